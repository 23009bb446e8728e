"""Language identification by string kernels: blended-spectrum presence kernels, Nystroem landmarks, one-versus-rest ridge regression.

Two texts are as alike as the number of n-grams (n = 1, 2, 3) that both hold, over the geometric mean of how many each holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import cut, discard, fitted, fold, marked, sample_per_class
from tallyline.llm.words import in_turn, steps

#: n-gram orders of the spectrum, and the number of cells that n-grams are hashed into.
ORDERS, CELLS = (1, 2, 3), 1 << 15
#: The bound of the training sample: rows per language and in all; landmarks per language and in all. With more languages, each has
#: fewer rows and landmarks, but four at least. A row's text counts as a whole up to MOST_CHARS characters, a longer one by STRETCHES of it.
MOST_ROWS, ALL_ROWS, MOST_CHARS, STRETCHES, LANDMARKS, ALL_LANDMARKS = 400, 16_000, 8_000, 16, 48, 1_024
#: Cells that are folded at a time.
AT_ONCE = 1 << 12
RIDGE, SHARPNESS = 1e-2, 8.0
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def presence(texts: list[str]) -> np.ndarray:
    """0/1 matrix of n-grams present: a row for each whole text, a column for each cell. White space counts as one blank."""
    out = np.zeros((len(texts), CELLS), np.float32)
    for row, text in zip(out, texts, strict=True):
        codes = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        for start in range(0, len(codes), 1 << 18):  # a long text in overlapping stretches
            part = codes[start : start + (1 << 18) + max(ORDERS) - 1].astype(np.uint64) + np.uint64(1)
            for n in ORDERS:
                if len(part) >= n:
                    h = np.full(len(part) - n + 1, n, np.uint64)
                    for k in range(n):
                        h = (h ^ part[k : len(part) - n + 1 + k]) * _MIX[k]
                        h ^= h >> np.uint64(31)
                    row[(h * _MIX[0]) >> np.uint64(49)] = 1.0
    return out


class Model:
    """Decision values are kernel(text, landmarks) @ weights; weights hold the Nystroem map and the ridge solution."""

    def __init__(self, langs: list[str], landmarks: np.ndarray, weights: np.ndarray, intercept: np.ndarray):
        self.langs, self.intercept = langs, intercept
        #: A text whose best decision value is below this is in none of the languages; see ``threshold``.
        self.least = -np.inf
        self.norms = np.sqrt(np.maximum(landmarks.sum(axis=1), 1)) if len(landmarks) else np.zeros(0)
        #: landmarks.T / norms @ weights: the batched products of all landmarks, folded into one matrix, some cells at a time
        self.folded = np.zeros((CELLS, len(langs)), np.float32)
        for k in range(0, CELLS if len(landmarks) else 0, AT_ONCE):
            self.folded[k : k + AT_ONCE] = (landmarks[:, k : k + AT_ONCE].T / self.norms) @ weights

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score (softmax of the decision values) of each whole text."""
        return [(lang, score) for lang, score, _ in self.decided(texts)]

    def decided(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """Language, score and best decision value of each whole text."""
        out: list[tuple[str, float, float]] = []
        for k in range(0, len(texts), 64):
            some = texts[k : k + 64]
            x = presence(some)
            f = (x @ self.folded) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1)) + self.intercept
            for text, row in zip(some, f, strict=True):
                if not self.langs or not LETTER.search(text):
                    out.append((UNKNOWN, 0.0, -np.inf))
                    continue
                p = np.exp(SHARPNESS * (row - row.max()))
                best = int(row.argmax())
                out.append((self.langs[best], float(p[best] / p.sum()), float(row[best])))
        return out


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS) -> Model:
    """Fit on labelled texts. One language: it is always predicted. None: every prediction is ``und``."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((0, CELLS), np.float32), np.zeros((0, 0)), np.zeros(0))
    landmarks = max(4, min(landmarks, ALL_LANDMARKS // len(names)))
    marks = np.concatenate([np.flatnonzero(np.array(langs) == n)[:landmarks] for n in names])
    held = presence([texts[i] for i in marks])
    norms = np.sqrt(np.maximum(held.sum(axis=1), 1))
    c = np.zeros((len(texts), len(marks)))
    for k in range(0, len(texts), 64):  # the sample's presence matrix as a whole would be large
        x = presence(texts[k : k + 64])
        c[k : k + 64] = (x @ held.T) / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] / norms
    values, vectors = np.linalg.eigh(c[marks])
    keep = values > 1e-6 * values.max()
    nystroem = vectors[:, keep] / np.sqrt(values[keep])
    z = c @ nystroem
    y = np.where(np.array(langs)[:, None] == np.array(names), 1.0, -1.0)
    mean_z, mean_y = z.mean(axis=0), y.mean(axis=0)
    w = np.linalg.solve((z - mean_z).T @ (z - mean_z) + RIDGE * len(z) * np.eye(z.shape[1]), (z - mean_z).T @ (y - mean_y))
    return Model(names, held, nystroem @ w, mean_y - mean_z @ w)


def threshold(texts: list[str], langs: list[str], lose: float) -> float:
    """The decision value that all but a share ``lose`` of labelled texts reach, under a model fitted on the other half of them.

    Softmax scores do not tell whether a text is in any of the languages, as they only compare them; decision values do.
    """
    model = fit(texts[::2], langs[::2])
    values = [v for _, _, v in model.decided(texts[1::2])]
    return float(np.quantile(values, lose)) - 1e-6 if values and model.langs else -np.inf


def spread(text: Column, most: int) -> Column:
    """A text of at most ``most`` characters as it is, of a longer one stretches of together as many, evenly spread from its beginning to its end."""
    size = most // STRETCHES
    start = lambda i: (F.floor(i * (F.length(text) - size) / (STRETCHES - 1)) + 1).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), lambda i: F.substring(text, start(i), F.lit(size)))
    return F.when(F.length(text) <= most, text).otherwise(F.array_join(parts, " "))


def train(docs: DataFrame, most_rows: int = MOST_ROWS, most_chars: int = MOST_CHARS, lose: float | None = None) -> Model:
    """Fit on labelled rows outside the held-out fold: at most ``most_rows`` of each language, each text from all over (see ``spread``).

    Every non-null language is learnt. One pass counts the rows of each (without their texts), one takes the sample. With ``lose``,
    the model rejects texts by the ``threshold`` that this share of them falls below. See ``fitted`` for where it is fitted.
    """
    rows = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 2))
    counts = cut(rows.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    most_rows = max(4, min(most_rows, ALL_ROWS // max(1, counts.count())))
    texts = rows.where(F.col("text").rlike(r"\p{L}")).select("lang", F.xxhash64("doc_id", "text").alias("h"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = sample_per_class(texts, "lang", counts, ["h", "doc_id"], most_rows)
    found = some.select("h", "doc_id", "lang", F.col("lang").alias("name"), spread(F.col("text"), most_chars).alias("text"))

    def learn(columns: list[list]) -> pa.RecordBatch:
        names, texts = columns
        model = fit(texts, names)
        least = -np.inf if lose is None else threshold(texts, names, lose)
        return pa.RecordBatch.from_pydict({"langs": pa.array([model.langs], pa.list_(pa.string())), "folded": [model.folded.tobytes()], "intercept": pa.array([model.intercept], pa.list_(pa.float64())), "least": [least]})

    row = fitted(found, ["h", "doc_id", "lang"], "langid training", learn, "langs array<string>, folded binary, intercept array<double>, least double")
    discard(counts)
    model = Model(row.langs, np.zeros((0, CELLS), np.float32), np.zeros((0, 0)), np.array(row.intercept, np.float64))
    model.folded, model.least = np.frombuffer(bytes(row.folded), np.float32).reshape(CELLS, len(row.langs)), row.least
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; ``und`` with score 0 where a text is null or has no letter."""
    langs, folded, intercept = model.langs, model.folded, model.intercept

    @in_turn("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(langs, np.zeros((0, CELLS), np.float32), np.zeros((0, 0)), intercept)
        own.folded = folded
        for batch in batches:
            for part in steps(batch, 2):
                found = own.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)


def filter_known(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is told with a score of ``least`` or more and which the model does not reject.

    ``und`` always goes, so null and empty texts do. Rows stay as they are; repeated ones stay or go together.
    """
    langs, folded, intercept, reached = model.langs, model.folded, model.intercept, model.least
    at = docs.columns.index("text")

    @in_turn("langid")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(langs, np.zeros((0, CELLS), np.float32), np.zeros((0, 0)), intercept)
        own.folded = folded
        for batch in batches:
            yield marked(batch, at, lambda part: [x != UNKNOWN and s >= least and v >= reached for x, s, v in own.decided(part.column(at).to_pylist())])

    return docs.mapInArrow(run, docs.schema)
