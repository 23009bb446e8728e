"""Toxicity: subword-bag embeddings averaged over spans of a text into a linear softmax; trained jointly in numpy.

A word is the bag of its character 3- to 5-grams (with word bounds) and itself, hashed into a fixed number of buckets, so that a
misspelling shares most vectors with the word it comes from; training reads part of the texts misspelt. The bags of all words are averaged span by span, from the first word to the last.
A window of a fixed number of words has the mean of its TOP spans that speak most for toxicity, so that no single odd word decides, and a text the
score of its worst window: what else it holds, and how much of it, takes nothing away. Where a text has no blanks for long, overlapping
pieces count as its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import fitted, fold, marked, sample_per_class
from tallyline.llm.words import Cache, in_turn, indexed, release, steps

#: Hash buckets of subwords, size of an embedding.
BUCKETS, DIM = 1 << 17, 12
#: Words of a span and of a window, which begins at every half of one; spans by which a window is scored.
SPAN, WINDOW, TOP = 2, 400, 4
#: Training begins with so many passes over whole texts, of each of which so many words are drawn anew in every pass (``train`` takes another number).
WHOLE, DRAWN = 2, 300
#: Misspelt forms of each word of FORMED or more characters that training knows, and the share of texts that an epoch reads in them.
FORMS, FORMED, SHARE = 3, 4, 0.3
#: Words whose subwords are looked up at a time.
AT_ONCE = 5_000
#: The bound of the training sample: rows per class, and characters of a row.
MOST_ROWS, MOST_CHARS = 1500, 20_000
#: Score from which a document counts as toxic.
THRESHOLD = 0.3
#: A longer token than LONG characters is not taken for a word: pieces of PIECE characters that overlap by OVERLAP stand for it.
LONG, PIECE, OVERLAP = 64, 12, 4
#: Marks that are dropped from both ends of a word.
MARKS = ".,;:!?()[]{}\"'|"
CACHE = 400_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def bare(word: str) -> str:
    """A word as it is looked up: lower case, without marks at its ends unless it is all marks."""
    return word.lower().strip(MARKS) or word


def pieces(word: str) -> list[str]:
    """What stands for a token: the bare word, or the pieces of a long one, which hold every n-gram of it."""
    whole = bare(word)
    if len(word) <= LONG:
        return [whole]
    return [whole[k : k + PIECE] for k in range(0, max(1, len(whole) - OVERLAP), PIECE - OVERLAP)]


def tokens(text: str) -> list[str]:
    """The words of a whole text, long ones in pieces."""
    return [p for w in text.split() for p in pieces(w)]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every subword of every word; n-grams are hashed from code points, all words at once."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = ["<" + w + ">" for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in padded])
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # characters to the end of the word
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    at, bucket = [], []
    for n in (3, 4, 5):
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ mixed[k : len(codes) - n + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(32)
            ok = left[: len(h)] >= n
            at.append(word[: len(h)][ok])
            bucket.append((h[ok] % np.uint64(BUCKETS)).astype(np.int64))
    # the word itself: the sum of its characters' hashes, each at its place
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.add.reduceat(mixed * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)), np.cumsum(sizes) - sizes)
    whole ^= whole >> np.uint64(31)
    at.append(np.arange(len(words)))
    bucket.append((whole % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(at), np.concatenate(bucket)


def n_subwords(word: str) -> int:
    """How many ``subwords`` a word has: itself, and its n-grams with its bounds."""
    return 1 + sum(max(0, len(word) + 3 - n) for n in (3, 4, 5))


def misspelt(word: str, rng: np.random.Generator) -> str:
    """The word with two neighbouring letters inside it swapped, one left out, or one doubled; short words as they are."""
    if len(word) < FORMED:
        return word
    way, i = rng.integers(4), int(rng.integers(1, len(word) - 2))
    if way < 2:
        return word[:i] + word[i + 1] + word[i] + word[i + 2 :]
    return word[:i] + (word[i] * 2 if way == 2 else "") + word[i + 1 :]


def word_logits(words: list[str], table: np.ndarray) -> np.ndarray:
    """Each word's share of the log odds: the mean over its subwords. ``table`` holds one number for each bucket."""
    at, bucket = subwords(words)
    n = np.bincount(at, minlength=len(words))
    return np.bincount(at, weights=table[bucket], minlength=len(words)) / np.maximum(n, 1)


def spans(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the spans of a text of n words begin and end; the last one ends with the text and is as long as the others, if the text is."""
    start = np.arange(0, n, SPAN)
    if n:
        start[-1] = max(0, min(start[-1], n - SPAN))
    return start, np.minimum(start + SPAN, n)


def worst_window(values: np.ndarray) -> tuple[float, np.ndarray]:
    """The score of a text's worst window by its words' logits: the mean of the TOP largest of its spans' means; and which spans these are."""
    start, end = spans(len(values))
    upto = np.concatenate([[0.0], np.cumsum(values)])
    means = (upto[end] - upto[start]) / (end - start)
    half = WINDOW // SPAN // 2
    if len(means) <= 2 * half:
        k = min(TOP, len(means))
        at = np.argpartition(means, len(means) - k)[-k:]
        return float(means[at].mean()), at
    blocks = np.concatenate([means, np.full(-len(means) % half, -np.inf)]).reshape(-1, half)
    each = np.concatenate([blocks[:-1], blocks[1:]], axis=1)
    top = np.argpartition(each, 2 * half - TOP, axis=1)[:, -TOP:]
    score = np.take_along_axis(each, top, axis=1).mean(axis=1)
    worst = int(score.argmax())
    return float(score[worst]), top[worst] + worst * half


class Model:
    """Log odds = mean over the worst window's spans of their words' mean logit + bias: the softmax over two classes of averaged embeddings."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.cache = Cache(self._learn, CACHE)

    def _learn(self, words: list[str]) -> dict[str, float]:
        spelt = [bare(w) for w in words]
        order = sorted(set(spelt))
        logit: dict[str, float] = {}
        for k in range(0, len(order), AT_ONCE):
            some = order[k : k + AT_ONCE]
            logit.update(zip(some, word_logits(some, self.table).tolist(), strict=True))
        return {w: logit[b] for w, b in zip(words, spelt, strict=True)}

    def _spread(self, words: list[str], codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of all words of all rows, pieces of long words each with its own, and the rows' offsets."""
        short = [w if len(w) <= LONG else "" for w in words]
        own = [np.array([x]) for x in self.cache.get(short)]
        for i, w in enumerate(words):
            if len(w) > LONG:
                parts = pieces(w)
                own[i] = np.concatenate([word_logits(parts[k : k + AT_ONCE], self.table) for k in range(0, len(parts), AT_ONCE)])
        count = np.fromiter(map(len, own), np.int64, len(own))
        flat, start, n = np.concatenate(own), np.cumsum(count) - count, count[codes]
        ends = np.cumsum(n)
        return flat[np.repeat(start[codes] - (ends - n), n) + np.arange(ends[-1])], np.concatenate([[0], ends])[offsets]

    def scores(self, texts: pa.Array) -> list[float]:
        """Score of each whole text by its worst window; 0 without a word."""
        words, codes, offsets = indexed(pc.utf8_split_whitespace(texts))
        keep = np.array([w != "" for w in words], bool)[codes] if "" in words else np.ones(len(codes), bool)
        if any(len(w) > LONG for w in words):
            offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
            values, offsets = self._spread(words, codes[keep], offsets)
            keep = np.ones(len(values), bool)
        else:
            values = np.array(self.cache.get(words))[codes] if len(codes) else np.zeros(0)
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = values[a:b][keep[a:b]]
            if not len(own):
                out.append(0.0)
                continue
            best = np.clip(worst_window(own)[0] + self.bias, -30, 30)
            out.append(float(1 / (1 + np.exp(-best))))
        return out


def fit(texts: list[str], labels: list[int], epochs: int = 14, seed: int = 7, drawn: int = DRAWN, share: float = SHARE) -> Model:
    """Train embeddings and softmax together. Each epoch takes from every text the spans of its worst window so far; the first WHOLE epochs take all words, or ``drawn``.

    In every epoch a ``share`` of the texts, toxic and clean ones alike, is read misspelt (FORMS), so that n-grams which outlast a misspelling bear the weight.
    Without both classes there is nothing to tell apart; every score is then the share of label 1.
    """
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4))
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in tokens(t)], np.int32) for t in texts]
    known = list(number)
    forms = np.array([[number.setdefault(misspelt(w, rng), len(number)) for w in known] for _ in range(FORMS)], np.int32)
    vocabulary = list(number)
    n_sub = np.array([n_subwords(w) for w in vocabulary], np.int32)
    first = np.concatenate([[0], np.cumsum(n_sub, dtype=np.int64)])
    joined = [" ".join(vocabulary[k : k + AT_ONCE]) for k in range(0, len(vocabulary), AT_ONCE)]  # single strings take several times the room
    del number, known, vocabulary
    release()
    bucket = np.empty(first[-1], np.int32)
    for k, some in enumerate(joined):
        at, own = subwords(some.split(" "))
        begin = first[k * AT_ONCE]
        bucket[begin : begin + len(own)] = own[np.argsort(at, kind="stable")]
    del joined
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    out = rng.normal(0, 0.1, (DIM, 2))
    bias = np.zeros(2)
    seen_emb, seen_out, seen_bias = np.full((BUCKETS, 1), 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    for epoch in range(epochs):
        table = (emb @ (out[:, 1] - out[:, 0])).astype(np.float32)
        logit = [np.zeros(0)]
        for k in range(0, len(n_sub), AT_ONCE):
            some = first[k : k + AT_ONCE + 1]
            logit.append(np.add.reduceat(table[bucket[some[0] : some[-1]]], some[:-1] - some[0]) / n_sub[k : k + AT_ONCE])
        logit = np.concatenate(logit)
        bags, target = [], []
        for d, label in zip(docs, y.tolist(), strict=True):
            if not len(d):
                continue
            if rng.random() < share:
                d = forms[rng.integers(FORMS, size=len(d)), d]
            if epoch < WHOLE:
                bags.append(d if len(d) <= drawn else rng.choice(d, drawn, replace=False))
            else:
                start, end = spans(len(d))
                bags.append(np.concatenate([d[start[i] : end[i]] for i in worst_window(logit[d])[1]]))
            target.append(label)
        order = rng.permutation(len(bags))
        size = 32 if epoch < WHOLE else 128
        rate = 0.5 * (1 - epoch / (epochs + 2))
        for k in range(0, len(order), size):
            batch = [bags[i] for i in order[k : k + size]]
            t = np.array([target[i] for i in order[k : k + size]])
            flat = np.concatenate(batch)
            row = np.repeat(np.arange(len(batch)), [len(b) for b in batch])
            counts = n_sub[flat]
            gather = np.repeat(first[flat], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            sub = bucket[gather]
            weight = np.repeat(1.0 / (counts * np.bincount(row)[row]), counts)
            sub_row = np.repeat(row, counts)
            used, inverse = np.unique(sub, return_inverse=True)
            bag = np.bincount(sub_row * len(used) + inverse, weights=weight, minlength=len(batch) * len(used)).reshape(len(batch), len(used))
            hidden = bag @ emb[used]
            z = hidden @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(t)), t] -= 1
            g_out, g_bias, g_emb = hidden.T @ p / len(t), p.mean(axis=0), bag.T @ (p @ out.T)
            seen_out += g_out**2
            seen_bias += g_bias**2
            seen_emb[used] += (g_emb**2).mean(axis=1, keepdims=True)
            out -= rate * 0.2 * g_out / np.sqrt(seen_out)
            bias -= rate * 0.2 * g_bias / np.sqrt(seen_bias)
            emb[used] -= rate * g_emb / np.sqrt(seen_emb[used])
    return Model(emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_chars: int = MOST_CHARS, drawn: int = DRAWN) -> Model:
    """Fit on labelled rows outside the held-out fold: at most ``most_rows`` of each class, each of at most ``most_chars`` characters; see ``fitted``.

    Twice as many ids as rows are drawn and broadcast to fetch texts in one pass, since some texts are too long or missing.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = F.broadcast(rows.groupBy("toxic").agg(F.count("*").alias("n")))  # two rows
    picked = sample_per_class(rows, "toxic", counts, ["doc_id"], 2 * most_rows)  # at most 4 * most_rows ids
    short = docs.selectExpr("cast(doc_id as long) doc_id", "text").where((F.length("text") <= most_chars) & F.col("doc_id").isNotNull())
    texts = short.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(0)), "doc_id")
    found = texts.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most_rows).select("doc_id", "text", "toxic")

    def learn(columns: list[list]) -> pa.RecordBatch:
        model = fit(*columns, drawn=drawn)
        return pa.RecordBatch.from_pydict({"logits": [model.table.tobytes()], "bias": [model.bias]})

    row = fitted(found, ["doc_id"], "toxicity training", learn, "logits binary, bias double")
    return Model(np.frombuffer(bytes(row.logits)), row.bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; texts without a token (null, empty) score 0; repeated rows stay."""
    table, bias = model.table.astype(np.float32), model.bias

    @in_turn("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(table, bias)
        for batch in batches:
            for part in steps(batch, 2):
                s = own.scores(part.column(2))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(s, pa.float64()), pa.array([int(x >= THRESHOLD) for x in s], pa.int32())],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)


def filter_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns), as they are, that are not predicted to be toxic; null and empty texts stay."""
    table, bias = model.table.astype(np.float32), model.bias
    at = docs.columns.index("text")

    @in_turn("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(table, bias)
        for batch in batches:
            yield marked(batch, at, lambda part: [s < THRESHOLD for s in own.scores(part.column(at))])

    return docs.mapInArrow(run, docs.schema)
