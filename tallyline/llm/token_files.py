"""Token ids as ORC: integer run-length encoding within stripes, row indexes, and Bloom filters on the document id.

Rows lie in ascending doc_id order, each file holding a range of its own, so a reader can take stripes in parallel and skip those
whose statistics or Bloom filter rule an id out. Beside its ids a row has its file's number and its place among the file's ids.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import cut, new_path
from tallyline.llm.words import held, in_turn, steps

#: A unit of letters or of marks alone, which the library takes as one; lower case but for what only the library lowers.
PLAIN = re.compile(r"[a-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+")
#: Units that a worker knows at most, and units to a call of the library.
CACHE, JOINED = 400_000, 400
#: Units of more bytes are named by a digest of all of them.
LONG = 64
#: Bytes of text that go into one file, about.
FILE_BYTES = 32 << 20
SCHEMA = "doc_id long, ids array<int>, file int, place long"

U = np.uint64


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """A class for every byte (0 white space, 1 letter or part of a longer character, 2 digit, 3 other), and the bytes in lower case."""
    kind, lower = np.full(256, 3, np.uint8), np.arange(256, dtype=np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = 0
    kind[0x30:0x3A] = 2
    kind[0x61:0x7B] = kind[0x41:0x5B] = kind[0x80:] = 1
    lower[0x41:0x5B] += 0x20
    return kind, lower


_KIND, _LOWER = _classes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the units of a text (bytes, lower case, white space at both ends) begin and end.

    The library splits at white space, and between letters, digits and other marks, but for an apostrophe before some letters. A word
    of ASCII and Latin-1 letters without an apostrophe is split so; any other is one unit, and the library's own rules apply within it.
    """
    kind = _KIND[raw]
    edge = np.diff((kind == 0).astype(np.int8))
    start, end = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1  # words
    latin = np.zeros(len(raw) + 1, bool)  # the two bytes of a Latin-1 letter
    latin[:-2] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    latin[1:] |= latin[:-1]
    odd = np.concatenate([[0], np.cumsum(((raw >= 0x80) & ~latin[:-1]) | (raw == 0x27))])
    whole = odd[end] > odd[start]
    at = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != 0)) + 1
    word = np.searchsorted(start, at, side="right") - 1
    keep = ~whole[word] | (at == start[word])
    at, word = at[keep], word[keep]
    return at, np.minimum(np.append(at[1:], len(raw)), end[word])


def names(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name for each unit; units of at most 8 bytes have different ones."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    block = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from every place on
    size = end - start
    out = size.astype(U)
    rest = np.arange(len(start))
    for k in range(0, LONG, 8):
        rest = rest[size[rest] > k]
        if not len(rest):
            break
        left = np.minimum(size[rest] - k, 8).astype(U)
        bytes_ = block[start[rest] + k] & (U(0xFFFFFFFFFFFFFFFF) >> (U(64) - U(8) * left))
        out[rest] = _mix(bytes_ ^ (out[rest] * U(0x9E3779B97F4A7C15)))
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


class WordTokenizer:
    """The library's tokenizer, asked once for each distinct unit of the texts.

    The vocabulary drops white space and never merges across units, so the ids of a text are those of its units in order. Only texts
    that hold one of its added tokens, in whatever case, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a unit
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.added = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        """An empty table: sorted names, and where the ids of each lie among ``ids``."""
        self.known, self.at, self.count, self.ids = np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers of the units in the order learnt, how many ids each has, and all their ids.

        Letters alone and marks alone are one sequence each, many to a call: a token that ends one tells them apart.
        """
        plain = [i for i, w in enumerate(words) if PLAIN.fullmatch(w)]
        order, count, ids = [np.array(plain, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        groups = [" ".join([words[i] for i in plain[k : k + JOINED]]) for k in range(0, len(plain), JOINED)]
        for k in range(0, len(groups), 64):
            for e in self.library.encode_batch_fast(groups[k : k + 64], add_special_tokens=False):
                ids.append(np.array(e.ids, np.uint32))
                count.append(np.diff(np.flatnonzero(self.last[ids[-1]]), prepend=-1))
        others = np.setdiff1d(np.arange(len(words)), order[0], assume_unique=True)
        order.append(others)
        for k in range(0, len(others), 4096):
            found = [e.ids for e in self.library.encode_batch_fast([words[i] for i in others[k : k + 4096]], add_special_tokens=False)]
            count.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32))
        return np.concatenate(order), np.concatenate(count), np.concatenate(ids)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and the texts' offsets among them."""
        special = np.zeros(len(texts), bool)
        for token in self.added:
            special |= pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False)
        if special.any():
            return self._with_special(texts, special)
        sizes = np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), np.int64)
        raw = _LOWER[np.frombuffer(b" ".join([b"", *(t.as_buffer() for t in texts.cast(pa.binary())), b""]), np.uint8)]
        if not len(texts):
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        start, end = units(raw)
        name, example, code = np.unique(names(raw, start, end), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, name)
        new = self.known[np.minimum(place, len(self.known) - 1)] != name if len(self.known) else np.ones(len(name), bool)
        if new.any():
            if len(self.known) + int(new.sum()) > CACHE:  # keep what this batch uses
                self._keep(place[~new])
            whole = raw.tobytes()
            order, count, ids = self._learn([whole[a:b].decode() for a, b in zip(start[example[new]].tolist(), end[example[new]].tolist(), strict=True)])
            self._add(name[new][order], count, ids)
            place = np.searchsorted(self.known, name)
        count, first = self.count[place][code], self.at[place][code]
        ends = np.cumsum(count)
        out = self.ids[np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        row = np.searchsorted(start, np.cumsum(sizes + 1) - sizes)
        return out, np.concatenate([[0], ends])[np.append(row, len(start))]

    def _keep(self, places: np.ndarray) -> None:
        count = self.count[places]
        ends = np.cumsum(count)
        self.ids = self.ids[np.repeat(self.at[places] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        self.known, self.at, self.count = self.known[places], ends - count, count

    def _add(self, name: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        at = np.cumsum(count) - count + len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        known = np.concatenate([self.known, name])
        order = np.argsort(known, kind="stable")
        self.known, self.at, self.count = known[order], np.concatenate([self.at, at])[order], np.concatenate([self.count, count])[order]

    def _with_special(self, texts: pa.Array, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold an added token, encoded whole, among the others."""
        others, at = self.encode_batch(texts.filter(pa.array(~special)))
        parts, k = [], 0
        for text, odd in zip(texts, special.tolist(), strict=True):
            if odd:
                parts.append(np.array(self.library.encode(text.as_py(), add_special_tokens=False).ids, np.uint32))
            else:
                parts.append(others[at[k] : at[k + 1]])
                k += 1
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


_loaded: dict[str, WordTokenizer] = {}
held(_loaded.clear)


def loaded(path: str) -> WordTokenizer:
    """One tokenizer for each worker process and file."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def tokenize(docs: DataFrame, path: str, end_id: int | None) -> DataFrame:
    """doc_id, ids (with ``end_id`` last), file (the partition), place (ids of the partition's rows before) for each row.

    Null and empty texts have the end id alone.
    """
    end = [] if end_id is None else [end_id]

    @in_turn("token_files")
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, file, before = loaded(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in steps(batch, 1, 4_000_000):
                ids, at = tok.encode_batch(part.column(1))
                values = np.insert(ids, np.repeat(at[1:], len(end)), np.tile(np.array(end, "<u4"), len(at) - 1))
                offsets = at + len(end) * np.arange(len(at))
                lists = pa.ListArray.from_arrays(offsets.astype(np.int32), values.astype(np.int32))
                place = pa.array(before + offsets[:-1], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(np.full(len(place), file, np.int32)), place], ["doc_id", "ids", "file", "place"])
                before += int(offsets[-1])

    return docs.mapInArrow(encode, SCHEMA)


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int | None = 1, files: int | None = None) -> None:
    """Tokenize every whole text and write ORC files in ascending doc_id order (nulls first; rows of like doc_id by a hash of their text).

    Texts, not ids, are dealt by ranges of doc_id and hash, so that each is tokenized once, in order, on its way into its file, and rows
    of one doc_id may fill several files. Without ``files`` there is one for every FILE_BYTES of text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    n = files or (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES + 1
    order = [F.col("doc_id").asc_nulls_first(), F.col("h").asc(), F.col("text").asc_nulls_first()]
    (
        tokenize(rows.repartitionByRange(n, *order[:2]).sortWithinPartitions(*order).select("doc_id", "text"), tokenizer, end_id)
        .write.option("orc.compress", "ZSTD")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(out)
    )


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Read token files; ``doc_ids`` are looked up through stripe statistics, row indexes and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of token files as read; ``start`` is the row's place in its file after all ids of the files before.

    Those totals are one small row a file.
    """

    @in_turn("token_files")
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            at = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "file", "place", "n_tokens", "ids_crc32"],
            )

    per_doc = cut(rows.mapInArrow(sums, "doc_id long, file int, place long, n_tokens long, ids_crc32 long"), "sums")
    totals = per_doc.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    offsets = totals.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return per_doc.join(offsets, "file").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write token files to the shared folder, read them back and digest them; one row for each row of ``docs``."""
    out = new_path(docs.sparkSession, "tokens")
    write_token_files(docs, out, tokenizer, end_id)
    return digest(read_token_files(docs.sparkSession, out))
