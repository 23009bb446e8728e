"""Byte-level BPE as batched matrix work: pieces of like length form one padded matrix, and every row merges once a round."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tallyline.llm.words import Cache, gather, held, in_turn, indexed, steps

#: No token: padding, and the rank of a pair that does not merge.
NONE = np.int64(1) << 40
#: Pieces above this many bytes merge through a heap, whose work grows with n log n instead of n squared.
LONG_PIECE = 192
#: Segments, and pieces, that a worker remembers before it starts anew; bounds the memory of a worker.
CACHE = 120_000
#: Bytes of text that a worker encodes at a time.
STEP = 1_000_000
#: A blank before a character that no regex dialect counts as white space. The pattern always begins a new match there.
SEGMENT = re.compile(r" (?=[!-~¡-ɏ])")
#: A blank before anything else, or at the end.
OTHER_BLANK = " ([^!-~¡-ɏ]|$)"
#: A segment of one run of letters, with or without one mark behind it: one piece, or two.
PLAIN = re.compile(r" ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+([.,]?)")

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairTable:
    """Open-addressing hash table from a pair of ids to the id (and rank) of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(4 * len(left) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        self.probes = 1
        keys = (left.astype(np.int64) << 20) | right.astype(np.int64)
        slots, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            free = self.keys[slots[rest]] == -1
            _, first = np.unique(slots[rest], return_index=True)
            take = np.zeros(len(rest), bool)
            take[first] = True
            take &= free
            self.keys[slots[rest[take]]] = keys[rest[take]]
            self.values[slots[rest[take]]] = merged[rest[take]]
            rest = rest[~take]
            if len(rest):
                slots[rest] = (slots[rest] + 1) & (len(self.keys) - 1)
                self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NONE where there is none or an id is NONE."""
        keys = np.where((left < NONE) & (right < NONE), (left << 20) | right, np.int64(-2))
        shape, keys = keys.shape, keys.ravel()
        out = np.full(len(keys), NONE, np.int64)
        rest = np.flatnonzero(keys >= 0)
        slots = self._slot(keys[rest])
        for _ in range(self.probes):
            if not len(rest):
                break
            there = self.keys[slots]
            hit = there == keys[rest]
            out[rest[hit]] = self.values[slots[hit]]
            on = ~hit & (there != -1)
            rest, slots = rest[on], (slots[on] + 1) & (len(self.keys) - 1)
        return out.reshape(shape)


class ByteBpe:
    """Encoder and decoder for a file of byte-string ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.token = dict((i, b) for b, i in ranks.items())
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for word, rank in ranks.items():
            for k in range(1, len(word)):
                if (a := ranks.get(word[:k])) is not None and (b := ranks.get(word[k:])) is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(merged, np.int64))
        self.pair_of = dict(zip(zip(left, right, strict=True), merged, strict=True))
        self.segments = Cache(self._learn, CACHE)
        self.pieces = Cache(self.encode_pieces, CACHE)

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}, pattern)

    def merge_rows(self, ids: np.ndarray) -> list[bytes]:
        """Merge the rows of a padded id matrix to the end; each round, every row merges its leftmost pair of least rank."""
        done: list[bytes] = [b""] * len(ids)
        row = np.arange(len(ids))
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        while len(ids):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                least = ranks[np.arange(len(ids)), at]
            else:
                at, least = np.zeros(len(ids), np.int64), np.full(len(ids), NONE)
            ended = least == NONE
            if ended.any():  # rows that ended leave the matrix
                final = ids[ended]
                flat, width = final.astype("<u4").tobytes(), 4 * final.shape[1]
                for k, (i, n) in enumerate(zip(row[ended].tolist(), (final < NONE).sum(axis=1).tolist(), strict=True)):
                    done[i] = flat[k * width : k * width + 4 * n]
                on = ~ended
                ids, ranks, row, at, least = ids[on], ranks[on], row[on], at[on], least[on]
                if not len(ids):
                    break
            r = np.arange(len(ids))
            ids[r, at] = least
            # what stands right of the merged pair moves one place to the left
            right = np.arange(ids.shape[1] - 1) > at[:, None]
            ids = np.where(right, ids[:, 1:], ids[:, :-1])
            width = int((ids < NONE).sum(axis=1).max())
            ids = ids[:, :width]
            if width < 2:
                ranks = np.empty((len(ids), 0), np.int64)
                continue
            right = np.arange(ranks.shape[1] - 1) >= at[:, None]
            ranks = np.where(right, ranks[:, 1:], ranks[:, :-1])[:, : width - 1]
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < width - 1))
                ranks[ok, side[ok]] = self.pairs.find(ids[ok, side[ok]], ids[ok, side[ok] + 1])
        return done

    def merge_long(self, piece: bytes) -> bytes:
        """One long piece: a heap of (rank, place) over a linked list gives the same merges."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.pair_of.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = rank, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.pair_of.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x, on in zip(ids, alive, strict=True) if on], "<u4").tobytes()

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each distinct piece, as little-endian unsigned 32-bit integers."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            if (whole := self.ranks.get(raw)) is not None:
                out[piece] = whole.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                out[piece] = self.merge_long(raw)
            else:
                by_width.setdefault(-(-len(raw) // 4) * 4, []).append((piece, raw))
        for width, bucket in by_width.items():
            step = max(1, 200_000 // width)
            for k in range(0, len(bucket), step):
                some = bucket[k : k + step]
                chars = np.frombuffer(b"".join([raw.ljust(width, b"\0") for _, raw in some]), np.uint8).reshape(len(some), width)
                real = np.arange(width) < np.array([len(raw) for _, raw in some])[:, None]
                merged = self.merge_rows(np.where(real, self.byte_id[chars], NONE))
                out.update(zip([piece for piece, _ in some], merged, strict=True))
        return out

    def _learn(self, segments: list[str]) -> dict[str, bytes]:
        split: list[list[str]] = []
        for s in segments:
            if m := PLAIN.fullmatch(s):
                split.append([s[:-1], m[1]] if m[1] else [s])
            else:
                split.append(self.pattern.findall(s))
        wanted = list({p for ps in split for p in ps})
        ids = dict(zip(wanted, self.pieces.get(wanted), strict=True))
        return {s: ids[ps[0]] if len(ps) == 1 else b"".join([ids[p] for p in ps]) for s, ps in zip(segments, split, strict=True)}

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and the texts' offsets among them.

        A text is cut before every blank that begins a match for certain; other blanks stay within their segment.
        """
        lists = pc.split_pattern(texts, " ")
        odd = pc.match_substring_regex(texts, OTHER_BLANK).to_numpy(zero_copy_only=False)
        if odd.any():  # rejoin those that were cut at another blank
            rows = lists.to_pylist()
            for i in np.flatnonzero(odd):
                rows[i] = SEGMENT.split(texts[i].as_py())
            lists = pa.array(rows, pa.list_(pa.string()))
        segments, codes, offsets = indexed(lists)
        codes = codes.astype(np.int64) + len(segments)
        codes[offsets[:-1]] -= len(segments)  # the first of a text has no blank before it; every text has one
        used, codes = np.unique(codes, return_inverse=True)
        spelt = [segments[k] if k < len(segments) else " " + segments[k - len(segments)] for k in used.tolist()]
        return gather(self.segments.get(spelt), codes, offsets)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[tuple[str, str], ByteBpe] = {}
held(_loaded.clear)


def loaded(path: str, pattern: str) -> ByteBpe:
    """One encoder for each worker process and file."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe.load(path, pattern)
    return _loaded[path, pattern]


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encode every whole text and decode the ids again.

    One row for each row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256. Null and empty texts have no
    tokens and the digests of nothing; repeated rows stay repeated; other columns are not read. The tokenizer's file must be at
    ``path`` on every executor.
    """

    @in_turn("bpe")
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            for part in steps(batch, 1, STEP):
                ids, at = bpe.encode_batch(part.column(1))
                each = [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in each], pa.string()),
                        pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in each], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(encode, SCHEMA)


def encode_ids(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The ids themselves: doc_id and ids (array of int) for each row, nulls as in :func:`round_trip`."""

    @in_turn("bpe")
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            for part in steps(batch, 1, STEP):
                ids, at = bpe.encode_batch(part.column(1))
                lists = pa.ListArray.from_arrays(at.astype(np.int32), ids.astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>")
