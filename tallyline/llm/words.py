"""Columnar word handling for the Python operators: split in Arrow, look each distinct word of a batch up once, gather in numpy."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a worker handles at a time.
STEP_BYTES = 6_000_000


_turn: dict[str, str] = {}
_forget: list[Callable[[], None]] = []


def held(forget: Callable[[], None]) -> None:
    """Register how to drop what a module keeps in a worker from task to task."""
    _forget.append(forget)


def release() -> None:
    """Give freed memory back to the system: workers live on between tasks, and theirs counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def in_turn(owner: str):
    """For functions over the batches of a task: a worker drops what other operators keep before one takes its turn, and tidies up after a task."""

    def wrap(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        @functools.wraps(run)
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if _turn.get("now") != owner:
                for forget in _forget:
                    forget()
                _turn["now"] = owner
                release()
            yield from run(batches)
            release()

        return task

    return wrap


def steps(batch: pa.RecordBatch, text: int, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes of text each; a longer row stands alone. The text column is filled with ''."""
    column = batch.column(text)
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    group = np.cumsum(size) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            part = batch.slice(a, b - a)
            yield part.set_column(text, "text", pc.fill_null(part.column(text), ""))


def indexed(lists: pa.ListArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct strings of a list column, each item's index among them, and the rows' offsets."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), offsets - offsets[0]


def gather(pieces: list[bytes], codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one behind the other, and the rows' offsets: each item of a row stands for the ids in ``pieces``."""
    flat = np.frombuffer(b"".join(pieces), "<u4")
    count = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
    start = np.cumsum(count) - count
    n = count[codes]
    ends = np.cumsum(n)
    out = flat[np.repeat(start[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    return out, np.concatenate([[0], ends])[offsets]


class Cache:
    """What a worker knows of strings, at most about ``most`` of them: when the younger half is full, the older half goes.

    Strings that are asked for again move into the younger half, so that frequent ones stay.
    """

    def __init__(self, learn: Callable[[list[str]], dict], most: int):
        self.learn, self.half, self.young, self.old = learn, most // 2, {}, {}

    def get(self, wanted: list[str]) -> list:
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = [w for w in wanted if w not in young]
        young.update([(w, old[w]) for w in missing if w in old])
        if new := [w for w in missing if w not in old]:
            young.update(self.learn(new))
        return [young[w] for w in wanted]
