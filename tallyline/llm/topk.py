"""Exact top-k by inner product: term-at-a-time accumulation of postings into dense scores, block by block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most rows of a candidate block and of a query block, and least rows of a candidate block where there are partitions to fill.
CANDIDATES, QUERIES, LEAST = 65_536, 8_192, 4_096
#: Query rows whose dense scores are held at once.
HELD = 64
PARTIAL = "query_id long, vec_id long, score long"


def quantize(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """vec_id and terms: floor(scale * x) of every component. Null vectors and ones with a null or non-finite component go.

    Repeated rows stay. Components beyond a shorter vector's end count as 0.
    """
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    terms = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long"))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), terms.alias("terms"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Rows as one integer matrix, shorter ones filled with 0."""
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def block_top(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of one block for each query of one block, ties to the smaller vec_id."""
    if not len(queries) or not len(candidates):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    candidates = candidates.sort_values("vec_id", ignore_index=True)
    ids, n = candidates.vec_id.to_numpy(), len(candidates)
    width = max(map(len, [*queries.terms, *candidates.terms]), default=0)
    c, q = _matrix(candidates.terms, width), _matrix(queries.terms, width)
    bound = int(np.abs(q).sum(axis=1).max(initial=0)) * int(np.abs(c).max(initial=0))
    kind = np.int32 if bound < 2**30 else np.int64
    postings = []  # for each term: the rows that have it and their weights; a term in most rows is posted for all of them
    for d in range(width):
        at = np.flatnonzero(c[:, d])
        postings.append((slice(None), c[:, d].astype(kind)) if len(at) > n // 2 else (at, c[at, d].astype(kind)))
    own, out = queries.vec_id.to_numpy(), []
    for first in range(0, len(q), HELD):
        part, part_ids = q[first : first + HELD].astype(kind), own[first : first + HELD]
        scores = np.zeros((len(part), n), kind)
        for d in range(width):
            at, weight = postings[d]
            for i in np.flatnonzero(part[:, d]):
                scores[i, at] += part[i, d] * weight
        most = k + int((np.searchsorted(ids, part_ids, side="right") - np.searchsorted(ids, part_ids)).max(initial=0))
        least = np.partition(scores, n - most, axis=1)[:, n - most, None] if n > most else np.iinfo(kind).min
        row, col = np.nonzero(scores >= least)  # the best of each row but for its own, with all ties of the last one
        other = ids[col] != part_ids[row]
        row, col = row[other], col[other]
        best = np.lexsort((ids[col], ~scores[row, col], row))  # ~x falls as x grows, and never overflows
        row, col = row[best], col[best]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, col = row[top], col[top]
        out.append(pd.DataFrame({"query_id": part_ids[row], "vec_id": ids[col], "score": scores[row, col].astype(np.int64)}))
    return pd.concat(out, ignore_index=True)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each row of ``queries`` (both vec_id, terms), but for its own vec_id.

    Every pair of a query block and a candidate block is one group of bounded size; a window merges the blocks' best. Each candidate is
    sent once for every QUERIES queries, each query once for every candidate block.
    """
    n_c, n_q = vectors.count(), queries.count()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks_c = max(-(-n_c // CANDIDATES), min(tasks, n_c // LEAST), 1)
    blocks_q = max(1, -(-n_q // QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("vec_id", "terms", F.pmod(F.xxhash64("vec_id"), F.lit(blocks_q)).cast("int").alias("qb"), every(blocks_c).alias("cb"))
    right = vectors.select("vec_id", "terms", F.pmod(F.monotonically_increasing_id(), F.lit(blocks_c)).cast("int").alias("cb"), every(blocks_q).alias("qb"))
    partial = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(lambda a, b: block_top(a, b, k), PARTIAL)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return partial.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


def every_twentieth(embeddings: DataFrame, k: int = 20) -> DataFrame:
    """Top k for each vec_id that is divisible by 20 (of several rows with it, the least vector), among all rows with another vec_id.

    A row that repeats another one is a candidate of its own.
    """
    vectors = quantize(embeddings)
    queries = vectors.where(F.col("vec_id") % 20 == 0).groupBy("vec_id").agg(F.min("terms").alias("terms"))
    return search(vectors, queries, k)
