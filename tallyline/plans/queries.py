"""Parameterised queries over published tables. Parameters are checked before any job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.scalars import match_rank, round_half_up
from tallyline.operators.pooled import pooled_quantile
from tallyline.operators.reports import limited

NOTES = {"license": "CC BY 4.0 compatible terms of the publisher", "caveat": "cells with one or two masked winners are left out"}


#: How many values an error lists.
LISTED = 100
#: Buckets that a query gives at most.
MOST_BUCKETS = 200


def filter_years(stats: DataFrame, year: int | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """Rows of one year, or of an inclusive range. A year that is not in the table is an error, bounds outside it are not."""
    if year is not None:
        out = stats.where(F.col("fiscal_year") == year)
        if out.isEmpty():
            raise ValueError(f"no fiscal year {year}")
        return out
    out = stats
    if low is not None:
        out = out.where(F.col("fiscal_year") >= low)
    if high is not None:
        out = out.where(F.col("fiscal_year") <= high)
    return out


def resolve(stats: DataFrame, text: str, name: str, code: str | None = None) -> DataFrame:
    """Values of a dimension that answer a search: the exact ones, else those that contain it; several hits are all taken.

    Where the dimension has codes, a search that begins with a name finds it too. None for a search without a hit.
    """
    dim = stats.select(F.col(name), F.col(code) if code else F.lit("").alias("code_")).distinct()
    rank = match_rank(F.col(name), F.col(code) if code else F.lit(""), text, starts=code is not None)
    ranked = dim.withColumn("rank_", rank).where("rank_ is not null").withColumn("best_", F.min("rank_").over(Window.partitionBy()))
    return ranked.where("rank_ = best_").select(name).distinct()


def resolved(stats: DataFrame, text: str, name: str, code: str | None = None) -> DataFrame:
    """Like :func:`resolve`, but a search without a hit is an error that lists values there are."""
    hits = resolve(stats, text, name, code)
    if hits.isEmpty():
        some = [r[0] for r in stats.select(name).distinct().orderBy(name).limit(LISTED).collect()]
        raise ValueError(f"unknown {name}: {text!r}. Available values: {', '.join(map(str, some))}")
    return hits


def matched(stats: DataFrame, low=None, high=None, sector=None, prefecture=None, year=None) -> DataFrame:
    """Rows that answer all given parameters."""
    rows = filter_years(stats, year, low, high)
    if sector is not None:
        rows = rows.join(resolved(stats, sector, "sector"), "sector", "left_semi")
    if prefecture is not None:
        rows = rows.join(resolved(stats, prefecture, "prefecture", "prefecture_code"), "prefecture", "left_semi")
    return rows


def procurement_totals(stats: DataFrame, **parameters) -> DataFrame:
    """One row of totals over the matched cells; the mean is rounded half up."""
    rows = matched(stats, **parameters)
    sums = [F.sum(c).alias(c) for c in ("n_awards", "n_corporate", "n_masked_individual", "amount_sum_jpy")]
    mean = round_half_up(F.sum("amount_sum_jpy") / F.sum("n_awards")).alias("amount_mean_jpy")
    return rows.agg(F.count("*").alias("n_cells"), *sums, mean, F.min("amount_min_jpy").alias("amount_min_jpy"), F.max("amount_max_jpy").alias("amount_max_jpy"))


def procurement_buckets(stats: DataFrame, n: int = 25, **parameters) -> DataFrame:
    """The first matched cells in order, with how many matched and whether some are left out."""
    rows = matched(stats, **parameters).select("fiscal_year", "prefecture", "sector", "n_awards", "amount_median_jpy")
    return limited(rows, ["fiscal_year", "sector", "prefecture"], n)


def procurement_quantiles(cells: DataFrame) -> DataFrame:
    """One row: number of cells and the pooled quartiles in whole yen."""
    out = pooled_quantile(cells, [])
    return out.select("n_cells", *[F.bround(c, 0).cast("long").alias(c) for c in ("q25", "q50", "q75")])


def procurement_stats(stats: DataFrame, bucket_limit: int = 25, include_buckets: bool = True, **parameters) -> DataFrame:
    """One row: totals, quartiles and how they were found, the first buckets, notes, licence, over the cells that match.

    Quartiles of a single cell are its own; of several they are pooled from their five-number summaries.
    """
    rows = matched(stats, **parameters)
    totals = procurement_totals(stats, **parameters)
    pooled = pooled_quantile(rows, []).select(*[F.bround(c, 0).cast("long").alias(c) for c in ("q25", "q50", "q75")])
    own = rows.agg(*[F.max(f"amount_{c}_jpy").alias(f"own_{c}") for c in ("q1", "median", "q3")])
    k = max(0, min(bucket_limit, MOST_BUCKETS)) if include_buckets else 0
    cell = F.struct("fiscal_year", "sector", "prefecture", "n_awards", "amount_median_jpy")
    first = rows.orderBy("fiscal_year", "sector", "prefecture").limit(k).agg(F.array_sort(F.collect_list(cell)).alias("buckets"))
    out = totals.join(own).join(first).join(pooled, how="left")  # one row each
    single = F.col("n_cells") == 1
    quartile = [F.when(single, F.col(f"own_{n}")).otherwise(F.col(q)).alias(f"amount_{n}_jpy") for n, q in (("q1", "q25"), ("median", "q50"), ("q3", "q75"))]
    method = F.when(single, "exact").when(F.col("n_cells") > 1, "estimated")
    notes = F.array(
        F.when(F.col("n_cells") == 0, "no cell matched, or those that did are withheld"),
        F.when(F.col("n_cells") > 1, "quartiles over more than one cell are estimated"),
        F.when((F.col("n_cells") > k) & F.lit(k > 0), F.concat(F.lit(f"the first {k} of "), F.col("n_cells").cast("string"), F.lit(" cells are shown; totals cover all"))),
    )
    return with_notes(out.select(*totals.columns, *quartile, method.alias("quartile_method"), "buckets", F.filter(notes, lambda x: x.isNotNull()).alias("notes")))


def status_index(pages: DataFrame, daily: DataFrame) -> DataFrame:
    """dataset, records, entries, newest for each published dataset."""
    a = pages.agg(F.sum("n_awards").alias("records"), F.count("*").alias("entries"), F.max("fiscal_year").cast("string").alias("newest"))
    b = daily.where("axis = 'total'").agg(F.sum("n").alias("records"), F.count("*").alias("entries"), F.max("day").cast("string").alias("newest"))
    return a.withColumn("dataset", F.lit("awards")).unionByName(b.withColumn("dataset", F.lit("changes")))


def with_notes(df: DataFrame) -> DataFrame:
    """A published table with licence and caveat beside every row."""
    return df.withColumns({k: F.lit(v) for k, v in NOTES.items()})
