"""Report figures over published cells and daily counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.scalars import log_decade, round_half_up
from tallyline.operators import ranges
from tallyline.operators.awards import sector_year, with_quantiles


def share(n: Column, places: int = 4, by: list[str] | None = None) -> Column:
    """A value's share of the sum over its partition."""
    return F.bround(n / F.sum(n).over(Window.partitionBy(*(by or []))), places)


def sector_year_matrix(pages: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """sector, fiscal_year, n_awards with row, column and grand totals (null stands for all), in an optional window of years."""
    rows = pages
    if low is not None:
        rows = rows.where(F.col("fiscal_year") >= low)
    if high is not None:
        rows = rows.where(F.col("fiscal_year") <= high)
    return rows.cube("sector", "fiscal_year").agg(F.sum("n_awards").alias("n_awards"))


def awards_by_year(pages: DataFrame, years: DataFrame, sector: str | None = None) -> DataFrame:
    """Awards of every year of ``years``, zero where there are none."""
    rows = pages if sector is None else pages.where(F.col("sector") == sector)
    counts = rows.groupBy("fiscal_year").agg(F.sum("n_awards").alias("n"))
    return years.join(counts, "fiscal_year", "left").select("fiscal_year", F.coalesce("n", F.lit(0)).alias("n_awards"))


def awards_by_sector(pages: DataFrame, year: int | None = None) -> DataFrame:
    """Awards and share of every sector with any."""
    rows = pages if year is None else pages.where(F.col("fiscal_year") == year)
    counts = rows.groupBy("sector").agg(F.sum("n_awards").alias("n_awards")).where("n_awards > 0")
    return counts.withColumn("share", share(F.col("n_awards")))


def median_by_sector(exact: DataFrame, year: int) -> DataFrame:
    return exact.where(F.col("fiscal_year") == year).select("sector", "amount_median_jpy")


def awards_by_prefecture(cells: DataFrame, k: int = 10) -> DataFrame:
    """The k prefectures with most awards and their shares of all awards; ties by name."""
    counts = cells.groupBy("prefecture").agg(F.sum("n_awards").alias("n_awards")).withColumn("share", share(F.col("n_awards")))
    return counts.orderBy(F.desc("n_awards"), "prefecture").limit(k)


def growth(pages: DataFrame, base: int, last: int) -> DataFrame:
    """Per sector: awards of two years and their ratio to two places (null without awards in the base year)."""
    n = lambda y: F.coalesce(F.sum(F.when(F.col("fiscal_year") == y, F.col("n_awards"))), F.lit(0))
    out = pages.groupBy("sector").agg(n(base).alias("n_base"), n(last).alias("n_last"))
    return out.withColumn("growth", F.when(F.col("n_base") > 0, F.bround(F.col("n_last") / F.col("n_base"), 2)))


def count_vs_amount_share(pages: DataFrame) -> DataFrame:
    """Per sector: its share of awards beside its share of amounts."""
    sums = pages.groupBy("sector").agg(F.sum("n_awards").alias("n"), F.sum("amount_sum_jpy").alias("a"))
    return sums.select("sector", share(F.col("n")).alias("award_share"), share(F.col("a")).alias("amount_share"))


def month_shares(awards: DataFrame) -> DataFrame:
    """Per sector and month of award: awards and share of the sector's awards."""
    counts = awards.groupBy("sector", F.month("award_date").alias("month")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", share(F.col("n"), by=["sector"]))


def sextile_class(df: DataFrame, col: str) -> DataFrame:
    """class 1 to 6 by five cut values (at ranks n*k/6), 0 for null: 1 and the number of cuts at or below the value.

    Equal values share a class, which ntile would not grant. Values are counted first; their counts are summed by ranges of the value, so
    no task orders all of them. The cuts are one row.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("times"))
    counts = ranges.ranged(counts, "v")
    ahead = ranges.before(counts, ahead=F.sum("times"))
    ranked = counts.join(F.broadcast(ahead), ranges.RANGE).withColumn("upto", F.col("ahead") + F.sum("times").over(ranges.upto("v")))
    ranked = ranked.join(F.broadcast(counts.agg(F.sum("times").alias("n"))))
    at = [F.least(F.col("n") - 1, F.floor(F.col("n") * k / 6)) for k in range(1, 6)]
    cuts = ranked.agg(F.array(*[F.min(F.when(F.col("upto") > a, F.col("v"))) for a in at]).alias("cuts"))
    value = F.col(col)
    cls = F.when(value.isNull(), 0).otherwise(F.size(F.filter("cuts", lambda c: c <= value)) + 1)
    return df.join(F.broadcast(cuts)).withColumn("class", cls).drop("cuts")


def rank_cells(df: DataFrame, group: list[str]) -> DataFrame:
    """Place of each cell in its page: most awards first, blank codes last among equals."""
    order = [F.desc("n_awards"), F.coalesce(F.nullif("prefecture_code", F.lit("")), F.lit("zz"))]
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def top_k(df: DataFrame, col: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest values, ties by a key."""
    return df.orderBy(F.desc(col), F.asc(tie)).limit(k)


def limited(df: DataFrame, order: list, n: int = 25, most: int = 200) -> DataFrame:
    """The first rows (0 to ``most``) in an order, each with n_matched and whether there were more."""
    n = max(0, min(most, n))
    total = df.agg(F.count("*").alias("n_matched"))
    return df.orderBy(*order).limit(n).join(F.broadcast(total)).withColumn("truncated", F.col("n_matched") > n)


def stats_index(pages: DataFrame, exact: DataFrame) -> DataFrame:
    """One row per sector and year: counts, sum, median, whether the median is estimated."""
    e = exact.select("fiscal_year", "sector", "amount_median_jpy")
    joined = pages.join(e, ["fiscal_year", "sector"], "left")
    return joined.select("sector", "fiscal_year", "n_awards", "amount_sum_jpy", "amount_median_jpy", F.col("amount_median_jpy").isNull().alias("estimated"))


def page_rows(published: DataFrame, exact: DataFrame, estimated: DataFrame, sector: str, year: int) -> DataFrame:
    """The page of one sector and year: a row of its totals (place 0), then its cells in the order of the page, each with its place and share.

    The total row has the awards held back beside those in the table, the mean (half up) and quartiles, exact ones where ``exact`` has them
    (quantiles_exact). Cells' quartiles are their own. A page that does not exist has no rows; a blank code is null.
    """
    here = (F.col("sector") == sector) & (F.col("fiscal_year") == year)
    cells = rank_cells(published.where(here), ["fiscal_year", "sector"])
    total = with_quantiles(sector_year(published.where(here)), exact.where(here), estimated.where(here))
    quartiles = ["amount_q1_jpy", "amount_median_jpy", "amount_q3_jpy"]
    counts = published.where(here).groupBy("fiscal_year", "sector").agg(F.sum("n_corporate").alias("n_corporate"), F.sum("n_masked_individual").alias("n_masked_individual"))
    total = total.join(counts, ["fiscal_year", "sector"])
    mean = lambda n: round_half_up(F.col("amount_sum_jpy") / F.col(n)).alias("amount_mean_jpy")
    both = ["n_corporate", "n_masked_individual", "amount_min_jpy", *quartiles, "amount_max_jpy", "amount_sum_jpy"]
    head = total.select(
        F.lit(0).alias("place"), F.lit(None).cast("string").alias("prefecture"), F.lit(None).cast("string").alias("prefecture_code"), "n_awards", "n_held_back", "n_cells", *both,
        mean("n_awards_in_table"), F.lit(1.0).alias("share"), "quantiles_exact",
    )
    all_ = F.sum("n_awards").over(Window.partitionBy("fiscal_year", "sector"))
    rows = cells.select(
        "place", "prefecture", F.nullif("prefecture_code", F.lit("")).alias("prefecture_code"), "n_awards", F.lit(None).cast("long").alias("n_held_back"), F.lit(None).cast("long").alias("n_cells"),
        *both, mean("n_awards"), F.bround(F.col("n_awards") / all_, 4).alias("share"), F.lit(True).alias("quantiles_exact"),
    )
    return head.unionByName(rows)


def five_number_decades(pages: DataFrame) -> DataFrame:
    """The decades between which a page's five-number summary is drawn."""
    low = log_decade(F.col("amount_min_jpy"))
    high = F.ceil(F.log10(F.greatest(F.col("amount_max_jpy"), F.lit(1)).cast("double"))).cast("int")
    return pages.select("sector", "fiscal_year", low.alias("low_decade"), high.alias("high_decade"))
