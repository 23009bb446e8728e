"""Running sums over a whole table without a single task that sees it: rows are dealt into ranges of their order, and each range begins with what precedes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.staging import staged

RANGE = "range_"


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` dealt by ranges of ``order`` and written so, with the number of each row's range; rows alike in the order share one."""
    return staged(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def within(*order: str):
    """The window of a range's rows up to and including a row."""
    return Window.partitionBy(RANGE).orderBy(*order)


def upto(*order: str):
    return within(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(df: DataFrame, **totals: Column) -> DataFrame:
    """For each range the aggregates ``totals`` put together over all earlier ranges: (range_, name...) with sums, or for ``last_...`` the last one there is.

    There are as many ranges as shuffle partitions at most, so their totals are one small row, however large the table is.
    """
    each = df.groupBy(RANGE).agg(*[c.alias(n) for n, c in totals.items()])
    rows = each.agg(F.array_sort(F.collect_list(F.struct(RANGE, *totals))).alias("all_"))

    def earlier(name: str, upto_: Column) -> Column:
        if name.startswith("last_"):
            there = F.filter("all_", lambda x: (x[RANGE] < upto_) & x[name].isNotNull())
            return F.try_element_at(F.transform(there, lambda x: x[name]), F.lit(-1))
        kind = each.schema[name].dataType
        return F.aggregate(F.filter("all_", lambda x: x[RANGE] < upto_), F.lit(0).cast(kind), lambda s, x: s + F.coalesce(x[name], F.lit(0).cast(kind)))

    out = rows.select("all_", F.explode("all_").alias("own_"))
    return out.select(F.col(f"own_.{RANGE}").alias(RANGE), *[earlier(n, F.col(f"own_.{RANGE}")).alias(n) for n in totals])
