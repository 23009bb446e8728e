"""Pooled quantiles from five-number summaries, by a sweep over the breakpoints of the mixture's distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators import ranges

NAMES = ["amount_min_jpy", "amount_q1_jpy", "amount_median_jpy", "amount_q3_jpy", "amount_max_jpy"]


def _rise() -> Column:
    """What the distribution rises by from the breakpoint before."""
    return F.coalesce((F.col("x") - F.col("x0")) * F.greatest("s0", F.lit(0.0)), F.lit(0.0))


def _over_ranges(keyed: DataFrame) -> DataFrame:
    """Breakpoints (x, slope, jump) of one distribution with x0, s0, rise and after: sums within ranges of x, on top of those of earlier ranges."""
    rows = ranges.ranged(keyed, "x")
    w, running = ranges.within("x"), ranges.upto("x")
    ahead = ranges.before(rows, s_ahead=F.sum("slope"), last_x=F.max("x"))
    rows = rows.join(F.broadcast(ahead), ranges.RANGE)  # a row a range
    rows = rows.withColumn("s", F.sum("slope").over(running) + F.col("s_ahead"))
    rows = rows.withColumn("x0", F.coalesce(F.lag("x").over(w), "last_x")).withColumn("s0", F.coalesce(F.lag("s").over(w), "s_ahead"))
    rows = rows.withColumn("rise", _rise())
    risen = ranges.before(rows, a_ahead=F.sum(F.col("rise") + F.col("jump")))
    rows = rows.join(F.broadcast(risen), ranges.RANGE)
    return rows.withColumn("after", F.sum(F.col("rise") + F.col("jump")).over(running) + F.col("a_ahead"))


def pooled_quantile(stats: DataFrame, group: list[str], ps: tuple[float, ...] = (0.25, 0.5, 0.75), weight: str = "n_awards") -> DataFrame:
    """``group``, n_cells and one pooled quantile (double) for each p, as q25, q50, ...

    Each cell spreads a quarter of its weight evenly over each of its four segments; a segment of no width is a jump. The sum of
    slopes is piecewise constant between breakpoints, so running sums give the distribution at each, and a quantile lies in the
    first stretch that reaches its share. A group of one cell so gets its own summary back. Cells without amounts take no part.

    Without ``group`` all cells are one: breakpoints are then dealt into ranges, and running sums go on from range to range.
    """
    cells = stats.where(F.col(NAMES[0]).isNotNull() & (F.col(weight) > 0))
    quarter = F.col(weight) * F.lit(0.25)
    events = []
    for low, high in zip(NAMES[:-1], NAMES[1:], strict=True):
        a, b = F.col(low).cast("double"), F.col(high).cast("double")
        slope = F.when(b > a, quarter / (b - a)).otherwise(0.0)
        jump = F.when(b > a, 0.0).otherwise(quarter)
        events += [F.struct(a.alias("x"), slope.alias("slope"), jump.alias("jump")), F.struct(b.alias("x"), (-slope).alias("slope"), F.lit(0.0).alias("jump"))]
    keyed = cells.select(*group, F.explode(F.array(*events)).alias("e")).groupBy(*group, "e.x").agg(F.sum("e.slope").alias("slope"), F.sum("e.jump").alias("jump"))
    total = cells.groupBy(*group).agg(F.sum(weight).cast("double").alias("w"), F.count("*").alias("n_cells"))
    if group:
        w = Window.partitionBy(*group).orderBy("x")
        running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = keyed.withColumn("s", F.sum("slope").over(running)).withColumn("x0", F.lag("x").over(w)).withColumn("s0", F.lag("s").over(w))
        rows = rows.withColumn("rise", _rise()).withColumn("after", F.sum(F.col("rise") + F.col("jump")).over(running))
        rows = rows.join(total, group)
    else:
        rows = _over_ranges(keyed).join(F.broadcast(total))
    rows = rows.withColumn("before", F.col("after") - F.col("jump"))
    out = []
    for p in ps:
        share = F.col("w") * p
        near = share * F.lit(1e-9)
        within = F.col("x0") + (F.col("x") - F.col("x0")) * (share - (F.col("before") - F.col("rise"))) / F.col("rise")
        value = F.when((F.col("before") >= share - near) & (F.col("rise") > 0), F.least(within, F.col("x"))).otherwise(F.col("x"))
        out.append(F.min_by(value, F.when(F.col("after") >= share - near, F.col("x"))).alias(f"q{round(p * 100)}"))
    return rows.groupBy(*group).agg(F.max("n_cells").alias("n_cells"), *out)
