"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets an exponential key divided by its quality weight; within a source, sorted by key, sizes are prefix-summed up to
the source's token budget. A source whose target exceeds its size first takes complete epochs, then the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import WORD_GAP, comparable, cut

#: Weights of the sources in order of their names, repeating; and how often a source's size its target may be.
WEIGHTS, MOST_EPOCHS = (1, 2, 3), 3
#: Rows to a range of the sampling key, about, if all rows were of one source; so no task sorts a whole source.
RANGE_ROWS = 4_000
SEED = 17


def size_in_words(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{WORD_GAP}|{WORD_GAP}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_GAP))).cast("long")


def quality_weight(text: Column) -> Column:
    """0.25 to 1: the share of a text that is neither symbols nor digits, of a null text 0.25."""
    plain = F.length(F.translate(text, "#*$%&|<>@{}[]\\^~0123456789", ""))
    return F.coalesce(0.25 + 0.75 * plain / F.greatest(F.length(text), F.lit(1)), F.lit(0.25))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target for a table of source and source_size (one row a source).

    Shares of the whole in proportion to weights, each stopped at MOST_EPOCHS times the source's size and the excess reshared by
    weight. Sources stop in order of size by weight, so the level at which no more stop is found by running sums, without a loop.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (position % len(WEIGHTS) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(MOST_EPOCHS)))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    # the level if all sources before this one stop: what is left, by the weight that is left
    left = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / weight_left).withColumn("stops", F.col("most") <= F.col("level") * F.col("weight"))
    final = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)  # from the first that does not stop, levels fall
    rows = rows.withColumn("final", final)
    return rows.select("source", "source_size", F.coalesce(F.least("most", F.col("final") * F.col("weight")), "most").alias("target"))


ROW = ["row_a", "row_b"]


def _named(rows: DataFrame, identity: list) -> DataFrame:
    """``rows`` with a 128-bit name of each row's ``identity``, shared by rows alike in it, and a draw by doc_id, text and source."""
    blanks = F.concat(*[F.isnull(c).cast("string") for c in identity])  # a null leaves a hash as it is
    names = {c: F.xxhash64(*identity, blanks, F.lit(seed)) for c, seed in zip(ROW, (SEED, SEED + 1), strict=True)}
    return rows.withColumns(names | {"draw": F.xxhash64("doc_id", "text", "source", F.lit(SEED + 2))})


def plan(docs: DataFrame) -> DataFrame:
    """Row names, doc_id, source, size, source_size, target, rows (alike), full (epochs of every one of them), more (how many get one more).

    ``docs`` has row names. Null texts have size 0 and are never short of their target; a null source is a source. Rows that are alike
    are counted first and then stand together. Texts are read once. Reruns agree.
    """
    rows = docs.select(*ROW, "draw", "doc_id", "source", size_in_words(F.col("text")).alias("size"), quality_weight(F.col("text")).alias("w"))
    u = (F.shiftrightunsigned("draw", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = rows.groupBy(*ROW, "doc_id", "source", "size", (-F.log(u) / F.col("w")).alias("key")).agg(F.count("*").alias("rows"))
    rows = cut(rows, "sizes")
    ranges = rows.count() // RANGE_ROWS + 1
    rows = rows.withColumn("range", F.floor((1 - F.exp(-F.col("key") / 2)) * ranges).cast("int")).withColumn("words", F.col("size") * F.col("rows"))
    sums = rows.groupBy("source", "range").agg(F.sum("words").alias("range_size"))
    ahead = F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("ahead", F.coalesce(ahead, F.lit(0)))
    sizes = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size"))).withColumnRenamed("source", "of")
    known = sums.join(sizes, F.col("source").eqNullSafe(F.col("of")))
    known = known.select(F.col("source").alias("s"), F.col("range").alias("r"), "ahead", "source_size", "target")
    within = Window.partitionBy("source", "range").orderBy("key", *ROW).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("words").over(within), F.lit(0)))
    joined = placed.join(known, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")), "left")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("long")
    rest = F.col("target") - full * F.col("source_size")
    # a row on the border is taken if that brings the source nearer to its target
    open_ = (rest > 0) & (full < MOST_EPOCHS)
    fits = F.floor((rest - F.col("ahead") - F.col("before")) / F.col("size") + 0.5)
    more = F.when(open_ & (F.col("size") > 0), F.greatest(F.lit(0), F.least(F.col("rows"), fits))).when(open_ & (F.col("ahead") + F.col("before") <= rest), F.col("rows")).otherwise(0)
    return joined.select(*ROW, "doc_id", "source", "size", "source_size", "target", "rows", full.alias("full"), more.cast("long").alias("more"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, epochs for every row. Reads doc_id, text and source only."""
    found = plan(_named(docs.select("doc_id", "text", "source"), ["doc_id", "text", "source"]))
    found = found.select("*", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("k"))
    epochs = F.col("full") + (F.col("k") <= F.col("more")).cast("long")
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * epochs).alias("taken"), epochs.alias("epochs"))


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, as they are, each as often as the plan takes it; of rows alike in all columns, as often as all of them.

    Columns may have any names and types; one that holds a map is alike in two rows if its JSON text is.
    """
    packed = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    named = _named(packed, comparable(docs, "row"))
    times = plan(named).select(*ROW, (F.col("full") * F.col("rows") + F.col("more")).alias("times")).where("times > 0")
    each = named.select(*ROW, "row").join(times, ROW).groupBy(*ROW).agg(F.first("times").alias("times"), F.first("row").alias("row"))
    return each.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")
