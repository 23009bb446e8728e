"""Benchmark decontamination by a prefix-filtered set join: which words of documents lie in passages of benchmark items.

A window is ten consecutive words of an item, or all words of a shorter one. As a set of word shingles it lies in a document only if all
its shingles do, so a prefix of one shingle is necessary, and the best one is the rarest: shingles are ordered by how often the documents
hold them. Documents meet windows on that shingle alone; its place in both gives the only place where the window may begin, which
must lie within the document, and the words there are compared with the window's. Everything is DataFrame functions. Texts
are read once and are never shuffled: what leaves the scan is a row for each document and the places of shingles that the benchmark has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import cut, join_salted

#: Words of a window and of a shingle; a window of fewer words than a shingle is a shingle of its own.
WINDOW, SHINGLE = 10, 5
#: Cells of the bitmap by which other places are left out before a shuffle: as rows of 64 bits it is broadcast, and never larger than this.
CELLS = 1 << 22
#: Fixed value: what stands between words.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "".join(map(chr, range(65, 91)))
#: Characters, other than ASCII ones, that lower() may change.
_OTHER_UPPER = r"[^\x00-\x7F\p{Ll}\p{Lo}\p{Lm}\p{M}\p{P}\p{Sm}\p{Sc}\p{Zs}]"


def words(text: Column) -> Column:
    """Words of a text in order, with only A-Z in lower case; none for null."""
    text = F.coalesce(text, F.lit(""))
    exact = lambda w: F.when(w.rlike(_OTHER_UPPER), F.translate(w, _UPPER, _UPPER.lower())).otherwise(F.lower(w))
    split = F.when(text.rlike(_OTHER_UPPER), F.transform(F.split(text, GAP), exact)).otherwise(F.split(F.lower(text), GAP))
    return F.array_remove(split, "")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item, window (words, blank-joined), length: every window of every item with a word. A null item_id counts as an empty one."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    rows = rows.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))).alias("at"))
    rows = rows.select("item", F.slice("w", F.col("at"), F.lit(size)).alias("w"))
    return rows.select("item", F.array_join("w", " ").alias("window"), F.size("w").alias("length")).distinct()


def _hash(w: Column, at: Column, size: int) -> Column:
    """A name for the shingle of ``size`` words at a place (from 0)."""
    return F.xxhash64(*[F.get(w, at + k) for k in range(size)])


def shingles(each: DataFrame) -> DataFrame:
    """window, length, size, offset, shingle for each shingle of distinct windows."""
    rows = each.select("window", "length", F.split("window", " ").alias("w"), F.least("length", F.lit(SHINGLE)).alias("size"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size"))).alias("offset"))
    name = F.lit(None).cast("long")
    for k in range(1, SHINGLE + 1):
        name = F.when(F.col("size") == k, _hash(F.col("w"), F.col("offset"), k)).otherwise(name)
    return rows.select("window", "length", "size", "offset", name.alias("shingle"))


def places(docs: DataFrame, named: DataFrame, sizes: list[int], size: int = WINDOW) -> DataFrame:
    """A row with place -1 for each document (row, doc_id, n_words), and one for each place of a shingle that the bitmap of ``named`` lets pass.

    The latter also hold the words (``near``, from place ``start`` on) among which a window with that shingle must lie.
    """
    cell = lambda x: F.pmod(x, F.lit(CELLS))
    bits = named.select(cell(F.col("shingle")).alias("c")).distinct().groupBy(F.floor(F.col("c") / 64).alias("at"))
    bits = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(c % 64 as int))")).alias("bits"))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    rows = rows.select("*", F.size("w").alias("n_words")).select("*", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)).alias("place"))
    at = F.col("place")
    kinds = [F.when((at >= 0) & (at + k <= F.col("n_words")), F.struct(F.lit(k).alias("size"), _hash(F.col("w"), at, k).alias("shingle"))) for k in sizes]
    if len(kinds) == 1:
        rows = rows.withColumn("s", kinds[0])
    else:
        # the row of the document itself comes once, whatever the number of sizes
        some = F.when(at < 0, F.array(kinds[0])).otherwise(F.filter(F.array(*kinds), lambda s: s.isNotNull()))
        rows = rows.withColumn("s", F.explode(some))
    rows = rows.select("row", "doc_id", "n_words", "place", "w", F.col("s.size").alias("size"), F.col("s.shingle").alias("shingle"))
    rows = rows.join(F.broadcast(bits), F.floor(cell(F.col("shingle")) / 64) == F.col("at"), "left")
    rows = rows.where("place < 0 or shiftrightunsigned(bits, cast(pmod(shingle, 64) as int)) & 1 = 1")
    start = F.when(F.col("size") < SHINGLE, at).otherwise(F.greatest(at - (size - SHINGLE), F.lit(0)))
    reach = F.when(F.col("size") < SHINGLE, at + F.col("size")).otherwise(at + size)
    near = F.when(at >= 0, F.slice("w", start + 1, reach - start))
    return rows.select("row", F.when(at < 0, F.col("doc_id")).alias("doc_id"), "n_words", "place", "size", "shingle", F.when(at >= 0, start).alias("start"), near.alias("near"))


def occurrences(held: DataFrame, pieces: DataFrame) -> DataFrame:
    """row, begin, length, window: where windows occur. ``held`` are places, ``pieces`` the shingles of windows."""
    hits = held.where("place >= 0")
    often = hits.groupBy("size", "shingle").agg(F.count("*").alias("often"))
    ranked = pieces.join(often, ["size", "shingle"])  # a window with a shingle that no document has occurs in none
    whole = pieces.groupBy("window").agg(F.count("*").alias("of"))
    prefix = ranked.groupBy("window", "length").agg(F.count("*").alias("met"), F.min(F.struct("often", "shingle", "offset", "size")).alias("p"))
    prefix = prefix.join(whole, "window").where("met = of").select("window", "length", F.col("p.size").alias("size"), F.col("p.shingle").alias("shingle"), F.col("p.offset").alias("offset"))
    met = join_salted(hits, prefix, ["size", "shingle"], F.xxhash64("row", "place"))
    begin = F.col("place") - F.col("offset")
    met = met.where((begin >= 0) & (begin + F.col("length") <= F.col("n_words")))
    return met.where(F.array_join(F.slice("near", begin - F.col("start") + 1, F.col("length")), " ") == F.col("window")).select("row", begin.alias("begin"), "length", "window")


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (row, doc_id, n_words), where windows occur in them (row, begin, length, window), and windows of items (item, window, length)."""
    items = cut(windows(benchmark, size), "windows")
    pieces = cut(shingles(items.select("window", "length").distinct()), "shingles")
    sizes = sorted(r[0] for r in pieces.select("size").distinct().collect()) or [SHINGLE]  # five at most
    held = cut(places(docs, pieces, sizes, size), "places")
    return held.where("place < 0").select("row", "doc_id", "n_words"), cut(occurrences(held, pieces), "occurrences"), items


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    A word is hit once, however many windows it lies in. Null and empty texts have no words and are clean; repeated rows stay and are judged alike.
    Items without a word have no window; items of one id are one. Without items or without documents nothing is hit. Reads doc_id and text
    of documents, item_id and text of items, whatever other columns are called.
    """
    every, found, items = hits(docs, benchmark, size)
    # words that lie in a stretch count from where the stretches before it end
    reach = found.groupBy("row", "begin").agg((F.col("begin") + F.max("length")).alias("end"))
    before = F.max("end").over(Window.partitionBy("row").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1))
    reach = reach.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(before, F.lit(0)))))
    n_hit = reach.groupBy("row").agg(F.sum("new").alias("n_hit"))
    named = join_salted(found.select("row", "window").distinct(), items.select("item", "window"), ["window"], F.xxhash64("row"))
    named = named.select("row", "item").distinct().groupBy("row")
    named = named.agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ",").cast("binary"), 256).alias("items_sha256"))
    out = every.join(n_hit, "row", "left").join(named, "row", "left")
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def oracle(size: int = WINDOW) -> str:
    """The same in DuckDB SQL, by joining every stretch of a document's words with the windows of its length."""
    w = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{GAP}'), lambda x: x <> '')"
    return rf"""
with d as (select row_number() over () as r, doc_id, {w} as w from documents),
b as (select coalesce(item_id::varchar, '') as item, {w} as w from benchmark),
x as (select distinct item, array_to_string(w[i:i + {size} - 1], ' ') as g, least(len(w), {size}) as n from b, unnest(range(1, greatest(len(w) - {size}, 0) + 2)) t(i) where len(w) > 0),
n as (select distinct n from x),
s as (select r, i, n, array_to_string(w[i:i + n - 1], ' ') as g from d, n, unnest(range(1, len(w) - n + 2)) t(i) where len(w) >= n),
f as (select distinct r, i, s.n, s.g from s join (select distinct g, n from x) y on s.g = y.g and s.n = y.n),
h as (select r, count(distinct i + k) as n_hit from f, unnest(range(n)) t(k) group by 1),
m as (select r, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256 from (select distinct r, item from f join x using (g, n)) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated from d left join h using (r) left join m using (r)"""
