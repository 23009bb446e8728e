"""Source divergence audit by in-mapper stripes: how the sources of a language differ in what they write about.

Tasks fold whole documents into a hash table from a term to its stripe: the number of documents that hold it and its count in every source.
A table that is full is spilt as rows, one a language and term; rows of one key are merged in the order of a sort, a batch at a time, and
only stripes of terms that enough documents hold go on. A merged stripe gives the counts from which both kinds of divergence follow:
how far a source stands from each other one over all terms, and which terms it uses more than its language does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import cut, join_salted
from tallyline.llm.words import in_turn, indexed, steps

#: A term is kept in a language if at least this many of its documents hold it; terms that a source's report lists.
LEAST_DOCS, LISTED = 30, 50
#: Shares are in billionths, and each count is raised by this.
UNIT, RAISED = 1_000_000_000, 5
#: A task spills its table beyond so many counts, terms, or characters of terms.
MOST_COUNTS, MOST_TERMS, MOST_CHARS = 2_000_000, 400_000, 50_000_000
#: Sources of a block, and terms of a group, when sources are compared with each other; terms that are compared at a time.
BLOCK, TERMS, AT_ONCE = 256, 1_024, 1_024
STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"
_GROUPS = 1 << 20

#: What each byte of a text becomes: letters in lower case, bytes of other than ASCII characters as they are, all else a blank.
_AS = np.full(256, 0x20, np.uint8)
_AS[0x80:] = np.arange(0x80, 0x100)
_AS[0x61:0x7B] = _AS[0x41:0x5B] = np.arange(0x61, 0x7B)


def terms_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct terms of some texts (no nulls), the term of each place, and the texts' offsets: runs of A-Z, a-z and other than ASCII characters."""
    size = np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), np.int64)
    raw = np.frombuffer(b"".join(t.as_buffer() for t in texts.cast(pa.binary())), np.uint8)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(_AS[raw]))
    terms, codes, offsets = indexed(pc.ascii_split_whitespace(plain))
    if "" in terms:
        keep = codes != terms.index("")
        codes, offsets = codes[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]
    return terms, codes.astype(np.int64), offsets


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], *((np.add.reduceat(v[order], first) if len(keys) else v) for v in values)


class Stripes:
    """The hash table of a task: numbers of terms and of (lang, source), and counts by both."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.terms: dict[str, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.chars, self.size = 0, 0
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, langs: list[str], sources: list[str], texts: pa.Array) -> None:
        """Fold whole documents."""
        terms, codes, offsets = terms_of(texts)
        before, known = len(self.terms), self.terms
        number = np.array([known.setdefault(t, len(known)) for t in terms], np.int64)
        if len(known) > before:
            self.chars += sum(map(len, terms))
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)], np.int64)
        doc = np.repeat(np.arange(len(group)), np.diff(offsets))
        pairs, count = np.unique(doc * max(1, len(terms)) + codes, return_counts=True)  # a document's terms
        doc, code = np.divmod(pairs, max(1, len(terms)))
        self.held.append(_summed(number[code] * _GROUPS + group[doc], count.astype(np.int64), np.ones(len(pairs), np.int64)))
        self.size += len(self.held[-1][0])
        if self.size > MOST_COUNTS:
            self.held = [_summed(*(np.concatenate(x) for x in zip(*self.held, strict=True)))]
            self.size = len(self.held[0][0])

    def full(self) -> bool:
        return 4 * self.size > 3 * MOST_COUNTS or len(self.terms) > MOST_TERMS or self.chars > MOST_CHARS or 2 * len(self.groups) > _GROUPS

    def spilt(self) -> Iterator[pa.RecordBatch]:
        """The table as stripes, and an empty table."""
        if self.held:
            keys, count, docs = _summed(*(np.concatenate(x) for x in zip(*self.held, strict=True)))
            names = sorted({g[0] for g in self.groups})
            lang_of = np.array([names.index(g[0]) for g in self.groups], np.int64)
            term, group = np.divmod(keys, _GROUPS)
            order = np.lexsort((term, lang_of[group])) if len(keys) else np.empty(0, np.int64)
            term, group, count, docs = term[order], group[order], count[order], docs[order]
            lang = lang_of[group]
            first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])])) if len(term) else np.empty(0, np.int64)
            ends = np.append(first, len(term)).astype(np.int32)
            df = np.add.reduceat(docs, first) if len(first) else docs
            terms, langs, sources = pa.array(list(self.terms), pa.string()), pa.array(names, pa.string()), pa.array([g[1] for g in self.groups], pa.string())
            for k in range(0, len(first), 50_000):
                some, edges = first[k : k + 50_000], ends[k : k + 50_001]
                part = slice(edges[0], edges[-1])
                lists = [pa.ListArray.from_arrays(pa.array(edges - edges[0]), x) for x in (sources.take(pa.array(group[part])), pa.array(count[part]))]
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(lang[some])), terms.take(pa.array(term[some])), pa.array(df[k : k + 50_000]), *lists], ["lang", "term", "df", "sources", "counts"]
                )
        self.clear()


def stripes(docs: DataFrame) -> DataFrame:
    """lang, term, df, sources, counts: a task's stripes, several of one key from several tasks. Null text, lang or source count as empty."""

    @in_turn("divergence")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Stripes()
        for batch in batches:
            for part in steps(batch, 2):
                table.add(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2))
                if table.full():
                    yield from table.spilt()
        yield from table.spilt()

    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), "text").mapInArrow(run, STRIPE)


def _merge(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Stripes in order of their keys, those of one key as one."""
    lang, term = (rows.column(k).dictionary_encode().indices.to_numpy() for k in (0, 1))
    new = np.concatenate([[True], (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])])
    first, key = np.flatnonzero(new), np.cumsum(new) - 1
    names, codes, offsets = indexed(rows.column(3))
    at = rows.column(4).offsets.to_numpy()
    counts = rows.column(4).values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
    pairs, counts = _summed(np.repeat(key, np.diff(offsets)) * max(1, len(names)) + codes, counts)
    key, source = np.divmod(pairs, max(1, len(names)))
    ends = pa.array(np.searchsorted(key, np.arange(len(first) + 1)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(names, pa.string()).take(pa.array(source)), pa.array(counts))]
    heads = pa.array(first)
    df = pa.array(np.add.reduceat(rows.column(2).to_numpy(), first))
    return pa.RecordBatch.from_arrays([rows.column(0).take(heads), rows.column(1).take(heads), df, *lists], ["lang", "term", "df", "sources", "counts"])


def merged(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Stripes of all tasks as one for each language and term, of terms in at least ``least_docs`` documents of the language.

    Rows of one key stand together after the sort, which spills; a task holds one batch and one stripe that is not ended.
    """

    @in_turn("divergence")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: pa.RecordBatch | None = None

        def enough(part: pa.RecordBatch) -> pa.RecordBatch:
            return part.filter(pc.greater_equal(part.column(2), least_docs))

        for batch in batches:
            if not batch.num_rows:
                continue
            if open_ is not None:
                batch = pa.Table.from_batches([open_, batch.cast(open_.schema)]).combine_chunks().to_batches()[0]
            one = _merge(batch)
            yield enough(one.slice(0, one.num_rows - 1))
            open_ = pa.RecordBatch.from_arrays([x.take(pa.array([one.num_rows - 1])) for x in one.columns], schema=one.schema)
        if open_ is not None:
            yield enough(open_)

    return rows.repartition("lang", "term").sortWithinPartitions("term", "lang").mapInArrow(run, STRIPE)


def share(count: str, n: str, v: str):
    """1 + floor(UNIT * (count + RAISED) / (n + RAISED * v)), exact; null without kept terms."""
    return F.expr(f"cast(cast({UNIT} as decimal(10, 0)) * cast({count} + {RAISED} as decimal(20, 0)) div nullif(cast({n} + {RAISED} * {v} as decimal(20, 0)), 0) as bigint) + 1")


def compared(entries: pd.DataFrame, known: pd.DataFrame, low: int, high: int, first: bool) -> pd.DataFrame:
    """source, item, value: what the terms of a group add to the distance between sources of two blocks, in both directions.

    A source without a term has its least share there. So the sum over all terms is that between least shares, given once (``first``), and
    for terms that some source of the blocks has, how much they differ from it.
    """
    known = known.drop_duplicates("source").sort_values("source", ignore_index=True)
    least, names = known.base.to_numpy(), known.source.to_numpy()
    left, right = (np.flatnonzero(known.block.to_numpy() == b) for b in (low, high))
    total = np.zeros((len(left), len(right)), np.int64)
    apart = np.abs(least[left][:, None] - least[right][None, :])
    if len(entries):
        term, row = np.unique(entries.term.to_numpy(), return_inverse=True)
        column, p = np.searchsorted(names, entries.source.to_numpy()), entries.p.to_numpy()
        order = np.argsort(row, kind="stable")
        row, column, p = row[order], column[order], p[order]
        for k in range(0, len(term), AT_ONCE):
            a, b = np.searchsorted(row, [k, k + AT_ONCE])
            shares = np.repeat(least[None, :], min(AT_ONCE, len(term) - k), axis=0)
            shares[row[a:b] - k, column[a:b]] = p[a:b]
            theirs = shares[:, right]
            for i, s in enumerate(left):
                total[i] += np.abs(theirs - shares[:, s : s + 1]).sum(axis=0)
        total -= apart * len(term)
    if first and len(known):
        total += apart * int(known.v.iat[0])
    i, j = np.nonzero(left[:, None] != right[None, :])
    out = pd.DataFrame({"source": names[left[i]], "item": names[right[j]], "value": total[i, j]})
    return out if low == high else pd.concat([out, out.rename(columns={"source": "item", "item": "source"})], ignore_index=True)


def pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language.

    Sources are dealt into blocks of about BLOCK and terms into groups of about TERMS; each pair of blocks is compared for each group of terms.
    """
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    known = groups.join(sizes, "lang").select(
        "lang", "source", "v", F.coalesce(share("0", "n", "v"), F.lit(0)).alias("base"), "blocks", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    )
    known = cut(known, "sources")
    parts = F.floor(F.col("v") / TERMS).cast("int") + 1
    with_ = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with")).drop("blocks", "with")

    right = dealt(known.select("*", with_)).select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    placed = join_salted(entries, known.select("lang", "source", "blocks", "block"), ["lang", "source"], F.xxhash64("term"))
    left = dealt(placed.select("*", with_, F.pmod(F.xxhash64("term"), parts).cast("int").alias("part")))
    keys = ["lang", "low", "high", "part"]

    def each(key: tuple, some: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        out = compared(some, sources, key[1], key[2], key[3] == 0)
        out.insert(0, "lang", key[0])
        return out

    both = left.select(*keys, "term", "source", "p").groupBy(*keys).cogroup(right.select(*keys, "source", "v", "base", "block").groupBy(*keys))
    found = both.applyInPandas(each, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, listed: int = LISTED) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language its distance to each other one, and the terms it has more of.

    Null texts, languages and sources count as empty ones; an empty language or source is one like others. Repeated rows are documents of their own.
    Ties go to the item that comes first in UTF-8. A language without kept terms has distances of 0. Reads text, lang and source only.
    """
    kept = cut(merged(stripes(docs), least_docs), "stripes")
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    entries = kept.select("lang", "term", total.alias("total"), F.explode(F.arrays_zip("sources", "counts")).alias("s"))
    entries = entries.select("lang", "term", "total", F.col("s.sources").alias("source"), F.col("s.counts").alias("count"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum(total).alias("n_lang"))
    groups = every.join(entries.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = cut(groups.select("lang", "source", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "v", "n_lang"))), "groups")
    known = join_salted(entries, groups, ["lang", "source"], F.xxhash64("term"))
    known = known.select("lang", "source", "term", "v", share("count", "n", "v").alias("p"), share("total", "n_lang", "v").alias("q"))
    known = cut(known, "shares")
    by_pair = pairs(known.drop("q"), groups).withColumn("part", F.lit("pair"))
    by_term = known.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    by_term = by_term.withColumn("rank", rank).where(F.col("rank") <= listed).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return by_pair.withColumn("rank", rank).select(*columns).unionByName(by_term.select(*columns))


def oracle(least_docs: int = LEAST_DOCS, listed: int = LISTED) -> str:
    """The same in DuckDB SQL."""
    upper = "".join(map(chr, range(65, 91)))
    p = lambda count, n: f"1 + ({UNIT}::hugeint * ({count} + {RAISED})) // ({n} + {RAISED} * v.v)"
    return rf"""
with d as (select coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r from documents),
t as (select r, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term, count(*) as total from t group by 1, 2 having count(distinct r) >= {least_docs}),
v as (select lang, count(*) as v, sum(total) as n from k group by 1),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t join k using (lang, term) group by 1, 2, 3),
gn as (select g.lang, g.source, coalesce(sum(c.n), 0) as n from g left join c using (lang, source) group by 1, 2),
f as (
  select gn.lang, gn.source, k.term, coalesce(c.n, 0) as n, {p("coalesce(c.n, 0)", "gn.n")} as p, {p("k.total", "v.n")} as q
  from gn join k using (lang) join v using (lang) left join c on c.lang = gn.lang and c.source = gn.source and c.term = k.term
), s as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from f a join f b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by 1, 2, 3
), pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
  left join s on s.lang = a.lang and s.source = a.source and s.item = b.source
), term as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from f where n > 0 and p > q)
select *, (row_number() over (partition by lang, source order by value desc, item))::integer as rank from pair
union all select *, (row_number() over (partition by lang, source order by value desc, item))::integer as rank from term
qualify rank <= {listed}"""
