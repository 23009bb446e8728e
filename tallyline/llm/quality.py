"""Quality rules as a bitmask ledger: each rule is evaluated once, its failure is one bit, and policies are masks over the bits.

Measurements and bits are stored together, so a new version of a policy, or the effect of leaving a rule out, needs no second pass
over the texts. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Rules in the order of their bits. The first two are the base; they hold whatever the policy.
RULES = ["few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting", "few_letters", "repeated_lines_30"]
#: Versioned policies: the rules whose failure rejects a document. 3 is the first form of 2: it allows 30 % of repeated lines, not 60 %.
POLICIES = {
    1: ["few_words", "repeated_words"],
    2: ["few_words", "repeated_words", "symbols", "repeated_lines", "word_length", "shouting", "few_letters"],
    3: ["few_words", "repeated_words", "symbols", "repeated_lines_30", "word_length", "shouting", "few_letters"],
}
CURRENT = 2


def mask(rules: list[str]) -> int:
    """The bits of some rules."""
    return sum(1 << RULES.index(r) for r in set(rules))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first included.

    Windows are told apart by 64-bit hashes; sorted, equal ones stand side by side, and the sum over the places of repeated ones of
    min(3, distance to the next) counts each word once. A text without a repeated window ends after the first look.
    """
    windows = F.when(F.size(w) < 3, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    )

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            same = lambda x, j: F.get(p, j - 1)["h"].eqNullSafe(x["h"]) | F.get(p, j + 1)["h"].eqNullSafe(x["h"])
            return F.array_sort(F.transform(F.filter(p, same), lambda x: x["i"]))

        def covered(at: Column) -> Column:
            step = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
            return F.aggregate(step, F.lit(0), lambda a, b: a + b)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(_let(pairs, places), covered))

    return _let(windows, count)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed_bits`` for every row; a null text counts as empty; repeated rows stay.

    Reads doc_id and text only, whatever other columns are called.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select("doc_id", text.alias("text"))
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]+", ""))
    measured = rows.select(
        "doc_id",
        _let(
            words(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).cast("long").alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) > 1))).cast("long").alias("n_upper_words"),
            ),
        ).alias("m"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
        letters.cast("long").alias("n_letters"),
    ).select("doc_id", "m.*", "n_symbols", "n_dup_lines", "n_lines", "n_letters")
    n, chars = F.col("n_words"), F.col("word_chars")
    failed = {
        "few_words": n < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 100 * F.col("n_dup_lines") > 60 * F.col("n_lines"),
        "word_length": (chars < 2 * n) | (chars > 15 * n),
        "shouting": 2 * F.col("n_upper_words") > n,
        "few_letters": 2 * F.col("n_letters") < chars,
        "repeated_lines_30": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }
    bits = sum((F.when(failed[r], F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)), F.lit(0))
    return measured.withColumn("failed_bits", bits.cast("long"))


def apply_policy(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """``rows`` of a ledger with base_failed and kept under one version of the policy."""
    base = F.col("failed_bits").bitwiseAND(mask(RULES[:2])) != 0
    kept = F.col("failed_bits").bitwiseAND(mask([*RULES[:2], *POLICIES[version]])) == 0
    return rows.withColumn("base_failed", base).withColumn("kept", kept)


def ablation(rows: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, and documents that it alone rejects. One pass over distinct bit patterns."""
    full = mask(POLICIES[version])
    patterns = rows.groupBy(F.col("failed_bits").bitwiseAND(full).alias("bits")).count()
    out = [
        F.struct(
            F.lit(r).alias("rule"),
            F.sum(F.when(F.col("bits").bitwiseAND(mask([r])) != 0, F.col("count")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == mask([r]), F.col("count")).otherwise(0)).alias("n_only"),
        )
        for r in POLICIES[version]
    ]
    return patterns.agg(F.array(*out).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def rate(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept (current policy), failed_bits."""
    return apply_policy(ledger(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits"
    )


def oracle() -> str:
    """The same in DuckDB SQL, with windows as whole strings."""
    return r"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (
  select doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d
), g as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from w, unnest(range(1, len(w) - 1)) t(i)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from g) where n > 1
), covered as (
  select doc_id, count(distinct i + k) as n from twice, (values (0), (1), (2)) v(k) group by doc_id
), m as (
  select w.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
         len(list_filter(w, lambda x: x = upper(x) and x <> lower(x) and length(x) > 1)) as n_upper, len(lines) as n_lines,
         length(regexp_replace(text, '[^\p{L}]+', '', 'g')) as n_letters
  from w left join covered c using (doc_id)
), b as (
  select *, (n_words < 50)::bigint + 2 * (100 * n_repeat_words > 50 * n_words)::bigint + 4 * (10 * n_symbols > n_words)::bigint
            + 8 * (100 * n_dup_lines > 60 * n_lines)::bigint + 16 * (word_chars < 2 * n_words or word_chars > 15 * n_words)::bigint
            + 32 * (2 * n_upper > n_words)::bigint + 64 * (2 * n_letters < word_chars)::bigint
            + 128 * (100 * n_dup_lines > 30 * n_lines)::bigint as failed_bits
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 as base_failed,
       (failed_bits & 127) = 0 as kept, failed_bits from b"""
