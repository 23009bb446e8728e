"""Source divergence against exact sums in Python, and on odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tallyline.llm import divergence

DATA = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, listed=50):
    """Rows of (text, lang, source)."""
    df, count, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        df.update((lang, t) for t in set(terms))
        count[lang, source].update(terms)
    out = set()
    for lang in {g for g, _ in groups}:
        kept = sorted(t for (g, t), n in df.items() if g == lang and n >= least)
        sources = sorted(s for g, s in groups if g == lang)
        share = {}
        for name in [None, *sources]:
            c = {t: sum(count[lang, s][t] for s in sources) if name is None else count[lang, name][t] for t in kept}
            n = sum(c.values()) + 5 * len(kept)
            share[name] = {t: 1 + 1_000_000_000 * (c[t] + 5) // n for t in kept}
        for s in sources:
            pairs = sorted((-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((share[None][t] - share[s][t], t.encode(), t) for t in kept if count[lang, s][t] and share[s][t] > share[None][t])
            out |= {(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)}
            out |= {(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms[:listed])}
    return out


def got(df, *rest):
    rows = [tuple(r) for r in divergence.audit(df, *rest).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_divergence_of_table(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    want = brute([(r.text, r.lang, r.source) for r in df.collect()])
    assert got(df) == want and len(want) > 2000


ODD = [(None, "en", "s"), ("", "en", "t"), ("The the THE cat", None, None), ("the cat's 9 lives", None, "s"), ("", None, "u"), ("  \x00 12 ", "xx", "s"), ("É é Straße ÉÉ", "fr", "a"), ("é straße", "fr", "b"),
       ("é straße", "fr", "b"), ("日本 語", "ja", "z"), ("w" * 50_000 + " " + "long text " * 20_000, "en", "s"), ("long", "en", "t")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 as term", "2 as part", "3 as block", "4 as n", "'x' as item")


def test_divergence_of_odd_rows(spark):
    for least in (1, 2):
        assert got(frame(spark, ODD), least) == brute(ODD, least)
    assert got(frame(spark, ODD)) == brute(ODD)
    assert got(frame(spark, ODD).where("false")) == set()


@pytest.mark.parametrize("small", [False, True])
def test_spills_blocks_and_ties(spark, monkeypatch, small):
    """Small tables, blocks and groups give the same; many terms tie."""
    draw = random.Random(4)
    rows = [(" ".join(f"t{chr(97 + draw.randint(0, 25))}{chr(97 + draw.randint(0, 3))}" for _ in range(draw.randint(0, 60))), draw.choice("ab"), f"s{draw.randint(0, 12)}") for _ in range(400)]
    if small:
        for name, value in (("MOST_TERMS", 20), ("MOST_COUNTS", 60), ("BLOCK", 4), ("TERMS", 16), ("AT_ONCE", 3)):
            monkeypatch.setattr(divergence, name, value)
    assert got(frame(spark, rows).repartition(5), 3, 7) == brute(rows, 3, 7)
