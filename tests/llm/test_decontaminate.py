"""Decontamination against a plain search for every window, and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyline.llm import decontaminate

DATA = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(len(w) - 10, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if item is None else str(item))
    out = Counter()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        out[doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    return out


def scanned(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as place", "'x' as w", "3 as n_words", "4 as bits")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' as item", "5 as window")
    return Counter(map(tuple, decontaminate.scan(d, b).collect()))


def test_decontamination_of_tables(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert Counter(map(tuple, decontaminate.scan(docs, items).collect())) == want
    assert sum(n for k, n in want.items() if k[-1]) > 3


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Four SCORE and, seven years!"), (3, "one"), (4, None), (5, " .,; "), (6, LONG + " tail end"), (None, "no id at all here"), (2, "also item two has this text in it yes it has"),
         (7, "a b a b a b a b a b a b a b"), (8, "ÉTÉ été Straße ǅ"), (9, "x y")]
DOCS = [(1, None), (2, ""), (3, "...\n"), (4, "before " + LONG + " after"), (5, LONG.upper()), (6, " ".join(LONG.split()[3:12])), (7, " ".join(LONG.split()[3:13])), (8, "four score and seven years"),
        (8, "four score and seven years"), (8, "one"), (None, "there is no id at all here"), (9, "x one y"), (10, "a b " * 40), (11, "filler " * 5000 + LONG + " filler" * 5000), (12, "Été Été straße ǅ ÉTÉ été Straße ǅ"),
        (13, "b a b a b a b a b a"), (14, "x" * 100_000 + " y"), (15, "x\x00y"), (16, LONG.replace("w7", "w8"))]


def test_decontamination_of_odd_rows(spark):
    assert scanned(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)
    assert scanned(spark, DOCS, ITEMS[:1]) == brute(DOCS, ITEMS[:1])
    assert scanned(spark, DOCS, [(4, None)]) == brute(DOCS, []) and not scanned(spark, DOCS[:0] or [(1, None)], ITEMS)[None]


@pytest.mark.parametrize("seed", range(3))
def test_decontamination_of_random_words(spark, seed):
    """Few different words, so that windows, shingles and their places repeat."""
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    docs = [(i, text(draw.randint(0, 60))) for i in range(150)]
    items = [(i, text(draw.randint(0, 14))) for i in range(25)]
    assert scanned(spark, docs, items) == brute(docs, items)


def test_lower_case_is_that_of_ascii_only(spark):
    """No character that lower() changes is missed by the pattern that picks the words to spell out."""
    rows = spark.range(0x110000).where("id not between 55296 and 57343 and id > 0").select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    changed = rows.where((F.lower("c") != F.col("c")) & ~F.col("c").rlike("[A-Z]"))
    assert changed.count() > 1000 and changed.where(~F.col("c").rlike(decontaminate._OTHER_UPPER)).count() == 0


def test_empty_tables_and_sql(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    assert decontaminate.scan(docs.where("false"), items).count() == 0
    assert decontaminate.scan(docs, items.where("false")).where("contaminated or n_hit > 0 or n_items > 0").count() == 0
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.execute("create table benchmark(item_id bigint, text varchar)")
    plain = [(d, t) for d, t in DOCS if "\x00" not in (t or "")]
    con.executemany("insert into documents values (?, ?)", plain)
    con.executemany("insert into benchmark values (?, ?)", ITEMS)
    q = con.execute(decontaminate.oracle())
    assert Counter(q.fetchall()) == brute(plain, ITEMS)
