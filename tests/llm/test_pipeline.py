"""The pipeline: every stage against a plain version in Python, on documents and on odd rows among them."""

import base64
import hashlib
import os
import time
import tracemalloc
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_jaccard import brute

from tallyline.llm import common, langid, mixing, toxicity

DATA = "/root/testdata/sf0.001"
STEP = dict(corpus_pipeline.STAGES)
A, B = " ".join(f"the and thing{i}" for i in range(40)), " ".join(f"of that with{i}" for i in range(40))
ODD = [(9001, None, "en", "s", 1), (9002, "", "en", None, 2), (9003, " \n\t ", None, "s", 3), (9004, "12 34 !?", "en", "s", 4), (9005, A * 90, "en", "t", 5), (9006, A, "en", "s", 6),
       (9006, A, "en", "s", 6), (9006, B, "en", "s", 6), (None, A + " end", None, None, None), (None, None, None, None, None), (9007, "you idiot, you stupid worthless scum", "en", "s", 7),
       (9008, "zq" * 40, "en", "s", 8)]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents, odd rows, and columns named like results."""
    rows = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    return rows.select(*odd.columns).unionByName(odd).selectExpr("*", "1 as size", "2 as node", "3 as target", "4 as key", "'x' as draw", "5 as times_").cache()


def plain(df):
    return Counter(map(tuple, df.collect()))


def test_language(spark, docs):
    model = langid.train(docs, lose=corpus_pipeline.LOSE)
    verdict = {t: model.decided([t or ""])[0] for t in {r.text for r in docs.collect()}}
    want = Counter(tuple(r) for r in docs.collect() if verdict[r.text][0] != "und" and verdict[r.text][2] >= model.least)
    got = STEP["language ID"](spark, docs, DATA)
    assert got.columns == docs.columns and plain(got) == want
    assert sum(want.values()) > 150 and not {9001, 9002, 9003, 9004} & {r[0] for r in want}


def test_toxicity(spark, docs):
    model = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    want = Counter(tuple(r) for r in docs.collect() if not r.text or model.scores(pa.array([r.text]))[0] < toxicity.THRESHOLD)
    got = STEP["toxicity"](spark, docs, DATA)
    assert got.columns == docs.columns and plain(got) == want and {9001, 9002, 9003, 9006} <= {r[0] for r in want}


def test_near_duplicates(spark, docs):
    rows = docs.collect()
    texts = sorted({r.text for r in rows if (r.text or "").split()})
    group = brute(list(enumerate(texts)))[0]
    by_group = defaultdict(list)
    for r in rows:
        if (r.text or "").split():
            by_group[group[texts.index(r.text)][1]].append(r)
    got = STEP["n-gram Jaccard join"](spark, docs, DATA).collect()
    blank = lambda rs: Counter(map(tuple, (r for r in rs if not (r.text or "").split())))
    assert blank(got) == blank(rows) and len(got) == sum(blank(rows).values()) + len(by_group)
    kept = {group[texts.index(r.text)][1]: r for r in got if (r.text or "").split()}
    for g, members in by_group.items():
        ids = [r.doc_id for r in members if r.doc_id is not None]
        assert kept[g] in members and kept[g].doc_id == (min(ids) if ids else None)


def test_mixing(spark, docs):
    got = STEP["mixing"](spark, docs, DATA)
    assert got.columns == docs.columns and set(plain(got)) <= set(plain(docs))
    taken = Counter(r.doc_id for r in mixing.mix(docs).collect() for _ in range(r.epochs))
    found = Counter(r.doc_id for r in got.collect())
    assert not found - taken and not taken - found and max(taken.values()) == 9


def test_tokens(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda b: hashlib.sha256(b).hexdigest()
    ids = [(r.doc_id, r.text or "", enc.encode_ordinary(r.text or "")) for r in docs.collect()]
    want = Counter((d, len(i), digest(np.array(i, "<u4").tobytes()), digest(t.encode())) for d, t, i in ids)
    assert plain(STEP["byte-level BPE"](spark, docs, DATA).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == want


def test_run(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
    assert plain(corpus_pipeline.run(spark, DATA)) == plain(corpus_pipeline.STAGES[-1][1](spark, docs, DATA))


@pytest.mark.parametrize("name", list(STEP))
def test_empty(spark, docs, name):
    out = STEP[name](spark, docs.where(F.lit(False)), DATA)
    assert out.count() == 0 and (name == "byte-level BPE" or out.columns == docs.columns)


def test_near_duplicates_of_odd_ids(spark):
    """Repeated rows, null ids, and one id with two texts."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (2, a, "x"), (None, b, "x"), (None, b, "x"), (None, b + " end", "x"), (3, c, None), (4, c + " end", "x"), (4, d, "x"),
            (None, e, "x"), (5, e + " end", "x"), (6, None, "x"), (6, None, "x"), (7, "", "x"), (None, None, "x")]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), DATA).collect()
    got = sorted(map(tuple, out), key=str)
    assert len(got) == 9 and {r for r in got if r[0] != None or r[1] == None} == {(1, a, "x"), (3, c, None), (4, d, "x"), (5, e + " end", "x"), (6, None, "x"), (7, "", "x"), (None, None, "x")}  # noqa: E711
    assert len([r for r in got if r[0] is None and r[1]]) == 1 and [r for r in got if r[0] is None and r[1]][0][1].startswith(b)


INTERNAL = ["join_key", "row", "order", "row_a", "row_b", "draw", "key", "node", "component", "times", "stays", "salt_", "bits", "range", "k"]


@pytest.mark.parametrize("name", list(STEP)[:-1])
def test_columns_of_any_name_and_type(spark, docs, name):
    """Columns named like all internal ones, and struct, array and map columns, come out as they went in."""
    some = docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id < 60 or doc_id > 9000 or doc_id is null")
    odd = [*[f"concat('x', cast(doc_id as string)) as {c}" for c in INTERNAL], "struct(doc_id as a, map('k', lang) as m) as s", "array(n_chars) as arr", "map(source, doc_id) as mp"]
    rows = some.withColumn("source", F.coalesce("source", F.lit("none"))).selectExpr("*", *odd)
    out = STEP[name](spark, rows, DATA)
    assert out.schema.simpleString() == rows.schema.simpleString()
    text = lambda df: Counter(r[0] for r in df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})).collect())
    came, went = text(rows), text(out)
    assert set(went) <= set(came) and sum(went.values()) > 20 and (name == "mixing" or not went - came)


def test_tables_in_between_go(spark, docs, tmp_path, monkeypatch):
    """What a stage writes for itself is deleted; what its result is read from stays until that is read."""
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    left = lambda: sorted(p.name.split("-")[0] for p in tmp_path.iterdir())
    out = STEP["n-gram Jaccard join"](spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), DATA)
    assert left() == ["leaving"] and out.count() > 100
    corpus_pipeline.run(spark, DATA).collect()
    assert left() == ["leaving", "mixing"]


@pytest.mark.parametrize("what", [toxicity, langid])
def test_models_are_fitted_in_a_task(spark, docs, what, monkeypatch):
    """The driver holds neither the texts nor what a fit needs beside them."""
    labels, fit, driver = spark.read.parquet(f"{DATA}/labels.parquet"), what.fit, os.getpid()

    def elsewhere(*args, **kw):
        assert os.getpid() != driver
        return fit(*args, **kw)

    train = lambda d, n: toxicity.train(d, labels, n) if what is toxicity else langid.train(d, n)
    want = train(docs, 20)
    monkeypatch.setattr(what, "fit", elsewhere)
    got = train(docs, 20)
    texts = pa.array([A, B, "you idiot, you stupid worthless scum"])
    assert got.scores(texts) == want.scores(texts) if what is toxicity else got.decided(texts.to_pylist()) == want.decided(texts.to_pylist())


def test_toxicity_takes_little_memory():
    """Training and scoring hold subwords of some words at a time; peaks in MB."""
    some = [" ".join(f"word{i}x{k}" for k in range(1500)) for i in range(40)]
    peaks = []
    for run in (lambda: toxicity.fit(some, [i % 2 for i in range(40)], epochs=1), lambda: toxicity.Model(np.zeros(toxicity.BUCKETS), 0.0).scores(pa.array(some))):
        tracemalloc.start()
        run()
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
    assert peaks[0] < 100 and peaks[1] < 80, peaks  # 131 and 126 with subwords of 50,000 words at a time


def test_a_cut_leaves_no_shuffle_files(spark):
    """They went only once the driver's garbage was collected; the setting by which they go is put back."""
    files = lambda: {x for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before, setting = files(), spark.conf.get(common.TIDY)
    back = common.cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if left := files() - before:
            time.sleep(0.1)
    assert not left and spark.conf.get(common.TIDY) == setting and back.count() == 7
    common.discard(back)
