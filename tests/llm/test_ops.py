"""The other training-data operators against brute-force versions, the libraries, SQL or held-out labels; and on odd rows."""

import base64
import glob
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import bpe, langid, licenses, mixing, queries, quality, sharding, token_files, topk, toxicity
from tallyline.llm.common import fold

DATA = "/root/testdata/sf0.01"
RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
LONG = "word-" * 9_000 + " " + "long text, " * 9_000
ODD = [(1, None, "en", "s", 1), (2, "", "en", None, 2), (3, " \n\t ", None, "s", 3), (4, "12 34 !?", "en", "s", 4), (5, LONG, "de", "t", 5), (6, "same text", "en", "s", 6),
       (6, "same text", "en", "s", 6), (None, "no id", None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, score long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeats, and columns named like results."""
    return spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 as size", "2 as slot", "3 as n_words", "4 as node", "5 as target", "'x' as part")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(spark, docs, odd):
    enc = library()
    for df in (docs, odd):
        want = sorted((-1 if r.doc_id is None else r.doc_id, len(ids := enc.encode_ordinary(r.text or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((r.text or "").encode()).hexdigest()) for r in df.select("doc_id", "text").collect())
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, RANKS).collect())
        assert got == want
    assert bpe.round_trip(docs.where("false"), RANKS).count() == 0
    assert bpe.encode_ids(docs.where("doc_id = 0"), RANKS).first().ids == enc.encode_ordinary(docs.where("doc_id = 0").first().text)


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b\n\n c", "it's we'LL", "a" * 700, "x\x1c\x85y　z", "日本語🎉 é́", " \n x ", "9 99 999,9"])
def test_bpe_of_odd_texts(text):
    own = bpe.loaded(RANKS, P.PATTERN)
    ids, at = own.encode_batch(pa.array([text, "x " + text]))
    enc = library()
    assert ids[at[0] : at[1]].tolist() == enc.encode_ordinary(text) and ids[at[1] : at[2]].tolist() == enc.encode_ordinary("x " + text)
    assert own.decode(ids[at[0] : at[1]].tobytes()) == text.encode()


SPECIAL = ["a <|endoftext|> b", "A <|ENDOFTEXT|> É<|EndOfText|>é <|startoftext|>", "don't we'LL it's 'S ''s x's't 5's", "Éa é naïve— ,—x ÷a×b ñ! «hola» é́,", "日本語 テスト。「a」 ａｂｃ １２３",
           "12.5% of 2024's a_b-c___--d #$%^&*()<|x|>", "x\x1c\x85y　z q a‍b c­b", "w" * 200 + " é" * 3 + "long'" * 40]


def test_token_files(spark, docs, odd, tmp_path):
    """Against the untouched library, in the order of the files; also with added tokens in texts and one doc_id with many texts."""
    tok = Tokenizer.from_file(WORDS)
    some = spark.createDataFrame([(i // 3, t) for i, t in enumerate(SPECIAL)] + [(1, t[::-1]) for t in SPECIAL], "doc_id long, text string")
    for df in (docs, odd, some):
        want = Counter()
        for r in df.collect():
            ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
            want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        out = str(tmp_path / f"tokens{len(want)}")
        token_files.write_token_files(df, out, WORDS, files=5)
        held, key = [], lambda r: -1 if r.doc_id is None else r.doc_id
        for path in sorted(glob.glob(f"{out}/*.orc")):
            rows = spark.read.orc(path).orderBy("place").collect()
            assert [key(r) for r in rows] == sorted(map(key, rows)) and (not held or not rows or key(held[-1]) <= key(rows[0]))
            held += rows
        start, by_file = 0, []
        for r in held:
            by_file.append((r.doc_id, start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())))
            start += len(r.ids)
        assert Counter((d, n, c) for d, _, n, c in by_file) == want
        assert sorted(map(tuple, token_files.digest(token_files.read_token_files(spark, out)).collect()), key=lambda r: r[1]) == by_file
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.round_trip(df, WORDS).collect()) == want
    out = str(tmp_path / "orc")
    token_files.write_token_files(docs, out, WORDS)
    assert [r.doc_id for r in token_files.read_token_files(spark, out, [7, 900]).orderBy("doc_id").collect()] == [7, 900]
    orc, conf = spark._jvm.org.apache.orc.OrcFile, spark.sparkContext._jsc.hadoopConfiguration()
    for path in glob.glob(f"{out}/*.orc"):
        reader = orc.createReader(spark._jvm.org.apache.hadoop.fs.Path(path), orc.readerOptions(conf))
        for stripe in reader.getStripes():
            kinds = [(x.getColumn(), x.getKind().toString()) for x in reader.rows().readStripeFooter(stripe).getStreamsList()]
            assert (1, "BLOOM_FILTER_UTF8") in kinds and {c for c, k in kinds if k == "ROW_INDEX"} >= {1, 2}
        assert reader.getRowIndexStride() == 1000
    assert token_files.round_trip(docs.where("false"), WORDS).count() == 0


def test_token_table_forgets(monkeypatch):
    """A small table of known units gives the same ids."""
    monkeypatch.setattr(token_files, "CACHE", 20)
    own, tok = token_files.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    texts = [" ".join(f"word{i % 37} Other{i % 11}, {i}" for i in range(k, k + 30)) for k in range(0, 300, 30)] + ["", "the <|endoftext|>"]
    for t in texts + texts:
        ids, at = own.encode_batch(pa.array([t, "the end"]))
        assert ids[: at[1]].tolist() == tok.encode(t, add_special_tokens=False).ids and ids[at[1] :].tolist() == tok.encode("the end").ids
    assert own.encode_batch(pa.array([], pa.string()))[1].tolist() == [0]


def test_top_k(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.integers(-3, 4, 5) / 64]) for i in range(130)]
    bad = [(200, None), (220, [None, 1.0]), (240, [math.nan]), (260, [math.inf, 0.0]), (None, [1.0])]
    df = spark.createDataFrame([*vectors, *bad, vectors[20]], "vec_id long, embedding array<float>").selectExpr("*", "0 as score", "1 as rank")
    got = defaultdict(list)
    for r in topk.every_twentieth(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ints = {i: np.array([math.floor(64 * x) for x in v]) for i, v in vectors}
    for q in range(0, 130, 20):
        best = sorted((-int(ints[q] @ v), i) for i, v in [*ints.items(), (20, ints[20])] if i != q)[:20]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert set(got) == set(range(0, 130, 20))
    few = topk.every_twentieth(df.where("vec_id < 5")).collect()
    assert len(few) == 4 and topk.every_twentieth(df.where("false")).count() == 0


def test_top_k_over_blocks(spark, monkeypatch):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    want = {tuple(r) for r in topk.every_twentieth(df).collect()}
    monkeypatch.setattr(topk, "CANDIDATES", 100)
    monkeypatch.setattr(topk, "QUERIES", 7)
    assert {tuple(r) for r in topk.every_twentieth(df).collect()} == want


def test_top_k_of_large_scores():
    """Scores near 2^60 against Python integers, with ties, a query among the candidates and repeated rows."""
    rng = np.random.default_rng(12)
    c = rng.integers(-(2**28), 2**28, (3000, 3)) * 2
    c[100:140] = c[7]
    ids = np.concatenate([np.arange(2990), [5] * 10])
    q = np.array([[2**29, -(2**29), 2**28], c[7], c[0]])
    own = [10**6, 7, 0]
    got = topk.block_top(pd.DataFrame({"vec_id": own, "terms": list(q)}), pd.DataFrame({"vec_id": ids, "terms": list(c)}), 20)
    for name, vector in zip(own, q.tolist(), strict=True):
        best = sorted((-sum(a * b for a, b in zip(vector, row, strict=True)), i) for i, row in zip(ids.tolist(), c.tolist(), strict=True) if i != name)[:20]
        mine = got[got.query_id == name]
        assert list(zip((-mine.score).tolist(), mine.vec_id.tolist(), strict=True)) == best
    assert got.score.max() > 2**57


def test_sharding_table():
    names, slots = [f"s{i}" for i in range(5)], 101
    table = sharding.fill(names, slots)
    num = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    want, turn = {}, 0
    while len(want) < slots:
        s = names[turn % 5]
        order = [(num(f"{s}/offset") + j * (num(f"{s}/skip") % (slots - 1) + 1)) % slots for j in range(slots)]
        want[next(x for x in order if x not in want)] = turn % 5
        turn += 1
    assert table == [want[i] for i in range(slots)]
    assert max(table.count(i) for i in range(5)) - min(table.count(i) for i in range(5)) <= 1
    fewer = sharding.fill(names[:4], slots)
    assert sum(a != b for a, b in zip(table, fewer, strict=True)) < 0.45 * slots
    with pytest.raises(ValueError, match="prime"):
        sharding.fill(names, 100)


def test_sharding_rows(spark, odd, tmp_path):
    placed = sharding.place(odd)
    assert placed.count() == len(ODD) and placed.where("shard is null").isEmpty()
    assert placed.where("doc_id = 6").select("shard").distinct().count() == 1
    sharding.write_shards(odd, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(ODD)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in queries.QUERIES[name](spark, DATA).select(*names).collect())


def test_quality_of_odd_rows(spark, odd):
    rows = {r.doc_id: r for r in quality.rate(odd).collect()}
    assert rows[1].n_words == rows[2].n_words == rows[3].n_words == 0 and rows[1].base_failed and not rows[1].kept
    assert rows[5].n_words == 18_001 and rows[5].n_repeat_words == 18_000 and rows[5].base_failed
    texts = ["a b c a b c", "a b c d e a b c", "x x x x", "a b", "a b c\na b c\n\na b c", "p q r s p q r s t u p q"]
    for text, r in zip(texts, quality.ledger(spark.createDataFrame(enumerate(texts), "doc_id long, text string")).orderBy("doc_id").collect(), strict=True):
        w = text.split()
        spans = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        covered = {i + k for i, s in enumerate(spans) if spans.count(s) > 1 for k in range(3)}
        assert r.n_repeat_words == len(covered), text
    assert quality.ledger(odd.where("false")).count() == 0


def test_quality_ablation(spark, docs):
    rows = quality.ledger(docs)
    found = {r.rule: (r.n_failed, r.n_only) for r in quality.ablation(rows).collect()}
    bits = [r.failed_bits for r in rows.collect()]
    assert found == {r: (sum(b >> i & 1 for b in bits), sum(b & 127 == 1 << i for b in bits)) for i, r in enumerate(quality.RULES[:7])}
    kept = {v: quality.apply_policy(rows, v).where("kept").count() for v in quality.POLICIES}
    assert kept[3] == sum(b & ~8 == 0 for b in bits) <= kept[2] == sum(b & 127 == 0 for b in bits) <= kept[1]


def water(sizes, weights):
    """Targets by repeated resharing."""
    target, open_ = {}, set(sizes)
    left = float(sum(sizes.values()))
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level >= 3 * sizes[s]}
        if not full:
            return target | {s: weights[s] * level for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mixing(spark, docs, odd):
    for df in (docs, odd):
        rows = mixing.mix(df).collect()
        given = df.select("doc_id", "text", "source").collect()
        count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert sorted((r.doc_id or -1, r.size) for r in rows) == sorted((r.doc_id or -1, count(r.text)) for r in given)
        sizes, source = defaultdict(int), {}
        for r in given:
            sizes[r.source] += count(r.text)
            source[r.doc_id] = r.source
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        want = water(sizes, {s: 1 + i % 3 for i, s in enumerate(names)})
        taken, largest = defaultdict(int), defaultdict(int)
        for r in rows:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and r.taken <= 3 * r.size
            taken[s] += r.taken
            largest[s] = max(largest[s], r.size)
        assert all(abs(taken[s] - want[s]) <= largest[s] for s in names)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()))
    mix, again = mixing.take(docs), mixing.mix(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r.epochs for r in again.collect())
    assert mixing.mix(docs.where("false")).count() == 0


def test_mixing_selects(spark, docs, odd):
    """Which rows are taken, against a plain pass over each source in the order of its keys; and the mix by rows."""
    twice = odd.unionByName(odd.where("doc_id = 4")).unionByName(spark.createDataFrame([(6, "other text", "en", "s", 6)], SCHEMA).selectExpr("*", "1 as size", "2 as slot", "3 as n_words", "4 as node", "5 as target", "'x' as part"))
    for df in (docs, twice):
        named = mixing._named(df.select("doc_id", "text", "source"), ["doc_id", "text", "source"])
        rows = named.select("doc_id", "source", mixing.size_in_words(F.col("text")).alias("size"), mixing.quality_weight(F.col("text")).alias("w"), *mixing.ROW, F.col("draw").alias("h")).collect()
        out = mixing.mix(df).collect()
        sizes = defaultdict(int)
        for r in rows:
            sizes[r.source] += r.size
        target = water(sizes, {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))})
        want = Counter()
        for s in sizes:
            full = int(target[s] / sizes[s] + 1e-12) if sizes[s] else 0
            rest, so_far = target[s] - full * sizes[s], 0
            key = lambda r: (-math.log((((r.h & (2**64 - 1)) >> 11) + 0.5) / 2**53) / r.w, r.row_a, r.row_b)
            for r in sorted((r for r in rows if r.source == s), key=key):
                more = rest > 0 and full < 3 and so_far + r.size / 2 <= rest
                so_far += r.size
                want[r.doc_id, r.size, full + more] += 1
        assert Counter((r.doc_id, r.size, r.epochs) for r in out if r.size) == Counter({k: v for k, v in want.items() if k[1]})
        mix = mixing.take(df)
        assert mix.columns == df.columns and mix.schema.simpleString() == df.schema.simpleString()
        taken = Counter(r.doc_id for r in mix.collect())
        assert taken == Counter(r.doc_id for r in out for _ in range(r.epochs))


def test_language(spark, docs, odd):
    model = langid.train(docs)
    rows = langid.predict(docs, model).where("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 100 and sum(r.lang_pred == r.lang for r in rows) > 0.96 * len(rows)
    found = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert all(found[i].lang_pred == "und" for i in (1, 2, 3, 4)) and found[5].lang_pred in model.langs
    assert langid.filter_known(odd, model).columns == odd.columns
    assert langid.train(docs.where("false")).langs == [] and langid.predict(docs.where("false"), model).count() == 0
    kept = langid.filter_known(spark.createDataFrame([(1, "This is some text of the documents.", None), (2, None, "x")], "doc_id long, text string, lang string"), model)
    assert [tuple(r) for r in kept.collect()] == [(1, "This is some text of the documents.", None)]


def test_language_scores():
    """The folded product is the product with every landmark, kernel by kernel."""
    rng = np.random.default_rng(2)
    marks, texts = ["ein Text über das", "un texte", "some text"], ["ein texte", "x" * 300_000 + " Ende", "das ist some"]
    weights, intercept = rng.normal(size=(3, 2)), np.array([0.1, -0.2])
    model = langid.Model(["a", "b"], langid.presence(marks), weights, intercept)

    def grams(t):
        t = " " + " ".join(t.lower().split()) + " "
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    for text, (lang, score, best) in zip(texts, model.decided(texts), strict=True):
        kernel = np.array([len(grams(text) & grams(m)) / math.sqrt(len(grams(text)) * len(grams(m))) for m in marks])
        values = kernel @ weights + intercept
        p = np.exp(langid.SHARPNESS * (values - values.max()))
        assert lang == "ab"[values.argmax()] and abs(best - values.max()) < 2e-3 and abs(score - (p / p.sum()).max()) < 5e-3


def test_many_languages(spark):
    """Seventy languages, some with long texts only: each is learnt."""
    rng = np.random.default_rng(1)
    rows = []
    for lang in range(70):
        letters = [chr(0x61 + x) for x in rng.choice(26, 6, replace=False)] + [chr(0x400 + lang)]
        for i in range(24):
            words = ["".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(9000 if lang == 3 and i < 4 else 40)]
            rows.append((len(rows), " ".join(words), f"l{lang}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    found = langid.predict(docs, model).where("held_out").join(docs, "doc_id").collect()
    assert len(model.langs) == 70 and sum(r.lang == r.lang_pred for r in found) > 0.9 * len(found)


def test_language_rejects(spark, docs):
    """Gibberish and unknown languages go by the classifier's verdict; nearly all held-out documents stay."""
    rng = np.random.default_rng(4)
    alphabet = list("abcdefghijklmnopqrstuvwxyz0123456789     ")
    bad = ["".join(rng.choice(alphabet, 300)) for _ in range(30)] + ["Ελληνικό κείμενο για δοκιμή, που δεν είναι γνωστό. " * 4, "นี่คือข้อความภาษาไทยสำหรับการทดสอบ" * 4]
    model = langid.train(docs, lose=corpus_pipeline.LOSE)
    assert langid.filter_known(spark.createDataFrame([(t,) for t in bad], "text string"), model).isEmpty()
    held = docs.where(fold(docs.doc_id) == 2)
    assert langid.filter_known(held, model).count() >= 0.98 * held.count()
    assert langid.train(docs.where("lang = 'en'"), lose=0.005).predict(["some text"])[0][0] == "en"


@pytest.fixture(scope="module")
def judged(spark):
    """Documents, labels, and a model that is trained on them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.train(docs, labels)


@pytest.fixture(scope="module")
def held_out(judged):
    """Held-out toxic texts, and clean ones."""
    docs, labels, _ = judged
    rows = docs.where(fold(F.col("doc_id")) == 2).join(labels.select("doc_id", "toxic"), "doc_id").where("length(text) > 0").select("doc_id", "text", "toxic").distinct().orderBy("doc_id").collect()
    return [r.text for r in rows if r.toxic == 1], [r.text for r in rows if r.toxic == 0]


@pytest.mark.parametrize("size", [10_000, 48_000, 184_000, 700_000])
def test_toxic_texts_among_clean_ones(judged, held_out, size):
    """A toxic text in front of, in the middle of and behind clean ones counts as it does alone, however long these are."""
    model, (toxic, clean) = judged[2], held_out
    filler = "\n".join(clean)[:size]
    half = filler.index(" ", size // 2)
    found = [model.scores(pa.array([t + "\n" + filler, filler[:half] + "\n" + t + "\n" + filler[half:], filler + "\n" + t])) for t in toxic[:40]]
    assert len(filler) == size and np.mean([s >= toxicity.THRESHOLD for three in found for s in three]) >= 0.85
    if size < 200_000:
        assert model.scores(pa.array([filler]))[0] < toxicity.THRESHOLD


def test_misspelt_toxic_texts(judged, held_out):
    """Two letters change places in every word of five or more: seven of ten toxic texts are still found, and clean ones are left alone."""
    model, draw = judged[2], np.random.default_rng(1)

    def swapped(text):
        out = []
        for w in text.split(" "):
            if len(w) >= 5:
                i = int(draw.integers(1, len(w) - 2))
                w = w[:i] + w[i + 1] + w[i] + w[i + 2 :]
            out.append(w)
        return " ".join(out)

    toxic, clean = (np.array(model.scores(pa.array([swapped(t) for t in texts]))) >= toxicity.THRESHOLD for texts in held_out)
    assert toxic.mean() >= 0.7 and clean.mean() <= 0.015


def test_toxicity(spark, odd, judged):
    """On all held-out rows, and on those with one of six plain words."""
    docs, labels, model = judged
    rows = toxicity.score(docs, model).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r.predicted for r in rows if r.toxic == 0]
    marked = [r.predicted for r in toxic if re.search("idiot|moron|stupid|scum|worthless|pathetic", r.text)]
    assert len(toxic) > 100 and sum(r.predicted for r in toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.015 * len(clean)
    assert len(marked) > 40 and sum(marked) >= 0.95 * len(marked)
    found = {r.doc_id: r for r in toxicity.score(odd, model).collect()}
    assert found[1].score == found[2].score == found[3].score == 0 and len(found) == 7
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert toxicity.train(docs.where("false"), labels).scores(pa.array(["x"]))[0] < 0.3
    assert [tuple(r) for r in toxicity.filter_clean(odd.where("doc_id = 1"), model).collect()] == [tuple(r) for r in odd.where("doc_id = 1").collect()]


def test_misspelt_forms():
    """One letter is swapped, left out or doubled inside a word; short words stay, and a seed gives the same forms and model again."""
    draw = np.random.default_rng(2)
    forms = {toxicity.misspelt("abcdef", draw) for _ in range(300)}
    assert {len(f) for f in forms} == {5, 6, 7} and all(f[0] == "a" and f[-1] == "f" and f != "abcdef" for f in forms)
    assert toxicity.misspelt("abc", draw) == "abc"
    texts, labels = ["some quiet words here", "horrible words there", "", "quiet"] * 5, [0, 1, 0, 0] * 5
    assert np.array_equal(toxicity.fit(texts, labels).table, toxicity.fit(texts, labels).table)


def test_toxicity_scores():
    """Scores of whole texts against sums over every subword of every word."""
    rng = np.random.default_rng(4)
    table, bias, wrap = rng.normal(size=toxicity.BUCKETS), -0.3, 2**64 - 1

    def logit(word):
        padded = "<" + word + ">"
        mixed = [(ord(c) + 1) * 0x9E3779B97F4A7C15 & wrap for c in padded]
        mixed = [x ^ x >> 29 for x in mixed]
        buckets = []
        for n in (3, 4, 5):
            for i in range(len(padded) - n + 1):
                h = n
                for k in range(n):
                    h = (h ^ mixed[i + k]) * 0xD6E8FEB86659FD93 & wrap
                    h ^= h >> 32
                buckets.append(h % toxicity.BUCKETS)
        whole = sum(x * (2 * i + 1) for i, x in enumerate(mixed)) & wrap
        buckets.append((whole ^ whole >> 31) % toxicity.BUCKETS)
        return sum(table[b] for b in buckets) / len(buckets)

    texts = ["", "One, two! (three)", " ".join(f"w{x}" for x in rng.integers(0, 50, 97)), "é" * 150 + " end", "a b " * 6, "x", " ".join(f"w{x}" for x in rng.integers(0, 5000, 1900))]
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 300, n)) for n in (2, 3, 7, 8, 9, 399, 400, 401, 402, 599, 600, 601, 1000, 1201)]
    for text, score in zip(texts, toxicity.Model(table, bias).scores(pa.array(texts)), strict=True):
        values = [logit(p) for w in text.split() for p in toxicity.pieces(w)]
        means = [sum(values[i : i + 2]) / 2 if i + 1 < len(values) else sum(values[-2:]) / len(values[-2:]) for i in range(0, len(values), 2)]
        windows = [means] if len(means) <= 200 else [means[i : i + 200] for i in range(0, len(means) - 100, 100)]
        worst = max((sum(sorted(w)[-4:]) / len(sorted(w)[-4:]) for w in windows if w), default=None)
        assert score == pytest.approx(1 / (1 + math.exp(-worst - bias)) if values else 0.0, abs=1e-9)


def test_toxicity_of_long_tokens():
    """All of a text without blanks counts, as pieces that hold each of its n-grams."""
    rng = np.random.default_rng(3)
    bad = ["".join(chr(0x5000 + x) for x in rng.integers(0, 40, 200)) for _ in range(60)]
    clean = ["".join(chr(0x6000 + x) for x in rng.integers(0, 40, 200)) for _ in range(60)]
    model = toxicity.fit(bad + clean, [1] * 60 + [0] * 60)
    late, never = clean[0] + bad[0], clean[0] + clean[1]
    a, b, c = model.scores(pa.array([late, never, "x " + late + "  y"]))
    assert a > 0.5 > b and c > 0.5
    word = "".join(map(chr, range(0x4E00, 0x4E00 + 203)))
    held = toxicity.pieces(word)
    assert all(any(word[k : k + 5] in p for p in held) for k in range(199)) and toxicity.pieces("Word,") == ["word"]
    assert toxicity.tokens(word + " a") == [*held, "a"]


def test_licenses(spark, odd):
    texts = ["Some words.\nReleased under the MIT License.\nMore.", "  LICENSED UNDER CC BY-NC 4.0  ", "all rights reserved", "nothing here", "Licensed under the Apache License\nVersion 2.0.\n\nx y"]
    rows = licenses.scan(spark.createDataFrame(enumerate(texts), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.license for r in rows] == ["MIT", "CC-BY-NC-4.0", "all-rights-reserved", None, "Apache-2.0"]
    assert rows[0].dice == 1 and rows[0].n_matches == 1 and rows[3].n_matches == 0
    assert licenses.scan(odd).where("license is not null").isEmpty() and licenses.scan(odd).count() == len(ODD)


def test_licenses_equal_brute_force(spark, docs):
    def norm(t):
        return re.sub(r"[^\w]+|_+", " ", t.lower()).split()

    def grams(w):
        return set(zip(w[:-1], w[1:], strict=True)) if len(w) > 1 else {(x,) for x in w}

    known = [(name, grams(norm(text))) for name, text in licenses.TEMPLATES]
    want = {}
    for r in docs.collect():
        units = r.text.split("\n") + [p for p in re.split(r"\n[ \t\r]*\n", r.text) if "\n" in p.strip()]
        scores = [max(((2 * len(g & t) / (len(g) + len(t)), n) for n, t in known if g), default=(0, "")) for g in map(grams, map(norm, units))]
        good = [s for s in scores if s[0] >= 0.8]
        want[r.doc_id] = (max(good)[1] if good else None, len(good))
    assert {r.doc_id: (r.license, r.n_matches) for r in licenses.scan(docs).collect()} == want


def test_licenses_inside_other_text(spark):
    """Notices within longer lines and paragraphs, against a brute force over all windows of each template's size."""
    norm = lambda t: re.sub(r"[^\w]+|_+", " ", t.lower()).split()
    grams = lambda w: set(zip(w[:-1], w[1:], strict=True))
    rng = np.random.default_rng(8)
    other = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 30, n))
    texts, names = [], []
    for name, template in licenses.TEMPLATES:
        wrapped = re.sub(r"((?:\S+ ){5})", r"\1\n# ", template)
        texts += [f"{other(40)} {template} {other(30)}", f"# {other(9)}\n#\n# Copyright 2020 x\n# {wrapped}\n# {other(30)}"]
        names += [name, name]
    texts += [" ".join(norm(licenses.TEMPLATES[2][1])[:25]) + " " + other(50), "the software is free of charge, and the license " + other(20)]
    for text, r in zip(texts, licenses.scan(spark.createDataFrame(enumerate(texts), "doc_id long, text string")).orderBy("doc_id").collect(), strict=True):
        w, best = norm(text), (0, "")
        for name, template in licenses.TEMPLATES:
            t = norm(template)
            for k in range(max(1, len(w) - len(t) + 1)):
                g = grams(w[k : k + len(t)])
                best = max(best, (2 * len(g & grams(t)) / (len(g) + len(grams(t))), name))
        assert (r.license, r.n_matches) == ((best[1], 1) if best[0] >= 0.8 else (None, 0)), text
        assert r.license is None or abs(r.dice - best[0]) < 1e-12
        assert r.doc_id >= len(names) or (r.dice == 1 and r.license == best[1])
    mixed = "All rights reserved.\n" + texts[0].replace("\n", " ") + "\nAll rights reserved.\nAll rights reserved."
    assert licenses.scan(spark.createDataFrame([(1, mixed)], "doc_id long, text string")).first().n_matches == 4


def test_languages_that_mix_in_long_texts(spark, docs):
    """Training looks at long texts from beginning to end: there most of each text is of its language, but not its first 10,000 characters."""
    base = {lang: " ".join(r.text for r in docs.where(f"lang = '{lang}' and length(text) between 500 and 4000").orderBy("doc_id").limit(60).collect()) for lang in ("en", "de", "fr", "es")}
    rows, other = [], {"en": "de", "de": "fr", "fr": "es", "es": "en"}
    for k, lang in enumerate(base):
        for i in range(24):
            at = 997 * i
            rows.append((1000 * k + i, base[other[lang]][at : at + 10_000] + " " + base[lang][at : at + 40_000], lang))
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    plain = docs.where("length(text) > 400").select("text", "lang").collect()
    found = model.predict([r.text for r in plain])
    assert sum(f[0] == r.lang for f, r in zip(found, plain, strict=True)) > 0.9 * len(plain)
    assert langid.spread is not None and spark.createDataFrame([("x" * 9_000 + "y" * 9_000,)], "t string").select(langid.spread(F.col("t"), 1600)).first()[0].count("y") == 800
