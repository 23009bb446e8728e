"""Readers, sinks and streaming jobs; each stream gives what the batch form gives."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import interactions, postings, registry
from tallyline.plans import bindings
from tallyline.sources import readers, sinks
from tallyline.streaming import jobs

DATA = "/root/testdata/sf0.001"


def test_award_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿"1","翻訳, 業務","2026-04-01","31389000.00","W1","8004030","Ｐｏｌｅ","7011003005763"\r\n"2","x"\r\n"3","t","2026-04-02","5","U1","8002010","n"\r\n', "utf-8")
    rows = readers.read_awards(spark, str(tmp_path / "a.csv")).orderBy("item_no").collect()
    assert [(r.item_no, r.corporate_number) for r in rows] == [("1", "7011003005763"), ("3", None)]
    assert rows[0].title == "翻訳, 業務"


def test_postings_payloads(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"jobs": [{"id": 1, "title": "t", "location": {"name": "Tokyo"}, "absolute_url": "u", "updated_at": "d", "secret": "s"}]}')
    (tmp_path / "l.json").write_text('[{"id": "x", "text": "t", "hostedUrl": "u", "createdAt": 1, "categories": {"location": "Osaka", "team": "e"}, "description": "never"}]')
    o = readers.read_postings(spark, str(tmp_path / "o.json"), "object").first()
    assert (o.job_id, o.location) == ("1", "Tokyo")
    assert readers.read_postings(spark, str(tmp_path / "l.json"), "array").first().team == "e"
    with pytest.raises(Exception, match="payload"):
        readers.read_postings(spark, str(tmp_path / "o.json"), "array").collect()


def test_store_merges_by_key(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = bindings.changes(spark, DATA)
    sinks.write_changes(rows.where("arrival % 2 = 0"), path)
    sinks.write_changes(rows.where("arrival % 2 = 1"), path)
    assert readers.read_changes(spark, path).count() == registry.dedup_changes(rows).count()


def test_rebuild_and_serving(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.rebuild(spark.range(5), path) == 5
    with pytest.raises(ValueError, match="rebuild"):
        sinks.rebuild(spark.range(0), path)
    assert spark.read.parquet(path).count() == 5
    sinks.load_serving_table(spark.createDataFrame([("a", "1"), ("b", "")], "k string, n string"), str(tmp_path / "s"), ["k"], ["n"])
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [0, 1]
    assert sinks.load_serving_table(spark.createDataFrame([("a", "7")], "k string, n string"), str(tmp_path / "s"), ["k"], ["n"], str(tmp_path / "loads")) == 1
    assert [r.n for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [7] and sinks.read_run_log(spark, str(tmp_path / "loads")).first().rows == "1"
    sinks.append_run_log(spark, str(tmp_path / "log"), {"run": 1, "ok": True})
    sinks.append_run_log(spark, str(tmp_path / "log"), {"run": 2, "error": "e"})
    assert sinks.read_run_log(spark, str(tmp_path / "log")).count() == 2


def test_registry_files(spark, tmp_path):
    cells = [f"c{i}" for i in range(30)]
    (tmp_path / "d.csv").write_text(",".join(f'"{c}"' for c in cells) + "\r\n" + ",".join(f'"{c}"' for c in cells[:10]) + "\r\n", "utf-8")
    rows = readers.read_registry_diff(spark, str(tmp_path / "d.csv")).collect()
    assert len(rows) == 1 and len(rows[0]) == 24 and (rows[0].name_image_id, rows[0].kind_code, rows[0].hidden_flag) == ("c7", "c8", "c29") and "c16" not in rows[0]
    base = readers.read_registry_baseline(spark, str(tmp_path / "d.csv"), "s", "2026-01-01").first()
    assert base.asDict() == {"corporate_number": "c1", "prefecture_code": "c13", "prefecture": "c9", "city": "c10", "kind_code": "c8", "close_date": "c18", "source_id": "s", "retrieved_at": "2026-01-01"}
    (tmp_path / "m.csv").write_text("day,status\n1,ok\n2,\n3,failed\n")
    manifest = spark.read.csv(str(tmp_path / "m.csv"), header=True)
    assert [r.day for r in readers.read_manifest(spark, str(tmp_path / "m.csv")).collect()] == ["1", "2"]
    sinks.publish_manifest(manifest, str(tmp_path / "pm"), ["day"])
    assert [r.day for r in spark.read.csv(str(tmp_path / "pm"), header=True).collect()] == ["1", "2"]
    store = spark.createDataFrame([("a", 1), ("b", 2)], "file_key string, x int")
    assert sorted(map(tuple, sinks.replace_files(store, store.where("file_key = 'a'").withColumn("x", F.lit(9))).collect())) == [("a", 9), ("b", 2)]


def test_day_summary_round_trip(spark, tmp_path):
    daily = bindings.daily(spark, DATA)
    sinks.publish_day_summary(daily, str(tmp_path / "days"))
    back = readers.read_day_summary(spark, str(tmp_path / "days"))
    cols = ["day", "axis", "key", "n"]
    assert back.select(cols).exceptAll(daily.select(cols)).isEmpty() and daily.select(cols).exceptAll(back.select(cols)).isEmpty()
    assert len(list((tmp_path / "days").glob("part-*"))) == 1


def test_stats_table(spark, tmp_path):
    rows = spark.createDataFrame([(2024, "b", 3, None), (2023, "a", 1, "x")], "fiscal_year int, sector string, n int, note string")
    sinks.publish_table(rows, str(tmp_path / "s"), ["fiscal_year", "sector", "n", "note"], ["fiscal_year"])
    back = readers.read_stats(spark, str(tmp_path / "s"), "fiscal_year int, sector string, n int, note string", ["sector"])
    assert [tuple(r) for r in back.orderBy("fiscal_year").collect()] == [(2023, "a", 1, "x"), (2024, "b", 3, None)]
    with pytest.raises(ValueError, match="one file"):
        sinks.publish_table(rows, str(tmp_path / "s2"), ["n"], ["n"], most=1)
    with pytest.raises(ValueError, match="missing"):
        readers.read_stats(spark, str(tmp_path / "s"), "fiscal_year int", ["nothing"])
    assert sorted(r.id for r in sinks.drop_expired(spark.range(3).withColumn("day", F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int"))), "day", "2026-02-06").collect()) == [2]


def test_daily_counts_stream(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = jobs.ingest_stream(spark, str(tmp_path / "in"), events.schema.simpleString()[7:-1].replace(":", " "))
    jobs.start_daily_counts(stream, ["event_type"], str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    assert got.exceptAll(want).isEmpty() and want.where(F.col("day") < F.lit(last)).exceptAll(got).isEmpty()


def run(stream, tmp_path, name, mode="append"):
    out = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    out.awaitTermination(120)
    return stream.sparkSession.table(name)


def test_first_hits_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = jobs.ingest_stream(spark, str(tmp_path / "in"), events.schema.simpleString()[7:-1].replace(":", " "))
    got = run(jobs.first_hits(stream, ["event_type"], F.col("user_id")), tmp_path, "hits").groupBy("event_type", "day").agg(F.count("*").alias("clients"))
    want = interactions.distinct_clients(events, ["event_type"], F.col("user_id"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_tracker_equals_lifecycle(spark, tmp_path):
    seen, outcomes = bindings.sql(spark, DATA, bindings.OBSERVED), bindings.sql(spark, DATA, bindings.OUTCOMES)
    outcomes = outcomes.withColumn("outcome", F.when(F.col("outcome") == "unchanged", "ok").otherwise(F.col("outcome")))
    ids = seen.groupBy("board", "day").agg(F.collect_set("posting").alias("job_ids"))
    crawls = outcomes.join(ids, ["board", "day"], "left").select(F.col("board").cast("string"), F.col("day").cast("string"), "outcome", "job_ids")
    crawls.coalesce(1).write.parquet(str(tmp_path / "crawls"))
    stream = jobs.ingest_stream(spark, str(tmp_path / "crawls"), "board string, day string, outcome string, job_ids array<string>")
    got = run(jobs.track_postings(stream), tmp_path, "tracked", "update").select("board", "posting", "status", "first_seen")
    # a posting that comes back after closing is open again, so only the last state of a batch is compared
    want = postings.posting_lifecycle(seen, outcomes).select(F.col("board").cast("string"), "posting", "status", F.col("first_seen").cast("string"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_window_verdicts_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").select(F.concat(F.lit("c"), F.col("user_id") % 5).alias("client"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("request_id"))
    events.write.parquet(str(tmp_path / "req"))
    stream = jobs.ingest_stream(spark, str(tmp_path / "req"), "client string, ts timestamp, request_id long")
    got = run(jobs.window_verdicts(stream, 3, 86_400), tmp_path, "verdicts").select("request_id", "allowed", F.col("remaining").cast("long"), "retry_after")
    want = interactions.fixed_window_verdicts(events, 3, 86_400).select("request_id", "allowed", "remaining", "retry_after")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
