"""Files of differing columns, the ledger of loaded files, replaced files, retention, and streams whose state ends."""

import datetime as dt
import gzip
import time

import pytest
from pyspark.sql import functions as F

from tallyline.operators import interactions, registry
from tallyline.plans import bindings
from tallyline.sources import ledger, readers, sinks
from tallyline.streaming import jobs

DATA = "/root/testdata/sf0.001"


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# ---------------------------------------------------------------- union of files


def test_union_of_files(spark, tmp_path):
    (tmp_path / "y").mkdir()
    (tmp_path / "y/2023.csv").write_text("﻿id,amount, sector\n1,10,a\n2,,\"b, c\"\n", "utf-8")
    with gzip.open(tmp_path / "y/2024.csv.gz", "wt", encoding="utf-8") as f:
        f.write("sector,id,ratio\nd,3,0.5\n")
    (tmp_path / "y/2025.csv").write_text("id,amount,sector\n4,x,e\n", "utf-8")
    (tmp_path / "y/_SUCCESS").write_text("")
    want = {"id": "int", "amount": "long", "sector": "string", "ratio": "double"}
    rows = readers.union_files(spark, [f"{tmp_path}/y/*.csv", f"{tmp_path}/y/2024.csv.gz"], columns=want).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 10, "a", None, "2023.csv"), (2, None, "b, c", None, "2023.csv"), (3, None, "d", 0.5, "2024.csv.gz"), (4, None, "e", None, "2025.csv")]
    every = readers.union_files(spark, [f"{tmp_path}/y"])
    assert every.columns == ["id", "amount", "sector", "ratio", "file_key"] and {r.file_key for r in every.collect()} == {"y"}
    pruned = readers.union_files(spark, [f"{tmp_path}/y/2023.csv"], columns={"sector": "string"})
    assert "ReadSchema: struct<sector:string>" in pruned._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="no files"):
        readers.union_files(spark, [f"{tmp_path}/none"])


def test_union_of_parquet_files(spark, tmp_path):
    spark.range(2).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("a")).write.parquet(f"{tmp_path}/p1")
    spark.range(5, 7).select("id", F.lit(1.5).alias("b")).write.parquet(f"{tmp_path}/p2")
    rows = readers.union_files(spark, [f"{tmp_path}/p1", f"{tmp_path}/p2"], "parquet", {"id": "long", "a": "string", "b": "double"})
    assert sorted(map(tuple, rows.collect())) == [(0, "x", None, "p1"), (1, "x", None, "p1"), (5, None, 1.5, "p2"), (6, None, 1.5, "p2")]


def test_personal_columns_stop_a_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,phone_no\n1,2\n")
    with pytest.raises(ValueError, match="phone_no"):
        readers.union_files(spark, [f"{tmp_path}/a.csv"], columns={"id": "int"})
    spark.range(1).withColumn("代表者", F.lit("x")).write.parquet(f"{tmp_path}/store")
    with pytest.raises(ValueError, match="代表者"):
        readers.read_changes(spark, f"{tmp_path}/store")


# ---------------------------------------------------------------- ledger


def daily_file(folder, day, n, kind, spark):
    name = f"diff_{day.replace('-', '')}"
    if kind == "csv":
        (folder / f"{name}.csv").write_text("day,n\n" + "".join(f"{day},{i}\n" for i in range(n)))
    else:
        made = folder.parent / f"made-{name}"
        spark.range(n).select(F.lit(day).alias("day"), F.col("id").cast("int").alias("n")).coalesce(1).write.parquet(str(made))
        next(made.glob("part-*")).rename(folder / f"{name}.parquet")


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_each_file_once(spark, tmp_path, kind):
    """Gaps first and oldest first; a late file, a restart, a lost checkpoint and a batch between do not load a file twice."""
    folder, store, book, at = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "ledger"), str(tmp_path / "at")
    folder.mkdir()
    reader = (ledger.csv_reader if kind == "csv" else ledger.parquet_reader)("day string, n int")
    for day, n in (("2024-01-03", 3), ("2024-01-01", 1), ("2024-01-02", 2)):
        daily_file(folder, day, n, kind, spark)
    assert [str(r.day) for r in ledger.pending_files(spark, str(folder), book).collect()] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert [str(r.day) for r in ledger.pending_files(spark, str(folder), book, 2).collect()] == ["2024-01-02", "2024-01-03"]
    assert [k[5:13] for k in ledger.repair(spark, str(folder), store, book, reader, most=1)] == ["20240103"]
    assert [tuple(r) for r in ledger.missing_days(spark, str(folder), book, "2024-01-01", "2024-01-04").orderBy("day").collect()] == [
        (dt.date(2024, 1, 1), True), (dt.date(2024, 1, 2), True), (dt.date(2024, 1, 4), False)]

    def ingest(where=at):
        ledger.start_ingest(spark, str(folder), store, book, "day string, n int", where, kind).awaitTermination(120)
        return {r.day: r["count"] for r in spark.read.parquet(store).groupBy("day").count().collect()}

    assert ingest() == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 3}
    daily_file(folder, "2024-01-05", 5, kind, spark)
    daily_file(folder, "2023-12-31", 4, kind, spark)  # late
    want = {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 3, "2024-01-05": 5, "2023-12-31": 4}
    assert ingest() == want and ingest() == want and ingest(str(tmp_path / "at2")) == want
    entries = spark.read.parquet(book)
    assert entries.count() == 5 and sorted(r.n_rows for r in ledger.read_ledger(spark, book).collect()) == [1, 2, 3, 4, 5]
    assert not ledger.repair(spark, str(folder), store, book, reader)


def test_stream_leaves_out_what_the_ledger_has(spark, tmp_path):
    """The stream alone loads new files; one that a batch has loaded meanwhile is left out though the stream has not seen it."""
    folder, store, book = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "ledger")
    folder.mkdir()
    daily_file(folder, "2024-01-01", 2, "csv", spark)
    query = ledger.start_ingest(spark, str(folder), store, book, "day string, n int", str(tmp_path / "at"), "csv", every="1 second")
    daily_file(folder, "2024-01-02", 3, "csv", spark)
    for _ in range(100):
        if ledger.read_ledger(spark, book).count() == 2:
            break
        time.sleep(0.3)
    query.stop()
    assert {(r.file_key, r.batch.split("-")[0]) for r in ledger.read_ledger(spark, book).collect()} == {("diff_20240101.csv", "repair"), ("diff_20240102.csv", "stream")}
    assert spark.read.parquet(store).count() == 5


def test_a_spoilt_file_does_not_stop_the_others(spark, tmp_path):
    folder, store, book = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "ledger")
    folder.mkdir()
    daily_file(folder, "2024-01-01", 2, "parquet", spark)
    (folder / "diff_20240102.parquet").write_text("spoilt")
    daily_file(folder, "2024-01-03", 1, "parquet", spark)
    reader = ledger.parquet_reader("day string, n int")
    assert ledger.repair(spark, str(folder), store, book, reader) == ["diff_20240101.parquet", "diff_20240103.parquet"]
    state = {r.file_key: r.status[:5] for r in ledger.read_ledger(spark, book).collect()}
    assert state == {"diff_20240101.parquet": "ok", "diff_20240102.parquet": "error", "diff_20240103.parquet": "ok"}
    (folder / "diff_20240102.parquet").unlink()
    daily_file(folder, "2024-01-02", 4, "parquet", spark)
    assert ledger.repair(spark, str(folder), store, book, reader) == ["diff_20240102.parquet"] and spark.read.parquet(store).count() == 7


# ---------------------------------------------------------------- replaced files, retention


def table(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("file_key", "x", "year").collect()))


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("a", 1, 2023), ("a", 2, 2024), ("b", 3, 2024), ("c", 4, 2025), ("d", 5, 2026)]
    assert sinks.replace_issued(spark.createDataFrame(rows, "file_key string, x int, year int"), path, "year") == [f"year={y}" for y in (2023, 2024, 2025, 2026)]
    return path


def test_issued_file_replaces_its_rows(spark, tmp_path, store):
    log = str(tmp_path / "log")
    untouched = sorted((tmp_path / "store/year=2025").iterdir())
    new = spark.createDataFrame([("a", 9, 2024), ("a", 8, 2027), ("d", 7, 2024)], "file_key string, x int, year int")
    assert sinks.replace_issued(new, store, "year", log) == ["year=2024", "year=2027"]
    assert table(spark, store) == [("a", 8, 2027), ("a", 9, 2024), ("b", 3, 2024), ("c", 4, 2025), ("d", 7, 2024)]
    assert sorted((tmp_path / "store/year=2025").iterdir()) == untouched and not (tmp_path / "store/year=2026").exists()
    assert [(r.status, r.files) for r in sinks.read_run_log(spark, log).orderBy("status").collect()] == [("begun", "a,d"), ("done", "a,d")]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("store.")]


@pytest.mark.parametrize("at", range(1, 6))
def test_a_crash_leaves_the_old_table(spark, tmp_path, store, monkeypatch, at):
    """The run dies at its n-th move, whichever that is; what the next run finds is the old table."""
    before, moves, move = table(spark, store), [], sinks._rename

    def dies(*args):
        moves.append(args)
        if len(moves) >= at:
            raise SystemExit("dead")
        move(*args)

    new = spark.createDataFrame([("a", 9, 2024), ("a", 8, 2027), ("d", 7, 2024)], "file_key string, x int, year int")
    monkeypatch.setattr(sinks, "_rename", dies)
    with pytest.raises(SystemExit):
        sinks.replace_issued(new, store, "year")
    monkeypatch.setattr(sinks, "_rename", move)
    assert sinks.recover(spark, store) and table(spark, store) == before and sinks.recover(spark, store) is None
    sinks.replace_issued(new, store, "year")
    assert table(spark, store) == [("a", 8, 2027), ("a", 9, 2024), ("b", 3, 2024), ("c", 4, 2025), ("d", 7, 2024)]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("store.")]


def test_a_table_lost_between_two_moves_comes_back(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.rebuild(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.old-1")
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and sinks.rebuild(spark.range(4), path) == 4


def test_retention_frees_storage(spark, tmp_path):
    path, totals = str(tmp_path / "counts"), str(tmp_path / "totals")
    days = spark.range(900).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.concat(F.lit("p"), F.col("id") % 3).alias("product"), (F.col("id") % 7).alias("n"))
    days.where("day < '2023-01-20' or day > '2024-12-01'").repartition(1).write.partitionBy("day").parquet(path)
    want = sinks.all_time(spark, path, totals, ["product"]).collect()
    gone = sinks.expire(spark, path, totals, "2025-06-18", ["product"])
    assert gone == [f"day=2023-01-{d:02}" for d in range(1, 20)] and min(sinks.folders(spark, path)) == "day=2024-12-02"
    assert sorted(sinks.all_time(spark, path, totals, ["product"]).collect()) == sorted(want)
    # a run that died before it took the folders away: counted once all the same
    days.where("day = '2023-01-05'").write.mode("append").partitionBy("day").parquet(path)
    assert sorted(sinks.all_time(spark, path, totals, ["product"]).collect()) == sorted(want)
    assert sinks.expire(spark, path, totals, "2025-06-18", ["product"]) == ["day=2023-01-05"] and sinks.expire(spark, path, totals, "2025-06-18", ["product"]) == []
    sinks.expire(spark, path, totals, "2027-06-18", ["product"])
    assert sinks.folders(spark, path) == [] and sorted(sinks.all_time(spark, path, totals, ["product"]).collect()) == sorted(want)


# ---------------------------------------------------------------- streams


def fields(df):
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def run(stream, tmp_path, name, mode="append"):
    """The rows given out, and the state rows that are left."""
    out = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"at-{name}")).trigger(availableNow=True).start()
    out.awaitTermination(180)
    last = [p for p in out.recentProgress if p.stateOperators]
    return stream.sparkSession.table(name), [o.numRowsTotal for o in last[-1].stateOperators]


def test_a_day_in_two_batches(spark, tmp_path):
    """Days that come in pieces, corrections that move a change to another day, and a batch that comes twice, against counts over all rows."""
    store, path = str(tmp_path / "store"), str(tmp_path / "days")
    rows = bindings.changes(spark, DATA)
    fixed = rows.where("correct_flag = 0 and arrival % 17 = 0 and day(file_date) < 25").withColumn("correct_flag", F.lit(1)).withColumn("arrival", F.col("arrival") + 1_000_000)
    fixed = fixed.withColumn("file_date", F.date_add("file_date", 3))
    every = rows.unionByName(fixed)
    write = jobs.update_day_summary(store, path)
    batches = [rows.where("arrival % 2 = 0"), rows.where("arrival % 2 = 1 and file_date < '2024-01-20'"), fixed, rows.where("arrival % 2 = 1 and file_date >= '2024-01-15'")]
    for i, b in enumerate(batches):
        write(b, i)
    write(batches[3], 3)
    write(batches[2], 2)
    got = spark.read.parquet(path).select("day", "axis", "key", "n")
    assert same(got, registry.daily_counts(registry.dedup_changes(every)))


def test_a_crash_between_store_and_summary(spark, tmp_path, monkeypatch):
    """A correction empties a day; the run dies after the store has changed; the batch comes again."""
    store, path = str(tmp_path / "store"), str(tmp_path / "days")
    rows = bindings.changes(spark, DATA)
    one = rows.where("correct_flag = 0").limit(1).withColumn("file_date", F.lit("2024-01-29").cast("date")).cache()
    fixed = one.withColumn("correct_flag", F.lit(1)).withColumn("file_date", F.lit("2024-01-30").cast("date")).withColumn("arrival", F.lit(10**7).cast(one.schema["arrival"].dataType))
    write = jobs.update_day_summary(store, path)
    write(one, 0)
    monkeypatch.setattr(jobs, "daily_counts", lambda _: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write(fixed, 1)
    monkeypatch.undo()
    write(fixed, 1)
    assert {str(r.day) for r in spark.read.parquet(path).collect()} == {"2024-01-30"}


def test_day_summary_as_a_stream(spark, tmp_path):
    rows = bindings.changes(spark, DATA)
    for i in range(3):
        rows.where(f"arrival % 3 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.ingest_stream(spark, str(tmp_path / "in"), fields(rows), 1)
    write = jobs.update_day_summary(str(tmp_path / "store"), str(tmp_path / "days"))
    stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination(180)
    assert same(spark.read.parquet(str(tmp_path / "days")).select("day", "axis", "key", "n"), registry.daily_counts(registry.dedup_changes(rows)))


def test_distinct_clients_as_a_stream(spark, tmp_path):
    """Two stateful steps give what the batch gives, and forget clients and days once these are past."""
    valid, _ = interactions.validate_clicks(bindings.sql(spark, DATA, bindings.CLICKS), [f"p{i}" for i in range(6)])
    valid = valid.select(F.col("ts").cast("timestamp").alias("ts"), "product", "kind", "client")
    end = valid.limit(1).withColumn("ts", F.lit("2024-03-01").cast("timestamp"))
    folder = str(tmp_path / "in")
    for i, part in enumerate([valid.where("ts < '2024-01-12'"), valid.where("ts >= '2024-01-12'"), end, end.withColumn("ts", F.lit("2024-03-01 01:00:00").cast("timestamp"))]):
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1 if i < 3 else 0)
    stream = jobs.ingest_stream(spark, folder, fields(valid), 1)
    got, left = run(jobs.distinct_clients_stream(stream, ["product", "kind"], F.col("client")), tmp_path, "clients")
    assert same(got, interactions.distinct_clients(valid, ["product", "kind"], F.col("client")).select("product", "kind", "day", "clients"))
    assert len(left) == 2 and max(left) <= 1


def test_window_state_ends(spark, tmp_path):
    """Verdicts are those of the batch form; once event time has passed, no client is held any more."""
    events = spark.read.parquet(f"{DATA}/events.parquet").select(F.concat(F.lit("c"), F.col("user_id") % 9).alias("client"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("request_id"))
    last = spark.createDataFrame([("late", dt.datetime(2024, 6, 1), -1)], "client string, ts timestamp, request_id long")
    after = spark.createDataFrame([("later", dt.datetime(2024, 9, 1), -2)], "client string, ts timestamp, request_id long")
    folder = str(tmp_path / "req")
    for i, part in enumerate([events.where("ts < '2024-01-15'"), events.where("ts >= '2024-01-15'"), last, after]):
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1 if i < 3 else 0)
    stream = jobs.ingest_stream(spark, folder, fields(events), 1)
    got, left = run(jobs.window_verdicts(stream, 3, 86_400), tmp_path, "ended")
    want = interactions.fixed_window_verdicts(events, 3, 86_400).select("client", "request_id", "allowed", F.col("remaining").cast("int").alias("remaining"), "retry_after")
    assert same(want, got.where("request_id >= 0"))
    assert left[0] <= 4  # the last client, its window and its timer


def crawl_files(spark, folder, crawls):
    for i, c in enumerate(crawls):
        spark.createDataFrame([c], "board string, day string, outcome string, job_ids array<string>").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1 if i < len(crawls) - 1 else 0)
    return jobs.ingest_stream(spark, folder, "board string, day string, outcome string, job_ids array<string>", 1)


def test_tracker_forgets(spark, tmp_path):
    """Postings closed for longer than is kept go from the state, and so do all of a board that is no longer crawled."""
    crawls = [("1", f"2024-01-{d:02}", "ok", j) for d, j in ((1, ["a", "b"]), (2, ["a"]), (3, ["a"]), (20, ["a"]), (21, ["a", "b"]))]
    stream = crawl_files(spark, str(tmp_path / "crawls"), [*crawls, ("2", "2024-06-01", "ok", ["x"]), ("2", "2024-06-02", "ok", ["x"])])
    rows, left = run(jobs.track_postings(stream, 10), tmp_path, "forgets", "update")
    assert {(r.posting, r.first_seen) for r in rows.where("status = 'open' and last_seen = '2024-01-21'").collect()} == {("a", "2024-01-01"), ("b", "2024-01-21")}
    kept, all_left = run(jobs.track_postings(stream, 400), tmp_path, "keeps", "update")
    assert {(r.posting, r.first_seen) for r in kept.where("status = 'open' and last_seen = '2024-01-21'").collect()} == {("a", "2024-01-01"), ("b", "2024-01-01")}
    assert left[0] < all_left[0]


def test_tracker_forgets_by_the_clock(spark, tmp_path):
    folder = str(tmp_path / "crawls")
    stream = crawl_files(spark, folder, [("1", "2024-01-01", "ok", ["a"])])
    def waited(n):
        for _ in range(150):
            if spark.table("clock").count() >= n:
                return
            time.sleep(0.2)

    query = jobs.track_postings(stream, 4 / 86_400, clock=True).writeStream.format("memory").queryName("clock").outputMode("update").option("checkpointLocation", str(tmp_path / "at"))
    query = query.trigger(processingTime="1 second").start()
    try:
        waited(1)
        time.sleep(6)
        crawl_files(spark, folder, [("1", "2024-01-02", "ok", ["a"])])
        waited(2)
    finally:
        query.stop()
    assert [(r.first_seen, r.last_seen) for r in spark.table("clock").orderBy("last_seen").collect()] == [("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-02")]
