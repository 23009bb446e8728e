"""Sinks: keyed merges into partitioned stores, staged rebuilds, published aggregates, serving tables, run logs."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.awards import dedup_awards
from tallyline.operators.registry import dedup_changes


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return bool(fs.exists(at))


def _rename(spark: SparkSession, old: str, new: str) -> None:
    (a, fs), (b, _) = _path(spark, old), _path(spark, new)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {old}")


def _delete(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders of a table."""
    at, fs = _path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at) if x.isDirectory() and "=" in x.getPath().getName()) if fs.exists(at) else []


def recover(spark: SparkSession, path: str) -> str | None:
    """Undo what a run that died left half done at ``path``: a swap of the whole table or of partitions. The run's name, if there was one.

    The sinks call this before they touch a table; a reader may, after a crash.
    """
    at, fs = _path(spark, path)
    if not fs.exists(at):
        for x in fs.globStatus(_path(spark, f"{path}.old-*")[0]) or []:
            fs.rename(x.getPath(), at)
            return x.getPath().getName()
    journal, _ = _path(spark, f"{path}.replacing")
    if not fs.exists(journal):
        return None
    todo = json.loads("".join(r.value for r in spark.read.text(f"{path}.replacing", wholetext=True).collect()) or "{}")
    for name in todo.get("names", []):
        aside, staged, there = (f"{todo[k]}/{name}" for k in ("aside", "staged", "path"))
        if exists(spark, aside):
            _delete(spark, there)
            _rename(spark, aside, there)
        elif name not in todo["old"] and not exists(spark, staged):
            _delete(spark, there)
    for k in ("aside", "staged"):
        if k in todo:
            _delete(spark, todo[k])
    fs.delete(journal, True)
    return todo.get("run")


def swap_partitions(spark: SparkSession, staged: str, path: str, gone: list[str], run: str) -> None:
    """Put staged partitions in the place of those of a table and take ``gone`` away. A journal tells :func:`recover` how to undo it.

    Old partitions are kept aside until all new ones stand; deleting the journal is what makes the new state the table's.
    """
    names = sorted({*folders(spark, staged), *gone})
    old = [n for n in names if exists(spark, f"{path}/{n}")]
    todo = {"run": run, "path": path, "staged": staged, "aside": f"{path}.aside-{run}", "names": names, "old": old}
    at, fs = _path(spark, f"{path}.replacing")
    out = fs.create(at, False)
    try:
        out.write(json.dumps(todo).encode())
    finally:
        out.close()
    for n in names:
        if n in old:
            _rename(spark, f"{path}/{n}", f"{todo['aside']}/{n}")
        if exists(spark, f"{staged}/{n}"):
            _rename(spark, f"{staged}/{n}", f"{path}/{n}")
    fs.delete(at, True)
    _delete(spark, todo["aside"])
    _delete(spark, staged)


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged table in the place of another; the old one goes only when the new one stands. See :func:`recover`."""
    recover(spark, path)
    (old, fs), (new, _) = _path(spark, path), _path(spark, staged)
    aside, _ = _path(spark, f"{path}.old-{uuid.uuid4().hex}")
    if fs.exists(old) and not fs.rename(old, aside):
        raise OSError(f"cannot move {path}")
    if not fs.rename(new, old):
        fs.rename(aside, old)
        raise OSError(f"cannot move {staged}")
    fs.delete(aside, True)


def _merge(df: DataFrame, path: str, partition: str, dedup, sort: str) -> None:
    """Merge rows into a store by key. Only partitions that get rows are read and written again."""
    spark = df.sparkSession
    rows = df
    if exists(spark, path):
        touched = df.select(partition).distinct()
        rows = spark.read.parquet(path).join(touched, partition, "left_semi").unionByName(df, allowMissingColumns=True)
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    dedup(rows).sortWithinPartitions(partition, sort).write.partitionBy(partition).parquet(staged)
    fresh = spark.read.parquet(staged)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    at, fs = _path(spark, staged)
    fs.delete(at, True)


def write_awards(df: DataFrame, path: str) -> None:
    """Merge awards into a store by fiscal year; the last arrival of an award wins."""
    _merge(df, path, "fiscal_year", dedup_awards, "award_id")


def write_changes(df: DataFrame, path: str) -> None:
    """Merge changes into a store by file month; the first correction, else the first arrival, wins."""
    _merge(df, path, "file_month", dedup_changes, "corporate_number")


def rebuild(df: DataFrame, path: str, least: int = 1) -> int:
    """Build a table anew beside the old one and swap it in only if it has ``least`` rows; the number of rows."""
    spark = df.sparkSession
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    n = spark.read.parquet(staged).count()
    if n < least:
        at, fs = _path(spark, staged)
        fs.delete(at, True)
        raise ValueError(f"a rebuild of {n} rows does not replace the table")
    swap_in(spark, staged, path)
    return n


#: Rows of a table that is published as one file.
MOST_ROWS = 1_000_000


def publish_table(df: DataFrame, path: str, columns: list[str], order: list[str], kind: str = "csv", most: int = MOST_ROWS) -> None:
    """A small aggregate as one ordered file with a fixed column order; nulls as blanks in CSV. A table of more than ``most`` rows is refused."""
    if df.select(F.lit(1)).limit(most + 1).count() > most:
        raise ValueError(f"a table of more than {most} rows is not published as one file")
    rows = df.select(*columns).orderBy(*order).coalesce(1)
    if kind == "csv":
        rows.write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")
    else:
        rows.write.mode("overwrite").json(path)


def publish_day_summary(daily: DataFrame, path: str) -> None:
    """A day summary (day, axis, key, n) as one JSON text, days and keys in order: what :func:`read_day_summary` reads.

    One small struct a publication day; there are a few hundred in a year.
    """
    each = lambda axis: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("axis") == axis, F.struct("key", "n")))))
    days = daily.groupBy("day").agg(
        F.sum(F.when(F.col("axis") == "total", F.col("n"))).alias("records"), each("process").alias("process_codes"), each("kind").alias("kind_codes"),
        each("prefecture").alias("prefectures"),
    )
    entry = F.struct(F.col("day").cast("string").alias("day"), F.struct("records", "process_codes", "kind_codes", "prefectures").alias("v"))
    in_order = F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["day"] < b["day"], -1).when(a["day"] > b["day"], 1).otherwise(0))  # maps have no order
    text = days.agg(F.map_from_entries(in_order).alias("days")).select(F.to_json(F.struct("days")).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(path)


def publish_manifest(manifest: DataFrame, path: str, columns: list[str]) -> None:
    """The rows of a manifest that are ok, in the columns that may be published, ordered by the first of them."""
    publish_table(manifest.where(F.coalesce(F.trim("status"), F.lit("")).isin("ok", "")), path, columns, columns[:1])


def replace_files(store: DataFrame, issued: DataFrame) -> DataFrame:
    """A store's rows after files came again: rows of a file (file_key) that is issued anew give way to its new ones."""
    return store.join(issued.select("file_key").distinct(), "file_key", "left_anti").unionByName(issued, allowMissingColumns=True)


def replace_issued(issued: DataFrame, path: str, partition: str, log: str | None = None) -> list[str]:
    """Replace the rows of files (file_key) that came again in a store partitioned by ``partition``; the partition folders written.

    Only partitions that hold rows of those files, old or new, are read and written: beside the table first, then swapped in. A run that dies
    leaves, after :func:`recover`, the old table. ``log`` is a run log that gets a row when the swap begins and one when it is done.
    """
    spark, run = issued.sparkSession, uuid.uuid4().hex
    if (undone := recover(spark, path)) and log is not None:
        append_run_log(spark, log, {"table": path, "run": undone, "status": "undone"})
    staged = f"{path}.staged-{run}"
    keys = issued.select("file_key").distinct()
    if not exists(spark, path):
        issued.write.partitionBy(partition).parquet(staged)
        _path(spark, path)[1].mkdirs(_path(spark, path)[0])
        touched = []
    else:
        store = spark.read.parquet(path)
        at = store.join(keys, "file_key", "left_semi").select(partition).unionByName(issued.select(partition)).distinct()
        touched = [r[0] for r in at.select(F.col(partition).cast("string")).collect()]  # names of partitions
        side = at.withColumnRenamed(partition, "touched_")
        kept = store.join(side, F.col(partition).eqNullSafe(F.col("touched_")), "left_semi")
        replace_files(kept, issued).write.partitionBy(partition).parquet(staged)
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    old, written = [name(partition, t) for t in touched], folders(spark, staged)
    entry = {"table": path, "run": run, "files": ",".join(sorted(str(r[0]) for r in keys.collect())), "partitions": ",".join(written)}
    if log is not None:
        append_run_log(spark, log, entry | {"status": "begun"})
    swap_partitions(spark, staged, path, [n for n in old if n not in written], run)
    if log is not None:
        append_run_log(spark, log, entry | {"status": "done"})
    return written


def load_serving_table(df: DataFrame, path: str, key: list[str], integers: list[str], log: str | None = None) -> int:
    """Replace a serving table: blanks null (0 in ``integers``, where other text fails the load), keys unique; the number of rows.

    The new table is built beside the old one and then takes its place. ``log`` is a run log that gets a row about the load.
    """
    typed = df
    for c in integers:
        text = F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
        bad = F.raise_error(F.concat(F.lit(f"{c} is no integer: "), text))
        typed = typed.withColumn(c, F.when(text == "", F.lit(0)).when(text.rlike("^-?[0-9]+$"), text.cast("long")).otherwise(bad))
    if not typed.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} is not unique")
    n = rebuild(typed, path, 0)
    if log is not None:
        append_run_log(df.sparkSession, log, {"table": path, "rows": n, "key": ",".join(key)})
    return n


def append_run_log(spark: SparkSession, path: str, row: dict) -> None:
    """Append one row about a run, all values as text; columns may differ from run to run."""
    spark.createDataFrame([{k: None if v is None else str(v) for k, v in row.items()}], ", ".join(f"`{k}` string" for k in row)).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def drop_expired(df: DataFrame, day_col: str, today: str, days: int = 400) -> DataFrame:
    """Rows of the last ``days`` days."""
    return df.where(F.col(day_col) > F.date_sub(F.lit(today).cast("date"), days))


def expire(spark: SparkSession, path: str, totals: str, today: str, keys: list[str], n: str = "n", days: int = 400) -> list[str]:
    """Take the day partitions (day=...) of a table of counters that are older than ``days`` away; the folders that went.

    Their counts are added to a table of totals first, by ``keys``, together with the last day that it covers. So a run that dies in
    between adds no day twice: the next one only takes away what is left. Whole folders go; no row of a day that stays is read or written.
    """
    limit = dt.date.fromisoformat(today) - dt.timedelta(days)
    old = [f for f in folders(spark, path) if f.startswith("day=") and f.removeprefix("day=") <= limit.isoformat()]
    recover(spark, totals)
    have = exists(spark, totals)
    through = spark.read.parquet(totals).agg(F.max("through")).first()[0] if have else None
    if fresh := [f for f in old if through is None or f.removeprefix("day=") > through.isoformat()]:
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in fresh]).select(*keys, F.col(n).cast("long").alias(n))
        if have:
            rows = rows.unionByName(spark.read.parquet(totals).select(*keys, n))
        last = F.lit(max(fresh).removeprefix("day=")).cast("date")
        rebuild(rows.groupBy(*keys).agg(F.sum(n).alias(n)).withColumn("through", last), totals, 0)
    for f in old:
        _delete(spark, f"{path}/{f}")
    return old


def all_time(spark: SparkSession, path: str, totals: str, keys: list[str], n: str = "n") -> DataFrame:
    """``keys`` and their counts of all time: of days that are there, and of those that have gone."""
    rows = spark.read.parquet(path).select("day", *keys, F.col(n).cast("long").alias(n)) if folders(spark, path) else None
    if exists(spark, totals):
        gone = spark.read.parquet(totals)
        before = gone.select(*keys, n)
        if rows is not None:  # a day that is counted among those gone may still be there after a crash
            last = F.broadcast(gone.agg(F.max("through").alias("through")))
            rows = rows.join(last).where(F.col("through").isNull() | (F.col("day") > F.col("through"))).drop("day", "through").unionByName(before)
        else:
            rows = before
    if rows is None:
        raise ValueError("there are no counters")
    return rows.groupBy(*keys).agg(F.sum(n).alias(n))
