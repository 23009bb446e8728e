"""A ledger of loaded files that batch jobs and streams share, so that each file of a folder is loaded once, gaps first and oldest first.

A file's rows are one partition of the store. They are written before the ledger says so: a run that dies in between loads the file
again into the same partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.sources.sinks import exists

ENTRY = "file_key string, status string, n_rows long, batch string, at timestamp"
#: What tells a file's day in its name.
DAY = r"(\d{4})-?(\d{2})-?(\d{2})"
#: Loads rows of some files; given the session and the files' paths, with a column file_key.
Reader = Callable[[SparkSession, list[str]], DataFrame]


def csv_reader(schema: str, **options) -> Reader:
    """Reads CSV files with a header by a schema."""
    return lambda spark, paths: spark.read.csv(paths, schema=schema, header=True, **options).withColumn("file_key", F.col("_metadata.file_name"))


def parquet_reader(schema: str) -> Reader:
    """Reads Parquet files by a schema; columns that a file lacks are null."""
    return lambda spark, paths: spark.read.schema(schema).parquet(*paths).withColumn("file_key", F.col("_metadata.file_name"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of each file."""
    if not exists(spark, path):
        return spark.createDataFrame([], ENTRY)
    rows = spark.read.schema(ENTRY).parquet(path)
    last = Window.partitionBy("file_key").orderBy(F.desc("at"), F.desc("batch"))
    return rows.withColumn("k_", F.row_number().over(last)).where("k_ = 1").drop("k_")


def listing(spark: SparkSession, folder: str, day: str = DAY) -> DataFrame:
    """file_key, path, day (null where the name tells none) of the files in a folder; contents are not read."""
    files = spark.read.format("binaryFile").load(folder).select(F.col("path"), F.regexp_extract("path", "([^/]*)$", 1).alias("file_key"))
    parts = [F.regexp_extract("file_key", day, k) for k in (1, 2, 3)]
    return files.select("file_key", "path", F.try_to_date(F.concat_ws("-", *parts), "yyyy-MM-dd").alias("day"))


def pending_files(spark: SparkSession, folder: str, ledger: str, most: int | None = None, day: str = DAY) -> DataFrame:
    """Files of a folder that are not loaded yet, or whose loading failed: the newest ``most`` of them, oldest first; undated ones come last."""
    held = read_ledger(spark, ledger).where("status = 'ok'").select("file_key")
    open_ = listing(spark, folder, day).join(held, "file_key", "left_anti")
    if most is not None:
        open_ = open_.orderBy(F.desc_nulls_last("day"), F.desc("file_key")).limit(most)
    return open_.orderBy(F.asc_nulls_last("day"), "file_key")


def missing_days(spark: SparkSession, folder: str, ledger: str, low: str, high: str, day: str = DAY) -> DataFrame:
    """Days of a range of which no file is loaded, and whether the folder has one."""
    from tallyline.operators.registry import calendar

    files = listing(spark, folder, day)
    held = files.join(read_ledger(spark, ledger).where("status = 'ok'"), "file_key", "left_semi").select("day")
    there = files.select("day", F.lit(True).alias("there")).distinct()
    return calendar(spark, low, high).join(held, "day", "left_anti").join(there, "day", "left").select("day", F.coalesce("there", F.lit(False)).alias("in_folder"))


def load(rows: DataFrame, keys: list[str], store: str, ledger: str, batch: str) -> None:
    """Write the rows of some files, one partition for each, in the place of what it had, and enter the files in the ledger."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_key").parquet(store)
    names = spark.createDataFrame([(k,) for k in keys], "file_key string")
    written = spark.read.parquet(store).join(names, "file_key", "left_semi").groupBy("file_key").agg(F.count("*").alias("n_rows")) if exists(spark, store) else None
    entries = names.withColumn("n_rows", F.lit(0).cast("long")) if written is None else names.join(written, "file_key", "left").fillna(0, ["n_rows"])
    enter(entries.withColumn("status", F.lit("ok")), ledger, batch)


def enter(entries: DataFrame, ledger: str, batch: str) -> None:
    """Append entries (file_key, status, n_rows) to the ledger."""
    entries.select("file_key", "status", "n_rows", F.lit(batch).alias("batch"), F.current_timestamp().alias("at")).coalesce(1).write.mode("append").parquet(ledger)


def repair(spark: SparkSession, folder: str, store: str, ledger: str, reader: Reader, most: int | None = None, together: int = 32, day: str = DAY) -> list[str]:
    """Load all files that are not loaded yet, oldest first, ``together`` in a job; the names of those loaded.

    If a job fails its files are tried one by one; one that fails again is entered as an error and is tried anew by the next run.
    """
    todo = [(r.file_key, r.path) for r in pending_files(spark, folder, ledger, most, day).collect()]  # names of new files
    done = []
    for k in range(0, len(todo), together):
        some = todo[k : k + together]
        try:
            load(reader(spark, [p for _, p in some]), [n for n, _ in some], store, ledger, "repair")
            done += [n for n, _ in some]
        except Exception:  # one file may spoil the job of all
            for name, path in some:
                try:
                    load(reader(spark, [path]), [name], store, ledger, "repair")
                    done.append(name)
                except Exception as e:
                    lost = spark.createDataFrame([(name, f"error: {str(e).splitlines()[0][:200]}", 0)], "file_key string, status string, n_rows long")
                    enter(lost, ledger, "repair")
    return done


def start_ingest(spark: SparkSession, folder: str, store: str, ledger: str, schema: str, checkpoint: str, kind: str = "parquet", most_files: int | None = None, every: str | None = None, **options):
    """Repair gaps, then load new files as they come, each once; the running query. Without ``every`` it ends with what is there now.

    Files that the ledger has, from a repair or from a batch that was run again, are left out.
    """
    reader = csv_reader(schema, **options) if kind == "csv" else parquet_reader(schema)
    repair(spark, folder, store, ledger, reader)
    source = spark.readStream.schema(schema)
    source = source if most_files is None else source.option("maxFilesPerTrigger", most_files)
    rows = source.csv(folder, header=True, **options) if kind == "csv" else source.parquet(folder)
    rows = rows.withColumn("file_key", F.col("_metadata.file_name"))

    def each(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        new = batch.join(read_ledger(own, ledger).where("status = 'ok'").select("file_key"), "file_key", "left_anti")
        keys = [r.file_key for r in new.select("file_key").distinct().collect()]  # files of one batch
        if keys:
            load(new, keys, store, ledger, f"stream-{number}")

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()
