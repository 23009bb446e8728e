"""Readers: explicit schemas by position or by name, blanks as null, rows that are too short counted and left out."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AWARD_COLUMNS = ["item_no", "title", "award_date", "price", "ministry_cd", "method_cd", "winner_name", "corporate_number"]

# The 30 positions of a registry file and their names; those without a name are left out.
REGISTRY_LAYOUT: list[tuple[int, str | None]] = [
    (0, "sequence_number"),
    (1, "corporate_number"),
    (2, "process_code"),
    (3, "correct_flag"),
    (4, "update_date"),
    (5, "change_date"),
    (6, "name"),
    (7, "name_image_id"),
    (8, "kind_code"),
    (9, "prefecture"),
    (10, "city"),
    (11, "street_number"),
    (12, None),
    (13, "prefecture_code"),
    (14, "city_code"),
    (15, "post_code"),
    (16, None),
    (17, None),
    (18, "close_date"),
    (19, "close_cause"),
    (20, "successor_corporate_number"),
    (21, "change_cause"),
    (22, "assignment_date"),
    (23, "latest_flag"),
    (24, None),
    (25, None),
    (26, None),
    (27, None),
    (28, "furigana"),
    (29, "hidden_flag"),
]
BASELINE_COLUMNS = ["corporate_number", "prefecture_code", "prefecture", "city", "kind_code", "close_date"]
PROVENANCE_COLUMNS = ["source_id", "retrieved_at"]
POSTING_FIELDS = ["job_id", "title", "location", "url", "created_at", "updated_at", "commitment", "team"]


def _positional(spark: SparkSession, path: str, layout: list[str | None], least: int) -> DataFrame:
    """Headerless quoted CSV by position; positions without a name are left out. Cells are trimmed, blanks null; rows of fewer than ``least`` cells go."""
    columns = [c or f"_{i}" for i, c in enumerate(layout)]
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _bad string"
    rows = spark.read.csv(path, schema=schema, header=False, quote='"', escape='"', multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    cells = rows.select("*", F.col("_metadata.file_name").alias("file_key"))
    # a short row lacks its last columns; its text says how many cells there were
    count = F.size(F.split(F.col("_bad"), r",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"))
    whole = cells.where(F.col("_bad").isNull() | (count >= least))
    clean = [F.nullif(F.trim(F.regexp_replace(c, "^\\uFEFF", "")), F.lit("")).alias(c) for c in filter(None, layout)]
    return whole.select(*clean, "file_key")


def read_awards(spark: SparkSession, path: str) -> DataFrame:
    """Award files: 8 columns by position, the last optional."""
    return _positional(spark, path, AWARD_COLUMNS, 7)


def read_registry_diff(spark: SparkSession, path: str) -> DataFrame:
    """Registry changes: 30 columns by position, those that are not allowed left out."""
    return _positional(spark, path, [name for _, name in REGISTRY_LAYOUT], 24)


def read_registry_baseline(spark: SparkSession, path: str, source_id: str | None = None, retrieved_at: str | None = None) -> DataFrame:
    """The registry's full dump, in the columns that a lookup needs, with where and when it came from; other columns are pruned."""
    origin = [F.lit(v).cast("string").alias(c) for c, v in zip(PROVENANCE_COLUMNS, (source_id, retrieved_at), strict=True)]
    return read_registry_diff(spark, path).select(*BASELINE_COLUMNS, *origin)


def read_changes(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """The store of normalised changes, partitioned by file_month; ``months`` prunes partitions. Columns of natural persons stop the read."""
    from tallyline.operators.masking import assert_no_registry_persons

    rows = assert_no_registry_persons(spark.read.parquet(root))
    return rows if months is None else rows.where(F.col("file_month").isin(months))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest with a header; rows whose status is ok or blank."""
    rows = spark.read.csv(path, header=True)
    return rows if "status" not in rows.columns else rows.where(F.coalesce(F.trim("status"), F.lit("")).isin("ok", ""))


def read_postings(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Posting payloads, one JSON document a file: ``object`` (jobs in a field) or ``array``. Fields not asked for are never parsed.

    A payload of another shape fails the job.
    """
    text = spark.read.text(path, wholetext=True)
    if kind == "object":
        shape = "struct<jobs: array<struct<id: string, title: string, location: struct<name: string>, absolute_url: string, updated_at: string>>>"
        jobs = F.from_json("value", shape)["jobs"]
        pick = ["j.id", "j.title", "j.location.name", "j.absolute_url", "null", "j.updated_at", "null", "null"]
    elif kind == "array":
        shape = (
            "array<struct<id: string, text: string, hostedUrl: string, createdAt: string, updatedAt: string, "
            "categories: struct<location: string, team: string, commitment: string>>>"
        )
        jobs = F.when(F.ltrim("value").startswith("["), F.from_json("value", shape))
        pick = ["j.id", "j.text", "j.categories.location", "j.hostedUrl", "j.createdAt", "j.updatedAt", "j.categories.commitment", "j.categories.team"]
    else:
        raise ValueError("kind must be object or array")
    checked = F.when(jobs.isNotNull(), jobs).otherwise(F.raise_error(F.lit(f"payload is no {kind} of jobs")))
    rows = text.select(F.col("_metadata.file_name").alias("file_key"), F.explode(checked).alias("j"))
    return rows.selectExpr("file_key", *[f"cast({p} as string) as {n}" for p, n in zip(pick, POSTING_FIELDS, strict=True)])


def read_day_summary(spark: SparkSession, path: str) -> DataFrame:
    """A published day summary (nested JSON) as day, axis, key, n."""
    counts = "map<string, bigint>"
    shape = f"struct<days: map<string, struct<records: bigint, process_codes: {counts}, kind_codes: {counts}, prefectures: {counts}>>>"
    days = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", shape)["days"]).alias("day", "v"))
    parts = [days.select("day", F.lit("total").alias("axis"), F.lit("").alias("key"), F.col("v.records").alias("n"))]
    for axis, field in (("process", "process_codes"), ("kind", "kind_codes"), ("prefecture", "prefectures")):
        parts.append(days.select("day", F.lit(axis).alias("axis"), F.explode(f"v.{field}").alias("key", "n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("day", F.col("day").cast("date"))


def read_stats(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    """A statistics table with a typed schema; missing columns or ones that name parties stop the job."""
    from tallyline.operators.masking import assert_not_directory

    header = spark.read.csv(path, header=True).columns
    if absent := [c for c in required if c not in header]:
        raise ValueError(f"columns are missing: {absent}")
    assert_not_directory(spark.read.csv(path, header=True))
    return spark.read.csv(path, header=True, schema=schema)


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files that a path, a folder or a glob stands for, hidden ones left out, in order of their names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out, open_ = [], list(fs.globStatus(at) or [])
    while open_:
        status = open_.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            open_ += [x for x in fs.listStatus(status.getPath()) if not x.getPath().getName().startswith(("_", "."))]
        elif not name.startswith(("_", ".")):
            out.append(status.getPath().toString())
    if not out:
        raise ValueError(f"no files: {path}")
    return sorted(out)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first line of a CSV file, compressed or not; nothing else of it is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        return [c.strip() for c in next(csv.reader([(lines.readLine() or "").removeprefix("\ufeff")]), [])]
    finally:
        stream.close()


def union_files(spark: SparkSession, paths: list[str], kind: str = "csv", columns: dict[str, str] | None = None) -> DataFrame:
    """Rows of many files whose columns differ, put together by name, with ``file_key``: the file, or the folder given, that a row comes from.

    ``columns`` (name -> type) are the ones wanted; without it all that any file has, in the order of their first appearance. Columns that a
    file lacks are null there, others are never read. Only names (of Parquet also types) are looked at first, one file after the other; files alike
    in them are then one read. CSV cells are trimmed, blanks null; values that do not fit a wanted type are null. A column named like one of a
    natural person, wanted or not, stops the job before a row is read.
    """
    from tallyline.operators.masking import refuse_registry_persons

    if kind not in ("csv", "parquet"):
        raise ValueError("kind must be csv or parquet")
    layouts: dict[tuple, list[str]] = {}
    types: dict[str, str] = {}
    folders = set()
    for given in paths:
        for file in files_of(spark, given):
            if kind == "csv":
                layout = tuple((c, "string") for c in header_of(spark, file))
            else:
                layout = tuple((f.name, f.dataType.simpleString()) for f in spark.read.parquet(file).schema)
            refuse_registry_persons([c for c, _ in layout])
            layouts.setdefault(layout, []).append(file)
            for c, t in layout:
                types.setdefault(c, t)
            name = given.rstrip("/").rsplit("/", 1)[-1]
            if not file.endswith(f"/{name}"):
                folders.add(name)
    wanted = types if columns is None else columns
    last = F.regexp_extract("_metadata.file_path", "([^/]*)$", 1)
    within = F.regexp_extract("_metadata.file_path", f"/({'|'.join(map(re.escape, sorted(folders)))})/", 1) if folders else F.lit("")
    out = None
    for layout, files in layouts.items():
        if kind == "csv":
            rows = spark.read.csv(files, header=True, schema=", ".join(f"`{c}` string" for c, _ in layout), quote='"', escape='"', multiLine=True)
            cell = lambda c: F.nullif(F.trim(c), F.lit(""))
        else:
            rows, cell = spark.read.parquet(*files), F.col
        has = {c for c, _ in layout}
        typed = [(cell(f"`{c}`").try_cast(t) if kind == "csv" else F.col(f"`{c}`").cast(t)).alias(c) if c in has else F.lit(None).cast(t).alias(c) for c, t in wanted.items()]
        part = rows.select(*typed, F.coalesce(F.nullif(within, F.lit("")), last).alias("file_key"))
        out = part if out is None else out.unionByName(part)
    return out
