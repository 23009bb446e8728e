"""Shared helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.words import in_turn, steps
from tallyline.sources.staging import shared_dir

#: A word of a text: a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"


#: Copies of the other side where a join's key may hold most rows.
SALTS = 32


def join_salted(rows: DataFrame, side: DataFrame, on: list[str], salt: Column, how: str = "inner") -> DataFrame:
    """A join on keys of which one may hold most of ``rows``: each key is split SALTS ways by ``salt``, and ``side`` is copied to all of them."""
    left = rows.withColumn("salt_", F.pmod(salt, F.lit(SALTS)).cast("int"))
    right = side.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*on, "salt_"], how).drop("salt_")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that is not in use; it is removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


#: The setting by which a query's shuffle files are deleted at its end.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch() -> Iterator[Callable[..., None]]:
    """Tables that ``cut`` writes in this block are deleted at its end, but for those handed to what it yields: a result that is read later needs them."""
    held: list[DataFrame] = []
    kept: set[str] = set()
    _open.append(held)
    try:
        yield lambda *tables: kept.update(t.cut_at for t in tables)
    finally:
        _open.remove(held)
        discard(*(t for t in held if t.cut_at not in kept))
        if _open:
            _open[-1] += [t for t in held if t.cut_at in kept]


def comparable(df: DataFrame, prefix: str = "") -> list[Column]:
    """The columns of ``df`` (of a struct, with its name as ``prefix``) in forms that can be hashed and compared: those with a map as JSON text."""
    out = []
    for f in df.schema:
        c = F.col(prefix)[f.name] if prefix else F.col(f"`{f.name}`")
        out.append(F.to_json(F.struct(c.alias("m"))) if "map<" in f.dataType.simpleString() else c)
    return out


def cut(df: DataFrame, what: str = "cut") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage ends there and survives lost executors.

    Its shuffle files go once it is written; else they would stay until the driver's garbage happens to be collected.
    """
    spark = df.sparkSession
    path = new_path(spark, what)
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.cut_at = path
    if _open:
        _open[-1].append(back)
    return back


def discard_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once nothing reads them any more."""
    for df in tables:
        discard_path(df.sparkSession, df.cut_at)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def fold(doc_id: Column) -> Column:
    """0..3 from the id's text; 2 is the held-out fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)) % 4


def sample_per_class(rows: DataFrame, label: str, counts: DataFrame, key: list[str], most: int, seed: int = 0) -> DataFrame:
    """At most ``most`` rows of each class, the ones with the smallest seeded hash of their ``key``, so that reruns agree.

    ``counts`` (label, n) says about how many rows a class has. Of a large class only rows with a hash below a share of about twice
    ``most`` are looked at, so all classes are sampled in one pass over ``rows`` and no task holds more than that. Rows alike in key
    and class are one.
    """
    h = F.xxhash64(*key, F.lit(seed))
    share = F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30))
    low = rows.join(counts.withColumnRenamed("n", "n_"), label).where(share * F.col("n_") <= 2 * most + 64).drop("n_")
    each = low.dropDuplicates([label, *key])
    return each.withColumn("k_", F.row_number().over(Window.partitionBy(label).orderBy(h, *key))).where(F.col("k_") <= most).drop("k_")


def fitted(sample: DataFrame, order: list[str], owner: str, fit: Callable[[list[list]], pa.RecordBatch], schema: str) -> Row:
    """The one row that ``fit`` makes of the columns of a bounded sample, sorted by ``order``, which are left out.

    It runs in a task: neither the texts nor what a fit needs beside them take the driver's memory, only the model returns.
    """

    @in_turn(owner)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = []
        for batch in batches:
            columns = columns or [[] for _ in batch.columns]
            for held, column in zip(columns, batch.columns, strict=True):
                held += column.to_pylist()
        yield fit(columns or [[] for _ in range(width)])

    rows = sample.repartition(1).sortWithinPartitions(*order).drop(*order)
    width = len(rows.columns)
    found = rows.mapInArrow(run, schema).collect()
    if found:
        return found[0]
    return Row(**fit([[] for _ in range(width)]).to_pylist()[0])  # Spark runs no task where it sees that there are no rows


def marked(batch: pa.RecordBatch, text: int, keep: Callable[[pa.RecordBatch], list[bool]]) -> pa.RecordBatch:
    """The rows of a batch, as they are, for which ``keep`` of a slice (text without nulls) says so."""
    return batch.filter(pa.array([x for part in steps(batch, text) for x in keep(part)], pa.bool_()))
