"""Stage boundaries: tables written to the folder that driver and executors share, so that a plan ends there and survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Temporary folders of local sessions that have none, by application.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session (a test) may have none; it then gets a temporary folder of its own.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:  # the setting cannot be changed in a session that runs
        _own[app] = tempfile.mkdtemp(prefix="spark-")
    return _own[app]


def staged(df: DataFrame, what: str = "stage") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back; the table is removed when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
