"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where it is unset, a local master gets a new folder
    of its own (tests), and a cluster stops: its executors wouldn't see each other's rows there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write a table there and read it again: the lineage ends, and a lost executor costs no earlier work."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """A table there in buckets of a key: what joins by this key, or groups by it and more, reads it where it lies."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", f"{shared_dir(spark)}/{table}").option("compression", "zstd").saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")  # the name alone: the files lie outside of the warehouse and stay
