"""A graph kept in buckets by record id, into which later graphs are put without rewriting all of it.

Folders below a path: ``rows`` (partitioned by bucket: a row for each record, and one for each of its attributes),
``filter`` (a Bloom filter of each bucket's ids: words of 64 bits, a row for each word that has a bit; later rows of a
word are or-ed with it) and ``settings`` (buckets, and words of a bucket's filter).

``upsert_graph`` gives what ``records.merge_graphs`` gives for the old graph and the new one: a record of the new graph
replaces the old one with all its attributes. Ids that the filter has never seen are surely new; the others are looked for
among the ids of their buckets. Buckets that have any are read, put together and written anew, and what goes into others is
only appended. A large bucket is written by several tasks (rebalanced), a file each. The filter is extended first, so an upsert that was interrupted may be run again. Attributes without a record are left out; null ids as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.shared import materialize
from loomgraph.operators.design import as_set

ROWS = "record_id string, pid string, kind string, key string, value string, value_type string, is_record boolean, bucket int"
FILTER = "word long, bits long, bucket int"
#: Bits that each id sets.
HASHES = 4


def _rows(records: DataFrame, attributes: DataFrame, buckets: int) -> DataFrame:
    """Rows of a graph in which an id stands for one record."""
    one = records.where("record_id is not null").groupBy("record_id").agg(F.max(F.struct("pid", "kind")).alias("own")).select("record_id", "own.pid", "own.kind")
    none = lambda *names: {n: F.lit(None).cast("string") for n in names}
    own = as_set(attributes.select("record_id", "key", "value", "value_type").join(one.select("record_id"), "record_id", "left_semi"))
    both = one.withColumns(none("key", "value", "value_type") | {"is_record": F.lit(True)}).unionByName(own.withColumns(none("pid", "kind") | {"is_record": F.lit(False)}))
    return both.withColumn("bucket", F.pmod(F.xxhash64("record_id"), F.lit(buckets)).cast("int"))


def _bits(ids: DataFrame, words: int) -> DataFrame:
    """record_id, bucket, word and bit: what each id sets in its bucket's filter."""
    places = F.array(*[F.pmod(F.xxhash64("record_id", F.lit(j)), F.lit(64 * words)) for j in range(HASHES)])
    return ids.select("record_id", "bucket", F.explode(places).alias("at")).select("record_id", "bucket", F.floor(F.col("at") / 64).alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit"))


def _add_to_filter(ids: DataFrame, words: int, path: str) -> None:
    _bits(ids, words).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits")).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/filter")


def _put(rows: DataFrame, mode: str, path: str) -> None:
    """Write rows into their buckets; a bucket that is too large for a task is split."""
    dealt = rows.hint("rebalance", F.col("bucket"))
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/rows")


def write_snapshot(records: DataFrame, attributes: DataFrame, path: str, *, buckets: int = 256, bits_of_id: int = 12) -> None:
    """Write a graph. bits_of_id: of the filter; with 12, about 1 of 150 new ids has its bucket rewritten for nothing."""
    spark = records.sparkSession
    rows = _rows(records, attributes, buckets)
    _put(rows, "errorifexists", path)
    ids = spark.read.schema(ROWS).parquet(f"{path}/rows").where("is_record").select("record_id", "bucket")
    words = max(1, -(-ids.count() * bits_of_id // (64 * buckets)))
    spark.createDataFrame([(buckets, words)], "buckets int, words int").write.parquet(f"{path}/settings")
    _add_to_filter(ids, words, path)


def maybe_known(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The rows of ids (record_id, bucket) that the filter may have seen: all that the snapshot has, and a few others."""
    words = spark.read.parquet(f"{path}/settings").first()["words"]
    seen = spark.read.schema(FILTER).parquet(f"{path}/filter").groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    met = _bits(ids, words).join(seen, ["bucket", "word"]).where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    return met.groupBy("record_id", "bucket").count().where(F.col("count") == HASHES).drop("count")


def upsert_graph(spark: SparkSession, path: str, records: DataFrame, attributes: DataFrame) -> list[int]:
    """Put a graph into the snapshot; returns the buckets that were written anew."""
    settings = spark.read.parquet(f"{path}/settings").first()
    new = materialize(_rows(records, attributes, settings["buckets"]), "new-rows")
    ids = new.where("is_record").select("record_id", "bucket")
    maybe = materialize(maybe_known(spark, path, ids), "maybe-known")
    buckets = lambda t: sorted(r["bucket"] for r in t.select("bucket").distinct().collect())  # noqa: E731  settings["buckets"] numbers at most
    there = spark.read.schema(ROWS).parquet(f"{path}/rows").where("is_record")
    likely = buckets(maybe)
    touched = buckets(maybe.join(there.where(F.col("bucket").isin(likely)).select("record_id", "bucket"), ["record_id", "bucket"], "left_semi")) if likely else []
    _add_to_filter(ids, settings["words"], path)
    if touched:
        old = spark.read.schema(ROWS).parquet(f"{path}/rows").where(F.col("bucket").isin(touched))
        merged = old.join(ids.select("record_id"), "record_id", "left_anti").unionByName(new.where(F.col("bucket").isin(touched)))
        _put(merged, "overwrite", path)  # dynamic: buckets are staged, and replace what was read when all are written
    rest = new.where(~F.col("bucket").isin(touched)) if touched else new
    _put(rest, "append", path)
    return touched


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of the whole graph."""
    rows = spark.read.schema(ROWS).parquet(f"{path}/rows")
    return rows.where("is_record").select("record_id", "pid", "kind"), rows.where("not is_record").select("record_id", "key", "value", "value_type")
