"""Writers of record graphs and of identifier mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_pid(records: DataFrame) -> DataFrame:
    """records with pid filled: the record's own, or its id where there is none."""
    return records.withColumn("pid", F.coalesce(F.nullif(F.col("pid"), F.lit("")), F.col("record_id")))


def graph_lines(records: DataFrame, attributes: DataFrame) -> DataFrame:
    """record_id and value: the JSON text ``{id: {"record": [{"key", "value"}], "pid"}}`` of each record, pairs sorted."""
    # a record's own pairs
    pair = F.struct("key", "value", "value_type")
    sets = attributes.dropDuplicates(["record_id", "key", "value", "value_type"]).groupBy("record_id").agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
    typed = lambda p: F.concat(F.lit('{"key":'), _text(p["key"]), F.lit(',"value":'), _json(p), F.lit("}"))
    body = F.concat(F.lit("["), F.array_join(F.transform(F.coalesce("pairs", F.array().cast("array<struct<key: string, value: string, value_type: string>>")), typed), ","), F.lit("]"))
    whole = resolve_pid(records).join(sets, "record_id", "left")
    return whole.select("record_id", F.concat(F.lit("{"), _text(F.col("record_id")), F.lit(':{"record":'), body, F.lit(',"pid":'), _text(F.col("pid")), F.lit("}}")).alias("value"))


def _text(c: Column) -> Column:
    """A JSON string."""
    return F.to_json(c.cast("variant"))


def _json(p: Column) -> Column:
    """A JSON value of the pair's type."""
    number = F.to_json(p["value"].try_cast("double").cast("variant"))
    whole = p["value"].try_cast("bigint").cast("string")
    truth = p["value"].try_cast("boolean").cast("string")
    typed = F.when(p["value_type"] == "double", number).when(p["value_type"] == "long", whole).when(p["value_type"] == "boolean", truth)
    return F.coalesce(typed, _text(p["value"]))


def write_graph(records: DataFrame, attributes: DataFrame, path: str) -> None:
    """One line for each record."""
    graph_lines(records, attributes).select("value").write.text(path)


def apply_pid_mapping(records: DataFrame, attributes: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Put registered identifiers in place of local ids, in records and in values that point at them.

    mapping: record_id, pid. The third table counts records, mapped ones, and mappings without a record.
    """
    own = mapping.select(F.col("record_id"), F.col("pid").alias("new_pid")).dropDuplicates(["record_id"])
    renamed = records.join(own, "record_id", "left")
    new_records = renamed.select("record_id", F.coalesce("new_pid", "pid").alias("pid"), "kind")
    pointed = attributes.join(own.select(F.col("record_id").alias("value"), "new_pid"), "value", "left")
    new_attributes = pointed.select("record_id", "key", F.coalesce("new_pid", "value").alias("value"), "value_type")
    both = records.select("record_id", F.lit(1).alias("r")).join(own.select("record_id", F.lit(1).alias("m")), "record_id", "full")
    counts = both.agg(F.count("r").alias("records"), F.sum(F.when(F.col("r").isNotNull() & F.col("m").isNotNull(), 1).otherwise(0)).alias("mapped"), F.sum(F.when(F.col("r").isNull(), 1).otherwise(0)).alias("unknown"))
    return new_records, new_attributes, counts
