"""The given tables in the shapes that operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 16, F.lit("0"))


def document_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents as files: a language is a concept, a source a version of it, equal texts are equal files."""
    return table(spark, d, "documents").select(
        F.col("lang").alias("concept"), F.concat_ws("/", "lang", "source").alias("version_doi"), F.substring("source", 4, 9).cast("int").alias("ordinal"), F.col("doc_id").alias("pos"),
        F.concat(F.lit("md5:"), F.md5("text")).alias("checksum"), F.concat(F.lit("doc"), "doc_id", F.lit(".txt")).alias("filename"), F.col("n_chars").alias("size"),
        F.lit("text/plain").alias("mimetype"), F.concat(F.lit("https://files.example/"), "doc_id").alias("download_url"),
    )


def turns(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as versions of a concept."""
    own = table(spark, d, "conversations")
    return own.select(F.col("conv_id").alias("concept"), F.concat_ws(".", "conv_id", "turn").alias("version_doi"), F.col("turn").cast("string").alias("version_label"), F.col("turn").alias("input_pos"), "role", "text")


def landed(spark: SparkSession, d: str) -> DataFrame:
    """Orders as landed records, with their lines as files (the lines of one order at most) and customers as creators."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")  # both grow with the orders: neither is broadcast
    key = F.col("o_orderkey")
    file = lambda x: F.struct(
        F.concat(F.lit("part"), x["l_partkey"].cast("string"), F.lit(".csv")).alias("key"), x["l_quantity"].cast("bigint").alias("size"),
        F.when(x["l_partkey"] % 2 == 0, F.md5(x["l_partkey"].cast("string"))).otherwise(F.concat(F.lit("md5:"), F.md5(x["l_partkey"].cast("string")))).alias("checksum"),
        F.lit("text/csv").alias("mimetype"), F.struct(F.when(x["l_partkey"] % 3 > 0, F.concat(F.lit("https://l/"), x["l_partkey"].cast("string"))).alias("self")).alias("links"),
    )
    creator = F.struct(F.when(key % 5 > 0, F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("affiliation"), F.when(key % 2 == 0, digits(F.col("c_custkey"))).otherwise(F.concat(F.lit("https://orcid.org/"), digits(F.col("c_custkey")))).alias("orcid"))
    related = lambda id_, relation: F.struct(id_.alias("identifier"), relation.alias("relation"), F.lit(None).cast("string").alias("resource_type"), F.lit("doi").alias("scheme"))
    metadata = F.struct(
        F.concat(F.lit("10.5281/zenodo."), key.cast("string")).alias("doi"), F.when(key % 7 > 0, F.col("o_orderpriority")).alias("title"), F.lit(None).cast("string").alias("description"),
        F.when(key % 3 > 0, F.col("o_orderstatus")).alias("version"), F.when(key % 11 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("no date")).alias("publication_date"),
        F.struct(F.when(key % 2 == 0, F.lit("cc-by")).alias("id"), F.lit(None).cast("string").alias("title"), F.when(key % 2 == 0, F.lit("https://l.example/cc-by")).alias("url")).alias("license"),
        F.array("o_orderpriority").alias("keywords"), F.array(creator).alias("creators"),
        F.array(related(F.concat(F.lit("10.5281/zenodo."), (key + 1).cast("string")), F.lit("cites")), related(F.concat(F.lit("10.1/"), F.col("o_custkey").cast("string")), F.when(key % 4 == 0, F.lit("unknown")).otherwise(F.lit("references")))).alias("related_identifiers"),
        F.array(F.struct(F.col("o_orderstatus").alias("code"), F.lit(None).cast("string").alias("title"), F.struct(F.col("c_mktsegment").alias("name")).alias("funder"), F.lit(None).cast("string").alias("internal_id"))).alias("grants"),
        F.array(F.struct(F.lit(None).cast("string").alias("id"), F.col("c_mktsegment").alias("slug"), F.lit(None).cast("string").alias("name"))).alias("communities"),
    )
    return rows.select(key.alias("id"), F.when(key % 4 > 0, F.concat(F.lit("c/"), F.col("o_custkey").cast("string"))).alias("conceptdoi"), F.when(key % 4 > 0, F.col("o_custkey").cast("string")).alias("conceptrecid"), metadata.alias("metadata"), F.transform("lines", file).alias("files"))


def trade_graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders, customers, nations and regions as a record graph: (records, attributes)."""
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    name = lambda p, k: F.concat(F.lit(f"{p}:"), F.col(k).cast("string"))
    record = lambda t, p, k: t.select(name(p, k).alias("record_id"), F.lit("").alias("pid"), F.lit(p).alias("kind"))
    records = record(o, "o", "o_orderkey").union(record(c, "c", "c_custkey")).union(record(n, "n", "n_nationkey")).union(record(r, "r", "r_regionkey"))
    pair = lambda t, s, key, v: t.select(s.alias("record_id"), F.lit(key).alias("key"), v.alias("value"), F.lit("string").alias("value_type"))
    attributes = (
        pair(o, name("o", "o_orderkey"), "isPartOf", name("c", "o_custkey"))
        .union(pair(o, name("o", "o_orderkey"), "profile", F.col("o_orderstatus")))
        .union(pair(o, name("o", "o_orderkey"), "keyword", F.col("o_orderpriority")))
        .union(pair(c, name("c", "c_custkey"), "references", name("n", "c_nationkey")))
        .union(pair(c, name("c", "c_custkey"), "name", F.col("c_name")))
        .union(pair(c, name("c", "c_custkey"), "profile", F.lit("customer")))
        .union(pair(n, name("n", "n_nationkey"), "cites", name("r", "n_regionkey")))
        .union(pair(n, name("n", "n_nationkey"), "cites", F.lit("nowhere")))
    )
    return records, attributes


TRADE_SQL = """
records AS (SELECT 'o:' || o_orderkey AS record_id FROM orders UNION ALL SELECT 'c:' || c_custkey FROM customer UNION ALL SELECT 'n:' || n_nationkey FROM nation UNION ALL SELECT 'r:' || r_regionkey FROM region),
attributes AS (SELECT 'o:' || o_orderkey AS record_id, 'isPartOf' AS key, 'c:' || o_custkey AS value FROM orders
  UNION SELECT 'o:' || o_orderkey, 'profile', o_orderstatus FROM orders UNION SELECT 'o:' || o_orderkey, 'keyword', o_orderpriority FROM orders
  UNION SELECT 'c:' || c_custkey, 'references', 'n:' || c_nationkey FROM customer UNION SELECT 'c:' || c_custkey, 'name', c_name FROM customer UNION SELECT 'c:' || c_custkey, 'profile', 'customer' FROM customer
  UNION SELECT 'n:' || n_nationkey, 'cites', 'r:' || n_regionkey FROM nation UNION SELECT 'n:' || n_nationkey, 'cites', 'nowhere' FROM nation)"""
