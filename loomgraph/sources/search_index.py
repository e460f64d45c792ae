"""An index for searches of any text within ids and values: postings of runs of three characters.

Folders below a path: ``texts`` (id, text and parts: the distinct ids and values, lower-cased), ``owners`` (id, part and
record_id) and ``postings`` (g and id: each run of a text once, a text of fewer characters whole), sorted so that a reader
skips what it doesn't ask for. The owners of a text that many records say are dealt to so many parts, and a run of many
texts stands in several files, so no task gets all of a text or of a run. A search reads the postings of the runs that cover its text, keeps texts that have all of them, and looks
at these alone. A text of one or two characters is looked for in the runs themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.shared import materialize
from loomgraph.operators.graph import node_kind
from loomgraph.operators.postings import numbered

RUN = 3
#: Owners of a text that make a part.
OWNERS = 1_000_000


def write_index(records: DataFrame, attributes: DataFrame, path: str) -> None:
    """Index the ids of records, and the values of their attributes."""
    known = records.select("record_id").distinct()
    said = attributes.select("record_id", F.lower("value").alias("text")).join(known, "record_id", "left_semi").union(known.select("record_id", F.lower("record_id"))).where("text is not null").distinct()
    said = materialize(said, "said")
    parts = F.ceil(F.count("*") / OWNERS).cast("int").alias("parts")
    texts = numbered(said.groupBy("text").agg(parts))
    texts.repartitionByRange("id").sortWithinPartitions("id").write.parquet(f"{path}/texts")
    few, many = texts.where("parts = 1").select("text", "id", F.lit(0).alias("part")), texts.where("parts > 1")
    hot = materialize(many, "hot-texts")  # few: each stands for so many owners
    dealt = said.join(F.broadcast(hot.select("text", "parts")), "text", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("record_id"), "parts"), F.lit(0)).cast("int"))
    numbers = few.union(hot.select("text", "id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    owners = dealt.select("text", "part", "record_id").join(numbers, ["text", "part"]).select("id", "part", "record_id")
    owners.repartitionByRange("id", "part").sortWithinPartitions("id", "part").write.parquet(f"{path}/owners")
    of_text = F.array_distinct(F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{{RUN}}}))."), F.lit(1)))  # once a text, without a shuffle
    runs = texts.where(F.length("text") >= RUN).select(F.explode(of_text).alias("g"), "id").union(texts.where(F.length("text") < RUN).select("text", "id"))
    runs.repartitionByRange("g", "id").sortWithinPartitions("g", "id").write.parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame:
    """id of the texts that may hold a lower-cased text."""
    postings = spark.read.parquet(f"{path}/postings")
    if len(text) < RUN:
        return postings.where(F.contains("g", F.lit(text))).select("id").distinct()
    places = {*range(0, len(text) - RUN + 1, RUN), len(text) - RUN}
    runs = sorted({text[i : i + RUN] for i in places})
    return postings.where(F.col("g").isin(runs)).groupBy("id").count().where(F.col("count") == len(runs)).select("id")


def search_index(spark: SparkSession, path: str, text: str | None = None, kinds: tuple[str, ...] = ()) -> DataFrame:
    """record_id of the records of these kinds whose id or a value holds a text, in any case: as ``graph.search``."""
    owners = spark.read.parquet(f"{path}/owners")
    if text:
        low = text.lower()
        held = spark.read.parquet(f"{path}/texts").join(candidates(spark, path, low), "id", "left_semi").where(F.contains("text", F.lit(low)))
        dealt = held.select("id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        owners = owners.join(dealt, ["id", "part"], "left_semi")
    found = owners.select("record_id").distinct()
    return found.where(node_kind(F.col("record_id")).isin(*kinds)) if kinds else found
