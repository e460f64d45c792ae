"""Readers of landed files. Schemas are given, never inferred; order is kept with positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import schemas


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed repository records, one a line, bare or in an envelope ``hits.hits``; raw keeps the whole text."""
    text = spark.read.text(path).where(F.trim("value") != "")
    envelope = F.from_json("value", f"hits struct<hits: array<struct<{_fields(schemas.LANDED_RECORD)}>>>")
    one = F.from_json("value", schemas.LANDED_RECORD)
    many = F.when(F.get_json_object("value", "$.hits.hits").isNotNull(), envelope["hits"]["hits"]).otherwise(F.array(one))
    rows = text.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source_path"), F.posexplode(many).alias("record_pos", "r"))
    return rows.select("r.*", "raw", "source_path", "record_pos")


def _fields(schema: str) -> str:
    """Top-level fields of a DDL schema in the notation of a struct's fields."""
    from pyspark.sql.types import StructType

    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in StructType.fromDDL(schema))


def read_exports(spark: SparkSession, path: str) -> DataFrame:
    """One row per export creator, affiliation and identifier: recid, exp_pos, name, orcid, aff_pos, id_pos, scheme, identifier."""
    rows = spark.read.schema(schemas.EXPORT).json(path)
    creators = rows.select(F.col("id").alias("recid"), F.posexplode("metadata.creators").alias("exp_pos", "c"))
    orcid = F.get(F.filter("c.person_or_org.identifiers", lambda x: x["scheme"] == "orcid"), F.lit(0))["identifier"]
    named = creators.select("recid", "exp_pos", F.col("c.person_or_org.name").alias("name"), orcid.alias("orcid"), F.posexplode_outer("c.affiliations").alias("aff_pos", "a"))
    return named.select("recid", "exp_pos", "name", "orcid", "aff_pos", F.posexplode_outer("a.identifiers").alias("id_pos", "i")).select(
        "recid", "exp_pos", "name", "orcid", "aff_pos", "id_pos", F.col("i.scheme").alias("scheme"), F.col("i.identifier").alias("identifier")
    )


def read_affiliations(spark: SparkSession, path: str) -> DataFrame:
    """A researcher's organisations: orcid, seq (employments before educations), organization, organization_id, start_date, end_date."""
    rows = spark.read.schema(schemas.AFFILIATIONS).json(path)
    each = []
    for kind, column in enumerate(("employment-summary", "education-summary")):
        one = rows.select("orcid", F.posexplode(F.col(f"`{column}`")).alias("pos", "a"))
        each.append(one.select("orcid", (F.lit(kind) * 1_000_000 + F.col("pos")).cast("long").alias("seq"), "a"))
    both = each[0].unionByName(each[1])
    identifier = F.col("a.organization.disambiguated_organization.disambiguated_organization_identifier")
    return both.select(
        "orcid", "seq", F.col("a.organization.name").alias("organization"), identifier.alias("organization_id"),
        F.col("a.start_date.value").alias("start_date"), F.col("a.end_date.value").alias("end_date"),
    )


def read_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of ``.json`` files, whole: source_path, text and doc (variant); empty or unreadable ones are errors."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    parsed = files.select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"), F.try_parse_json("value").alias("doc"))
    message = F.when(F.trim("text") == "", "empty file").when(F.col("doc").isNull(), "not JSON")
    judged = parsed.withColumn("message", message)
    return judged.where("message is null").drop("message"), judged.where("message is not null").select("source_path", "message")


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated sheets, whole, with bad bytes replaced: source_path and content."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("source_path"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))


def read_type_registry(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """profile_properties, info_types and basic_type_rules of a registry folder with profiles, info_types and basic_info_types."""
    inner = "Name: string, Type: string, Property: string, Value: variant, Properties: struct<Cardinality: string>"
    schema = f"Identifier string, name string, Schema struct<Type: string, Properties: array<struct<{inner}>>>"

    def load(kind: str) -> DataFrame:
        text = spark.read.option("pathGlobFilter", "*.json").text(f"{folder}/{kind}", wholetext=True)
        parsed = text.select(F.from_json("value", schema).alias("j"), F.get_json_object("value", "$.identifier").alias("lower"))
        return parsed.select(F.coalesce("j.Identifier", "lower").alias("pid"), F.col("j.name").alias("name"), F.col("j.Schema").alias("s"))

    profiles = load("profiles").select(F.col("pid").alias("profile_pid"), F.col("name").alias("profile_name"), F.explode("s.Properties").alias("p"))
    parts = F.split(F.col("p.Properties.Cardinality"), " - ")
    top = F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))
    properties = profiles.select(
        "profile_pid", "profile_name", F.col("p.Name").alias("property"), F.col("p.Type").alias("infotype_pid"),
        F.get(parts, F.lit(0)).try_cast("int").alias("min_count"), F.when(top != "n", top.try_cast("int")).alias("max_count"),
    )
    infos = load("info_types").select("pid", "name", F.get("s.Properties", F.lit(0))["Type"].alias("basic_type_pid"))
    basics = load("basic_info_types").select("pid", "name", F.col("s.Type").alias("kind"), "s")
    rule = lambda n, t: F.try_variant_get(F.get(F.filter("s.Properties", lambda x: x["Property"] == n), F.lit(0))["Value"], "$", t)
    rules = basics.select("pid", "name", "kind", rule("pattern", "string").alias("pattern"), rule("minimum", "double").alias("minimum"), rule("maximum", "double").alias("maximum"), rule("enum", "array<string>").alias("enum"))
    return {"profile_properties": properties, "info_types": infos, "basic_type_rules": rules}


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of exported graphs: each text line maps record ids to their pairs and pid."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    typed = F.from_json("value", "map<string, struct<record: array<struct<key: string, value: variant>>, pid: string>>")
    plain = F.from_json("value", "map<string, struct<record: array<struct<key: string, value: string>>, pid: string>>")
    entries = lines.select(F.explode(F.map_zip_with(typed, plain, lambda _, t, p: F.struct(t.alias("t"), p.alias("p")))).alias("record_id", "e"))
    records = entries.select("record_id", F.col("e.p.pid").alias("pid"), F.lit(None).cast("string").alias("kind"))
    pairs = entries.select("record_id", F.explode(F.arrays_zip(F.col("e.t.record").alias("t"), F.col("e.p.record").alias("p"))).alias("x"))
    kind = F.schema_of_variant("x.t.value")
    value_type = F.when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "double").when(kind == "BIGINT", "long").when(kind == "BOOLEAN", "boolean").otherwise("string")
    # the text of numbers comes from the second reading: a variant forgets that 980.0 had a decimal point
    attributes = pairs.select("record_id", F.col("x.p.key").alias("key"), F.col("x.p.value").alias("value"), value_type.alias("value_type")).where("value is not null")
    return records, attributes
