"""Constraints: validation with quarantine, identity, and conformance to profiles and value types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.columns import is_emptyish
from loomgraph.functions.vocabulary import GENERAL_TYPES, RELATIONS

# What valid identifiers look like.
DOI = r"(?i)^10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+$"
ORCID_URL = r"^https://orcid\.org/[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]$"
ROR = r"^https://ror\.org/0[a-z0-9]{6,8}$"
CHECKSUM = r"^md5:[a-f0-9]{32}$"


def breaks(pattern: str, c: Column) -> Column:
    """Set, and not of the pattern."""
    return c.isNotNull() & ~c.rlike(pattern)


def rules_for(columns: dict[str, Column]) -> dict[str, Column]:
    """The usual rules for those of doi, orcid, ror, checksum, size, relation, resource_type and versions that are given;
    each is true where a row breaks it."""
    known = {
        "doi": lambda c: breaks(DOI, c),
        "orcid": lambda c: breaks(ORCID_URL, c),
        "ror": lambda c: breaks(ROR, c),
        "checksum": lambda c: breaks(CHECKSUM, c),
        "size": lambda c: c <= 0,
        "relation": lambda c: ~c.isin(*RELATIONS),
        "resource_type": lambda c: ~c.isin(*GENERAL_TYPES),
        "versions": lambda c: F.coalesce(c, F.lit(0)) < 1,
    }
    return {name: known[name](c) for name, c in columns.items()}


def violations(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks, in their order; unknown counts as kept."""
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in rules.items()]))


def validate(df: DataFrame, rules: dict[str, Column], *, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows carry the names of the rules they break, or fail the job."""
    judged = df.withColumn("violations", violations(rules))
    if fail_fast:
        judged = fail_if(judged, F.size("violations") > 0, F.concat(F.lit("broken rules: "), F.array_join("violations", ", ")))
    return judged.where(F.size("violations") == 0).drop("violations"), judged.where(F.size("violations") > 0)


def fail_if(df: DataFrame, condition: Column, message: Column | str = "") -> DataFrame:
    """df, whose evaluation fails with a message at the first row for which the condition holds."""
    text = F.lit(message) if isinstance(message, str) else message
    text = F.when(is_emptyish(text), F.lit("a condition that stops the job holds")).otherwise(text)
    return df.where(F.when(F.coalesce(condition, F.lit(False)), F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))


def check_identity(records: DataFrame, *, fail_fast: bool = False) -> DataFrame:
    """(problem, value, n): empty ids, ids that repeat, and pids that repeat although they aren't empty."""
    empty = records.where(is_emptyish(F.col("record_id"))).select(F.lit("empty id").alias("problem"), F.col("record_id").alias("value")).groupBy("problem", "value").agg(F.count("*").alias("n"))
    again = lambda c, name: records.where(~is_emptyish(F.col(c))).groupBy(F.lit(name).alias("problem"), F.col(c).alias("value")).agg(F.count("*").alias("n")).where("n > 1")
    found = empty.unionByName(again("record_id", "repeated id")).unionByName(again("pid", "repeated pid"))
    return fail_if(found, F.lit(True), F.concat_ws(": ", "problem", "value")) if fail_fast else found


def check_profiles(attributes: DataFrame, profile_properties: DataFrame, profile_key: str = "profile") -> DataFrame:
    """record_id, profile_pid, key, n: keys that a declared profile wants more or less often than the record has them.

    profile_properties: profile_pid, key, min_count, max_count (null: any number); small, and broadcast.
    Pairs are counted for each record and key before they meet the profiles.
    """
    declared = attributes.where(F.col("key") == profile_key).select("record_id", F.col("value").alias("profile_pid")).distinct()
    wanted = declared.join(F.broadcast(profile_properties), "profile_pid")
    counts = attributes.groupBy("record_id", "key").agg(F.count("*").alias("n"))
    met = wanted.join(counts, ["record_id", "key"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return met.where("n < min_count or n > max_count").select("record_id", "profile_pid", "key", "n")


def check_values(attributes: DataFrame, value_rules: DataFrame) -> DataFrame:
    """record_id, key, value, problem: values outside the pattern, range or list of their key's basic type.

    value_rules: key, pattern, minimum, maximum, enum (each may be null); small, and broadcast, as few keys have most rows. Nothing is dropped: this reports.
    """
    met = attributes.join(F.broadcast(value_rules), "key")
    number = F.col("value").try_cast("double")
    ranged = F.col("minimum").isNotNull() | F.col("maximum").isNotNull()
    outside = ranged & (number.isNull() | F.coalesce(number < F.col("minimum"), F.lit(False)) | F.coalesce(number > F.col("maximum"), F.lit(False)))
    problem = (
        F.when(F.col("pattern").isNotNull() & ~F.regexp_like("value", F.col("pattern")), "pattern")
        .when(outside, "range")
        .when(F.col("enum").isNotNull() & ~F.array_contains("enum", F.col("value")), "enum")
    )
    return met.withColumn("problem", problem).where("problem is not null").select("record_id", "key", "value", "problem")


def value_rules(registry: dict[str, DataFrame]) -> DataFrame:
    """The value rules of a registry's keys, by the key's identifier."""
    return registry["info_types"].select(F.col("pid").alias("key"), F.col("basic_type_pid")).join(registry["basic_type_rules"].select(F.col("pid").alias("basic_type_pid"), "pattern", "minimum", "maximum", "enum"), "basic_type_pid").drop("basic_type_pid")
