"""Designs: declarative projections from documents to records and attribute rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.columns import number_text


@dataclass(frozen=True)
class Entry:
    """A key and the expression of its value or values (an array if many). Null values give no attribute."""

    key: str
    value: Column
    value_type: str = "string"
    many: bool = False


@dataclass(frozen=True)
class Design:
    """How one kind of document becomes a record. Several entries may share a key.

    Write expressions over JSON with try_variant_get, so that a missing path or another type skips the attribute, while
    a malformed path fails the job.
    """

    record_id: Column
    entries: Sequence[Entry]
    pid: Column | None = None
    skip: Column | None = None
    kind: str = ""
    backlinks: Sequence[tuple[str, str]] = field(default=())


def pairs(entries: Sequence[Entry], *, once: bool = False) -> Column:
    """All entries as one array of (key, value, value_type); with once, an entry has each of its values once."""

    def one(e: Entry) -> Column:
        text = (lambda v: number_text(v)) if e.value_type == "double" else (lambda v: v.cast("string"))
        make = lambda v: F.struct(F.lit(e.key).alias("key"), text(v).alias("value"), F.lit(e.value_type).alias("value_type"))
        none = F.array().cast("array<struct<key: string, value: string, value_type: string>>")
        values = F.array_distinct(e.value) if e.many and once else e.value
        return F.coalesce(F.transform(values, make), none) if e.many else F.array(make(e.value))

    return F.flatten(F.array(*map(one, entries)))


def attribute_rows(df: DataFrame, record_id: Column, entries: Sequence[Entry], *, alone: Column | None = None) -> DataFrame:
    """record_id, key, value, value_type: the set of all non-null values.

    alone: true for rows whose id no other row has. Their values are a set within the row, so they aren't dealt; keys of
    the entries differ then, and arrays are of strings."""

    def rows(own: DataFrame, once: bool) -> DataFrame:
        made = own.select(record_id.alias("record_id"), F.explode(pairs(entries, once=once)).alias("p")).select("record_id", "p.*")
        return made.where("record_id is not null and value is not null")

    if alone is None:
        return as_set(rows(df, False))
    if len({e.key for e in entries}) < len(entries) or any(e.many and e.value_type != "string" for e in entries):
        raise ValueError("rows are sets by themselves only where keys differ and arrays are of strings")
    return rows(df.where(alone), True).unionByName(as_set(rows(df.where(~alone), False)))


def as_set(attributes: DataFrame) -> DataFrame:
    """Each pair once a record; values of different types are different."""
    return attributes.dropDuplicates(["record_id", "key", "value", "value_type"])


def contains(attributes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of wanted (record_id, key, value) that the attributes hold."""
    return wanted.join(attributes, ["record_id", "key", "value"], "left_semi")


def apply_design(docs: DataFrame, design: Design) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of the documents that the design doesn't skip."""
    kept = docs if design.skip is None else docs.where(~F.coalesce(design.skip, F.lit(False)))
    pid = F.lit("") if design.pid is None else F.coalesce(design.pid.cast("string"), F.lit(""))
    records = kept.select(design.record_id.cast("string").alias("record_id"), pid.alias("pid"), F.lit(design.kind).alias("kind"))
    return records, attribute_rows(kept, design.record_id.cast("string"), design.entries)


def run_designs(docs: DataFrame, designs: Sequence[Design]) -> tuple[DataFrame, DataFrame]:
    """Every design applied to every document. Records and attributes each read the documents once: what all designs make
    of a document is one array, exploded."""

    def each(make: Callable[[Design, Column], Column]) -> Column:
        """An array of what each design that doesn't skip the document makes of it."""
        made = [F.when(~F.coalesce(d.skip, F.lit(False)), make(d, d.record_id.cast("string"))) if d.skip is not None else make(d, d.record_id.cast("string")) for d in designs]
        return F.filter(F.array(*made), lambda m: m.isNotNull())

    pid = lambda d: F.lit("") if d.pid is None else F.coalesce(d.pid.cast("string"), F.lit(""))
    record = lambda d, i: F.struct(i.alias("record_id"), pid(d).alias("pid"), F.lit(d.kind).alias("kind"))
    own = lambda d, i: F.struct(i.alias("record_id"), pairs(d.entries).alias("pairs"))
    records = docs.select(F.explode(each(record)).alias("r")).select("r.record_id", "r.pid", "r.kind")
    made = docs.select(F.explode(each(own)).alias("r")).select("r.record_id", F.explode("r.pairs").alias("p")).select("record_id", "p.*")
    return records, as_set(made.where("record_id is not null and value is not null"))
