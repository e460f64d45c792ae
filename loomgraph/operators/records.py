"""Record construction: contracts become records and attribute rows, and graphs are merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.columns import clean_text, number_text
from loomgraph.functions.shared import materialize
from loomgraph.functions.vocabulary import PROFILES
from loomgraph.operators.design import Entry, as_set, attribute_rows
from loomgraph.operators.matching import not_yet_linked

PROFILE = "profile"


def profiles(*names: str) -> Entry:
    return Entry(PROFILE, F.array(*[F.lit(PROFILES[n]) for n in names]), many=True)


def some(key: str, column: str) -> Entry:
    """A value that is left out if it is empty."""
    return Entry(key, F.nullif(F.col(column).cast("string"), F.lit("")))


def all_of(key: str, column: str) -> Entry:
    return Entry(key, F.col(column), many=True)


def _records(inputs: DataFrame, record_id: str, kind: str) -> DataFrame:
    return inputs.select(F.col(record_id).alias("record_id"), F.lit("").alias("pid"), F.lit(kind).alias("kind"))


def dataset_records(inputs: DataFrame, *, alone: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of dataset contracts; a record is a version, its id the version's DOI. alone: true for
    contracts whose DOI no other has, which aren't dealt."""
    of = lambda f: F.filter(F.transform("creators", lambda c: c[f]), lambda x: x != "")
    entries = [
        profiles("Base", "Versionable"),
        Entry("name", F.col("title")),
        Entry("description", F.when(F.col("description") != "", clean_text(F.col("description")))),
        Entry("dateCreated", F.date_format("publication_date", "yyyy-MM-dd")),
        Entry("creator", of("orcid"), many=True),
        Entry("creatorAffiliation", of("ror_id"), many=True),
        all_of("keyword", "keywords"),
        Entry("version", F.col("version_label")),
        some("previousVersion", "previous_version_doi"),
        some("nextVersion", "next_version_doi"),
        Entry("latestVersion", F.when(F.col("latest_version_doi") != F.col("doi"), F.nullif(F.col("latest_version_doi"), F.lit("")))),
        all_of("hasPart", "files"),
        some("landingPageLocation", "landing_page_url"),
        all_of("previewImage", "preview_images"),
    ]
    return _records(inputs, "doi", "dataset"), attribute_rows(inputs, F.col("doi"), entries, alone=alone)


def file_records(inputs: DataFrame, *, alone: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of file contracts; the id is the checksum. alone: true for contracts whose checksum no other has."""
    entries = [
        profiles("Base", "DataResource", "Versionable"),
        Entry("name", F.col("filename")),
        some("mimeType", "mimetype"),
        Entry("dataObjectLocation", F.col("download_url")),
        Entry("checksum", F.col("checksum")),
        some("spdxLicense", "license_url"),
        some("previousVersion", "previous_version_checksum"),
        some("nextVersion", "next_version_checksum"),
        all_of("isPartOf", "dataset_versions"),
        some("landingPageLocation", "landing_page_url"),
    ]
    return _records(inputs, "checksum", "file"), attribute_rows(inputs, F.col("checksum"), entries, alone=alone)


def publication_records(inputs: DataFrame, mentions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of publication contracts; the id is the publication's identifier. Who refers to them comes
    from the contracts' arrays, or as rows: mentions (identifier, referencing)."""
    entries = [
        profiles("Base", "Publication"),
        Entry("doi", F.col("identifier")),
        some("dataCitePublicationType", "resource_type"),
        some("publisher", "publisher"),
        some("datePublished", "publication_date"),
        some("name", "title"),
        Entry("description", F.when(F.col("description") != "", clean_text(F.col("description")))),
        all_of("creator", "creator_orcids"),
        all_of("isReferencedBy", "referenced_by_datasets"),
        some("landingPageLocation", "landing_page_url"),
    ]
    attributes = attribute_rows(inputs, F.col("identifier"), entries)
    if mentions is not None:
        own = mentions.select(F.col("identifier").alias("record_id"), F.lit("isReferencedBy").alias("key"), F.col("referencing").alias("value"), F.lit("string").alias("value_type"))
        attributes = as_set(attributes.unionByName(own))
    return _records(inputs, "identifier", "publication"), attributes


def _references(inputs: DataFrame, record_id: str, attributes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Attributes with references to the files that aren't linked by one of the keys."""
    links = inputs.select(F.col(record_id).alias("record_id"), F.explode("referenced_files").alias("value")).where("value is not null")
    more = not_yet_linked(links, attributes, keys).select("record_id", F.lit("references").alias("key"), "value", F.lit("string").alias("value_type"))
    return as_set(attributes.unionByName(more))


def experiment_records(inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of creep tests; the id is the test's. Measures of 0 or less are left out where they may be."""
    above = lambda c: F.when(F.col(c) > 0, F.col(c))
    about = F.concat(F.lit("Creep test at "), number_text(F.col("specified_temperature")), F.lit("°C, "), number_text(F.col("initial_stress")), F.lit(" MPa"))
    entries = [
        profiles("CreepExperiment", "Base", "Versionable"),
        Entry("applicableStandard", F.col("applicable_standard")),
        Entry("testID", F.col("test_id")),
        Entry("specifiedTemperature", F.col("specified_temperature"), "double"),
        Entry("initialStress", F.col("initial_stress"), "double"),
        Entry("testDuration", F.col("test_duration")),
        Entry("percentageCreepExtension", above("percentage_creep_extension"), "double"),
        Entry("SingleCrystalOrientation", above("single_crystal_orientation"), "double"),
        all_of("hasData", "has_data"),
        all_of("hasMetadata", "has_metadata"),
        Entry("usesMaterial", F.col("uses_material")),
        Entry("name", F.concat(F.lit("Creep Test "), "test_id")),
        Entry("dateCreated", F.col("date_of_test_start")),
        Entry("description", about),
        all_of("creator", "creators"),
        all_of("creatorAffiliation", "creator_affiliations"),
        all_of("keyword", "keywords"),
    ]
    attributes = attribute_rows(inputs, F.col("test_id"), entries)
    return _records(inputs, "test_id", "experiment"), _references(inputs, "test_id", attributes, ("hasData", "hasMetadata"))


def material_records(inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, attributes) of materials; the id joins the material's name and its composition's checksum."""
    entries = [
        profiles("Material", "Base"),
        Entry("materialID", F.col("material_id")),
        all_of("previewImage", "preview_images"),
        all_of("semImage", "sem_images"),
        Entry("hasChemicalComposition", F.col("has_chemical_composition")),
        Entry("hasHeatTreatment", F.col("has_heat_treatment")),
        Entry("name", F.concat(F.lit("Material "), "material_id")),
        all_of("description", "descriptions"),
        all_of("creator", "creators"),
        all_of("creatorAffiliation", "creator_affiliations"),
        all_of("keyword", "keywords"),
    ]
    attributes = attribute_rows(inputs, F.col("pid_composition"), entries)
    return _records(inputs, "pid_composition", "material"), _references(inputs, "pid_composition", attributes, ("hasChemicalComposition", "hasHeatTreatment"))


def merge_graphs(graphs: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Later graphs replace whole records of earlier ones. Within a graph a record id stands for one record."""
    records = attributes = None
    for seq, (r, a) in enumerate(graphs):
        r, a = r.withColumn("seq", F.lit(seq)), a.withColumn("seq", F.lit(seq))
        records = r if records is None else records.unionByName(r)
        attributes = a if attributes is None else attributes.unionByName(a)
    latest = records.groupBy("record_id").agg(F.max(F.struct("seq", "pid", "kind")).alias("own"))
    kept = latest.select("record_id", "own.seq", "own.pid", "own.kind")
    return kept.drop("seq"), as_set(attributes.join(kept.select("record_id", "seq"), ["record_id", "seq"], "left_semi").drop("seq"))


def overlay_graphs(graphs: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """What merge_graphs gives, for graphs whose attributes are sets and belong to records of their own graph: records are
    compared by their ids, and attributes leave by what other graphs replace, so they aren't dealt where that is little."""
    numbered = [(r.withColumn("seq", F.lit(seq)), a.withColumn("seq", F.lit(seq))) for seq, (r, a) in enumerate(graphs)]
    records, attributes = numbered[0]
    for r, a in numbered[1:]:
        records, attributes = records.unionByName(r), attributes.unionByName(a)
    latest = materialize(records.groupBy("record_id").agg(F.max(F.struct("seq", "pid", "kind")).alias("own"), F.min("seq").alias("first")), "records")
    replaced = materialize(latest.where("first < own.seq").select("record_id", F.col("own.seq").alias("last")), "replaced")
    if replaced.head(1):
        attributes = attributes.join(replaced, "record_id", "left").where("last is null or seq = last").drop("last")
    return latest.select("record_id", "own.pid", "own.kind"), attributes.select("record_id", "key", "value", "value_type")


def latest_by(records: DataFrame, order: list, keys: tuple[str, ...] = ("record_id",)) -> DataFrame:
    """The last row of each key in an order (largest first)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return records.withColumn("n_", F.row_number().over(w)).where("n_ = 1").drop("n_")
