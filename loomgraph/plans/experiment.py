"""From a record graph and its test sheets to the graph with materials and experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.columns import composed_id
from loomgraph.functions.shared import materialize
from loomgraph.operators import graph, matching, records, sheets
from loomgraph.operators.design import as_set
from loomgraph.operators.repository import first_per


def collection_labels(records: DataFrame, attributes: DataFrame, *, key: str = "hasPart") -> DataFrame:
    """record_id and collection: datasets that have parts, and all that their parts lead down to, are labelled by the
    dataset; a record below several has a row for each. What is below none has the label '' (so a graph that names no
    parts is one collection). Circles of parts end; levels are written to the shared folder."""
    own = materialize(attributes.where(F.col("key") == key).select("record_id", F.col("value").alias("part")).distinct(), "parts")  # each level reads it
    roots = records.where("kind = 'dataset'").select("record_id").join(own, "record_id", "left_semi").distinct()
    labels = frontier = materialize(roots.withColumn("collection", F.col("record_id")), "labels")
    while frontier.head(1):
        near = frontier.join(own, "record_id").select(F.col("part").alias("record_id"), "collection").distinct()
        frontier = materialize(near.join(labels, ["record_id", "collection"], "left_anti"), "labels")
        labels = labels.unionByName(frontier)
    rest = records.select("record_id").distinct().join(labels, "record_id", "left_anti")
    return labels.unionByName(rest.withColumn("collection", F.lit("")))


def repeated_values(ids: DataFrame, values: DataFrame) -> DataFrame:
    """Attribute rows that give each id (record_id, collection) all values (key, value) of its collection."""
    return matching.salted_join(ids, values, "collection").select("record_id", "key", "value", F.lit("string").alias("value_type"))


def read_experiments(graph_records: DataFrame, attributes: DataFrame, landed: DataFrame, *, test_prefix: str = "Vh5205_") -> dict[str, DataFrame]:
    """tests with their collections, refs (files that tests mention), hit (those found), labels, complements (other) and
    errors: all that is read from the sheets. Sheets that are asked for are written once, and so is what each says."""
    by = ["collection"]
    labels = collection_labels(graph_records, attributes)
    names = attributes.where("key = 'name'").select("record_id", F.col("value").alias("name"))
    file_names = materialize(names.join(graph_records.where("kind = 'file'").select("record_id"), "record_id", "left_semi").join(labels, "record_id"), "names")
    files = file_names.where(F.lower("name").endswith(".lis")).withColumn("pos", F.struct("name", "record_id"))
    collections, incomplete = sheets.test_collections(sheets.pick_files(sheets.classify_files(files, test_prefix=test_prefix), by), by)
    collections = materialize(collections, "collections")
    other, common_id = sheets.complementary_files(files, by), sheets.common_file(files, by)  # a row for each collection

    sheet_of = collections.select(F.col("md_tr").alias("key"), F.col("test_id").alias("own_id")).distinct()
    asked = sheet_of.select("key").union(common_id.select("record_id")).distinct()
    landed = materialize(landed.select("key", "content").join(asked, "key", "left_semi"), "landed")
    parsed, unread = sheets.judge_tests(materialize(sheets.fold_tests(sheets.sheet_lines(landed.join(sheet_of, "key", "left_semi"))), "folded"))
    tests = parsed.join(collections.select("collection", F.col("md_tr").alias("key"), F.col("test_id").alias("own_id")), "key")
    tests = tests.withColumn("test_id", F.when(F.col("test_id") == F.col("key"), F.col("own_id")).otherwise(F.col("test_id"))).drop("key", "own_id")
    unread = unread.join(sheet_of.withColumnRenamed("key", "test_id"), "test_id").withColumn("test_id", F.col("own_id")).drop("own_id")
    shared = sheets.parse_common(sheets.sheet_lines(landed.join(common_id, landed["key"] == common_id["record_id"], "left_semi")))
    shared = shared.join(common_id.withColumnRenamed("record_id", "key"), "key")
    tests = materialize(matching.fill_common(tests, shared, ("material_id", "applicable_standard")), "tests")

    refs = tests.select("collection", "test_id", F.explode("file_references").alias("ref"))
    hit, missing = matching.resolve_file_refs(refs, file_names, by="collection")
    errors = incomplete.unionByName(sheets.fetch_errors(collections.select("test_id", "md_tr").distinct(), landed)).unionByName(unread)
    warnings = missing.select(F.lit(None).cast("string").alias("test_id"), F.col("ref").alias("filename"), F.lit("UNRESOLVED_FILE").alias("error_type"), F.lit("no file record has this name").alias("message"))
    return {"tests": tests, "collections": collections, "refs": refs, "hit": hit, "labels": labels, "other": other, "errors": errors.unionByName(warnings)}


def build_experiment_graph(graph_records: DataFrame, attributes: DataFrame, landed: DataFrame, *, test_prefix: str = "Vh5205_") -> dict[str, DataFrame]:
    """records, attributes (with backlinks) and errors. landed: key (checksum) and content of the sheets.

    A dataset with parts is a collection (``collection_labels``). Its tests are made of its own files, complemented by its
    own, and mention its own; its creators, affiliations and images are repeated by each of its experiments and
    materials, as attribute rows, and its keywords by those that have none of their own. A file of several datasets
    serves in each; a sheet is parsed once. Sheets are in the order of their names; a material is described by its first
    test in the order of their ids, of the first collection if several share it. Errors come from the reading alone
    (``read_experiments``): who wants no graph needs no more.
    """
    by = ["collection"]
    read = read_experiments(graph_records, attributes, landed, test_prefix=test_prefix)
    tests, collections, refs, hit, labels, other = (read[k] for k in ("tests", "collections", "refs", "hit", "labels", "other"))
    linked = refs.join(hit, ["collection", "ref"]).groupBy("collection", "test_id").agg(F.array_sort(F.collect_set("record_id")).alias("referenced_files"))  # of one sheet
    none = F.array().cast("array<string>")
    full = tests.join(linked, ["collection", "test_id"], "left").withColumn("referenced_files", F.coalesce("referenced_files", none))
    full = matching.salted_join(full, other, "collection", how="left").fillna("", [c for c in other.columns if c != "collection"])
    full = full.withColumn("pid_composition", composed_id(F.col("material_id"), F.col("chemical_measured")))
    full = materialize(sheets.with_keywords(sheets.with_duration(full), none), "full")

    texts = F.array_compact(F.array(F.concat(F.lit("As-manufactured: "), "manufacturing_as_manufactured"), F.concat(F.lit("As-tested: "), "manufacturing_as_tested")))
    firsts = sheets.first_tests(full, "test_id", by)
    materials = first_per(firsts, ["pid_composition"], "collection").select(
        "material_id", "pid_composition", F.col("chemical_measured").alias("has_chemical_composition"), F.col("heat_treatment").alias("has_heat_treatment"), texts.alias("descriptions"),
        none.alias("preview_images"), none.alias("sem_images"), none.alias("creators"), none.alias("creator_affiliations"), "keywords", "referenced_files",
    )
    layout = "yyyy-MM-dd'T'HH:mm:ss"
    experiments = full.join(collections, ["collection", "test_id"], "left").select(
        "test_id", "applicable_standard", "specified_temperature", "initial_stress", "test_duration", "single_crystal_orientation",
        F.date_format("date_test_start", layout).alias("date_of_test_start"), F.date_format("date_test_end", layout).alias("date_of_test_end"), "project",
        F.array_compact(F.array("creep", "loading", F.nullif(F.col("primary_processed"), F.lit("")))).alias("has_data"),
        F.array_compact(F.array("md_tr", F.nullif(F.col("data_acquisition_creep"), F.lit("")))).alias("has_metadata"),
        F.col("pid_composition").alias("uses_material"), "percentage_creep_extension", none.alias("creators"), none.alias("creator_affiliations"), "keywords", "referenced_files",
    )

    said = attributes.where(F.col("key").isin("creator", "creatorAffiliation", "keyword")).select("record_id", "key", "value")
    values = materialize(said.join(labels, "record_id").select("collection", "key", "value").distinct(), "values")
    pictures = sheets.images(attributes, of_records=True).join(labels, "record_id")
    pictures = pictures.select("collection", F.when(F.col("kind") == "sem", "semImage").otherwise("previewImage").alias("key"), "value").distinct()
    material_ids, test_ids = (t.select(F.col(c).alias("record_id"), "collection", (F.size("keywords") == 0).alias("bare")) for t, c in ((firsts, "pid_composition"), (full, "test_id")))
    people, words = values.where("key <> 'keyword'"), values.where("key = 'keyword'")
    of_materials = repeated_values(material_ids, people.unionByName(pictures)).unionByName(repeated_values(material_ids.where("bare"), words))
    of_tests = repeated_values(test_ids, people).unionByName(repeated_values(test_ids.where("bare"), words))
    with_more = lambda made, more: (made[0], as_set(made[1].unionByName(more)))
    merged_records, merged = records.merge_graphs([(graph_records, attributes), with_more(records.material_records(materials), of_materials), with_more(records.experiment_records(experiments), of_tests)])
    return {"records": merged_records, "attributes": graph.with_backlinks(merged, merged_records), "errors": read["errors"]}
