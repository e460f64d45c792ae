"""From landed records to the graph of datasets, files and publications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.shared import materialize, materialize_by
from loomgraph.operators.design import as_set
from loomgraph.operators import graph, matching, quality, records, references, repository


def build_repository_graph(landed: DataFrame, dois: DataFrame, run_date: str, *, exports: DataFrame | None = None, affiliations: DataFrame | None = None, max_depth: int = 3) -> dict[str, DataFrame]:
    """records, attributes (with backlinks), outcomes (doi, status, error), bad_files and visited concepts.

    landed: what read_records gives. dois: doi. Concepts that datasets refer to are followed up to max_depth steps.
    """
    own = materialize_by(repository.whole_versions(landed, run_date), "versions", "concept")  # all that follows reads this
    known = own.select("recid", "record_doi", "concept")
    resolved, _ = repository.resolve_dois(dois, known)
    related = own.select("concept", F.explode("related").alias("r")).select("concept", "r.*")
    routed = references.route_references(related)
    names = known.select("concept", F.col("record_doi").alias("doi")).union(known.select("concept").distinct().select("concept", F.col("concept").alias("doi"))).where("doi <> ''")  # who asks takes each once
    links = routed.where("route = 'dataset'").join(names.withColumnRenamed("concept", "dst"), F.col("identifier") == F.col("doi")).select(F.col("concept").alias("src"), "dst")
    visited = materialize(references.traverse(resolved.select(F.col("concept").alias("node")), links, max_depth=max_depth), "concepts")
    here = visited.select(F.col("node").alias("concept"))

    # visited concepts meet their versions by hashing, so that whole versions aren't sorted
    mine = own.join(here.hint("shuffle_hash"), "concept", "left_semi")
    versions, repeats = repository.share_by_doi(mine)
    versions = repository.dedup_in_row(versions)
    broken = lambda f: quality.violations(quality.rules_for({"checksum": f["checksum"], "size": f["size"]}))
    bad = versions.select("version_doi", F.explode(F.filter("files", lambda f: F.size(broken(f)) > 0)).alias("f")).select("version_doi", "f.*").withColumn("violations", broken({c: F.col(c) for c in ("checksum", "size")}))
    unnamed = mine.where("record_doi is null").select(F.col("record_doi").alias("version_doi"), F.explode("files").alias("f")).select("version_doi", "f.*")  # no version's, but they may be bad
    unnamed = repository.dedup_in_version(unnamed)
    bad = (bad.distinct() if repeats else bad).unionByName(quality.validate(unnamed, quality.rules_for({c: F.col(c) for c in ("checksum", "size")}))[1])
    versions = versions.withColumn("files", F.filter("files", lambda f: F.size(broken(f)) == 0))
    files = materialize(repository.whole_file_inputs(versions), "files")
    datasets = repository.whole_dataset_inputs(versions)

    latest = materialize(own.where("latest_doi is null").join(here, "concept", "left_semi").select("concept", F.col("version_doi").alias("latest_doi")), "latest")
    targets = names.join(latest, "concept").select("doi", "concept", "latest_doi")
    about = materialize(routed.join(latest, "concept").withColumn("referencing", F.col("latest_doi")).drop("latest_doi"), "about")
    publications = references.publication_inputs(about)
    alone = ~F.col("repeated") if repeats else F.lit(True)
    graphs = [records.publication_records(publications, references.publication_mentions(about)), records.file_records(files, alone=F.lit(True)), records.dataset_records(datasets, alone=alone)]
    merged_records, merged = records.overlay_graphs(graphs)
    cited = references.citation_links(about, latest.select(F.col("latest_doi").alias("record_id")))
    named = materialize(references.named_references(about, targets).drop("predicate", "target"), "named")
    named = as_set(named.unionByName(graph.invert_named_references(named, merged_records)))
    merged = [merged, cited.select(*merged.columns), _affiliations(versions, exports, affiliations), named.select(*merged.columns)]
    # no part holds what another does: their keys or records differ
    attributes = materialize(reduce(DataFrame.unionByName, [m for m in merged if m is not None]), "attributes", "zstd")
    outcome = repository.outcomes(dois, resolved)
    return {"records": merged_records, "attributes": graph.with_backlinks(attributes, merged_records, is_set=True), "outcomes": outcome, "bad_files": bad, "visited": visited}


def _affiliations(versions: DataFrame, exports: DataFrame | None, affiliations: DataFrame | None) -> DataFrame | None:
    """Attributes creatorAffiliation of whole versions, from exports, else from researchers' histories."""
    if exports is None and affiliations is None:
        return None
    creators = versions.select("version_doi", "recid", F.year("publication_date").alias("year"), F.explode("creators").alias("c")).select("version_doi", "recid", "year", "c.*")
    creators = creators.withColumn("key", F.concat_ws("#", "version_doi", "pos"))
    nothing = creators.limit(0).select("key", F.lit("").alias("ror"))
    first = nothing if exports is None else matching.ror_from_export(creators, exports).join(creators.select("recid", "pos", "key"), ["recid", "pos"]).select("key", "ror")
    second = nothing if affiliations is None else matching.ror_from_history(matching.without(creators, first), affiliations)
    found = matching.first_source(creators, first, second).where("ror <> ''")
    return as_set(found.select(F.col("version_doi").alias("record_id"), F.lit("creatorAffiliation").alias("key"), F.col("ror").alias("value"), F.lit("string").alias("value_type")))
