"""From landed repository records to versions, files and their histories.

Order decides in many places which value wins; it always comes from positions in the input, never from row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.columns import normalize_orcid
from loomgraph.functions.shared import materialize
from loomgraph.functions.vocabulary import RELATIONS

# What counts as a preview image.
IMAGE_TYPES = ("image/png", "image/jpeg", "image/gif", "image/webp")
#: Rows that one part of a concept puts out when DOIs meet versions.
FAN_OUT = 1_000_000
#: Versions that a DOI is given at a time there.
RUN = 256
IMAGE_NAMES = r"\.(png|jpg|jpeg|gif|webp)$"


def first_per(df: DataFrame, keys: Sequence[str | Column], *order: str | Column) -> DataFrame:
    """The first row for each key in an order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place_", place).where("place_ = 1").drop("place_")


def resolve_dois(dois: DataFrame, records: DataFrame, pattern: str = r"zenodo\.([0-9]+)") -> tuple[DataFrame, DataFrame]:
    """(resolved, unresolved): dois (doi) meet records (recid, record_doi, ...) by the number in the DOI, else by the DOI itself,
    where the smallest recid wins."""
    asked = dois.select("doi").distinct().withColumn("number", F.nullif(F.regexp_extract("doi", pattern, 1), F.lit("")).try_cast("bigint"))
    by_number = asked.join(records, asked["number"] == records["recid"])
    rest = asked.join(by_number.select("doi"), "doi", "left_anti")
    by_doi = first_per(rest.join(records, rest["doi"] == records["record_doi"]), ["doi"], "recid")
    resolved = by_number.unionByName(by_doi).drop("number")
    return resolved, asked.join(resolved.select("doi"), "doi", "left_anti").select("doi")


def fan_out_versions(resolved: DataFrame, versions: DataFrame) -> DataFrame:
    """doi and version_recid for every version of a resolved record's concept, or for the record itself if there is none.

    resolved: doi, recid, concept; versions: concept, version_recid. A row for each version may be many more rows than are
    read, so they are counted first. DOIs and versions of a concept are dealt to parts of bounded arrays; a part of DOIs meets
    a part of versions in a row that puts out about FAN_OUT rows, and a task gets a few. So what is shuffled is a small share of what
    is put out, and that repeats short runs of versions, which columnar files keep small: a run over a whole concept outgrows
    the window of their codecs."""
    asked, known = materialize(resolved.select("doi", "recid", "concept"), "asked"), versions.select("concept", "version_recid")
    sizes = known.groupBy("concept").agg(F.count("*").alias("n"))
    side, none = max(1, isqrt(FAN_OUT)), F.lit(None).cast(known.schema["version_recid"].dataType)
    wide = asked.groupBy("concept").agg(F.count("*").alias("asked")).join(sizes, "concept").withColumn("rows", F.col("asked") * F.col("n"))
    parts = wide.select("concept", "rows", F.ceil(F.col("n") / side).alias("vs"), F.ceil(F.col("asked") * F.least("n", F.lit(side)) / FAN_OUT).alias("ds"))
    parts = materialize(parts, "concepts")
    rows, count = parts.agg(F.sum("rows")).first()[0] or 1, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-rows // (16 * FAN_OUT)), min(-(-rows // FAN_OUT), count))
    each, cell = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)), ["concept", "v", "d"]
    dealt = asked.join(parts, "concept", "left")
    bare = dealt.where("rows is null").select("doi", "concept", F.col("recid").alias("version_recid"))  # no versions, or no concept
    dois = dealt.where("rows is not null").withColumn("d", F.pmod(F.xxhash64("doi", "recid"), "ds"))
    dois = dois.groupBy("concept", "vs", "d").agg(F.collect_list(F.struct("doi", "recid")).alias("dois")).withColumn("v", each("vs"))
    listed = F.concat(F.sort_array(F.collect_list("version_recid")), F.array_repeat(none, (F.count("*") - F.count("version_recid")).cast("int")))
    held = known.join(parts, "concept").withColumn("v", F.pmod(F.xxhash64("version_recid"), "vs"))
    held = held.groupBy("concept", "ds", "v").agg(listed.alias("held")).withColumn("d", each("ds"))
    met = dois.select(*cell, "dois").repartition(tasks, *cell).join(held.select(*cell, "held").repartition(tasks, *cell), cell)
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("held") - 1) / RUN).cast("int")), lambda i: F.slice("held", i * RUN + 1, RUN))
    met = met.select("concept", "dois", F.explode(runs).alias("run")).select("concept", "run", F.explode("dois").alias("of"))
    met = met.select("of.doi", "concept", "of.recid", F.explode("run").alias("version_recid"))
    return met.select("doi", "concept", F.coalesce("version_recid", "recid").alias("version_recid")).unionByName(bare)


def concept_defaults(records: DataFrame) -> DataFrame:
    """Landed records with concept_doi (conceptdoi, else the record's DOI, else '') and concept_recid (conceptrecid, else id)."""
    return records.withColumn("concept_doi", F.coalesce("conceptdoi", "metadata.doi", F.lit(""))).withColumn("concept_recid", F.coalesce("conceptrecid", F.col("id").cast("string")))


def build_versions(records: DataFrame, run_date: str, *more: Column) -> DataFrame:
    """The version columns of landed records, and more: label 1.0, empty title and run_date stand in for what is missing."""
    m = F.col("metadata")
    license_ = F.when(m["license"]["id"].isNotNull() | m["license"]["url"].isNotNull(), F.struct(m["license"]["id"].alias("id"), m["license"]["title"].alias("name"), m["license"]["url"].alias("url")))
    return concept_defaults(records).select(
        "concept_doi", F.coalesce(m["doi"], F.lit("")).alias("version_doi"), F.col("id").alias("recid"), F.coalesce(m["version"], F.lit("1.0")).alias("version_label"),
        F.coalesce(m["title"], F.lit("")).alias("title"), m["description"].alias("description"),
        F.coalesce(F.try_to_date(m["publication_date"], "yyyy-MM-dd"), F.lit(run_date).cast("date")).alias("publication_date"),
        license_.alias("license"), F.coalesce(m["keywords"], F.array().cast("array<string>")).alias("keywords"), *more,
    )


def build_creators(records: DataFrame) -> DataFrame:
    """version_doi, pos, name (default ''), affiliation and normalised orcid of every creator."""
    each = records.select(F.col("metadata.doi").alias("version_doi"), F.posexplode("metadata.creators").alias("pos", "c"))
    return each.select("version_doi", creator(F.col("c"), F.col("pos")).alias("c")).select("version_doi", "c.*")


def creator(c: Column, pos: Column) -> Column:
    """pos, name, affiliation and orcid of a landed creator."""
    return F.struct(pos.alias("pos"), F.coalesce(c["name"], F.lit("")).alias("name"), c["affiliation"].alias("affiliation"), normalize_orcid(c["orcid"]).alias("orcid"))


def build_related(records: DataFrame) -> DataFrame:
    """concept_doi, pos, identifier, relation, scheme and resource_type; relations outside the vocabulary are left out."""
    each = concept_defaults(records).select("concept_doi", F.posexplode("metadata.related_identifiers").alias("pos", "r"))
    return each.select("concept_doi", "pos", "r.identifier", "r.relation", "r.scheme", "r.resource_type").where(F.col("relation").isin(*RELATIONS))


def build_grants(records: DataFrame) -> DataFrame:
    each = concept_defaults(records).select("concept_doi", F.posexplode("metadata.grants").alias("pos", "g"))
    return each.select("concept_doi", "pos", F.coalesce("g.code", F.lit("")).alias("code"), F.coalesce("g.title", F.lit("")).alias("title"), F.coalesce("g.funder.name", F.lit("")).alias("funder"), F.col("g.internal_id").alias("internal_id"))


def build_communities(records: DataFrame) -> DataFrame:
    each = concept_defaults(records).select("concept_doi", F.posexplode("metadata.communities").alias("pos", "c"))
    return each.select("concept_doi", "pos", F.coalesce("c.id", "c.slug").alias("id"), F.coalesce("c.name", "c.id", "c.slug").alias("name"))


def checksum_with_prefix(c: Column) -> Column:
    return F.when(c.startswith("md5:"), c).otherwise(F.concat(F.lit("md5:"), c))


def build_files(records: DataFrame, url_base: str = "https://zenodo.org/records/") -> DataFrame:
    """version_doi, recid, pos, checksum, filename, size, mimetype and download_url (constructed where there is no link)."""
    each = records.select(F.col("metadata.doi").alias("version_doi"), F.col("id").alias("recid"), F.posexplode("files").alias("pos", "f"))
    return each.select("version_doi", landed_file(F.col("f"), F.col("pos"), F.col("recid"), url_base).alias("f")).select("version_doi", "f.*")


def landed_file(f: Column, pos: Column, recid: Column, url_base: str = "https://zenodo.org/records/") -> Column:
    """recid, pos, checksum, filename, size, mimetype and download_url of a landed file."""
    url = F.coalesce(f["links"]["self"], F.concat(F.lit(url_base), recid.cast("string"), F.lit("/files/"), f["key"]))
    return F.struct(recid.alias("recid"), pos.alias("pos"), checksum_with_prefix(f["checksum"]).alias("checksum"), f["key"].alias("filename"), f["size"].alias("size"), f["mimetype"].alias("mimetype"), url.alias("download_url"))


def dedup_in_version(files: DataFrame, version: str = "version_doi") -> DataFrame:
    """One row per checksum in a version: the last file's attributes at the first one's position."""
    rest = [c for c in files.columns if c not in (version, "checksum", "pos")]
    dealt = files.repartition(version, "checksum")  # rows are dealt as they are: few repeat, and partial aggregates are wider
    one = dealt.groupBy(version, "checksum").agg(F.max_by(F.struct("pos", *rest), "pos").alias("own"), F.min("pos").alias("pos"))
    return one.select(version, "checksum", "pos", *[F.col("own")[c].alias(c) for c in rest])


def file_registry(files: DataFrame) -> DataFrame:
    """One row per checksum of a concept: attributes from its first version, and the versions it is in, in order.

    files: concept, checksum, ordinal, version_doi and attributes, at most one row for a checksum of a version."""
    rest = [c for c in files.columns if c not in ("concept", "checksum", "ordinal", "version_doi")]
    place = F.struct("ordinal", "version_doi")
    merged = files.groupBy("concept", "checksum").agg(
        F.min_by(F.struct(F.col("version_doi").alias("first_version_doi"), *rest), place).alias("own"),
        F.array_sort(F.collect_set(place)).alias("places"),  # the versions of one file
    )
    return merged.select("concept", "checksum", "own.*", F.transform("places", lambda p: p["version_doi"]).alias("present_in"))


def natural_order(label: Column) -> Column:
    """The numbers of a label, so that 10.0 follows 2.0."""
    return F.transform(F.regexp_extract_all(label, F.lit("([0-9]+)"), 1), lambda x: x.try_cast("bigint"))


def order_versions(versions: DataFrame, *, order: str = "text", concept: str = "concept", label: str = "version_label", position: str = "input_pos") -> DataFrame:
    """versions with ordinal from 1: by label as text (missing: "0") or by its numbers, then by input position."""
    text = F.coalesce(F.col(label).cast("string"), F.lit("0"))
    key = text if order == "text" else natural_order(text)
    return versions.withColumn("ordinal", F.row_number().over(Window.partitionBy(concept).orderBy(key, position)))


def version_links(versions: DataFrame, *, concept: str = "concept", doi: str = "version_doi") -> DataFrame:
    """versions with prev_doi, next_doi and latest_doi; the latest version has no latest_doi."""
    w = Window.partitionBy(concept).orderBy("ordinal")
    last = F.last(doi).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return versions.withColumn("prev_doi", F.lag(doi).over(w)).withColumn("next_doi", F.lead(doi).over(w)).withColumn("latest_doi", F.nullif(last, F.col(doi)))


def file_chains(files: DataFrame, *, acyclic: bool = False) -> DataFrame:
    """concept, checksum, prev_checksum, next_checksum: files of one name in successive versions, where they differ.

    files: concept, filename, checksum, ordinal, pos. Where a checksum gets several links the last one stays (by the
    name's first appearance, then by version), so contents that come back can close a circle; acyclic keeps the first.
    """
    w = Window.partitionBy("concept", "filename").orderBy("ordinal", "pos")
    named = files.withColumn("name_first", F.min(F.struct("ordinal", "pos")).over(Window.partitionBy("concept", "filename")))
    steps = named.withColumn("after", F.lead("checksum").over(w)).where(F.col("after") != F.col("checksum"))
    order = F.struct("name_first", F.col("ordinal"), F.col("pos"), F.col("filename"))
    pick = F.min_by if acyclic else F.max_by
    ahead = steps.groupBy("concept", "checksum").agg(pick("after", order).alias("next_checksum"))
    behind = steps.select("concept", F.col("after").alias("checksum"), F.col("checksum").alias("before"), order.alias("order"))
    back = behind.groupBy("concept", "checksum").agg(pick("before", "order").alias("prev_checksum"))
    return ahead.join(back, ["concept", "checksum"], "full").select("concept", "checksum", "prev_checksum", "next_checksum")


def inherited_license(registry: DataFrame, versions: DataFrame) -> DataFrame:
    """concept, checksum and license_url: that of the first version with one among those the file is in.

    registry: concept, checksum, present_in; versions: version_doi, ordinal, license_url."""
    places = registry.select("concept", "checksum", F.explode("present_in").alias("version_doi"))
    met = places.join(versions.where("license_url is not null").select("version_doi", "ordinal", "license_url"), "version_doi")
    return met.groupBy("concept", "checksum").agg(F.min_by("license_url", F.struct("ordinal", "version_doi")).alias("license_url"))


def landing_page(doi: Column) -> Column:
    return F.concat(F.lit("https://doi.org/"), doi)


def looks_like_image(mimetype: Column, filename: Column) -> Column:
    return mimetype.isin(*IMAGE_TYPES) | F.lower(filename).rlike(IMAGE_NAMES)


def preview_images(files: DataFrame, *, limit: int = 10, key: str = "version_doi", is_image: Column | None = None, url: str = "download_url") -> DataFrame:
    """key and preview_images: the addresses of a version's first images, in file order."""
    image = looks_like_image(F.col("mimetype"), F.col("filename")) if is_image is None else is_image
    ranked = files.where(image).withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("rank") <= limit)
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", url))).alias("x")).select(key, F.transform("x", lambda r: r[url]).alias("preview_images"))


def dataset_inputs(versions: DataFrame, creators: DataFrame, files: DataFrame, images: DataFrame) -> DataFrame:
    """Dataset contracts: linked versions with their creators (orcid, ror_id), checksums and preview images, in order."""
    people = creators.groupBy("version_doi").agg(F.array_sort(F.collect_list(F.struct("pos", "orcid", "ror_id"))).alias("p"))
    people = people.select("version_doi", F.transform("p", lambda c: F.struct(c["orcid"].alias("orcid"), c["ror_id"].alias("ror_id"))).alias("creators"))
    listed = files.select("version_doi", "pos", "checksum").repartition("version_doi")  # before they are lists
    sums = listed.groupBy("version_doi").agg(F.array_sort(F.collect_set(F.struct("pos", "checksum"))).alias("f")).select("version_doi", F.transform("f", lambda x: x["checksum"]).alias("files"))
    met = versions.join(people, "version_doi", "left").join(sums, "version_doi", "left").join(images, "version_doi", "left")
    return met.select(
        F.col("version_doi").alias("doi"), "title", "description", "publication_date", "version_label", "creators", "keywords",
        F.col("prev_doi").alias("previous_version_doi"), F.col("next_doi").alias("next_version_doi"), F.col("latest_doi").alias("latest_version_doi"),
        "files", landing_page(F.col("version_doi")).alias("landing_page_url"), "preview_images",
    )


def file_inputs(registry: DataFrame, chains: DataFrame, licenses: DataFrame) -> DataFrame:
    """File contracts: registered files with their histories and licenses."""
    met = registry.join(chains, ["concept", "checksum"], "left").join(licenses, ["concept", "checksum"], "left")
    return met.select(
        "concept", "checksum", "filename", "mimetype", "download_url", "license_url",
        F.col("prev_checksum").alias("previous_version_checksum"), F.col("next_checksum").alias("next_version_checksum"),
        F.col("present_in").alias("dataset_versions"), landing_page(F.col("first_version_doi")).alias("landing_page_url"),
    )


# The same steps on whole records. A landed record holds its version's files, so versions with their creators and files are
# dealt once, by concept: what is of one version is worked out within its row, and what is of one concept where it lies.


def packed(checksum: Column) -> Column:
    """A checksum for a shuffle: md5 as 16 bytes, or any other as its text."""
    usual = checksum.rlike("^md5:[0-9a-f]{32}$")
    return F.struct(F.when(usual, F.unhex(F.substr(checksum, F.lit(5)))).alias("md5"), F.when(~usual, checksum).alias("text"))


def unpacked(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("md5:"), F.lower(F.hex(c["md5"]))), c["text"])


def whole_versions(records: DataFrame, run_date: str) -> DataFrame:
    """build_versions with ordinal and links, and with the arrays related, creators and files of each record, dealt by concept."""
    count, m = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("metadata")
    needed = F.struct(*[m[c].alias(c) for c in ("doi", "title", "description", "version", "publication_date", "license", "keywords", "creators", "related_identifiers")])
    own = concept_defaults(records).select("id", "conceptdoi", "conceptrecid", F.col("concept_doi").alias("concept"), needed.alias("metadata"), F.transform("files", lambda f: f.withField("sum", packed(checksum_with_prefix(f["checksum"]))).dropFields("checksum")).alias("files"))
    dealt = own.repartition(count, "concept")  # as it landed: what follows from it is wider
    dealt = dealt.withColumn("files", F.transform("files", lambda f: f.withField("checksum", unpacked(f["sum"]))))
    mention = lambda r, i: F.struct(i.alias("pos"), r["identifier"].alias("identifier"), r["relation"].alias("relation"), r["scheme"].alias("scheme"), r["resource_type"].alias("resource_type"))
    related = F.filter(F.transform(m["related_identifiers"], mention), lambda r: r["relation"].isin(*RELATIONS)).alias("related")
    creators, files = F.transform(m["creators"], creator).alias("creators"), F.transform("files", lambda f, i: landed_file(f, i, F.col("id"))).alias("files")
    own = build_versions(dealt, run_date, m["doi"].alias("record_doi"), related, creators, files, F.col("concept"), F.col("id").alias("input_pos")).drop("concept_doi")
    return version_links(order_versions(own)).drop("input_pos")


def share_by_doi(versions: DataFrame) -> tuple[DataFrame, bool]:
    """(versions, whether a version's DOI repeats): rows with repeated, and with license_place (the first ordinal with a license,
    and its address). Creators and files belong to a DOI, so rows of one DOI have them in common; records without a DOI have none."""
    own, named = versions.withColumn("license_place", F.when(F.col("license.url").isNotNull(), F.struct("ordinal", F.col("license.url").alias("url")))), F.col("record_doi").isNotNull()
    mine = [F.when(named, F.col(c)).alias(c) for c in ("creators", "files")]
    rest = [c for c in own.columns if c not in ("creators", "files")]
    many = materialize(own.groupBy("version_doi").agg(F.count("*").alias("n")).where("n > 1").select("version_doi"), "repeated")  # few
    if not many.head(1):
        return own.select(*rest, *mine).withColumn("repeated", F.lit(False)), False
    all_of = lambda c: F.flatten(F.collect_list(F.when(named, F.col(c)))).alias(f"{c}_")
    common = own.join(many, "version_doi", "left_semi").groupBy("version_doi").agg(all_of("creators"), all_of("files"), F.min("license_place").alias("license_"), F.lit(True).alias("repeated_"))
    met = own.select(*rest, *mine).join(materialize(common, "common"), "version_doi", "left").withColumn("repeated", F.col("repeated_").isNotNull())
    for c in ("creators", "files"):
        met = met.withColumn(c, F.when(F.col("repeated"), F.col(f"{c}_")).otherwise(F.col(c)))
    met = met.withColumn("license_place", F.when(F.col("repeated"), F.col("license_")).otherwise(F.col("license_place")))
    return met.drop("creators_", "files_", "license_", "repeated_"), True


def dedup_in_row(versions: DataFrame) -> DataFrame:
    """dedup_in_version within the array files of each row: of equal checksums the last file at the first one's position."""
    same = lambda x, i: F.coalesce(F.get("in_order", i)["checksum"].eqNullSafe(x["checksum"]), F.lit(False))
    sorted_ = versions.withColumn("in_order", F.sort_array(F.transform("files", lambda f: F.struct(f["checksum"].alias("checksum"), f["pos"].alias("pos"), f.alias("own")))))
    first = F.filter("in_order", lambda x, i: (i == 0) | ~same(x, i - 1))
    last = F.filter("in_order", lambda x, i: (i == F.size("in_order") - 1) | ~same(x, i + 1))
    return sorted_.withColumn("files", F.zip_with(first, last, lambda a, b: b["own"].withField("pos", a["pos"]))).drop("in_order")


def whole_dataset_inputs(versions: DataFrame, *, limit: int = 10) -> DataFrame:
    """dataset_inputs of whole versions, whose organisations aren't known; repeated comes along."""
    in_order = lambda files, c: F.transform(F.sort_array(F.transform(files, lambda f: F.struct(f["pos"], f[c].alias("of")))), lambda x: x["of"])
    images = F.filter("files", lambda f: F.coalesce(looks_like_image(f["mimetype"], f["filename"]), F.lit(False)))
    return versions.select(
        F.col("version_doi").alias("doi"), "title", "description", "publication_date", "version_label",
        F.transform("creators", lambda c: F.struct(c["orcid"].alias("orcid"), F.lit(None).cast("string").alias("ror_id"))).alias("creators"), "keywords",
        F.col("prev_doi").alias("previous_version_doi"), F.col("next_doi").alias("next_version_doi"), F.col("latest_doi").alias("latest_version_doi"),
        in_order(F.col("files"), "checksum").alias("files"), landing_page(F.col("version_doi")).alias("landing_page_url"),
        F.slice(in_order(images, "download_url"), 1, limit).alias("preview_images"), "repeated",
    )


def whole_file_inputs(versions: DataFrame) -> DataFrame:
    """latest_file_inputs of file_inputs (registry, chains and licenses) of whole versions: one pass over each concept's files
    where they lie, then one shuffle by checksum."""
    each = versions.select("concept", "version_doi", "ordinal", "license_place", F.explode("files").alias("f")).select("concept", "version_doi", "ordinal", "license_place", "f.checksum", "f.pos", "f.filename", "f.mimetype", "f.download_url")
    w, spot = Window.partitionBy("concept", "filename").orderBy("ordinal", "pos"), F.struct("ordinal", "pos")
    named = each.select("*", F.first(spot).over(w).alias("name_first"), F.lead("checksum").over(w).alias("after"), F.lag("checksum").over(w).alias("before"), F.lag(spot).over(w).alias("before_spot"))
    place = F.struct("ordinal", "version_doi")
    order = lambda other, at: F.when(F.col(other) != F.col("checksum"), F.struct("name_first", F.col(f"{at}ordinal").alias("o"), F.col(f"{at}pos").alias("p"), "filename"))
    licensed = F.when(F.col("license_place").isNotNull(), F.struct("license_place.ordinal", "version_doi"))
    met = named.groupBy("concept", "checksum").agg(
        F.min_by(F.struct("filename", "mimetype", "download_url"), place).alias("own"),
        F.array_sort(F.collect_set(place)).alias("places"),  # the versions of one file
        F.max_by("before", order("before", "before_spot.")).alias("previous_version_checksum"), F.max_by("after", order("after", "")).alias("next_version_checksum"),
        F.min_by("license_place.url", licensed).alias("license_url"),
    )
    sums = {"sum": "checksum", "prev": "previous_version_checksum", "next": "next_version_checksum"}
    dealt = met.select("concept", *[packed(F.col(c)).alias(s) for s, c in sums.items()], "own.*", "license_url", F.transform("places", lambda p: p["version_doi"]).alias("dataset_versions"))
    kept = first_per(dealt.select("concept", "sum.*", *dealt.columns[2:]), ["md5", "text"], F.desc("concept")).withColumn("sum", F.struct("md5", "text"))
    return kept.select(
        *[unpacked(F.col(s)).alias(c) for s, c in sums.items()], "filename", "mimetype", "download_url", "license_url", "dataset_versions",
        landing_page(F.get("dataset_versions", F.lit(0))).alias("landing_page_url"),
    )


def outcomes(dois: DataFrame, resolved: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """doi, status and error: each asked DOI once. failed: doi and error of DOIs whose rows were quarantined."""
    asked = dois.select("doi").distinct()
    good = resolved.select("doi").distinct().withColumn("found", F.lit(True))
    met = asked.join(good, "doi", "left")
    if failed is not None:
        met = met.join(failed.groupBy("doi").agg(F.min("error").alias("why")), "doi", "left")
    else:
        met = met.withColumn("why", F.lit(None).cast("string"))
    error = F.when(F.col("found").isNull(), "not found").otherwise(F.col("why"))
    return met.select("doi", F.when(error.isNull(), "ok").otherwise("failed").alias("status"), error.alias("error"))


def latest_file_inputs(inputs: DataFrame, *, merge: bool = False) -> DataFrame:
    """One contract for each checksum: of the last concept that has it; with merge, in the versions of all."""
    kept = first_per(inputs, ["checksum"], F.desc("concept"))
    if merge:
        every = inputs.select("checksum", F.explode("dataset_versions").alias("v")).groupBy("checksum").agg(F.array_sort(F.collect_set("v")).alias("dataset_versions"))
        kept = kept.drop("dataset_versions").join(every, "checksum", "left")
    return kept.drop("concept")
