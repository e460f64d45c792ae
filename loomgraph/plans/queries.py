"""The registered queries of the record-graph operators, each with its SQL for DuckDB beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import vocabulary
from loomgraph.functions.shared import materialize, shared_dir
from loomgraph.operators import graph, quality, records, repository, sheets
from loomgraph.plans.adapters import TRADE_SQL, digits, document_files, landed, table, trade_graph, turns
from loomgraph.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    """Register a query under its function's name, and its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def values(pairs: object) -> str:
    rows = pairs.items() if isinstance(pairs, dict) else pairs
    return ", ".join(f"('{a}', '{b}')" for a, b in rows)


def comma(c: str):
    return F.array_join(c, ",")


def scratch(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- files of documents: registry, records, inference, counts

FILES = """
f AS (SELECT lang AS concept, lang || '/' || source AS version_doi, CAST(substr(source, 4) AS INT) AS ordinal, doc_id AS pos, 'md5:' || md5(text) AS checksum, 'doc' || doc_id || '.txt' AS filename, n_chars AS size, 'https://files.example/' || doc_id AS download_url FROM documents),
one AS (SELECT concept, version_doi, ordinal, checksum, min(pos) AS pos, arg_max(filename, pos) AS filename, arg_max(size, pos) AS size, arg_max(download_url, pos) AS download_url FROM f GROUP BY ALL),
reg AS (SELECT concept, checksum, arg_min(version_doi, ordinal) AS first_version_doi, arg_min(filename, ordinal) AS filename, arg_min(size, ordinal) AS size, arg_min(download_url, ordinal) AS download_url, string_agg(version_doi, ',' ORDER BY ordinal) AS present_in FROM one GROUP BY ALL)"""


@query(f"WITH {FILES} SELECT version_doi, checksum, pos, filename, size FROM one")
def c9_dedup_in_version(spark: SparkSession, d: str) -> DataFrame:
    return repository.dedup_in_version(document_files(spark, d)).select("version_doi", "checksum", "pos", "filename", "size")


def registry(spark: SparkSession, d: str) -> DataFrame:
    return repository.file_registry(repository.dedup_in_version(document_files(spark, d)).drop("pos"))


@query(f"WITH {FILES} SELECT concept, checksum, first_version_doi, filename, size, present_in FROM reg")
def c10_file_registry(spark: SparkSession, d: str) -> DataFrame:
    return registry(spark, d).select("concept", "checksum", "first_version_doi", "filename", "size", comma("present_in").alias("present_in"))


LICENSED = "lic AS (SELECT DISTINCT version_doi, ordinal, CASE WHEN ordinal % 3 = 0 THEN 'https://l.example/' || ordinal END AS license_url FROM f)"


@query(f"WITH {FILES}, {LICENSED} SELECT concept, checksum, arg_min(license_url, lic.ordinal) AS license_url FROM one JOIN lic USING (version_doi) WHERE license_url IS NOT NULL GROUP BY ALL")
def c14_license_inheritance(spark: SparkSession, d: str) -> DataFrame:
    return repository.inherited_license(registry(spark, d), licensed(spark, d))


def licensed(spark: SparkSession, d: str) -> DataFrame:
    versions = document_files(spark, d).select("version_doi", "ordinal").distinct()
    return versions.withColumn("license_url", F.when(F.col("ordinal") % 3 == 0, F.concat(F.lit("https://l.example/"), "ordinal")))


CHAINS = """
ch AS (SELECT *, lead(checksum) OVER w AS after, min(ordinal::BIGINT * 1000000000 + pos) OVER (PARTITION BY concept, fname) AS nf FROM (SELECT *, 'len' || (size % 50) AS fname FROM one) WINDOW w AS (PARTITION BY concept, fname ORDER BY ordinal, pos)),
st AS (SELECT * FROM ch WHERE after <> checksum),
nx AS (SELECT concept, checksum, arg_max(after, (nf, ordinal, pos)) AS next_checksum FROM st GROUP BY ALL),
pv AS (SELECT concept, after AS checksum, arg_max(checksum, (nf, ordinal, pos)) AS prev_checksum FROM st GROUP BY concept, after)"""


def document_chains(spark: SparkSession, d: str) -> DataFrame:
    own = repository.dedup_in_version(document_files(spark, d)).withColumn("filename", F.concat(F.lit("len"), F.col("size") % 50))
    return repository.file_chains(own)


@query(f"WITH {FILES}, {CHAINS} SELECT concept, checksum, prev_checksum, next_checksum FROM nx FULL JOIN pv USING (concept, checksum)")
def c13_file_chains(spark: SparkSession, d: str) -> DataFrame:
    return document_chains(spark, d)


INPUTS = f"""{FILES}, {CHAINS}, {LICENSED},
li AS (SELECT concept, checksum, arg_min(license_url, lic.ordinal) AS license_url FROM one JOIN lic USING (version_doi) WHERE license_url IS NOT NULL GROUP BY ALL),
fi AS (SELECT reg.concept, reg.checksum, filename, download_url, license_url, prev_checksum, next_checksum, present_in, 'https://doi.org/' || first_version_doi AS landing FROM reg LEFT JOIN nx USING (concept, checksum) LEFT JOIN pv USING (concept, checksum) LEFT JOIN li USING (concept, checksum)),
ff AS (SELECT * FROM fi QUALIFY row_number() OVER (PARTITION BY checksum ORDER BY concept DESC) = 1)"""


def file_contracts(spark: SparkSession, d: str) -> DataFrame:
    own = registry(spark, d)
    return repository.file_inputs(own, document_chains(spark, d), repository.inherited_license(own, licensed(spark, d)))


@query(f"WITH {INPUTS} SELECT concept, checksum, filename, download_url, license_url, prev_checksum AS previous_version_checksum, next_checksum AS next_version_checksum, present_in AS dataset_versions, landing AS landing_page_url FROM fi")
def c18_file_inputs(spark: SparkSession, d: str) -> DataFrame:
    return file_contracts(spark, d).drop("mimetype").withColumn("dataset_versions", comma("dataset_versions"))


P = vocabulary.PROFILES
FILE_ATTRIBUTES = f"""{INPUTS}, fa AS (
SELECT checksum AS record_id, 'profile' AS key, unnest(['{P["Base"]}', '{P["DataResource"]}', '{P["Versionable"]}']) AS value FROM ff
UNION SELECT checksum, 'name', filename FROM ff UNION SELECT checksum, 'mimeType', 'text/plain' FROM ff UNION SELECT checksum, 'dataObjectLocation', download_url FROM ff
UNION SELECT checksum, 'checksum', checksum FROM ff UNION SELECT checksum, 'spdxLicense', license_url FROM ff WHERE license_url IS NOT NULL
UNION SELECT checksum, 'previousVersion', prev_checksum FROM ff WHERE prev_checksum IS NOT NULL UNION SELECT checksum, 'nextVersion', next_checksum FROM ff WHERE next_checksum IS NOT NULL
UNION SELECT checksum, 'isPartOf', unnest(string_split(present_in, ',')) FROM ff UNION SELECT checksum, 'landingPageLocation', landing FROM ff)"""


def file_graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return records.file_records(repository.latest_file_inputs(file_contracts(spark, d)))


@query(f"WITH {FILE_ATTRIBUTES} SELECT record_id, key, value FROM fa")
def r2_file_records(spark: SparkSession, d: str) -> DataFrame:
    return file_graph(spark, d)[1].select("record_id", "key", "value")


@query(f"WITH {FILE_ATTRIBUTES}, r AS (SELECT DISTINCT record_id FROM fa), b AS (SELECT value AS record_id, 'previousVersion' AS key, record_id AS value FROM fa WHERE key = 'nextVersion' UNION SELECT value, 'nextVersion', record_id FROM fa WHERE key = 'previousVersion') SELECT key, count(*) AS n, count(DISTINCT record_id) AS records FROM (SELECT record_id, key, value FROM fa UNION SELECT * FROM b SEMI JOIN r USING (record_id)) GROUP BY key")
def flagship_unique_files(spark: SparkSession, d: str) -> DataFrame:
    """Unique files, where each occurs, their inverse links: pairs and records by key."""
    own, attributes = file_graph(spark, d)
    whole = graph.with_backlinks(attributes, own, (("nextVersion", "previousVersion"), ("previousVersion", "nextVersion")))
    return whole.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("records"))


@query("SELECT l_suppkey, string_agg(url, ',' ORDER BY rank) AS preview_images FROM (SELECT l_suppkey, l_orderkey || '-' || l_partkey AS url, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 100000 + l_partkey) AS rank FROM lineitem WHERE l_returnflag = 'R') WHERE rank <= 10 GROUP BY l_suppkey")
def c16_preview_images(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "lineitem").withColumn("pos", F.col("l_orderkey") * 100000 + F.col("l_partkey")).withColumn("url", F.concat_ws("-", "l_orderkey", "l_partkey"))
    return repository.preview_images(own, key="l_suppkey", is_image=F.col("l_returnflag") == "R", url="url").withColumn("preview_images", comma("preview_images"))


# ---- versions

@query("SELECT conv_id AS concept, conv_id || '.' || turn AS version_doi, row_number() OVER (PARTITION BY conv_id ORDER BY turn::VARCHAR, turn)::INT AS ordinal FROM conversations")
def c11_version_order(spark: SparkSession, d: str) -> DataFrame:
    return repository.order_versions(turns(spark, d)).select("concept", "version_doi", "ordinal")


@query("SELECT conv_id AS concept, conv_id || '.' || turn AS version_doi, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS ordinal FROM conversations")
def c11_natural_order(spark: SparkSession, d: str) -> DataFrame:
    return repository.order_versions(turns(spark, d), order="natural").select("concept", "version_doi", "ordinal")


@query("WITH v AS (SELECT conv_id AS concept, conv_id || '.' || turn AS v, row_number() OVER (PARTITION BY conv_id ORDER BY turn::VARCHAR, turn) AS o FROM conversations) SELECT concept, v AS version_doi, lag(v) OVER w AS prev_doi, lead(v) OVER w AS next_doi, nullif(last_value(v) OVER (PARTITION BY concept ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), v) AS latest_doi FROM v WINDOW w AS (PARTITION BY concept ORDER BY o)")
def c12_version_links(spark: SparkSession, d: str) -> DataFrame:
    return repository.version_links(repository.order_versions(turns(spark, d))).select("concept", "version_doi", "prev_doi", "next_doi", "latest_doi")


ASKED = "q AS (SELECT DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN 'x/' || c_name WHEN o_orderkey % 3 = 1 THEN 'zenodo.' || o_custkey ELSE 'zenodo.9' || o_custkey || '00000' END AS doi, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_custkey END AS k FROM orders JOIN customer ON o_custkey = c_custkey)"


def asked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    k = F.col("o_orderkey") % 3
    doi = F.when(k == 0, F.concat(F.lit("x/"), "c_name")).when(k == 1, F.concat(F.lit("zenodo."), "o_custkey")).otherwise(F.concat(F.lit("zenodo.9"), "o_custkey", F.lit("00000")))
    known = c.select(F.col("c_custkey").alias("recid"), F.concat(F.lit("x/"), "c_name").alias("record_doi"), F.col("c_nationkey").alias("concept"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(doi.alias("doi")), known


@query(f"WITH {ASKED} SELECT doi, k AS recid FROM q")
def c1_resolve_dois(spark: SparkSession, d: str) -> DataFrame:
    resolved, rest = repository.resolve_dois(*asked(spark, d))
    return resolved.select("doi", "recid").union(rest.select("doi", F.lit(None).cast("long")))


@query(f"WITH {ASKED} SELECT doi, c_nationkey AS concept, coalesce(s_suppkey, k) AS version_recid FROM q JOIN customer ON k = c_custkey LEFT JOIN (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN s_nationkey ELSE -1 END AS s_concept FROM supplier) ON s_concept = c_nationkey")
def c2_fan_out_versions(spark: SparkSession, d: str) -> DataFrame:
    versions = table(spark, d, "supplier").select(F.when(F.col("s_acctbal") > 5000, F.col("s_nationkey")).otherwise(-1).alias("concept"), F.col("s_suppkey").alias("version_recid"))
    return repository.fan_out_versions(repository.resolve_dois(*asked(spark, d))[0], versions)


@query(f"WITH {ASKED} SELECT doi, CASE WHEN k IS NULL THEN 'failed' WHEN k % 10 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN k IS NULL THEN 'not found' WHEN k % 10 = 0 THEN 'bad file' END AS error FROM q")
def c19_outcomes(spark: SparkSession, d: str) -> DataFrame:
    dois, known = asked(spark, d)
    resolved, _ = repository.resolve_dois(dois, known)
    return repository.outcomes(dois, resolved, resolved.where("recid % 10 = 0").select("doi", F.lit("bad file").alias("error")))


# ---- landed records

KEY = "o_orderkey"
CONCEPT = "CASE WHEN o_orderkey % 4 > 0 THEN 'c/' || o_custkey ELSE '10.5281/zenodo.' || o_orderkey END"
ORCID = "'https://orcid.org/' || substr(lpad(c_custkey::VARCHAR, 16, '0'), 1, 4) || '-' || substr(lpad(c_custkey::VARCHAR, 16, '0'), 5, 4) || '-' || substr(lpad(c_custkey::VARCHAR, 16, '0'), 9, 4) || '-' || substr(lpad(c_custkey::VARCHAR, 16, '0'), 13, 4)"
OC = "orders JOIN customer ON o_custkey = c_custkey"


@query(f"SELECT o_orderkey AS id, {CONCEPT} AS concept_doi, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey ELSE o_orderkey END::VARCHAR AS concept_recid FROM {OC}")
def c3_concept_defaults(spark: SparkSession, d: str) -> DataFrame:
    return repository.concept_defaults(landed(spark, d)).select("id", "concept_doi", "concept_recid")


@query(f"SELECT {CONCEPT} AS concept_doi, '10.5281/zenodo.' || o_orderkey AS version_doi, o_orderkey AS recid, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus ELSE '1.0' END AS version_label, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority ELSE '' END AS title, CASE WHEN o_orderkey % 11 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2024-05-06' END AS publication_date, CASE WHEN o_orderkey % 2 = 0 THEN 'https://l.example/cc-by' END AS license_url, o_orderpriority AS keywords FROM {OC}")
def c4_versions(spark: SparkSession, d: str) -> DataFrame:
    own = repository.build_versions(landed(spark, d), "2024-05-06")
    return own.select("concept_doi", "version_doi", "recid", "version_label", "title", F.date_format("publication_date", "yyyy-MM-dd").alias("publication_date"), F.col("license.url").alias("license_url"), comma("keywords").alias("keywords"))


@query(f"SELECT '10.5281/zenodo.' || o_orderkey AS version_doi, 0 AS pos, CASE WHEN o_orderkey % 5 > 0 THEN c_name ELSE '' END AS name, c_mktsegment AS affiliation, {ORCID} AS orcid FROM {OC}")
def c5_creators(spark: SparkSession, d: str) -> DataFrame:
    return repository.build_creators(landed(spark, d))


@query(f"SELECT 'related' AS kind, {CONCEPT} AS concept_doi, '10.5281/zenodo.' || (o_orderkey + 1) AS a, 'cites' AS b FROM {OC} UNION ALL SELECT 'related', {CONCEPT}, '10.1/' || o_custkey, 'references' FROM {OC} WHERE o_orderkey % 4 <> 0 UNION ALL SELECT 'grant', {CONCEPT}, o_orderstatus, c_mktsegment FROM {OC} UNION ALL SELECT 'community', {CONCEPT}, c_mktsegment, c_mktsegment FROM {OC}")
def c6_related_grants_communities(spark: SparkSession, d: str) -> DataFrame:
    own = landed(spark, d)
    pick = lambda t, kind, a, b: t.select(F.lit(kind).alias("kind"), "concept_doi", F.col(a).alias("a"), F.col(b).alias("b"))
    return pick(repository.build_related(own), "related", "identifier", "relation").union(pick(repository.build_grants(own), "grant", "code", "funder")).union(pick(repository.build_communities(own), "community", "id", "name"))


LANDED_FILES = "lf AS (SELECT '10.5281/zenodo.' || o_orderkey AS version_doi, o_orderkey AS recid, (row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1)::INT AS pos, 'md5:' || md5(l_partkey::VARCHAR) AS checksum, 'part' || l_partkey || '.csv' AS filename, l_quantity::BIGINT AS size, CASE WHEN l_partkey % 3 > 0 THEN 'https://l/' || l_partkey ELSE 'https://zenodo.org/records/' || o_orderkey || '/files/part' || l_partkey || '.csv' END AS download_url, l_partkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey)"


@query(f"WITH {LANDED_FILES} SELECT version_doi, recid, pos, checksum, filename, size, download_url FROM lf")
def c7_c8_files(spark: SparkSession, d: str) -> DataFrame:
    return repository.build_files(landed(spark, d)).drop("mimetype")


DATASETS = f"""{LANDED_FILES}, v AS (SELECT {CONCEPT} AS concept, '10.5281/zenodo.' || o_orderkey AS doi, o_orderkey AS recid, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus ELSE '1.0' END AS label, {ORCID} AS orcid, o_orderpriority, c_mktsegment AS seg, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority ELSE '' END AS title, CASE WHEN o_orderkey % 11 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2024-05-06' END AS published FROM {OC}),
ds AS (SELECT *, lag(doi) OVER w AS prev, lead(doi) OVER w AS next, nullif(last_value(doi) OVER (PARTITION BY concept ORDER BY label, recid ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), doi) AS latest FROM v WINDOW w AS (PARTITION BY concept ORDER BY label, recid)),
fs AS (SELECT version_doi, string_agg(checksum, ',' ORDER BY pos) AS files FROM (SELECT version_doi, checksum, min(pos) AS pos FROM lf GROUP BY ALL) GROUP BY version_doi)"""


def dataset_contracts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as datasets, with texts in HTML, organisations of some creators, and some files as images."""
    own = landed(spark, d).withColumn("metadata", F.col("metadata").dropFields("related_identifiers", "grants", "communities"))
    own = materialize(own, "landed")  # without what no contract says
    versions = repository.build_versions(own, "2024-05-06").withColumnRenamed("concept_doi", "concept").withColumn("input_pos", F.col("recid"))
    versions = repository.version_links(repository.order_versions(versions)).withColumn("description", F.concat(F.lit("<p>About <b>"), "title", F.lit("</b></p>")))
    files = repository.build_files(own).select("version_doi", "checksum", "pos", "download_url")
    files = materialize(repository.dedup_in_version(files), "files")
    creators = repository.build_creators(own).withColumn("ror_id", F.when(F.col("affiliation") != "BUILDING", F.concat(F.lit("https://ror.org/"), "affiliation")))
    return repository.dataset_inputs(versions, creators, files, repository.preview_images(files, is_image=F.col("download_url").rlike("^https://l/[0-9]*0$")))


@query(f"WITH {DATASETS} SELECT doi, published AS publication_date, label AS version_label, orcid AS creators, prev AS previous_version_doi, next AS next_version_doi, latest AS latest_version_doi, files FROM ds LEFT JOIN fs ON version_doi = doi")
def c17_dataset_inputs(spark: SparkSession, d: str) -> DataFrame:
    own = dataset_contracts(spark, d)
    return own.select("doi", F.date_format("publication_date", "yyyy-MM-dd").alias("publication_date"), "version_label", comma("creators.orcid").alias("creators"), "previous_version_doi", "next_version_doi", "latest_version_doi", comma("files").alias("files"))


@query(f"""WITH {DATASETS}
SELECT doi AS record_id, 'profile' AS key, unnest(['{P["Base"]}', '{P["Versionable"]}']) AS value FROM ds UNION SELECT doi, 'name', title FROM ds UNION SELECT doi, 'dateCreated', published FROM ds UNION SELECT doi, 'creator', orcid FROM ds
UNION SELECT doi, 'keyword', o_orderpriority FROM ds UNION SELECT doi, 'version', label FROM ds UNION SELECT doi, 'previousVersion', prev FROM ds WHERE prev IS NOT NULL UNION SELECT doi, 'nextVersion', next FROM ds WHERE next IS NOT NULL
UNION SELECT doi, 'latestVersion', latest FROM ds WHERE latest IS NOT NULL UNION SELECT version_doi, 'hasPart', checksum FROM lf UNION SELECT doi, 'landingPageLocation', 'https://doi.org/' || doi FROM ds
UNION SELECT doi, 'creatorAffiliation', 'https://ror.org/' || seg FROM ds WHERE seg <> 'BUILDING' UNION SELECT doi, 'description', trim('About ' || title) FROM ds UNION SELECT version_doi, 'previewImage', download_url FROM lf WHERE l_partkey % 3 > 0 AND l_partkey % 10 = 0""")
def r1_dataset_records(spark: SparkSession, d: str) -> DataFrame:
    return records.dataset_records(dataset_contracts(spark, d))[1].select("record_id", "key", "value")


@query(f"WITH {LANDED_FILES} SELECT version_doi, recid, pos, checksum, filename, size, 'text/csv' AS mimetype, download_url FROM lf")
def a1_landed_records(spark: SparkSession, d: str) -> DataFrame:
    """Landed JSON written (compressed: its texts repeat) and read again, shredded to files."""
    path = scratch(spark, "landed")
    landed(spark, d).write.option("ignoreNullFields", False).option("compression", "gzip").json(path)
    return repository.build_files(readers.read_records(spark, path))


@query("SELECT lpad(s_suppkey::VARCHAR, 16, '0') AS orcid, k * 1000000 AS seq, n_name AS organization, CASE WHEN k = 0 THEN 'g' || n_nationkey END AS organization_id, (1990 + s_suppkey % 9 + k)::VARCHAR AS start_date, (1992 + s_suppkey % 9 + k)::VARCHAR AS end_date FROM supplier JOIN nation ON s_nationkey = n_nationkey, (VALUES (0), (1)) t(k)")
def a3_affiliations(spark: SparkSession, d: str) -> DataFrame:
    """Researchers' organisations written as JSON and read again."""
    path, own = scratch(spark, "affiliations"), table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))

    def entry(k: int):
        group = F.struct((F.concat(F.lit("g"), "n_nationkey") if k == 0 else F.lit(None).cast("string")).alias("disambiguated_organization_identifier"))
        year = lambda x: F.struct(x.cast("string").alias("value"))
        start = 1990 + F.col("s_suppkey") % 9 + k
        return F.array(F.struct(F.struct(F.col("n_name").alias("name"), group.alias("disambiguated_organization")).alias("organization"), year(start).alias("start_date"), year(start + 2).alias("end_date")))

    own.select(digits(F.col("s_suppkey")).alias("orcid"), entry(0).alias("employment-summary"), entry(1).alias("education-summary")).write.json(path)
    return readers.read_affiliations(spark, path)


@query("SELECT n_regionkey::BIGINT AS recid, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1)::INT AS exp_pos, n_name AS name, lpad(n_nationkey::VARCHAR, 16, '0') AS orcid, 0 AS aff_pos, 0 AS id_pos, 'ror' AS scheme, '0' || n_nationkey AS identifier FROM nation")
def a2_exports(spark: SparkSession, d: str) -> DataFrame:
    """Structured affiliations written as JSON and read again."""
    path, own = scratch(spark, "exports"), table(spark, d, "nation")
    identifier = F.struct(F.lit("ror").alias("scheme"), F.concat(F.lit("0"), "n_nationkey").alias("identifier"))
    creator = F.struct(F.struct(F.col("n_name").alias("name"), F.array(F.struct(F.lit("orcid").alias("scheme"), digits(F.col("n_nationkey")).alias("identifier"))).alias("identifiers")).alias("person_or_org"), F.array(F.struct(F.lit("x").alias("name"), F.array(identifier).alias("identifiers"))).alias("affiliations"))
    own.groupBy(F.col("n_regionkey").cast("long").alias("id")).agg(F.sort_array(F.collect_list(creator)).alias("creators")).select("id", F.struct("creators").alias("metadata")).write.json(path)
    return readers.read_exports(spark, path)


@query("SELECT DISTINCT p_brand AS brand, p_type AS type, count(*) AS n FROM part GROUP BY ALL")
def a4_json_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole JSON documents, one for each brand, written and read again as variants."""
    path = scratch(spark, "documents")
    own = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).groupBy("p_brand").agg(F.sort_array(F.collect_list(F.struct(F.col("p_type").alias("type"), "n"))).alias("types"))
    own.select(F.col("p_brand").alias("brand"), "types").repartition(64, "p_brand").write.option("maxRecordsPerFile", 1).json(path)
    docs, _ = readers.read_documents(spark, path)
    parts = docs.select(F.try_variant_get("doc", "$.brand", "string").alias("brand"), F.explode(F.try_variant_get("doc", "$.types", "array<struct<type: string, n: bigint>>")).alias("t"))
    return parts.select("brand", "t.type", "t.n")


@query("SELECT user_id, event_id, event_type, value FROM events")
def a5_l6_sheets(spark: SparkSession, d: str) -> DataFrame:
    """Sheets of tab-separated lines, a file for each user, written as text and read back from whole bytes."""
    path = scratch(spark, "sheets")
    line = F.concat_ws("\t", "event_type", F.concat(F.lit(" e"), "event_id"), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.concat("value", F.lit(" \r")), F.lit("*"))
    table(spark, d, "events").select((F.col("user_id") % 64).alias("k"), F.concat_ws("\t", F.col("user_id"), line).alias("value")).repartition("k").write.partitionBy("k").text(path)
    raw = readers.read_sheets(spark, path).select(F.col("source_path").alias("key"), "content")
    shifted = sheets.sheet_lines(raw.withColumn("content", F.regexp_replace("content", "(?m)^([0-9]+)\t([a-z]+)\t", "$1/$2\t")))
    return shifted.select(F.split("categorization", "/")[0].cast("long").alias("user_id"), F.substring("entry", 2, 20).cast("long").alias("event_id"), F.split("categorization", "/")[1].alias("event_type"), F.col("information").cast("double").alias("value"))


@query(f"WITH {TRADE_SQL} SELECT record_id, key, value, 'string' AS value_type FROM attributes UNION ALL SELECT 'c:' || c_custkey, 'balance', c_acctbal::VARCHAR, 'double' FROM customer UNION ALL SELECT 'c:' || c_custkey, 'rank', c_custkey::VARCHAR, 'long' FROM customer")
def a7_a8_graph_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A graph with typed values, written and read again."""
    own, attributes = trade_graph(spark, d)
    c, path = table(spark, d, "customer"), scratch(spark, "graph")
    typed = lambda key, column, kind: c.select(F.concat(F.lit("c:"), "c_custkey").alias("record_id"), F.lit(key).alias("key"), F.col(column).cast("string").alias("value"), F.lit(kind).alias("value_type"))
    writers.write_graph(own, attributes.union(typed("balance", "c_acctbal", "double")).union(typed("rank", "c_custkey", "long")), path)
    return readers.read_graph(spark, path)[1]


@query("SELECT 'c:' || c_custkey AS record_id, CASE WHEN c_custkey % 2 = 0 THEN 'c:' || c_custkey ELSE 'p/' || c_custkey END AS pid FROM customer")
def a9_resolve_pid(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "customer").select(F.concat(F.lit("c:"), "c_custkey").alias("record_id"), F.when(F.col("c_custkey") % 4 == 0, "").when(F.col("c_custkey") % 2 == 1, F.concat(F.lit("p/"), "c_custkey")).alias("pid"))
    return writers.resolve_pid(own)


@query(f"WITH {TRADE_SQL}, m AS (SELECT 'c:' || c_custkey AS record_id, 'h/' || c_custkey AS pid FROM customer WHERE c_custkey % 2 = 0) SELECT a.record_id, key, coalesce(m.pid, a.value) AS value FROM attributes a LEFT JOIN m ON a.value = m.record_id")
def a10_pid_mapping(spark: SparkSession, d: str) -> DataFrame:
    mapping = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("c:"), "c_custkey").alias("record_id"), F.concat(F.lit("h/"), "c_custkey").alias("pid"))
    return writers.apply_pid_mapping(*trade_graph(spark, d), mapping)[1].select("record_id", "key", "value")


@query("""WITH m AS (SELECT 'c:' || c_custkey AS record_id, 'h/' || c_custkey AS pid FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'x:' || s_suppkey, 'h/x' FROM supplier),
r AS (SELECT 'o:' || o_orderkey AS record_id FROM orders UNION ALL SELECT 'c:' || c_custkey FROM customer UNION ALL SELECT 'n:' || n_nationkey FROM nation UNION ALL SELECT 'r:' || n_regionkey FROM (SELECT DISTINCT r_regionkey AS n_regionkey FROM region))
SELECT 'pid' AS what, record_id, coalesce(pid, '') AS pid, 1 AS n FROM r LEFT JOIN m USING (record_id) UNION ALL SELECT 'records', '', '', count(*) FROM r UNION ALL SELECT 'mapped', '', '', count(*) FROM r JOIN m USING (record_id) UNION ALL SELECT 'unknown', '', '', count(*) FROM m WHERE record_id NOT IN (SELECT record_id FROM r)""")
def a10_mapped_records(spark: SparkSession, d: str) -> DataFrame:
    """The records with registered identifiers, and the counts of the mapping, which also has ids of no record."""
    pair = lambda t, record_id, pid: t.select(F.concat(*record_id).alias("record_id"), pid.alias("pid"))
    known = pair(table(spark, d, "customer").where("c_custkey % 2 = 0"), (F.lit("c:"), "c_custkey"), F.concat(F.lit("h/"), "c_custkey"))
    mapping = known.union(pair(table(spark, d, "supplier"), (F.lit("x:"), "s_suppkey"), F.lit("h/x")))
    own, _, counts = writers.apply_pid_mapping(*trade_graph(spark, d), mapping)
    counted = counts.select(F.explode(F.create_map(*[x for c in ("records", "mapped", "unknown") for x in (F.lit(c), F.col(c))])).alias("what", "n"))
    return own.select(F.lit("pid").alias("what"), "record_id", "pid", F.lit(1).cast("long").alias("n")).union(counted.select("what", F.lit(""), F.lit(""), "n"))
