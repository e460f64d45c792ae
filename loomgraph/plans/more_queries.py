"""More registered queries: designs and constraints, matching, references, graphs and test sheets."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.functions import columns, vocabulary
from loomgraph.operators import design, graph, matching, quality, records, references, sheets
from loomgraph.plans import queries as first
from loomgraph.plans.adapters import TRADE_SQL, digits, table, trade_graph
from loomgraph.sources import search_index, snapshot

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
comma, values, scratch, P = first.comma, first.values, first.scratch, vocabulary.PROFILES


def query(sql: str) -> Callable:
    """Register a query under its function's name, and its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# ---- designs and constraints


def event_design(kind: str, skip: str | None = None) -> design.Design:
    entries = [
        design.Entry("k", F.try_variant_get("doc", "$.k", "bigint"), "long"),
        design.Entry("name", F.col("event_type")),
        design.Entry("name", F.concat(F.lit("user "), "user_id")),
        design.Entry("missing", F.try_variant_get("doc", "$.no.such[0]", "string")),
        design.Entry("tag", F.array(F.col("event_type"), F.lit(None).cast("string"), F.lit("t")), many=True),
        design.Entry("value", F.col("value"), "double"),
    ]
    return design.Design(F.concat(F.lit(f"{kind}:"), "event_id"), entries, skip=None if skip is None else F.col("event_type") == skip, kind=kind)


EVENT = """SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value, 'long' AS value_type, event_type FROM events UNION ALL SELECT event_id, 'name', event_type, 'string', event_type FROM events UNION ALL SELECT event_id, 'name', 'user ' || user_id, 'string', event_type FROM events
UNION ALL SELECT event_id, 'tag', event_type, 'string', event_type FROM events UNION ALL SELECT event_id, 'tag', 't', 'string', event_type FROM events UNION ALL SELECT event_id, 'value', value::VARCHAR, 'double', event_type FROM events"""


def event_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("doc", F.try_parse_json("props"))


@query(f"SELECT 'e:' || event_id AS record_id, key, value, value_type FROM ({EVENT}) WHERE event_type <> 'error'")
def b1_b5_design(spark: SparkSession, d: str) -> DataFrame:
    return design.apply_design(event_docs(spark, d), event_design("e", "error"))[1]


@query(f"SELECT 'e:' || event_id AS record_id, key, value FROM ({EVENT}) WHERE event_type <> 'click' UNION ALL SELECT 'f:' || event_id, key, value FROM ({EVENT})")
def b10_many_designs(spark: SparkSession, d: str) -> DataFrame:
    return design.run_designs(event_docs(spark, d), [event_design("e", "click"), event_design("f")])[1].select("record_id", "key", "value")


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 IN (0, 1, 2, 3, 4, 5) THEN 'other' ELSE c_mktsegment END AS segment FROM customer")
def b6_otherwise(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey") % 7
    odd = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, " NULL ").when(k == 2, "").when(k == 3, "()").when(k == 4, " []").when(k == 5, "{}").otherwise(F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", columns.otherwise(odd, F.lit("other")).alias("segment"))


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 3 = 0 THEN 'doi' END, CASE WHEN c_custkey % 5 = 0 THEN 'checksum' END, CASE WHEN c_acctbal <= 0 THEN 'size' END, CASE WHEN c_nationkey % 2 = 0 THEN 'relation' END) AS violations
FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0 OR c_acctbal <= 0 OR c_nationkey % 2 = 0""")
def b7_quarantine(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    own = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.when(key % 3 == 0, F.lit("doi:")).otherwise(F.lit("")), F.lit("10.1234/a"), key.cast("string")).alias("doi"),
        F.concat(F.lit("md5:"), F.when(key % 5 == 0, F.lit("XYZ")).otherwise(F.md5(key.cast("string")))).alias("checksum"), F.col("c_acctbal").alias("size"),
        F.when(F.col("c_nationkey") % 2 == 0, "likes").otherwise("cites").alias("relation"),
    )
    _, bad = quality.validate(own, quality.rules_for({"doi": F.col("doi"), "checksum": F.col("checksum"), "size": F.col("size"), "relation": F.col("relation")}))
    return bad.select("c_custkey", comma("violations").alias("violations"))


@query("SELECT p_partkey, p_size FROM part")
def b8_fail_if(spark: SparkSession, d: str) -> DataFrame:
    return quality.fail_if(table(spark, d, "part").select("p_partkey", "p_size"), F.col("p_size") < 0, "a size is negative")


@query("""WITH r AS (SELECT CASE WHEN o_orderkey % 100 = 0 THEN '' ELSE (o_orderkey // 2)::VARCHAR END AS record_id, CASE WHEN o_orderkey % 10 = 0 THEN (o_orderkey // 20)::VARCHAR ELSE '' END AS pid FROM orders)
SELECT 'empty id' AS problem, record_id AS value, count(*) AS n FROM r WHERE record_id = '' GROUP BY ALL UNION ALL SELECT 'repeated id', record_id, count(*) FROM r WHERE record_id <> '' GROUP BY record_id HAVING count(*) > 1 UNION ALL SELECT 'repeated pid', pid, count(*) FROM r WHERE pid <> '' GROUP BY pid HAVING count(*) > 1""")
def b9_identity(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    own = table(spark, d, "orders").select(F.when(key % 100 == 0, "").otherwise(F.floor(key / 2).cast("string")).alias("record_id"), F.when(key % 10 == 0, F.floor(key / 20).cast("string")).otherwise("").alias("pid"))
    return quality.check_identity(own)


# ---- columns


@query("""WITH x AS (SELECT c_custkey, lpad(c_custkey::VARCHAR, 16, '0') AS s FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE 'https://orcid.org/' || substr(s, 1, 4) || '-' || substr(s, 5, 4) || '-' || substr(s, 9, 4) || '-' || substr(s, 13, 4) END AS orcid FROM x""")
def e1_normalize_orcid(spark: SparkSession, d: str) -> DataFrame:
    s, k = digits(F.col("c_custkey")), F.col("c_custkey") % 4
    dashed = F.concat_ws("-", *[F.substring(s, a, 4) for a in (1, 5, 9, 13)])
    forms = F.when(k == 0, s).when(k == 1, F.concat(F.lit("https://orcid.org/"), dashed)).when(k == 2, F.concat(F.lit(" http://orcid.org/"), s)).otherwise(F.concat(s, F.lit("7")))
    return table(spark, d, "customer").select("c_custkey", columns.normalize_orcid(forms).alias("orcid"))


@query(r"""WITH x AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[\s\x{00A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}\x{0085}]+', ' ', 'g')) AS t FROM pages)
SELECT page_id, md5(CASE WHEN len(string_split(t, ' ')) > 500 THEN array_to_string(string_split(t, ' ')[1:500], ' ') || '...' ELSE t END) AS text FROM x""")
def e2_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(columns.clean_text(F.col("html"))).alias("text"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE year(o_orderdate) END::INT AS year, o_orderkey || '_' || o_orderstatus AS id, split_part(o_orderpriority, '-', 1) AS standard FROM orders")
def e3_e5_small_columns(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 5 == 0, "circa").otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    standard = columns.standard_name(F.replace("o_orderpriority", F.lit("-"), F.lit(":")))
    return table(spark, d, "orders").select("o_orderkey", columns.year_of(text).alias("year"), columns.composed_id(F.col("o_orderkey").cast("string"), F.col("o_orderstatus")).alias("id"), standard.alias("standard"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 6 WHEN 5 THEN NULL ELSE strftime(l_shipdate + INTERVAL (l_partkey % 1440) MINUTE, '%Y-%m-%d %H:%M') END AS at FROM lineitem")
def l8_timestamps(spark: SparkSession, d: str) -> DataFrame:
    at = F.expr("l_shipdate + make_interval(0, 0, 0, 0, 0, cast(l_partkey % 1440 as int))")
    k = F.col("l_linenumber") % 6
    shown = F.when(k == 5, "soon")
    for i, layout in enumerate(("yyyy-MM-dd HH:mm:ss", "d.M.yy h:mm a", "d.M.yy H:mm", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy HH:mm")):
        shown = shown.when(k == i, F.date_format(at, layout))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.date_format(columns.parse_timestamp(shown), "yyyy-MM-dd HH:mm").alias("at"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS number, value / 100 AS ratio, CASE WHEN event_id % 2 = 0 THEN value END AS angle FROM events")
def l9_numbers(spark: SparkSession, d: str) -> DataFrame:
    text, k = F.col("value").cast("string"), F.col("event_id")
    number = F.when(k % 3 == 0, F.concat(text, F.lit("d"))).otherwise(F.concat(F.lit(" "), text))
    angle = F.when(k % 2 == 0, F.concat(F.lit("<001>, "), text, F.lit(" deg"))).otherwise(F.concat(F.lit("about "), text))
    return table(spark, d, "events").select("event_id", columns.parse_number(number).alias("number"), columns.parse_percent(F.concat(text, F.lit(" %"))).alias("ratio"), columns.parse_orientation(angle).alias("angle"))


@query(r"""SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS ref FROM pages""")
def l10_file_references(spark: SparkSession, d: str) -> DataFrame:
    text = F.regexp_replace("html", 'href="', 'See file "')
    return table(spark, d, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit('(?i)See file "([^"]+)"'), 1))).alias("ref"))


@query("""WITH x AS (SELECT user_id, date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS s FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN s <= 0 THEN 'PT0S' ELSE 'P' || CASE WHEN s // 86400 > 0 THEN (s // 86400) || 'D' ELSE '' END || CASE WHEN s % 86400 > 0 THEN 'T' || CASE WHEN s // 3600 % 24 > 0 THEN (s // 3600 % 24) || 'H' ELSE '' END || CASE WHEN s // 60 % 60 > 0 THEN (s // 60 % 60) || 'M' ELSE '' END || CASE WHEN s % 60 > 0 THEN (s % 60) || 'S' ELSE '' END ELSE '' END END AS duration FROM x""")
def l14_durations(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "events").groupBy("user_id").agg(F.date_trunc("second", F.min("ts")).alias("a"), F.date_trunc("second", F.max("ts")).alias("b"))
    return own.select("user_id", columns.iso_duration(F.col("a"), F.col("b")).alias("duration"))


# ---- matching

J1 = """c AS (SELECT c_nationkey AS recid, c_custkey AS pos, lower(c_name) AS n, c_custkey % 97 AS o FROM customer),
x AS (SELECT s_nationkey AS recid, s_suppkey AS exp_pos, 'dr. customer#' || lpad(s_suppkey::VARCHAR, 9, '0') || ' jr' AS n, s_suppkey % 97 AS o FROM supplier WHERE s_suppkey % 5 <> 0),
j1 AS (SELECT recid, pos, 'https://ror.org/0' || exp_pos AS ror FROM c JOIN x USING (recid) WHERE contains(x.n, c.n) OR c.o = x.o QUALIFY row_number() OVER (PARTITION BY recid, pos ORDER BY exp_pos) = 1)"""


def people(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    creators = c.select(F.col("c_nationkey").alias("recid"), F.col("c_custkey").alias("pos"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), digits(F.col("c_custkey") % 97).alias("orcid"))
    exports = s.select(
        F.col("s_nationkey").alias("recid"), F.col("s_suppkey").alias("exp_pos"), F.concat(F.lit("Dr. Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, F.lit("0")), F.lit(" Jr")).alias("name"),
        digits(F.col("s_suppkey") % 97).alias("orcid"), F.lit(0).alias("aff_pos"), F.lit(0).alias("id_pos"), F.when(F.col("s_suppkey") % 5 == 0, "grid").otherwise("ror").alias("scheme"), F.concat(F.lit("0"), "s_suppkey").alias("identifier"),
    )
    return creators, exports


@query(f"WITH {J1} SELECT recid, pos, ror FROM j1")
def j1_ror_from_export(spark: SparkSession, d: str) -> DataFrame:
    return matching.ror_from_export(*people(spark, d))


J2 = """p AS (SELECT o_orderkey AS key, o_custkey % 50 AS o, lower(n_name) AS own, year(o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
h AS (SELECT s_suppkey % 50 AS o, s_suppkey AS seq, CASE WHEN s_suppkey % 2 = 0 THEN lower(n_name) || ' university' ELSE substr(lower(n_name), 1, 7) END AS org, 'h' || s_suppkey AS id, 1990 + s_suppkey % 9 AS a, CASE WHEN s_suppkey % 3 > 0 THEN 1992 + s_suppkey % 9 END AS b FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 0),
j2 AS (SELECT key, 'https://ror.org/' || id AS ror FROM p JOIN h USING (o) WHERE (contains(org, own) OR contains(own, org)) AND a <= y + 1 AND coalesce(b >= y - 1, true) QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq) = 1)"""


def history(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    n = table(spark, d, "nation")
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    s, k = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")), F.col("s_suppkey")
    creators = o.select(F.col("o_orderkey").alias("key"), digits(F.col("o_custkey") % 50).alias("orcid"), F.col("n_name").alias("affiliation"), F.year("o_orderdate").alias("year"))
    affiliations = s.select(
        digits(k % 50).alias("orcid"), k.alias("seq"), F.when(k % 2 == 0, F.concat("n_name", F.lit(" University"))).otherwise(F.substring("n_name", 1, 7)).alias("organization"),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("h"), k)).alias("organization_id"), (1990 + k % 9).cast("string").alias("start_date"), F.when(k % 3 == 0, "today").otherwise(F.concat(1992 + k % 9, F.lit("-06"))).alias("end_date"),
    )
    return creators, affiliations


@query(f"WITH {J2} SELECT key, ror FROM j2")
def j2_ror_from_history(spark: SparkSession, d: str) -> DataFrame:
    return matching.ror_from_history(*history(spark, d))


@query(f"WITH {J2}, a AS (SELECT o_orderkey AS key, 'first/' || o_orderkey AS ror FROM orders WHERE o_orderkey % 3 = 0) SELECT p.key, coalesce(a.ror, j2.ror) AS ror FROM p LEFT JOIN a USING (key) LEFT JOIN j2 USING (key)")
def j3_first_source(spark: SparkSession, d: str) -> DataFrame:
    creators, affiliations = history(spark, d)
    easy = creators.where("key % 3 = 0").select("key", F.concat(F.lit("first/"), "key").alias("ror"))
    return matching.first_source(creators.select("key"), easy, matching.ror_from_history(matching.without(creators, easy), affiliations))


J4 = """n AS (SELECT p_partkey AS record_id, p_name || '-' || p_partkey AS name FROM part),
q AS (SELECT DISTINCT CASE p_partkey % 9 WHEN 0 THEN upper(name) WHEN 1 THEN 'see ' || name || '.' WHEN 2 THEN substr(name, 1, length(name) - 1) WHEN 3 THEN '-' || p_partkey WHEN 4 THEN substr(name, length(name) - 5) ELSE 'none ' || p_partkey END AS ref FROM n JOIN part ON record_id = p_partkey)"""


@query(f"WITH {J4} SELECT ref, record_id FROM q LEFT JOIN n ON contains(lower(name), lower(ref)) OR contains(lower(ref), lower(name)) QUALIFY row_number() OVER (PARTITION BY ref ORDER BY lower(name) <> lower(ref), length(name) DESC, record_id) = 1")
def j4_file_references(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "part").select(F.col("p_partkey").alias("record_id"), F.concat_ws("-", "p_name", "p_partkey").alias("name"))
    k = F.col("record_id") % 9
    ref = F.when(k == 0, F.upper("name")).when(k == 1, F.concat(F.lit("see "), "name", F.lit("."))).when(k == 2, F.expr("substr(name, 1, length(name) - 1)")).when(k == 3, F.concat(F.lit("-"), "record_id")).when(k == 4, F.expr("substr(name, length(name) - 5)")).otherwise(F.concat(F.lit("none "), "record_id"))
    found, rest = matching.resolve_file_refs(own.select(ref.alias("ref")), own)
    return found.union(rest.select("ref", F.lit(None).cast("long")))


@query("""WITH n AS (SELECT doc_id AS record_id, coalesce(text, '') AS name FROM documents), q AS (SELECT DISTINCT text AS ref FROM benchmark)
SELECT md5(ref) AS ref, record_id FROM q LEFT JOIN n ON contains(lower(name), lower(ref)) OR contains(lower(ref), lower(name)) QUALIFY row_number() OVER (PARTITION BY ref ORDER BY lower(name) <> lower(ref), length(name) DESC, record_id) = 1""")
def j4_benchmark_passages(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark texts against documents that hold them: long names on either side."""
    own = table(spark, d, "documents").select(F.col("doc_id").alias("record_id"), F.coalesce("text", F.lit("")).alias("name"))
    found, rest = matching.resolve_file_refs(table(spark, d, "benchmark").select(F.col("text").alias("ref")), own)
    return found.union(rest.select("ref", F.lit(None).cast("long"))).withColumn("ref", F.md5("ref"))


@query("SELECT DISTINCT l_orderkey::VARCHAR AS record_id, l_partkey::VARCHAR AS value FROM lineitem l WHERE l_returnflag = 'R' AND NOT EXISTS (SELECT 1 FROM lineitem k WHERE k.l_orderkey = l.l_orderkey AND k.l_partkey = l.l_partkey AND k.l_returnflag <> 'R')")
def j5_not_yet_linked(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("record_id"), F.col("l_returnflag").alias("key"), F.col("l_partkey").cast("string").alias("value"))
    return matching.not_yet_linked(own.where("key = 'R'").select("record_id", "value").distinct(), own, ("A", "N"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN m ELSE p_type END AS p_type FROM part JOIN (SELECT p_brand, min(p_type) AS m FROM part GROUP BY p_brand) USING (p_brand)")
def j6_fill_common(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("collection"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type")).alias("p_type"))
    common = table(spark, d, "part").groupBy(F.col("p_brand").alias("collection")).agg(F.min("p_type").alias("p_type"))
    return matching.fill_common(own, common, ("p_type",)).select("p_partkey", "p_type")


@query(f"WITH {TRADE_SQL}, t(name, pid) AS (VALUES {values(vocabulary.INFO_TYPES)}) SELECT record_id, coalesce(pid, key) AS key, value FROM attributes LEFT JOIN t ON key = name")
def j7_resolve_names(spark: SparkSession, d: str) -> DataFrame:
    return matching.resolve_names(trade_graph(spark, d)[1], vocabulary.info_types(spark)).select("record_id", "key", "value").distinct()


# ---- references


@query("SELECT page_id, CASE WHEN contains(lower(url), 'example.net') THEN 'dataset' WHEN contains(url, 'm.') THEN 'mobile' END AS route FROM pages")
def g1_route_references(spark: SparkSession, d: str) -> DataFrame:
    rules = [("dataset", F.contains(F.lower("url"), F.lit("example.net"))), ("mobile", F.contains("url", F.lit("m.")))]
    return references.route_references(table(spark, d, "pages"), rules).select("page_id", "route")


TYPED = "CASE p_partkey % 6 WHEN 0 THEN 'publication-article' WHEN 1 THEN 'SOFTWARE' WHEN 2 THEN 'Dataset' WHEN 3 THEN '' WHEN 4 THEN p_type ELSE 'Model' END"


@query(f"WITH t(k, v) AS (VALUES {values(vocabulary.RESOURCE_TYPES)}), p AS (SELECT p_partkey, {TYPED} AS t FROM part) SELECT p_partkey, CASE WHEN t = '' THEN NULL ELSE coalesce(v, CASE WHEN t IN ({', '.join(repr(x) for x in vocabulary.GENERAL_TYPES)}) THEN t END, 'Other') END AS general_type FROM p LEFT JOIN t ON lower(t) = k")
def g2_resource_types(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 6
    kind = F.when(k == 0, "publication-article").when(k == 1, "SOFTWARE").when(k == 2, "Dataset").when(k == 3, "").when(k == 4, F.col("p_type")).otherwise("Model")
    return references.map_resource_type(table(spark, d, "part").select("p_partkey", kind.alias("t")), "t").select("p_partkey", "general_type")


ROUTED = "routed AS (SELECT 'o:' || l_orderkey AS referencing, 'o' || l_orderkey % 300 AS concept, CASE WHEN l_partkey % 4 = 0 THEN 'zenodo.' || l_partkey % 300 ELSE '10.1/' || l_partkey END AS identifier, CASE l_linenumber % 3 WHEN 0 THEN 'cites' WHEN 1 THEN 'references' ELSE 'isSupplementTo' END AS relation, CASE WHEN l_suppkey % 2 = 0 THEN 'dataset' ELSE 'text' END AS resource_type, l_linenumber * 100000 + l_suppkey AS pos, CASE WHEN l_partkey % 4 = 0 THEN 'dataset' ELSE 'publication' END AS route FROM lineitem)"


def routed(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_linenumber") % 3
    own = table(spark, d, "lineitem").select(
        F.concat(F.lit("o:"), "l_orderkey").alias("referencing"), F.concat(F.lit("o"), F.col("l_orderkey") % 300).alias("concept"), F.when(F.col("l_partkey") % 4 == 0, F.concat(F.lit("zenodo."), F.col("l_partkey") % 300)).otherwise(F.concat(F.lit("10.1/"), "l_partkey")).alias("identifier"),
        F.when(k == 0, "cites").when(k == 1, "references").otherwise("isSupplementTo").alias("relation"), F.when(F.col("l_suppkey") % 2 == 0, "dataset").otherwise("text").alias("resource_type"), (F.col("l_linenumber") * 100000 + F.col("l_suppkey")).alias("pos"),
    )
    return references.route_references(own)


@query(f"WITH {ROUTED} SELECT identifier, CASE arg_min(resource_type, (referencing, pos)) WHEN 'dataset' THEN 'Dataset' ELSE 'Text' END AS resource_type, count(DISTINCT referencing) AS datasets FROM routed WHERE route = 'publication' GROUP BY identifier")
def g3_publications(spark: SparkSession, d: str) -> DataFrame:
    counts = references.publication_mentions(routed(spark, d)).groupBy("identifier").agg(F.count("*").alias("datasets"))
    return references.publication_inputs(routed(spark, d)).select("identifier", "resource_type").join(counts, "identifier")


@query(f"WITH {ROUTED} SELECT DISTINCT identifier AS record_id, k AS key, CASE k WHEN 'doi' THEN identifier WHEN 'isReferencedBy' THEN referencing WHEN 'landingPageLocation' THEN identifier WHEN 'dataCitePublicationType' THEN CASE arg_min(resource_type, (referencing, pos)) OVER (PARTITION BY identifier) WHEN 'dataset' THEN 'Dataset' ELSE 'Text' END ELSE p END AS value FROM routed, (VALUES ('dataCitePublicationType', ''), ('doi', ''), ('isReferencedBy', ''), ('landingPageLocation', ''), ('profile', '{P['Base']}'), ('profile', '{P['Publication']}')) t(k, p) WHERE route = 'publication'")
def r3_publication_records(spark: SparkSession, d: str) -> DataFrame:
    return records.publication_records(references.publication_inputs(routed(spark, d)), references.publication_mentions(routed(spark, d)))[1].select("record_id", "key", "value")


@query(f"WITH {ROUTED} SELECT DISTINCT referencing AS record_id, relation AS key, identifier AS value FROM routed WHERE route = 'publication' AND relation IN ('cites', 'references') AND referencing IN (SELECT 'o:' || o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def g4_citation_links(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("o:"), "o_orderkey").alias("record_id"))
    return references.citation_links(routed(spark, d), known).drop("value_type")


LATEST = "latest AS (SELECT 'zenodo.' || i AS doi, 'o' || i AS concept, 'zenodo.' || (1000 + i) AS latest_doi FROM range(300) t(i) WHERE i IN (SELECT o_orderkey % 300 FROM orders))"


def latest(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "orders").select((F.col("o_orderkey") % 300).alias("i")).distinct()
    return i.select(F.concat(F.lit("zenodo."), "i").alias("doi"), F.concat(F.lit("o"), "i").alias("concept"), F.concat(F.lit("zenodo."), F.col("i") + 1000).alias("latest_doi"))


NAMED = f"""{ROUTED}, {LATEST}, named AS (SELECT DISTINCT s.latest_doi AS record_id, '{{"relationshipPredicate": "' || relation || '", "target": "' || t.latest_doi || '"}}' AS value, relation AS predicate, t.latest_doi AS target FROM routed r JOIN latest t ON r.identifier = t.doi JOIN latest s ON s.concept = r.concept WHERE route = 'dataset' AND r.concept <> t.concept)"""


@query(f"WITH {NAMED} SELECT record_id, value FROM named")
def g5_named_references(spark: SparkSession, d: str) -> DataFrame:
    return references.named_references(routed(spark, d), latest(spark, d)).select("record_id", "value")


@query(f"""WITH {NAMED}, inv(a, b) AS (VALUES {values(vocabulary.INVERSE_RELATIONS)}) SELECT DISTINCT target AS record_id, '{{"relationshipPredicate": "' || b || '", "target": "' || record_id || '"}}' AS value FROM named JOIN inv ON predicate = a""")
def n11_inverse_references(spark: SparkSession, d: str) -> DataFrame:
    own = references.named_references(routed(spark, d), latest(spark, d)).drop("predicate", "target")
    known = latest(spark, d).select(F.col("latest_doi").alias("record_id"))
    return graph.invert_named_references(own, known).select("record_id", "value")


@query(f"WITH {ROUTED}, {LATEST} SELECT DISTINCT t.concept AS doi, r.concept AS referencing FROM routed r JOIN latest t ON r.identifier = t.doi WHERE route = 'dataset' AND r.concept <> t.concept")
def g6_cross_references(spark: SparkSession, d: str) -> DataFrame:
    return references.cross_references(routed(spark, d), latest(spark, d))


EDGES = "e AS (SELECT 'o:' || o_orderkey AS src, 'c:' || o_custkey AS dst FROM orders UNION SELECT 'c:' || c_custkey, 'n:' || c_nationkey FROM customer UNION SELECT 'n:' || n_nationkey, 'r:' || n_regionkey FROM nation UNION SELECT 'r:' || n_regionkey, 'n:' || n_nationkey FROM nation)"
REACHED = f"{EDGES}, w AS (SELECT 'o:' || o_orderkey AS node, 0 AS depth FROM orders WHERE o_orderstatus = 'F' UNION SELECT dst, depth + 1 FROM w JOIN e ON src = node WHERE depth < 3), best AS (SELECT node, min(depth) AS depth FROM w GROUP BY node)"


def trade_edges(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    name = lambda p, c: F.concat(F.lit(f"{p}:"), F.col(c))
    edge = lambda t, a, b: table(spark, d, t).select(a.alias("src"), b.alias("dst"))
    o, c, n = edge("orders", name("o", "o_orderkey"), name("c", "o_custkey")), edge("customer", name("c", "c_custkey"), name("n", "c_nationkey")), edge("nation", name("n", "n_nationkey"), name("r", "n_regionkey"))
    return table(spark, d, "orders").where("o_orderstatus = 'F'").select(name("o", "o_orderkey").alias("node")), o.union(c).union(n).union(n.select("dst", "src"))


@query(f"WITH RECURSIVE {REACHED} SELECT node, depth::INT AS depth FROM best")
def g7_traverse(spark: SparkSession, d: str) -> DataFrame:
    return references.traverse(*trade_edges(spark, d), max_depth=3)


LED = REACHED.replace("UNION SELECT 'c:' || c_custkey", "UNION SELECT a, b FROM orders_in_turn UNION SELECT 'c:' || c_custkey")


@query(f"""WITH RECURSIVE orders_in_turn AS (
  SELECT 'o:' || o_orderkey AS a, 'o:' || coalesce(lead(o_orderkey) OVER c, CASE WHEN o_custkey % 2 = 0 THEN first(o_orderkey) OVER c END) AS b FROM orders
  WINDOW c AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
{LED.replace("SELECT a, b FROM orders_in_turn", "SELECT a, b FROM orders_in_turn WHERE b IS NOT NULL")},
met AS (SELECT e.src, e.dst, a.depth, b.depth AS dst_depth FROM e JOIN best a ON a.node = e.src LEFT JOIN best b ON b.node = e.dst),
again AS (SELECT src, dst FROM met WHERE dst_depth <= depth),
led AS (SELECT DISTINCT dst AS start, dst AS node FROM again UNION SELECT start, met.dst FROM led JOIN met ON src = node WHERE dst_depth IS NOT NULL)
SELECT met.src, met.dst, depth::INT AS depth, CASE WHEN dst_depth IS NULL THEN 'max depth' WHEN dst_depth = depth + 1 THEN 'visited' WHEN led.start IS NOT NULL THEN 'cycle' ELSE 'another way' END AS reason
FROM met LEFT JOIN led ON start = met.dst AND node = met.src""")
def g8_traversal_report(spark: SparkSession, d: str) -> DataFrame:
    """Besides the edges of g7, a customer's orders lead to one another in turn, and the last to the first for every other."""
    seeds, found = trade_edges(spark, d)
    turn = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    first = F.when(F.col("o_custkey") % 2 == 0, F.min("o_orderkey").over(Window.partitionBy("o_custkey")))
    led = table(spark, d, "orders").withColumn("next", F.coalesce(F.lead("o_orderkey").over(turn), first)).where("next is not null")
    found = found.union(led.select(F.concat(F.lit("o:"), "o_orderkey"), F.concat(F.lit("o:"), "next")))
    return references.traversal_report(references.traverse(seeds, found, max_depth=3), found, max_depth=3)


# ---- graphs

BACK = f"{TRADE_SQL}, rules(f, b) AS (VALUES {values(vocabulary.BACKLINK_RULES)}), back AS (SELECT DISTINCT value AS record_id, b AS key, a.record_id AS value FROM attributes a JOIN rules ON key = f WHERE value IN (SELECT record_id FROM records))"


@query(f"WITH {BACK} SELECT record_id, key, value FROM back")
def n1_backlinks(spark: SparkSession, d: str) -> DataFrame:
    own, attributes = trade_graph(spark, d)
    return graph.infer_backlinks(attributes, own).select("record_id", "key", "value")


CHAIN = (*vocabulary.BACKLINK_RULES, ("isPartOf", "holds"), ("holds", "heldBy"), ("isReferencedBy", "mentions"), ("mentions", "isMentionedBy"), ("isCitedBy", "cites"))


@query(f"""WITH RECURSIVE {TRADE_SQL}, rules(f, b) AS (VALUES {values(CHAIN)}),
back AS (SELECT DISTINCT record_id, key, value FROM attributes UNION SELECT back.value, b, back.record_id FROM back JOIN rules ON key = f WHERE back.value IN (SELECT record_id FROM records))
SELECT record_id, key, value FROM back""")
def n1_fixpoint(spark: SparkSession, d: str) -> DataFrame:
    """Rules whose conclusions are premises of others, until nothing is new."""
    own, attributes = trade_graph(spark, d)
    return graph.with_backlinks(attributes, own, CHAIN, fixpoint=True).select("record_id", "key", "value").distinct()


TRADE_EDGES = f"{TRADE_SQL}, edges AS (SELECT DISTINCT record_id AS src, key, value AS dst FROM attributes WHERE key <> 'profile' AND value IN (SELECT record_id FROM records))"


@query(f"WITH {TRADE_EDGES} SELECT src, key, dst, CASE key WHEN 'isPartOf' THEN 'file' ELSE 'citation' END AS kind FROM edges")
def n2_n3_edges(spark: SparkSession, d: str) -> DataFrame:
    own, attributes = trade_graph(spark, d)
    return graph.edge_kinds(graph.edges(attributes, own))


@query(f"WITH {first.INPUTS} SELECT kind, count(*) AS n FROM (SELECT checksum AS id, 'file' AS kind FROM ff UNION ALL SELECT DISTINCT '10.5281/zenodo.' || version_doi, 'dataset' FROM f UNION ALL SELECT DISTINCT version_doi, 'other' FROM f) GROUP BY kind")
def n4_node_kinds(spark: SparkSession, d: str) -> DataFrame:
    own, _ = first.file_graph(spark, d)
    versions = first.document_files(spark, d).select("version_doi").distinct()
    ids = own.select("record_id").union(versions.select(F.concat(F.lit("10.5281/zenodo."), "version_doi"))).union(versions)
    return ids.groupBy(graph.node_kind(F.col("record_id")).alias("kind")).agg(F.count("*").alias("n"))


@query(f"WITH {TRADE_EDGES} SELECT 'other' AS what, count(*) AS n FROM records UNION ALL SELECT 'nodes', count(*) FROM records UNION ALL SELECT 'edges', count(*) FROM edges")
def n5_statistics(spark: SparkSession, d: str) -> DataFrame:
    own, attributes = trade_graph(spark, d)
    return graph.statistics(own, graph.edges(attributes, own))


@query(f"WITH {TRADE_SQL} SELECT DISTINCT record_id FROM records WHERE contains(record_id, 'o:1') OR record_id IN (SELECT record_id FROM attributes WHERE contains(lower(value), 'urgent') OR contains(lower(value), 'o:1'))")
def n6_search(spark: SparkSession, d: str) -> DataFrame:
    own, attributes = trade_graph(spark, d)
    return graph.search(own, attributes, "URGENT", ("other",)).union(graph.search(own, attributes, "o:1")).distinct()


@query(f"WITH {TRADE_SQL}, t(asked) AS (VALUES ('URGENT'), ('o:1'), ('#00'), ('5'), ('-S'), ('not there'), ('2-HIGH')), v AS (SELECT record_id, value FROM attributes WHERE record_id IN (SELECT record_id FROM records) UNION SELECT record_id, record_id FROM records) SELECT DISTINCT asked, record_id FROM t JOIN v ON contains(lower(value), lower(asked))")
def n6_search_index(spark: SparkSession, d: str) -> DataFrame:
    """One index of all ids and values, and several searches in it."""
    path = scratch(spark, "search")
    search_index.write_index(*trade_graph(spark, d), path)
    found = [search_index.search_index(spark, path, t).select(F.lit(t).alias("asked"), "record_id") for t in ("URGENT", "o:1", "#00", "5", "-S", "not there", "2-HIGH")]
    return functools.reduce(DataFrame.union, found)


@query(f"WITH {TRADE_SQL} SELECT value AS profile, count(DISTINCT record_id) AS n FROM attributes WHERE key = 'profile' GROUP BY value")
def n7_count_by_profile(spark: SparkSession, d: str) -> DataFrame:
    return graph.count_by_profile(trade_graph(spark, d)[1])


@query(f"WITH {TRADE_SQL} SELECT DISTINCT key, value FROM attributes WHERE key IN ('keyword', 'name')")
def n8_distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return graph.distinct_values(trade_graph(spark, d)[1], "keyword", "name")


CARDINALITY = [("F", "keyword", 1, 1), ("F", "name", 1, None), ("O", "keyword", 2, None), ("P", "isPartOf", 0, 0), ("customer", "references", 1, 1), ("customer", "keyword", 0, 1)]


@query(f"WITH {TRADE_SQL}, p(profile_pid, key, lo, hi) AS (VALUES {', '.join(f'({a!r}, {b!r}, {x}, {y if y is not None else chr(78) + chr(85) + chr(76) + chr(76)})' for a, b, x, y in CARDINALITY)}), n AS (SELECT record_id, key, count(*) AS n FROM attributes GROUP BY ALL), x AS (SELECT a.record_id, profile_pid, p.key, coalesce(n.n, 0) AS n, lo, hi FROM attributes a JOIN p ON a.key = 'profile' AND a.value = profile_pid LEFT JOIN n ON n.record_id = a.record_id AND n.key = p.key) SELECT record_id, profile_pid, key, n FROM x WHERE n < lo OR n > hi")
def n9_check_profiles(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.createDataFrame(CARDINALITY, "profile_pid string, key string, min_count int, max_count int")
    return quality.check_profiles(trade_graph(spark, d)[1], wanted)


@query(f"WITH {TRADE_SQL}, x AS (SELECT record_id, key, value, CASE key WHEN 'name' THEN CASE WHEN NOT regexp_matches(value, '^Customer#[0-9]*[02468]$') THEN 'pattern' END WHEN 'keyword' THEN CASE WHEN value NOT IN ('1-URGENT', '2-HIGH') THEN 'enum' END WHEN 'cites' THEN 'range' END AS problem FROM attributes) SELECT record_id, key, value, problem FROM x WHERE problem IS NOT NULL")
def n10_check_values(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([("name", "^Customer#[0-9]*[02468]$", None, None, None), ("keyword", None, None, None, ["1-URGENT", "2-HIGH"]), ("cites", None, 0.0, 1.0, None)], "key string, pattern string, minimum double, maximum double, enum array<string>")
    return quality.check_values(trade_graph(spark, d)[1].distinct(), rules)


@query(f"WITH {TRADE_SQL}, k AS (SELECT 'c:' || c_custkey AS record_id FROM customer WHERE c_custkey % 2 = 0) SELECT record_id, key, value FROM attributes WHERE record_id NOT IN (SELECT record_id FROM k) UNION ALL SELECT record_id, 'name', 'new' FROM k")
def r6_merge_graphs(spark: SparkSession, d: str) -> DataFrame:
    own, attributes = trade_graph(spark, d)
    newer = own.where("kind = 'c' and cast(substring(record_id, 3, 20) as bigint) % 2 = 0")
    changed = newer.select("record_id", F.lit("name").alias("key"), F.lit("new").alias("value"), F.lit("string").alias("value_type"))
    return records.merge_graphs([(own, attributes), (newer, changed)])[1].select("record_id", "key", "value")


@query(f"WITH {TRADE_SQL}, k AS (SELECT 'c:' || c_custkey AS record_id FROM customer WHERE c_custkey % 2 = 0) SELECT record_id, key, value FROM attributes WHERE record_id IN (SELECT record_id FROM records) AND record_id NOT IN (SELECT record_id FROM k) UNION SELECT record_id, 'name', 'new' FROM k UNION SELECT 'z:' || c_custkey, 'name', 'first' FROM customer")
def r6_upsert_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The graph as a snapshot, into which changed customers are put, and then records that it never had."""
    path, (own, attributes) = scratch(spark, "snapshot"), trade_graph(spark, d)
    snapshot.write_snapshot(own, attributes, path, buckets=16)
    newer = own.where("kind = 'c' and cast(substring(record_id, 3, 20) as bigint) % 2 = 0")
    named = lambda t, name: t.select("record_id", F.lit("name").alias("key"), F.lit(name).alias("value"), F.lit("string").alias("value_type"))
    snapshot.upsert_graph(spark, path, newer, named(newer, "new"))
    other = table(spark, d, "customer").select(F.concat(F.lit("z:"), "c_custkey").alias("record_id"), F.lit("").alias("pid"), F.lit("z").alias("kind"))
    snapshot.upsert_graph(spark, path, other, named(other, "first"))
    return snapshot.read_snapshot(spark, path)[1].select("record_id", "key", "value").distinct()


# ---- test sheets

SHEET_FILES = "sf AS (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN 'Creep' WHEN 1 THEN 'MD-TR' WHEN 2 THEN 'Loading' ELSE 'notes' END AS t, l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey AS pos FROM lineitem), cf AS (SELECT pos || '' AS record_id, pos, CASE WHEN l_partkey % 3 = 0 THEN 'Vh5205_' || t || '_C-' || l_suppkey || '.LIS' WHEN l_partkey % 3 = 1 THEN 'Vh5205_C-' || l_suppkey || '-' || t || '.lis' ELSE 'Vh5205_C-' || l_suppkey || '-' || t || '.json' END AS name, l_suppkey, t, l_partkey FROM sf), cl AS (SELECT DISTINCT record_id, pos, name, CASE WHEN t <> 'notes' THEN 'Vh5205_C-' || l_suppkey END AS test_id, CASE WHEN t <> 'notes' THEN replace(lower(t), '-', '_') END AS file_type, CASE WHEN t <> 'notes' THEN l_partkey % 3 = 0 END AS type_first FROM cf WHERE l_partkey % 3 < 2)"
PICKED = f"{SHEET_FILES}, pk AS (SELECT * FROM cl WHERE test_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY test_id, file_type ORDER BY type_first DESC, CASE WHEN type_first THEN -pos ELSE pos END) = 1)"


def sheet_files(spark: SparkSession, d: str) -> DataFrame:
    k, p = F.col("l_linenumber") % 4, F.col("l_partkey") % 3
    kind = F.when(k == 0, "Creep").when(k == 1, "MD-TR").when(k == 2, "Loading").otherwise("notes")
    name = F.when(p == 0, F.concat(F.lit("Vh5205_"), kind, F.lit("_C-"), "l_suppkey", F.lit(".LIS"))).otherwise(F.concat(F.lit("Vh5205_C-"), "l_suppkey", F.lit("-"), kind, F.when(p == 1, F.lit(".lis")).otherwise(F.lit(".json"))))
    pos = F.col("l_orderkey") * 1000000 + F.col("l_linenumber") * 100000 + F.col("l_partkey")
    return table(spark, d, "lineitem").select(pos.cast("string").alias("record_id"), pos.alias("pos"), name.alias("name")).distinct()


@query(f"WITH {SHEET_FILES} SELECT record_id, test_id, file_type, type_first FROM cl")
def l1_classify_files(spark: SparkSession, d: str) -> DataFrame:
    return sheets.classify_files(sheet_files(spark, d)).select("record_id", "test_id", "file_type", "type_first")


@query(f"WITH {PICKED} SELECT test_id, file_type, record_id FROM pk")
def l2_pick_files(spark: SparkSession, d: str) -> DataFrame:
    return sheets.pick_files(sheets.classify_files(sheet_files(spark, d))).select("test_id", "file_type", "record_id")


SETS = f"{PICKED}, w AS (SELECT test_id, max(record_id) FILTER (WHERE file_type = 'md_tr') AS md_tr, max(record_id) FILTER (WHERE file_type = 'creep') AS creep, max(record_id) FILTER (WHERE file_type = 'loading') AS loading FROM pk GROUP BY test_id)"


@query(f"WITH {SETS} SELECT test_id, md_tr, creep, loading, CASE WHEN md_tr IS NULL OR creep IS NULL OR loading IS NULL THEN 'missing: ' || concat_ws(', ', CASE WHEN md_tr IS NULL THEN 'md_tr' END, CASE WHEN creep IS NULL THEN 'creep' END, CASE WHEN loading IS NULL THEN 'loading' END) END AS message FROM (SELECT test_id, CASE WHEN ok THEN md_tr END AS md_tr, CASE WHEN ok THEN creep END AS creep, CASE WHEN ok THEN loading END AS loading FROM (SELECT *, md_tr IS NOT NULL AND creep IS NOT NULL AND loading IS NOT NULL AS ok FROM w) WHERE ok) UNION ALL SELECT test_id, NULL, NULL, NULL, 'missing: ' || concat_ws(', ', CASE WHEN md_tr IS NULL THEN 'md_tr' END, CASE WHEN creep IS NULL THEN 'creep' END, CASE WHEN loading IS NULL THEN 'loading' END) FROM w WHERE md_tr IS NULL OR creep IS NULL OR loading IS NULL")
def l3_test_collections(spark: SparkSession, d: str) -> DataFrame:
    good, bad = sheets.test_collections(sheets.pick_files(sheets.classify_files(sheet_files(spark, d))))
    none = F.lit(None).cast("string")
    return good.select("test_id", "md_tr", "creep", "loading", none.alias("message")).union(bad.select("test_id", none, none, none, "message"))


PARTS = ("Heat-treatment", "Ch.-Comp.-measured", "Ch.-Comp.-nominal", "Data-acquisition-creep", "Data-acquisition", "Primary-data", "Rp0.2", "Common")


@query("WITH x AS (SELECT p_partkey, p_partkey % 8 AS k FROM part), m AS (SELECT k, max(p_partkey)::VARCHAR AS id FROM x GROUP BY k) SELECT coalesce(max(id) FILTER (WHERE k = 0), '') AS heat_treatment, coalesce(max(id) FILTER (WHERE k = 1), '') AS chemical_measured, coalesce(max(id) FILTER (WHERE k = 2), '') AS chemical_nominal, coalesce(max(id) FILTER (WHERE k = 3), '') AS data_acquisition_creep, coalesce(max(id) FILTER (WHERE k = 4), '') AS data_acquisition, coalesce(max(id) FILTER (WHERE k = 5), '') AS primary_processed, '' AS roughness, coalesce(max(id) FILTER (WHERE k = 6), '') AS rp02, max(id) FILTER (WHERE k = 7) AS common FROM m")
def l4_l5_complementary_files(spark: SparkSession, d: str) -> DataFrame:
    kind = F.get(F.array(*map(F.lit, PARTS)), (F.col("p_partkey") % 8).cast("int"))
    name = F.when(F.col("p_partkey") % 8 == 7, "Vh12_MD-TR_Common-to-all.LIS").otherwise(F.concat(F.lit("Vh12_Complementary_"), kind, F.lit(".LIS")))
    files = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("record_id"), F.col("p_partkey").alias("pos"), name.alias("name"))
    return sheets.complementary_files(files).crossJoin(sheets.common_file(files).withColumnRenamed("record_id", "common"))  # one row each


def test_lines(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events as the lines of a test sheet, by event_id: which field they set goes by event_id modulo 7."""
    k = F.col("event_id") % 7
    entry = F.when(k == 0, "Date of test start").when(k == 1, "Date of test end").when(k == 2, "Specified temperature").when(k == 3, "Initial stress").when(k == 4, "Material Identifier").when(k == 5, "Percentage creep extension").otherwise("Test standard")
    area = F.when(k < 2, sheets.JOB).when(k == 4, sheets.MATERIAL).otherwise(sheets.PARAMETERS)
    stamp = F.date_format("ts", "dd.MM.yyyy HH:mm:ss")
    info = F.when(k < 2, stamp).when(k == 2, F.col("value").cast("string")).when(k == 3, F.when(F.col("event_id") % 2 == 0, F.col("value").cast("string")).otherwise("high")).when(k == 4, F.col("event_type")).when(k == 5, F.concat("value", F.lit("%"))).otherwise(F.concat("event_type", F.lit(":2019")))
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("line_no"), area.alias("categorization"), entry.alias("entry"), info.alias("information"))


TESTS = "t AS (SELECT user_id::VARCHAR AS key, strftime(arg_max(ts, event_id) FILTER (WHERE event_id % 7 = 0), '%Y-%m-%d %H:%M:%S') AS a, strftime(arg_max(ts, event_id) FILTER (WHERE event_id % 7 = 1), '%Y-%m-%d %H:%M:%S') AS b, arg_max(value, event_id) FILTER (WHERE event_id % 7 = 2) AS temperature, arg_max(value, event_id) FILTER (WHERE event_id % 7 = 3 AND event_id % 2 = 0) AS stress, arg_max(event_type, event_id) FILTER (WHERE event_id % 7 = 4) AS material, arg_max(value, event_id) FILTER (WHERE event_id % 7 = 5) / 100 AS extension, arg_max(event_type, event_id) FILTER (WHERE event_id % 7 = 6) AS standard FROM events GROUP BY user_id)"


@query(f"WITH {TESTS} SELECT key, a, b, temperature, stress, material, extension, standard || ':2019' AS standard FROM t WHERE a IS NOT NULL AND b IS NOT NULL")
def l7_parse_tests(spark: SparkSession, d: str) -> DataFrame:
    tests, _ = sheets.parse_tests(test_lines(spark, d))
    at = lambda c, n: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n)
    return tests.select("key", at("date_test_start", "a"), at("date_test_end", "b"), F.col("specified_temperature").alias("temperature"), F.col("initial_stress").alias("stress"), F.col("material_id").alias("material"), F.col("percentage_creep_extension").alias("extension"), F.col("applicable_standard").alias("standard"))


@query(f"WITH {TESTS}, er AS (SELECT 'PARSE_ERROR' AS error_type, key FROM t WHERE a IS NULL OR b IS NULL UNION ALL SELECT 'VALUE_ERROR', user_id::VARCHAR FROM events WHERE event_id % 7 = 3 AND event_id % 2 = 1) SELECT 'type' AS scope, error_type, NULL AS test_id, count(*) AS n FROM er GROUP BY error_type UNION ALL SELECT 'test', error_type, key, count(*) FROM er GROUP BY error_type, key")
def l11_l17_error_report(spark: SparkSession, d: str) -> DataFrame:
    _, errors = sheets.parse_tests(test_lines(spark, d))
    return sheets.error_report(errors)


@query(f"WITH {TESTS} SELECT key AS test_id FROM t WHERE a IS NOT NULL AND b IS NOT NULL")
def l17_successes(spark: SparkSession, d: str) -> DataFrame:
    tests, errors = sheets.parse_tests(test_lines(spark, d))
    return sheets.successes(tests, errors)


@query("SELECT user_id::VARCHAR AS key, arg_max(event_type, event_id) FILTER (WHERE event_id % 3 = 0) AS material_id, arg_max(value::VARCHAR, event_id) FILTER (WHERE event_id % 3 = 1) AS applicable_standard FROM events GROUP BY user_id")
def l12_common_metadata(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 3
    entry = F.when(k == 0, " Material Identifier ").when(k == 1, "Test standard").otherwise("Test standard applied")
    lines = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("line_no"), F.lit("").alias("categorization"), entry.alias("entry"), F.when(k == 0, F.col("event_type")).otherwise(F.col("value").cast("string")).alias("information"))
    return sheets.parse_common(lines).select("key", "material_id", "applicable_standard")


@query("SELECT o_orderpriority AS material_id, min(o_orderkey) AS pos FROM orders GROUP BY o_orderpriority")
def l13_first_tests(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "orders").select(F.col("o_orderpriority").alias("material_id"), F.col("o_orderkey").alias("pos"))
    return sheets.first_tests(own).select("material_id", "pos")


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_type || ',' || p_brand WHEN 1 THEN p_brand WHEN 2 THEN p_type ELSE 'all,words' END AS keywords FROM part")
def l15_keywords(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    own = table(spark, d, "part").select("p_partkey", F.when(k.isin(0, 2), F.col("p_type")).alias("material_id"), F.when(k.isin(0, 1), F.concat("p_brand", F.lit(":1"))).otherwise("").alias("applicable_standard"))
    return sheets.with_keywords(own, F.array(F.lit("all"), F.lit("words"))).select("p_partkey", comma("keywords").alias("keywords"))


@query("SELECT CASE p_partkey % 4 WHEN 0 THEN 'sem' WHEN 1 THEN 'preview' END AS kind, CASE p_partkey % 4 WHEN 0 THEN 'f' || p_partkey ELSE 'u' || p_partkey END AS value FROM part WHERE p_partkey % 4 < 2")
def l16_images(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.concat("p_name", F.lit("-SEM.tif"))).when(k == 1, F.concat("p_name", F.lit(" test-piece.JPG"))).when(k == 2, F.concat("p_name", F.lit(".tif"))).otherwise(F.concat("p_name", F.lit(" overview.pdf")))
    own = table(spark, d, "part").select(F.concat(F.lit("f"), "p_partkey").alias("record_id"), F.map_from_arrays(F.array(F.lit("name"), F.lit("dataObjectLocation")), F.array(name, F.concat(F.lit("u"), "p_partkey"))).alias("m"))
    return sheets.images(own.select("record_id", F.explode("m").alias("key", "value")))


TEST_RECORDS = f"""WITH {TESTS}, g AS (SELECT * FROM t WHERE a IS NOT NULL AND b IS NOT NULL)"""


def experiment_contracts(spark: SparkSession, d: str) -> DataFrame:
    tests = sheets.with_keywords(sheets.with_duration(sheets.parse_tests(test_lines(spark, d))[0]), F.array(F.lit("none")))
    return tests.select(
        "test_id", "applicable_standard", "specified_temperature", "initial_stress", "test_duration", F.lit(0.0).alias("single_crystal_orientation"), F.date_format("date_test_start", "yyyy-MM-dd").alias("date_of_test_start"),
        F.array(F.concat(F.lit("md5:"), "test_id")).alias("has_data"), F.array().cast("array<string>").alias("has_metadata"), F.concat(F.lit("m/"), "material_id").alias("uses_material"), "percentage_creep_extension",
        F.array().cast("array<string>").alias("creators"), F.array().cast("array<string>").alias("creator_affiliations"), "keywords", F.array(F.concat(F.lit("md5:"), "test_id"), F.lit("md5:x")).alias("referenced_files"),
    )


@query(f"""{TEST_RECORDS} SELECT key AS record_id, k AS key, CASE k WHEN 'testID' THEN key WHEN 'name' THEN 'Creep Test ' || key WHEN 'hasData' THEN 'md5:' || key WHEN 'references' THEN 'md5:x' WHEN 'dateCreated' THEN substr(a, 1, 10) WHEN 'specifiedTemperature' THEN temperature::VARCHAR WHEN 'percentageCreepExtension' THEN extension::VARCHAR WHEN 'usesMaterial' THEN 'm/' || material END AS value
FROM g, (VALUES ('testID'), ('name'), ('hasData'), ('references'), ('dateCreated'), ('specifiedTemperature'), ('usesMaterial')) v(k) WHERE value IS NOT NULL""")
def r4_experiment_records(spark: SparkSession, d: str) -> DataFrame:
    attributes = records.experiment_records(experiment_contracts(spark, d))[1]
    return attributes.where(F.col("key").isin("testID", "name", "hasData", "references", "dateCreated", "specifiedTemperature", "usesMaterial")).select("record_id", "key", "value")


@query(f"""WITH m AS (SELECT DISTINCT p_type FROM part) SELECT p_type || '_md5:c' AS record_id, k AS key, CASE k WHEN 'materialID' THEN p_type WHEN 'name' THEN 'Material ' || p_type WHEN 'references' THEN 'md5:z' WHEN 'hasChemicalComposition' THEN 'md5:c' WHEN 'hasHeatTreatment' THEN 'md5:h' WHEN 'description' THEN 'As-tested: ' || p_type ELSE p END AS value
FROM m, (VALUES ('materialID', ''), ('name', ''), ('references', ''), ('hasChemicalComposition', ''), ('hasHeatTreatment', ''), ('description', ''), ('profile', '{P["Material"]}'), ('profile', '{P["Base"]}')) v(k, p)""")
def r5_material_records(spark: SparkSession, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    own = table(spark, d, "part").select("p_type").distinct().select(
        F.col("p_type").alias("material_id"), columns.composed_id(F.col("p_type"), F.lit("md5:c")).alias("pid_composition"), F.lit("md5:c").alias("has_chemical_composition"), F.lit("md5:h").alias("has_heat_treatment"),
        F.array(F.concat(F.lit("As-tested: "), "p_type")).alias("descriptions"), none.alias("preview_images"), none.alias("sem_images"), none.alias("creators"), none.alias("creator_affiliations"), none.alias("keywords"), F.array(F.lit("md5:c"), F.lit("md5:z")).alias("referenced_files"),
    )
    return records.material_records(own)[1].select("record_id", "key", "value")
