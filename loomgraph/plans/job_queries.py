"""Registered queries of whole jobs and of the type registry, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions.vocabulary import BACKLINK_RULES, PROFILES
from loomgraph.operators import quality, sheets
from loomgraph.plans.adapters import landed, table
from loomgraph.plans.experiment import build_experiment_graph, read_experiments
from loomgraph.plans.more_queries import PARTS, TESTS, test_lines
from loomgraph.plans.queries import CONCEPT, OC, scratch, values
from loomgraph.plans.repository import build_repository_graph
from loomgraph.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    """Register a query under its function's name, and its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# ---- type registry


def written_registry(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Brands as profiles and part types as info types and basic types, written as JSON files and read as a registry."""
    path, part = scratch(spark, "registry"), table(spark, d, "part")
    variant = lambda c: F.parse_json(c)
    prop = lambda name, kind, cardinality: F.struct(name.alias("Name"), kind.alias("Type"), F.struct(cardinality.alias("Cardinality")).alias("Properties"))
    counted = part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    k = F.col("n") % 4
    cardinality = F.when(k == 0, "1").when(k == 1, "0 - 1").when(k == 2, "1 - n").otherwise("0 - n")
    properties = F.sort_array(F.collect_list(prop(F.col("p_type"), F.concat(F.lit("i/"), "p_type"), cardinality)))  # the types of one brand
    profiles = counted.groupBy("p_brand").agg(properties.alias("ps")).select(F.concat(F.lit("p/"), "p_brand").alias("Identifier"), F.col("p_brand").alias("name"), F.struct(F.col("ps").alias("Properties")).alias("Schema"))
    types = part.groupBy("p_type").agg((F.min("p_partkey") % 3).alias("k"))
    infos = types.select(F.concat(F.lit("i/"), "p_type").alias("identifier"), F.col("p_type").alias("name"), F.struct(F.array(prop(F.col("p_type"), F.concat(F.lit("b/"), "p_type"), F.lit("1"))).alias("Properties")).alias("Schema"))
    rule = lambda name, json: F.struct(F.lit(name).alias("Property"), variant(F.lit(json)).alias("Value"))
    enum = "[" + ", ".join(f'"{i}"' for i in range(1, 26)) + "]"
    ranged, listed, spelled = (F.array(*r) for r in ((rule("minimum", "10"), rule("maximum", "30")), (rule("enum", enum),), (rule("pattern", '"^[0-9]$"'),)))
    rules = F.when(F.col("k") == 0, ranged).when(F.col("k") == 1, listed).otherwise(spelled)
    basics = types.select(F.concat(F.lit("b/"), "p_type").alias("Identifier"), F.col("p_type").alias("name"), F.struct(F.lit("Number").alias("Type"), rules.alias("Properties")).alias("Schema"))
    for kind, own in (("profiles", profiles), ("info_types", infos), ("basic_info_types", basics)):
        own.repartition(16, "name").write.option("maxRecordsPerFile", 1).json(f"{path}/{kind}")
    return readers.read_type_registry(spark, path)


@query("""WITH c AS (SELECT p_brand, p_type, count(*) % 4 AS k FROM part GROUP BY ALL)
SELECT 'p/' || p_brand AS profile_pid, p_brand AS profile_name, p_type AS property, 'i/' || p_type AS infotype_pid, CASE WHEN k IN (0, 2) THEN 1 ELSE 0 END::INT AS min_count, CASE WHEN k < 2 THEN 1 END::INT AS max_count, 'b/' || p_type AS basic_type_pid FROM c""")
def a6_type_registry(spark: SparkSession, d: str) -> DataFrame:
    registry = written_registry(spark, d)
    infos = registry["info_types"].select(F.col("pid").alias("infotype_pid"), "basic_type_pid")
    return registry["profile_properties"].join(infos, "infotype_pid").select("profile_pid", "profile_name", "property", "infotype_pid", "min_count", "max_count", "basic_type_pid")


@query("""WITH t AS (SELECT p_type, min(p_partkey) % 3 AS k FROM part GROUP BY p_type)
SELECT 'r' || p_partkey AS record_id, 'i/' || p_type AS key, p_size::VARCHAR AS value, CASE k WHEN 0 THEN 'range' WHEN 1 THEN 'enum' ELSE 'pattern' END AS problem
FROM part JOIN t USING (p_type) WHERE CASE k WHEN 0 THEN p_size < 10 OR p_size > 30 WHEN 1 THEN p_size > 25 ELSE p_size > 9 END""")
def a6_n10_registry_rules(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "part").select(F.concat(F.lit("r"), "p_partkey").alias("record_id"), F.concat(F.lit("i/"), "p_type").alias("key"), F.col("p_size").cast("string").alias("value"))
    return quality.check_values(own, quality.value_rules(written_registry(spark, d)))


# ---- the experiment job


def experiment_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, attributes and landed sheets. Users as tests: their events are the lines of a sheet. Suppliers are images and drawings, nations complement the
    tests, regions are the datasets: three of them have parts, and some drawings are parts of two. Some tests lack a file,
    and some sheets haven't landed."""
    u, s, n, r = (table(spark, d, "events").select(F.col("user_id").alias("u")).distinct(), *(table(spark, d, t) for t in ("supplier", "nation", "region")))
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    file = lambda t, record_id, name: t.select(record_id.alias("record_id"), name.alias("name"))
    user, supplier, nation = F.col("u"), F.col("s_suppkey"), F.col("n_nationkey")
    kind = F.get(F.array(*map(F.lit, PARTS)), nation % 8)
    files = (
        file(u, text("md5:m", user), text("Vh5205_MD-TR_C-", user, ".LIS"))
        .union(file(u, text("md5:c", user), text("Vh5205_C-", user, "-Creep.LIS")))
        .union(file(u.where("u % 7 <> 0"), text("md5:l", user), text("Vh5205_C-", user, "-Loading.LIS")))
        .union(file(s, text("md5:s", supplier), F.when(supplier % 4 == 0, text("SEM-", supplier, ".tif")).when(supplier % 4 == 1, text("overview ", supplier, ".jpg")).when(supplier % 4 == 2, text("Form", supplier, ".pdf")).otherwise(text("notes ", supplier, ".txt"))))
        .union(file(n, text("md5:n", nation), F.when(nation % 8 == 7, "Vh12_MD-TR_Common-to-all.LIS").otherwise(text("Vh12_Complementary_", kind, ".LIS"))))
    )
    dataset = text("10.5281/zenodo.", F.col("r_regionkey"))
    own = files.select("record_id", F.lit("").alias("pid"), F.lit("file").alias("kind")).union(r.select(dataset, F.lit(""), F.lit("dataset")))
    pair = lambda t, record_id, key, value: t.select(record_id.alias("record_id"), F.lit(key).alias("key"), value.alias("value"), F.lit("string").alias("value_type"))
    attributes = (
        pair(files, F.col("record_id"), "name", F.col("name"))
        .union(pair(s, text("md5:s", supplier), "dataObjectLocation", text("https://p/", supplier)))
        .union(pair(r, dataset, "creator", text("https://orcid.org/", F.col("r_name"))))
        .union(pair(r, dataset, "creatorAffiliation", text("https://ror.org/", F.col("r_regionkey"))))
        .union(pair(r, dataset, "keyword", F.col("r_name")))
    )
    part = lambda t, dataset_no, record_id: pair(t, text("10.5281/zenodo.", dataset_no), "hasPart", record_id)
    for kind_of_file, some in (("m", u), ("c", u), ("l", u.where("u % 7 <> 0"))):
        attributes = attributes.union(part(some, user % 3, text(f"md5:{kind_of_file}", user)))
    attributes = attributes.union(part(s, supplier % 3, text("md5:s", supplier))).union(part(s.where("s_suppkey % 10 = 0"), (supplier + 1) % 3, text("md5:s", supplier)))
    attributes = attributes.union(part(n, F.least(F.floor(nation / 8), F.lit(2)), text("md5:n", nation)))
    line = lambda category, entry, information: F.concat_ws("\t", category, entry, F.lit(""), F.lit(""), F.lit(""), F.lit(""), information, F.lit("*"))
    lines = test_lines(spark, d).select(F.col("key").alias("u"), "line_no", line(F.col("categorization"), F.col("entry"), F.col("information")).alias("line"))
    e = table(spark, d, "events")
    drawing = line(F.lit(sheets.PARAMETERS), F.lit("Drawing"), text('See file "Form', F.col("event_id") % 300, '.pdf"'))
    lines = lines.union(e.where("event_id % 13 = 0").select(F.col("user_id").cast("string"), "event_id", drawing))
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\r\n")  # the lines of one sheet
    landed = lines.groupBy("u").agg(content.alias("content")).where("cast(u as bigint) % 11 <> 0").select(text("md5:m", F.col("u")).alias("key"), "content")
    common = F.concat_ws("\r\n", line(F.lit("x"), F.lit("Material Identifier"), text("common material ", nation)), line(F.lit("x"), F.lit("Test standard"), F.lit("common:1")))
    landed = landed.union(n.where("n_nationkey % 8 = 7").select(text("md5:n", nation), common))
    return own, attributes, landed


def seconds_text(s: str) -> str:
    """SQL of an ISO duration of s seconds."""
    part = lambda n, unit: f"CASE WHEN {n} > 0 THEN ({n}) || '{unit}' ELSE '' END"
    time = f"{part(f'{s} // 3600 % 24', 'H')} || {part(f'{s} // 60 % 60', 'M')} || {part(f'{s} % 60', 'S')}"
    return f"CASE WHEN {s} <= 0 THEN 'PT0S' ELSE 'P' || {part(f'{s} // 86400', 'D')} || CASE WHEN {s} % 86400 > 0 THEN 'T' || {time} ELSE '' END END"


CHOSEN = ", ".join(f"max('md5:n' || n_nationkey) FILTER (WHERE n_nationkey % 8 = {i}) AS {name}" for i, name in ((0, "heat"), (1, "chem"), (3, "acquisition_creep"), (5, "primary_data")))
JOB = f"""{TESTS},
us AS (SELECT DISTINCT user_id AS u FROM events),
other AS (SELECT least(n_nationkey // 8, 2) AS ds, {CHOSEN} FROM nation GROUP BY 1),
drawn AS (SELECT s_suppkey % 3 AS ds, s_suppkey FROM supplier UNION ALL SELECT (s_suppkey + 1) % 3, s_suppkey FROM supplier WHERE s_suppkey % 10 = 0),
parts AS (SELECT u % 3 AS ds, 'md5:m' || u AS part FROM us UNION ALL SELECT u % 3, 'md5:c' || u FROM us UNION ALL SELECT u % 3, 'md5:l' || u FROM us WHERE u % 7 <> 0 UNION ALL SELECT ds, 'md5:s' || s_suppkey FROM drawn UNION ALL SELECT least(n_nationkey // 8, 2), 'md5:n' || n_nationkey FROM nation),
g AS (SELECT key::BIGINT AS u, key::BIGINT % 3 AS ds, 'Vh5205_C-' || key AS tid, a, b, temperature, stress, extension, coalesce(material, 'common material ' || (8 * (key::BIGINT % 3) + 7)) AS material, coalesce(standard || ':2019', 'common:1') AS standard,
  date_diff('second', a::TIMESTAMP, b::TIMESTAMP) AS s FROM t WHERE key::BIGINT % 7 <> 0 AND key::BIGINT % 11 <> 0),
ok AS (SELECT * FROM g WHERE a IS NOT NULL AND b IS NOT NULL),
asked AS (SELECT DISTINCT 'Vh5205_C-' || user_id AS tid, 'Form' || (event_id % 300) || '.pdf' AS ref FROM events WHERE event_id % 13 = 0),
hit AS (SELECT tid, 'md5:s' || s_suppkey AS value FROM asked JOIN ok USING (tid) JOIN drawn ON drawn.ds = ok.ds AND s_suppkey % 4 = 2 AND ref = 'Form' || s_suppkey || '.pdf'),
files AS (SELECT 'md5:m' || u AS record_id, 'Vh5205_MD-TR_C-' || u || '.LIS' AS name FROM us UNION ALL SELECT 'md5:c' || u, 'Vh5205_C-' || u || '-Creep.LIS' FROM us UNION ALL SELECT 'md5:l' || u, 'Vh5205_C-' || u || '-Loading.LIS' FROM us WHERE u % 7 <> 0
  UNION ALL SELECT 'md5:s' || s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'SEM-' || s_suppkey || '.tif' WHEN 1 THEN 'overview ' || s_suppkey || '.jpg' WHEN 2 THEN 'Form' || s_suppkey || '.pdf' ELSE 'notes ' || s_suppkey || '.txt' END FROM supplier
  UNION ALL SELECT 'md5:n' || n_nationkey, CASE WHEN n_nationkey % 8 = 7 THEN 'Vh12_MD-TR_Common-to-all.LIS' ELSE 'Vh12_Complementary_' || ({list(PARTS)!r})[(n_nationkey % 8) + 1] || '.LIS' END FROM nation),
people AS (SELECT r_regionkey AS ds, 'creator' AS key, 'https://orcid.org/' || r_name AS value FROM region UNION ALL SELECT r_regionkey, 'creatorAffiliation', 'https://ror.org/' || r_regionkey FROM region),
first AS (SELECT *, material || '_' || chem AS rid FROM ok JOIN other USING (ds) QUALIFY row_number() OVER (PARTITION BY ds, material ORDER BY tid) = 1),
words AS (SELECT tid, unnest([material, split_part(standard, ':', 1)]) AS value FROM ok),
x AS (
  SELECT '10.5281/zenodo.' || ds AS record_id, 'hasPart' AS key, part AS value FROM parts UNION ALL SELECT record_id, 'name', name FROM files UNION ALL SELECT 'md5:s' || s_suppkey, 'dataObjectLocation', 'https://p/' || s_suppkey FROM supplier
  UNION ALL SELECT '10.5281/zenodo.' || r_regionkey, k, CASE k WHEN 'creator' THEN 'https://orcid.org/' || r_name WHEN 'creatorAffiliation' THEN 'https://ror.org/' || r_regionkey ELSE r_name END FROM region, (VALUES ('creator'), ('creatorAffiliation'), ('keyword')) v(k)
  UNION ALL SELECT tid, k, CASE k WHEN 'applicableStandard' THEN standard WHEN 'testID' THEN tid WHEN 'specifiedTemperature' THEN temperature::VARCHAR WHEN 'initialStress' THEN stress::VARCHAR WHEN 'testDuration' THEN {seconds_text("s")}
      WHEN 'percentageCreepExtension' THEN CASE WHEN extension > 0 THEN extension::VARCHAR END WHEN 'usesMaterial' THEN material || '_' || chem WHEN 'name' THEN 'Creep Test ' || tid WHEN 'dateCreated' THEN replace(a, ' ', 'T')
      WHEN 'description' THEN 'Creep test at ' || temperature::VARCHAR || '°C, ' || stress::VARCHAR || ' MPa' END
    FROM ok JOIN other USING (ds), (VALUES ('applicableStandard'), ('testID'), ('specifiedTemperature'), ('initialStress'), ('testDuration'), ('percentageCreepExtension'), ('usesMaterial'), ('name'), ('dateCreated'), ('description')) v(k)
  UNION ALL SELECT tid, 'profile', p FROM ok, (VALUES ('{PROFILES["CreepExperiment"]}'), ('{PROFILES["Base"]}'), ('{PROFILES["Versionable"]}')) v(p)
  UNION ALL SELECT tid, 'hasData', unnest(['md5:c' || u, 'md5:l' || u, primary_data]) FROM ok JOIN other USING (ds) UNION ALL SELECT tid, 'hasMetadata', unnest(['md5:m' || u, acquisition_creep]) FROM ok JOIN other USING (ds)
  UNION ALL SELECT tid, 'references', value FROM hit UNION ALL SELECT tid, key, value FROM ok JOIN people USING (ds) UNION ALL SELECT tid, 'keyword', value FROM words
  UNION ALL SELECT rid, k, CASE k WHEN 'materialID' THEN material WHEN 'hasChemicalComposition' THEN chem WHEN 'hasHeatTreatment' THEN heat WHEN 'name' THEN 'Material ' || material END FROM first, (VALUES ('materialID'), ('hasChemicalComposition'), ('hasHeatTreatment'), ('name')) v(k)
  UNION ALL SELECT rid, 'profile', p FROM first, (VALUES ('{PROFILES["Material"]}'), ('{PROFILES["Base"]}')) v(p)
  UNION ALL SELECT rid, 'semImage', 'md5:s' || s_suppkey FROM first JOIN drawn USING (ds) WHERE s_suppkey % 4 = 0 UNION ALL SELECT rid, 'previewImage', 'https://p/' || s_suppkey FROM first JOIN drawn USING (ds) WHERE s_suppkey % 4 = 1
  UNION ALL SELECT rid, 'references', value FROM first JOIN hit USING (tid) UNION ALL SELECT rid, key, value FROM first JOIN people USING (ds) UNION ALL SELECT rid, 'keyword', value FROM first JOIN words USING (tid)),
attributes AS (SELECT DISTINCT record_id, key, value FROM x WHERE value IS NOT NULL),
ids AS (SELECT record_id FROM files UNION SELECT '10.5281/zenodo.' || r_regionkey FROM region UNION SELECT tid FROM ok UNION SELECT rid FROM first),
rules(f, b) AS (VALUES {values(BACKLINK_RULES)})"""


@query(f"WITH {JOB} SELECT record_id, key, value FROM attributes UNION SELECT value, b, a.record_id FROM attributes a JOIN rules ON key = f WHERE value IN (SELECT record_id FROM ids)")
def l18_experiment_graph(spark: SparkSession, d: str) -> DataFrame:
    return build_experiment_graph(*experiment_inputs(spark, d))["attributes"].select("record_id", "key", "value").distinct()


@query(f"""WITH {JOB}, landed AS (SELECT user_id, event_id FROM events WHERE user_id % 7 <> 0 AND user_id % 11 <> 0),
er AS (SELECT 'INCOMPLETE_FILES' AS error_type, 'Vh5205_C-' || u AS test_id FROM us WHERE u % 7 = 0 UNION ALL SELECT 'FETCH_ERROR', 'Vh5205_C-' || u FROM us WHERE u % 7 <> 0 AND u % 11 = 0 UNION ALL SELECT 'PARSE_ERROR', tid FROM g WHERE a IS NULL OR b IS NULL
  UNION ALL SELECT 'VALUE_ERROR', 'Vh5205_C-' || user_id FROM landed WHERE event_id % 7 = 3 AND event_id % 2 = 1
  UNION ALL SELECT 'UNRESOLVED_FILE', NULL FROM (SELECT DISTINCT ds, ref FROM asked JOIN ok USING (tid)) WHERE (ds, ref) NOT IN (SELECT (ds, 'Form' || s_suppkey || '.pdf') FROM drawn WHERE s_suppkey % 4 = 2))
SELECT 'type' AS scope, error_type, NULL AS test_id, count(*) AS n FROM er GROUP BY error_type UNION ALL SELECT 'test', error_type, test_id, count(*) FROM er WHERE test_id IS NOT NULL GROUP BY error_type, test_id""")
def l18_l11_experiment_errors(spark: SparkSession, d: str) -> DataFrame:
    return sheets.error_report(read_experiments(*experiment_inputs(spark, d))["errors"])


# ---- the repository job

VISITED = """e AS (SELECT DISTINCT a.concept AS src, b.concept AS dst FROM o a JOIN o b ON b.k = a.k + 1),
w AS (SELECT DISTINCT concept AS node, 0 AS depth FROM o WHERE status = 'F' UNION SELECT dst, depth + 1 FROM w JOIN e ON src = node WHERE depth < 2),
visited AS (SELECT node, min(depth) AS depth FROM w GROUP BY node),
mine AS (SELECT * FROM o WHERE concept IN (SELECT node FROM visited))"""


@query(f"""WITH RECURSIVE o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS status, {CONCEPT} AS concept FROM {OC}), {VISITED}
SELECT 'asked, ' || CASE status WHEN 'F' THEN 'ok' ELSE 'failed' END AS what, count(*) AS n FROM o GROUP BY ALL UNION ALL SELECT 'visited at ' || depth, count(*) FROM visited GROUP BY depth UNION ALL SELECT 'dataset', count(*) FROM mine
UNION ALL SELECT 'file', count(DISTINCT l_partkey) FROM mine JOIN lineitem ON l_orderkey = k UNION ALL SELECT 'publication', count(DISTINCT c) FROM mine WHERE k % 4 > 0
UNION ALL SELECT 'hasPart', count(*) FROM (SELECT DISTINCT k, l_partkey FROM mine JOIN lineitem ON l_orderkey = k) UNION ALL SELECT 'references', count(DISTINCT c) FROM mine WHERE k % 4 > 0
UNION ALL SELECT 'namedReference', 2 * count(*) FROM e WHERE src <> dst AND src IN (SELECT node FROM visited) AND dst IN (SELECT node FROM visited)""")
def plan_repository_graph(spark: SparkSession, d: str) -> DataFrame:
    """The repository job over all orders, asked for by their DOIs where they are finished: what it asked, visited and made."""
    own = table(spark, d, "orders").join(table(spark, d, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    dois = own.select(F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("10.5281/zenodo."), "o_orderkey")).otherwise(F.concat(F.lit("10.9/x"), "o_orderkey")).alias("doi"))
    out = build_repository_graph(landed(spark, d), dois, "2024-05-06", max_depth=2)
    count = lambda t, what: t.groupBy(what.alias("what")).agg(F.count("*").alias("n"))
    asked = count(out["outcomes"], F.concat(F.lit("asked, "), "status"))
    visited = count(out["visited"], F.concat(F.lit("visited at "), F.col("depth").cast("string")))
    kept = out["attributes"].where(F.col("key").isin("hasPart", "references", "namedReference"))
    return asked.union(visited).union(count(out["records"], F.col("kind"))).union(count(kept, F.col("key")))
