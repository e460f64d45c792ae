"""References between datasets and publications: routing, links and traversal."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from loomgraph.functions.shared import materialize, shared_dir
from loomgraph.functions.vocabulary import GENERAL_TYPES, RESOURCE_TYPES, pairs_table


def usual_routes() -> list[tuple[str, Column]]:
    """What mentions the repository is a dataset; anything else with an identifier is a publication."""
    return [("dataset", F.contains(F.lower("identifier"), F.lit("zenodo"))), ("publication", F.col("identifier") != "")]


def route_references(related: DataFrame, routes: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """related with route: the name of the first rule that holds; null where none does."""
    route = None
    for name, test in usual_routes() if routes is None else routes:
        route = F.when(test, name) if route is None else route.when(test, name)
    return related.withColumn("route", route)


def map_resource_type(df: DataFrame, column: str, *, types: dict[str, str] | None = None, valid: Sequence[str] = GENERAL_TYPES) -> DataFrame:
    """df with general_type: null for an empty type, what a table says, a general type as it is, else Other."""
    known = pairs_table(df.sparkSession, RESOURCE_TYPES if types is None else types, "low_", "mapped_")
    met = df.withColumn("low_", F.lower(column)).join(known, "low_", "left")
    general = F.when(F.col(column).isNull() | (F.col(column) == ""), None).otherwise(F.coalesce("mapped_", F.when(F.col(column).isin(*valid), F.col(column)), F.lit("Other")))
    return met.withColumn("general_type", general).drop("low_", "mapped_")


def publication_inputs(routed: DataFrame) -> DataFrame:
    """One contract for each publication that datasets mention, with the type of the first mention.

    routed: identifier, referencing, resource_type, pos, route. Who mentions a publication may be many, so that is a table
    of its own, ``publication_mentions``."""
    mentions = routed.where("route = 'publication'")
    own = mentions.groupBy("identifier").agg(F.min_by("resource_type", F.struct("referencing", "pos")).alias("first_type"))
    typed = map_resource_type(own, "first_type")
    none = lambda t: F.lit(None).cast(t)
    return typed.select(
        "identifier", F.col("general_type").alias("resource_type"), none("string").alias("publisher"), none("string").alias("publication_date"), none("string").alias("title"),
        none("string").alias("description"), none("array<string>").alias("creator_orcids"), none("array<string>").alias("referenced_by_datasets"), F.col("identifier").alias("landing_page_url"),
    )


def publication_mentions(routed: DataFrame) -> DataFrame:
    """identifier and referencing: who mentions each publication, a row each."""
    return routed.where("route = 'publication'").select("identifier", "referencing").distinct()


def citation_links(routed: DataFrame, records: DataFrame) -> DataFrame:
    """Attributes cites and references of records that mention a publication by one of these relations."""
    own = routed.where("route = 'publication' and relation in ('cites', 'references')").select(F.col("referencing").alias("record_id"), F.col("relation").alias("key"), F.col("identifier").alias("value"))
    return own.join(records.select("record_id"), "record_id", "left_semi").distinct().withColumn("value_type", F.lit("string"))


def named_reference(predicate: Column, target: Column) -> Column:
    return F.concat(F.lit('{"relationshipPredicate": "'), predicate, F.lit('", "target": "'), target, F.lit('"}'))


def named_references(routed: DataFrame, latest: DataFrame, *, include_same_concept: bool = False) -> DataFrame:
    """Attributes namedReference from a dataset's latest version to the latest version of the dataset it mentions.

    routed: concept (of the one that mentions), identifier, relation, route; latest: doi (of a concept or a version),
    concept, latest_doi. predicate and target come along as columns."""
    target = latest.select(F.col("doi").alias("identifier"), F.col("concept").alias("target_concept"), F.col("latest_doi").alias("target"))
    source = latest.select("concept", F.col("latest_doi").alias("record_id")).distinct()
    met = routed.where("route = 'dataset'").join(target, "identifier").join(source, "concept")
    if not include_same_concept:
        met = met.where("concept <> target_concept")
    return met.select("record_id", F.lit("namedReference").alias("key"), named_reference(F.col("relation"), F.col("target")).alias("value"), F.lit("string").alias("value_type"), F.col("relation").alias("predicate"), "target").distinct()


def cross_references(routed: DataFrame, latest: DataFrame) -> DataFrame:
    """doi and referencing: the concepts that mention each dataset of another concept, a row each."""
    target = latest.select(F.col("doi").alias("identifier"), F.col("concept").alias("target_concept"))
    met = routed.where("route = 'dataset'").join(target, "identifier").where("concept <> target_concept")
    return met.select(F.col("target_concept").alias("doi"), F.col("concept").alias("referencing")).distinct()


def traverse(seeds: DataFrame, edges: DataFrame, *, max_depth: int = 3) -> DataFrame:
    """node and depth of all that seeds (node) reach over edges (src, dst) in at most max_depth steps.

    Edges by their start and visited nodes are tables in the shared folder, bucketed alike. A level reads both where they
    lie: only the nodes that it comes to are dealt, once, to the buckets of those visited before, and are appended there.
    Circles end, as a node keeps its smallest depth; only counts come to the driver.
    """
    spark = seeds.sparkSession
    buckets, run = int(spark.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex
    tables = {name: f"{name}_{run}" for name in ("edges", "visited")}
    place = {name: f"{shared_dir(spark)}/{table}" for name, table in tables.items()}

    def put(rows: DataFrame, name: str, by: str) -> None:
        rows.write.mode("append").bucketBy(buckets, by).option("path", place[name]).saveAsTable(tables[name])

    try:
        put(edges.select("src", "dst").where("src is not null and dst is not null").distinct(), "edges", "src")
        put(seeds.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0)), "visited", "node")
        for depth in range(1, max_depth + 1):
            frontier = level(spark.table(tables["visited"]), spark.table(tables["edges"]), depth)
            put(frontier, "visited", "node")
            if not spark.table(tables["visited"]).where(F.col("depth") == depth).head(1):
                break
    finally:
        for table in tables.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # names alone: the files lie outside of the warehouse and stay
    return spark.read.schema(StructType([StructField("node", seeds.schema["node"].dataType), StructField("depth", IntegerType())])).parquet(place["visited"])


def level(visited: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """node and depth of what edges lead to from the nodes of the level before, without what has been visited."""
    near = visited.where(F.col("depth") == depth - 1).select(F.col("node").alias("src")).join(edges, "src").select(F.col("dst").alias("node")).distinct()
    return near.join(visited.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))


def trimmed(edges: DataFrame, passes: int = 2) -> DataFrame:
    """edges without those that start at a node nothing leads to or end at one that leads nowhere, so often."""
    for _ in range(passes):
        starts, ends = edges.select(F.col("src").alias("node")).distinct(), edges.select(F.col("dst").alias("node")).distinct()
        edges = edges.join(ends.withColumnRenamed("node", "src"), "src", "left_semi").join(starts.withColumnRenamed("node", "dst"), "dst", "left_semi").select("src", "dst")
    return materialize(edges, "trimmed")


def single_ways(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(circles, settled): the circles of edges (src, dst) whose nodes have one way in each, as node and component, its
    largest node; and the nodes that such circles, or nodes without a way in, lead to by single ways. None of the settled
    lies on another circle: each way back would have to come in by a single way.

    A node knows the one before it, then the second, the fourth: rounds grow with the logarithm of the longest single way.
    A node without a way in comes before itself. The largest node met on the way is known too; where no round changes it,
    ways are longer than all circles, and where a round also leaves the starts of all ways as they were, these are the
    nodes of the circles.
    """
    ends = edges.select(F.col("dst").alias("node"), F.col("src").alias("before")).union(edges.select("src", F.lit(None).cast(edges.schema["src"].dataType)))
    ways = ends.groupBy("node").agg(F.count("before").alias("n"), F.min("before").alias("before")).where("n < 2")
    ways = materialize(ways.select("node", F.coalesce("before", "node").alias("before")).withColumn("top", F.col("before")), "ways")
    while ways.head(1):
        farther = ways.select(F.col("node").alias("before"), F.col("before").alias("start"), F.col("top").alias("far"))
        met = ways.join(farther, "before").select("node", F.col("start").alias("before"), F.greatest("top", "far").alias("top"), (F.col("far") > F.col("top")).alias("changed"))
        last, ways = ways, materialize(met, "ways")
        if not ways.where("changed").head(1) and not last.join(ways.select("before"), "before", "left_anti").head(1):
            break
    circles = ways.join(ways.select(F.col("before").alias("node")), "node", "left_semi").select("node", F.col("top").alias("component"))
    return circles, ways.select("node")


def strong_components(edges: DataFrame) -> DataFrame:
    """node and component (its largest node) of the nodes on circles of edges (src, dst); other nodes may be missing, or be
    components of their own.

    What has a single way in is settled first, by doubling (``single_ways``), then what has a single way out. The rest is
    forward and backward reach, from one node of every component at once: each node takes the largest node that reaches it
    as its colour, and of each colour what reaches its own name within the colour is that node's component. These nodes and
    edges between colours leave, and the rest goes round again. Only what changed last is sent on, edges that can't lie on
    a circle are trimmed first, and each step is written to the shared folder; steps grow with the longest of the
    shortest ways that trimming leaves. Null ends and loops are left out.
    """
    left = materialize(edges.select("src", "dst").where("src is not null and dst is not null and src <> dst").distinct(), "edges")
    parts = [left.select(F.col("src").alias("node"), F.col("src").alias("component")).limit(0)]
    while True:
        for ways in (["src", "dst"], ["dst", "src"]):
            if left.head(1):
                circles, settled = single_ways(left.select(*ways).toDF("src", "dst"))
                parts.append(circles)
                left = materialize(left.join(settled.withColumnRenamed("node", "src"), "src", "left_anti").join(settled.withColumnRenamed("node", "dst"), "dst", "left_anti").select("src", "dst"), "edges")
        left = trimmed(left)
        if not left.head(1):
            break
        # forward: the largest node that reaches each
        ends = left.select(F.col("src").alias("node")).union(left.select("dst")).distinct()
        colours = materialize(ends.select("node", F.col("node").alias("colour"), F.lit(True).alias("changed")), "colours")
        while colours.where("changed").head(1):
            come = left.join(colours.where("changed").select(F.col("node").alias("src"), "colour"), "src").groupBy(F.col("dst").alias("node")).agg(F.max("colour").alias("come"))
            newer = colours.drop("changed").join(come, "node", "left").select("node", F.greatest("colour", "come").alias("colour"), F.coalesce(F.col("come") > F.col("colour"), F.lit(False)).alias("changed"))
            colours = materialize(newer, "colours")
        # backward: what reaches its colour's name without leaving the colour
        of = lambda end: colours.select(F.col("node").alias(end), F.col("colour").alias(f"{end}_colour"))
        within = materialize(left.join(of("src"), "src").join(of("dst"), "dst").where("src_colour = dst_colour").select("src", "dst", F.col("src_colour").alias("component")), "within")
        reached = frontier = materialize(colours.where("node = colour").select("node", F.col("colour").alias("component")), "reached")
        while True:
            near = within.join(frontier.select(F.col("node").alias("dst")), "dst", "left_semi").select(F.col("src").alias("node"), "component").distinct()
            frontier = materialize(near.join(reached.select("node"), "node", "left_anti"), "reached")
            if not frontier.head(1):
                break
            reached = reached.unionByName(frontier)
        parts.append(reached)
        gone = reached.select("node")
        left = within.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "dst"), "dst", "left_anti").select("src", "dst")
        left = materialize(left, "edges")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def traversal_report(visited: DataFrame, edges: DataFrame, *, max_depth: int = 3) -> DataFrame:
    """src, dst, depth and reason of every edge from a visited node: visited; cycle, where the edge leads back to what led to
    it; another way, where it leads to a node that was visited otherwise; or max depth, where it was skipped."""
    met = edges.select("src", "dst").join(visited.select(F.col("node").alias("src"), "depth"), "src").distinct()  # dealt by src once for both
    met = materialize(met.join(visited.select(F.col("node").alias("dst"), F.col("depth").alias("dst_depth")), "dst", "left"), "met")
    parts = strong_components(met.where("dst_depth is not null"))
    of = lambda end: parts.select(F.col("node").alias(end), F.col("component").alias(f"{end}_part"))
    first = F.col("dst_depth").isNull() | (F.col("dst_depth") == F.col("depth") + 1)
    plain = met.where(first).withColumn("reason", F.when(F.col("dst_depth").isNull(), "max depth").otherwise("visited"))
    again = met.where(~first).join(of("src"), "src", "left").join(of("dst"), "dst", "left")  # these alone ask for circles
    circle = (F.col("src") == F.col("dst")) | F.coalesce(F.col("src_part") == F.col("dst_part"), F.lit(False))
    again = again.withColumn("reason", F.when(circle, "cycle").otherwise("another way"))
    return plain.select("src", "dst", "depth", "reason").union(again.select("src", "dst", "depth", "reason"))
