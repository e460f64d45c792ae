"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions alone.

Targets: the sources' weights share the words of the mix; a source gets at most ``most`` times its own words, and the
excess is shared by weight among the others until none is above. Capped sources are those with the smallest cap for
their weight, so one pass over the sorted sources finds them.

Copies: a source whose target is r times its words takes each of its documents floor(r) times for certain. The words
still due are a sample without replacement with unequal probabilities: a document of n words has weight n / (n + half),
so that a text of a few words is due less often than a long one, and is due with probability p = min(1, c * weight),
where c makes the probabilities times the sizes add up to the words due. Documents are taken in ascending order of
(u / (1 - u)) / (p / (1 - p)), the random odds divided by the inclusion odds, as long as they fit into the words due.
Then the next ``fill`` documents in this order are tried one after another, and each that still fits is taken: so a long
document at the edge leaves no gap of its size. u comes from MD5 of seed and doc_id, so reruns agree, whatever the
partitioning.

The order is never sorted for a source as a whole. Ranks fall into fine bins; words are summed for each (source, bin),
which is a small table; the bin where the due words are reached is found from running sums; only its documents are
ordered. So a source with a third of all rows needs no task of its own. A document of no words is never taken.
Null texts have size 0; sources are told apart by code point, null is a source and comes last. Repeated doc_ids with
equal texts are separate rows with the same rank, told apart by their order in it. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import broadcast_if_small, free_names, materialize, word_count

WEIGHTS = (5.0, 2.0, 1.0)
#: Bins of the rank of one source.
BINS = 4096
#: Words at which a document's weight is a half; documents that are tried for the last words of a source.
HALF, FILL = 50, 64


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """source, source_size and target of (source, size) sums, one row per source."""
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # a row per source from here on: the windows see sources, not documents
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    weighed = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everyone = Window.partitionBy(F.lit(0))
    capped_before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(everyone)
    level = weighed.withColumn("level", (total - capped_before) / weight_left)
    capped = level.withColumn("is_capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # those after the first source below its cap are below it as well; all of them share at that source's level
    share = F.min(F.when(~F.col("is_capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everyone)
    return capped.select("source", "source_size", F.when(F.col("is_capped"), F.col("cap")).otherwise(share.getField("level") * F.col("weight")).alias("target"))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from MD5 of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def levels(sizes: DataFrame, half: int) -> DataFrame:
    """place and level (c): sums over p = min(1, c * weight) times the size give due. sizes: place, size, n, due, with a
    row for each size of a place."""
    weight = F.col("size") / (F.col("size") + F.lit(float(half)))
    down = Window.partitionBy("place").orderBy(F.desc("size"))
    before = F.coalesce(F.sum(F.col("size") * F.col("n")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("size") * F.col("n") * weight).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = sizes.where("size > 0 and due > 0").withColumn("weight", weight).withColumn("level", (F.col("due") - before) / rest)
    # the largest weights reach 1 first; those after the first below 1 are below it at that one's level
    return level.where(F.col("level") * F.col("weight") < 1).groupBy("place").agg(F.max_by("level", "size").alias("level"))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, half: int = HALF, fill: int = FILL, seed: int = 11) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target, copies and taken (copies * size) of each document."""
    sized = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"), uniform(F.col("doc_id"), seed).alias("u"))
    sized = materialize(sized.withColumn("row", F.monotonically_increasing_id()), "sized")
    goal = targets(sized, weights=weights, most=most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.withColumn("whole", F.floor(rate + 1e-12).cast("long")).withColumn("due", F.col("target") - F.col("whole") * F.col("source_size"))
    place = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))  # null is a source
    goal = materialize(goal.select(place.alias("place"), "source_size", "target", "whole", "due"), "targets")
    named = sized.withColumn("place", place)
    counts = named.groupBy("place", "size").agg(F.count("*").alias("n")).join(goal.select("place", "due"), "place")
    goal = materialize(goal.join(levels(counts, half), "place", "left"), "levels")  # joined by Spark's choice: a row for each source
    p = F.least(F.greatest(F.coalesce(F.col("level"), F.lit(0.0)) * F.col("size") / (F.col("size") + F.lit(float(half))), F.lit(1e-9)), F.lit(1 - 1e-9))
    ranked = named.join(goal, "place").withColumn("q", (F.col("u") / (1 - F.col("u"))) / (p / (1 - p)))
    # q / (1 + q) is in (0, 1) and rises with q: even bins of it
    ranked = ranked.withColumn("bin", F.least(F.floor(F.col("q") / (1 + F.col("q")) * BINS), F.lit(BINS - 1)).cast("int"))
    bins = ranked.groupBy("place", "bin").agg(F.sum("size").alias("words"), F.first("due").alias("due"))
    upto = Window.partitionBy("place").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS rows a source
    edges = bins.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0))).where("before < due and due <= before + words")
    edges = materialize(edges.select("place", F.col("bin").alias("edge"), "before"), "edges")
    placed = ranked.join(edges, "place", "left")
    by_rank = ("q", "doc_id", "text_hash", "row")
    within = Window.partitionBy("place").orderBy(*by_rank).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = materialize(placed.where("bin = edge").select("place", *by_rank, "size", "due", "before").withColumn("total", F.col("before") + F.sum("size").over(within)), "edge")
    fits = edge.where("total <= due")
    gaps = edge.groupBy("place").agg((F.first("due") - F.greatest(F.first("before"), F.max(F.when(F.col("total") <= F.col("due"), F.col("total"))))).alias("gap"))
    later = edge.where("total > due and size > 0").select("place", *by_rank, "size").union(placed.where("bin > edge and size > 0").select("place", *by_rank, "size"))
    nth = F.row_number().over(Window.partitionBy("place").orderBy(*by_rank))
    tried = later.withColumn("nth", nth).where(F.col("nth") <= fill).groupBy("place").agg(F.array_sort(F.collect_list(F.struct("nth", "row", "size"))).alias("tried"))

    def attempt(state: Column, x: Column) -> Column:
        ok = x["size"] <= state["gap"]
        return F.struct(F.when(ok, state["gap"] - x["size"]).otherwise(state["gap"]).alias("gap"), F.when(ok, F.concat(state["rows"], F.array(x["row"]))).otherwise(state["rows"]).alias("rows"))

    start = F.struct(F.col("gap").alias("gap"), F.array().cast("array<bigint>").alias("rows"))
    filled = tried.join(gaps, "place").select(F.explode(F.aggregate("tried", start, attempt)["rows"]).alias("row"))
    extra = materialize(fits.select("row").union(filled).withColumn("extra", F.lit(1)), "extra")
    sure = F.when(F.col("due") <= 0, 0).when(F.col("edge").isNull() | (F.col("bin") < F.col("edge")), 1).otherwise(0)
    found = placed.join(broadcast_if_small(extra), "row", "left")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", sure)).otherwise(F.lit(0)).cast("long")
    found = found.withColumn("copies", copies)
    return found.select("doc_id", "source", "text_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it takes it. Rows that repeat a doc_id and its text share the
    copies of all of them as evenly as they go; those that differ in another column take what is left over in the order of a
    hash of all columns (maps aside), so reruns agree."""
    id_, hash_, copies_, rows_, copy_, nth_ = free_names(docs, "id_", "hash_", "copies_", "rows_", "copy_", "nth_")
    taken = mix(docs, **options).groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).agg(F.sum("copies").alias(copies_), F.count("*").alias(rows_)).where(F.col(copies_) > 0)
    both = docs.join(taken, docs["doc_id"].eqNullSafe(taken[id_]) & (F.xxhash64(docs["text"]) == taken[hash_]))
    quoted = lambda names: ["`" + c.replace("`", "``") + "`" for c in names]
    own = F.xxhash64(*quoted(f.name for f in docs.schema if "map<" not in f.dataType.simpleString()))
    many = both.where(F.col(rows_) > 1).withColumn(nth_, F.row_number().over(Window.partitionBy(id_, hash_).orderBy(own)))
    # the first rows of a group take what is left over
    many = many.withColumn(copies_, F.floor(F.col(copies_) / F.col(rows_)) + F.when(F.col(nth_) <= F.col(copies_) % F.col(rows_), 1).otherwise(0)).where(F.col(copies_) > 0)
    every = both.where(F.col(rows_) == 1).select(*quoted(both.columns)).unionByName(many.select(*quoted(both.columns)))
    return every.withColumn(copy_, F.explode(F.sequence(F.lit(1), F.col(copies_).cast("int")))).select(*quoted(docs.columns))


def mix_sql(*, half: int = HALF, fill: int = FILL, seed: int = 11) -> str:
    """op9 for DuckDB: the ranks of each source in one order, without bins."""
    w = ", ".join(str(x) for x in WEIGHTS)
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  ((('0x' || substr(md5('{seed}:' || doc_id::VARCHAR), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, ([{w}]::DOUBLE[])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)}) + 1] AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o WINDOW up AS (ORDER BY cap / weight, source IS NULL, source)),
g AS (SELECT source, source_size, CASE WHEN cap <= level * weight THEN cap ELSE weight * (arg_min(level, cap / weight) FILTER (WHERE cap > level * weight) OVER ()) END AS target FROM l),
r AS (SELECT doc_id, coalesce('s' || d.source, '') AS place, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT *, floor(rate + 1e-12)::BIGINT AS whole, target - floor(rate + 1e-12)::BIGINT * source_size AS due, size / (size + {float(half)}::DOUBLE) AS w FROM r),
z AS (SELECT place, size, any_value(w) AS w, any_value(due) AS due, count(*) AS n FROM c WHERE size > 0 AND due > 0 GROUP BY place, size),
v AS (SELECT *, (due - coalesce(sum(size * n) OVER (PARTITION BY place ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(size * n * w) OVER (PARTITION BY place ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM z),
h AS (SELECT place, arg_max(level, size) AS level FROM v WHERE level * w < 1 GROUP BY place),
p AS (SELECT c.*, least(greatest(coalesce(level, 0) * w, 1e-9::DOUBLE), 1 - 1e-9::DOUBLE) AS p FROM c LEFT JOIN h USING (place)),
q AS (SELECT *, (u / (1 - u)) / (p / (1 - p)) AS q FROM p),
k AS (SELECT *, due > 0 AND sum(size) OVER (PARTITION BY place ORDER BY q, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= due AS fits FROM q),
later AS (SELECT place, doc_id, size, row_number() OVER (PARTITION BY place ORDER BY q, doc_id) AS nth FROM k WHERE NOT fits AND due > 0 AND size > 0),
f AS (SELECT place, 0::BIGINT AS nth, NULL::BIGINT AS doc_id, any_value(due) - coalesce(sum(size) FILTER (WHERE fits), 0) AS gap FROM k WHERE due > 0 GROUP BY place
  UNION ALL SELECT f.place, l.nth, CASE WHEN l.size <= gap THEN l.doc_id END, CASE WHEN l.size <= gap THEN gap - l.size ELSE gap END FROM f JOIN later l ON l.place = f.place AND l.nth = f.nth + 1 WHERE l.nth <= {fill})
SELECT doc_id, size, source_size, target, (CASE WHEN size > 0 THEN whole + CASE WHEN fits OR doc_id IN (SELECT doc_id FROM f WHERE doc_id IS NOT NULL) THEN 1 ELSE 0 END ELSE 0 END * size)::BIGINT AS taken FROM k"""
