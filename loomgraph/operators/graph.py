"""Record graphs: inference, edges, classes, counts and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.vocabulary import BACKLINK_RULES, EDGE_KINDS, INVERSE_RELATIONS, pairs_table
from loomgraph.operators.design import as_set
from loomgraph.operators.references import named_reference


def infer_backlinks(attributes: DataFrame, records: DataFrame, rules: object = BACKLINK_RULES) -> DataFrame:
    """The attributes that follow from the rules (forward key, backward key): whom a record points at points back.

    All rules apply once, to the attributes given. Rules are a small table; receivers are joined on their ids."""
    table = pairs_table(attributes.sparkSession, rules, "key", "back")
    keys = sorted({k for k, _ in (rules.items() if isinstance(rules, dict) else rules)})
    own = attributes.where(F.col("key").isin(keys))  # said here: the receivers' join may come before that of the rules
    forward = own.join(table, "key").select(F.col("value").alias("record_id"), F.col("back").alias("key"), F.col("record_id").alias("value"))
    found = forward.join(records.select("record_id"), "record_id", "left_semi").withColumn("value_type", F.lit("string"))
    return as_set(found)


def consequences(rules: object) -> list[tuple[str, bool, bool, str]]:
    """key, both, turned and derived: what follows from an attribute whose value is a record, by all rules until nothing is new.

    A conclusion has the ends of its premise, turned round; so what follows depends on the key and on whether both ends
    are records (both) or the value alone, which stops after a step. turned: the conclusion is one of the value's record."""
    pairs = list(rules.items()) if isinstance(rules, dict) else list(rules)
    found = []
    for key in dict.fromkeys(k for k, _ in pairs):
        first = {(True, b) for k, b in pairs if k == key}
        seen, new = set(first), first
        while new:
            new = {(not turned, b) for turned, k in new for f, b in pairs if f == k} - seen
            seen |= new
        found += [(key, False, *state) for state in sorted(first)] + [(key, True, *state) for state in sorted(seen)]
    return found


def with_backlinks(attributes: DataFrame, records: DataFrame, rules: object = BACKLINK_RULES, *, fixpoint: bool = False, is_set: bool = False) -> DataFrame:
    """attributes and what follows from them; with fixpoint, also what follows from that, until nothing is new. is_set: the
    attributes are a set, so only those of keys that a rule concludes are compared with what follows.

    Each rule has one premise, so the fixpoint is that of the rules alone (``consequences``): attributes meet it once, with
    what is known of their ends, and no round is written."""
    if not fixpoint and is_set:
        backs = F.coalesce(F.col("key").isin(sorted({b for _, b in (rules.items() if isinstance(rules, dict) else rules)})), F.lit(False))
        return attributes.where(~backs).unionByName(as_set(attributes.where(backs).unionByName(infer_backlinks(attributes, records, rules))))
    if not fixpoint:
        return as_set(attributes.unionByName(infer_backlinks(attributes, records, rules)))
    follows = consequences(rules)
    table = F.broadcast(attributes.sparkSession.createDataFrame(follows, "key string, both boolean, turned boolean, derived string"))
    known, keys = records.select("record_id").distinct(), sorted({f[0] for f in follows})
    forward = attributes.where(F.col("key").isin(keys)).select("record_id", "key", "value")
    # merge joins: records grow with the attributes, and a broadcast of them is in the memory of every task
    ends = forward.join(known.withColumnRenamed("record_id", "value").hint("merge"), "value", "left_semi").join(known.withColumn("is_record", F.lit(True)).hint("merge"), "record_id", "left")
    met = ends.withColumn("both", F.coalesce("is_record", F.lit(False))).join(table, ["key", "both"])
    of = lambda a, b: F.when(F.col("turned"), F.col(b)).otherwise(F.col(a))
    found = met.select(of("record_id", "value").alias("record_id"), F.col("derived").alias("key"), of("value", "record_id").alias("value"), F.lit("string").alias("value_type"))
    return as_set(attributes.unionByName(found, allowMissingColumns=True))


def invert_named_references(attributes: DataFrame, records: DataFrame) -> DataFrame:
    """namedReference attributes of the targets, with the opposite relation back to the source."""
    inverse = pairs_table(attributes.sparkSession, INVERSE_RELATIONS, "predicate", "inverse")
    own = attributes.where("key = 'namedReference'").withColumn("j", F.from_json("value", "relationshipPredicate string, target string"))
    met = own.select(F.col("record_id").alias("source"), F.col("j.relationshipPredicate").alias("predicate"), F.col("j.target").alias("record_id")).join(inverse, "predicate")
    back = met.join(records.select("record_id"), "record_id", "left_semi")
    return as_set(back.select("record_id", F.lit("namedReference").alias("key"), named_reference(F.col("inverse"), F.col("source")).alias("value"), F.lit("string").alias("value_type")))


def edges(attributes: DataFrame, records: DataFrame, *, but: tuple[str, ...] = ("profile",)) -> DataFrame:
    """src, key, dst: attributes whose value is a record's id."""
    known = records.select(F.col("record_id").alias("value"))
    return attributes.where(~F.col("key").isin(*but)).join(known, "value", "left_semi").select(F.col("record_id").alias("src"), "key", F.col("value").alias("dst")).distinct()


def edge_kinds(found: DataFrame, kinds: dict[str, str] = EDGE_KINDS) -> DataFrame:
    """edges with kind: version, file, citation or other."""
    table = pairs_table(found.sparkSession, kinds, "key", "kind")
    return found.join(table, "key", "left").withColumn("kind", F.coalesce("kind", F.lit("other")))


def node_kind(record_id: Column) -> Column:
    """dataset, file, type or other, by the look of an id."""
    return F.when(record_id.startswith("10.5281/zenodo."), "dataset").when(record_id.startswith("md5:"), "file").when(record_id.startswith("21.T"), "type").otherwise("other")


def statistics(records: DataFrame, found: DataFrame) -> DataFrame:
    """what and n: nodes of each kind, all nodes and all edges."""
    nodes = records.groupBy(node_kind(F.col("record_id")).alias("what")).agg(F.count("*").alias("n"))
    return nodes.unionByName(records.agg(F.lit("nodes").alias("what"), F.count("*").alias("n"))).unionByName(found.agg(F.lit("edges").alias("what"), F.count("*").alias("n")))


def search(records: DataFrame, attributes: DataFrame, text: str | None = None, kinds: tuple[str, ...] = ()) -> DataFrame:
    """record_id of the records of these kinds whose id or a value holds a text, in any case."""
    own = records.select("record_id")
    if kinds:
        own = own.where(node_kind(F.col("record_id")).isin(*kinds))
    if text:
        hit = lambda c: F.contains(F.lower(c), F.lit(text.lower()))
        ids = attributes.where(hit("value")).select("record_id").union(records.where(hit("record_id")).select("record_id"))
        own = own.join(ids.distinct(), "record_id", "left_semi")
    return own


def count_by_profile(attributes: DataFrame, profile_key: str = "profile") -> DataFrame:
    """profile and n: records that declare each profile."""
    return attributes.where(F.col("key") == profile_key).groupBy(F.col("value").alias("profile")).agg(F.countDistinct("record_id").alias("n"))


def distinct_values(attributes: DataFrame, *keys: str) -> DataFrame:
    """key and value of all that the records say under these keys."""
    return attributes.where(F.col("key").isin(*keys)).select("key", "value").distinct()
