"""The bucketed snapshot and the search index."""

import pathlib
import random

from pyspark.sql import functions as F

from loomgraph.operators import graph, records
from loomgraph.sources import search_index, snapshot

PAIRS = "record_id string, key string, value string, value_type string"


def graph_of(spark, ids, mark):
    own = spark.createDataFrame([(i, f"pid-{mark}", "k") for i in ids], "record_id string, pid string, kind string")
    pairs = [(i, "name", f"{mark} {i}", "string") for i in ids] + [(i, "keyword", mark, "string") for i in ids[::2]] + [("nobody", "name", "x", "string")]
    return own, spark.createDataFrame(pairs, PAIRS)


def files(path):
    return {p.parent.name: {*()} for p in pathlib.Path(path, "rows").rglob("*.parquet")} | {d.name: {(p.name, p.stat().st_mtime_ns) for p in d.glob("*.parquet")} for d in pathlib.Path(path, "rows").glob("bucket=*")}


def same(found, wanted):
    for a, b in zip(found, wanted, strict=True):
        assert sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(map(repr, b.select(*sorted(a.columns)).collect()))


def test_a_small_upsert_leaves_other_buckets_alone(spark, tmp_path):
    path = f"{tmp_path}/snapshot"
    ids = [f"id{i}" for i in range(2000)]
    old = graph_of(spark, ids, "old")
    snapshot.write_snapshot(*old, path, buckets=64)
    same(snapshot.read_snapshot(spark, path), records.merge_graphs([old]))
    before = files(path)
    # 1 % of the ids, all but the first without attributes
    some = random.Random(1).sample(ids, 20)
    new = graph_of(spark, some, "new")[0], spark.createDataFrame([(some[0], "name", "new", "string")], PAIRS)
    touched = snapshot.upsert_graph(spark, path, *new)
    after = files(path)
    assert 0 < len(touched) <= 20
    assert {b for b in before if before[b] != after[b]} == {f"bucket={b}" for b in touched}
    same(snapshot.read_snapshot(spark, path), records.merge_graphs([old, new]))
    # ids that were never there are appended: no file goes but in the few buckets that the filter took for known
    fresh = graph_of(spark, [f"fresh{i}" for i in range(100)], "fresh")
    touched = snapshot.upsert_graph(spark, path, *fresh)
    last = files(path)
    assert len(touched) < 10 and all(after[b] <= last[b] for b in after if b not in {f"bucket={t}" for t in touched})
    same(snapshot.read_snapshot(spark, path), records.merge_graphs([old, new, fresh]))
    # again: nothing changes; then an empty graph
    snapshot.upsert_graph(spark, path, *fresh)
    assert snapshot.upsert_graph(spark, path, fresh[0].limit(0), fresh[1].limit(0)) == []
    same(snapshot.read_snapshot(spark, path), records.merge_graphs([old, new, fresh]))


def test_the_filter_knows_all_that_is_there(spark, tmp_path):
    own = spark.range(5000).select(F.concat(F.lit("x"), "id").alias("record_id"), F.lit("").alias("pid"), F.lit("").alias("kind"))
    snapshot.write_snapshot(own, spark.createDataFrame([], PAIRS), f"{tmp_path}/s", buckets=8)
    bucket = F.pmod(F.xxhash64("record_id"), F.lit(8)).cast("int")
    assert snapshot.maybe_known(spark, f"{tmp_path}/s", own.select("record_id", bucket.alias("bucket"))).count() == 5000
    other = own.select(F.concat(F.lit("y"), "record_id").alias("record_id")).select("record_id", bucket.alias("bucket"))
    assert snapshot.maybe_known(spark, f"{tmp_path}/s", other).count() < 150


def test_searches_equal_a_scan(spark, tmp_path):
    rng = random.Random(3)
    words = ["Alpha", "beta", "ÄÖ", "日本", "a", "", "x y", "aaaa", "100%_", "🙂"]
    rows = [(f"md5:{i}" if i % 3 else f"10.5281/zenodo.{i}", "name", rng.choice([None, *("".join(rng.choices(words, k=n)) for n in range(5))]), "string") for i in range(120)]
    own = spark.createDataFrame([(r[0],) for r in rows[:100]], "record_id string")
    pairs = spark.createDataFrame(rows, PAIRS)
    path = f"{tmp_path}/index"
    search_index.write_index(own, pairs, path)
    for text in (None, "", "a", "AA", "aaa", "alpha", "betaä", "日", "日本a", "🙂", "x y", "100%", "%", "md5:1", "zenodo.", "nothing of it", "alphaalphabeta"):
        for kinds in ((), ("file",)):
            found = sorted(r.record_id for r in search_index.search_index(spark, path, text, kinds).collect())
            assert found == sorted({r.record_id for r in graph.search(own, pairs, text, kinds).collect()}), text
    plan = search_index.candidates(spark, path, "alphabeta")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(g, " in plan
    search_index.write_index(own.limit(0), pairs, f"{tmp_path}/empty")
    assert search_index.search_index(spark, f"{tmp_path}/empty", "alpha").count() == 0


def test_new_records_rewrite_nothing_and_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/s"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        old = graph_of(spark, [f"id{i}" for i in range(4000)], "old")
        snapshot.write_snapshot(*(t.repartition(4) for t in old), path, buckets=2, bits_of_id=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = files(path)
    assert all(len(before[f"bucket={b}"]) > 1 for b in range(2))
    # a filter this small takes new ids for known ones
    fresh = graph_of(spark, [f"fresh{i}" for i in range(100)], "fresh")
    assert snapshot.upsert_graph(spark, path, *fresh) == []
    after = files(path)
    assert all(before[f"bucket={b}"] < after[f"bucket={b}"] for b in range(2))
    same(snapshot.read_snapshot(spark, path), records.merge_graphs([old, fresh]))
