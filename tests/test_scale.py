"""What keeps a task's share from growing with the input: plans and parts."""

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import vocabulary
from loomgraph.operators import graph, matching, postings, quality, repository
from loomgraph.sources import search_index

ATTRIBUTES = "record_id string, key string, value string, value_type string"


def plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("operator", ["names", "values", "backlinks"])
def test_rules_are_broadcast(spark, capsys, operator):
    rows = [(f"a{i}", "cites" if i % 2 else "name", f"a{i // 2}", "string") for i in range(20)]
    own = spark.createDataFrame(rows, ATTRIBUTES)
    if operator == "names":
        found = matching.resolve_names(own, vocabulary.info_types(spark))
    elif operator == "values":
        found = quality.check_values(own, spark.createDataFrame([("cites", None, 0.0, 1.0, None)], "key string, pattern string, minimum double, maximum double, enum array<string>"))
    else:
        found = graph.infer_backlinks(own, own.select("record_id"))
    assert "BroadcastHashJoin [key" in plan(found, capsys)
    assert found.count() == {"names": 20, "values": 10, "backlinks": 10}[operator]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_fan_out_of_one_concept_is_dealt_in_parts(spark, monkeypatch, threshold):
    monkeypatch.setattr(repository, "FAN_OUT", 50, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        resolved = spark.range(200).select(F.concat(F.lit("d"), "id").alias("doi"), F.col("id").alias("recid"), F.when(F.col("id") < 198, F.lit("hot")).when(F.col("id") == 198, F.lit("bare")).alias("concept"))
        versions = spark.range(10).select(F.lit("hot").alias("concept"), (F.col("id") + 1000).alias("version_recid"))
        out = repository.fan_out_versions(resolved.repartition("concept"), versions).cache()
        tasks = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        rows = {(r["doi"], r["version_recid"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.count() == len(rows) == 198 * 10 + 2
    assert {("d198", 198), ("d199", 199)} <= rows
    assert len(tasks) > 3 and max(tasks) < 1000


def test_landed_texts_are_written_compressed(spark):
    import os

    from loomgraph.functions.shared import shared_dir
    from loomgraph.plans.queries import a1_landed_records

    a1_landed_records(spark, "/root/testdata/sf0.001")
    names = [n for folder, _, files in os.walk(shared_dir(spark)) if os.path.basename(folder).startswith("landed-") for n in files if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)


def test_files_are_dealt_before_they_are_aggregated(spark, capsys):
    files = spark.createDataFrame([("v", 1, "c", "n")], "version_doi string, pos int, checksum string, filename string")
    shown = plan(repository.dedup_in_version(files), capsys)
    assert shown.index("partial_max_by") < shown.index("Exchange")


def test_a_fixpoint_of_rules_takes_no_rounds(spark):
    import os
    import random

    from loomgraph.functions.shared import shared_dir

    rng = random.Random(5)
    rules = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("x", "a"), ("a", "z")]
    ends = [f"r{i}" for i in range(8)] + ["gone", "away"]
    given = {(rng.choice(ends), rng.choice("abcdxyz"), rng.choice([*ends, None]), rng.choice(["string", "url"])) for _ in range(40)}
    wanted, new = set(given), set(given)
    while new:
        new = {(v, b, r, "string") for r, k, v, _ in new for f, b in rules if f == k and v in ends[:8]} - wanted
        wanted |= new
    before = set(os.listdir(shared_dir(spark)))
    own = spark.createDataFrame([(i,) for i in ends[:8] + ends[:2]], "record_id string")
    found = graph.with_backlinks(spark.createDataFrame(sorted(given, key=repr), ATTRIBUTES), own, rules, fixpoint=True)
    rows = [tuple(r) for r in found.select("record_id", "key", "value", "value_type").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == wanted
    assert set(os.listdir(shared_dir(spark))) == before


def test_owners_of_a_common_text_are_dealt_in_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(search_index, "OWNERS", 100, raising=False)
    own = spark.range(1000).select(F.concat(F.lit("r"), "id").alias("record_id"))
    said = own.select("record_id", F.lit("key").alias("key"), F.lit("Common").alias("value"), F.lit("string").alias("value_type"))
    search_index.write_index(own, said.union(said), str(tmp_path))
    texts, owners = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("texts", "owners"))
    sizes = [r["count"] for r in owners.join(texts.where("text = 'common'"), "id").groupBy("id", "part").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 200
    assert {r.record_id for r in search_index.search_index(spark, str(tmp_path), "MMO").collect()} == {f"r{i}" for i in range(1000)}
    assert search_index.search_index(spark, str(tmp_path), "r99").count() == 11


def test_long_texts_look_at_their_likely_holders_alone(spark, monkeypatch):
    import random

    rng = random.Random(7)
    text = lambda n: "".join(rng.choices("abä🙂 \n", k=n))
    long = [text(n) for n in (63, 64, 80, 95, 200)]
    held = [(s, i, t) for i, (s, t) in enumerate((s, t) for s in "xy" for t in [*long, "ab ä🙂aab", "q" * 70])]
    # each long text at every distance from a block's start, and many texts that hold none
    texts = [("x", text(k) + long[k % 5] + text(9)) for k in range(64)] + [("x", text(900)) for _ in range(150)] + [("x", long[0]), ("y", long[1][:-1] + "!"), ("y", long[2])]
    holders = [(s, i, t) for i, (s, t) in enumerate(texts)]
    own, other = (spark.createDataFrame(rows, "scope string, id long, text string") for rows in (held, holders))
    seen, plain = [], postings._contained
    monkeypatch.setattr(postings, "_contained", lambda h, o, n: seen.append((h.count(), o.count())) or plain(h, o, n))
    found = {tuple(r) for r in postings.contained(own, other, 8).select("held", "holder").collect()}
    assert found == {(i, j) for s, i, t in held for z, j, u in holders if s == z and t in u}
    assert sorted(seen) == [(2, len(holders)), (12, 67)]  # the one in vain differs in its last character


def landed_rows(n):
    """Landed records as JSON: few concepts, DOIs that repeat or lack, and files in several versions and concepts."""
    import random

    rng = random.Random(3)
    for i in range(n):
        files = [{"key": f"f{rng.randrange(4)}", "size": rng.randrange(1, 9), "checksum": rng.choice(["", "md5:"]) + f"{rng.randrange(12):032x}", "mimetype": rng.choice(["text/csv", "image/png"]), "links": {"self": f"u{i}/{k}"}} for k in range(0 if i % 13 == 6 else rng.randrange(6))]  # what repeats a DOI has no files of its own, so no two are at one place
        doi = None if i % 11 == 5 else f"10.5281/zenodo.{i - i % 4 if i % 13 == 6 else i}"
        licence = {"url": f"l{i}"} if i % 3 == 0 else None
        yield {"id": i, "conceptdoi": f"c{i % 5}", "metadata": {"doi": doi, "title": f"t{i}", "version": str(i % 7), "license": licence, "keywords": ["a", "a"], "creators": [{"name": "x", "orcid": f"{i % 3:016d}"}]}, "files": files}


def test_whole_versions_give_what_the_single_steps_give(spark, capsys, tmp_path):
    import json

    from loomgraph.functions.shared import materialize_by
    from loomgraph.operators import records
    from loomgraph.sources import readers

    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, landed_rows(80))))
    landed = repository.concept_defaults(readers.read_records(spark, str(tmp_path / "a.json"))).cache()
    versions = repository.version_links(repository.order_versions(repository.build_versions(landed, "2024-01-01").withColumnRenamed("concept_doi", "concept").withColumn("input_pos", F.col("recid"))))
    good = repository.dedup_in_version(repository.build_files(landed).where("version_doi is not null")).join(versions.select("concept", "version_doi", "ordinal"), "version_doi")
    registry = repository.file_registry(good.drop("pos"))
    wanted = repository.latest_file_inputs(repository.file_inputs(registry, repository.file_chains(good), repository.inherited_license(registry, versions.withColumn("license_url", F.col("license.url")))))
    own, repeats = repository.share_by_doi(materialize_by(repository.whole_versions(landed, "2024-01-01"), "versions", "concept"))
    own = repository.dedup_in_row(own)
    found = repository.whole_file_inputs(own)
    assert repeats and plan(found, capsys).count("Exchange hashpartitioning") == 1  # by checksum; what is of a concept is read where it lies
    rows = lambda t: {tuple(map(str, r)) for r in t.select(*sorted(t.columns)).collect()}
    assert found.count() == 12 and rows(found) == rows(wanted)

    people = repository.build_creators(landed).withColumn("ror_id", F.lit(None).cast("string"))
    plain = records.dataset_records(repository.dataset_inputs(versions, people, good, repository.preview_images(good)))[1]
    whole = records.dataset_records(repository.whole_dataset_inputs(own), alone=~F.col("repeated"))[1]
    pairs = lambda t: [tuple(r) for r in t.collect()]
    assert len(pairs(whole)) == len(set(pairs(whole))) and set(pairs(whole)) == set(pairs(plain))


def test_graphs_that_are_sets_overlay_as_they_merge(spark):
    from loomgraph.operators import records

    r = lambda *ids: spark.createDataFrame([(i, "", f"k{len(ids)}") for i in ids], "record_id string, pid string, kind string")
    a = lambda *ids: spark.createDataFrame([(i, "name", f"{i}{len(ids)}", "string") for i in ids], ATTRIBUTES)
    graphs = [(r("a", "b", "c"), a("a", "b", "c")), (r("b", "d"), a("b", "d")), (r("c"), a("c"))]
    one, other = records.overlay_graphs(graphs), records.merge_graphs(graphs)
    for x, y in zip(one, other):
        assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))


def test_keys_without_a_rule_are_left_before_receivers_are_joined(spark, capsys):
    own = spark.createDataFrame([("a", "name", "b", "string"), ("a", "cites", "b", "string")], ATTRIBUTES)
    found = graph.infer_backlinks(own, spark.createDataFrame([("b",)], "record_id string"))
    assert "key#" in plan(found, capsys) and "cites" in plan(found, capsys)
    assert [tuple(x) for x in found.collect()] == [("b", "isCitedBy", "a", "string")]


def test_fan_out_is_small_where_it_is_written(spark, tmp_path):
    """5003 versions of one concept, 400 DOIs: a run over all versions is longer than a codec looks back."""
    resolved = spark.range(400).select(F.concat(F.lit("d"), "id").alias("doi"), F.col("id").alias("recid"), F.lit("hot").alias("concept"))
    versions = spark.range(5003).select(F.lit("hot").alias("concept"), (F.col("id") * 25 + F.col("id") % 11).alias("version_recid"))
    repository.fan_out_versions(resolved, versions).write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).distinct().count() == 400 * 5003
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("part-*")) < 1_000_000


@pytest.mark.parametrize("fan_out", [7, 1_000_000])
def test_fan_out_keeps_rows_that_repeat_or_lack_a_version(spark, monkeypatch, fan_out):
    from collections import Counter

    monkeypatch.setattr(repository, "FAN_OUT", fan_out)
    monkeypatch.setattr(repository, "RUN", 2, raising=False)
    asked = [("a", 1, "x"), ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y"), ("d", 4, None), ("e", 5, "alone"), (None, 6, "y")]
    held = [("x", 10), ("x", 10), ("x", None), ("x", None), ("x", 11), ("y", 12), ("y", 13), ("other", 14), (None, 15)]
    found = repository.fan_out_versions(spark.createDataFrame(asked, "doi string, recid long, concept string"), spark.createDataFrame(held, "concept string, version_recid long"))
    wanted = Counter((doi, c, r if v is None else v) for doi, r, c in asked for v in ([v for k, v in held if c is not None and k == c] or [None]))
    assert Counter(map(tuple, found.collect())) == wanted
