"""The two-version dataset, end to end and in its parts."""

import json

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import graph, quality, records, references, repository
from loomgraph.plans.repository import build_repository_graph
from loomgraph.sources import readers, writers

SHARED = "md5:1234567890abcdef1234567890abcdef"
ONE, TWO = "md5:28573899cc09a145ac2c69fc1370c0bf", "md5:abcdef12345678901234567890abcdef"


def version(recid, label, date, files, creators, **more):
    return {
        "id": recid, "conceptdoi": "10.5281/zenodo.999999", "conceptrecid": "999999",
        "metadata": {
            "doi": f"10.5281/zenodo.{recid}", "title": f"Creep Reference Data v{label[0]}", "description": "Text with <b>tags</b>", "version": label, "publication_date": date,
            "license": {"id": "cc-by-4.0", "url": "https://creativecommons.org/licenses/by/4.0/"}, "keywords": ["creep", "superalloy"], "creators": creators,
            "related_identifiers": [{"identifier": "10.1016/j.actamat.2025.120735", "relation": "cites", "scheme": "doi", "resource_type": "publication-article"}],
        },
        "files": [{"key": k, "size": s, "checksum": c, "mimetype": m, "links": {"self": f"https://x/{k}"}} for k, s, c, m in files],
    } | more


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("landed") / "a.json"
    doe = {"name": "Doe, John", "affiliation": "Institute", "orcid": "0000-0000-0000-0001"}
    smith = {"name": "Smith, Jane", "affiliation": "Other", "orcid": "0000-0000-0000-0002"}
    rows = [
        version(111111, "1.0", "2024-01-15", [("data_v1.csv", 1024, ONE[4:], "text/csv"), ("readme.txt", 512, SHARED, "text/plain")], [doe, smith]),
        version(222222, "2.0", "2024-06-01", [("data_v2.csv", 2048, TWO, "text/csv"), ("readme.txt", 512, SHARED, "text/plain")], [doe]),
    ]
    path.write_text("\n".join(map(json.dumps, rows)))
    landed = readers.read_records(spark, str(path))
    dois = spark.createDataFrame([("10.5281/zenodo.111111",), ("10.5281/zenodo.111111",), ("10.9/none",)], "doi string")
    out = build_repository_graph(landed, dois, "2025-01-01")
    pairs = {}
    for r in out["attributes"].collect():
        pairs.setdefault(r.record_id, set()).add((r.key, r.value))
    return out, pairs


def test_six_records(built):
    out, pairs = built
    assert {r.record_id for r in out["records"].collect()} == {"10.5281/zenodo.111111", "10.5281/zenodo.222222", ONE, TWO, SHARED, "10.1016/j.actamat.2025.120735"}
    assert set(pairs) == {r.record_id for r in out["records"].collect()}


def test_version_links(built):
    _, pairs = built
    first, second = pairs["10.5281/zenodo.111111"], pairs["10.5281/zenodo.222222"]
    assert ("nextVersion", "10.5281/zenodo.222222") in first and ("latestVersion", "10.5281/zenodo.222222") in first
    assert ("previousVersion", "10.5281/zenodo.111111") in second and not any(k == "latestVersion" for k, _ in second)


def test_shared_file_is_one_record(built):
    _, pairs = built
    assert {v for k, v in pairs[SHARED] if k == "isPartOf"} == {"10.5281/zenodo.111111", "10.5281/zenodo.222222"}
    assert ("spdxLicense", "https://creativecommons.org/licenses/by/4.0/") in pairs[SHARED]


def test_creators_and_text(built):
    _, pairs = built
    assert {v for k, v in pairs["10.5281/zenodo.111111"] if k == "creator"} == {"https://orcid.org/0000-0000-0000-0001", "https://orcid.org/0000-0000-0000-0002"}
    assert ("description", "Text with tags") in pairs["10.5281/zenodo.111111"]


def test_citation_and_backlink(built):
    _, pairs = built
    assert ("cites", "10.1016/j.actamat.2025.120735") in pairs["10.5281/zenodo.222222"]
    assert ("isCitedBy", "10.5281/zenodo.222222") in pairs["10.1016/j.actamat.2025.120735"]
    assert ("dataCitePublicationType", "JournalArticle") in pairs["10.1016/j.actamat.2025.120735"]


def test_outcomes(built):
    out, _ = built
    assert {(r.doi, r.status) for r in out["outcomes"].collect()} == {("10.5281/zenodo.111111", "ok"), ("10.9/none", "failed")}


def test_every_backlink_has_its_forward_link(built):
    _, pairs = built
    for record, own in pairs.items():
        for key, value in own:
            if key == "isCitedBy":
                assert ("cites", record) in pairs[value]


def test_chain_with_a_return(spark):
    rows = [("c", "f", x, i, 0) for i, x in enumerate(["A", "B", "A", "A"])]
    files = spark.createDataFrame(rows, "concept string, filename string, checksum string, ordinal int, pos int")
    found = {r.checksum: (r.prev_checksum, r.next_checksum) for r in repository.file_chains(files).collect()}
    assert found == {"A": ("B", "B"), "B": ("A", "A")}


def test_natural_order(spark):
    versions = spark.createDataFrame([("c", "2.0", 0), ("c", "10.0", 1), ("c", None, 2)], "concept string, version_label string, input_pos int")
    of = lambda order: [r.version_label for r in repository.order_versions(versions, order=order).orderBy("ordinal").collect()]
    assert of("text") == [None, "10.0", "2.0"] and of("natural") == [None, "2.0", "10.0"]


def test_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"hits": {"hits": [version(1, "1", "x", [], []), version(2, "2", "2024-01-01", [], [])]}}))
    own = readers.read_records(spark, str(tmp_path / "a.json"))
    assert sorted(r.id for r in own.collect()) == [1, 2]
    dates = {r.recid: str(r.publication_date) for r in repository.build_versions(own, "2025-05-05").collect()}
    assert dates == {1: "2025-05-05", 2: "2024-01-01"}


def test_graph_round_trip(spark, tmp_path):
    own = spark.createDataFrame([("a", "", "x"), ("b\"c", "p", "x")], "record_id string, pid string, kind string")
    rows = [("a", "k", "980.0", "double"), ("a", "k", "7", "long"), ("a", "k", "true", "boolean"), ("a", "k", 'say "hé"', "string"), ("a", "k", "980.0", "double")]
    attributes = spark.createDataFrame(rows, "record_id string, key string, value string, value_type string")
    writers.write_graph(own, attributes, str(tmp_path / "g"))
    back, pairs = readers.read_graph(spark, str(tmp_path / "g"))
    assert {(r.record_id, r.pid) for r in back.collect()} == {("a", "a"), ('b"c', "p")}
    assert sorted(tuple(r) for r in pairs.collect()) == sorted(set(rows))


def test_quarantine_and_stop(spark):
    df = spark.createDataFrame([("10.1234/x", 1), ("nope", 0), (None, None)], "doi string, size int")
    good, bad = quality.validate(df, quality.rules_for({"doi": F.col("doi"), "size": F.col("size")}))
    assert good.count() == 2 and bad.first()["violations"] == ["doi", "size"]
    with pytest.raises(Exception, match="stops"):
        quality.fail_if(df, F.col("size") == 0, "").collect()
    with pytest.raises(Exception, match="broken rules"):
        quality.validate(df, quality.rules_for({"doi": F.col("doi")}), fail_fast=True)[0].collect()


def test_circles_end(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    assert {(r.node, r.depth) for r in references.traverse(seeds, edges, max_depth=3).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    assert references.traverse(seeds.limit(0), edges).count() == 0


def test_fixpoint(spark):
    own = spark.createDataFrame([("a", "", ""), ("b", "", "")], "record_id string, pid string, kind string")
    attributes = spark.createDataFrame([("a", "f", "b", "string")], "record_id string, key string, value string, value_type string")
    rules = (("f", "g"), ("g", "h"))
    once = graph.with_backlinks(attributes, own, rules)
    more = graph.with_backlinks(attributes, own, rules, fixpoint=True)
    assert once.count() == 2 and more.count() == 3


def test_later_graph_replaces_records(spark):
    r = lambda x: spark.createDataFrame([(x, "", "k")], "record_id string, pid string, kind string")
    a = lambda x, v: spark.createDataFrame([(x, "name", v, "string")], "record_id string, key string, value string, value_type string")
    _, merged = records.merge_graphs([(r("x"), a("x", "old")), (r("x"), a("x", "new"))])
    assert [tuple(x) for x in merged.collect()] == [("x", "name", "new", "string")]


def test_only_new_attributes_meet_the_rules(spark, monkeypatch):
    """A chain of rules: what a round infers from is what the round before found."""
    rules = tuple((f"k{i}", f"k{i + 1}") for i in range(4))
    own = spark.createDataFrame([("a",), ("b",), ("c",)], "record_id string")
    attributes = spark.createDataFrame([("a", "k0", "b", "string"), ("c", "k2", "a", "string"), ("a", "other", "b", "string")], "record_id string, key string, value string, value_type string")
    sizes, infer = [], graph.infer_backlinks
    monkeypatch.setattr(graph, "infer_backlinks", lambda new, *more: sizes.append(new.count()) or infer(new, *more))
    found = {(r.record_id, r.key, r.value) for r in graph.with_backlinks(attributes, own, rules, fixpoint=True).collect()}
    assert found == {("a", "k0", "b"), ("b", "k1", "a"), ("a", "k2", "b"), ("b", "k3", "a"), ("a", "k4", "b"), ("c", "k2", "a"), ("a", "k3", "c"), ("c", "k4", "a"), ("a", "other", "b")}
    assert sizes == [3, 2, 2, 1, 1]
