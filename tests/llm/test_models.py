"""Classifiers by held-out accuracy, neighbours by recall, and pseudonyms by their properties."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import ann, pii, quality_model, toxicity

SMALL = "/root/testdata/sf0.001"


def test_toxicity(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        words = [f"w{rng.randrange(2000)}" for _ in range(rng.choice([5, 40, 200]))]
        bad = rng.random() < 0.3
        for _ in range(4 if bad else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["vile", "scum", "idiot"]))
        rows.append((i, " ".join(words), "en", int(bad)))
    docs = spark.createDataFrame([(*r[:3], "clash") for r in rows] + [(1000, None, None, ""), (1001, "", "en", ""), (1002, "scum " * 50000, "en", "")], "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, learn=F.col("doc_id") % 3 != 1, settings=toxicity.Settings(rows=1 << 14))
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == 903 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())
    held = [r for r in rows if r[0] % 3 == 1]
    assert np.mean([found[r[0]].predicted == r[3] for r in held]) > 0.95
    assert found[1000].predicted == found[1001].predicted == 0 and found[1002].predicted == 1
    assert found[1000].score == found[1001].score
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_quality_model(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.fit(docs)
    judged = quality_model.score(docs, model).join(labels, "doc_id").select("quality", (F.col("score") >= 0.3).cast("int").alias("kept")).toPandas()
    good = judged[judged.quality == 1]
    assert (judged.quality == judged.kept).mean() > 0.95 and good.kept.mean() > 0.97
    more = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "Word. " * 40000, 1.0)], "doc_id long, text string, score double")
    kept = quality_model.good_documents(docs.select("doc_id", "text", F.lit(1.0).alias("score")).unionByName(more))
    assert kept.columns == ["doc_id", "text", "score"] and kept.where("text is null or text = ''").count() == 0
    assert quality_model.score(docs.limit(0), quality_model.fit(docs.limit(0))).count() == 0


def test_expectation_maximisation():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.8
    accuracy = np.array([0.9, 0.8, 0.95, 0.7, 0.85, 0.9, 0.9, 0.75, 0.8])
    votes = np.where(rng.random((20000, 9)) < accuracy, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    own, counts = np.unique(quality_model.patterns(votes), return_counts=True)
    assert np.array_equal(quality_model.patterns(quality_model.expand(own)), own)
    share, table = quality_model.expectation_maximisation(quality_model.expand(own), counts.astype(float), 100)
    assert share == pytest.approx(0.8, abs=0.02) and np.allclose(table[1, :, 2], accuracy, atol=0.03)


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]  # one very common vector
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(5000, None, 1), (5020, [0.0] * 16, 1), (5040, [float("nan")] * 16, 1), (5060, [None] * 16, 1), (0, x[0].tolist(), 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    found = ann.nearest(vectors, is_query=F.col("vec_id") % 20 == 0, settings=ann.Settings(books=8, words=64, sample=2000, block=700, queries=50)).toPandas()
    hits = 0
    for q in range(0, 3000, 20):
        score = x.astype(np.float64) @ x[q].astype(np.float64)
        ids = np.delete(np.arange(3000), q)
        wanted = ids[np.lexsort((ids, -score[ids]))[:20]]
        own = found[found.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own.score, score[own.vec_id], atol=1e-12)
        assert own.vec_id.tolist() == own.sort_values(["score", "vec_id"], ascending=[False, True]).vec_id.tolist()
        hits += len(set(wanted) & set(own.vec_id))
    assert set(found.query_id) == set(range(0, 3000, 20)) and hits / (150 * 20) >= 0.9
    assert ann.nearest(vectors.where("vec_id in (0, 1)"), is_query=F.col("vec_id") == 0).collect()[0]["vec_id"] == 1
    assert ann.nearest(vectors.limit(0), is_query=F.col("vec_id") == 0).count() == 0


def test_neighbours_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    lengths = {16: 900, 24: 1, 8: 700, 3: 40}
    rows, vectors = [], {}
    for size, n in lengths.items():
        for v in rng.normal(size=(n, size)) * (1e30 if size == 3 else 1):
            vectors[len(rows)] = v
            rows.append((len(rows), v.tolist(), "x"))
    rows.append((7, rng.normal(size=16).tolist(), "x"))  # an id with two vectors
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep string")
    settings = ann.Settings(books=8, words=64, sample=2000, block=300, queries=20, rerank=64)
    found = ann.nearest(table, is_query=F.col("vec_id") % 20 == 0, settings=settings).toPandas()
    hits = wanted = 0
    for q in range(0, len(vectors), 20):
        near = {i: float(v @ vectors[q]) for i, v in vectors.items() if len(v) == len(vectors[q]) and i not in (q, 7)}
        best = sorted(near, key=lambda i: (-near[i], i))[:20]
        own = found[(found.query_id == q) & (found.vec_id != 7)]
        assert set(own.vec_id) <= set(near) and np.allclose(own.score, [near[i] for i in own.vec_id], rtol=1e-12)
        assert len(found[found.query_id == q]) == min(20, len(near) + (len(vectors[q]) == 16))
        hits, wanted = hits + len(set(best) & set(own.vec_id)), wanted + len(best)
        if len(near) < 64:  # an exact space
            assert own.sort_values("rank").vec_id.tolist() == best
    assert hits / wanted >= 0.9


def test_pseudonyms(spark):
    texts = {
        1: "card 4111111111111111, 4111 1111 1111 1111 and not 4111111111111112", 2: "call +1 (942) 555-3625 or 212-555-1234", 3: "at 169.122.221.182 not 300.1.1.1", 4: "ssn 123-45-6789 not 000-12-1234",
        5: "iban DE89370400440532013000 and GB82 WEST 1234 5698 7654 32", 6: "on 2023-02-28, 2024-02-29, 31/12/1999 not 2023-02-30", 7: 'token = "49ab8b03847754d938118ecf003181de2dc09b88"', 8: "mail A.b.72@mail3.example.com and a.b.72@mail3.example.com.",
        9: None, 10: "", 11: "clean text 12.5 and 2024", 12: "again 4111111111111111", 13: "x " * 50000 + "169.122.221.182",
    }
    docs = spark.createDataFrame([(*r, "k") for r in texts.items()], "doc_id long, text string, kind string")
    out = {r.doc_id: r for r in pii.private_values(docs, key="k").collect()}
    assert {i: out[i].n_private for i in texts} == {1: 2, 2: 2, 3: 1, 4: 1, 5: 2, 6: 3, 7: 1, 8: 2, 9: 0, 10: 0, 11: 0, 12: 1, 13: 1}
    first = out[1].text.split()[1].rstrip(",")
    luhn = lambda s: sum((d * 2 - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(s)))) % 10
    assert luhn(first) == 0 and first != "4111111111111111" and out[12].text == f"again {first}" and "4111111111111112" in out[1].text
    assert out[1].text.split(", ")[1][:19].replace(" ", "") == first
    for value in out[5].text.replace("iban ", "").split(" and "):
        plain = value.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert out[9].text is None and out[10].text == "" and out[11].text == texts[11]
    assert "2023-02-30" in out[6].text and "-02-29" in out[6].text and "300.1.1.1" in out[3].text and "000-12-1234" in out[4].text
    assert len({w.strip(".") for w in out[8].text.split() if "@" in w}) == 1
    assert pii.private_values(docs, key="other").where("doc_id = 12").first()["text"] != out[12].text
    days = spark.range(3000).select(F.col("id").alias("doc_id"), F.date_add(F.lit("1996-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("text"))
    assert pii.private_values(days, key="k").select("text").distinct().count() == 3000
    assert pii.pseudonymize(docs, key="k").columns == [*docs.columns, "found_"] and pii.private_values(docs.limit(0), key="k").count() == 0


def test_private_values_in_common_surroundings(spark):
    low, long = "0123456789abcdef" * 2, "0123456789abcdef" * 8 + "0a"
    texts = {
        1: ("http://10.1.2.3/x", ["10.1.2.3"]), 2: ("10.0.0.0/24", ["10.0.0.0"]), 3: ("from /10.1.2.3:80 10.0.0.1-10.0.0.9", ["10.1.2.3", "10.0.0.1", "10.0.0.9"]),
        4: ("1980-01-02T00:00:00Z/1981-01-02T00:00:00Z", ["1980-01-02", "1981-01-02"]), 5: ("01/02/2020-03/04/2021", ["01/02/2020", "03/04/2021"]), 6: ("logs/1980-01-02/3 1980-01-02-1981-03-04", ["1980-01-02/", "1980-01-02-", "1981-03-04"]),
        7: (f"API_KEY={low} Token: '{low.upper()}'", [low, low.upper()]), 8: (f'{{"secret": "{long}"}}', [long]), 9: (f"Password = {long.upper()}", [long.upper()]),
        10: (f"http://300.1.2.3/x 1.2.3.4.5 Chrome/120.0.0.0 1980-02-30T00:00:00 1980-01-02-3 {low} AE12{low[4:].upper()}", []),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string")
    out = {r.doc_id: r for r in pii.private_values(docs, key="k").collect()}
    for i, (text, values) in texts.items():
        assert out[i].n_private == len(values) and len(out[i].text) > 0 and not any(v in out[i].text for v in values), text
    assert out[10].text == texts[10][0] and out[1].text.startswith("http://") and out[1].text.endswith("/x") and out[4].text.count("T00:00:00Z") == 2
    small, capital = out[7].text.split(" ")[0].removeprefix("API_KEY="), out[7].text.split("'")[1]
    assert small.upper() == capital and small == small.lower() and len(out[8].text) == len(texts[8][0])
