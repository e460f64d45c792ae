"""The classifiers and the pipeline against plain loops."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from loomgraph.llm import bpe, jaccard, mixing, pii, quality_model, toxicity
from loomgraph.llm.common import ALNUM, WordHasher
from test_sets import SCHEMA, brute

LOWER = {i: i + 32 for i in range(65, 91)}


# ---- toxicity: embeddings, filters and pooling


def random_model(rng, rows=1 << 10, size=4, filters=3, widths=(1, 2, 3)):
    draw = lambda *shape: rng.normal(size=shape).astype(np.float32)
    return toxicity.Model(draw(rows, size), [draw(w, size, filters) for w in widths], [draw(filters) for _ in widths], draw(len(widths) * filters), 0.3, widths, ((5, True), (7, False)), 0.7, -0.1)


def plain_score(model, text):
    """One word, one place, one filter after another."""
    hasher, rows = WordHasher(ALNUM), len(model.table)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    vectors = []
    for w in words:  # hashed alone: a word's rows don't depend on what stands around it
        table_rows, _ = toxicity._hashed([w.encode()], hasher, rows, model.prefixes)
        vectors.append(sum(model.table[r].astype(float) for r in table_rows[:, 0]))
    pooled = []
    for f, b in zip(model.filters, model.biases, strict=True):
        for j in range(f.shape[2]):
            best = 0.0
            for i in range(len(vectors)):
                total = float(b[j])
                for k in range(len(f)):
                    if i + k < len(vectors):
                        total += float(vectors[i + k] @ f[k, :, j])
                best = max(best, total)
            pooled.append(best)
    z = (float(np.dot(pooled, model.out)) + model.bias) * model.scale + model.shift
    return 1 / (1 + math.exp(-z))


def test_convolution_and_pooling_equal_plain_loops():
    rng, pick = np.random.default_rng(2), random.Random(3)
    model, hasher = random_model(rng), WordHasher(ALNUM)
    texts = ["", "one", "Two words", "a b c d e f g", "ünï cödé 日本 wörter", "punctuated, and-joined; words."] + [" ".join(pick.choice(["alpha", "beta", "Gamma", "delta9", "epsilonian"]) for _ in range(pick.randrange(40))) for _ in range(30)]
    words, at = toxicity._hashed([t.encode() for t in texts], hasher, len(model.table), model.prefixes)
    assert np.allclose(model.score(words, at), [plain_score(model, t) for t in texts], atol=1e-4)


def test_toxicity_scores_depend_on_the_text_alone(spark):
    """The same texts in other places, slices, partitions and batches have the same scores to the last bit."""
    rng, pick = np.random.default_rng(4), random.Random(6)
    model = random_model(rng, size=8, filters=8)
    texts = ["", "one", "two words"] + [" ".join(pick.choice(["alpha", "beta", "Gamma", "delta9", "x"]) for _ in range(pick.randrange(60))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    alone = {}
    for i, t in enumerate(texts):
        words, at = toxicity._hashed([t.encode()], WordHasher(ALNUM), len(model.table), model.prefixes)
        alone[i] = float(model.score(words, at)[0])
    for parts, batch in ((1, 10_000), (7, 13), (3, 1)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        assert {r.doc_id: r.score for r in toxicity.score(docs.repartition(parts), model).collect()} == alone
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_toxicity_edges(spark):
    """Rows that repeat a doc_id score by their own text; a doc_id with both labels learns as toxic; null lang and doc_id."""
    rows = [(i, f"w{i} vile scum" if i % 4 == 0 else f"w{i} fine day", None if i % 5 == 0 else "en") for i in range(300)]
    rows += [(0, rows[0][1], "en"), (0, "another text", "en"), (None, "vile scum", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("flagged", F.lit("clash")).withColumn("toxic", F.lit(7))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(4, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, settings=toxicity.Settings(rows=1 << 12, epochs=6))
    found = [(r.doc_id, r.score) for r in toxicity.score(docs, model).collect()]
    assert len(found) == len(rows)
    same = collections.defaultdict(set)
    for i, s in found:
        same[i].add(s)
    assert len(same[0]) == 2 and all(len(same[i]) == 1 for i in range(1, 300)) and len(same[None]) == 2


# ---- quality: votes, features and scores


def plain_votes(text):
    words = [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    raw = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, data = len(words), [w.encode() for w in raw]
    kind = lambda c: int(quality_model.KINDS[c])
    per, total = max(n, 1), lambda f: sum(f(w) for w in data)
    small, large = total(lambda w: sum(kind(c) == 1 for c in w)), total(lambda w: sum(kind(c) == 2 for c in w))
    mean, caps = total(len) / per, large / max(small + large, 1)
    marked = total(lambda w: kind(w[-1]) == 5 and len(w) > 1) / per
    signs = total(lambda w: (len(w) == 1 and kind(w[0]) == 5) or (kind(w[-1]) == 4 and kind(w[max(len(w) - 2, 0)]) == 4 and len(w) > 2)) / per
    same = sum(a == b for a, b in zip(words, words[1:], strict=False)) / per
    stops, short, variety = total(lambda w: w[-1:] in (b".", b"?", b"!")), total(lambda w: len(w) <= 3 and kind(w[-1]) == 1) / per, len(set(words)) / per
    pick = lambda good, bad: -1 if bad else int(good)
    long = n >= 20
    return [
        pick(n >= 20, n == 0), pick(3 < mean < 10, mean < 2 or mean > 16), pick(caps < 0.15, caps > 0.5), pick(marked < 0.05, marked > 0.2), pick(signs < 0.05, signs > 0.15),
        pick(long and variety > 0.35, long and variety < 0.15), pick(same < 0.02, same > 0.2), pick(long and stops * 60 > n, long and stops * 200 < n), pick(long and 0.08 < short < 0.7, long and short < 0.02),
    ]


def odd_texts(n=200, seed=5):
    rng = random.Random(seed)
    pool = ["word", "Word", "LOUD", "a", "of", "it.", "end!", "what?", "--", "#", "tag#", "...", "12", "x2", "ünï", "日本", "longerwordsthanusual", "(note)"]
    return ["", " \n", "one", *[rng.choice([" ", "\n", "\t "]).join(rng.choices(pool, k=rng.randrange(60))) for _ in range(n)]]


def test_votes_equal_plain_loops():
    texts = odd_texts()
    votes = quality_model.Reader().votes([t.encode() for t in texts])
    for t, own in zip(texts, votes.tolist(), strict=True):
        assert own == plain_votes(t), t


def test_expectation_maximisation_equals_plain_loops():
    rng = random.Random(1)
    votes = [[rng.choice([-1, 0, 1, 1]) for _ in range(9)] for _ in range(60)]
    counts = [rng.randrange(1, 50) for _ in votes]
    posterior = [1 / (1 + math.exp(-(sum(v) - 4 * sum(x < 0 for x in v)))) for v in votes]
    for _ in range(20):
        share = sum(p * n for p, n in zip(posterior, counts, strict=True)) / sum(counts)
        share = min(max(share, 1e-3), 1 - 1e-3)
        table = {}
        for c in (0, 1):
            for j in range(9):
                mass = {x: 1.0 + sum((p if c else 1 - p) * n for p, n, v in zip(posterior, counts, votes, strict=True) if v[j] == x) for x in (-1, 0, 1)}
                for x in mass:
                    table[c, j, x] = mass[x] / sum(mass.values())
        odds = [math.prod(table[1, j, v[j]] / table[0, j, v[j]] for j in range(9)) * share / (1 - share) for v in votes]
        posterior = [o / (1 + o) for o in odds]
    own_share, own = quality_model.expectation_maximisation(np.array(votes), np.array(counts, float), 20)
    assert own_share == pytest.approx(share) and all(own[c, j, x + 1] == pytest.approx(table[c, j, x]) for c, j, x in table)


def test_scorer_equals_plain_sums():
    rng, reader, texts = np.random.default_rng(4), quality_model.Reader(), odd_texts(60, 9)
    model = quality_model.Model(rng.normal(size=1 << 12).astype(np.float32), 0.2, 0.5, {})
    scores = model.score(*reader.features([t.encode() for t in texts], 1 << 12))
    for t, s in zip(texts, scores, strict=True):
        buckets, _ = reader.features([t.encode()], 1 << 12)
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t))
        assert len(buckets) == 2 * n
        z = sum(float(model.weights[b]) for b in buckets) / max(n, quality_model.FEW) + 0.2
        assert s == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5) if n else s == 0


# ---- the pipeline, stage by stage


def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    near = rows[0][1].split(" ")
    rows += [(90001, rows[0][1], "en", "src1", 1), (90002, " ".join([*near[:-1], "changed"]), "en", None, 1), (90003, None, "en", "src1", 0), (90004, "", None, "src1", 0), (90005, rows[3][1] + " mail a.b@example.org from 10.20.30.40 .", "en", "src2", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_pipeline_equals_brute_force(spark):
    docs = corpus(spark)
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    columns = docs.columns

    def step(k, now):
        out = stages[k](spark, now, "")
        return spark.createDataFrame(out.collect(), out.schema)

    key = lambda df: collections.Counter((r.doc_id, r.text) for r in df.collect())
    good = step(0, docs)
    model = quality_model.fit(docs)
    judged = quality_model.score(docs, model, keep=("doc_id", "text")).collect()
    assert good.columns == columns and key(good) == collections.Counter((r.doc_id, r.text) for r in judged if r.score >= quality_model.Settings().threshold)
    assert not any(i in (90003, 90004) for i, _ in key(good))

    single = step(1, good)
    groups = brute([(r.doc_id, r.text) for r in good.collect()], 5, 80)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(i for i, _, least in groups if i == least)
    assert not any(i in (90001, 90002) for i, _ in key(single))

    clean = step(2, single)
    texts = {r.doc_id: r.text for r in pii.private_values(single, key=pii.key_of(spark)).collect()}
    assert clean.columns == columns and {r.doc_id: r.text for r in clean.collect()} == texts and clean.count() == single.count()
    before = {r.doc_id: (r.text, r.n_chars) for r in single.collect()}
    assert all(r.n_chars == (before[r.doc_id][1] if r.text == before[r.doc_id][0] else len(r.text)) for r in clean.collect())

    mixed = step(3, clean)
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    assert mixed.columns == columns and collections.Counter(r.doc_id for r in mixed.collect()) == +collections.Counter(copies)

    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = collections.Counter()
    for r in mixed.collect():
        ids = public.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
    last = stages[4](spark, mixed, "")
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in last.collect()) == want


def test_pipeline_edges(spark):
    """No rows; and rows whose doc_id is null, repeated or repeated with another text, and extra columns."""
    docs = corpus(spark)
    now = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = spark.createDataFrame(stage(spark, now, "").collect(), stage(spark, docs.limit(0), "").schema)
    assert now.count() == 0
    first, second = (r.text for r in docs.where("length(text) > 400").orderBy("doc_id").limit(2).collect())
    rows = [(1, first), (1, first), (1, second), (None, first), (2, first), (None, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"), F.lit("x").alias("id_"), F.lit("y").alias("found_"))
    now = odd
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, now, "")
        assert out.columns == odd.columns
        now = spark.createDataFrame(out.collect(), odd.schema)
    left = collections.Counter(r.doc_id for r in jaccard.keep_one(odd).collect())
    assert left == {1: 2, None: 2}  # of (1, first) one row, (1, second), and the rows without a doc_id
