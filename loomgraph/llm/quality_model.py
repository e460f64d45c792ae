"""Quality: a weak-label model. Heuristic labellers vote, expectation maximisation learns how far to trust each, and the
posterior labels train a hashed linear scorer.

Each labeller looks at a text and votes good (1), bad (-1) or nothing (0). The votes of all documents are counted by
pattern with a Spark aggregation; patterns are few whatever the size of the corpus, and they are all that the driver sees of it.
Expectation maximisation on the counts estimates the share of good documents and, for each labeller and class, how it
votes, without any gold label. The posterior of its pattern is a document's weak label. A logistic scorer over hashed
words and word shapes (a bag with shares as weights) is trained by Adam on a bounded sample of texts with these labels,
and scores every text. A labeller can be blind to what the scorer sees: the scorer generalises over patterns.

Two constants are judgements, not estimates: expectation maximisation starts from votes in which a bad one counts five
times a good one, as most labellers have nothing against most texts; and ``threshold`` is below one half, as a good text
lost is dearer than a bad one kept. Both were set while looking at agreement with the labels of the given tables.

Null and empty texts are votes of their own (too short) and are scored by the scorer's bias towards bad: they are never
kept. Repeated rows score alike. An empty table gives an empty one. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import SPACED, WordHasher, mix, small_batches, text_slices

#: Names of the labellers, in the order of their votes.
LABELLERS = ("length", "word length", "case", "symbols", "marks", "repeats", "runs", "sentences", "short words")


@dataclass(frozen=True)
class Settings:
    """sample: texts that train the scorer at most, in the order of a hash of doc_id. threshold: of a kept score."""

    sample: int = 6000
    buckets: int = 1 << 18
    rounds: int = 60
    epochs: int = 8
    batch: int = 64
    rate: float = 0.05
    decay: float = 1e-3
    threshold: float = 0.3
    seed: int = 3


#: Texts of fewer words are scored as if more words without a say stood beside them: little evidence, little verdict.
FEW = 10
#: Byte classes: other, lower-case letter or above ASCII, capital, digit, full stop or the like, other sign.
KINDS = np.full(256, 5, np.uint8)
KINDS[97:123], KINDS[128:], KINDS[65:91], KINDS[48:58] = 1, 1, 2, 3
KINDS[[ord(c) for c in ".,;:?!"]] = 4


class Reader:
    """Votes and hashed features of texts, with array operations over the words of many texts."""

    def __init__(self) -> None:
        self.hasher = WordHasher(SPACED)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Word hashes, offsets of the texts, and per word: bytes, first and last kind, letters above, whether it repeats."""
        hashes, at = self.hasher(texts)
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], SPACED[joined])).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        kinds = KINDS[joined]
        count = lambda k: np.concatenate(([0], np.cumsum(kinds == k, dtype=np.int32)))
        upper, lower = count(2), count(1)
        text_of = np.repeat(np.arange(len(texts)), np.diff(at))
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])
        last = ends - 1
        return hashes, at, {
            "bytes": ends - starts, "first": kinds[starts], "last": kinds[last], "before": kinds[np.maximum(last - 1, starts)],
            "upper": upper[ends] - upper[starts], "lower": lower[ends] - lower[starts], "same": same,
            "stop": np.isin(joined[last], np.frombuffer(b".?!", np.uint8)),
        }

    def votes(self, texts: list[bytes]) -> np.ndarray:
        """(texts, labellers) of -1, 0 and 1."""
        hashes, at, w = self.words(texts)
        n = np.diff(at)
        per = np.maximum(n, 1)
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[at])
        letters = np.maximum(total(w["upper"]) + total(w["lower"]), 1)
        distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)])
        mean, caps = total(w["bytes"]) / per, total(w["upper"]) / letters
        marked = total((w["last"] == 5) & (w["bytes"] > 1)) / per
        signs = total(((w["bytes"] == 1) & (w["first"] == 5)) | (((w["last"] == 4) & (w["before"] == 4)) & (w["bytes"] > 2))) / per
        same, stops, short = total(w["same"]) / per, total(w["stop"]), total((w["bytes"] <= 3) & (w["last"] == 1)) / per
        variety = distinct / per
        pick = lambda good, bad: np.where(bad, -1, np.where(good, 1, 0))
        long = n >= 20
        return np.stack(
            [
                pick(n >= 20, n == 0),
                pick((mean > 3) & (mean < 10), (mean < 2) | (mean > 16)),
                pick(caps < 0.15, caps > 0.5),
                pick(marked < 0.05, marked > 0.2),
                pick(signs < 0.05, signs > 0.15),
                pick(long & (variety > 0.35), long & (variety < 0.15)),
                pick(same < 0.02, same > 0.2),
                pick(long & (stops * 60 > n), long & (stops * 200 < n)),
                pick(long & (short > 0.08) & (short < 0.7), long & (short < 0.02)),
            ],
            1,
        )

    def features(self, texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of each text's words and of their shapes (two for a word), and offsets of the texts."""
        hashes, at, w = self.words(texts)
        shape = w["first"].astype(np.uint64) * np.uint64(8) + w["last"]
        shape = shape * np.uint64(8) + w["before"]
        shape = shape * np.uint64(16) + np.minimum(w["bytes"], 15).astype(np.uint64)
        shape = shape * np.uint64(2) + w["same"].astype(np.uint64)
        shape = shape * np.uint64(2) + (w["upper"] > 1).astype(np.uint64)
        both = np.stack([hashes, mix(shape + np.uint64(1 << 32))], 1).ravel()
        return (both & np.uint64(buckets - 1)).astype(np.int64), 2 * at


def patterns(votes: np.ndarray) -> np.ndarray:
    """A number for each row of votes."""
    return ((votes + 1) * 3 ** np.arange(votes.shape[1])).sum(1)


def expand(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[float, np.ndarray]:
    """The share of good documents, and (class, labeller, vote + 1) probabilities, for vote patterns and their counts.

    Starts from the balance of the votes, so that class 1 is the one most labellers call good.
    """
    lean = votes.sum(1) - 4.0 * (votes < 0).sum(1)
    posterior = 1 / (1 + np.exp(-lean))
    share, table = 0.5, np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        share = float(np.clip(weight[1].sum() / counts.sum(), 1e-3, 1 - 1e-3))
        for v in (-1, 0, 1):
            table[:, :, v + 1] = weight @ (votes == v) + 1.0
        table /= table.sum(2, keepdims=True)
        posterior = posteriors(votes, share, table)
    return share, table


def posteriors(votes: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    at = np.arange(votes.shape[1])
    good, bad = (np.log(table[c][at, votes + 1]).sum(1) for c in (1, 0))
    return 1 / (1 + np.exp(np.clip(bad - good + np.log((1 - share) / share), -60, 60)))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    share: float
    accuracies: dict[str, tuple[float, float]]

    def score(self, buckets: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(self.weights[buckets], dtype=np.float64)))
        z = np.diff(sums[at]) / np.maximum(np.diff(at) / 2, FEW) + self.bias
        return np.where(np.diff(at) > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)


def train_scorer(texts: list[bytes], weak: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Weights of buckets and bias, for soft labels."""
    rng, reader = np.random.default_rng(s.seed), Reader()
    rows = []
    for first in range(0, len(texts), 64):
        buckets, at = reader.features(texts[first : first + 64], s.buckets)
        for a, b in zip(at[:-1], at[1:], strict=True):
            own, count = np.unique(buckets[a:b], return_counts=True)
            rows.append((own.astype(np.int32), (count / max(FEW, (b - a) / 2)).astype(np.float32)))
    w, m, v = (np.zeros(s.buckets) for _ in range(3))
    bias = bias_m = bias_v = 0.0
    step = 0
    for epoch in range(s.epochs):
        for pick in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // s.batch)):
            step += 1
            rate = s.rate * (1 - epoch / s.epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            z = np.array([w[rows[i][0]] @ rows[i][1] for i in pick]) + bias
            delta = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - weak[pick]) / len(pick)
            at = np.concatenate([rows[i][0] for i in pick])
            near, back = np.unique(at, return_inverse=True)
            grad = np.bincount(back, np.concatenate([rows[i][1] * d for i, d in zip(pick, delta, strict=True)]), len(near)) + s.decay / len(pick) * w[near]
            m[near] = 0.9 * m[near] + 0.1 * grad
            v[near] = 0.999 * v[near] + 0.001 * grad**2
            w[near] -= rate * m[near] / (np.sqrt(v[near]) + 1e-8)
            g = delta.sum()
            bias_m, bias_v = 0.9 * bias_m + 0.1 * g, 0.999 * bias_v + 0.001 * g * g
            bias -= rate * bias_m / (np.sqrt(bias_v) + 1e-8)
    return w.astype(np.float32), float(bias)


def fit(docs: DataFrame, *, settings: Settings = Settings()) -> Model:
    """Votes of all docs, labellers' accuracies from them, and a scorer from a bounded sample."""
    s = settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                own, count = np.unique(patterns(reader.votes(texts)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(count)], ["pattern", "n"])

    with small_batches(docs.sparkSession):
        counted = docs.select("text").mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas().sort_values("pattern")  # 3 ** 9 rows at most
    if not len(counted):
        return Model(np.zeros(s.buckets, np.float32), 0.0, 0.5, {})
    votes = expand(counted["pattern"].to_numpy())
    share, table = expectation_maximisation(votes, counted["n"].to_numpy(float), s.rounds)
    ids = docs.select("doc_id", F.xxhash64("text").alias("h")).orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id", "h").limit(s.sample)
    some = docs.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi").select("doc_id", "text")  # s.sample rows at most
    some = some.orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id", F.xxhash64("text")).limit(s.sample).toPandas()
    texts = [(t or "").encode() for t in some["text"]]
    reader = Reader()
    weak = np.concatenate([posteriors(reader.votes(texts[i : i + 64]), share, table) for i in range(0, len(texts), 64)]) if texts else np.zeros(0)
    weights, bias = train_scorer(texts, weak, s)
    return Model(weights, bias, share, {name: (float(table[0, i, 0]), float(table[1, i, 2])) for i, name in enumerate(LABELLERS)})


def score(docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns keep and score (0 to 1, higher: better) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    source = docs.select(*keep, "text")
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reader = shared.value, Reader()
        for batch in batches:
            for first, texts in text_slices(batch.column(len(keep))):
                scores = own.score(*reader.features(texts, len(own.weights)))
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(first, len(texts)) for k in range(len(keep))], pa.array(scores)], [*keep, "score"])

    return source.mapInArrow(run, schema)


def good_documents(docs: DataFrame, *, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs that the classifier keeps, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, settings=settings))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reader = shared.value, Reader()
        for batch in batches:
            for first, texts in text_slices(batch.column(place)):
                scores = own.score(*reader.features(texts, len(own.weights)))
                yield batch.slice(first, len(texts)).filter(pa.array(scores >= settings.threshold))

    return docs.mapInArrow(run, docs.schema)
