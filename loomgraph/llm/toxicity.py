"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z) and their first bytes are hashed to rows of an
embedding table, whose sum stands for the word. Filters of several widths run over the whole text, each keeps its
largest response (max pooling), and a logistic layer turns these into a score. Everything is trained here in numpy by
Adam on a bounded sample of labelled texts; texts alone are inputs. A temperature is fitted so that scores are
probabilities, and a threshold is calibrated for each language on texts kept out of the training; ``flagged`` uses it, while the score doesn't know the language.

Scoring is one pass over whole texts with arrays over all words of a batch: no text is cut, and a text of any length
needs memory in proportion to a slice of it. Null or empty texts have no words and score what the output layer gives for
no response. Rows score by their text alone, so repeated rows score alike, and so do rows whose lang or doc_id is null.
A doc_id with labels of both kinds counts as toxic; null labels and labels of null ids aren't learned from. Without
labels of both kinds every score is 0.5.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import ALNUM, WordHasher, text_slices


@dataclass(frozen=True)
class Settings:
    """sample: labelled texts that training sees at most, taken in the order of a hash of doc_id. rows and size: of the
    embedding table. widths: words under a filter. held: share of the sample kept for calibration. threshold: of the
    score; the scale is fitted to it."""

    sample: int = 8000
    rows: int = 1 << 20
    size: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    prefixes: tuple[tuple[int, bool], ...] = ((5, True), (7, False))
    filters: int = 8
    epochs: int = 10
    batch: int = 32
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7
    held: float = 0.2
    threshold: float = 0.7


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    widths: tuple[int, ...]
    prefixes: tuple[tuple[int, bool], ...] = ()
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Largest response of every filter over each text, at least 0. Filters that reach beyond a text's end see zeros.

        Every sum runs over embedding columns and filter words in one fixed order, one multiplication and one addition at
        a time: a matrix product may round by a row's place and neighbours, and a text's score mustn't depend on these."""
        size = np.diff(at)
        full = np.flatnonzero(size)
        out = np.zeros((len(size), sum(f.shape[2] for f in self.filters)), np.float32)
        if not len(full):
            return out
        x = self.table[words[0]]
        for more in words[1:]:
            x += self.table[more]
        x = np.ascontiguousarray(x.T)  # a line for each embedding column
        last = at[1:][full] - 1
        product, to = np.empty(x.shape[1], np.float32), 0
        for f, b in zip(self.filters, self.biases, strict=True):
            width, columns, n = f.shape
            for j in range(n):
                total = np.full(x.shape[1], b[j], np.float32)
                for k in range(min(width, x.shape[1])):
                    stop = x.shape[1] - k
                    own = np.zeros(stop, np.float32) if k else total
                    for d in range(columns):
                        np.multiply(x[d, k:], f[k, d, j], out=product[:stop])
                        own += product[:stop]
                    if k:
                        for back in range(k):  # places from which word k of the filter lies beyond the text's end
                            past = last - back
                            own[past[(past >= 0) & (past < stop)]] = 0
                        total[:stop] += own
                out[full, to + j] = np.maximum(np.maximum.reduceat(total, at[full]), 0)
            to += n
        return out

    def logits(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        pooled = self.pooled(words, at)
        z = np.full(len(pooled), self.bias, np.float64)
        for j, weight in enumerate(self.out.tolist()):  # in a fixed order as well
            z += pooled[:, j].astype(np.float64) * weight
        return z

    def score(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(words, at) * self.scale + self.shift, -30, 30)
        return np.array([1 / (1 + math.exp(-v)) for v in z.tolist()], np.float64)


def _hashed(texts: list[bytes], hasher: WordHasher, rows: int, prefixes: tuple[tuple[int, bool], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all words, a line for the word itself and one for each kind of prefix, and offsets of the texts."""
    hashes, at = hasher.with_prefixes(texts, prefixes)
    return np.array([h & np.uint64(rows - 1) for h in hashes]).astype(np.int64), at


def train(texts: list[bytes], labels: np.ndarray, langs: list[str | None], s: Settings = Settings()) -> Model:
    """Fit the model, its scale and its thresholds. Order of the rows decides the split, so give them in a fixed order."""
    rng = np.random.default_rng(s.seed)
    n_filters = len(s.widths) * s.filters
    model = Model(
        rng.normal(0, 0.1, (s.rows, s.size)).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * s.size), (w, s.size, s.filters)).astype(np.float32) for w in s.widths],
        [np.zeros(s.filters, np.float32) for _ in s.widths],
        rng.normal(0, 0.3, n_filters).astype(np.float32),
        0.0,
        s.widths,
        s.prefixes,
    )
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        model.out[:], model.scale = 0, 0.0
        return model
    hasher, parts, at = WordHasher(ALNUM), [], [0]
    for first in range(0, len(texts), 64):  # the hasher's arrays take some 50 bytes for a byte of text
        some, own = _hashed(texts[first : first + 64], hasher, s.rows, s.prefixes)
        parts.append(some.astype(np.int32))
        at += (own[1:] + at[-1]).tolist()
    words, at = np.concatenate(parts, 1), np.array(at)
    held = rng.random(len(labels)) < s.held
    fit = np.flatnonzero(~held)
    weight = np.where(labels > 0, (labels[fit] == 0).sum() / max(1, (labels[fit] > 0).sum()), 1.0).astype(np.float32)
    weight = np.sqrt(weight)
    params = [model.table, *model.filters, *model.biases, model.out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    trained = np.zeros(s.rows, bool)
    bias_m = bias_v = 0.0
    step = 0
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs)
        for pick in np.array_split(rng.permutation(fit), max(1, len(fit) // s.batch)):
            step += 1
            sizes = at[pick + 1] - at[pick]
            full = np.flatnonzero(sizes)
            flat = np.concatenate([words[:, at[i] : at[i + 1]] for i in pick], 1)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            if not flat.size:
                continue
            x = model.table[flat].sum(0)
            text_of = np.repeat(np.arange(len(pick)), sizes)
            pooled, tops = [], []
            for w, f, b in zip(s.widths, model.filters, model.biases, strict=True):
                total = x @ f[0] + b
                for k in range(1, w):
                    same = text_of[k:] == text_of[:-k]
                    total[:-k] += (x[k:] @ f[k]) * same[:, None]
                best = np.zeros((len(pick), s.filters), np.float32)
                top = np.full((len(pick), s.filters), -1, np.int64)
                for i in full:
                    part = total[starts[i] : starts[i + 1]]
                    top[i] = part.argmax(0)
                    best[i] = part[top[i], np.arange(s.filters)]
                    top[i] += starts[i]
                pooled.append(best)
                tops.append(top)
            raw = np.concatenate(pooled, 1)
            act = np.maximum(raw, 0)
            z = act @ model.out + model.bias
            y = labels[pick]
            delta = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight[pick] / len(pick)).astype(np.float32)
            grads = [None, *[np.zeros_like(f) for f in model.filters], *[np.zeros_like(b) for b in model.biases], act.T @ delta + s.decay * model.out]
            back = (delta[:, None] * model.out) * (raw > 0)
            rows_at, rows_grad = [], []
            for g, (w, f) in enumerate(zip(s.widths, model.filters, strict=True)):
                d, top = back[:, g * s.filters : (g + 1) * s.filters], tops[g]
                for j in range(s.filters):
                    on = np.flatnonzero((d[:, j] != 0) & (top[:, j] >= 0))
                    for k in range(w):
                        place = top[on, j] + k
                        ok = place < starts[on + 1]
                        rows, amount = place[ok], d[on[ok], j]
                        grads[1 + g][k, :, j] += x[rows].T @ amount
                        rows_at.append(flat[:, rows].ravel())
                        rows_grad.append(np.tile(amount[:, None] * f[k, :, j], (len(flat), 1)))
                grads[1 + len(s.widths) + g] = d.sum(0)
            touched, back_to = np.unique(np.concatenate(rows_at), return_inverse=True)
            sums = np.zeros((len(touched), s.size), np.float32)
            np.add.at(sums, back_to, np.concatenate(rows_grad))
            trained[touched] = True
            first[0][touched] = 0.9 * first[0][touched] + 0.1 * sums
            second[0][touched] = 0.999 * second[0][touched] + 0.001 * sums**2
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            model.table[touched] -= rate * fix * first[0][touched] / (np.sqrt(second[0][touched]) + 1e-8)
            for p in range(1, len(params)):
                first[p] = 0.9 * first[p] + 0.1 * grads[p]
                second[p] = 0.999 * second[p] + 0.001 * grads[p] ** 2
                params[p] -= rate * fix * first[p] / (np.sqrt(second[p]) + 1e-8)
            g = float(delta.sum())
            bias_m, bias_v = 0.9 * bias_m + 0.1 * g, 0.999 * bias_v + 0.001 * g * g
            model.bias -= rate * fix * bias_m / (np.sqrt(bias_v) + 1e-8)
    model.table[~trained] = 0  # words that training never looked at have no say
    _calibrate(model, words, at, labels, langs, np.flatnonzero(held), s)
    return model


def _calibrate(model: Model, words: np.ndarray, at: np.ndarray, labels: np.ndarray, langs: list[str | None], held: np.ndarray, s: Settings) -> None:
    """Fit scale and shift so that the common threshold separates best on the held texts, then one for each language."""
    if len(set(labels[held].tolist())) < 2:
        return
    own = np.concatenate([words[:, at[i] : at[i + 1]] for i in held], 1)
    z = model.logits(own, np.concatenate(([0], np.cumsum(at[held + 1] - at[held])))).astype(np.float64)
    cut = _best_cut(z, labels[held])
    spread = max(1e-3, float(np.quantile(np.abs(z - cut), 0.5)))
    model.scale = 4.0 / spread
    model.shift = float(np.log(s.threshold / (1 - s.threshold)) - model.scale * cut)
    scores = 1 / (1 + np.exp(-np.clip(z * model.scale + model.shift, -30, 30)))
    for lang in sorted({x for x in langs if x is not None}):
        mine = np.array([langs[i] == lang for i in held])
        if labels[held][mine].sum() >= 5 and (labels[held][mine] == 0).sum() >= 5:
            model.thresholds[lang] = _best_cut(scores[mine], labels[held][mine])


def _best_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the largest F1."""
    order = np.argsort(values, kind="stable")
    v, y = values[order], labels[order]
    hits = y[::-1].cumsum()[::-1]
    f1 = 2 * hits / (np.arange(len(v), 0, -1) + y.sum())
    lower = np.concatenate(([v[0] - 1], v[:-1]))
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    at = best[np.argmax((v - lower)[best])]
    return float((v[at] + lower[at]) / 2)


def fit(docs: DataFrame, labels: DataFrame, *, learn: object = None, settings: Settings = Settings()) -> Model:
    """Train on at most settings.sample labelled texts of docs: rows of labels for which the condition ``learn`` holds,
    in the order of a hash of doc_id. Only that sample comes to the driver."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null")
    marked = marked.where(learn) if learn is not None else marked
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id"), F.lit(settings.seed))
    some = marked.orderBy(order, "doc_id").limit(settings.sample)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select("doc_id", "text", lang.alias("lang"))
    rows = texts.join(F.broadcast(some), "doc_id").orderBy(order, "doc_id", F.xxhash64("text")).limit(settings.sample).toPandas()
    return train([(t or "").encode() for t in rows["text"]], rows["toxic"].to_numpy(), [x if isinstance(x, str) else None for x in rows["lang"]], settings)


def score(docs: DataFrame, model: Model, *, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted (score >= threshold) and flagged (by the language's own threshold) of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # of fixed size: the embedding table and a few filters
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hasher = shared.value, WordHasher(ALNUM)
        rows = len(own.table)
        for batch in batches:
            for first, texts in text_slices(batch.column(2), 1 << 19):
                s = own.score(*_hashed(texts, hasher, rows, own.prefixes))
                part = batch.slice(first, len(texts))
                limits = np.array([own.thresholds.get(x, threshold) for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array((s >= limits).astype(np.int32))], ["doc_id", "score", "predicted", "flagged"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), "text").mapInArrow(run, "doc_id long, score double, predicted int, flagged int")


def third(doc_id: int) -> int:
    """The fold of a doc_id: crc32 of its decimal text modulo 3."""
    return zlib.crc32(str(doc_id).encode()) % 3
