"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest rows of other labels whose
score lies in a window below that positive's score.

Scores are inner products of vectors of integers. Both searches are threshold joins in the manner of L2AP: all rows are
searched for scores of at least a threshold, which starts high and is lowered, round after round, for those anchors and
windows that aren't full yet; the last round has no threshold (positives) or the window's own lower end (negatives).

Rows are dealt into blocks, and questions are copied to the blocks. Both are sorted so that a block's rows come first: a
task builds their index, then answers one question after another. The index is inverted, by groups of dimensions. With
``reach``, the smallest threshold of a unit of the questions' norms, the leading dimensions of a row whose norm together
stays below it can't reach any threshold alone; these entries are left out of the lists. A question goes through the
lists from the last group to the first, adds up partial scores, and drops a row as soon as its sum and the product of what
is left of both norms (Cauchy-Schwarz) stay below the threshold. What is left is scored exactly, with the left out
dimensions. Nothing is lost by a bound, so results don't depend on blocks or rounds.

Rows with a null id or label, a null vector, or null or non-finite components take no part. Scaled components are held
within bounds that keep every score a long (more than 2**28 for 64 dimensions). Only vectors of one length meet; empty
and zero vectors score 0. Rows that repeat an id count once; where label or vector differ, the one with the smallest
hash. Ties go to the smaller id. Fewer candidates than asked for all come back; an empty table gives an empty answer;
other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import broadcast_if_small, discard, materialize

LOWEST, HIGHEST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Settings:
    """scale: of components before they are rounded down. positives, negatives: how many of each. low, high: the window's
    ends in hundredths of the positive's score. starts: thresholds for positives as shares of the anchor's squared norm;
    steps: for negatives as shares of the positive's score (the window's lower end follows). group: dimensions in a list.
    values: components in a block of rows. tasks: parts that a search has at least, if there are rows for them."""

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    starts: tuple[float, ...] = (0.5, 0.35, 0.25)
    steps: tuple[float, ...] = (0.96, 0.9)
    group: int = 8
    values: int = 1 << 20
    tasks: int = 48


class Index:
    """Inverted lists of a block of rows, by groups of dimensions."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, reach: float, group: int):
        n, size = x.shape
        self.groups = [slice(a, min(a + group, size)) for a in range(0, size, group)]
        squares = np.array([(x[:, g].astype(np.float64) ** 2).sum(1) for g in self.groups]).reshape(len(self.groups), n)
        norms = np.sqrt(np.cumsum(squares, 0)) * (1 + 1e-9)  # of all dimensions up to the end of a group
        cut = (norms < reach).sum(0)  # groups that no list has of this row; all: it reaches no threshold
        order = np.lexsort((ids, cut))
        order = order[cut[order] < len(self.groups)] if size else order
        self.ids, self.labels, self.cut = ids[order], labels[order], cut[order]
        self.before = np.concatenate((np.zeros((1, len(order))), norms[:, order]))  # of all dimensions before a group
        self.lists = [np.ascontiguousarray(x[order[: np.searchsorted(self.cut, i, "right")], g], np.float64) for i, g in enumerate(self.groups)]
        self.x = x[order]
        self.largest = float(np.abs(x).max(initial=0))
        self.own = {label: np.flatnonzero(self.labels == label) for label in np.unique(self.labels).tolist()}

    def at_least(self, q: np.ndarray, low: int, label: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of rows of this label (or of all others) whose score is at least low, and their scores."""
        mine = self.own.get(label, np.zeros(0, np.int64))
        live = mine if same else np.delete(np.arange(len(self.ids)), mine)
        if low > LOWEST and self.groups:
            q_float = q.astype(np.float64)
            q_before = np.concatenate(([0], np.sqrt(np.cumsum([(q_float[g] ** 2).sum() for g in self.groups])))) * (1 + 1e-9)
            sums = np.zeros(len(live))
            for i in range(len(self.groups) - 1, -1, -1):
                held = np.searchsorted(live, len(self.lists[i]))  # rows stand in the order of their cuts
                sums[:held] += self.lists[i][live[:held]] @ q_float[self.groups[i]]
                rest = np.maximum(self.cut[live], i)  # what is left begins before this group, or before all that lists have
                slack = 1e-9 * (np.abs(sums) + q_before[-1] * self.before[-1, live])
                keep = sums + q_before[rest] * self.before[rest, live] + slack >= low
                live, sums = live[keep], sums[keep]
        score = dot(self.x[live], q, self.largest)
        keep = score >= low
        return live[keep], score[keep]


def dot(x: np.ndarray, q: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products of integers, by floating point where that is exact."""
    if x.shape[1] * largest * float(np.abs(q).max(initial=0)) < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return (x.astype(np.int64) * q.astype(np.int64)).sum(1)


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, size, x (integers) and norm of the rows that take part, one for each id."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    own = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(~F.exists("v", bad))
    most = F.least(F.lit(float(2**31 - 1)), F.floor(F.sqrt(F.lit(float(2**62)) / F.greatest(F.size("v"), F.lit(1)))).cast("double"))
    x = F.transform("v", lambda c: F.floor(F.greatest(-most, F.least(most, c * F.lit(float(scale))))).cast("int"))
    own = own.select("vec_id", "label", F.size("v").alias("size"), x.alias("x"))
    if own.groupBy("vec_id").count().where("count > 1").head(1):
        own = own.groupBy("vec_id").agg(F.min_by(F.struct("label", "size", "x"), F.struct(F.xxhash64("label", "x"), "label", "x")).alias("r")).select("vec_id", "r.*")
    return own.withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))


def _search(vectors: DataFrame, spaces: DataFrame, asked: DataFrame, same: bool, keep: int, s: Settings) -> DataFrame:
    """anchor_id, window, vec_id and score: the first ``keep`` rows of each window of each question.

    asked: anchor_id, label, size, x, norm and windows (array of window, low, high)."""
    least = F.array_min(F.transform("windows", lambda w: w["low"]))
    reach = asked.groupBy("size").agg(F.min(least / F.greatest("norm", F.lit(1e-9))).alias("reach"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    rows = vectors.join(spaces, "size").select("size", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"), "turns", F.col("vec_id").alias("id"), "label", "x", F.lit(None).cast(asked.schema["windows"].dataType).alias("windows"), F.lit(0.0).alias("reach"))
    rows = rows.select("*", every(F.col("turns")).alias("turn"))
    questions = asked.join(spaces, "size").join(F.broadcast(reach) if reach.limit(1001).count() <= 1000 else reach, "size")
    questions = questions.select("size", every(F.col("blocks")).alias("block"), "turns", F.col("anchor_id").alias("id"), "label", "x", "windows", "reach", F.pmod(F.xxhash64("anchor_id"), F.col("turns")).alias("turn"))
    both = rows.unionByName(questions).repartition("size", "block", "turn").sortWithinPartitions("size", "block", "turn", F.col("windows").isNotNull(), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, index, held = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.array([batch.column(i).to_numpy() for i in range(3)])
            is_row = batch.column(6).is_null().to_numpy(zero_copy_only=False)
            ids, labels, reaches = batch.column(3).to_numpy(), batch.column(4).to_numpy(), batch.column(7).to_numpy()
            edges = np.flatnonzero((np.diff(keys) != 0).any(0) | (np.diff(is_row.astype(np.int8)) != 0)) + 1
            found: list[tuple] = []
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if (key := tuple(keys[:, a].tolist())) != now:
                    now, index, held = key, None, []
                x = batch.column(5).slice(a, b - a).flatten().to_numpy().reshape(b - a, int(key[0]))
                if is_row[a]:
                    held.append((ids[a:b], labels[a:b], x))
                    continue
                if index is None:
                    index = Index(*(np.concatenate(c) for c in zip(*held, strict=True)), reaches[a], s.group) if held else False
                    held = []
                if index is False:
                    continue  # questions that no row of this block can answer
                for i, windows in enumerate(batch.column(6).slice(a, b - a).to_pylist()):
                    own = int(ids[a + i])
                    live, score = index.at_least(x[i], min(w["low"] for w in windows), int(labels[a + i]), same)
                    if same:
                        other = index.ids[live] != own
                        live, score = live[other], score[other]
                    for w in windows:
                        at = np.flatnonzero((score >= w["low"]) & (score <= w["high"]))
                        at = at[np.lexsort((index.ids[live[at]], -score[at]))[:keep]]
                        found += [(own, w["window"], *r) for r in zip(index.ids[live[at]].tolist(), score[at].tolist(), strict=True)]
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor_id", "window", "vec_id", "score"])

    some = both.select("size", "block", "turn", "id", "label", "x", "windows", "reach").mapInArrow(run, "anchor_id long, window int, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id"))
    return some.withColumn("place", place).where(F.col("place") <= keep)


def _fill(vectors: DataFrame, spaces: DataFrame, wanted: DataFrame, lows: list[Column], same: bool, keep: int, s: Settings) -> DataFrame:
    """Search with one threshold after another, each time for those windows of wanted that aren't full.

    wanted: anchor_id, window, low (the last threshold), high, base (what thresholds are shares of)."""
    about = vectors.select(F.col("vec_id").alias("anchor_id"), "label", "size", "x", "norm")
    parts, left = [], wanted
    for at, low in enumerate((*lows, F.col("low"))):
        windows = left.select("anchor_id", F.struct("window", F.greatest("low", low.cast("long")).alias("low"), "high").alias("w")).groupBy("anchor_id").agg(F.collect_list("w").alias("windows"))  # an anchor has as many as positives
        asked = materialize(about.join(windows, "anchor_id"), "questions")
        found = materialize(_search(vectors, spaces, asked, same, keep, s), "hits")
        discard(asked)
        if at == len(lows):
            parts.append(found)
            break
        full = found.groupBy("anchor_id", "window").count().where(F.col("count") >= keep).select("anchor_id", "window")
        parts.append(found.join(full, ["anchor_id", "window"]))
        left = materialize(left.join(full, ["anchor_id", "window"], "left_anti"), "open")
        if not left.head(1):
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def nearest_of_label(vectors: DataFrame, anchors: DataFrame, spaces: DataFrame, s: Settings) -> DataFrame:
    """anchor_id, place, positive_id and positive_score. vectors: as ``usable`` gives them; anchors: some of these rows."""
    wanted = anchors.select(F.col("vec_id").alias("anchor_id"), F.lit(0).alias("window"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"), (F.col("norm") * F.col("norm")).alias("base"))
    found = _fill(vectors, spaces, wanted, [F.floor(F.col("base") * share) for share in s.starts], True, s.positives, s)
    return found.select("anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))


def mine(vectors: DataFrame, *, is_anchor: Column, settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of rows (vec_id, label, embedding)."""
    s = settings
    own = materialize(usable(vectors, s.scale), "vectors")
    values = F.ceil(F.col("n") * F.greatest("size", F.lit(1)) / F.lit(s.values))
    spaces = own.groupBy("size").agg(F.count("*").alias("n")).select("size", values.alias("blocks"))
    spaces = broadcast_if_small(materialize(spaces.withColumn("turns", F.ceil(F.lit(s.tasks) / F.col("blocks"))), "spaces"))
    near = materialize(nearest_of_label(own, own.where(is_anchor), spaces, s), "positives")
    share = lambda n: F.col("positive_score").cast("decimal(20,0)") * F.lit(Decimal(n) / 100)  # noqa: E731  exact
    window = F.col("place").cast("int").alias("window")
    wanted = near.select("anchor_id", window, F.ceil(share(s.low)).cast("long").alias("low"), F.floor(share(s.high)).cast("long").alias("high"), F.col("positive_score").alias("base")).where("low <= high")
    found = _fill(own, spaces, wanted, [F.floor(F.col("base") * share) for share in s.steps], False, s.negatives, s)
    named = found.join(near.select("anchor_id", window, "positive_id", "positive_score"), ["anchor_id", "window"])
    return named.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine_sql() -> str:
    """DuckDB SQL for op13's rows: every anchor with every row."""
    return """
WITH own AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM own a JOIN own b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM near JOIN scored n USING (anchor_id) WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
QUALIFY rank <= 5"""
