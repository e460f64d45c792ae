"""Approximate nearest neighbours by inner product, with additive quantisation.

A vector is coded as the sum of one word from each of several full-dimensional codebooks. The books are fitted on a
bounded sample: k-means on what the earlier books leave, then least squares over all books together for the codes found.
Codes are chosen by beam search over the residuals. With each code its norm factor is stored, |x|^2 / <x, sum of words>,
which makes the estimate of an inner product exact along x. A query is scored against a block of codes with one lookup
table for each book; a block's best are scored exactly there, on the original vectors, and the nearest of them go on.
What a block selects depends on its size and not on the table's, so recall doesn't fall as a table grows.

Equal vectors are coded once: each distinct vector has its smallest ids, as many as an answer can hold, so that a vector
which a third of the rows repeat costs as much as any other and hides no neighbours. All distinct vectors are indexed;
queries meet all of them, block by block. Blocks have a bounded number of vectors and of values, and one task holds a
block of either kind. Codes and vectors are dealt by block; blocks of queries are copied to them.

An inner product needs vectors of one length, so each length is a space of its own, with its own books: a query's
neighbours have its length. A space of at most ``least`` distinct vectors has nothing to select: all are scored
exactly. Vectors that are null, zero, or hold nulls or values that aren't finite take no part, nor do null ids. Ties go
to the smaller id. Rows that repeat an id count once; if their vectors differ, the one with the smallest hash. With fewer candidates than asked for, all come back; an empty table gives an empty answer. Scores are computed in
double precision on the vectors as they came.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import discard, materialize, rows_per_batch


@dataclass(frozen=True)
class Settings:
    """books and words: of the code; beam: codes kept while encoding; sample: vectors that fit the books at most;
    rerank and least: distinct candidates that a query scores exactly in a block, an eighth of it within these bounds;
    block and values: vectors and their values in a block; queries: vectors in a block of queries."""

    books: int = 32
    words: int = 128
    beam: int = 4
    sample: int = 8192
    rounds: int = 6
    rerank: int = 512
    least: int = 64
    block: int = 32768
    values: int = 1 << 20
    queries: int = 512
    seed: int = 5


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words**2).sum(1) - 2 * (x @ words.T), 1)


def fit_books(x: np.ndarray, s: Settings = Settings()) -> np.ndarray:
    """Codebooks (books, words, dimension) for a sample of vectors."""
    rng = np.random.default_rng(s.seed)
    x = np.asarray(x, np.float32)
    words = min(s.words, len(x))
    rest, books = x.copy(), np.zeros((s.books, words, x.shape[1]), np.float32)
    for m in range(s.books):
        own = rest[rng.choice(len(rest), words, replace=False)].copy()
        for _ in range(s.rounds):
            at = _nearest(rest, own)
            sums = np.zeros_like(own)
            np.add.at(sums, at, rest)
            count = np.bincount(at, minlength=words)
            own = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], rest[rng.choice(len(rest), words)])
        books[m] = own
        rest -= own[_nearest(rest, own)]
    codes = encode(x, books, s.beam).astype(np.int64)
    # least squares: all books at once for these codes, pulled towards the books found
    size = s.books * words
    flat = codes + np.arange(s.books) * words
    both = np.zeros((size, size), np.float32)
    for a in range(s.books):
        for b in range(s.books):
            np.add.at(both, (flat[:, a], flat[:, b]), 1)
    both[np.arange(size), np.arange(size)] += 1
    gap = x - books[np.arange(s.books), codes].sum(1)
    right = np.zeros((size, x.shape[1]), np.float32)
    for a in range(s.books):
        np.add.at(right, flat[:, a], gap)
    return books + np.linalg.solve(both, right).reshape(books.shape)


def encode(x: np.ndarray, books: np.ndarray, beam: int) -> np.ndarray:
    """Codes (n, books) by beam search: the sums that come nearest, book after book."""
    out = np.zeros((len(x), len(books)), np.uint8)
    norms = (books**2).sum(2)
    for first in range(0, len(x), 1024):
        rest = x[first : first + 1024, None].astype(np.float32)
        n = len(rest)
        codes = np.zeros((n, 1, 0), np.uint8)
        rows = np.arange(n)[:, None]
        for m, own in enumerate(books):
            far = ((rest**2).sum(2)[:, :, None] + norms[m] - 2 * (rest @ own.T)).reshape(n, -1)
            keep = min(beam, far.shape[1])
            best = np.argpartition(far, keep - 1, 1)[:, :keep]
            parent, word = best // len(own), best % len(own)
            rest = rest[rows, parent] - own[word]
            codes = np.concatenate((codes[rows, parent], word[:, :, None].astype(np.uint8)), 2)
        out[first : first + n] = codes[np.arange(n), (rest**2).sum(2).argmin(1)]
    return out


def dot(x: Column, y: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, v: s + v)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    own = own.where("vec_id is not null and embedding is not null and size(embedding) > 0")
    return own.where(~F.exists("embedding", bad) & F.exists("embedding", lambda v: v != 0))


def _search(distinct: DataFrame, asked: DataFrame, size: int, total: int, k: int, s: Settings) -> DataFrame:
    """query, rep and score: for each asked rep the k nearest in each block among those that the codes bring nearest.
    distinct: rep and embedding, of one size."""
    spark = distinct.sparkSession
    some = distinct.orderBy(F.xxhash64("rep", F.lit(s.seed))).limit(s.sample).select("embedding").toPandas()["embedding"]
    some = np.array(some.tolist())
    scale = float(np.abs(some).max())  # codes are of single precision, whatever the size of the values
    books = spark.sparkContext.broadcast(fit_books(some / scale, s))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = (batch.column(1).flatten().to_numpy() / scale).reshape(batch.num_rows, size)
                codes = encode(x, books.value, s.beam)
                decoded = books.value[np.arange(len(books.value)), codes].sum(1)
                along = (x * decoded).sum(1)
                factor = np.where(along > 0, (x**2).sum(1) / np.maximum(along, 1e-12), 1.0).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factor)], ["rep", "embedding", "code", "factor"])

    queries = distinct.join(asked.select("rep").distinct(), "rep")
    parts, blocks = -(-queries.count() // s.queries), -(-total // max(1, min(s.block, s.values // size)))
    fan = min(parts, -(-32 // blocks))  # few blocks: each is copied for some queries, so that all executors have work
    coded = distinct.select("rep", "embedding").mapInArrow(code, "rep long, embedding array<double>, code binary, factor float")
    coded = coded.groupBy(F.pmod(F.xxhash64("rep"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("rep", "embedding", "code", "factor")).alias("codes"))  # about s.block vectors
    asking = queries.groupBy(F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(parts)).alias("part")).agg(F.collect_list(F.struct("rep", "embedding")).alias("queries"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    coded, asking = materialize(coded, "codes"), materialize(asking, "queries")
    met = coded.withColumn("turn", every(fan)).join(asking.withColumn("block", every(blocks)).withColumn("turn", F.col("part") % fan), ["block", "turn"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_books = books.value
        for batch in batches:
            for i in range(batch.num_rows):
                codes, own = (batch.column(c).slice(i, 1).flatten() for c in (0, 1))
                rep = codes.field("rep").to_numpy()
                code = np.frombuffer(b"".join(codes.field("code").to_pylist()), np.uint8).reshape(len(rep), -1)
                up = np.argsort(rep)  # ties go to the smaller id
                rep, code, factor = rep[up], code[up], codes.field("factor").to_numpy()[up]
                x = np.ascontiguousarray(codes.field("embedding").flatten().to_numpy().reshape(len(up), size)[up].T)
                q_rep = own.field("rep").to_numpy()
                q = own.field("embedding").flatten().to_numpy().reshape(len(q_rep), size)
                tables = np.einsum("qd,mkd->mqk", (q / scale).astype(np.float32), own_books, optimize=True)
                keep = min(len(rep), s.rerank, max(s.least, len(rep) // 8))
                most = min(k, keep)
                for at in range(0, len(q), 64):
                    here = q[at : at + 64]
                    score = np.zeros((len(here), len(rep)), np.float32)
                    for m in range(len(own_books)):
                        score += tables[m, at : at + 64][:, code[:, m]]
                    score *= factor
                    best = np.sort(np.argpartition(-score, keep - 1, 1)[:, :keep], 1)
                    exact = np.zeros(best.shape)
                    for d in range(size):  # in the order of dimensions, as dot does
                        exact += x[d][best] * here[:, d : d + 1]
                    first = np.argsort(-exact, 1, kind="stable")[:, :most]
                    reps, scores = (np.take_along_axis(v, first, 1).ravel() for v in (rep[best], exact))
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_rep[at : at + 64], most)), pa.array(reps), pa.array(scores)], ["query", "rep", "score"])

    with rows_per_batch(spark, 2):  # a row is two blocks
        found = materialize(met.select("codes", "queries").mapInArrow(scan, "query long, rep long, score double"), "found")
    discard(coded, asking)
    return found


def nearest(vectors: DataFrame, *, is_query: Column, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest that are found for each query, its own row left out."""
    s, spark = settings, vectors.sparkSession
    own = usable(vectors)
    if own.groupBy("vec_id").count().where("count > 1").head(1):
        own = own.groupBy("vec_id").agg(F.min_by("embedding", F.struct(F.xxhash64("embedding"), "embedding")).alias("embedding"))
    # the smallest k + 1 ids of each distinct vector: Spark limits each part of a group before it is shuffled
    order = Window.partitionBy("embedding").orderBy("vec_id")
    ids = own.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= k + 1).dropDuplicates(["embedding", "vec_id"])
    ids = materialize(ids, "ids")
    distinct = ids.where("place = 1").select(F.col("vec_id").alias("rep"), "embedding", F.size("embedding").alias("size"))
    distinct = materialize(distinct, "distinct")
    members = materialize(ids.join(distinct.select("rep", "embedding"), "embedding").select("rep", "vec_id"), "members")
    asked = materialize(own.where(is_query).join(distinct.select("rep", "embedding", "size"), "embedding").select(F.col("vec_id").alias("query_id"), "rep", "size").distinct(), "asked")
    spaces = distinct.groupBy("size").agg(F.count("*").alias("n")).where(F.col("n") > s.least).collect()  # a row for each length of many vectors
    large = [r["size"] for r in spaces]
    small = distinct.where(~F.col("size").isin(large)) if large else distinct
    queries = distinct.join(asked.select("rep").distinct(), "rep").select(F.col("rep").alias("query"), "size", F.col("embedding").alias("y"))
    exact = queries.join(small.withColumnRenamed("embedding", "x"), "size").select("query", "rep", dot(F.col("x"), F.col("y")).alias("score"))  # s.least of a size at most
    for r in sorted(spaces):
        here = F.col("size") == r["size"]
        if asked.where(here).head(1):
            exact = exact.unionByName(_search(distinct.where(here), asked.where(here), r["size"], r["n"], k + 1, s))
    # the first k + 1 rows of each distinct query answer all its rows
    expanded = exact.join(members, "rep").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k + 1)
    answers = materialize(expanded.select(F.col("query").alias("rep"), "vec_id", "score"), "answers")
    each = asked.join(answers, "rep").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
