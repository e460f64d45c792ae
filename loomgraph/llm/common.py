"""What several corpus operators share: the shared scratch folder, text batches and word hashes."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
WHITE = r"[\x20\x09-\x0D]"
MASK32 = np.uint64(0xFFFFFFFF)


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where it is unset, a local master gets a new folder
    of its own (tests), and a cluster stops: its executors wouldn't see each other's rows there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote, once all that reads them has been written itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what runs inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def rows_per_batch(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager[None]:
    """Arrow batches of so many rows for what runs inside: for tables whose rows are large."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def small_batches(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Arrow batches of 4 MB for what runs inside, or of one row where that is longer: texts are held twice, by the
    executor and by its Python worker, and numbers have small batches anyway."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """A table of a few numbers a row that has been written before: broadcast if it has at most so many rows, else left
    to Spark's own choice of a join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns that stand beside those of df for a while: the ones given, longer where df has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text):
    """Number of ``[^\\x20\\x09-\\x0D]+`` words in a text column as long; null and blank texts have 0."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE + "+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def text_slices(texts: pa.Array, max_bytes: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts of about max_bytes together, as UTF-8 (null: empty), with the index of their first row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    held, first, total = [], 0, 0
    for i, value in enumerate(texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())):
        value = value.as_py() or b""
        if held and total + len(value) > max_bytes:
            yield first, held
            held, first, total = [], i, 0
        held.append(value)
        total += len(value)
    if held:
        yield first, held


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (the public SplitMix64 constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    base = 0x9E3779B97F4A7C15
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(n, np.uint64)
        done, step = 1, b
        while done < n:  # doubling: p[done:2 done] = p[:done] * base**done
            more = min(done, n - done)
            p[done : done + more] = p[:more] * np.uint64(step)
            done, step = done + more, step * step % (1 << 64)
        out.append(p)
    return out[0], out[1]


class WordHasher:
    """Hashes all words of many texts at once: prefix sums of a polynomial over the bytes, without a loop over words.

    ``is_word`` marks the bytes of words; A-Z are lower-cased first. Hashes depend on the word's bytes alone.
    """

    def __init__(self, is_word: np.ndarray):
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.is_word = is_word[self.lower]
        self.bytes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[self.lower]
        self.powers, self.inverse = _powers(1 << 16)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts in order, and offsets: text i has words offsets[i] to offsets[i + 1]."""
        hashes, at = self.with_prefixes(texts, ())
        return hashes[0], at

    def with_prefixes(self, texts: list[bytes], prefixes: tuple[tuple[int, bool], ...]) -> tuple[list[np.ndarray], np.ndarray]:
        """As a call; besides the words' hashes those of their prefixes of so many bytes, with the word's length or not."""
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        n = len(joined)
        if len(self.powers) < n + 1:
            self.powers, self.inverse = _powers(n + 1)
        inside = self.is_word[joined]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.bytes[joined] * self.powers[:n], out=sums[1:])
        found = [mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))]
        for size, with_length in prefixes:
            stop = np.minimum(starts + size, ends)
            extra = (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) if with_length else np.uint64(0)
            found.append(mix((sums[stop] - sums[starts]) * self.inverse[starts] + np.uint64(size << 8) + extra))
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        return found, np.searchsorted(starts, at)


def not_in(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Marks of all bytes outside these inclusive ranges."""
    marks = np.ones(256, bool)
    for a, b in ranges:
        marks[a : b + 1] = False
    return marks


#: Bytes of words ``[^\x20\x09-\x0D]+``, and of words that punctuation ends as well.
SPACED = not_in([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = not_in([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)]) | np.isin(np.arange(256), np.arange(65, 91))
