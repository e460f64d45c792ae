"""Token ids as directly addressable codes, written as Parquet segments.

A segment holds the ids of successive documents, about SEGMENT_TOKENS of them. Its ids are split into chunks of 8 bits:
level 0 has the lowest chunk of every id, and a bitmap that marks the ids with more chunks; level 1 has the next chunk
of those alone, and so on. The place of an id in the next level is the number of marks before it, which the rank
directory gives: one running count for every RANK_BITS bits, and a popcount within. So any id is read with one look at
each level and nothing else is decoded (``Segment.at``).

Files: ``segments`` (one row a segment: part, seg, first token within the part, n_tokens, doc_ids and doc_tokens as
packed integers, levels) and ``parts`` (tokens before each part). Parts are ranges of doc_id, so documents stand in
ascending doc_id order throughout; rows of one doc_id stand in the order of their texts' hashes and lengths.

A null or empty text is one end id. Null doc_ids come first. Repeated rows are kept. An empty table gives empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.llm.units import STARTS, UnitMemo

SEGMENT_TOKENS = 1 << 16
RANK_BITS = 512
LEVELS = "array<struct<chunks: binary, more: binary, ranks: binary>>"
SEGMENTS = f"part int, seg int, first long, n_tokens int, doc_ids binary, nulls int, doc_tokens binary, levels {LEVELS}"


def pack(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of a run of ids."""
    ids, out = ids.astype(np.uint32), []
    while True:
        rest = ids >> np.uint32(8)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK_BITS // 8)))
        counts = np.bitwise_count(bits.reshape(-1, RANK_BITS // 8)).sum(1)
        ranks = np.concatenate(([0], np.cumsum(counts)[:-1])).astype("<u4") if len(counts) else np.zeros(0, "<u4")
        out.append({"chunks": ids.astype(np.uint8).tobytes(), "more": bits.tobytes(), "ranks": ranks.tobytes()})
        if not more.any():
            return out
        ids = rest[more]


class Segment:
    """Random access to the ids of one segment."""

    def __init__(self, levels: list[dict[str, bytes]]):
        self.levels = [(np.frombuffer(x["chunks"], np.uint8), np.frombuffer(x["more"], np.uint8), np.frombuffer(x["ranks"], "<u4")) for x in levels]

    def at(self, places: np.ndarray) -> np.ndarray:
        """Ids at these places, without decoding any other."""
        out = np.zeros(len(places), np.uint32)
        own, at = np.arange(len(places)), np.asarray(places, np.int64)
        for level, (chunks, more, ranks) in enumerate(self.levels):
            out[own] |= chunks[at].astype(np.uint32) << np.uint32(8 * level)
            on = (more[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            own, at = own[on], at[on]
            if not len(own):
                break
            block = at // RANK_BITS
            within = more.reshape(-1, RANK_BITS // 8)[block]
            place = at % RANK_BITS
            keep = np.clip(place[:, None] - 8 * np.arange(RANK_BITS // 8), 0, 8)
            masked = within & ((1 << keep) - 1).astype(np.uint8)
            at = ranks[block].astype(np.int64) + np.bitwise_count(masked).sum(1, dtype=np.int64)
        return out

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        out, own = None, None
        for level, (chunks, more, _) in enumerate(self.levels):
            if own is None:
                out, own = chunks.astype(np.uint32), np.arange(len(chunks))
            else:
                out[own] |= chunks.astype(np.uint32) << np.uint32(8 * level)
            own = own[np.unpackbits(more, bitorder="little")[: len(chunks)].astype(bool)]
        return np.zeros(0, np.uint32) if out is None else out


class Encoder:
    """A tokenizers file, for byte-level tokenizers behind a memo of units between spaces; others encode whole texts."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        kind = json.loads(self.tokenizer.to_str())
        split = kind.get("pre_tokenizer") or {}
        self.by_unit = kind.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        if self.by_unit:  # a byte-level vocabulary writes each byte as one character
            vocab = self.tokenizer.get_vocab(with_added_tokens=False)
            self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
            self.lengths[list(vocab.values())] = [len(token) for token in vocab]
            self.memo = UnitMemo(self.units)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, and how many each has. Units that may follow any other are encoded in long texts, which are
        cut where the bytes of the ids reach a unit's end."""
        joins = [u[:1] == b" " and len(u) > 1 and bool(STARTS[u[1]]) for u in units]
        parts: list[tuple[int, np.ndarray]] = [(i, np.array(ids, np.uint32)) for i, ids in zip([i for i, x in enumerate(joins) if not x], self.whole([u.decode() for u, x in zip(units, joins, strict=True) if not x]), strict=True)]
        counts = np.zeros(len(units), np.int64)
        for i, ids in parts:
            counts[i] = len(ids)
        plain = np.flatnonzero(joins)
        found = []
        lists = [plain[i : i + 4096] for i in range(0, len(plain), 4096)]
        for own, ids in zip(lists, self.whole([b"".join([units[i] for i in own]).decode() for own in lists]), strict=True):
            ends = np.cumsum([len(units[i]) for i in own])
            found.append(np.array(ids, np.uint32))
            counts[own] = np.diff(np.searchsorted(np.cumsum(self.lengths[found[-1]]), ends) + 1, prepend=0)
        out = np.zeros(counts.sum(), np.uint32)
        first = np.cumsum(counts) - counts
        for i, ids in parts:
            out[first[i] : first[i] + len(ids)] = ids
        if found:
            size = counts[plain]
            out[np.repeat(first[plain] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.concatenate(found)
        return out, counts

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and how many each has."""
        if self.by_unit:
            return self.memo([t.encode() for t in texts])
        ids = self.whole(texts)
        return np.array([x for own in ids for x in own], np.uint32), np.array([len(x) for x in ids], np.int64)


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
    return Encoder(path)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, *, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode the whole texts of (doc_id, text) and write them in ascending doc_id order below path.

    Documents are dealt by ranges of doc_id before they are encoded, so that only texts are shuffled, once.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), F.length("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        first = seg = nulls = held = 0
        doc_ids: list[int] = []
        ids: list[np.ndarray] = []
        kind = pa.list_(pa.struct([(n, pa.binary()) for n in ("chunks", "more", "ranks")]))

        def row() -> pa.RecordBatch:
            counts = np.array([len(x) for x in ids], "<i8")
            tokens = np.concatenate(ids)
            values = [part, seg, first, len(tokens), np.array(doc_ids, "<i8").tobytes(), nulls, counts.tobytes(), pack(tokens)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), kind]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["part", "seg", "first", "n_tokens", "doc_ids", "nulls", "doc_tokens", "levels"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                tokens, counts = own(some.column(1).to_pylist())
                stops = np.cumsum(counts).tolist()
                for doc_id, a, b in zip(some.column(0).to_pylist(), [0, *stops], stops, strict=False):
                    nulls += doc_id is None  # these come first in a segment
                    doc_ids.append(doc_id or 0)
                    ids.append(np.concatenate((tokens[a:b], end)))
                    held += len(ids[-1])
                    if held >= segment_tokens:
                        yield row()
                        first, seg, nulls, held, doc_ids, ids = first + held, seg + 1, 0, 0, [], []
        if ids:
            yield row()

    dealt.mapInArrow(run, SEGMENTS).write.parquet(f"{path}/segments")
    totals = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part, not for each segment
    totals.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("before")).write.parquet(f"{path}/parts")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments, with the place of their first token among all (start)."""
    segments, parts = (spark.read.parquet(f"{path}/{x}") for x in ("segments", "parts"))
    return segments.join(parts, "part").withColumn("start", F.col("before") + F.col("first")).drop("before", "first")


def read_documents(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files; its ids as well on request."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tokens = Segment(r["levels"]).all().astype("<u4")
                counts = np.frombuffer(r["doc_tokens"], "<i8")
                ends = np.cumsum(counts)
                doc_ids = np.frombuffer(r["doc_ids"], "<i8")
                raw = memoryview(tokens.tobytes())
                arrays = [
                    pa.array(doc_ids, mask=np.arange(len(doc_ids)) < r["nulls"]),
                    pa.array(r["start"] + ends - counts),
                    pa.array(counts),
                    pa.array([zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)], pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.array([tokens[e - c : e].astype(np.int32) for e, c in zip(ends, counts, strict=True)], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return read_segments(spark, path).select("start", "nulls", "doc_ids", "doc_tokens", "levels").mapInArrow(run, schema)


def look_up(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """(place, id) for each token place asked for; places outside the files are left out.

    Places and segments meet on blocks of SEGMENT_TOKENS places; each segment answers for its own places alone.
    """
    segments = read_segments(spark, path)
    blocks = F.sequence(F.floor(F.col("start") / SEGMENT_TOKENS), F.floor((F.col("start") + F.col("n_tokens") - 1) / SEGMENT_TOKENS))
    span = segments.select("part", "seg", "start", (F.col("start") + F.col("n_tokens")).alias("stop"), F.explode(blocks).alias("block"))
    asked = places.select(F.col("place").cast("long").alias("place")).distinct().withColumn("block", F.floor(F.col("place") / SEGMENT_TOKENS))
    own = asked.join(span, "block").where("place >= start and place < stop").select("part", "seg", (F.col("place") - F.col("start")).cast("long").alias("at"))
    wanted = own.groupBy("part", "seg").agg(F.collect_list("at").alias("at"))  # one segment's places at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.array(r["at"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at + r["start"]), pa.array(Segment(r["levels"]).at(at).astype(np.int64))], ["place", "id"])

    return segments.join(wanted, ["part", "seg"]).select("start", "levels", "at").mapInArrow(run, "place long, id long")
