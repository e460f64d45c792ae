"""Exact similarity join of shingle sets by parity sketches.

Every shingle of a set flips one bit of its sketch. The sketches of two sets differ in at most as many bits as the sets
differ in shingles, so a Hamming distance above the allowed difference rules a pair out. Sets that reach similarity t
have sizes within a factor t, and differ in at most (1 - t) / (1 + t) of the sum of their sizes. Sets are put into size
bands; d is the largest difference that a band's larger set allows. A set's sketch for a band has more than d pieces of
``BITS`` bits, so two linked sets agree in at least one of the pieces of the larger set's band (pigeonhole). A set takes
part in its own band, and in those of the larger sets that it can link with. A piece's odd bits are XORed into a key.
Pieces without any bit would bring unrelated sets together: ``SPARE`` more pieces than needed let a set leave them out,
unless it has more of them than that. Pieces are wide, so what agrees has the same shingles, not a bit by chance.

1. ``signatures``: 128 bits of each text's set. Texts with the same set are one node from here on.
2. ``piece_keys`` and ``candidates``: sets that share a key (band, piece number, piece) are candidates. Each key pairs
   its smallest node, the key's centre, with the others, so rows stay linear in the size of a group of near copies.
3. Each node's candidates with most keys in common are compared: exactly, if their folded sketches are near enough.
   The links that are found make components.
4. What is left: nodes of one centre that aren't in one component yet. Their folded sketches are compared in blocks of
   bounded size against blocks of the same centre, which gives the nodes that are near any other; the sets of these are
   compared exactly, block by block again. What leaves a task are nodes, and links that join components: a row a node at
   most and never one for each pair.

No pair that could link escapes: it shares a key, so both have that key's centre (or are it), so they are compared
there unless they are in one component already. Texts without words have no shingles and no links. Null texts are empty
texts; repeated rows of one doc_id are linked with each other as equal texts are. Hashes of shingles have 64 bits, as is
usual. A node is named by the first half of its signature; sets that share it and not the second half get other names.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import SPACED, WordHasher, broadcast_if_small, discard, free_names, materialize, mix, rows_per_batch, text_slices
from loomgraph.llm.graph import components

#: Pieces beyond those needed, as a share of them.
SPARE = 0.1
#: Bits of a piece.
BITS = 1 << 16
#: Sets in a block of step 4, and shingles of them together; a set of more is a block of its own.
BLOCK, WEIGHT = 512, 1 << 19
#: Candidates of a node that step 3 compares, those with most keys in common first; step 4 compares the rest.
LIKELY = 2


@dataclass(frozen=True)
class Measure:
    """Words in a shingle, and the least similarity of a link as percent."""

    words: int = 5
    percent: int = 80

    def apart(self, total: int) -> int:
        """Most shingles that linked sets whose sizes add up to total can differ in."""
        return total * (100 - self.percent) // (100 + self.percent)

    def band_starts(self) -> np.ndarray:
        """Smallest sizes of the bands: each band reaches up to its first size divided by the similarity."""
        out = [1]
        while out[-1] < 1 << 40:
            out.append(max(out[-1] + 1, int(Fraction(out[-1] * 100, self.percent)) + 1))
        return np.array(out, np.int64)


@cache
def _hasher() -> WordHasher:
    return WordHasher(SPACED)


@cache
def _bands(measure: Measure) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band starts; for each band the pieces (0: its sets link with equal ones only), and how many may go without a bit."""
    starts = measure.band_starts()
    apart = np.array([measure.apart(2 * (int(after) - 1)) for after in starts[1:]], np.int64)
    spare = np.ceil(SPARE * (apart + 1)).astype(np.int64)
    return starts, np.where(apart > 0, apart + 1 + spare, 0), spare


def _shingles(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    hashes, at = _hasher()(texts)
    if len(hashes):
        rolled = np.zeros(len(hashes), np.uint64)
        for k in range(words):  # shingle i covers words i to i + words - 1, kept within its text below
            rolled[: len(hashes) - k] = mix(rolled[: len(hashes) - k] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:  # the whole short sequence is one shingle
            h = np.uint64(b - a)
            for w in hashes[a:b]:
                h = mix(np.array([h * np.uint64(0xD6E8FEB86659FD93) + w]))[0]
            yield np.array([h])
        else:
            yield np.zeros(0, np.uint64)


def _piece_keys(sets: list[np.ndarray], measure: Measure) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of the pieces of sets, and the index of each key's set: band after band."""
    starts, counts, spares = _bands(measure)
    size = np.array([len(x) for x in sets], np.int64)
    low, high = (np.searchsorted(starts, x, "right") - 1 for x in (size, size * 100 // measure.percent))
    flat, text_of = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    value = mix((flat & np.uint64(BITS - 1)) + np.uint64(0x5851F42D4C957F2D))
    for step in range(int((high - low).max(initial=-1)) + 1):
        band = np.where(size > 0, low + step, 0)
        count = np.where((size > 0) & (band <= high), counts[band], 0)
        name = mix(band.astype(np.uint64) + np.uint64(1 << 40))
        of, own, bits = text_of, flat, value
        if not count.all():
            use = count[text_of] > 0
            of, own, bits = text_of[use], flat[use], value[use]
        if not len(own):
            continue
        # hashes are sorted, so a piece's shingles stand together
        place = ((own >> np.uint64(32)) * count[of].astype(np.uint64)) >> np.uint64(32)
        new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (of[1:] != of[:-1]))))
        odd = np.bitwise_xor.reduceat(bits, new)
        new, odd = new[odd != 0], odd[odd != 0]
        of, place = of[new], place[new]
        yield mix(odd + mix(place + name[of])), of
        bare = count - np.bincount(of, minlength=len(sets))
        for i in np.flatnonzero(bare > spares[band]):
            empty = np.setdiff1d(np.arange(count[i], dtype=np.uint64), place[of == i])
            yield mix(mix(empty + name[i])), np.full(len(empty), i)


def folded(own: np.ndarray, band: int) -> bytes:
    """A sketch of about two bits a shingle, of one length for a band and its neighbours."""
    size = 1 << max(7, int(band).bit_length() + 1)
    odd = (np.bincount((mix(own + np.uint64(0xA5A5)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def fold_to(sketch: np.ndarray, words: int) -> np.ndarray:
    """Fold rows of 64-bit words to fewer: parities of parities, whose distance is still a lower bound."""
    while sketch.shape[1] > words:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def signature(own: np.ndarray) -> tuple[int, int]:
    """127 bits of a set, as two signed integers; the first is even."""
    first = np.bitwise_xor.reduce(mix(own ^ np.uint64(0x51ED270B)), initial=0) + np.uint64(len(own))
    second = np.add.reduce(mix(own ^ np.uint64(0xC2B2AE35)), initial=np.uint64(0))
    return int((np.uint64(first) & ~np.uint64(1)).view(np.int64)), int(np.uint64(second).view(np.int64))


def signatures(docs: DataFrame, measure: Measure) -> DataFrame:
    """doc_id, text_hash, n (shingles), node and check (the set's signature), band and sketch (folded) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = _bands(measure)[0]
        with np.errstate(over="ignore"):
            for batch in batches:
                for first, texts in text_slices(batch.column(2)):
                    rows, sketch = [], []
                    for own in _shingles(texts, measure.words):
                        band = int(np.searchsorted(starts, len(own), "right")) - 1
                        rows.append((len(own), *signature(own), band))
                        sketch.append(folded(own, int(starts[band])) if band >= 0 else b"")
                    columns = np.array(rows, np.int64).reshape(-1, 4).T
                    own = [batch.column(k).slice(first, len(texts)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*own, *map(pa.array, columns), pa.array(sketch, pa.binary())], ["doc_id", "text_hash", "n", "node", "check", "band", "sketch"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return source.mapInArrow(run, "doc_id long, text_hash long, n long, node long, check long, band long, sketch binary")


def piece_keys(docs: DataFrame, measure: Measure) -> DataFrame:
    """(key, node) for the pieces of each set's sketches; a set that a task meets again gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        with np.errstate(over="ignore"):
            for batch in batches:
                for _, texts in text_slices(batch.column(0)):
                    sets, nodes = [], []
                    for own in _shingles(texts, measure.words):
                        node = signature(own)[0]
                        if len(own) and node not in met:
                            met.add(node)
                            sets.append(own)
                            nodes.append(node)
                    if sets:
                        names = np.array(nodes, np.int64)
                        for key, of in _piece_keys(sets, measure):
                            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(names[of])], ["key", "node"])

    return docs.where("doc_id is not null").select("text").mapInArrow(run, "key long, node long")


def candidates(keyed: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, and n, the keys they meet in: the smallest node of each key with every other node of the key.

    Keys are dealt and sorted by Spark; a task then sees each key's nodes in order and holds only the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node = (batch.column(k).to_numpy() for k in (0, 1))
            new = np.flatnonzero(np.concatenate(([last_key is None or key[0] != last_key], key[1:] != key[:-1])))
            first = np.empty(len(key), np.int64)
            if not len(new) or new[0]:
                first[: new[0] if len(new) else len(key)] = last_first
            if len(new):
                first[new[0] :] = np.repeat(node[new], np.diff(np.append(new, len(key))))
            last_key, last_first = key[-1], first[-1]
            own = first != node
            yield pa.RecordBatch.from_arrays([pa.array(first[own]), pa.array(node[own])], ["a", "b"])

    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("n"))


def node_sets(docs: DataFrame, wanted: DataFrame, measure: Measure) -> DataFrame:
    """id and hashes (sorted) of the wanted sets: id, and the doc_id and text_hash of a text that stands for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for first, texts in text_slices(batch.column(1)):
                    sets = list(_shingles(texts, measure.words))
                    hashes = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32), np.concatenate(sets).view(np.int64))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), hashes], ["id", "hashes"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    own = own.join(broadcast_if_small(wanted.select("id", "doc_id", "text_hash")), ["doc_id", "text_hash"])
    if docs.groupBy("doc_id").count().where("count > 1").head(1):  # rows that repeat a doc_id: one of each text is enough
        own = own.dropDuplicates(["id"])
    return own.select("id", "text").mapInArrow(run, "id long, hashes array<long>")


def _sketches(values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of binary sketches by their length: (indices of the rows, their words)."""
    size = pc.binary_length(values).to_numpy(zero_copy_only=False)
    out = []
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        out.append((at, np.frombuffer(b"".join(values.take(pa.array(at)).to_pylist()), "<u8").reshape(len(at), -1)))
    return out


def near_enough(pairs: DataFrame, nodes: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (a, b) of names whose sets' sizes and folded sketches allow a link, as ids."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("id").alias(f"id_{x}"), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(k).to_numpy() for k in (2, 3))
            most = (n_a + n_b) * (100 - measure.percent) // (100 + measure.percent)
            keep = np.zeros(batch.num_rows, bool)
            right = _sketches(batch.column(5))
            for at, x in _sketches(batch.column(4)):
                for bt, y in right:
                    both, i, j = np.intersect1d(at, bt, assume_unique=True, return_indices=True)
                    words = min(x.shape[1], y.shape[1])
                    keep[both] = np.bitwise_count(fold_to(x[i], words) ^ fold_to(y[j], words)).sum(1, dtype=np.int64) <= most[both]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    limit = F.greatest("n_a", "n_b") * measure.percent <= F.least("n_a", "n_b") * 100
    return sized.where(limit).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (a, b) of ids whose sets reach the similarity, compared exactly. pairs is read more than once."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = materialize(nodes.join(ends, "id").select("id", "doc_id", "text_hash"), "wanted")
    sets = materialize(node_sets(docs, wanted, measure), "sets")
    side = lambda x, y: sets.select(F.col("id").alias(x), F.col("hashes").alias(y))
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    total = F.size("x").cast("long") + F.size("y").cast("long")
    out = materialize(both.where(common * (100 + measure.percent) >= total * measure.percent).select("a", "b"), "links")
    discard(wanted, sets)
    return out


def _blocks(members: DataFrame) -> DataFrame:
    """Pairs (x, y) of blocks of members (group, id, linked, n, band, sketch): all of a small group, and of a large one
    blocks of one band with each other and with those of the next. y is null where x meets itself alone.

    Large groups are few, as each has many members, and so are their bands: members meet them without being dealt by
    group. The pairs of a group's band are dealt by their first block."""
    size = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / WEIGHT)).alias("parts")
    wide = materialize(members.groupBy("group").agg(size).where("parts > 1").select("group", F.lit(True).alias("large")), "large")
    sized = members.join(broadcast_if_small(wide), "group", "left")
    record = F.collect_list(F.struct("id", "linked", "n", "sketch")).alias("x")
    small = sized.where("large is null").groupBy("group").agg(record).select("x", F.lit(None).cast("array<struct<id: bigint, linked: bigint, n: bigint, sketch: binary>>").alias("y"))
    large = sized.where("large").drop("large")
    bands = materialize(large.groupBy("group", "band").agg(size), "bands")
    cut = large.join(broadcast_if_small(bands), ["group", "band"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    blocks = materialize(cut.repartition("group", "band", "part").groupBy("group", "band", "part").agg(record), "blocks")
    left = blocks.select("group", F.col("band").alias("at"), F.col("part").alias("p"), "x")
    right = blocks.select("group", "band", F.col("part").alias("q"), F.col("x").alias("y"), F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("at"))
    right = right.join(broadcast_if_small(bands.withColumnRenamed("band", "at")), ["group", "at"]).withColumn("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    met = left.join(right.where("band > at or p <= q"), ["group", "at", "p"]).select("x", "y")
    return small.unionByName(met)


def _suspects(blocks: DataFrame, measure: Measure) -> DataFrame:
    """pair, id and linked: the members of each pair of blocks whose sketches are near that of one in another component."""

    def fields(rows: pa.Array) -> tuple[np.ndarray, ...]:
        flat = rows.flatten()
        return tuple(flat.field(c).to_numpy() for c in ("id", "linked", "n")) + (flat.field("sketch"),)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ax, lx, nx, kx = fields(batch.column(0).slice(i, 1))
                ay, ly, ny, ky = (ax, lx, nx, kx) if batch.column(1)[i].as_py() is None else fields(batch.column(1).slice(i, 1))
                near_x, near_y = np.zeros(len(ax), bool), np.zeros(len(ay), bool)
                right = _sketches(ky)
                for at, sx in _sketches(kx):
                    for bt, sy in right:
                        words = min(sx.shape[1], sy.shape[1])
                        p, q = fold_to(sx, words), fold_to(sy, words)
                        step = max(1, (1 << 20) // (len(bt) * words))
                        for j in range(0, len(at), step):
                            rows = at[j : j + step]
                            a, b = nx[rows, None], ny[bt][None]
                            ok = (np.maximum(a, b) * measure.percent <= np.minimum(a, b) * 100) & (lx[rows, None] != ly[bt][None])
                            if ok.any():
                                far = np.bitwise_count(p[j : j + step, None] ^ q[None]).sum(2, dtype=np.int64)
                                ok &= far <= (a + b) * (100 - measure.percent) // (100 + measure.percent)
                                near_x[rows] |= ok.any(1)
                                near_y[bt] |= ok.any(0)
                ids, at = np.unique(np.concatenate((ax[near_x], ay[near_y])), return_index=True)
                if len(ids):
                    label = np.concatenate((lx[near_x], ly[near_y]))[at]
                    pair = int.from_bytes(hashlib.blake2b(ax.tobytes() + b"|" + ay.tobytes(), digest_size=8).digest(), "little", signed=True)  # names the two blocks
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), pair)), pa.array(ids), pa.array(label)], ["pair", "id", "linked"])

    return blocks.mapInArrow(run, "pair long, id long, linked long")


def _joining_links(suspects: DataFrame, docs: DataFrame, info: DataFrame, measure: Measure) -> DataFrame:
    """Links (a, b) among the suspects of each pair of blocks, compared exactly: those that join what isn't joined yet."""
    wanted = materialize(info.join(suspects.select("id").distinct(), "id").select("id", "doc_id", "text_hash"), "wanted")
    sets = materialize(node_sets(docs, wanted, measure), "sets")
    rows = suspects.distinct().join(sets, "id").groupBy("pair").agg(F.collect_list(F.struct("id", "linked", "hashes")).alias("s")).select("s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column(0).slice(i, 1).flatten()
                ids, label, lists = own.field("id").to_numpy(), own.field("linked").to_numpy(), own.field("hashes")
                size = pc.list_value_length(lists).to_numpy().astype(np.int64)
                at = np.concatenate(([0], np.cumsum(size)))
                _, flat = np.unique(lists.flatten().to_numpy(), return_inverse=True)
                flat = flat.ravel()
                held = np.zeros(int(flat.max(initial=0)) + 1, np.int32)
                _, group = np.unique(label, return_inverse=True)  # components so far, merged as links turn up
                group = group.ravel()
                found = []
                for k in range(len(ids) - 1):
                    held[flat[at[k] : at[k + 1]]] = 1
                    common = np.add.reduceat(held[flat[at[k + 1] :]], at[k + 1 : -1] - at[k + 1])
                    held[flat[at[k] : at[k + 1]]] = 0
                    near = np.flatnonzero(common * (100 + measure.percent) >= (size[k] + size[k + 1 :]) * measure.percent) + k + 1
                    for j in near[group[near] != group[k]].tolist():
                        if group[j] != group[k]:
                            found.append((ids[k], ids[j]))
                            group[group == group[j]] = group[k]
                if found:
                    a, b = np.array(found, np.int64).T
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    with rows_per_batch(docs.sparkSession, 8):  # a row holds the sets of two blocks at most
        out = materialize(rows.mapInArrow(run, "a long, b long"), "more")
    discard(wanted, sets)
    return out


def _placed(docs: DataFrame, measure: Measure) -> DataFrame:
    """doc_id, text_hash, n and first of every row of docs: the smallest (doc_id, text_hash) that links reach, or null."""
    each = materialize(signatures(docs, measure), "signatures")
    nodes = each.where("n > 0 and doc_id is not null").groupBy("node", "check").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    # sets that share the first half of their signature, which is even, are named by odd numbers from the second on
    turn = F.row_number().over(Window.partitionBy("node").orderBy("check"))
    nodes = materialize(nodes.withColumn("id", F.when(turn == 1, F.col("node")).otherwise(F.xxhash64("node", "check").bitwiseOR(F.lit(1)))), "nodes")

    star = materialize(candidates(piece_keys(docs, measure)), "candidates")
    ends = star.select(F.col("a").alias("node")).union(star.select(F.col("b").alias("node"))).distinct()
    stand = nodes.join(ends, "node").select("node", "check", "id", "first.doc_id", "first.text_hash")
    info = each.join(stand, ["node", "check", "doc_id", "text_hash"]).dropDuplicates(["id"])
    info = materialize(info.select("node", "id", "doc_id", "text_hash", "n", "band", "sketch"), "info")
    # links that are likeliest: what is left is compared below, whatever these find
    likely = star.withColumn("rank", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("n"), "a"))).where(F.col("rank") <= LIKELY).select("a", "b")
    near = materialize(near_enough(likely, info, measure), "near")
    links = linked(near, docs, info, measure)
    done = materialize(components(links), "components")
    discard(near, links)

    placed = info.join(done.withColumnRenamed("node", "id"), "id", "left").select("node", "id", F.coalesce("component", "id").alias("linked"))
    placed = materialize(placed, "placed")
    side = lambda x: placed.select(F.col("node").alias(x), F.col("id").alias(f"id_{x}"), F.col("linked").alias(f"linked_{x}"))
    met = materialize(star.join(side("b"), "b").join(side("a"), "a").select("a", "id_a", "linked_a", "id_b", "linked_b"), "met")
    open_centres = materialize(met.where("linked_a <> linked_b").select("a").distinct(), "open")
    left = met.join(broadcast_if_small(open_centres), "a", "left_semi")
    members = left.select(F.col("a").alias("group"), F.col("id_b").alias("id"), F.col("linked_b").alias("linked")).union(left.select("a", "id_a", "linked_a").distinct())
    members = materialize(members.join(info.select("id", "n", "band", "sketch"), "id"), "members")
    with rows_per_batch(docs.sparkSession, 16):  # a row is a pair of blocks
        suspects = materialize(_suspects(_blocks(members), measure), "suspects")
    discard(star, placed, met, open_centres, members)
    more = _joining_links(suspects, docs, info, measure)
    joined = components(done.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    named = nodes.join(joined.withColumnRenamed("node", "id"), "id", "left").select("node", "check", "first", F.coalesce("component", "id").alias("component"))
    named = materialize(named, "components")
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    ids = materialize(named.join(least, "component").select("node", "check", F.col("least").alias("first")), "named")
    discard(nodes, info, done, suspects, more, named)
    own = each.select("doc_id", "text_hash", "n", "node", "check")
    return own.join(ids, ["node", "check"], "left").select("doc_id", "text_hash", "n", F.when(F.col("n") > 0, F.col("first")).alias("first"))


def similar_components(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row of docs."""
    return _placed(docs, measure).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("first.doc_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """The rows of docs that stand for their component: its smallest doc_id, one row of it. All columns are kept.

    Rows that repeat a doc_id with another text are documents of their own: a row goes for what its own text is linked
    with. Texts without words are linked with nothing, so each row of them stays, and so do rows whose doc_id is null.
    """
    found = _placed(docs.select("doc_id", "text"), measure).where("first is not null and doc_id is not null")
    id_, hash_ = free_names(docs, "id_", "hash_")
    gone = found.where("first.doc_id <> doc_id or first.text_hash <> text_hash").select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    away = materialize(gone, "away")
    left = docs.join(broadcast_if_small(away), (docs["doc_id"] == F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(hash_)), "left_anti").select(*docs.columns)
    if not docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").head(1):
        return left
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]") | F.col("doc_id").isNull()
    one = left.where(~blank).withColumn(hash_, F.xxhash64("text")).dropDuplicates(["doc_id", hash_])
    return left.where(blank).unionByName(one.select(*docs.columns))


def components_sql(measure: Measure) -> str:
    """similar_components for DuckDB: all pairs that share a shingle are counted."""
    upper, lower, k = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123))), measure.words
    joined = " || ' ' || ".join(f"ws[i + {j}]" for j in range(k))
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {k} THEN list_transform(range(1, len(ws) - {k - 2}), lambda i: {joined}) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE []::VARCHAR[] END) AS sh FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * c >= {measure.percent} * (p.n + q.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce((SELECT min(root) FROM r WHERE node = d.doc_id), d.doc_id) AS component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id"""
