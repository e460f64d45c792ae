"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece of text starts as its single bytes. Leaf i of the tree holds the rank of the pair that the live node at byte i
forms with the next live node; an inner node holds the smallest rank below it, and ties go left. Each merge reads the
root, joins the leftmost pair of smallest rank and sets three leaves again, which costs a path to the root each. So a
piece of n bytes takes O(n log n), a megabyte without any space included.

Texts are cut at spaces into units (``loomgraph.llm.units``), so that a memo of bounded size saves most of the work. A null text counts as empty and gives no ids; repeated rows give repeated results;
unpaired surrogates cannot occur in Spark strings; other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomgraph.llm.units import STARTS, UnitMemo

NONE = 1 << 60
NO_RANK = np.int32(2**31 - 1)
#: Longest piece in bytes that is encoded together with others, and pieces together.
LARGEST, TREES = 64, 1 << 14


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def segment_tree_bpe(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the leftmost pair of the smallest rank until no pair has one."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    size = 1 << max(1, (n - 1).bit_length())
    tree = [NONE] * (2 * size)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    for i in range(n - 1):
        tree[size + i] = get(piece[i : i + 2], NONE)
    for i in range(size - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left <= right else right

    def put(i: int, rank: int) -> None:
        i += size
        tree[i] = rank
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            least = left if left <= right else right
            if tree[i] == least:
                break
            tree[i] = least
            i >>= 1

    while (least := tree[1]) < NONE:
        i = 1
        while i < size:
            i *= 2
            if tree[i] != least:
                i += 1
        i -= size
        j = after[i]
        k = after[j] if j < n else n
        after[i] = k
        put(j, NONE)
        if k < n:
            before[k] = i
            put(i, get(piece[i : after[k]], NONE))
        else:
            put(i, NONE)
        if (h := before[i]) >= 0:
            put(h, get(piece[h:k], NONE))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Encodes and decodes texts by one rank file; holds a memo of bounded size."""

    def __init__(self, ranks_path: str, pattern: str):
        self.ranks = load_ranks(ranks_path)
        self.pattern = regex.compile(pattern)
        self.memo = UnitMemo(self.units)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        get, pairs = self.ranks.get, {}
        for token, rank in self.ranks.items():  # every way to make a token of two
            for cut in range(1, len(token)):
                if (x := get(token[:cut])) is not None and (y := get(token[cut:])) is not None:
                    pairs[x << 32 | y] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[x] for x in self.pairs.tolist()], np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of live nodes; NO_RANK where they make no token or either is absent (below 0)."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pairs[at] == keys), self.joined[at], NO_RANK)

    def many_trees(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Ids of pieces of at most size bytes (a power of two): one tree for each, all of them one merge at a time."""
        n, rows = len(pieces), np.arange(len(pieces))
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        count = np.array([len(p) for p in pieces])
        place = np.arange(size)
        node = np.full((n, size + 1), -1, np.int64)  # the last column stands for what follows the end
        node[:, :size] = np.where(place < count[:, None], self.single[raw], -1)
        after = np.tile(np.minimum(np.arange(1, size + 2), size).astype(np.int16), (n, 1))
        before = np.tile(np.arange(-1, size, dtype=np.int16), (n, 1))
        after[rows, count - 1] = size
        tree = np.full((n, 2 * size), NO_RANK, np.int32)
        tree[:, size : 2 * size - 1] = self.pair_ranks(node[:, : size - 1].ravel(), node[:, 1:size].ravel()).reshape(n, size - 1)
        level = size
        while level > 1:
            level //= 2
            np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2], out=tree[:, level : 2 * level])
        while len(rows := rows[tree[rows, 1] < NO_RANK]):
            least = tree[rows, 1]
            i = np.ones(len(rows), np.int64)
            while i[0] < size:
                i *= 2
                i += tree[rows, i] != least
            i -= size
            j = after[rows, i].astype(np.int64)
            k = after[rows, j].astype(np.int64)
            h = before[rows, i].astype(np.int64)
            node[rows, i], node[rows, j] = least, -1
            after[rows, i], before[rows, k] = k, i
            left = np.where(h >= 0, node[rows, h], -1)
            new = self.pair_ranks(np.concatenate((node[rows, i], left)), np.concatenate((node[rows, k], node[rows, i])))
            leaf = np.concatenate((j, i, np.maximum(h, 0))) + size
            rank = np.concatenate((np.full(len(rows), NO_RANK, np.int32), new))
            own = np.concatenate((np.ones(2 * len(rows), bool), h >= 0))
            leaf, rank, row = leaf[own], rank[own], np.tile(rows, 3)[own]
            tree[row, leaf] = rank
            while leaf[0] > 1:
                leaf >>= 1
                tree[row, leaf] = np.minimum(tree[row, 2 * leaf], tree[row, 2 * leaf + 1])
        live = node[:, :size] >= 0
        ids = node[:, :size][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(1)) * 4
        return [ids[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        sized: dict[int, list[int]] = {}
        for at, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[at] = whole.to_bytes(4, "little")
            elif len(piece) > LARGEST:
                out[at] = np.array(segment_tree_bpe(piece, self.ranks), "<u4").tobytes()
            else:
                sized.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(at)
        for size, places in sized.items():
            for at in range(0, len(places), TREES):
                some = places[at : at + TREES]
                for x, ids in zip(some, self.many_trees([pieces[x] for x in some], size), strict=True):
                    out[x] = ids
        return out

    def units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, and how many each has. Units that may follow any other are split by the pattern together."""
        alone = [i for i, u in enumerate(units) if not (u[:1] == b" " and len(u) > 1 and STARTS[u[1]])]
        aside = set(alone)
        order = alone + [i for i in range(len(units)) if i not in aside]
        pieces = [p.encode() for i in alone for p in self.pattern.findall(units[i].decode())]
        pieces += [p.encode() for p in self.pattern.findall(b"".join([units[i] for i in order[len(alone) :]]).decode())]
        packed = self.pieces(pieces)
        ends = np.cumsum([len(units[i]) for i in order])
        stop = np.searchsorted(np.cumsum([len(p) for p in pieces]), ends) + 1
        after = np.concatenate(([0], np.cumsum([len(x) // 4 for x in packed])))[stop]
        counts = np.zeros(len(units), np.int64)
        counts[order] = np.diff(after, prepend=0)
        ids = np.frombuffer(b"".join(packed), "<u4")
        if not alone:
            return ids, counts
        first = (np.cumsum(counts) - counts)[order]
        size = counts[order]
        out = np.empty(len(ids), np.uint32)
        out[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
        return out, counts

    def encode_many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and how many each has."""
        return self.memo(texts)

    def encode(self, text: str) -> np.ndarray:
        return self.memo([text.encode()])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a run of ids."""
        if not len(ids):
            return b""
        if int(ids.max()) >= len(self.lengths):
            raise ValueError("an id is outside the vocabulary")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        source = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.bytes[source].tobytes()


@cache
def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec for each Python worker, kept from task to task."""
    return Codec(ranks_path, pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ids (array of int), n_tokens, ids_sha256, decoded (binary) and decoded_sha256 of each text."""
    return _encoded(docs, ranks_path, pattern, keep, ("ids", "decoded"))


def encode_ids(docs: DataFrame, ranks_path: str, pattern: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As encode_documents, but without the decoded bytes themselves."""
    return _encoded(docs, ranks_path, pattern, keep, ("ids",))


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As encode_documents, but without the ids and the decoded bytes themselves."""
    return _encoded(docs, ranks_path, pattern, keep, ())


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and text of each row of ids; bytes that aren't UTF-8 become U+FFFD."""
    source = encoded.select(*keep, "ids")
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            texts = [own.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"])

    return source.mapInArrow(run, schema)


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...], extra: tuple[str, ...]) -> DataFrame:
    source = docs.select(*keep, "text")
    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(", ids array<int>" if c == "ids" else ", decoded binary" for c in extra)
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep) + ", " + more
    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 512):
                part = batch.slice(at, 512)
                counts, first, second, ids, decoded = [], [], [], [], []
                tokens, sizes = own.encode_many([(t or "").encode() for t in part.column(len(keep)).to_pylist()])
                stops = np.cumsum(sizes).tolist()
                for a, b in zip([0, *stops], stops, strict=False):
                    packed = tokens[a:b].astype("<u4")
                    back = own.decode(packed)
                    counts.append(len(packed))
                    first.append(hashlib.sha256(packed.tobytes()).hexdigest())
                    second.append(hashlib.sha256(back).hexdigest())
                    if "ids" in extra:
                        ids.append(packed.astype(np.int32))
                    if "decoded" in extra:
                        decoded.append(back)
                arrays = [pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
                arrays += [pa.array(ids, pa.list_(pa.int32())) if c == "ids" else pa.array(decoded, pa.binary()) for c in extra]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *arrays], names)

    return source.mapInArrow(run, schema)
