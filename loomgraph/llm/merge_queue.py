"""BPE of the tokenizers library's files, by a priority queue of merge ranks over a doubly linked symbol list.

A piece of text starts as one symbol for each byte, each linked to its neighbours. The queue holds (rank, place) of every
neighbouring pair that a merge joins; the smallest comes first, and of equal ranks the leftmost. A merge unlinks the right
symbol and queues the pairs that the new symbol forms on either side. Entries that later merges made stale stay in the
queue and are skipped when they come up: ``due`` has the rank that the pair at a place has now. So n bytes take
O(n log n), however long they are.

The file says all the rest: its vocabulary, its list of merges (no other pair is joined, even if it spells a token), and
its added tokens, which are found in the text first, the leftmost and the longest of them, unless ``plain_specials`` makes
their strings ordinary text. Truncation, padding and the post-processor aren't used. Files with a normalizer, another
pre-tokenizer than the byte-level one, dropout, byte fallback, affixes, or added tokens that strip or look at words are
refused with a ValueError, as their ids would differ.

Decoding concatenates vocabulary strings: each character of a token stands for a byte, a token with other characters for
its own UTF-8 bytes, and what isn't UTF-8 in the end becomes U+FFFD. Ids outside the vocabulary are left out, as the
library does. A null text counts as empty and gives no ids and an empty text; repeated rows give repeated results; other
columns are left alone. Texts are cut at spaces into units (``loomgraph.llm.units``), so that a memo of bounded size saves
most of the queues.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomgraph.llm.bpe import Codec
from loomgraph.llm.common import text_slices
from loomgraph.llm.units import UnitMemo

#: The split pattern that the library's byte-level pre-tokenizer uses (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones of Latin-1 for themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


def queue_bpe(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Join symbols by merges, (left, right) to (rank, joined), until no neighbours can be joined."""
    n = len(symbols)
    node, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    due, queue = [-1] * n, []
    get = merges.get
    for i in range(n - 1):
        if (found := get((node[i], node[i + 1]))) is not None:
            due[i] = found[0]
            queue.append(found[0] * n + i)
    heapq.heapify(queue)
    while queue:
        rank, i = divmod(heapq.heappop(queue), n)
        if due[i] != rank:
            continue  # stale: the pair at i is another by now, or none
        j = after[i]
        k = after[j]
        node[i] = get((node[i], node[j]))[1]
        due[j] = -1
        after[i] = k
        due[i] = -1
        if k < n:
            before[k] = i
            if (found := get((node[i], node[k]))) is not None:
                due[i] = found[0]
                heapq.heappush(queue, found[0] * n + i)
        if (h := before[i]) >= 0:
            due[h] = -1
            if (found := get((node[h], node[i]))) is not None:
                due[h] = found[0]
                heapq.heappush(queue, found[0] * n + h)
    out, i = [], 0
    while i < n:
        out.append(node[i])
        i = after[i]
    return out


class QueueCodec(Codec):
    """Encodes and decodes texts by one file of the tokenizers library; holds a memo of bounded size."""

    def __init__(self, path: str, *, plain_specials: bool = False):
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        _refuse_others(kind)
        model = kind["model"]
        vocab: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {}
        for rank, (a, b) in enumerate(merges):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        characters = byte_characters()
        self.single = [vocab.get(c, -1) for c in characters]
        self.added = {t["content"]: t["id"] for t in kind.get("added_tokens") or ()}
        self.find_added = regex.compile("|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True))) if self.added and not plain_specials else None
        self.pattern = regex.compile(PATTERN)
        self.memo = UnitMemo(self.units)
        byte_of = {c: b for b, c in enumerate(characters)}
        tokens = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in (vocab | self.added).items():
            tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces as little-endian 32-bit integers. Bytes that the vocabulary lacks give no id."""
        single, merges = self.single, self.merges
        return [np.array(queue_bpe([x for b in piece if (x := single[b]) >= 0], merges), "<u4").tobytes() for piece in pieces]

    def encode_many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and how many each has. Added tokens split a text into parts of their own."""
        if self.find_added is None:
            return self.memo(texts)
        parts: list[bytes] = []
        marks: list[tuple[int, int, int]] = []  # text, parts of it before the token, id
        first = []
        for i, text in enumerate(texts):
            first.append(len(parts))
            if not any(x.encode() in text for x in self.added):
                parts.append(text)
                continue
            own, at = text.decode(), 0
            for m in self.find_added.finditer(own):
                parts.append(own[at : m.start()].encode())
                marks.append((i, len(parts), self.added[m[0]]))
                at = m.end()
            parts.append(own[at:].encode())
        ids, counts = self.memo(parts)
        ends = np.cumsum(counts)
        if marks:
            ids = np.insert(ids.astype(np.uint32), ends[[k - 1 for _, k, _ in marks]], [x for _, _, x in marks])
        per_text = np.diff(np.concatenate(([0], ends))[[*first, len(parts)]])
        np.add.at(per_text, [i for i, _, _ in marks], 1)
        return ids, per_text

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text.encode()])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a run of ids, in UTF-8."""
        ids = np.asarray(ids, np.int64)
        raw = super().decode(ids[(ids >= 0) & (ids < len(self.lengths))])
        return raw.decode("utf-8", "replace").encode()


def _refuse_others(kind: dict) -> None:
    model, split = kind["model"], kind.get("pre_tokenizer") or {}
    odd = {
        "model": model.get("type", "BPE") != "BPE",
        "dropout, affixes or byte fallback": any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges", "unk_token")),
        "normalizer": kind.get("normalizer") is not None,
        "pre-tokenizer": split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True),
        "decoder": (kind.get("decoder") or {}).get("type") != "ByteLevel",
        "added tokens": any(t.get(k) for t in kind.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip")),
    }
    if found := [k for k, v in odd.items() if v]:
        raise ValueError(f"not a byte-level BPE file of the known kind: {', '.join(found)}")


@cache
def codec(path: str, plain_specials: bool) -> QueueCodec:
    """One codec for each Python worker, kept from task to task."""
    return QueueCodec(path, plain_specials=plain_specials)


#: Texts of so many bytes together are encoded at once, but for a single longer text.
SLICE = 1 << 19


def encode_documents(docs: DataFrame, path: str, *, keep: tuple[str, ...] = ("doc_id",), plain_specials: bool = False) -> DataFrame:
    """Columns ``keep``, ids (array of int), n_tokens, ids_sha256, decoded (string) and decoded_sha256 of each text."""
    return _encoded(docs, path, keep, plain_specials, ("ids", "decoded"))


def encode_digests(docs: DataFrame, path: str, *, keep: tuple[str, ...] = ("doc_id",), plain_specials: bool = False) -> DataFrame:
    """As encode_documents, but without the ids and the decoded texts themselves."""
    return _encoded(docs, path, keep, plain_specials, ())


def decode_documents(encoded: DataFrame, path: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and text of each row of ids (null: empty)."""
    source = encoded.select(*keep, "ids")
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, False)
        for batch in batches:
            texts = [own.decode(np.array([x for x in ids or () if x is not None], np.int64)).decode() for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"])

    return source.mapInArrow(run, schema)


def _encoded(docs: DataFrame, path: str, keep: tuple[str, ...], plain_specials: bool, extra: tuple[str, ...]) -> DataFrame:
    source = docs.select(*keep, "text")
    kinds = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | {x: {"ids": "array<int>", "decoded": "string"}[x] for x in extra}
    schema = ", ".join([*(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep), *(f"{k} {v}" for k, v in kinds.items())])
    arrow = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, plain_specials)
        for batch in batches:
            for first, texts in text_slices(batch.column(len(keep)), SLICE):
                found: dict[str, list] = {k: [] for k in kinds}
                tokens, sizes = own.encode_many(texts)
                stops = np.cumsum(sizes).tolist()
                for a, b in zip([0, *stops], stops, strict=False):
                    packed = tokens[a:b].astype("<u4")
                    back = own.decode(packed)
                    row = {"n_tokens": b - a, "ids_sha256": hashlib.sha256(packed.tobytes()).hexdigest(), "decoded_sha256": hashlib.sha256(back).hexdigest()}
                    row |= ({"ids": packed.astype(np.int32)} if "ids" in extra else {}) | ({"decoded": back.decode()} if "decoded" in extra else {})
                    for k in kinds:
                        found[k].append(row[k])
                own_columns = batch.slice(first, len(texts)).columns[: len(keep)]
                yield pa.RecordBatch.from_arrays([*own_columns, *(pa.array(found[k], arrow.get(k, pa.string())) for k in kinds)], [*keep, *kinds])

    return source.mapInArrow(run, schema)
