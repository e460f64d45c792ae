"""BPE by a priority queue against the public library and a plain loop."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomgraph.llm import merge_queue

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"


def odd_texts(n=300, seed=3):
    rng = random.Random(seed)
    pool = ["the", "aaaa", "ü", "日本語", "🙂", "\U0010ffff", "\x00", "\x1c", "\x85", " ", "'ll", "'LL", "12", "½", "²", " ", "  ", "\t", "\n", "\r\n", " ", "-", "...", END, "<|endof", "|>", "é", "Übung"]
    return ["", " ", END, END * 2, f"a  {END}  b", f" {END}", "a" * 5000, "ab" * 3000 + " " * 700, *["".join(rng.choices(pool, k=rng.randrange(40))) for _ in range(n)]]


@pytest.mark.parametrize("plain", [False, True])
def test_ids_and_decoding_equal_the_library(plain):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = plain
    own = merge_queue.QueueCodec(PATH, plain_specials=plain)
    texts = odd_texts()
    for _ in range(2):  # the second time from the memo
        ids, counts = own.encode_many([t.encode() for t in texts])
        for t, a, b in zip(texts, np.cumsum(counts) - counts, np.cumsum(counts), strict=True):
            wanted = library.encode(t, add_special_tokens=False).ids
            assert ids[a:b].tolist() == wanted, repr(t)
            assert own.decode(ids[a:b]).decode() == library.decode(wanted, skip_special_tokens=False) == t
    rng = np.random.default_rng(1)
    for _ in range(200):  # runs of ids that no text gives: broken UTF-8
        some = rng.integers(0, 50257, rng.integers(0, 12)).tolist()
        assert own.decode(np.array(some)).decode() == library.decode(some, skip_special_tokens=False)


def plain_bpe(symbols, merges):
    symbols = list(symbols)
    while True:
        found = [(merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in merges]
        if not found:
            return symbols
        _, i = min(found)
        symbols[i : i + 2] = [merges[symbols[i], symbols[i + 1]][1]]


def test_queue_equals_a_plain_loop():
    """Random merge tables over few symbols: ties, overlaps and stale entries everywhere."""
    rng = random.Random(8)
    for _ in range(400):
        merges, spelled, rank = {}, {0: "a", 1: "b", 2: "c"}, 0
        for _ in range(rng.randrange(12)):
            pair = tuple(rng.choices(list(spelled), k=2))
            if pair not in merges:
                word = spelled[pair[0]] + spelled[pair[1]]
                to = next((i for i, w in spelled.items() if w == word), len(spelled))
                spelled[to] = word
                merges[pair] = (rank, to)
                rank += 1
        symbols = rng.choices(range(3), k=rng.randrange(30))
        assert merge_queue.queue_bpe(symbols, merges) == plain_bpe(symbols, merges)


def test_whole_tables(spark):
    texts = [None, *odd_texts(40), "same", "same", "long " * 60_000]
    rows = [(None if i == 3 else i % 30, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    library = Tokenizer.from_file(PATH)
    wanted = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    found = [tuple(r) for r in merge_queue.encode_digests(docs, PATH).collect()]
    assert sorted(found, key=key) == sorted(wanted, key=key)
    full = merge_queue.encode_documents(docs, PATH)
    assert sorted(r.decoded for r in full.collect()) == sorted(t or "" for t in texts)
    back = merge_queue.decode_documents(full.select("doc_id", "ids"), PATH)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for t in texts)
    assert merge_queue.encode_digests(docs.limit(0), PATH).count() == 0


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="normalizer"):
        merge_queue.QueueCodec(public_tokenizers.path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as f:
        kind = json.load(f)
    kind["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(kind), encoding="utf-8")
    with pytest.raises(ValueError, match="pre-tokenizer"):
        merge_queue.QueueCodec(str(tmp_path / "other.json"))
