"""Byte-level BPE and token files against the public libraries."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from loomgraph.llm import bpe, token_store
from loomgraph.llm.common import new_path

RANKS, TOKENIZER = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = " \n\t  abcThe123.,'s'reé　 ß日本\U0001f926‍♂\r\x85\xa0 "


def odd_texts(n, size=14, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def public():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_encoding_equals_the_public_library(public):
    own = bpe.codec(RANKS, P.PATTERN)
    texts = [*odd_texts(20000), "ab" * 40000, " ".join(["thandhe"] * 500), "<|endoftext|>"]
    for _ in range(2):  # the second time from the memo
        ids, counts = own.encode_many([t.encode() for t in texts])
        wanted = [public.encode_ordinary(t) for t in texts]
        assert counts.tolist() == [len(x) for x in wanted]
        assert np.array_equal(ids, np.array([i for x in wanted for i in x]))
    assert own.decode(ids) == "".join(texts).encode()


def test_one_tree_equals_many(public):
    own = bpe.codec(RANKS, P.PATTERN)
    for piece in (b"abracadabra", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ünïcödé".encode(), b"zq"):
        one = bpe.segment_tree_bpe(piece, own.ranks)
        size = max(4, 1 << (len(piece) - 1).bit_length())
        assert np.frombuffer(own.many_trees([piece], size)[0], "<u4").tolist() == one == public.encode_ordinary(piece.decode())


def test_documents(spark):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (1, "Hello  world"), (None, "x")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")
    out = {(r.doc_id, r.n_tokens, bytes(r.decoded)) for r in bpe.encode_documents(docs, RANKS, P.PATTERN).collect()}
    assert out == {(1, 3, b"Hello  world"), (2, 0, b""), (3, 0, b""), (None, 1, b"x")}
    back = bpe.decode_documents(bpe.encode_documents(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert sorted(r.text for r in back.collect()) == ["", "", "Hello  world", "Hello  world", "x"]
    assert bpe.encode_digests(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_units_of_the_tokenizers_library():
    own = token_store.Encoder(TOKENIZER)
    texts = [*odd_texts(20000, seed=5), "<|endoftext|> a", "x" * 5000]
    for _ in range(2):
        ids, counts = own(texts)
        wanted = own.whole(texts)
        assert counts.tolist() == [len(x) for x in wanted] and ids.tolist() == [i for x in wanted for i in x]


@pytest.mark.parametrize("largest", [1, 255, 256, 65535, 65536, 1 << 31])
def test_random_access(largest):
    ids = np.random.default_rng(1).integers(0, largest, 3000, endpoint=True).astype(np.uint32)
    segment = token_store.Segment(token_store.pack(ids))
    assert np.array_equal(segment.all(), ids) and np.array_equal(segment.at(np.arange(3000)[::-1]), ids[::-1])


def test_files(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts(400, 60))] + [(7, None), (7, None), (None, "null id"), (900, "word " * 3000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    path = new_path(spark, "tokens")
    token_store.write_tokens(docs, path, TOKENIZER, 2, segment_tokens=700)
    found = sorted(token_store.read_documents(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    encoder = token_store.Encoder(TOKENIZER)
    assert [r.doc_id for r in found] == [None, *range(8), 7, 7, *range(8, 400), 900]
    flat, by = [], {i: t for i, t in rows if i != 7}
    for r in found:
        assert r.start == len(flat) and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if r.doc_id != 7:
            assert r.ids == encoder.whole([by[r.doc_id]])[0] + [2]
        flat += r.ids
    places = spark.createDataFrame([(i,) for i in range(0, len(flat) + 50, 13)], "place long")
    looked = {r.place: r.id for r in token_store.look_up(spark, path, places).collect()}
    assert looked == {i: flat[i] for i in range(0, len(flat), 13)}
    empty = new_path(spark, "tokens")
    token_store.write_tokens(docs.limit(0), empty, TOKENIZER, 2)
    assert token_store.read_documents(spark, empty).count() == 0
