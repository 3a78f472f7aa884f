import random

import numpy as np
import public_tokenizers
import pytest

from shardstream.llm.pieces import Chunk, Pieces, boundary_states, combined, decode_ids, encode_texts
from tests.llm.data import documents, no_documents, odd_documents

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    with open(FILE, "rb") as file:
        return Pieces(file.read())


def chunks_of(pieces, text, size):
    text, n = " " + text, pieces.longest
    return [Chunk(pieces, text[max(0, a - n) : a], text[a : a + size], text[a + size : a + size + n]) for a in range(0, len(text), size)]


def scanned(pieces, text, size):
    chunks = chunks_of(pieces, text, size)
    at = boundary_states([c.transfer() for c in chunks])
    return np.frombuffer(b"".join(c.encode(at[k], at[k + 1]) for k, c in enumerate(chunks)), "<i4").tolist()


def random_texts(n):
    rng = random.Random(9)
    alphabets = ["aeiourstnl", "ab", "the inghtion", "a \n", "0123456789", "日本語aé\t ", "  \n x", "a", "<s>\U0001f600"]
    return ["".join(rng.choice(rng.choice(alphabets)) if k % 4 == 0 else rng.choice(alphabets[k % 9]) for _ in range(rng.randint(1, 250))) for k in range(n)]


def test_the_scan_equals_the_library(pieces):
    for k, text in enumerate(random_texts(800)):
        assert scanned(pieces, text, (40, 64, 99)[k % 3]) == pieces.model.encode(text), text


def test_words_and_decoding_equal_the_library(pieces):
    rng = random.Random(1)
    for text in random_texts(800):
        ids = pieces.model.encode(text)
        assert np.frombuffer(pieces.encode(" " + text), "<i4").tolist() == ids
        assert pieces.decode(np.array(ids)) == text == pieces.model.decode(ids)
        some = [rng.randrange(259, 32000) for _ in range(20)]
        assert pieces.decode(np.array(some)) == pieces.model.decode(some)


def test_products_are_associative(pieces):
    for text in random_texts(40):
        m = [c.transfer() for c in chunks_of(pieces, text * 3, 40)]
        for a, b, c in zip(m, m[1:], m[2:], strict=False):
            assert combined(combined(a, b), c) == combined(a, combined(b, c))


def test_documents_of_many_chunks(spark, pieces, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: pieces.model.encode(r.text) for r in docs.collect()}
    rows = encode_texts(docs, FILE, chunk=700).collect()
    assert {r.doc_id: r.ids for r in rows} == want and len(rows) == len(want)
    assert max(r.n_chunks for r in rows) > 10
    decoded = decode_ids(encode_texts(docs, FILE, chunk=5000), FILE)
    assert {r.doc_id: r.decoded for r in decoded.collect()} == {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("chunk", [1000, 1 << 15])
def test_odd_rows(spark, pieces, chunk):
    docs = odd_documents(spark).unionByName(odd_documents(spark))  # giant texts repeat too
    rows = encode_texts(docs, FILE, chunk=chunk).collect()
    want = [(r.doc_id, pieces.model.encode(r.text or "")) for r in docs.collect()]
    assert sorted(((r.doc_id, r.ids) for r in rows), key=repr) == sorted(want, key=repr)
    assert encode_texts(no_documents(spark), FILE).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [r.decoded for r in decode_ids(none, FILE).collect()] == ["", ""]


def test_one_word_of_many_chunks(spark, pieces):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij") for _ in range(5000))
    assert encode_texts(documents(spark, [text]), FILE, chunk=500).first().ids == pieces.model.encode(text)
