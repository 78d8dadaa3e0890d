"""Byte-level BPE against the public encoder, whose ids and text each row must have."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import regex
import tiktoken

from tidewatch.llm import byte_bpe, queries

from .helpers import docs, odd_rows

DIR = "/root/testdata/sf0.001"
RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
#: Letters, marks, numbers and white space of several kinds, what contractions are made of, and letters of later Unicode versions.
SIGNS = "aab'ssttremvelld  \n\t  　é漢字1234½²!?-–́\x1c\x85İſ\U0001f600ࣰ౜\U00011de0\x00"


@pytest.fixture(scope="module")
def public():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(RANKS)


def test_pattern_is_the_public_one():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


def test_pieces_are_the_pattern_s_matches():
    import numpy as np

    rng = random.Random(3)
    signs = [c for c in SIGNS if byte_bpe.classes()[ord(c)] != 3 or not regex.match(r"[\p{L}\p{N}]", c)]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    first = np.cumsum([0] + [len(t) for t in texts])
    at = [*byte_bpe.cuts(points, first[:-1]).tolist(), len(points)]
    whole = "".join(texts)
    assert [whole[a:b] for a, b in zip(at, at[1:])] == [p for t in texts for p in regex.findall(public_tokenizers.PATTERN, t)]


def test_ids_are_the_public_encoder_s(coder, public):
    rng = random.Random(1)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    texts += ["it's we'll  don't 'sing' ' s''s'll 'Re", "'", " ", ",'a'", "a'l", "'l", "x 're", "\n's", "  's  ", "'r'e"]
    for t, (ids, body) in zip(texts, coder.code(texts)):
        assert (ids.tolist(), body) == (public.encode_ordinary(t), t.encode())


@pytest.mark.parametrize("letters", ["x", "ab", "the", "abcdefghijklmnopqrstuvwxyz", "éa漢"])
def test_long_pieces(coder, public, letters):
    """Pieces of thousands of letters, of one kind and mixed, where one round contracts many places."""
    rng = random.Random(7)
    for text in (letters * (2000 // len(letters)), "".join(rng.choice(letters) for _ in range(700)), "".join(rng.choice(letters) for _ in range(130))):
        ((ids, body),) = coder.code([text])
        assert (ids.tolist(), body) == (public.encode_ordinary(text), text.encode())


def test_known_pieces_are_bounded_and_forgotten(public):
    coder = byte_bpe.Coder(RANKS, most_known=50)
    rng = random.Random(9)
    for _ in range(20):
        text = " ".join("".join(rng.choice("abcd") for _ in range(6)) for _ in range(30))
        assert coder.code([text])[0][0].tolist() == public.encode_ordinary(text)
        assert coder.n_known <= 50


def test_equal_hashes_are_found_out(coder, public, monkeypatch):
    """With a hash that takes all pieces of a length for one, what was decoded differs, and the text is coded alone."""
    coder.forget()
    monkeypatch.setattr(byte_bpe, "spans", lambda data, starts, ends: data[starts].astype("uint64") * 256 + (ends - starts).astype("uint64"))
    texts = ["abc", "axc", "ab ab"]
    assert [i.tolist() for i, _ in coder.code(texts)] == [public.encode_ordinary(t) for t in texts]
    coder.forget()


def test_portions_cut_only_where_the_pattern_does(public, coder):
    rng = random.Random(11)
    text = "".join(rng.choice(SIGNS) for _ in range(2000))
    parts = [held for _, held in byte_bpe.portions([text, "short", "", text], 64)]
    assert "".join(t for p in parts for t in p) == text + "short" + text and len(parts) > 20
    assert [i for p in byte_bpe.portions([text], 64) for x, _ in coder.code(p[1]) for i in x] == public.encode_ordinary(text)


def test_rows_of_every_kind(spark, public):
    rows = odd_rows()
    d = docs(spark, rows)
    assert byte_bpe.code_documents(d.where("false"), RANKS).count() == 0
    got = byte_bpe.code_documents(d, RANKS, most=5000).collect()
    assert sorted((str(r["id"]), r["decoded"]) for r in got) == sorted((str(i), t or "") for i, t, *_ in rows)
    for r in got:
        ids = public.encode_ordinary(r["decoded"])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_query(spark, public):
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    out = queries.QUERIES["op13_byte_bpe"](spark, DIR).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(text)
    for r in out:
        ids = public.encode_ordinary(text[r["doc_id"]])
        want = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text[r["doc_id"]].encode()).hexdigest())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_portions_of_every_size(public):
    """Tables of a few rows and of many against each other: no plan that DuckDB then chooses may fail."""
    texts = [r for r in _texts() if r]
    coder, rng = byte_bpe.Coder(RANKS), random.Random(5)
    for _ in range(60):
        some = [t[: rng.choice([1, 5, 50, 10**6])] for t in rng.sample(texts, rng.choice([1, 2, 3, 5, 10, 30]))]
        assert [i.tolist() for i, _ in coder.code(some)] == [public.encode_ordinary(t) for t in some]


def _texts():
    import pyarrow.parquet as pq

    return pq.read_table(f"{DIR}/documents.parquet", columns=["text"])["text"].to_pylist()
