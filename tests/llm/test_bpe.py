import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from mdlake.llm import bpe, queries

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def raw():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(raw):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_match_the_library(raw, library):
    codec, rng = bpe.Codec(raw, P.PATTERN), random.Random(5)
    letters = "abcdefghij  \n\t\r\x0b\x1c\x85\xa0 éñ漢字😀'sdmtvrl0123١½_#!́ß<|endoftext|>"
    for k in range(800):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60))) + "".join(rng.choices("theandir", k=300 if k % 10 == 0 else 0))
        ids = codec.encode([text])[0].tolist()
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 60_000, "xyzzy" * 9_000, "é" * 5_000, " " * 5_000 + "x"])
def test_one_very_long_piece(raw, library, text):
    assert bpe.Codec(raw, P.PATTERN).encode([text])[0].tolist() == library.encode_ordinary(text)


def test_frames_with_nulls_and_clashing_columns(spark):
    rows = [(1, None, "a"), (1, "", "b"), (2, "Hello  world", "c"), (None, "Hello  world", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert sorted(coded.columns) == ["decoded", "doc_id", "ids", "text"]
    got = coded.collect()
    assert [bytes(r.decoded).decode() for r in sorted(got, key=lambda r: (r.text or "", r.doc_id or 9))] == ["", "", "Hello  world", "Hello  world"]
    assert bpe.encode(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_query_matches_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = set()
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        want.add((d.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest()))
    assert {tuple(r) for r in queries.op4(spark, "/root/testdata/sf0.001").collect()} == want
