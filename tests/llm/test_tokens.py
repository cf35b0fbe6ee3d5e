import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cartlake.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_as_the_library(docs, rows, library):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digest(docs).collect()}
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        expected = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        assert got[doc_id] == expected


def test_words_one_by_one(library):
    rng, ranks = random.Random(1), bpe.ranks(PATH)
    for n in [1, 2, 5, 30, 70, 200, 3000]:
        for letters in (b"abcdethin ", b"ab", bytes(range(256))):
            word = bytes(rng.choice(letters) for _ in range(n))
            expected = library._encode_single_piece(word)
            assert bpe.merge(word, ranks) == expected
            if word not in ranks:
                assert bpe.merge_long(word, ranks) == expected


def test_odd_rows_and_no_rows(odd, empty):
    assert sorted(r["n_tokens"] for r in bpe.digest(odd).collect())[:2] == [0, 0]
    assert bpe.digest(odd).count() == 5
    assert bpe.digest(empty).collect() == []


def test_decode_joins_the_table(spark, library):
    text = "The ouvre, décor 🙂  twice.\n"
    rows = [(1, i, t) for i, t in enumerate(library.encode_ordinary(text))] + [(1, 999, None), (2, 0, 10**9)]
    got = {r["key"]: bytes(r["bytes"]) for r in bpe.decode(spark.createDataFrame(rows, "key int, position int, id long")).collect()}
    assert got == {1: text.encode()}


def test_bytes_that_are_no_text_come_back(spark):
    raw = [b"\xff", b"a\xc3", b"so \xf0\x9f\x99 it \xed\xa0\x80 is\n", "é".encode() * 3 + b"\x80"]
    rows = spark.createDataFrame(list(enumerate(raw)), "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) AS text")
    got = {r["doc_id"]: r for r in bpe.digest(rows).collect()}
    for i, value in enumerate(raw):
        assert got[i]["decoded_sha256"] == hashlib.sha256(value).hexdigest() and got[i]["n_tokens"] > 0
