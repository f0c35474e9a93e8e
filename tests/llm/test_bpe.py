import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from etalage.llm import bpe, queries
from tests.conftest import SF

RANKS = bpe.read_ranks(queries.RANKS)
TIKTOKEN = tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def whole():
    return bpe.PerfectHash(RANKS)


def test_perfect_hash_is_minimal_and_knows_its_keys(whole):
    assert len(whole.keys) == len(RANKS) and None not in whole.keys
    assert all(whole.get(k) == v for k, v in RANKS.items())
    assert whole.get(b"no such token here") is None


@pytest.mark.parametrize("table", [{}, {b"a": 0}, {b"a": 3, b"b": 1, b"ab": 2}])
def test_perfect_hash_of_small_tables(table):
    small = bpe.PerfectHash(table)
    assert all(small.get(k) == v for k, v in table.items()) and small.get(b"zz") is None


def numbers(ids):
    return np.frombuffer(ids, np.int32).tolist()


def ours(whole, text):
    import regex

    tokens = bpe.Tokens(whole, RANKS)
    return [i for t in regex.findall(queries.PATTERN, text) for i in numbers(tokens[t])]


def test_like_tiktoken_on_random_texts(whole):
    draw = random.Random(5)
    alphabet = "aeinorst 'ABC12\n\t.,üé—中x\u00a0\u2003\x1c\x85"
    for _ in range(1500):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 80)))
        assert ours(whole, text) == TIKTOKEN.encode_ordinary(text), text


def test_like_tiktoken_on_one_very_long_token(whole):
    text = "ab" * 40_000 + "\n" + " " * 5_000 + "<|endoftext|>"
    assert ours(whole, text) == TIKTOKEN.encode_ordinary(text)


def test_tokens_memory_is_bounded(whole):
    tokens = bpe.Tokens(whole, RANKS, most=10)
    for i in range(100):
        assert numbers(tokens[f"q{i}"]) == TIKTOKEN.encode_ordinary(f"q{i}")
        assert len(tokens) <= 10


def test_query_is_the_library_s_result(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op6_byte_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = TIKTOKEN.encode_ordinary(d.text or "")
        joined = " ".join(map(str, ids)).encode()
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(joined).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_nulls_empties_repeats_and_clashing_names(spark):
    rows = [(1, "word", "x"), (1, "word", "x"), (None, None, "y"), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, queries.RANKS, queries.PATTERN)
    assert encoded.columns == ["doc_id", "ids"]
    back = bpe.decode(encoded, queries.RANKS).collect()
    assert sorted((r.doc_id or 0, r.decoded.decode()) for r in back) == [(0, ""), (1, "word"), (1, "word"), (2, "")]
    empty = bpe.encode(docs.where("false"), queries.RANKS, queries.PATTERN)
    assert bpe.decode(empty, queries.RANKS).count() == 0


def test_decode_refuses_ids_outside_the_vocabulary(spark):
    rows = spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="bounds|vocabulary"):
        bpe.decode(rows, queries.RANKS).collect()
    nothing = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert bytes(bpe.decode(nothing, queries.RANKS).first().decoded) == b""


def test_vocabulary_is_a_parameter():
    multi = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    other = bpe.PerfectHash(multi)
    library = tiktoken.Encoding("multi", pat_str=queries.PATTERN, mergeable_ranks=multi, special_tokens={})
    tokens = bpe.Tokens(other, multi)
    assert numbers(tokens[" größer"]) == library.encode_ordinary(" größer")
