"""Byte-level BPE and token counts against the libraries."""

import hashlib
import random

import brute
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from conftest import SF_DIR

from dqtable.llm import byte_bpe
from dqtable.llm.common import read_table
from dqtable.llm.token_counts import token_counts


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text or "")


def texts():
    rng = random.Random(1)

    def some(n, alphabet):
        return "".join(rng.choices(alphabet, k=n))

    return [
        None, "", "hi  there's 'll  ", "<|endoftext|>", some(70_000, "ab  \n'rs1.é"),
        some(40_000, "   \n") + "x" * 5 + some(60_000, " ab'"), "a" * 40_000 + " " + some(50_000, "ab "),
        " " * 33_000 + "b" + "c d" * 30_000, some(1 << 15, "ab c"), some((1 << 15) + 1, "ab c"),
        some(33_800, "é世界 '"), some(98_304, "ab c 12"), "'re" * 30_000,
        some(32_760, "ab ") + "  'refer it's" * 3000,
    ]


def test_ids_and_bytes(spark, library):
    rows = list(enumerate(texts()))
    rows += [(3, rows[4][1]), (4, rows[4][1]), (None, rows[11][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as uid", "2 as ids")
    found = byte_bpe.encoded(df, ids=True)
    got = brute.Counter(tuple(r)[:4] for r in found.collect())
    assert got == brute.Counter((doc, *expected(library, text)) for doc, text in rows)
    back = brute.Counter((r.doc_id, r.text) for r in byte_bpe.decoded(found).collect())
    assert back == brute.Counter((doc, text or "") for doc, text in rows)
    assert byte_bpe.encoded(df.where("false")).isEmpty()


def test_blank_runs_beyond_the_matcher():
    codec = byte_bpe.Codec(byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS)), public_tokenizers.PATTERN)
    text = "a" + " " * 1_500_000 + "b"
    assert codec.decode(codec.encode(text)) == text.encode()
    short = "x  y" + " " * 30_000 + "b" + "c" * 10_000
    assert codec.encode(short) == codec.encoding.encode_ordinary(short)


def test_counts_come_from_the_cache(spark, scratch):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    values = [None, "", "a  b\n c <s> </s> é世 ", "x" * 20_000, " " * 3000 + "b", "a  b\n c <s> </s> é世 "]
    rows = [*enumerate(values), (2, values[2]), (None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as content", "2 as n_tokens")
    want = brute.Counter()
    for doc, text in rows:
        count = len(library.encode(text or ""))
        want[doc, len((text or "").encode()), count, count > 4096] += 1
    cache = f"{scratch}/cache"
    for _ in range(2):
        got = brute.Counter(tuple(r) for r in token_counts(df, cache).collect())
        assert got == want
        stored = spark.read.parquet(cache)
        assert stored.count() == len({t or "" for _, t in rows})
    # what is stored is used, and other texts are added to it
    more = df.unionByName(spark.createDataFrame([(9, "new words")], "doc_id long, text string"), True)
    token_counts(more, cache).collect()
    digest = hashlib.sha256(b"new words").digest()
    added = spark.read.parquet(cache).collect()
    assert len(added) == 1 + len({t or "" for _, t in rows}) and digest in {bytes(r.content) for r in added}
    assert token_counts(df.where("false"), cache).isEmpty()


def test_documents(spark, library):
    docs = read_table(spark, SF_DIR, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:4] for r in byte_bpe.encoded(docs).collect()}
    assert got == {d: expected(library, t) for d, t in text.items()}


def test_stitching_goes_on_behind_long_runs(spark, library, monkeypatch):
    """Chunks of a few words, with runs that span none, one or several of them."""
    monkeypatch.setattr(byte_bpe, "CHUNK", 64)
    monkeypatch.setattr(byte_bpe, "OVERLAP", 16)
    rng = random.Random(8)
    runs = ["a" * 20, "b" * 70, "c" * 300, " " * 40, " " * 200, "\n" * 90, "12" * 60, "'s" * 50, "é" * 130, "... " * 30]
    rows = []
    for i in range(80):
        parts = rng.choices(["ab ", "it's ", "word ", "  x", "1234 ", "\n"], k=rng.randint(20, 200))
        for _ in range(rng.randint(0, 4)):
            parts.insert(rng.randrange(len(parts)), rng.choice(runs))
        rows.append((i, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = brute.Counter(tuple(r)[:4] for r in byte_bpe.encoded(df).collect())
    assert got == brute.Counter((doc, *expected(library, text)) for doc, text in rows)


def test_one_long_run_leaves_the_rest_in_pieces(spark, scratch):
    text = "some words " * 12_000 + "x" * 3000 + " and more words" * 12_000
    df = spark.createDataFrame([(7, text)], "uid long, text string")
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    sent = spark.sparkContext.broadcast(ranks)
    pieces = byte_bpe._pieces(byte_bpe._chunks(df), sent, public_tokenizers.PATTERN)
    whole = byte_bpe._verified(pieces.cache(), sent, public_tokenizers.PATTERN, f"{scratch}/v")
    assert "".join(r.text for r in whole.orderBy("piece").collect()) == text
    assert whole.count() > 7
