"""Byte-level BPE and token counts against the libraries themselves."""

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from brute import DOCS, docs_frame, empty_docs, sha256, table
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import bpe
from tillroll.llm.token_counts import CACHE_SCHEMA, Counter, read_cache, token_counts

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def exact():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_round_trip_equals_tiktoken(spark, codec, exact):
    for df in (table(spark, "documents"), docs_frame(spark)):
        want = sorted((str(r.doc_id), len(i), sha256(np.array(i, "<u4").tobytes()), sha256((r.text or "").encode()))
                      for r in df.select("doc_id", "text").collect() for i in [exact.encode_ordinary(r.text or "")])
        got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(df, codec).collect())
        assert got == want
    assert bpe.round_trip_digests(empty_docs(spark), codec).count() == 0
    split = {r.doc_id: r.n_split_chars for r in bpe.round_trip(docs_frame(spark, [(1, "plain words"), (2, "naïve 😀😀 中文!"), (3, None)]), codec).collect()}
    assert split[1] == split[3] == 0 < split[2]
    both = bpe.decode_bpe(bpe.encode_bpe(docs_frame(spark), codec), codec).collect()
    assert sorted(str(r.decoded) for r in both) == sorted(str((t or "").encode()) for _, t in DOCS)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(codec, exact, text):
    ids = codec.encode([text])[0]
    assert ids.tolist() == exact.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_runs_of_one_character(codec, exact):
    texts = [c * n for c in [*map(chr, range(1, 300)), "  \n", "-=", "aA", "😀"] for n in (1, 2, 3, 5, 8, 13, 33, 64)]
    assert [i.tolist() for i in codec.encode(texts)] == [exact.encode_ordinary(t) for t in texts]


def test_offsets_and_split_characters(spark, codec):
    rows = bpe.encode_bpe(docs_frame(spark, [(1, "naïve 😀😀 中文!")]), codec).collect()
    r, text = rows[0], "naïve 😀😀 中文!"
    assert len(r.ids) == len(r.char_start) == len(r.char_end) and r.char_start[0] == 0 and r.char_end[-1] == len(text)
    pieces = [codec.decode(np.array([i])) for i in r.ids]
    assert any(not _whole(p) for p in pieces)              # a character is split over tokens
    assert all(a < b for a, b in zip(r.char_start, r.char_end))
    for p, a, b in zip(pieces, r.char_start, r.char_end):
        assert p in text[a:b].encode()


def _whole(piece):
    try:
        return bool(piece.decode())
    except UnicodeDecodeError:
        return False


def test_counts_and_cache(spark, scratch):
    tokenizer, cache = Counter(P.path("piece_bpe_32k.model")), f"{scratch}/cache"
    plain = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    df = docs_frame(spark)
    want = sorted((str(i), len((t or "").encode()), n, n > 4096) for i, t in DOCS for n in [len(plain.encode(t or ""))])
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, tokenizer, cache).collect()) == want
    first = read_cache(spark, cache)
    assert first.count() == len({t or "" for _, t in DOCS})
    # all known: nothing is appended; another tokenizer's counts are its own
    assert token_counts(df, tokenizer, cache).count() == len(DOCS) and read_cache(spark, cache).count() == first.count()
    other = Counter(P.path("word_bpe_49k.json"))
    token_counts(df, other, cache).count()
    assert {r["count"] for r in read_cache(spark, cache).groupBy("tokenizer").count().collect()} == {len({t or "" for _, t in DOCS})}
    assert token_counts(empty_docs(spark), tokenizer).count() == 0
    assert read_cache(spark, f"{scratch}/none").schema == spark.createDataFrame([], CACHE_SCHEMA).schema


def test_a_hot_text_is_counted_for_every_row(spark):
    rows = [(i, "the same text again") for i in range(700)] + [(i, f"text {i}") for i in range(700, 900)]
    got = token_counts(docs_frame(spark, rows), Counter(P.path("piece_bpe_32k.model"))).collect()
    assert sorted(r.doc_id for r in got) == list(range(900)) and len({r.n_tokens for r in got if r.doc_id < 700}) == 1


def test_hits_and_misses_meet_in_one_call(spark, scratch):
    tokenizer, cache = Counter(P.path("piece_bpe_32k.model")), f"{scratch}/cache"
    plain = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    old = [(i, f"text number {i % 40}") for i in range(120)]
    token_counts(docs_frame(spark, old), tokenizer, cache).count()
    assert read_cache(spark, cache).count() == 40
    rows = old + [(200 + i, f"newer text {i % 7}") for i in range(30)] + [(300, None)]
    got = {r.doc_id: r.n_tokens for r in token_counts(docs_frame(spark, rows), tokenizer, cache).collect()}
    assert got == {i: len(plain.encode(t or "")) for i, t in rows} and read_cache(spark, cache).count() == 48
