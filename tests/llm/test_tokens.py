"""Packing (4), token counts (5), token store (6)."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspark.llm import packing, token_counts, token_store
from quillspark.llm.tokens import Encoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ROWS = [(3, "Hello there, world"), (1, ""), (2, None), (None, "no id"), (3, "Hello there, world"), (3, "other text, same id"),
        (9, "long " * 5000), (8, " lead\n\n  two  \n"), (7, "İstanbul <|endoftext|> 😀")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in ROWS], "doc_id long, text string, ids string, start int").repartition(3)


@pytest.fixture(scope="module")
def encoders():
    return [Encoder(BYTE, True), Encoder(WORD, False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", " ", "\n", "\t", "\r", "\x1c", "\x85", "\u2003", "\u3000", "é", "'", "1", ".", "foo",
                                          "\u0301", "ß", "<|endoftext|>"]), max_size=12).map("".join), max_size=8))
def test_encoding_is_the_librarys(encoders, texts):
    for e in encoders:
        ids, off = e.encode(pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [e.tok.encode(t, add_special_tokens=False).ids for t in texts]


def whole(path, end):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return lambda t: np.array([*tok.encode(t or "", add_special_tokens=False).ids, end], "<u4")


def test_packing(odd):
    rows = packing.pack(odd, BYTE, length=64, ids=True).collect()
    enc = whole(BYTE, 0)
    docs = Counter((i, tuple(enc(t))) for i, t in ROWS)
    # pieces in order give each document's ids back
    by_place = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    got, ids = Counter(), []
    for r in by_place:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.length == len(r.ids)
        assert r.start == len(ids)
        ids += r.ids
        if not r.continues:
            assert r.doc_tokens == len(ids)
            got[(r.doc_id, tuple(ids))] += 1
            ids = []
    assert got == docs
    # sequences are full and gapless but for the last
    at = Counter()
    for r in by_place:
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert all(n == 64 for s, n in at.items() if s != max(at)) and sum(at.values()) == sum(len(x) * n for (_, x), n in docs.items())
    assert packing.pack(odd.limit(0), BYTE).count() == 0
    assert [packing.padding(n) for n in (1024, 1, 512, 1000)] == [0, 0, 0, 24]


def greedy(word, pieces, longest):
    n = i = 0
    while i < len(word):
        j = min(len(word), i + longest)
        while j > i + 1 and word[i:j] not in pieces:
            j -= 1
        n, i = n + 1, j
    return n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=5), max_size=25), st.lists(st.sampled_from(b"abcab"), max_size=40), st.binary(max_size=30))
def test_automaton_is_greedy(pieces, few, any_bytes):
    own = [bytes(b"abcde"[x % 5] for x in p) for p in pieces]
    a = token_counts.Automaton(own)
    for word in (bytes(few), any_bytes):
        assert a.count(word) == greedy(word, {*own, *(bytes([i]) for i in range(256))}, 5)


def test_token_counts(odd):
    pieces = set(token_counts.read_ranks(RANKS))
    longest = max(map(len, pieces))
    got = Counter((r.doc_id, r.n_words, r.n_tokens) for r in token_counts.count_tokens(odd, RANKS).collect())
    words = {i: (t or "").encode().split() for i, (_, t) in enumerate(ROWS)}
    assert got == Counter((d, len(words[i]), sum(greedy(b" " + w, pieces, longest) for w in words[i])) for i, (d, _) in enumerate(ROWS))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=0, max_size=700))
def test_elias_fano(steps):
    values = np.cumsum(np.array(steps, np.int64))
    e = token_store.EliasFano.of(values)
    assert e.all().tolist() == values.tolist()
    assert e.select(np.arange(len(values))).tolist() == values.tolist()
    for i in range(0, len(values), 97):
        assert e[i] == values[i]


def test_select_of_wide_numbers():
    for top in (1 << 40, 1 << 58, 1 << 61):
        values = np.array([0, 5, top // 3, top // 2, top])
        e = token_store.EliasFano.of(values)
        assert e.select(np.arange(5)).tolist() == values.tolist()


def test_shards_follow_their_numbers(spark):
    names = [f"x/part-{p:012d}-{k:012d}-{n}.tok" for p, k, n in ((0, 0, 5), (0, 1, 7), (999_999, 0, 11), (1_000_000, 0, 13), (1_000_000, 2, 17),
                                                              (2_000_000_000_000, 0, 19))]
    rows = token_store.shard_starts(spark.createDataFrame([(n,) for n in reversed(names)], "path string")).orderBy("part", "k").collect()
    assert [r.base for r in rows] == [0, 5, 12, 23, 36, 53]


def test_store_is_small():
    rnd = random.Random(2)
    values = np.cumsum([rnd.randint(1, 2000) for _ in range(20_000)])
    e = token_store.EliasFano.of(values)
    bits = 8 * (len(e.low) + len(e.high) + 4 * len(e.samples)) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1.5


@pytest.mark.parametrize("shard", [10**6, 50])
def test_token_store(spark, odd, shard, tmp_path):
    token_store.write(odd, str(tmp_path / "s"), WORD, shard_ids=shard)
    rows = token_store.read(spark, str(tmp_path / "s")).collect()
    enc = whole(WORD, 2)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter(
        (i, len(enc(t)), zlib.crc32(enc(t).tobytes())) for i, t in ROWS)
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert order == sorted(order)
    part = sorted((tmp_path / "s").glob("*.tok"))[0]
    s = token_store.Shard.loads(part.read_bytes())
    assert [len(s.document(i)) for i in range(s.ends.n)] == np.diff([0, *s.ends.all()]).tolist()


def test_empty_store(odd):
    assert token_store.round_trip(odd.limit(0), WORD).count() == 0


MARKED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\ny <|ENDOFTEXT|>", "<|startoftext|>Hello  <|endoftext|> \n", "a <|endoftext |> b", "plain text"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", " ", "\n", "\t", "é", "'", "1", "<|endoftext|>", "<|startoftext|>", "<|", "endoftext", "|>"]),
                max_size=12).map("".join))
def test_encoding_is_that_of_the_untouched_file(encoders, text):
    for e, path in zip(encoders, (BYTE, WORD)):
        ids, off = e.encode(pa.array([text, *MARKED], pa.large_string()))
        tok = Tokenizer.from_file(path)
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in (text, *MARKED)]


def test_queries_take_markers_as_the_library_does(spark, tmp_path):
    from quillspark.llm import queries

    spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for query, path, end in ((queries.op4_packing, BYTE, packing.END_ID), (queries.op6_token_store, WORD, token_store.END_ID)):
        tok = Tokenizer.from_file(path)
        want = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, end], "<u4") for i, t in enumerate(MARKED)}
        got = {r.doc_id: (r.ids_crc32, r.asDict().get("n_tokens", r.asDict().get("length"))) for r in query(spark, str(tmp_path)).collect()}
        assert got == {i: (zlib.crc32(x.tobytes()), len(x)) for i, x in want.items()}
