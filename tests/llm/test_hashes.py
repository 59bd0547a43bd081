"""Texts that are told apart by hash: words with the structure of a Thue-Morse
word, which polynomial hashes modulo a power of two cannot tell from their
complement."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from quillspark.llm import common as C
from quillspark.llm import jaccard_join, packing, quality_rules, substring_dedup, token_store
from quillspark.llm.tokens import Encoder


def pair(size):
    bits = [bin(i).count("1") & 1 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


SIZES = [1024, 2048, 64, 61]


@pytest.mark.parametrize("size", SIZES)
def test_words(size):
    for pad in ("", "x"):
        col = pa.array([pad + w for w in pair(size)], pa.large_string())
        w = C.Words(col, C.SPACE_WORD, False)
        assert all(len(set(w.hashes(seed).tolist())) == 2 for seed in range(3))


def test_hash_of_every_length():
    raw = np.frombuffer(bytes(range(1, 251)) * 2, np.uint8)
    n = np.arange(1, 200)
    a = C.byte_hash(raw, np.zeros(199, np.int64), n)
    assert len(set(a.tolist())) == 199
    assert (C.byte_hash(raw, np.full(199, 250), 250 + n) == a).all()  # wherever the bytes stand
    assert C.equal_bytes(raw, np.zeros(199, np.int64), n, raw, np.full(199, 250), n).all()
    assert not C.equal_bytes(raw, np.zeros(199, np.int64), n, raw, np.full(199, 251), n).any()


def test_windows_by_order_and_size():
    h = C.mix(np.arange(1, 200, dtype=C.U64))
    seen = set()
    for size in range(1, 40):
        at = np.arange(len(h) - size + 1)
        seen |= set(C.window_hash(h, at, size).tolist())
    assert len(seen) == sum(199 - size + 1 for size in range(1, 40))
    twin = np.concatenate((h, h))
    assert C.window_hash(twin, np.array([3, 202]), 37).tolist()[0] == C.window_hash(twin, np.array([3, 202]), 37).tolist()[1]
    assert C.window_hash(h[[0, 1]], np.array([0]), 2) != C.window_hash(h[[1, 0]], np.array([0]), 2)


@pytest.mark.parametrize("name, leading", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoding(name, leading):
    path = public_tokenizers.path(name)
    a, b = pair(1024)
    texts = [f"{a} {b}", b, f"z {a} y", "x" * 70 + " " + "x" * 69 + "y"]
    e, tok = Encoder(path, leading), Tokenizer.from_file(path)
    for _ in range(2):  # once learned, once remembered
        ids, off = e.encode(pa.array(texts, pa.large_string()))
        assert [ids[s:t].tolist() for s, t in zip(off, off[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgotten_pieces(monkeypatch):
    from quillspark.llm import tokens

    monkeypatch.setattr(tokens, "CACHE", 40)
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, tok = Encoder(path, True), Tokenizer.from_file(path)
    for k in range(12):
        texts = [" ".join(f"w{i * i}x" for i in range(k, k + 15)), f"same {k}\nline", "a\u3000b c", "tab\t", "\x01 b \x01"]
        ids, off = e.encode(pa.array(texts, pa.large_string()))
        assert [ids[s:t].tolist() for s, t in zip(off, off[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(e.keys) <= 40 + 20 and (np.diff(e.keys.astype(object)) > 0).all()


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("size", [1024, 2048])
def test_operators(spark, size):
    a, b = pair(size)
    two = docs(spark, [" ".join([a, *"cdefghijklmnopqrstuvwxyz"[:19]]), " ".join([b, *"cdefghijklmnopqrstuvwxyz"[:19]])])
    assert [r.n_removed for r in substring_dedup.report(two).collect()] == [0, 0]

    texts = [" ".join([a, "x", a, "y", a, "z"]), " ".join([b, "x", b, "y", b, "z"])]
    assert sorted(r.component_id for r in jaccard_join.report(docs(spark, texts)).collect()) == [0, 1]

    lines = f"one two three four five six seven eight nine\n{a}\n{b}"
    m = quality_rules.measure(pa.array([lines], pa.large_string()), np.zeros(1 << 16))
    assert m["n_dup_lines"].tolist() == [0]

    two = docs(spark, [f"{a} q", f"{b} q"])
    for name, rows, end in (("byte_bpe_50k.json", packing.pack(two, public_tokenizers.path("byte_bpe_50k.json"), length=1 << 20), 0),
                            ("word_bpe_49k.json", token_store.round_trip(two, public_tokenizers.path("word_bpe_49k.json")), 2)):
        tok = Tokenizer.from_file(public_tokenizers.path(name))
        want = {i: zlib_crc(tok.encode(f"{w} q", add_special_tokens=False).ids + [end]) for i, w in enumerate((a, b))}
        assert {r.doc_id: r.ids_crc32 for r in rows.collect()} == want


def zlib_crc(ids):
    import zlib

    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_long_words_hash_as_documented():
    data = np.frombuffer(b"q" * 100, np.uint8)
    h = C.byte_hash(data, np.array([0]), np.array([100]), 3)
    assert h[0] == np.frombuffer(hashlib.blake2b(b"q" * 100, digest_size=8, salt=(3).to_bytes(8, "little")).digest(), "<u8")[0]
