"""One text above a slice (2 MB), its copy, and a short one, through every operator."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillspark.llm import (chosen_path, common, decontam, filter_audit, jaccard_join, packing, pii, quality_rules, substring_dedup,
                            suffix_dedup, token_store)

N = 330_000
LONG = " ".join(f"w{i}" for i in range(N))
ROWS = [(1, LONG), (2, LONG), (3, "a short text of eight words or so"), (4, None)]


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG) > common.SLICE_BYTES
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(2).cache()


def test_duplicates(docs):
    for report in (jaccard_join.report, chosen_path.report):
        assert {r.doc_id: (r.n_shingles > N - 5 if r.doc_id < 3 else True, r.component_id) for r in report(docs).collect()} == {
            1: (True, 1), 2: (True, 1), 3: (True, 3), 4: (True, 4)}
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.report(docs).collect()} == {1: (N, 0), 2: (N, N), 3: (8, 0), 4: (0, 0)}
    size = len(LONG)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.report(docs).collect()} == {
        1: (size, 0, 0), 2: (size, size, 1), 3: (33, 0, 0), 4: (0, 0, 0)}


def test_words(spark, docs):
    bench = spark.createDataFrame([(9, " ".join(f"W{i}" for i in range(200_000, 200_012))), (8, "nothing here")], "item_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontam.report(docs, bench).collect()} == {
        1: (N, 12, 1), 2: (N, 12, 1), 3: (8, 0, 0), 4: (0, 0, 0)}
    m = {r.doc_id: (r.n_words, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(docs, np.zeros(1 << 16)).collect()}
    assert m == {1: (N, 0, False), 2: (N, 0, False), 3: (8, 0, True), 4: (0, 0, True)}
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    parts = filter_audit.audit(docs.selectExpr("doc_id", "text", "'p' AS part"), labels).where("filter_order = 'EABCD'").orderBy("step").collect()
    assert [r.removed for r in parts] == [1, 2, 0, 0, 0]
    assert {r.doc_id for r in pii.report(docs).collect()} == {1, 2, 3, 4}


def test_tokens(docs):
    for name, end, rows in (("byte_bpe_50k.json", 0, packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=1 << 30)),
                            ("word_bpe_49k.json", 2, token_store.round_trip(docs, public_tokenizers.path("word_bpe_49k.json")))):
        tok = Tokenizer.from_file(public_tokenizers.path(name))
        want = {i: zlib.crc32(np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], "<u4").tobytes()) for i, t in ROWS}
        assert {r.doc_id: r.ids_crc32 for r in rows.collect()} == want
