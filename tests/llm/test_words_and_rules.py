"""Shared arithmetic, quality rules (10), classifier (1), decontamination (2)."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.llm import common as C
from quillspark.llm import decontam, gam_quality, quality_rules

ROWS = [
    (1, "one two three four five six seven eight nine ten eleven"),
    (1, "one two three four five six seven eight nine ten eleven"),
    (2, None), (3, ""), (None, "a b c d"), (4, " \t\n\x0b\x0c\r"), (5, "x " * 30_000), (6, "Ünï çödé\nsame line\nsame line\n\nsame line"),
    (7, "a b c d e f a b c d e g h i j k l m n o p q r s"), (8, "<<##>> | & % $ *"),
]
SCHEMA = "doc_id long, text string, n_words string, score string, doc_tokens int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long, repeated rows, and columns with clashing names."""
    return spark.createDataFrame([(i, t, "mine", None, 7) for i, t in ROWS], SCHEMA)


def space_words(text):
    return (text or "").encode().split()


def test_words_and_hashes():
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("ab \n\t é😀", k=rnd.randint(0, 30))) for _ in range(300)]
    w = C.Words(pa.array(texts, pa.large_string()), C.SPACE_WORD, False)
    words = [w.data[s:e].tobytes() for s, e in zip(w.starts, w.ends)]
    assert words == [x for t in texts for x in space_words(t)]
    assert w.counts.tolist() == [len(space_words(t)) for t in texts]
    seen = {}
    for word, h in zip(words, w.hashes().tolist()):
        assert seen.setdefault(word, h) == h  # equal words, equal hashes wherever they stand
    assert len(set(seen.values())) == len(seen)


def rules_by_hand(text):
    words = space_words(text)
    text = text or ""
    lines = [x for x in text.split("\n") if x.encode().split()]
    at = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if at[tuple(words[i:i + 5])] > 1:
            hit |= set(range(i, i + 5))
    chars = sum(len(w.decode()) for w in words)
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def test_rules(spark, odd):
    weights = quality_rules.fit(odd, odd.limit(0))
    rows = quality_rules.judge(odd, weights).collect()
    assert len(rows) == len(ROWS)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == Counter((i, *rules_by_hand(t)) for i, t in ROWS)
    assert all(not r.kept for r in rows if r.base_failed)


def test_log_likelihood_ratio(spark):
    good, bad = "clean words of prose here and there once more today".split(), "zz qq ##".split()
    rnd = random.Random(5)
    texts = [" ".join(rnd.choices(good, k=20)) for _ in range(40)] + [" ".join(rnd.choices(bad, k=20)) for _ in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 1, 0), (45, 0, 0), (46, None, None)], "doc_id long, quality int, toxic int")
    target = quality_rules.trusted(docs, labels)
    assert target.count() == 20
    weights = quality_rules.fit(docs, target, buckets=256)
    def counts(some):
        n = np.zeros(256)
        for t in some:
            _, b = quality_rules._grams(C.Words(pa.array([t], pa.large_string()), C.SPACE_WORD, False), 256)
            np.add.at(n, b, 1)
        return n
    few, every = counts(texts[:20]), counts(texts)
    assert np.allclose(weights, np.log((few + 5) / (every * few.sum() / every.sum() + 5)))
    kept = {r.doc_id for r in quality_rules.judge(docs, weights).where("llr >= -0.2").collect()}
    assert kept == set(range(40))
    same = quality_rules.keep_good(docs.selectExpr("text", "doc_id", "doc_id as kept"), weights)
    assert same.columns == ["text", "doc_id", "kept"]


def test_classifier_learns_and_is_blind(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(600):
        junk = i % 3 == 0
        rows.append((i, " ".join(rnd.choices(["AA!!", "BB##", "||"] if junk else ["calm", "prose", "goes", "on,"], k=rnd.randint(20, 60))), int(not junk)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "calm prose"), (700, None), (701, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (5000, None, 0)], "doc_id long, quality int, toxic int")
    out = gam_quality.score(docs, gam_quality.train(docs, labels)).collect()
    assert len(out) == 603 and all(0 <= r.score <= 1 for r in out)
    truth = {i: q for i, _, q in rows}
    import zlib
    held = [r for r in out if r.doc_id in truth and r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    nothing = gam_quality.score(docs.limit(3), gam_quality.train(docs.limit(0), labels)).collect()
    assert [r.score for r in nothing] == [0.5] * 3


def test_pair_interaction_is_learned():
    rnd = np.random.default_rng(1)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    m = gam_quality.Model().fit(x[:3000], y[:3000])
    assert ((m.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert {m.pairs[0][0], m.pairs[0][1]} == {0, 1}


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def decontaminated_by_hand(docs, items, window=10):
    known = {}
    for i, t in items:
        w = bench_words(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1) if k else ():
            known.setdefault(tuple(w[a:a + k]), set()).add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, names = bench_words(t), set(), set()
        for k in {len(x) for x in known}:
            for a in range(len(w) - k + 1):
                found = known.get(tuple(w[a:a + k]))
                if found:
                    hit |= set(range(a, a + k))
                    names |= found
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven twelve"), (1, "one two"), (2, "ünï-çödé"), (3, None), (4, ""),
         (5, "..."), (None, "same line same line"), (12, "b c")]


@pytest.mark.parametrize("block", [10_000, 4])
def test_decontamination(spark, odd, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.report(odd, bench, block_words=block).collect()
    assert Counter(map(tuple, got)) == decontaminated_by_hand(ROWS, ITEMS)
    clean = decontam.remove_documents(odd, bench, block_words=block)
    assert clean.columns == odd.columns
    hit = decontaminated_by_hand(ROWS, ITEMS)
    assert clean.count() == sum(n for r, n in hit.items() if not r[-1])
    assert decontam.report(odd, bench.limit(0)).where("contaminated").count() == 0


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "keep Two, three keep"), (2, None), (3, "éé two three éé two three")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    out = {r.doc_id: r.text for r in decontam.remove_spans(docs, bench).collect()}
    assert out == {1: "keep  keep", 2: None, 3: "éé  éé "}


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.judge(none, quality_rules.fit(none, none)).count() == 0
    assert gam_quality.score(none, gam_quality.train(none, labels)).count() == 0
    assert not math.isnan(gam_quality.Model().score(np.zeros((1, 3)))[0])


def test_toxic_rows_are_dropped_out_of_sample(spark):
    """Every row judged by weights counted without its own label's fold."""
    docs = C.plain(C.read(spark, "/root/testdata/sf0.01", "documents"), "doc_id", "text").cache()
    labels = C.read(spark, "/root/testdata/sf0.01", "labels").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(3))).cache()
    n, kept = Counter(), Counter()
    for fold in range(3):
        weights, toxicity = quality_rules.learn(docs, docs, labels.where(F.col("fold") != fold))
        out = quality_rules.judge(docs, weights, toxicity=toxicity).where("not base_failed").join(labels.where(F.col("fold") == fold), "doc_id")
        for r in out.collect():
            n[r.quality, r.toxic] += 1
            kept[r.quality, r.toxic] += r.kept
    assert kept[1, 0] >= 0.98 * n[1, 0]
    assert kept[1, 1] <= 0.35 * n[1, 1]  # texts in other languages than English hold no toxic word


def test_one_toxic_word_in_a_long_text(spark):
    rnd = random.Random(6)
    prose = [f"w{i}" for i in range(2000)]
    texts = [" ".join(rnd.choices(prose, k=40)) for _ in range(400)]
    for i in range(0, 100):
        texts[i] = texts[i] + " vile " + texts[i + 100]
    rows = list(enumerate(texts)) + [(900, " ".join(rnd.choices(prose, k=20_000)) + " vile"), (901, " ".join(rnd.choices(prose, k=20_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 100)) for i in range(0, 400, 2)] + [(2, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    weights, toxicity = quality_rules.learn(docs, docs, labels)
    assert np.allclose(weights, quality_rules.fit(docs, quality_rules.trusted(docs, labels)))
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, weights, toxicity=toxicity).collect()}
    assert not got[900] and not any(got[i] for i in range(100)) and got[901] and sum(got[i] for i in range(100, 400)) >= 298
    same = quality_rules.keep_good(docs, weights, toxicity=toxicity)
    assert {r.doc_id for r in same.collect()} == {i for i, k in got.items() if k}
    for only in ("toxic = 1", "toxic = 0", "false"):  # nothing to hold against
        _, none = quality_rules.learn(docs, docs, labels.where(only))
        assert not none.any()
