"""Byte and word substring dedup (3, 8) and the Jaccard join (9) against brute force."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import common as C
from quillspark.llm import buckets, chosen_path, chunks, jaccard_join, substring_dedup, suffix_dedup

SMALL = {"chunk_bytes": 4_000, "block_keys": 500}


def corpus(seed, n=60):
    """Texts with shared passages, exact and near copies, repeats within a
    text, and odd rows; ids unsorted."""
    rnd = random.Random(seed)
    words = ["ab", "Cd", "efg", "é", "hij", "klmn", "o", "p,q", "rst.", "uvw"]
    passage = [" ".join(rnd.choices(words, k=30)) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rnd.choices(words, k=rnd.randint(0, 40)))]
        for _ in range(rnd.randint(0, 2)):
            parts += [rnd.choice(passage), " ".join(rnd.choices(words, k=rnd.randint(0, 9)))]
        texts.append(rnd.choice([" ", "\n", "  "]).join(parts))
    texts += [texts[3], texts[3], texts[5] + " tail", "zz " + texts[5], None, "", "", "ab", "AB", " \t\n", "same " * 200,
              "aaaa" * 60, "a" * 333, passage[0][7:60], passage[0] + passage[0]]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    return list(zip(ids, texts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n_words int, chunk string").repartition(3)


def bytes_by_hand(rows, length):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode()
        for a in range(len(w) - length + 1):
            first.setdefault(w[a:a + length], i)
    out = Counter()
    for i, t in rows:
        w = (t or "").encode()
        gone = np.zeros(len(w), bool)
        for a in range(len(w) - length + 1):
            if first[w[a:a + length]] < i:
                gone[a:a + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i, len(w), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(w, np.uint8)[~gone])).hexdigest()] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_byte_dedup(spark, seed):
    rows = corpus(seed)
    got = Counter(map(tuple, suffix_dedup.report(frame(spark, rows), **SMALL).collect()))
    assert got == bytes_by_hand(rows, 50)


def words_by_hand(rows, size):
    seen, out = {}, Counter()
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - size + 1):
            k = tuple(w[a:a + size])
            if k in seen:
                gone[a:a + size] = [True] * size
            seen[k] = i
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_word_dedup(spark, seed):
    rows = corpus(seed)
    got = Counter(map(tuple, substring_dedup.report(frame(spark, rows), **SMALL).collect()))
    assert got == words_by_hand(rows, 20)


def test_repeated_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, long), (2, long), (None, long), (None, long + " more"), (0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # rows with one id never remove from each other; null ids come last
    got = Counter((r.doc_id, r.n_removed > 0) for r in suffix_dedup.report(docs, **SMALL).collect())
    assert got == Counter({(1, False): 2, (2, True): 1, (None, True): 2, (0, False): 1})
    got = Counter((r.doc_id, r.n_removed) for r in substring_dedup.report(docs, **SMALL).collect())
    assert got == Counter({(1, 0): 1, (1, 40): 1, (2, 40): 1, (None, 40): 2, (0, 0): 1}) or got == Counter(
        {(1, 0): 2, (2, 40): 1, (None, 40): 2, (0, 0): 1})
    texts = {r.doc_id: r.text for r in substring_dedup.dedup(docs.where("doc_id in (0, 2)"), **SMALL).collect()}
    assert texts == {0: "", 2: long}


def test_dedup_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.report(none).count() == substring_dedup.report(none).count() == jaccard_join.report(none).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([b"aaaaaaaa", b"b", b"abcdefgh" * 3, b"\x00\xff", b"z" * 30]), max_size=40), st.integers(1, 3))
def test_suffix_order(parts, seed):
    text = np.frombuffer(b"".join(parts) + b"." * 50, np.uint8)
    starts = np.arange(len(text) - 49)
    order, edges = suffix_dedup.sort_suffixes(text, np.random.default_rng(seed).permutation(starts), 50)
    starts = np.random.default_rng(seed).permutation(starts)
    raw = text.tobytes()
    keys = [raw[starts[i]:starts[i] + 50] for i in order]
    assert keys == sorted(keys)
    assert edges.tolist() == [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]


def strings_of(seed, n=40, size=400):
    rnd = random.Random(seed)
    shared = rnd.randbytes(90).hex()
    texts = [rnd.randbytes(rnd.randint(0, size)).hex() for _ in range(n)] + ["", "x" * 49, "x" * 50, "ab" * 300, "y" * 200, "é" * 60]
    return pa.array([t if i % 3 else t + shared + t[:20] for i, t in enumerate(texts)], pa.large_string())


@pytest.mark.parametrize("stretch", [1 << 16, 64, 1000])
def test_anchor_runs_hold_every_string_once(stretch, monkeypatch):
    """Whatever is hashed at once: every string under one run, equal strings under one key."""
    col = strings_of(3)
    whole = suffix_dedup._Strings(col, 50, 24)
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch, raising=False)
    s = suffix_dedup._Strings(col, 50, 24)
    for a, b in ((s.start, whole.start), (s.n, whole.n), (s.key, whole.key), (s.row, whole.row)):
        assert a.tolist() == b.tolist()
    start, run = s.starts()
    raw = s.data.tobytes()
    assert start.tolist() == [int(o) + k for o, n in zip(s.off, np.diff(s.off)) for k in range(n - 49)]
    keys = {}
    for p, r in zip(start.tolist(), run.tolist()):
        assert s.off[s.row[r]] <= p and p + 50 <= s.off[s.row[r] + 1]
        assert keys.setdefault(raw[p:p + 50], s.key[r]) == s.key[r]
    assert len(set(s.key.tolist())) < len(s.key) < len(start) / 5


def alone(col):
    """A chunk of these texts, every counter of which is said to repeat."""
    ids = np.arange(len(col))
    chunk = type("Alone", (), {"number": 0})()
    chunk.own = lambda: (col, ids)
    chunk.bits = lambda kind, sizes: np.ones(sum(sizes.values()), bool)
    return chunk


def test_runs_take_no_python_step_each():
    """A chunk's runs are hashed and merged by arrays: the bytes that are hashed a
    place are few, and the number of calls does not follow the number of runs."""
    col = strings_of(5, n=400)
    hashed, calls, real = [], [], C.mix
    C.mix = lambda x: hashed.append(np.size(x)) or real(x)
    try:
        s = suffix_dedup._Strings(col, 50, 24)
    finally:
        C.mix = real
    assert sum(hashed) < len(s.data) / 4
    sys.setprofile(lambda frame, event, arg: calls.append(1) if event == "c_call" else None)
    try:
        r = suffix_dedup._Runs(alone(col), 0, 50, 24, 3)
    finally:
        sys.setprofile(None)
    assert len(r.run) > 10_000 and len(calls) < len(r.run) / 4


def test_equal_runs_are_one_and_clashing_hashes_are_told_apart(monkeypatch):
    col = strings_of(7)
    r = suffix_dedup._Runs(alone(col), 0, 50, 24, 3)
    raw = r.s.data.tobytes()
    content = [raw[p:p + n + 49] for p, n in zip(r.begin.tolist(), r.n.tolist())]
    sent = [raw[p:p + n + 49] for p, n in zip(r.first.tolist(), r.strings.tolist())]
    assert [sent[k] for k in r.run] == content and len(set(sent)) == len(sent) < len(content)
    least = {}
    for c, d in zip(content, r.ids[r.row].tolist()):
        least[c] = min(least.get(c, d), d)
    assert [least[c] for c in sent] == r.least.tolist()
    assert sum(len(x) - 4 - 12 * int.from_bytes(x[:4], "little") for _, x in r.blobs()) == sum(map(len, sent))
    # every run shares one hash: only runs with the bytes of the first are merged
    lead = r._first_equal(np.zeros(len(r.n), C.U64))
    assert all(content[a] == content[i] for i, a in enumerate(lead.tolist()))


@pytest.mark.parametrize("bits", [0, 3, 33])
def test_marked_keys_are_those_of_the_counters(bits):
    rnd = np.random.default_rng(bits)
    keys = C.mix(rnd.integers(0, 400, 1500).astype(C.U64))  # 33 bits: address and place do not fit one number
    owner = np.sort(rnd.integers(0, 90, 1500))
    s = chunks.Sketch(keys, bits, owner)
    wide = {}
    for k, o in zip((keys >> s.shift).tolist(), owner.tolist()):
        wide.setdefault(k, set()).add(o)
    assert s.at.tolist() == sorted(wide) and s.twice.tolist() == [len(wide[k]) > 1 for k in sorted(wide)]
    repeated = rnd.random(len(s.at)) < 0.5
    assert s.marked(repeated).tolist() == s.among(repeated, keys).tolist()


def classes_by_hand(rows, rule):
    sets = []
    for _, t in rows:
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
        k = rule.words
        sets.append(frozenset(tuple(w[a:a + k]) for a in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    big = 1 << 62
    least = [big if i is None else i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for x in range(len(rows)):
            for y in range(x):
                a, b = sets[x], sets[y]
                if a and b and rule.den * len(a & b) >= rule.num * len(a | b) and least[x] != least[y]:
                    least[x] = least[y] = min(least[x], least[y])
                    changed = True
    return Counter((i, len(s), None if v == big else v) for (i, _), s, v in zip(rows, sets, least))


def near_copies(seed):
    """A large group of near copies on both sides of the threshold, small sets,
    and unrelated texts."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 900)}" for _ in range(120)]
    rows = []
    for _ in range(70):
        own = list(base)
        for _ in range(rnd.randint(0, 5)):
            own[rnd.randrange(len(own))] = f"x{rnd.randint(0, 10**6)}"
        rows.append(" ".join(own[rnd.randint(0, 3):]))
    for size in (1, 2, 3, 5, 9, 12, 14, 16, 25, 40):
        a = [f"s{size}_{i}" for i in range(size)]
        rows += [" ".join(a), " ".join(a).upper(), " ".join(a[1:]), " ".join([*a, "end"]), " ".join([*a[:-1], "other"])]
    rows += [" ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(3, 200))) for _ in range(20)]
    rows += [None, "", " ", rows[0], rows[0], "word " * 500]
    ids = list(range(len(rows)))
    rnd.shuffle(ids)
    return [*zip(ids, rows), (None, rows[1]), (None, "only one without id here"), (ids[0], rows[0])]


@pytest.mark.parametrize("rule", [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_jaccard_classes(spark, rule, monkeypatch):
    monkeypatch.setattr(buckets, "TILE", 16)
    rows, r = near_copies(rule[0]), jaccard_join.Rule(*rule)
    got = Counter(map(tuple, jaccard_join.report(frame(spark, rows), r).collect()))
    assert got == classes_by_hand(rows, r)


def test_one_of_each_class_stays(spark):
    rows, rule = near_copies(4), jaccard_join.Rule(3, 90, 100)
    docs = frame(spark, rows)
    kept = jaccard_join.keep_one(docs, rule)
    assert kept.columns == docs.columns
    n = Counter(r.doc_id for r in kept.collect())
    lead = {(c if c is not None else None) for (i, size, c) in classes_by_hand(rows, rule) if size}
    empty = [i for i, t in rows if not (t or "").split()]
    assert set(n) == lead | set(empty) and set(n.values()) == {1}


@pytest.mark.parametrize("leaf, depth", [(256, 10), (6, 10), (4, 3)])
def test_chosen_path_classes(spark, leaf, depth, monkeypatch):
    """Small leaves make several levels, dense nodes and tiles; the trees are the
    same in every run, and here they miss no link."""
    monkeypatch.setattr(buckets, "TILE", 16)
    rows = near_copies(2)
    got = chosen_path.report(frame(spark, rows), leaf=leaf, depth=depth).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == classes_by_hand(rows, chosen_path.NEAR)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


@pytest.mark.parametrize("spare, edges", [(0, 20), (2, 100_000), (10**6, 20)])
def test_chosen_path_looks_again_only_where_pairs_are_left(spark, spare, edges, monkeypatch):
    """However many pairs a tile gives at once and tasks join the links: the same
    classes, and later rounds take few of the tree nodes."""
    monkeypatch.setattr(buckets, "TILE", 16)
    monkeypatch.setattr(chosen_path, "SPARE", spare, raising=False)
    monkeypatch.setattr(chosen_path, "EDGES_A_TASK", edges, raising=False)
    real, looked = chosen_path.across, []

    def counted(members, *args):
        looked.append(members.select("sig").distinct().count())
        return real(members, *args)

    monkeypatch.setattr(chosen_path, "across", counted)
    rows = near_copies(2)
    got = chosen_path.report(frame(spark, rows), leaf=6).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == classes_by_hand(rows, chosen_path.NEAR)
    assert looked[0] and sum(looked[1:]) < looked[0] and (spare < 10**6 or len(looked) == 1), looked


def test_chosen_path_recall():
    """Share of pairs at similarity 0.8 that meet in a node of some tree, by depth."""
    rnd = np.random.default_rng(5)
    pairs = 200
    common, own = 160, 20  # 160 of 200 tokens shared
    x = rnd.integers(1, 1 << 63, (pairs, common + 2 * own)).astype(C.U64)
    a, b = x[:, :common + own], np.concatenate((x[:, :common], x[:, common + own:]), axis=1)
    minima = [chosen_path.minwise(s.ravel(), np.arange(pairs + 1) * (common + own)) for s in (a, b)]
    agree = (minima[0] == minima[1]).mean()
    assert 0.77 < agree < 0.83
    roots = C.mix(np.arange(1, chosen_path.TREES + 1, dtype=C.U64) * C.U64(0x9E3779B97F4A7C15))
    nodes = []
    for m in minima:
        row, path = np.tile(np.arange(pairs), len(roots)), np.repeat(roots, pairs)
        for _ in range(4):
            at, path = chosen_path.branch(path, m[row], chosen_path.NEAR)
            row = row[at]
        nodes.append(set(zip(row.tolist(), path.tolist())))
    assert len({r for r, _ in nodes[0] & nodes[1]}) >= 0.97 * pairs
    # unrelated sets do not meet
    assert not {p for _, p in nodes[0]} & {p for r, p in nodes[1] if (r, p) not in nodes[0]}


def test_chosen_path_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert chosen_path.report(none).count() == 0
    empty = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in chosen_path.report(empty).collect()) == [
        ("1", 0, "1", True), ("2", 0, "2", True), ("None", 0, "None", True)]


@pytest.mark.parametrize("tile", [3, 7, 100])
def test_tiles_hold_every_pair_across_components_once(spark, tile):
    members = [(s, n) for s in range(3) for n in range(40) if (n * 7 + s) % 5]
    comp = {n: (0 if n < 25 else n // 6 * 6) for n in range(40)}
    found = Counter()
    rows = buckets.tiled(spark.createDataFrame(members, "sig long, node long"), spark.createDataFrame(list(comp.items()), "node long, comp long"), (), tile)
    by = {}
    for r in rows.collect():
        by.setdefault((r.sig, r.ti, r.tj), []).append(r)
    for (sig, ti, tj), own in by.items():
        if ti == tj:
            found.update((sig, *sorted((a.node, b.node))) for a in own for b in own if a.node < b.node and comp[a.node] != comp[b.node])
        else:
            found.update((sig, *sorted((a.node, b.node))) for a in own for b in own if a.side == 0 and b.side == 1 and comp[a.node] != comp[b.node])
    assert found == Counter((s, a, b) for s, a in members for t, b in members if s == t and a < b and comp[a] != comp[b])


def test_allocation_covers_the_difference():
    rule = jaccard_join.Rule(5, 80, 100)
    for n in (10, 100, 10**6):
        for size in (5, 30, 400, 20_000):
            d = rule.difference(size, size)
            one, two = jaccard_join.allocation(n, [(size, d)], d)
            assert one + 2 * two >= d + 1
    edges = rule.edges(10**6)
    for a in range(1, 3000):  # linked sizes lie in neighbouring bands
        b = a * rule.den // rule.num
        assert np.searchsorted(edges, b) - np.searchsorted(edges, a) <= 1


def test_components(spark):
    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + rnd.randint(1, 40)) for _ in range(60)] + [(7, 7), (None, 3), (500, 400)]
    got = {r.node: r.comp for r in C.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert {got[i] for i in range(61)} == {0} and got[500] == got[400] == 400
    assert all(v == 100 for k, v in got.items() if 100 <= k <= 140)
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("tasks", [1, 3])
def test_components_of_gathered_edges(spark, tasks):
    rnd = random.Random(9)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(180)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    assert sorted(C.components(df, tasks=tasks).collect()) == sorted(C.components(df).collect())
    assert C.components(df.where("a < 0"), tasks=tasks).count() == 0
