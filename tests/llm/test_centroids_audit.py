"""Centroid clustering (11) and filter audit (12) against brute force."""

import hashlib
import random
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import centroids, filter_audit, queries


# -- 11 ---------------------------------------------------------------------
def clusters_by_hand(rows, dims, k, rounds, scale=1024, salt="3:"):
    """(id, cluster, distance, cluster inertia, inertia, digest) in plain Python."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != dims or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    key = [(hashlib.sha256((salt + ("" if i is None else str(i))).encode()).hexdigest(), v) for i, v in kept]
    c = [list(v) for _, v in sorted(key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in enumerate(c))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in last:
        inertia[j] += d

    def fits(x):
        return x if x < 1 << 63 else None

    digest = [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in c]
    return Counter((i, j, fits(d), fits(inertia[j]), fits(sum(inertia.values())), digest[j]) for i, d, j in last)


def vectors(spark, rows):
    return spark.createDataFrame([(9, v, i, "q") for i, v in rows], "cluster int, embedding array<float>, vec_id long, x string").repartition(3)


def test_clusters(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(rnd.choice([-3, 0, 3]), 1) for _ in range(6)]) for i in range(300)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, [0.0] * 6), (400, [0.5] * 5), (401, [0.5] * 7), (402, None), (403, []),
             (404, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (405, [float("nan")] + [0.0] * 5), (406, [float("-inf")] + [0.0] * 5), (407, [-0.0] * 6)]
    got = centroids.cluster(vectors(spark, rows), dims=6, clusters=5, rounds=4).collect()
    assert Counter(map(tuple, got)) == clusters_by_hand(rows, 6, 5, 4)


def test_clusters_with_ties_and_repeats(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(40)] + [(7, [1.0, 0.0])] * 30
    got = centroids.cluster(vectors(spark, rows), dims=2, clusters=8, rounds=3).collect()
    assert Counter(map(tuple, got)) == clusters_by_hand(rows, 2, 8, 3)


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, -4.0])]
    got = centroids.cluster(vectors(spark, rows), dims=2, clusters=8, rounds=3).collect()
    assert Counter(map(tuple, got)) == clusters_by_hand(rows, 2, 8, 3)
    none = centroids.cluster(vectors(spark, rows).limit(0), dims=2)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_large_components(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([1e5, 1e9, -1e9, 3e12]) + rnd.randint(0, 9), rnd.random()]) for i in range(60)]
    got = centroids.cluster(vectors(spark, rows), dims=2, clusters=4, rounds=3).collect()
    want = clusters_by_hand(rows, 2, 4, 3)
    lost = any(w[2] is None for w in want)
    if lost:  # sums over a distance beyond 64 bits are null
        assert Counter(r[:3] for r in map(tuple, got)) == Counter({k: n for k, n in Counter(x[:3] for x in want.elements()).items()})
    else:
        assert Counter(map(tuple, got)) == want


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 5).flatmap(lambda d: st.tuples(
    st.lists(st.lists(st.integers(-6, 6), min_size=d, max_size=d), min_size=1, max_size=12),
    st.lists(st.lists(st.integers(-6, 6), min_size=d, max_size=d), min_size=1, max_size=9))))
def test_threshold_walk(both):
    x, c = (np.array(v) for v in both)
    for kind in (np.int64, object):
        number, best = centroids.nearest(x.astype(kind), c.astype(kind))
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        assert number.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()


# -- 12 ---------------------------------------------------------------------
def audit_by_hand(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    large = 1 << 70
    least = {}
    for i, t, _ in rows:
        k = large if i is None else i
        least[t or ""] = min(k, least.get(t or "", large))
    failed = []
    for i, t, p in rows:
        t = t or ""
        w = t.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")
        w = [x for x in w if x]
        bad = set()
        if len(w) < 200:
            bad.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            bad.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t):
            bad.add("C")
        if any(c in "#$%&*|" for c in t):
            bad.add("D")
        if (large if i is None else i) > least[t]:
            bad.add("E")
        failed.append((p or "", bad, i is not None and i in good, i is not None and i in toxic))
    out = []
    for part in {f[0] for f in failed}:
        own = [f for f in failed if f[0] == part]
        total = Counter()
        mine = []
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order):
                gone = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                total[x] += len(gone)
                fails = sum(x in f[1] for f in own)
                mine.append([part, "".join(order), step + 1, x, len(left), len(gone), fails - len(gone), sum(f[1] == {x} for f in own),
                             sum(f[2] for f in gone), sum(f[3] for f in gone)])
        out += [(*m, total[m[3]]) for m in mine]
    return Counter(out)


def text(rnd):
    n = rnd.choice([0, 1, 50, 199, 200, 230])
    t = rnd.choice([" ", "\n", "  ", "  "]).join(rnd.choices([f"w{i}" for i in range(rnd.choice([40, 400]))], k=n))
    return t + rnd.choice(["", "", " #", " É", " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEFGH"])


def test_audit(spark):
    rnd = random.Random(6)
    texts = [text(rnd) for _ in range(60)]
    rows = [(rnd.choice([None, *range(90)]), rnd.choice([*texts, None, "", "x" * 100_000]), rnd.choice(["a", "a", "", None, "b"])) for _ in range(300)]
    rows += [(500, "hot text", "a")] * 3 + [(i, "hot text", "c") for i in range(501, 600)]
    labels = [(rnd.choice([None, *range(90)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, p, 1, "z") for i, t, p in rows], "doc_id long, text string, part string, mask int, sha string").repartition(4)
    lab = spark.createDataFrame([(i, q, t, True) for i, q, t in labels], "doc_id long, quality int, toxic int, good boolean")
    got = Counter(map(tuple, filter_audit.audit(docs, lab).collect()))
    assert got == audit_by_hand(rows, labels)
    assert filter_audit.audit(docs.limit(0), lab).count() == 0
    none = filter_audit.audit(docs, lab.limit(0))
    assert {(r.good_lost, r.toxic_lost) for r in none.collect()} == {(0, 0)}


@pytest.mark.parametrize("m", [2, 3, 4, 5])
def test_least_squares_gives_shapley(m):
    rnd = random.Random(m)
    v = [0] + [rnd.randint(0, 1000) for _ in range((1 << m) - 1)]
    want = Counter()
    for order in permutations(range(m)):
        s = 0
        for i in order:
            want[i] += v[s | 1 << i] - v[s]
            s |= 1 << i
    assert (filter_audit.shapley_matrix(m) @ np.array(v)).tolist() == [want[i] for i in range(m)]


def test_inverse_is_exact():
    a = [[Fraction(1, 3), Fraction(2)], [Fraction(5), Fraction(1, 7)]]
    b = filter_audit.solve(a)
    assert [[sum(a[i][k] * b[k][j] for k in range(2)) for j in range(2)] for i in range(2)] == [[1, 0], [0, 1]]


def test_queries_read_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("count(distinct coalesce(source, ''))").first()[0]
    assert queries.op12_filter_audit(spark, sf).count() == 600 * n
    assert queries.op11_centroids(spark, sf).count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
