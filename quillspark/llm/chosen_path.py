"""MinHash near-duplicate removal by a chosen-path set similarity join.

A document's set holds the hashes of its distinct word shingles (with fewer
words than a shingle, the whole sequence is one); sets link when
``den * |A & B| >= num * |A | B|``.  Each set is described by ``TOKENS`` minwise
tokens.  In each of ``TREES`` independent trees, a document follows the paths it
chooses: from a node it goes on to the child of each of its tokens whose hash
under that node is below ``1 / (similarity * TOKENS)``, so a document has
``1 / similarity`` children on average and two similar documents share one or
more.  Nodes of at most ``LEAF`` documents are compared exhaustively, by two bits
of each minwise token; larger ones branch again.  A child that keeps most of
its parent's documents is a dense node (a group of near copies): it branches no
further and is compared as it is, as are nodes at ``DEPTH``.

What a comparison leaves is verified on the full sets, so no wrong link is made.
A spanning forest of each leaf's likely pairs (of a dense node: each member and
one centre) is verified first; then, within tree nodes that still hold several
components, the pairs across them that a parity sketch (an exact bound of the
overlap) allows, see ``buckets``: all of them at once where they are few, else a
spanning forest first.  A tree node is looked at again only if pairs of it are
left, and never if the first verification has met all its pairs.  A large group
of near copies costs about its size.

Recall: two sets of similarity 0.8 share a node at depth k of one tree with
probability .632, .469, .374, .312, .268 for k = 1 to 5 (survival of a branching
process with one child on average), of at least one of 16 trees with .9994 at
depth 3 and .993 at depth 5; more similar sets meet more often.  The comparison
by two bits loses a few of 10,000 pairs at the threshold.

Scale: the description of a set is some 180 bytes; texts move only for documents
with a likely partner.  Nodes are counted with partial sums, so a node that a
third of all documents share is a few rows per task.  Sets with equal content
are one node of the graph.  The driver sees loop counters only.

Defined results: null and empty texts have no set, link with nothing and are
their own component; a very long text is one set, held by one task; repeated
rows link like any equal texts; a null id counts as larger than all others (a
component of such rows only has a null id); ties have no effect, the smallest id
names a component; other columns, of whatever name, are not read; an empty table
gives no rows.  Shingles are compared by 64 bits of hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .buckets import TILE, complete, forest, inner_pairs
from .chunks import NULL_ID
from .jaccard_join import Rule, across, candidates, id_of, sets_of, verified

TOKENS = 64
TREES = 16
LEAF = 256
DEPTH = 10
#: Share of its parent's documents from which a child is a dense node.
DENSE = 0.7
#: Rows of the tree that branch in one task.
ROWS_A_TASK = 100_000
#: Levels made at once from the root.
FIRST = 3
#: Edges of the link graph that one task joins.
EDGES_A_TASK = 100_000
#: Pairs a row up to which a tile gives all its pairs across components at once.
SPARE = 2
NEAR = Rule(words=2, num=80, den=100)

_ODD = C.mix(np.arange(1, 2 * TOKENS + 1, dtype=C.U64)) | C.U64(1)
_PLACE = (np.arange(TOKENS, dtype=C.U64) + C.U64(1)) << C.U64(40)


def minwise(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(sets, TOKENS) of the non-empty sets x[off[i]:off[i + 1]]: the low 16 bits of
    each minimum (different tokens share them once in 65,536 times)."""
    full = off[:-1][np.diff(off) > 0]
    out = np.empty((len(full), TOKENS), np.uint16)
    for i in range(TOKENS if len(full) else 0):
        out[:, i] = np.minimum.reduceat((x * _ODD[i] + _ODD[TOKENS + i]) >> C.U64(32), full) & C.U64(0xFFFF)
    return out


def two_bits(minima: np.ndarray) -> np.ndarray:
    """(sets, 2) 64-bit numbers: the low two bits of every minimum."""
    low = (minima & np.uint16(3)).astype(C.U64).reshape(len(minima), 2, TOKENS // 2)
    return (low << (np.arange(TOKENS // 2, dtype=C.U64) * C.U64(2))).sum(axis=2, dtype=C.U64)


def least_agreement(rule: Rule) -> int:
    """Agreeing tokens from which a pair is likely: 3.5 deviations below the mean at the threshold."""
    p = rule.num / rule.den
    p += (1 - p) / 4
    return math.floor(TOKENS * p - 3.5 * math.sqrt(TOKENS * p * (1 - p)))


def likely(t: pa.Table, p: np.ndarray, q: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the pairs of rows (p, q) that may link, with the number of tokens
    that disagree."""
    n = t.column("n").to_numpy()
    differ = np.zeros(len(p), np.int64)
    for c in ("s0", "s1"):
        s = t.column(c).to_numpy().view(C.U64)
        x = s[p] ^ s[q]
        differ += np.bitwise_count((x | x >> C.U64(1)) & C.U64(0x5555555555555555))
    a, b = n[p], n[q]
    ok = (differ <= TOKENS - least_agreement(rule)) & rule.linked(np.minimum(a, b), a, b)
    return p[ok], q[ok], differ[ok]


def describe(keyed: DataFrame, rule: Rule) -> DataFrame:
    """(id, th, n, h1, h2, minima, s0, s1) of every row: text hash, size, 128-bit
    hash and minwise tokens of its set."""

    def rows(batches):
        for b, col in C.batches_of(batches, "text"):
            x, off = sets_of(col, rule.words)
            zero = np.zeros(1, C.U64)
            pre = [np.concatenate((zero, np.cumsum(C.mix(x ^ C.U64(s)), dtype=C.U64))) for s in (0x51, 0xA7)]
            h = [(p[off[1:]] - p[off[:-1]]).view(np.int64) for p in pre]
            full = np.diff(off) > 0
            minima = np.zeros((len(col), TOKENS), np.uint16)
            minima[full] = minwise(x, off)
            s = two_bits(minima).view(np.int64)
            raw = minima.tobytes()
            size = 2 * TOKENS
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(np.diff(off).astype(np.int64)), *map(pa.array, h),
                 pa.array([raw[i * size:(i + 1) * size] if f else None for i, f in enumerate(full.tolist())], pa.binary()),
                 pa.array(s[:, 0]), pa.array(s[:, 1])], ["id", "th", "n", "h1", "h2", "minima", "s0", "s1"])

    return keyed.select("id", "th", "text").mapInArrow(
        rows, "id long, th long, n long, h1 long, h2 long, minima binary, s0 long, s1 long")


def branch(path: np.ndarray, minima: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) of the children that rows at nodes ``path`` choose by their tokens."""
    token = C.mix(minima.astype(C.U64) | _PLACE)
    drawn = C.mix(token ^ C.mix(path)[:, None])
    row, at = np.nonzero(drawn < C.U64(int((1 << 64) * rule.den / (rule.num * TOKENS))))
    return row, C.mix(drawn[row, at] + C.U64(1))


def _tokens(col) -> np.ndarray:
    """The ``minima`` column as (rows, TOKENS)."""
    return np.array([np.frombuffer(x.as_buffer(), np.uint16) for x in col], np.uint16).reshape(-1, TOKENS)


def paths(nodes: DataFrame, rule: Rule, trees: int, leaf: int, depth: int) -> DataFrame:
    """(sig, node, size) of the final tree nodes with two documents or more, from
    written tables.  ``nodes(node, minima)`` is a written table."""

    def first(batches):
        roots = C.mix(np.arange(1, trees + 1, dtype=C.U64) * C.U64(0x9E3779B97F4A7C15))
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                b = whole.slice(i, 1024)
                node, minima = b.column("node").to_numpy(), _tokens(b.column("minima"))
                row, path = np.tile(np.arange(len(node)), trees), np.repeat(roots, len(node))
                for _ in range(FIRST):
                    if not len(row):
                        break
                    found = [branch(path[s:s + 4096], minima[row[s:s + 4096]], rule) for s in range(0, len(row), 4096)]
                    row = np.concatenate([row[s:s + 4096][r] for s, (r, _) in zip(range(0, len(row), 4096), found)])
                    path = np.concatenate([p for _, p in found])
                by = np.argsort(row, kind="stable")  # a document's paths together: its number is stored once
                row, path = row[by], path[by]
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(node[row]), pa.array(np.zeros(len(row), np.int64))],
                                                 ["sig", "node", "parent"])

    def onward(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                b = whole.slice(i, 4096)
                row, path = branch(b.column("sig").to_numpy().view(C.U64), _tokens(b.column("minima")), rule)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), b.column("node").take(take), b.column("size").take(take)],
                                                 ["sig", "node", "parent"])

    schema = "sig long, node long, parent long"
    final, level = None, FIRST
    entries = C.saved(nodes.select("node", "minima").mapInArrow(first, schema), "path-entries")
    while True:
        counts = entries.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        held = C.saved(entries.join(counts, "sig"), "path-nodes")
        done = (F.col("size") <= leaf) | ((F.col("parent") > 0) & (F.col("size") >= DENSE * F.col("parent"))) | F.lit(level >= depth)
        here = held.where(done).select("sig", "node", "size")
        final = here if final is None else final.union(here)
        large = held.where(~done)
        n = large.count()
        if level >= depth or not n:
            return final
        rows, tokens = large.select("sig", "node", "size"), nodes.select("node", "minima")
        if n <= ROWS_A_TASK:  # of 24 bytes: less than the tokens they would make move
            rows = tokens.join(F.broadcast(rows), "node")
        else:
            # as many tasks as the rows ask for: they are small and much is done for each
            parts = max(nodes.sparkSession.sparkContext.defaultParallelism, n // ROWS_A_TASK)
            rows = rows.repartition(parts, "node").join(tokens.repartition(parts, "node"), "node")
        entries = C.saved(rows.select("sig", "node", "size", "minima").mapInArrow(onward, schema), "path-entries")
        level += 1


def _leaf_pairs(leaves: DataFrame, rule: Rule) -> DataFrame:
    """(sig, node, partner, met) of the members of ``leaves(sig, node, n, s0, s1)`` with a
    likely partner in their leaf; partner: the other end of the member's edge of a
    spanning forest, if it brings one; met: the forest has all pairs of the leaf's
    members (there are two)."""

    names = ["sig", "node", "n", "s0", "s1"]

    def compare(batches):
        for t, b in complete(batches, ("sig",)):
            columns = [t.column(c).to_numpy() for c in names]
            for p, q in inner_pairs(b):
                p, q, far = likely(t, p, q, rule)
                if not len(p):
                    continue
                chosen = forest(p, q, far)  # rows of different leaves never meet
                p, q = p[chosen], q[chosen]
                # members without an edge of their own come with a null partner
                alone = np.setdiff1d(np.concatenate((p, q)), p)
                row = np.concatenate((p, alone))
                partner = pa.array(columns[1][np.concatenate((q, alone))], mask=np.arange(len(row)) >= len(p))
                # two rows of a leaf: one edge and its other end
                _, of, rows = np.unique(columns[0][row], return_inverse=True, return_counts=True)
                met = rows[of] == 2
                yield pa.RecordBatch.from_arrays([*(pa.array(c[row]) for c in columns[:2]), partner, pa.array(met)], ["sig", "node", "partner", "met"])

    rows = leaves.select(*names).repartition("sig").sortWithinPartitions("sig")
    return rows.mapInArrow(compare, "sig long, node long, partner long, met boolean")


def _joined(edges: DataFrame) -> DataFrame:
    return C.components(edges, tasks=edges.count() // EDGES_A_TASK + 1)


def classes(docs: DataFrame, rule: Rule = NEAR, trees: int = TREES, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """(id, th, n, lead_id, lead_th) of every row of ``docs(doc_id, text)``: text
    hash, set size, and the smallest (id, text hash) it is linked with, directly or
    through others."""
    leaf = min(leaf, TILE)
    keyed = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("th"), "text")
    every = C.saved(describe(keyed, rule), "path-sets")
    nodes = C.saved(every.where("n > 0").groupBy("h1", "h2", "n").agg(
        F.min(F.struct("id", "th")).alias("lead"), F.first("minima").alias("minima"), F.first("s0").alias("s0"), F.first("s1").alias("s1"))
        .withColumn("node", F.monotonically_increasing_id()), "path-set-nodes")

    ends = paths(nodes, rule, trees, leaf, depth)
    small = ends.where(F.col("size") <= leaf).select("sig", "node").join(nodes.select("node", "n", "s0", "s1"), "node")
    small = C.saved(_leaf_pairs(small, rule), "path-likely")
    large = ends.where(F.col("size") > leaf)
    centers = large.groupBy("sig").agg(F.min("node").alias("center"))
    star = large.join(centers, "sig").groupBy("node").agg(F.min("center").alias("b")).select(F.col("node").alias("a"), "b").where("a != b")
    pairs = small.where("partner is not null").select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")).union(star)
    members = C.saved(small.select("sig", "node", "met").distinct().union(large.select("sig", "node", F.lit(False))), "path-members")
    lead = nodes.select("node", F.col("lead.id").alias("id"), F.col("lead.th").alias("th"))
    sets = candidates(keyed, lead, members, rule)

    comp = _joined(C.saved(verified(pairs.distinct(), sets, rule), "path-links"))
    left = members.where("not met")
    for spanning in (True, True, False):
        found = C.saved(across(left, sets, comp, rule, spanning, SPARE), "path-across")
        more = C.saved(verified(found.where("a is not null").select("a", "b"), sets, rule), "path-links")
        if not more.isEmpty():
            comp = _joined(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more))
        again = found.where("open is not null").select(F.col("open").alias("sig"))
        if again.isEmpty():
            break
        left = members.join(again, "sig", "left_semi")

    of = nodes.select("h1", "h2", "n", "lead", "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    leads = of.groupBy("comp").agg(F.min("lead").alias("top"))
    found = of.join(leads, "comp").select("h1", "h2", "n", "top")
    out = every.select("id", "th", "n", "h1", "h2").join(found, ["h1", "h2", "n"], "left")
    return out.select("id", "th", "n", F.coalesce(F.col("top.id"), "id").alias("lead_id"),
                      F.coalesce(F.col("top.th"), "th").alias("lead_th"))


def report(docs: DataFrame, rule: Rule = NEAR, **kw) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: n_shingles, component_id, kept
    (the row's id names its component)."""
    return classes(docs, rule, **kw).select(id_of("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                            id_of("lead_id").alias("component_id"), (F.col("id") == F.col("lead_id")).alias("kept"))
