"""Comparing the members of buckets without comparing all pairs of a bucket.

Members of one bucket are candidates, but what matters is which components the
links join.  Within a bucket whose members already lie in several components,
the members of the largest one ("home") need to be held against the others
only: with ``u`` others and ``h`` at home, tiles of ``TILE`` members make
``u * h / TILE + u * u / TILE`` rows, not ``(u + h) ** 2 / TILE``.  So a large group
of copies that one round of links has joined costs about its size, and no task
holds more than two tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

TILE = 1024


def tiled(members: DataFrame, comp: DataFrame, carry: Sequence[str], tile: int | None = None) -> DataFrame:
    """(sig, ti, tj, side, node, comp, *carry) of the buckets ``members(sig, node,
    *carry)`` that hold several components, a row for each tile pair.  Within
    a tile pair, members of side 0 are to be compared with those of side 1; where
    all have side 0, with each other.  ``comp(node, comp)``: components so far."""
    tile = tile or TILE
    of = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    per = of.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"))
    split = (per.groupBy("sig").agg(F.max(F.struct("n", "comp")).alias("home"), F.sum("n").alias("size"), F.sum("who").alias("who"),
                                    F.count(F.lit(1)).alias("comps")).where("comps > 1")
             # buckets of the same members are looked at once
             .groupBy("who", "size").agg(F.min(F.struct("sig", "home")).alias("b")).select("size", "b.sig", "b.home"))
    tiles = F.when(F.col("size") <= tile, F.lit(1))
    split = split.select("sig", F.col("home.comp").alias("home"),
                         tiles.otherwise(F.ceil((F.col("size") - F.col("home.n")) / tile)).cast("int").alias("ut"),
                         tiles.otherwise(F.ceil(F.col("home.n") / tile)).cast("int").alias("ht"), (F.col("size") <= tile).alias("small"))
    rows = of.join(split, "sig")
    at_home = ~F.col("small") & (F.col("comp") == F.col("home"))
    own = F.pmod(F.xxhash64("node"), F.when(at_home, F.col("ht")).otherwise(F.col("ut"))).cast("int")

    def pair(ti, tj, side):
        return F.struct(F.lit(ti).cast("int").alias("ti") if isinstance(ti, int) else ti.cast("int").alias("ti"), tj.cast("int").alias("tj"),
                        F.lit(side).alias("side") if isinstance(side, int) else side.cast("int").alias("side"))

    def every(n):
        return F.sequence(F.lit(0), n - 1)

    # others: among themselves (tile pairs ti <= tj), and against each home tile (numbered below 0)
    among = F.transform(every(F.col("ut")), lambda k: pair(F.least(k, own), F.greatest(k, own), F.when(k < own, 1).otherwise(0)))
    to_home = F.transform(every(F.col("ht")), lambda k: pair(own, -1 - k, 0))
    from_home = F.transform(every(F.col("ut")), lambda k: pair(k, -1 - own, 1))
    places = (F.when(F.col("small"), F.array(pair(0, F.lit(0), 0))).when(at_home, from_home).otherwise(F.concat(among, to_home)))
    rows = rows.select("sig", "node", "comp", *carry, F.explode(places).alias("p"))
    return rows.select("sig", F.col("p.ti").alias("ti"), F.col("p.tj").alias("tj"), F.col("p.side").alias("side"), "node", "comp", *carry)


def dealt(rows: DataFrame) -> DataFrame:
    """``tiled`` rows, all of a tile pair in one partition and together."""
    return rows.repartition("sig", "ti", "tj").sortWithinPartitions("sig", "ti", "tj")


def sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows to hold against each other, and whether these are the same rows."""
    ti, tj, side = t.column("ti")[0].as_py(), t.column("tj")[0].as_py(), t.column("side").to_numpy()
    if ti == tj:
        every = np.arange(t.num_rows)
        return every, every, True
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1), False


def complete(batches, keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of batches sorted by ``keys``, and the groups' bounds."""
    held: list[pa.RecordBatch] = []

    def ready(done: bool):
        nonlocal held
        t = pa.Table.from_batches(held)
        cols = np.column_stack([t.column(c).to_numpy() for c in keys])
        b = np.append(C.bounds(cols), len(cols))
        last = len(b) - 1 if done else len(b) - 2
        if last > 0:
            yield t.slice(0, b[last]), b[:last + 1]
        held = [] if done else t.slice(b[last]).to_batches()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            yield from ready(False)
    if held:
        yield from ready(True)


def groups(batches, keys: Sequence[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """``fn`` on each group of two rows or more of batches sorted by ``keys``."""
    for t, b in complete(batches, keys):
        for s, e in zip(b[:-1].tolist(), b[1:].tolist()):
            if e - s > 1:
                yield from fn(t.slice(s, e - s))


def inner_pairs(b: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows p < q of one group, for groups with bounds ``b``: many
    groups at once, about ``most`` pairs."""
    n = np.diff(b)
    per = np.cumsum(n * (n - 1) // 2)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(per, (per[i - 1] if i else 0) + most, side="right")))
        rows = np.arange(b[i], b[j])
        left = np.repeat(b[i + 1:j + 1], n[i:j]) - rows - 1  # later rows of the group
        p = np.repeat(rows, left)
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(left) - left, left)
        yield p, q
        i = j


def forest(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Pairs (by number) of a spanning forest over the ends a, b, nearest first."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    chosen = []
    ends_a, ends_b = a.tolist(), b.tolist()
    for k in np.argsort(far, kind="stable").tolist():
        x, y = find(ends_a[k]), find(ends_b[k])
        if x != y:
            parent[x] = y
            chosen.append(k)
    return np.array(chosen, np.int64)


def pair_batches(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(a), 100_000):
        x, y = a[i:i + 100_000], b[i:i + 100_000]
        yield pa.RecordBatch.from_pydict({"a": np.minimum(x, y), "b": np.maximum(x, y)})
