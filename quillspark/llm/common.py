"""Helpers shared by the operators of this package: vectorised word and hash
arithmetic on Arrow string columns, and a distributed connected-components
loop.

Word classes are byte classes of UTF-8, so a batch of texts is handled as one
byte array with document offsets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

U64 = np.uint64
#: Bytes of text handled at once inside a task; a longer document is one slice.
SLICE_BYTES = 2 << 20

#: Separators of the "space" word class: 0x20 and 0x09-0x0D.
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Letters, digits and every byte of a non-ASCII character.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = True
ALNUM_WORD[0x80:] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and odd multiplications)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Spans of more bytes are hashed one by one (BLAKE2b), shorter ones eight bytes a step.
LONG_SPAN = 64
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U64)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number (zeros after the end)."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each span.  Every step mixes the state with the
    next eight bytes, so no arithmetic relation between bytes survives; hashes of
    different seeds are independent."""
    left = ends - starts
    eight = _eights(data)
    h = mix(left.astype(U64) + U64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    long_ = np.flatnonzero(left > LONG_SPAN)
    rows, at = np.flatnonzero((left > 0) & (left <= LONG_SPAN)), 0
    while len(rows):
        rest = left[rows] - at
        x = eight[starts[rows] + at] & _LOW_BYTES[np.minimum(rest, 8)]
        h[rows] = mix(h[rows] ^ x)
        rows, at = rows[rest > 8], at + 8
    if len(long_):
        raw, salt = memoryview(data), seed.to_bytes(8, "little")
        h[long_] = np.frombuffer(b"".join(
            hashlib.blake2b(raw[s:e], digest_size=8, salt=salt).digest()
            for s, e in zip(starts[long_].tolist(), ends[long_].tolist())), "<u8")
    return h


def equal_bytes(a: np.ndarray, at: np.ndarray, n: np.ndarray, b: np.ndarray, bt: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Which spans of ``a`` (from ``at``, ``n`` bytes) have the bytes of their
    counterparts of ``b`` (from ``bt``, ``m`` bytes)?"""
    same = n == m
    x, y = _eights(a), _eights(b)
    far = np.flatnonzero(same & (n > LONG_SPAN))
    rows, k = np.flatnonzero(same & (n > 0) & (n <= LONG_SPAN)), 0
    while len(rows):
        rest = n[rows] - k
        ok = (x[at[rows] + k] ^ y[bt[rows] + k]) & _LOW_BYTES[np.minimum(rest, 8)] == 0
        same[rows[~ok]] = False
        rows, k = rows[ok & (rest > 8)], k + 8
    for i in far.tolist():
        same[i] = np.array_equal(a[at[i]:at[i] + n[i]], b[bt[i]:bt[i] + n[i]])
    return same


def window_hash(h: np.ndarray, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of the ``size`` hashes from each place ``at`` on, built from
    windows of one, two, four ... places, each mixed."""
    level = mix(h ^ U64((seed + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
    out, bit = mix(np.full(len(at), size, U64)), 1
    if not len(at):
        return out
    while True:
        if size & bit:
            out = mix(out * U64(0xA0761D6478BD642F) + level[at])
            at = at + bit
        if 2 * bit > size:
            return out
        level = mix(level[:-bit] * U64(0xE7037ED1A0B428DB) + level[bit:])
        bit *= 2


def codes_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key among the different ones, first place of each different key)."""
    import pandas as pd

    code, different = pd.factorize(keys)
    first = np.empty(len(different), np.int64)
    first[code[::-1]] = np.arange(len(keys))[::-1]
    return code, first


def texts_of(col: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    """A text column as one large_string array; null counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    col = col.cast(pa.large_string())
    return col.fill_null("") if col.null_count else col


def raw_bytes(col: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets (one more than texts)."""
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(col: pa.LargeStringArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text (one row at least)."""
    n = len(col)
    if n == 0:
        return
    _, off = raw_bytes(col)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """Words of a slice of texts: byte spans, owning document, 64-bit hash.

    ``first`` has one more entry than texts: words of text d are
    ``first[d]:first[d + 1]``.
    """

    def __init__(self, col: pa.LargeStringArray, word_bytes: np.ndarray, lower: bool):
        data, off = raw_bytes(col)
        self.data = LOWER[data] if lower else data
        self.off = off
        self.n_docs = len(col)
        n = len(data)
        isw = word_bytes[self.data]
        st, en = isw.copy(), isw.copy()
        if n:
            st[1:] &= ~isw[:-1]
            en[:-1] &= ~isw[1:]
            edge = off[:-1][off[:-1] < n]
            st[edge] = isw[edge]
            edge = off[1:][off[1:] > 0] - 1
            en[edge] = isw[edge]
        self.starts = np.flatnonzero(st)
        self.ends = np.flatnonzero(en) + 1
        self.isw = isw
        self.first = np.searchsorted(self.starts, off)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return byte_hash(self.data, self.starts, self.ends, seed)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and document of every window of ``size`` words of one document."""
        per = np.maximum(self.counts - size + 1, 0)
        doc = np.repeat(np.arange(self.n_docs), per)
        begin = np.cumsum(per) - per
        start = np.arange(len(doc)) - begin[doc] + self.first[:-1][doc]
        return start, doc


def covered(n: int, starts: np.ndarray, length) -> np.ndarray:
    """Mask of the positions inside any [start, start + length)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.subtract.at(d, starts + length, 1)
    return np.cumsum(d[:-1]) > 0


def sums_by(first: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Sum of flags over each range first[d]:first[d + 1]."""
    c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return c[first[1:]] - c[first[:-1]]


def bounds(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values of a sorted array (or of sorted rows)."""
    if len(keys) == 0:
        return np.zeros(0, np.int64)
    new = keys[1:] != keys[:-1]
    if new.ndim > 1:
        new = new.any(axis=1)
    return np.concatenate(([0], np.flatnonzero(new) + 1))


def batches_of(batches: Iterable[pa.RecordBatch], text: str,
               limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.LargeStringArray]]:
    """Record batches cut to about ``limit`` bytes of text, with the text column."""
    for b in batches:
        col = texts_of(b.column(b.schema.get_field_index(text)))
        for i, j in slices(col, limit):
            yield b.slice(i, j - i), col.slice(i, j - i)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back (a lineage cut that
    survives lost executors)."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b", tasks: int | None = None) -> DataFrame:
    """(node, comp): smallest node reachable from each node that has an edge.

    Each round first shortens chains inside a partition (union-find over its
    own edges, a star out), then hooks every node's neighbours to the smallest
    one (alternating large-star and small-star steps); both steps keep
    connectivity, and the stars are final when a round changes nothing.  Each
    round is a written table, so a lost executor never restarts the loop.
    Self-loops and null ends are ignored.

    ``tasks``: as many as the number of edges asks for; few edges in many files
    would take a round for each chain that the files cut.  The stars of a single
    task are final.
    """
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    pairs = pairs.where(F.col("a") != F.col("b"))
    if tasks:
        pairs = pairs.coalesce(tasks)

    def local_stars(batches):
        parent: dict[int, int] = {}

        def find(x):
            root = x
            while parent.get(root, root) != root:
                root = parent[root]
            while parent.get(x, x) != root:
                parent[x], x = root, parent[x]
            return root

        for t in batches:
            for x, y in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
                rx, ry = find(x), find(y)
                lo, hi = (rx, ry) if rx < ry else (ry, rx)
                parent.setdefault(lo, lo)
                parent[hi] = lo
        ends = list(parent)
        for i in range(0, len(ends), 50_000):
            part = ends[i:i + 50_000]
            yield pa.RecordBatch.from_pydict({"a": pa.array(part, pa.int64()),
                                              "b": pa.array([find(x) for x in part], pa.int64())})

    # every row: a is the larger end
    stars = saved(pairs.mapInArrow(local_stars, "a long, b long").where("a > b").distinct(), "cc")
    while tasks != 1:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        # large-star: larger neighbours of a go to the smallest of a and its neighbours
        step = (both.join(low, "a").where("b > a")
                .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        # small-star: smaller neighbours of a, and a, go to the smallest
        low = step.groupBy("a").agg(F.min("b").alias("m"))
        step = (step.join(low, "a").select(F.explode(F.array(
                    F.struct("a", F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                .select("e.*").where("a != b").distinct())
        after = saved(step, "cc")
        same = (stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
                == after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        stars = after
        if same:
            break
    return (stars.select(F.col("a").alias("node"), F.col("b").alias("comp"))
            .union(stars.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()))


def plain(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text string) whatever else the table holds."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")


def key_part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
