"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
Every run of ``WINDOW`` words of a benchmark item is a window (an item of fewer
words is one window); the windows' hashes form the set.  Training texts are
scanned with rolling window hashes, each hash hit is verified on the words
themselves, and the words inside verified windows are marked.

Scale: one scan of the documents, no shuffle.  What travels with the tasks is
checked: the benchmark's words are counted first, and a benchmark of more than
``block_words`` words is dealt by item into blocks below that size, which are
applied one after the other, each in a scan of its own over the marks of the
ones before (a written table in between).  Any benchmark size gives the same
rows.

Defined results: null and empty texts have no words and no hits; a very long text
is scanned whole by one task; an empty benchmark hits nothing, an empty table gives
no rows; ties play no part; repeated items count once, an item with a null id
marks words and counts under the name "null"; repeated documents are judged
one by one; other columns, of whatever name, pass through.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WINDOW = 10
#: Benchmark words in one block (about 150 bytes of task memory each).
BLOCK_WORDS = 200_000


class Grams:
    """Windows of some benchmark items: sorted hashes by length, and the items
    of each window's exact words."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.items: dict[bytes, list[str]] = {}
        found: dict[int, set[int]] = {}
        for name, text in items:
            w = C.Words(pa.array([text or ""], pa.large_string()), C.ALNUM_WORD, True)
            n = int(w.counts[0])
            if not n:
                continue
            size = min(window, n)
            at, _ = w.windows(size)
            found.setdefault(size, set()).update(C.window_hash(w.hashes(), at, size).tolist())
            for a in at:
                names = self.items.setdefault(window_words(w, a, size), [])
                if name not in names:
                    names.append(name)
        self.hashes = {size: np.array(sorted(h), dtype=C.U64) for size, h in found.items()}

    def hits(self, col: pa.LargeStringArray) -> tuple[C.Words, np.ndarray, list[set[str]]]:
        """Words of a slice, which of them are hit, and each text's items."""
        w = C.Words(col, C.ALNUM_WORD, True)
        h = w.hashes()
        hit = np.zeros(len(h), bool)
        items: list[set[str]] = [set() for _ in range(w.n_docs)]
        for size, known in self.hashes.items():
            at, doc = w.windows(size)
            wh = C.window_hash(h, at, size)
            k = np.minimum(np.searchsorted(known, wh), len(known) - 1)
            maybe = np.flatnonzero(known[k] == wh)
            sure = []
            for i in maybe:
                names = self.items.get(window_words(w, at[i], size))  # the words decide, not the hash
                if names:
                    items[doc[i]].update(names)
                    sure.append(at[i])
            hit |= C.covered(len(h), np.array(sure, np.int64), size)
        return w, hit, items


def window_words(w: C.Words, at: int, size: int) -> bytes:
    data = w.data
    return b" ".join(data[s:e].tobytes() for s, e in zip(w.starts[at:at + size], w.ends[at:at + size]))


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int):
    """The benchmark as ``Grams``, each of about ``block_words`` words at most."""
    b = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("null")).alias("id"),
                         benchmark[text_col].cast("string").alias("text"))
    total = b.agg(F.sum(F.length("text"))).first()[0] or 0  # a word has two characters or more on average
    n = max(1, math.ceil(total / 2 / block_words))
    for i in range(n):
        rows = b.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).orderBy("id", "text").collect()
        yield i + 1 == n, Grams([(r["id"], r["text"]) for r in rows], window)


def annotate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id",
             bench_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS):
    """``docs`` with three more columns - number of words, hit words (ascending
    indexes), items (names) - and those columns' names, chosen to clash with none."""
    taken = {c.lower() for c in docs.columns}
    names = []
    for base in ("n_words", "hit_words", "hit_items"):
        while base in taken:
            base += "_"
        names.append(base)
    kinds = (T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()))
    out = docs.select("*", *[F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds)])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds)]])
    at, width = docs.columns.index(text_col), len(docs.columns)

    for last, grams in blocks(benchmark, id_col, bench_text, window, block_words):
        # the block travels with the tasks: its size is bounded by ``block_words``
        sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(grams))

        def mark(batches, sent=sent):
            own = pickle.loads(sent.value)
            for b in batches:
                col = C.texts_of(b.column(at))
                for i, j in C.slices(col):
                    part = b.slice(i, j - i)
                    w, hit, items = own.hits(col.slice(i, j - i))
                    hits = [np.flatnonzero(hit[s:e]) for s, e in zip(w.first[:-1], w.first[1:])]
                    for d, (h0, i0) in enumerate(zip(part.column(width + 1), part.column(width + 2))):
                        if h0.is_valid:
                            hits[d] = np.union1d(hits[d], np.array(h0.as_py(), np.int64))
                            items[d].update(i0.as_py())
                    cols = [*part.columns[:width], pa.array(w.counts.astype(np.int64)),
                            pa.array([h.astype(np.int32) for h in hits], pa.list_(pa.int32())),
                            pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

        out = out.mapInArrow(mark, schema)
        if not last:
            out = C.saved(out, "decontam")
    return out, names


def report(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: n_words, n_hit, n_items,
    items_sha256 (of the sorted item names, comma-joined), contaminated."""
    out, (n, hits, items) = annotate(docs.select("doc_id", "text"), benchmark, **kw)
    return out.select("doc_id", F.col(n).alias("n_words"), F.size(hits).cast("long").alias("n_hit"),
                      F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", F.array_sort(items)), 256).alias("items_sha256"),
                      (F.size(hits) > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` without any hit, columns as they were."""
    out, (_, hits, _) = annotate(docs, benchmark, text_col, **kw)
    return out.where(F.size(hits) == 0).drop(*out.columns[len(docs.columns):])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with each run of hit words, and what lies between them, cut out of the text."""
    out, names = annotate(docs, benchmark, text_col, **kw)
    at, width = docs.columns.index(text_col), len(docs.columns)

    def cut(batches):
        for b in batches:
            col = b.column(at)
            texts = []
            for v, hits in zip(col, b.column(width + 1)):
                h = np.array(hits.as_py() or [], np.int64)
                if not len(h):
                    texts.append(v.as_py())
                    continue
                raw = v.as_py().encode()
                w = C.Words(pa.array([v.as_py()], pa.large_string()), C.ALNUM_WORD, True)
                run = np.flatnonzero(np.diff(h) > 1)
                begin, end = h[np.concatenate(([0], run + 1))], h[np.concatenate((run, [len(h) - 1]))]
                kept, pos = [], 0
                for s, e in zip(w.starts[begin], w.ends[end]):
                    kept.append(raw[pos:s])
                    pos = e
                texts.append(b"".join([*kept, raw[pos:]]).decode())
            cols = list(b.columns[:width])
            cols[at] = pa.array(texts, col.type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:width])

    return out.mapInArrow(cut, docs.schema)
