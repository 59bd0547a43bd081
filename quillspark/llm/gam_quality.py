"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes ``FEATURES`` numbers; each number is cut into at most
``BINS`` bins.  Training is cyclic gradient boosting on the logistic loss: round
after round, one shallow tree (at most ``LEAVES`` leaves) per feature is fitted
to the bins' gradients and added, shrunk, to that feature's lookup table; then
the same for the feature pairs with the strongest remaining interaction, with
one cut on each side.  A score is the intercept plus one table entry per
feature and pair - additions of looked-up values only, vectorised per batch.

Scale: scoring is one scan without a shuffle.  The model is fitted on at most
``SAMPLE`` labelled rows (a documented bound: the rows with the smallest
xxhash64 of the id), whose features - not texts - reach the driver; the chosen
ids, ``SAMPLE`` longs, are the only broadcast.

Defined results: null and empty texts get the features of an empty text and so
a score; no training rows gives score 0.5; one class only gives a score near
that class; repeated rows are scored one by one; a very long text is measured
whole by one task; training rows with equal hashes of their ids are taken by id; an
empty table gives no rows; only id and text of the documents are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 20_000
BINS = 48
PAIR_BINS = 12
LEAVES = 3
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.15
RIDGE = 1.0
FOLDS = 5
CUT = 0.3

FEATURES = ("log_words", "log_bytes", "mean_word", "long_words", "short_words", "upper", "title_words", "digits",
            "symbols", "marks", "stops", "spaces", "non_ascii", "new_lines", "mean_line", "dup_lines",
            "distinct_words", "twin_words", "repeat_words", "byte_entropy", "bar", "angle")


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_UPPER = _mask(bytes(range(0x41, 0x5B)))
_DIGIT = _mask(b"0123456789")
_SYM = _mask(b"#*$%&@^~_=+/\\")
_MARK = _mask(b"!?;:")
_STOP = _mask(b".,")
_ANGLE = _mask(b"<>{}[]")


def featurise(col: pa.LargeStringArray) -> np.ndarray:
    """(texts, features) of a slice of texts."""
    w = C.Words(col, C.SPACE_WORD, False)
    n, nd = w.counts, w.n_docs
    size = np.diff(w.off)
    per_byte, per_word = np.maximum(size, 1), np.maximum(n, 1)

    def share(mask):
        return C.sums_by(w.off, mask[w.data]) / per_byte

    lengths = w.ends - w.starts
    starts_upper = _UPPER[w.data[w.starts]] if len(lengths) else np.zeros(0, bool)
    h = w.hashes()
    doc = w.doc
    keyed = C.mix(h + C.mix(doc.astype(C.U64)))
    order = np.argsort(keyed)
    b = C.bounds(keyed[order])
    distinct = np.bincount(doc[order][b], minlength=nd)
    s2, d2 = w.windows(2)
    twins = np.bincount(d2[h[s2] == h[s2 + 1]], minlength=nd)
    s5, d5 = w.windows(5)
    wh = C.window_hash(h, s5, 5) + C.mix(d5.astype(C.U64))
    order = np.argsort(wh)
    b = C.bounds(wh[order])
    runs = np.diff(np.append(b, len(wh)))
    hit = C.covered(len(h), s5[order][np.repeat(runs > 1, runs)], 5)

    nl = w.data == 0x0A
    lines = C.sums_by(w.off, nl) + 1
    ls = np.union1d(np.flatnonzero(nl) + 1, w.off[:-1])
    ls = ls[ls < len(w.data)]
    le = np.append(ls[1:], len(w.data))
    ld = np.searchsorted(w.off, ls, side="right") - 1
    lh = C.byte_hash(w.data, ls, le, 1) + C.mix(ld.astype(C.U64))
    order = np.argsort(lh)
    again = np.ones(len(lh), bool)
    again[C.bounds(lh[order])] = False
    dup = np.bincount(ld[order][again], minlength=nd)

    entropy = np.zeros(nd)
    for d in range(nd):
        c = np.bincount(w.data[w.off[d]:w.off[d + 1]], minlength=1)
        c = c[c > 0]
        if len(c):
            entropy[d] = np.log2(c.sum()) - (c * np.log2(c)).sum() / c.sum()

    return np.column_stack([
        np.log1p(n), np.log1p(size), C.sums_by(w.first, lengths) / per_word,
        C.sums_by(w.first, lengths > 14) / per_word, C.sums_by(w.first, lengths < 3) / per_word,
        share(_UPPER), C.sums_by(w.first, starts_upper) / per_word, share(_DIGIT), share(_SYM), share(_MARK),
        share(_STOP), 1 - C.sums_by(w.off, w.isw) / per_byte, share(C.ALNUM_WORD) - share(C.ALNUM_WORD & (np.arange(256) < 128)),
        lines / per_word, np.log1p(size / lines), dup / lines, distinct / per_word, twins / per_word,
        C.sums_by(w.first, hit) / per_word, entropy, share(_mask(b"|")), share(_ANGLE)])


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _steps(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf value of every bin of the best shallow tree on binned gradients."""
    edges = [0, len(g)]
    cg, ch = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))

    def worth(i, j):
        return (cg[j] - cg[i]) ** 2 / (ch[j] - ch[i] + RIDGE)

    for _ in range(leaves - 1):
        best = (1e-9, None)
        for i, j in zip(edges[:-1], edges[1:]):
            if j - i < 2:
                continue
            k = np.arange(i + 1, j)
            gain = worth(i, k) + worth(k, j) - worth(i, j)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (gain[at], int(k[at]))
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.empty(len(g))
    for i, j in zip(edges[:-1], edges[1:]):
        out[i:j] = (cg[j] - cg[i]) / (ch[j] - ch[i] + RIDGE)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree with one cut on each axis of a 2-d table of gradients: gain, leaf values."""
    cg = np.pad(g, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    ch = np.pad(h, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")

    def quarters(c):
        a = c[i, j]
        top, left, all_ = c[i, -1], c[-1, j], c[-1, -1]
        return np.stack([a, top - a, left - a, all_ - top - left + a])

    qg, qh = quarters(cg), quarters(ch)
    if qg.size == 0:
        return 0.0, np.zeros_like(g)
    gain = (qg ** 2 / (qh + RIDGE)).sum(0)
    at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    leaf = qg[(slice(None), *at)] / (qh[(slice(None), *at)] + RIDGE)
    out = np.empty_like(g)
    a, b = at[0] + 1, at[1] + 1
    out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = leaf
    return float(gain[at] - cg[-1, -1] ** 2 / (ch[-1, -1] + RIDGE)), out


class Model:
    """Intercept, per-feature tables and pair tables."""

    def __init__(self):
        self.base = 0.0
        self.cuts: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.pair_cuts: list[np.ndarray] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Model:
        if not len(y):
            return self
        p = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(p / (1 - p)))
        self.cuts = [_cuts(c, BINS) for c in x.T]
        bins = [np.searchsorted(c, v) for c, v in zip(self.cuts, x.T)]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        raw = np.full(len(y), self.base)

        def gradients():
            q = 1 / (1 + np.exp(-raw))
            return y - q, np.maximum(q * (1 - q), 1e-6)

        for _ in range(ROUNDS):
            for f, b in enumerate(bins):
                g, h = gradients()
                size = len(self.tables[f])
                step = RATE * _steps(np.bincount(b, g, size), np.bincount(b, h, size), LEAVES)
                self.tables[f] += step
                raw += step[b]
        self.pair_cuts = [_cuts(c, PAIR_BINS) for c in x.T]
        coarse = [np.searchsorted(c, v) for c, v in zip(self.pair_cuts, x.T)]
        sizes = [len(c) + 1 for c in self.pair_cuts]

        def table(i, j):
            g, h = gradients()
            at, n = coarse[i] * sizes[j] + coarse[j], sizes[i] * sizes[j]
            return _cross(np.bincount(at, g, n).reshape(sizes[i], sizes[j]),
                          np.bincount(at, h, n).reshape(sizes[i], sizes[j]))

        ranked = sorted(((table(i, j)[0], i, j) for i in range(len(bins)) for j in range(i)), reverse=True)[:PAIRS]
        self.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for gain, i, j in ranked if gain > 0]
        for _ in range(PAIR_ROUNDS):
            for i, j, t in self.pairs:
                step = RATE * table(i, j)[1]
                t += step
                raw += step[coarse[i], coarse[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        for c, t, v in zip(self.cuts, self.tables, x.T):
            raw += t[np.searchsorted(c, v)]
        for i, j, t in self.pairs:
            raw += t[np.searchsorted(self.pair_cuts[i], x[:, i]), np.searchsorted(self.pair_cuts[j], x[:, j])]
        return 1 / (1 + np.exp(-raw))


def held_out():
    """Condition on ``doc_id``: rows never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) of every row of ``docs(doc_id, text)``."""

    def rows(batches):
        for b, col in C.batches_of(batches, "text"):
            x = featurise(col)
            flat = pa.array(np.ascontiguousarray(x).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), lists], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, x array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # the broadcast side has at most ``sample`` rows of two numbers
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    rows = (features(picked).join(F.broadcast(chosen), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).collect())
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return Model().fit(x, np.array([float(r["quality"]) for r in rows]))


def score(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``."""

    def rows(batches):
        for b, col in C.batches_of(batches, "text"):
            s = model.score(featurise(col))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"))
