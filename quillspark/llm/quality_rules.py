"""Quality rules: hashed n-gram log-likelihood ratio.

Two multinomials over ``buckets`` hash buckets of word 1- and 2-grams are
counted over *all* rows: the raw corpus, and the trusted target (the rows a
label table marks as good).  A document's score is the mean, over its n-grams,
of log(p_target / p_raw), and the document passes when it is at least
``threshold``; plain rules on length and repetition come first.  A bucket's
ratio is taken between its target count and the count the raw corpus makes
expected, each plus ``smoothing``: a few n-grams more or less say nothing, so a
small target does not turn rare words into evidence.

A mean hides one toxic passage in a long text, and toxic texts are good prose
otherwise.  So the rows labelled toxic are held against the trusted ones as
well: in how many *documents* of either kind a bucket occurs, which a text that
repeats itself cannot drive.  Each n-gram has a bucket in ``ROWS`` independent
hashes and counts with its smallest log ratio, so sharing one bucket with a
toxic word is no evidence.  A document fails when its worst n-gram reaches
``TOXIC``, however long it is.  An n-gram that few labelled toxic rows hold
(``SMOOTHING`` of them, about) is not known; nor are languages without
labelled toxic rows.

Scale: counting is one scan; each task sends one row per bucket it saw
(``buckets`` at most), so the shuffle does not grow with the text.  The weight
table has exactly ``buckets`` doubles (512 kB at the default): that bound is
what allows it to travel with the tasks.  Scoring is a second scan without a
shuffle.  Only the marked rows' texts are joined to the labels, once for both
contrasts; the toxic table has ``ROWS * buckets`` doubles.

Defined results: null and empty texts have no words, so they fail the base
rules; a very long text is measured whole by one task; a score equal to the
threshold passes; an empty table gives no rows; repeated rows are judged one by one; an empty target or corpus gives
weight 0 everywhere, as does a corpus without toxic or without trusted rows for
the toxic contrast; other columns of the input are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 1 << 16
#: Mean log-likelihood ratio per n-gram from which a document is kept.
THRESHOLD = -0.2
#: Added to every bucket's counts, in n-grams of the target.
SMOOTHING = 5.0
#: Log ratio of toxic to trusted documents of the worst n-gram, from which a
#: document is dropped; set on held-out labelled rows (README).
TOXIC = 1.0
#: Independent hashes of an n-gram in the toxic contrast.
ROWS = 2
MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PCT = 20
#: Symbol characters counted by the rules.
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _grams(w: C.Words, buckets: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every 1- and 2-gram of the slice."""
    h = w.hashes(seed)
    s2, d2 = w.windows(2)
    two = C.mix(h[s2] * C.U64(3) + h[s2 + 1] if len(s2) else np.zeros(0, C.U64))
    doc = np.concatenate((w.doc, d2))
    return doc, (np.concatenate((h, two)) >> C.U64(64 - int(buckets).bit_length() + 1)).astype(np.int64)


def gram_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): n-grams per bucket over every row of ``texts(text)``."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for _, col in C.batches_of(batches, "text"):
            _, b = _grams(C.Words(col, C.SPACE_WORD, False), buckets)
            total += np.bincount(b, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of the rows whose labels say good quality and not toxic."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc_id"))
    # a merge join at every size: whether labels could be broadcast must not decide what is moved
    return docs.join(good.distinct().hint("merge"), "doc_id", "left_semi").select("text")


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, good, toxic) of the labelled rows of either kind; toxic wins where a
    document has both labels, but ``good`` is as in ``trusted``."""
    flags = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.expr("coalesce(quality = 1 and coalesce(toxic, 0) = 0, false)").alias("good"),
                          F.expr("coalesce(toxic = 1, false)").alias("toxic")).where("good or toxic")
    flags = flags.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return docs.join(flags.hint("merge"), "doc_id").select("text", "good", "toxic")


#: Sums of ``marked_counts``: n-grams of good texts, then documents with a bucket
#: of each hash among the good ones and among the toxic ones.
SUMS = ("good", *(f"{kind}_{k}" for kind in ("clean", "toxic") for k in range(ROWS)))


def marked_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, *SUMS) over ``marked`` texts; bucket -1 has the documents in all."""

    def count(batches):
        total = np.zeros((len(SUMS), buckets + 1), np.int64)  # the last place: all documents
        for b, col in C.batches_of(batches, "text"):
            good, toxic = (b.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("good", "toxic"))
            kinds = good & ~toxic, toxic
            w = C.Words(col, C.SPACE_WORD, False)
            for k in range(ROWS):
                doc, bucket = _grams(w, buckets, k)
                if k == 0:
                    total[0, :-1] += np.bincount(bucket[good[doc]], minlength=buckets)
                doc, bucket = np.divmod(np.unique(doc * buckets + bucket), buckets)
                for j, kind in enumerate(kinds):
                    at = total[1 + j * ROWS + k]
                    at[:-1] += np.bincount(bucket[kind[doc]], minlength=buckets)
                    at[-1] += kind.sum()
        seen = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.where(seen == buckets, -1, seen)), *(pa.array(t[seen]) for t in total)], ["bucket", *SUMS])

    rows = texts.select("text", "good", "toxic").mapInArrow(count, "bucket long, " + ", ".join(f"{c} long" for c in SUMS))
    return rows.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in SUMS))


def fit(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Weight of each bucket: log of target count over expected count."""
    return _weights(_raw_counts(target, buckets), _raw_counts(raw, buckets), smoothing)


def _raw_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    n = np.zeros(buckets)
    for r in gram_counts(texts, buckets).collect():  # at most ``buckets`` rows
        n[r["bucket"]] = r["n"]
    return n


def _weights(target: np.ndarray, raw: np.ndarray, smoothing: float) -> np.ndarray:
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log((target + smoothing) / (expected + smoothing))


def learn(raw: DataFrame, docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
          smoothing: float = SMOOTHING) -> tuple[np.ndarray, np.ndarray]:
    """``fit`` of the trusted texts of ``docs``, and the toxic contrast: log of toxic
    documents over expected ones, by hash and bucket."""
    sums = np.zeros((len(SUMS), buckets + 1))
    for r in marked_counts(marked(docs, labels), buckets).collect():  # at most ``buckets`` rows and one
        sums[:, r["bucket"]] = [r[c] for c in SUMS]
    weights = _weights(sums[0, :-1], _raw_counts(raw, buckets), smoothing)
    clean, toxic = sums[1:1 + ROWS], sums[1 + ROWS:]
    n_clean, n_toxic = clean[0, -1], toxic[0, -1]
    if not n_clean or not n_toxic:
        return weights, np.zeros((ROWS, buckets))
    ratio = n_toxic / n_clean
    some = smoothing * max(1.0, ratio)  # a few documents of the smaller kind say nothing
    return weights, np.log((toxic[:, :-1] + some) / (clean[:, :-1] * ratio + some))


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "llr double, toxic_llr double, base_failed boolean, kept boolean")


def measure(col: pa.LargeStringArray, weights: np.ndarray, threshold: float = THRESHOLD,
            toxicity: np.ndarray | None = None, toxic: float = TOXIC) -> dict[str, np.ndarray]:
    """All measures of a slice of texts; without ``toxicity`` no n-gram is toxic."""
    w = C.Words(col, C.SPACE_WORD, False)
    n = w.counts
    chars = w.isw & ((w.data & 0xC0) != 0x80)
    word_chars, symbols = C.sums_by(w.off, chars), C.sums_by(w.off, _SYMBOL[w.data])

    # lines: same bytes, same document, at least one word
    nl = w.data == 0x0A
    size = len(w.data)
    starts = np.union1d(np.flatnonzero(nl) + 1, w.off[:-1])
    starts = starts[starts < size]
    ends = np.minimum(np.append(starts[1:], size), size)
    ends -= (nl[ends - 1] & (ends > starts)) if size else 0
    wordy = C.sums_by(np.append(starts, size), w.isw) > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[wordy], ends[wordy]
    line_doc = np.searchsorted(w.off, starts, side="right") - 1
    lh = C.byte_hash(w.data, starts, ends, 1) + C.mix(line_doc.astype(C.U64))
    order = np.argsort(lh, kind="stable")
    again = np.ones(len(lh), bool)
    again[C.bounds(lh[order])] = False
    dup_lines = np.bincount(line_doc[order][again], minlength=w.n_docs)

    # words inside windows that occur twice or more in their text
    h = w.hashes()
    ws, wd = w.windows(REPEAT_WINDOW)
    wh = C.window_hash(h, ws, REPEAT_WINDOW) + C.mix(wd.astype(C.U64) + C.U64(7))
    order = np.argsort(wh)
    b = C.bounds(wh[order])
    many = np.repeat(np.diff(np.append(b, len(wh))) > 1, np.diff(np.append(b, len(wh))))
    hit = C.covered(len(h), ws[order][many], REPEAT_WINDOW)
    repeat = C.sums_by(w.first, hit)

    doc, bucket = _grams(w, len(weights))
    total = np.bincount(doc, weights=weights[bucket], minlength=w.n_docs)
    llr = total / np.maximum(np.bincount(doc, minlength=w.n_docs), 1)
    worst = np.zeros(w.n_docs)
    if toxicity is not None:
        ratio = toxicity[0][bucket]
        for k in range(1, len(toxicity)):
            ratio = np.minimum(ratio, toxicity[k][_grams(w, toxicity.shape[1], k)[1]])
        np.maximum.at(worst, doc, ratio)
    failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * n)
    return {"n_words": n.astype(np.int64), "word_chars": word_chars, "n_symbols": symbols,
            "n_dup_lines": dup_lines.astype(np.int64), "n_repeat_words": repeat, "llr": llr, "toxic_llr": worst,
            "base_failed": failed, "kept": ~failed & (llr >= threshold) & (worst < toxic)}


def judge(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD,
          toxicity: np.ndarray | None = None, toxic: float = TOXIC) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: the measures and the verdict."""

    def score(batches):
        for b, col in C.batches_of(batches, "text"):
            m = measure(col, weights, threshold, toxicity, toxic)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, m.values())], ["doc_id", *m])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id long, {MEASURES}")


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text",
              threshold: float = THRESHOLD, toxicity: np.ndarray | None = None, toxic: float = TOXIC) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they were."""
    at = docs.columns.index(text_col)

    def keep(batches):
        for b in batches:
            col = C.texts_of(b.column(at))
            for i, j in C.slices(col):
                m = measure(col.slice(i, j - i), weights, threshold, toxicity, toxic)
                yield b.slice(i, j - i).filter(pa.array(m["kept"]))

    return docs.mapInArrow(keep, docs.schema)
