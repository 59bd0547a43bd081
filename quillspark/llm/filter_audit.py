"""Filter interaction audit: what each filter removes in every order of
application, and its Shapley value by exact constrained least squares.

Every row fails some subset of the filters.  Rows are counted per part and
subset (at most ``2 ** 5`` counts a part, all and labelled ones), which gives
the removals v(S) of all 32 coalitions: rows that fail a filter of S.  Whatever
order is asked for, a step removes v(S with the filter) - v(S).

The Shapley values are the solution of the least-squares problem
``min sum_S k(S) (v(S) - sum_{i in S} phi_i) ** 2`` over the proper coalitions,
with the Shapley kernel ``k(S) = (m - 1) / (C(m, s) s (m - s))`` and the
efficiency constraint ``sum phi = v(all)``.  Its normal equations (with the
constraint's multiplier) are the same for every part but for the right-hand
side, so they are solved once, in rationals, as a matrix from removals to
values; times ``m!`` all entries are whole numbers.

Scale: one scan of the texts; only (id, text hash, flags) move.  Equal texts are
merged before they meet: per (text, id), then per (text, part, labels), so a
text that a third of all rows hold is a few rows per task.  Labels are merged
per id.  The counts of a part are one row; ``120 * 5`` result rows are made from
it.  The driver sees nothing.

Defined results: a null text counts as empty (it fails A only, and E after the
first such row); a very long text is one row like any other (its distinct words
are held by one task); a null part is the empty string; a null id counts as
larger than all others and has no labels; rows with equal ids and equal texts
are no copies of each other; several labels of one id count as one, set when any
of them is; labels without a document are not looked at; other columns, of
whatever name, are not read; an empty table gives no rows.  Texts are compared
by SHA-256.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import NULL_ID

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_UPPER_PCT = 2
#: The symbols of filter D, and the separators of words.
SYMBOLS = "[#$%&*|]"
SEPARATORS = "\t\n\x0b\x0c\r"
#: Parts turned into result rows at once.
PARTS = 64

RESULT = ("part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_failures(docs: DataFrame) -> DataFrame:
    """(id, part, sha, mask) of ``docs(doc_id, text, part)``; mask: bits of the failed
    filters A to D, which a text alone decides."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("part", F.lit("")).alias("part"))
    words = F.array_remove(F.split(F.translate("text", SEPARATORS, " " * len(SEPARATORS)), " "), "")
    d = d.select("*", words.alias("words"))
    no_upper = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    size = F.length("text").cast("long")
    failed = (F.size("words") < MIN_WORDS,
              100 * F.size(F.array_distinct("words")).cast("long") < MIN_DISTINCT_PCT * F.size("words").cast("long"),
              100 * (size - F.length(no_upper)) > MAX_UPPER_PCT * size,
              F.col("text").rlike(SYMBOLS))
    mask = sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(failed)), F.lit(0))
    return d.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("sha"), mask.alias("mask"))


def flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic), one row an id."""
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
                        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic")).where("doc_id is not null and (good or toxic)")
    return one.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))


def tabulate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows per part and exact set of failed filters."""
    rows = text_failures(docs)
    # a null id has no labels: such rows need not meet in the join
    known = rows.where("doc_id is not null").join(flags(labels), "doc_id", "left")
    known = known.select(F.col("doc_id").alias("id"), "part", "sha", "mask", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    none = rows.where("doc_id is null").select(F.lit(NULL_ID).alias("id"), "part", "sha", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    one = known.union(none).groupBy("sha", "id", "part", "good", "toxic").agg(F.count(F.lit(1)).alias("n"), F.min("mask").alias("mask"))
    kind = one.groupBy("sha", "part", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("lead"), F.min("mask").alias("mask"))
    first = kind.groupBy("sha").agg(F.min("lead.id").alias("first"))
    fresh = F.when(F.col("lead.id") == F.col("first"), F.col("lead.n")).otherwise(0)
    both = kind.join(first, "sha").select("part", "mask", "good", "toxic", "n", fresh.alias("fresh"))
    copy = 1 << FILTERS.index("E")
    split = both.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("fresh").alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")))).alias("e"))
    return (split.select("part", "good", "toxic", "e.*").where("n > 0").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


def solve(matrix: list[list[Fraction]]) -> list[list[Fraction]]:
    """Inverse of a matrix of rationals (Gauss-Jordan)."""
    n = len(matrix)
    rows = [[*map(Fraction, row), *(Fraction(int(i == j)) for j in range(n))] for i, row in enumerate(matrix)]
    for c in range(n):
        pivot = next(r for r in range(c, n) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n):
            if r != c and rows[r][c]:
                f = rows[r][c]
                rows[r] = [x - f * y for x, y in zip(rows[r], rows[c])]
    return [row[n:] for row in rows]


def shapley_matrix(m: int = len(FILTERS)) -> np.ndarray:
    """(filter, coalition) whole numbers: times the removals of all coalitions they
    give ``m!`` times the Shapley values."""
    every = (1 << m) - 1
    kernel = [Fraction(0)] * (every + 1)
    for s in range(1, every):
        k = s.bit_count()
        kernel[s] = Fraction(m - 1, comb(m, k) * k * (m - k))
    has = [[s >> i & 1 for s in range(every + 1)] for i in range(m)]
    normal = [[sum((kernel[s] for s in range(every + 1) if has[i][s] and has[j][s]), Fraction(0)) for j in range(m)] + [Fraction(1)] for i in range(m)]
    inverse = solve([*normal, [*[Fraction(1)] * m, Fraction(0)]])
    out = np.zeros((m, every + 1), np.int64)
    for i in range(m):
        for s in range(1, every + 1):
            x = inverse[i][m] if s == every else sum((inverse[i][j] * kernel[s] for j in range(m) if has[j][s]), Fraction(0))
            if (x * factorial(m)).denominator != 1:
                raise ArithmeticError("Shapley weights times m! are whole numbers")
            out[i, s] = int(x * factorial(m))
    return out


def steps(order: str) -> list[tuple[int, int, int]]:
    """(filter, coalition before, coalition after) of each step."""
    out, before = [], 0
    for letter in order:
        i = FILTERS.index(letter)
        out.append((i, before, before | 1 << i))
        before |= 1 << i
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result rows of ``docs(doc_id, text, part)``: one per part, order and step."""
    counted = tabulate(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))  # 32 at most
    every = 1 << len(FILTERS)
    masks = np.arange(every)
    # removals of each coalition: rows that fail one of its filters
    meets = ((masks[:, None] & masks[None, :]) > 0).astype(np.int64)
    weights = shapley_matrix()
    orders = ["".join(p) for p in permutations(FILTERS)]
    plan = [(o, k + 1, *s) for o in orders for k, s in enumerate(steps(o))]
    own, before, after = (np.array([p[c] for p in plan]) for c in (2, 3, 4))

    def rows(batches):
        for b in batches:
            for at in range(0, b.num_rows, PARTS):
                some = b.slice(at, PARTS)
                counts = np.zeros((3, some.num_rows, every), np.int64)
                for p, found in enumerate(some.column("counts").to_pylist()):
                    for c in found:
                        counts[:, p, c["mask"]] = c["n"], c["good"], c["toxic"]
                total = counts[0].sum(axis=1, keepdims=True)
                v, good, toxic = counts @ meets
                removed = v[:, after] - v[:, before]
                part = some.column("part").take(pa.array(np.repeat(np.arange(some.num_rows), len(plan))))
                again = some.num_rows
                columns = [total - v[:, after], removed, v[:, 1 << own] - removed, counts[0][:, 1 << own],
                           good[:, after] - good[:, before], toxic[:, after] - toxic[:, before], (v @ weights.T)[:, own]]
                yield pa.RecordBatch.from_arrays(
                    [part, pa.array([p[0] for p in plan] * again), pa.array([p[1] for p in plan] * again, pa.int32()),
                     pa.array([FILTERS[i] for i in own] * again), *(pa.array(c.ravel()) for c in columns)],
                    [c.split()[0] for c in RESULT.split(", ")])

    return counted.mapInArrow(rows, RESULT)
