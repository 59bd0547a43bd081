"""Running (prefix) aggregates that stay parallel inside a huge partition.

A running min/max/count over ``Window.partitionBy(run).orderBy(step)`` puts a
whole run into one task.  When one run may hold a third of all rows, the
order key is cut into chunks: each (run, chunk) computes its own total, a
window over the small chunk table gives every chunk the total of all earlier
chunks (the carry), and the running value inside a chunk combines that carry
with a window over the chunk only.  Results equal the plain window exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _add(a, b):
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


# how -> (row aggregate, aggregate of chunk totals, combine carry with in-chunk value)
_COMBINE = {
    "min": (F.min, F.min, F.least),
    "max": (F.max, F.max, F.greatest),
    "sum": (F.sum, F.sum, _add),
    "count": (F.count, F.sum, _add),
}


def prefix_aggs(df: DataFrame, part: Sequence[str], order: str, specs, chunk: int | None = 4096) -> DataFrame:
    """Several running aggregates in one pass.

    ``specs``: iterable of ``(value, how, out, inclusive)``; each adds ``out`` =
    ``how`` (min/max/sum/count) of ``value`` over the rows of the same
    ``part`` that come before (``inclusive``: up to and including) the current
    row in ``order`` (unique within a partition).  ``chunk`` is the width of an
    order-key chunk; ``None`` uses plain windows.
    """
    part = list(part)
    specs = [(F.col(v) if isinstance(v, str) else v, how, out, inc) for v, how, out, inc in specs]
    if chunk is None:
        cols = {}
        for v, how, out, inc in specs:
            agg = _COMBINE[how][0]
            w = Window.partitionBy(*part).orderBy(order).rowsBetween(
                Window.unboundedPreceding, Window.currentRow if inc else -1)
            res = agg(v).over(w)
            cols[out] = F.coalesce(res, F.lit(0)) if how in ("sum", "count") else res
        return df.withColumns(cols)
    # integer division, exact at every size; a plain % keeps the sign, so shift negatives down
    step = F.col(order).cast("bigint")
    d = df.withColumn("_chunk", F.expr(f"({{}}) div {int(chunk)}".format(f"cast(`{order}` as bigint)"))
                      - F.when(step % chunk < 0, 1).otherwise(0))
    d = d.withColumns({f"_v{i}": v for i, (v, _, _, _) in enumerate(specs)})
    # one exchange by (part, chunk) feeds the in-chunk windows; the chunk totals
    # are a partial aggregate of the same rows
    d = d.repartition(*part, "_chunk")
    totals = d.groupBy(*part, "_chunk").agg(*[_COMBINE[how][0](f"_v{i}").alias(f"_t{i}")
                                              for i, (_, how, _, _) in enumerate(specs)])
    before = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*part, "_chunk", *[_COMBINE[how][1](f"_t{i}").over(before).alias(f"_c{i}")
                                             for i, (_, how, _, _) in enumerate(specs)])
    # null-safe: a null run id is a run of its own
    names = part + ["_chunk"]
    carry = carry.withColumnsRenamed({c: f"_p_{c}" for c in names})
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    j = d.join(carry, same, "left").drop(*[f"_p_{c}" for c in names])
    cols = {}
    for i, (_, how, out, inc) in enumerate(specs):
        agg, _, combine = _COMBINE[how]
        inner = Window.partitionBy(*part, "_chunk").orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow if inc else -1)
        res = combine(F.col(f"_c{i}"), agg(f"_v{i}").over(inner))
        if how in ("min", "max"):
            res = F.coalesce(res, F.col(f"_c{i}"))
        cols[out] = res
    drop = ["_chunk"] + [f"_{k}{i}" for i in range(len(specs)) for k in "vc"]
    return j.withColumns(cols).drop(*drop)


def prefix_agg(df: DataFrame, part: Sequence[str], order: str, value: Column | str, how: str,
               out: str, inclusive: bool = False, chunk: int | None = 4096) -> DataFrame:
    """One running aggregate (see ``prefix_aggs``)."""
    return prefix_aggs(df, part, order, [(value, how, out, inclusive)], chunk)


def trailing_agg(df: DataFrame, part: Sequence[str], order: str, aggs: dict, width: int,
                 block: int | None = None, chunk: int | None = 4096) -> DataFrame:
    """Window aggregates over the ``width`` rows before each row (a
    ``rowsBetween(-width, -1)`` frame) without one task per partition.

    Rows get their index in ``order`` (chunked prefix count), are cut into
    blocks of ``block`` (>= width) consecutive indices, and the last ``width``
    rows of each block are also copied into the next block as halo rows, so
    every frame is complete inside one (run, block) window partition.  Only
    non-halo rows are returned.  ``aggs`` maps output name -> function of a
    window spec returning a Column, e.g. ``{"m": lambda w: F.avg("x").over(w)}``.
    """
    part = list(part)
    block = max(block or 4 * width, width, 1)
    if chunk is None:
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(-width, -1)
        return df.withColumns({k: f(w) for k, f in aggs.items()})
    d = prefix_agg(df, part, order, F.lit(1), "count", "_idx", inclusive=True, chunk=chunk)
    i0 = F.col("_idx") - 1
    d = d.withColumns({"_blk": F.floor(i0 / F.lit(block)).cast("bigint"), "_pos": i0 % F.lit(block)})
    shift = F.explode(F.when(F.col("_pos") >= F.lit(block - width), F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0))))
    d = d.select("*", shift.alias("_shift")).withColumn("_blk", F.col("_blk") + F.col("_shift"))
    w = Window.partitionBy(*part, "_blk").orderBy("_idx").rowsBetween(-width, -1)
    out = d.withColumns({k: f(w) for k, f in aggs.items()})
    return out.where(F.col("_shift") == 0).drop("_idx", "_blk", "_pos", "_shift")
