"""Reproducible ordering, sampling and splitting.

Draws never use ``rand()``/``sample()``: every row gets a key
``md5(seed # id columns)``, so a draw is the same for any partitioning, input
order or cluster size, and the oracle (DuckDB ``md5``) can reproduce it.

Ranking inside large groups avoids one-task windows: the leading hex digits of
the key cut each group into buckets, as many digits as the number of rows asks
for (``BUCKET_ROWS``).  A small table of counts per (group, bucket) gives each
bucket its offset, and ``row_number`` runs only inside a bucket.  Because the key
is a hash, buckets are even whatever the group sizes, so a level holding a third
of the rows is spread over as many tasks as its rows need.  Rows and offsets meet
in an ordinary join on the window's own keys: no further exchange, and broadcast
only where the runtime size is below the session's threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def hash_key(seed: int, *cols, salt: str = "") -> Column:
    """md5 of seed, ids and the operator's own ``salt``: two operators with one
    seed must not make the same draw."""
    parts = [F.lit(f"{seed}{salt}")] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("#", *parts))


#: Draws are 52-bit numbers, exact as doubles.
DRAWS = 1 << 52


def hash_unit(seed: int, *cols, salt: str = "") -> Column:
    """Stable integer in [0, ``DRAWS``) from the first 52 bits of the md5 key."""
    return F.conv(F.substring(hash_key(seed, *cols, salt=salt), 1, 13), 16, 10).cast("bigint")


def share(fraction) -> Column:
    """The draw below which a row belongs to a share in [0, 1]."""
    return (F.lit(fraction) if not isinstance(fraction, Column) else fraction) * F.lit(float(DRAWS))


#: Rows of one bucket, about: what a task sorts at once.
BUCKET_ROWS = 1 << 16
#: Hex digits of a bucket number at most (a long).
MAX_DIGITS = 15


def bucket_digits(df: DataFrame, bucket_rows: int = BUCKET_ROWS) -> Column:
    """Leading hex digits of the key that make buckets of ``bucket_rows`` or fewer
    rows: the next whole number above log16(rows / bucket_rows).  A scalar
    subquery, so it follows the data at every size and stays in the plan."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    # one row more would ask for: rows <= bucket_rows * 16 ** digits
    return n.select(F.least(F.lit(MAX_DIGITS), F.greatest(F.lit(0), F.ceil(F.log(
        16.0, F.greatest(F.col("n"), F.lit(1)) / F.lit(float(bucket_rows)))))).cast("int")).scalar()


def with_bucket(df: DataFrame, key: str, bucket_rows: int = BUCKET_ROWS, rows: DataFrame | None = None) -> DataFrame:
    """``_bucket`` from the key's leading digits; ``rows``: a frame with as many rows
    as ``df`` that is cheaper to count."""
    digits = bucket_digits(df if rows is None else rows, bucket_rows)
    number = F.conv(F.concat(F.lit("0"), F.substr(F.col(key), F.lit(1), digits)), 16, 10).cast("bigint")
    return df.withColumn("_bucket", number)


#: Buckets under one sum of the offsets.
BUCKET_GROUP = 1 << 12


def bucket_offsets(b: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Per (group, bucket): rows in earlier buckets of the group (``_off``) and
    the group's size (``_gsize``).  One aggregate over the input, then prefix sums
    in two levels: within ``BUCKET_GROUP`` neighbouring buckets, and over these
    stretches, so that the buckets of one large group are not one task's work."""
    group_cols = list(group_cols)
    counts = b.groupBy(*group_cols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_span", F.floor(F.col("_bucket") / BUCKET_GROUP))
    part = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    spans = counts.groupBy(*group_cols, "_span").agg(F.sum("_n").alias("_t"))
    before = part.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*group_cols, "_span", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start"),
                         F.sum("_t").over(part).alias("_gsize"))
    inside = Window.partitionBy(*group_cols, "_span").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return same_groups(counts, spans, [*group_cols, "_span"]).select(
        *group_cols, "_bucket", (F.col("_start") + F.col("_in")).alias("_off"), "_gsize")


def same_groups(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Join on equal ``cols``, null being equal to null; the columns come once."""
    names = {c: f"_r_{c}" for c in cols}
    cond = [F.col(c).eqNullSafe(F.col(r)) for c, r in names.items()]
    return left.join(right.withColumnsRenamed(names), cond).drop(*names.values())


def rank_in_buckets(joined: DataFrame, group_cols: Sequence[str], key: str, tie_cols: Sequence[str],
                    rank_col: str) -> DataFrame:
    inner = Window.partitionBy(*group_cols, "_bucket").orderBy(key, *tie_cols)
    return joined.withColumn(rank_col, F.col("_off") + F.row_number().over(inner))


def hash_rank(df: DataFrame, group_cols: Sequence[str], key: str, tie_cols: Sequence[str] = (),
              max_rank: int | None = None, rank_col: str = "rank", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """1-based rank of each row within its group, ordered by ``key`` then ``tie_cols``.

    ``max_rank`` drops whole buckets that start past it before any sort.
    """
    group_cols = list(group_cols)
    b = with_bucket(df, key, bucket_rows)
    offsets = bucket_offsets(b, group_cols).drop("_gsize")
    j = same_groups(b, offsets, [*group_cols, "_bucket"])
    if max_rank is not None:
        j = j.where(F.col("_off") < F.lit(max_rank))
    return rank_in_buckets(j, group_cols, key, tie_cols, rank_col).drop("_bucket", "_off")


def seeded_shuffle(df: DataFrame, seed: int = DEFAULT_SEED, id_cols: Sequence[str] = ("dataset", "sample_id"),
                   position_col: str = "position", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """a reproducible permutation, materialised as a 0-based ``position``.

    No global ``Window.orderBy`` (that is a single task): hash buckets that follow
    the number of rows, their offsets, and per-bucket row numbers.
    """
    keyed = df.withColumn("_key", hash_key(seed, *id_cols))
    ranked = hash_rank(keyed, [], "_key", list(id_cols), rank_col="_rank", bucket_rows=bucket_rows)
    return ranked.withColumn(position_col, F.col("_rank") - 1).drop("_rank", "_key")


def sample_per_level(df: DataFrame, n: int = 5, seed: int = DEFAULT_SEED, level: str = "level",
                     id_cols: Sequence[str] = ("sample_id",)) -> DataFrame:
    """up to ``n`` rows per level (all when the level has <= n), with the
    1-based ``sample_index`` of the draw.

    ``row_number() <= n`` lets Spark plan a partial ``WindowGroupLimit`` before
    the exchange, so each task ships at most n rows per level.
    """
    key = hash_key(seed, *id_cols)
    w = Window.partitionBy(level).orderBy(key, *id_cols)
    return (df.withColumn("sample_index", F.row_number().over(w))
              .where(F.col("sample_index") <= n))


MODES = ("sample", "balanced", "full")


def analysis_pass(df: DataFrame, mode: str = "sample", per_level: int = 5, seed: int = DEFAULT_SEED,
                  level: str = "level", id_cols: Sequence[str] = ("sample_id",),
                  bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """one ranked frame, filtered per mode; ``all`` = the three modes
    stacked with an ``analysis`` column (one rank computation, not three).

    Pick counts per mode — sample: min(n, size); balanced: min(smallest
    non-empty size, size); full: size — are columns of the bucket offsets
    table, so sizes, the minimum and the offsets come from one aggregate and
    one join.  Buckets that start past every mode's count are dropped before the
    ranking sort.
    """
    if mode not in MODES + ("all",):
        raise ValueError(f"Unknown mode {mode}")
    if mode == "sample":
        # n per level needs no level sizes: one pass with a partial group limit
        return (sample_per_level(df, per_level, seed, level, id_cols)
                .withColumns({"sample_index": F.col("sample_index").cast("bigint"), "analysis": F.lit("sample")}))
    keyed = df.withColumn("_key", hash_key(seed, *id_cols))
    b = with_bucket(keyed, "_key", bucket_rows)
    offs = bucket_offsets(b, [level])
    offs = offs.withColumn("_min", offs.agg(F.min("_gsize")).scalar())
    offs = offs.select(level, "_bucket", "_off",
                       F.least(F.lit(per_level).cast("bigint"), F.col("_gsize")).alias("n_sample"),
                       F.least(F.col("_min"), F.col("_gsize")).alias("n_balanced"),
                       F.col("_gsize").alias("n_full"))
    modes = MODES if mode == "all" else (mode,)
    j = same_groups(b, offs, [level, "_bucket"])
    limit = F.greatest(*[F.col(f"n_{m}") for m in modes]) if len(modes) > 1 else F.col(f"n_{modes[0]}")
    j = j.where(F.col("_off") < limit)
    ranked = rank_in_buckets(j, [level], "_key", list(id_cols), "sample_index")
    # every row is emitted once per mode that takes it: one pass, no union
    member = F.array_compact(F.array(*[F.when(F.col("sample_index") <= F.col(f"n_{m}"), F.lit(m))
                                       for m in modes]))
    out = ranked.withColumn("analysis", F.explode(member))
    return out.drop("_key", "_bucket", "_off", "n_sample", "n_balanced", "n_full")


def balanced_sample(df: DataFrame, seed: int = DEFAULT_SEED, level: str = "level",
                    id_cols: Sequence[str] = ("sample_id",)) -> DataFrame:
    """every non-empty level cut to the size of the smallest non-empty level."""
    return analysis_pass(df, "balanced", seed=seed, level=level, id_cols=id_cols).drop("analysis")


def full_sample(df: DataFrame) -> DataFrame:
    """all usable rows."""
    return df


SPLIT_NAMES = ("train", "validation", "test")


def split_dataset(df: DataFrame, ratios: Sequence[int] = (8, 1, 1), seed: int = DEFAULT_SEED,
                  id_cols: Sequence[str] = ("dataset", "sample_id"), split_col: str = "split") -> DataFrame:
    """train/validation/test by a 52-bit draw.

    A row's split depends only on its id and the seed, so it is stable across
    partitionings and when rows are added.
    """
    total = float(sum(ratios))
    cuts, acc = [], 0.0
    for r in ratios[:-1]:
        acc += r
        cuts.append(acc / total)
    h = hash_unit(seed, *id_cols, salt=".split")
    expr = F.lit(SPLIT_NAMES[len(ratios) - 1])
    for name, cut in reversed(list(zip(SPLIT_NAMES, cuts))):
        expr = F.when(h < share(cut), F.lit(name)).otherwise(expr)
    return df.withColumn(split_col, expr)


def stratified_sample(df: DataFrame, fractions: Mapping[int, float], seed: int = DEFAULT_SEED,
                      level: str = "level", id_cols: Sequence[str] = ("sample_id",)) -> DataFrame:
    """F8: keep each row with its level's fraction (hash threshold, reproducible)."""
    frac = F.lit(0.0)
    for lv, f in sorted(fractions.items(), reverse=True):
        frac = F.when(F.col(level) == F.lit(lv), F.lit(float(f))).otherwise(frac)
    return df.where(hash_unit(seed, *id_cols, salt=".stratified") < share(frac))


def mix_datasets(df: DataFrame, mode: str = "alternate", weights: Mapping[str, float] | None = None,
                 seed: int = DEFAULT_SEED, dataset: str = "dataset",
                 id_cols: Sequence[str] = ("dataset", "sample_id"), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Mix datasets.

    ``weighted``: keep each row with its dataset's weight (hash threshold).
    ``alternate``: round-robin over datasets in name order, each in hash order;
    ``mix_position`` (0-based) is computed arithmetically from the per-dataset
    sizes (a scalar subquery over a table with one row per dataset), so no
    global sort is needed.
    """
    if mode == "weighted":
        if not weights:
            raise ValueError("weighted mixing needs weights")
        w = F.lit(0.0)
        for d, f in sorted(weights.items()):
            w = F.when(F.col(dataset) == F.lit(d), F.lit(float(f))).otherwise(w)
        return df.where(hash_unit(seed, *id_cols, salt=".mix") < share(w))
    if mode != "alternate":
        raise ValueError(f"Unknown mix mode {mode}")
    keyed = df.withColumn("_key", hash_key(seed, *id_cols))
    b = with_bucket(keyed, "_key", bucket_rows)
    offs = bucket_offsets(b, [dataset])
    ranked = rank_in_buckets(same_groups(b, offs.drop("_gsize"), [dataset, "_bucket"]),
                             [dataset], "_key", list(id_cols), "_r").drop("_bucket", "_off")
    sizes = (offs.groupBy(dataset).agg(F.max("_gsize").alias("n"))
             .agg(F.collect_list(F.struct(F.col(dataset).alias("d"), F.col("n"))).alias("s"))
             .scalar())
    ranked = ranked.withColumn("_sizes", sizes)
    r, d = F.col("_r"), F.col(dataset)
    before = F.aggregate(
        F.col("_sizes"), F.lit(0).cast("bigint"),
        lambda acc, s: acc + F.least(r - 1, s["n"])
        + F.when((s["d"] < d) & (s["n"] >= r), F.lit(1)).otherwise(F.lit(0)))
    return ranked.withColumn("mix_position", before).drop("_key", "_r", "_sizes")
