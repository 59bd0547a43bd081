"""Training-log analytics (K1-K8): best evaluations, save points, retention,
run summaries, early stopping and spike flags.

Log rows: ``(run_id, global_step, eval_loss)``; every row is one evaluation
event, ``eval_loss`` may be null (an evaluation without a loss).  NaN losses
are treated as null: Spark orders NaN above every number, so a running min
would otherwise differ from the reference's ``<`` comparisons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import prefix_agg, prefix_aggs, trailing_agg

RUN, STEP, LOSS = "run_id", "global_step", "eval_loss"


def clean_loss(df: DataFrame, loss: str = LOSS) -> DataFrame:
    return df.withColumn(loss, F.when(~F.isnan(F.col(loss)), F.col(loss)))


def flag_best(log: DataFrame, chunk: int | None = 4096) -> DataFrame:
    """K1: ``is_best`` — the loss is strictly lower than every earlier loss of
    the run (the first non-null loss counts); null losses never are."""
    d = prefix_agg(clean_loss(log), [RUN], STEP, LOSS, "min", "_prev_best", chunk=chunk)
    best = F.col(LOSS).isNotNull() & (F.col("_prev_best").isNull() | (F.col(LOSS) < F.col("_prev_best")))
    return d.withColumn("is_best", best).drop("_prev_best")


def new_best(log: DataFrame, chunk: int | None = 4096) -> DataFrame:
    """K1 rows: the evaluations that set a new best."""
    return flag_best(log, chunk).where("is_best").select(RUN, STEP, LOSS)


def interval_points(log: DataFrame, n: int | None) -> DataFrame:
    """K3: logged steps on the save cadence (step > 0 and step % n == 0); none when n is falsy."""
    if not n:
        return log.select(RUN, STEP).where(F.lit(False))
    return log.where((F.col(STEP) > 0) & (F.col(STEP) % n == 0)).select(RUN, STEP)


def save_plan(log: DataFrame, n: int | None, chunk: int | None = 4096) -> DataFrame:
    """K4: union of best and interval save points with their reasons."""
    best = new_best(log, chunk).select(RUN, STEP, F.lit("best").alias("reason"))
    inter = interval_points(log, n).withColumn("reason", F.lit("interval"))
    return (best.unionByName(inter).groupBy(RUN, STEP)
            .agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons")))


def retain_last(points: DataFrame, limit: int) -> DataFrame:
    """K5: the newest ``limit`` save points per run.  ``row_number() <= limit``
    is planned with a partial WindowGroupLimit, so a huge run ships only
    ``limit`` rows per task into the exchange."""
    w = Window.partitionBy(RUN).orderBy(F.col(STEP).desc())
    return points.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


def best_checkpoint(log: DataFrame, n: int | None, metric: str = LOSS,
                    higher_is_better: bool = False) -> DataFrame:
    """K2: the final best evaluation per run (best ``metric`` — lowest loss by
    default, or e.g. highest accuracy — earliest step on a tie) and
    ``copied_step``: the last save between it and the next evaluation, whose
    weights end up in the best-checkpoint folder.

    Saves after the best one come from the interval cadence, so the last
    of them is computed arithmetically: the largest multiple of ``n`` below
    the next evaluation step (or up to the run's last logged step).
    """
    c = clean_loss(log, metric)
    m = F.col(metric)
    order = F.struct((-m if higher_is_better else m), F.col(STEP))
    best = (c.where(m.isNotNull()).groupBy(RUN)
            .agg(F.min_by(F.struct(F.col(STEP).alias("s"), m.alias("l")), order).alias("_b"))
            .select(RUN, F.col("_b.s").alias("best_step"), F.col("_b.l").alias("best_loss")))
    after = (c.select(RUN, STEP).join(best, RUN)
             .groupBy(RUN).agg(
                 F.min(F.when(F.col(STEP) > F.col("best_step"), F.col(STEP))).alias("next_eval_step"),
                 F.max(STEP).alias("_last")))
    out = best.join(after, RUN)
    end_excl = F.coalesce(F.col("next_eval_step"), F.col("_last") + 1)
    if n:
        last_mult = F.floor((end_excl - 1) / F.lit(n)).cast("bigint") * F.lit(n)
        copied = F.when((last_mult > 0) & (last_mult >= F.col("best_step")), last_mult).otherwise(F.col("best_step"))
    else:
        copied = F.col("best_step")
    return out.select(RUN, "best_step", "best_loss", "next_eval_step", copied.alias("copied_step"))


def run_metrics(log: DataFrame) -> DataFrame:
    """K6: final and summary metrics per run (one partial/final aggregate)."""
    c = clean_loss(log)
    last = F.max_by(F.struct(F.col(STEP).alias("s"), F.col(LOSS).alias("l")), F.col(STEP))
    return c.groupBy(RUN).agg(
        F.count(F.lit(1)).alias("n_evals"),
        F.count(LOSS).alias("n_with_loss"),
        F.min(STEP).alias("first_step"),
        last.alias("_last"),
        F.min(LOSS).alias("best_loss"),
    ).select(RUN, "n_evals", "n_with_loss", "first_step", F.col("_last.s").alias("last_step"),
             F.col("_last.l").alias("last_loss"), "best_loss")


def early_stop(log: DataFrame, patience: int, chunk: int | None = 4096) -> DataFrame:
    """K7: first evaluation at which ``patience`` evaluations in a row brought
    no new best (null-loss evaluations do not count); null when never.

    ``stale`` = evaluations so far minus the index of the last best.  Two
    chunked prefix passes: (running min of earlier losses, running count of
    evaluations), then the running max of the index of best rows.
    """
    c = clean_loss(log)
    f = prefix_aggs(c, [RUN], STEP, [(LOSS, "min", "_prev_best", False),
                                     (F.when(F.col(LOSS).isNotNull(), F.lit(1)), "count", "_idx", True)], chunk)
    best = F.col(LOSS).isNotNull() & (F.col("_prev_best").isNull() | (F.col(LOSS) < F.col("_prev_best")))
    f = f.withColumn("is_best", best)
    f = prefix_agg(f, [RUN], STEP, F.when(F.col("is_best"), F.col("_idx")), "max", "_last_best",
                   inclusive=True, chunk=chunk)
    f = f.withColumn("stale", F.col("_idx") - F.coalesce(F.col("_last_best"), F.lit(0)))
    stops = (f.where(F.col(LOSS).isNotNull() & (F.col("stale") >= patience))
             .groupBy(RUN).agg(F.min(STEP).alias("stop_step")))
    runs = log.select(RUN).distinct()
    return runs.join(stops, RUN, "left")


def spike_monitor(log: DataFrame, window: int = 20, z: float = 3.0, chunk: int | None = 4096,
                  metric: str = LOSS) -> DataFrame:
    """K8: evaluations whose ``metric`` (loss by default; a gradient norm or a
    learning rate works the same way) is NaN, or above the trailing mean plus
    ``z`` trailing standard deviations of the previous ``window`` rows.
    The trailing frame is computed in bounded blocks (``trailing_agg``), so a
    run holding most of the log is still spread over many tasks."""
    raw = F.col(metric)
    c = F.when(~F.isnan(raw), raw)
    d = trailing_agg(log.withColumn("_c", c), [RUN], STEP,
                     {"trailing_mean": lambda w: F.avg("_c").over(w),
                      "trailing_std": lambda w: F.stddev_samp("_c").over(w)},
                     window, chunk=chunk).drop("_c")
    flag = F.isnan(raw) | (c > F.col("trailing_mean") + F.lit(z) * F.col("trailing_std"))
    return d.where(F.coalesce(flag, F.lit(False))).select(RUN, STEP, metric, "trailing_mean", "trailing_std")
