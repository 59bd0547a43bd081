"""Training-log entry point (K1-K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trainlog as TL
from ..sources import tables as TB
from . import sqltext as Q
from .registry import query

SAVE_STEPS = 200           # save cadence (LoRA configuration)
SAVE_LIMIT = 3             # save_total_limit (LoRA configuration)
PATIENCE = 3
SPIKE_WINDOW = 20
SPIKE_Z = 3.0


def log(spark, sf_dir):
    return TB.fx_trainlog(spark, sf_dir).select("run_id", "global_step", "eval_loss")


CLEAN = "SELECT run_id, global_step, CASE WHEN isnan(eval_loss) THEN NULL ELSE eval_loss END AS eval_loss FROM fx_trainlog"
FLAGS = """SELECT *, eval_loss IS NOT NULL AND (prev IS NULL OR eval_loss < prev) AS is_best FROM (
  SELECT *, min(eval_loss) OVER (PARTITION BY run_id ORDER BY global_step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM clean)"""
LOG_VIEWS = dict(fx_trainlog=Q.FX_TRAINLOG, clean=CLEAN, flags=FLAGS)
BEST_SQL = "SELECT run_id, global_step, eval_loss FROM flags WHERE is_best"
INTERVAL_SQL = f"SELECT run_id, global_step FROM clean WHERE global_step > 0 AND global_step % {SAVE_STEPS} = 0"
PLAN_SQL = f"""SELECT run_id, global_step, string_agg(reason, ',' ORDER BY reason) AS reasons FROM (
  SELECT run_id, global_step, 'best' AS reason FROM ({BEST_SQL})
  UNION ALL SELECT run_id, global_step, 'interval' AS reason FROM ({INTERVAL_SQL}))
GROUP BY run_id, global_step"""


@query("new_best", Q.with_views(BEST_SQL, **LOG_VIEWS))
def new_best(spark, sf_dir):
    return TL.new_best(log(spark, sf_dir))


@query("interval", Q.with_views(INTERVAL_SQL, **LOG_VIEWS))
def interval(spark, sf_dir):
    return TL.interval_points(log(spark, sf_dir), SAVE_STEPS)


@query("save_plan", Q.with_views(PLAN_SQL, **LOG_VIEWS))
def save_plan(spark, sf_dir):
    return TL.save_plan(log(spark, sf_dir), SAVE_STEPS)


@query("retained", Q.with_views(f"""
SELECT run_id, global_step, reasons FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY global_step DESC) AS rn FROM plan)
WHERE rn <= {SAVE_LIMIT}
""", **LOG_VIEWS, plan=PLAN_SQL))
def retained(spark, sf_dir):
    return TL.retain_last(TL.save_plan(log(spark, sf_dir), SAVE_STEPS), SAVE_LIMIT)


@query("best_checkpoint", Q.with_views(f"""
SELECT b.run_id, b.best_step, b.best_loss, a.next_eval_step,
  CASE WHEN lm > 0 AND lm >= b.best_step THEN lm ELSE b.best_step END AS copied_step
FROM (SELECT run_id, arg_min(global_step, (eval_loss, global_step)) AS best_step, min(eval_loss) AS best_loss
      FROM clean WHERE eval_loss IS NOT NULL GROUP BY run_id) b
JOIN (SELECT c.run_id, min(CASE WHEN c.global_step > b2.bs THEN c.global_step END) AS next_eval_step,
             max(c.global_step) AS last_step
      FROM clean c JOIN (SELECT run_id, arg_min(global_step, (eval_loss, global_step)) AS bs FROM clean
                         WHERE eval_loss IS NOT NULL GROUP BY run_id) b2 ON b2.run_id = c.run_id
      GROUP BY c.run_id) a ON a.run_id = b.run_id,
LATERAL (SELECT CAST(floor((coalesce(a.next_eval_step, a.last_step + 1) - 1) / {SAVE_STEPS}) AS BIGINT) * {SAVE_STEPS} AS lm)
""", **LOG_VIEWS))
def best_checkpoint(spark, sf_dir):
    return TL.best_checkpoint(log(spark, sf_dir), SAVE_STEPS)


@query("run_metrics", Q.with_views("""
SELECT run_id, count(*) AS n_evals, count(eval_loss) AS n_with_loss, min(global_step) AS first_step,
       max(global_step) AS last_step, arg_max({'l': eval_loss}, global_step).l AS last_loss,
       min(eval_loss) AS best_loss
FROM clean GROUP BY run_id
""", **LOG_VIEWS))
def run_metrics(spark, sf_dir):
    return TL.run_metrics(log(spark, sf_dir))


@query("early_stop", Q.with_views(f"""
SELECT r.run_id, s.stop_step FROM (SELECT DISTINCT run_id FROM clean) r LEFT JOIN (
  SELECT run_id, min(global_step) AS stop_step FROM (
    SELECT *, idx - coalesce(max(CASE WHEN is_best THEN idx END) OVER w, 0) AS stale FROM (
      SELECT *, count(eval_loss) OVER w AS idx FROM flags
      WINDOW w AS (PARTITION BY run_id ORDER BY global_step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WINDOW w AS (PARTITION BY run_id ORDER BY global_step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  WHERE eval_loss IS NOT NULL AND stale >= {PATIENCE} GROUP BY run_id) s ON s.run_id = r.run_id
""", **LOG_VIEWS))
def early_stop(spark, sf_dir):
    return TL.early_stop(log(spark, sf_dir), PATIENCE)


@query("spikes", Q.with_views(f"""
SELECT run_id, global_step, eval_loss, round(t_mean, 6) AS trailing_mean, round(t_std, 6) AS trailing_std FROM (
  SELECT *, avg(CASE WHEN isnan(eval_loss) THEN NULL ELSE eval_loss END) OVER w AS t_mean,
            stddev_samp(CASE WHEN isnan(eval_loss) THEN NULL ELSE eval_loss END) OVER w AS t_std
  FROM fx_trainlog
  WINDOW w AS (PARTITION BY run_id ORDER BY global_step ROWS BETWEEN {SPIKE_WINDOW} PRECEDING AND 1 PRECEDING))
WHERE coalesce(isnan(eval_loss) OR eval_loss > t_mean + {SPIKE_Z} * t_std, false)
""", fx_trainlog=Q.FX_TRAINLOG))
def spikes(spark, sf_dir):
    out = TL.spike_monitor(log(spark, sf_dir), SPIKE_WINDOW, SPIKE_Z)
    return out.withColumns({"trailing_mean": F.round("trailing_mean", 6), "trailing_std": F.round("trailing_std", 6)})


# --- other metrics of the log: gradient norm, learning rate, accuracy -------------

def fx_metrics(spark, sf_dir):
    """Evaluations with more metrics, from the events: a gradient norm (not a number
    for errors), a learning rate, and an accuracy with many ties."""
    ev = TB.load(spark, sf_dir, "events", ["user_id", "event_id", "event_type", "value", "props"])
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("global_step"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value") / 10).alias("grad_norm"),
        (F.col("value") / 1000 * (1 + k % 3)).alias("learning_rate"),
        F.when(F.col("event_type") != "signup", (k % 20) / F.lit(20.0)).alias("accuracy"))


METRICS_SQL = """
SELECT user_id AS run_id, event_id AS global_step, CASE WHEN event_type = 'error' THEN CAST('nan' AS DOUBLE) ELSE value / 10 END AS grad_norm,
       value / 1000 * (1 + k % 3) AS learning_rate, CASE WHEN event_type <> 'signup' THEN (k % 20) / 20.0 END AS accuracy
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
"""


def _spikes_sql(metric):
    return f"""
SELECT '{metric}' AS metric, run_id, global_step, {metric} AS value, round(m, 9) AS trailing_mean, round(s, 9) AS trailing_std FROM (
  SELECT *, avg(c) OVER w AS m, stddev_samp(c) OVER w AS s
  FROM (SELECT *, CASE WHEN isnan({metric}) THEN NULL ELSE {metric} END AS c FROM fx_metrics)
  WINDOW w AS (PARTITION BY run_id ORDER BY global_step ROWS BETWEEN {SPIKE_WINDOW} PRECEDING AND 1 PRECEDING))
WHERE coalesce(isnan({metric}) OR {metric} > m + {SPIKE_Z} * s, false)"""


@query("metric_spikes", Q.with_views(_spikes_sql("grad_norm") + " UNION ALL " + _spikes_sql("learning_rate"), fx_metrics=METRICS_SQL))
def metric_spikes(spark, sf_dir):
    """K8 over the gradient norm and the learning rate: exploding gradients and rate jumps."""
    log_ = fx_metrics(spark, sf_dir)
    parts = []
    for metric in ("grad_norm", "learning_rate"):
        out = TL.spike_monitor(log_.select("run_id", "global_step", metric), SPIKE_WINDOW, SPIKE_Z, metric=metric)
        parts.append(out.select(F.lit(metric).alias("metric"), "run_id", "global_step", F.col(metric).alias("value"),
                                F.round("trailing_mean", 9).alias("trailing_mean"), F.round("trailing_std", 9).alias("trailing_std")))
    return parts[0].unionByName(parts[1])


@query("best_by_accuracy", Q.with_views(f"""
SELECT b.run_id, b.best_step, b.best_accuracy, a.next_eval_step,
  CASE WHEN lm > 0 AND lm >= b.best_step THEN lm ELSE b.best_step END AS copied_step
FROM (SELECT run_id, min(global_step) AS best_step, max(accuracy) AS best_accuracy
      FROM (SELECT *, max(accuracy) OVER (PARTITION BY run_id) AS top FROM fx_metrics) WHERE accuracy = top GROUP BY run_id) b
JOIN (SELECT m.run_id, min(CASE WHEN m.global_step > t.s THEN m.global_step END) AS next_eval_step, max(m.global_step) AS last_step
      FROM fx_metrics m JOIN (SELECT run_id, min(global_step) AS s FROM (SELECT *, max(accuracy) OVER (PARTITION BY run_id) AS top FROM fx_metrics)
                              WHERE accuracy = top GROUP BY run_id) t ON t.run_id = m.run_id GROUP BY m.run_id) a ON a.run_id = b.run_id,
LATERAL (SELECT CAST(floor((coalesce(a.next_eval_step, a.last_step + 1) - 1) / {SAVE_STEPS}) AS BIGINT) * {SAVE_STEPS} AS lm)
""", fx_metrics=METRICS_SQL))
def best_by_accuracy(spark, sf_dir):
    """K2 by the highest accuracy, the earliest step of equal ones."""
    best = TL.best_checkpoint(fx_metrics(spark, sf_dir).select("run_id", "global_step", "accuracy"), SAVE_STEPS, "accuracy", higher_is_better=True)
    return best.withColumnRenamed("best_loss", "best_accuracy")
