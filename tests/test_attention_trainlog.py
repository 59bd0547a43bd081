"""Attention metric properties, layer choice, prefix scans and log rules."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import MEDIUM
from quillspark.operators import attention as AT
from quillspark.operators import scan
from quillspark.operators import trainlog as TL
from quillspark.sources import tables as TB


@pytest.mark.parametrize("n,want", [
    (0, []), (1, [0]), (2, [0, 1]), (3, [0, 1, 2, 2]), (4, [0, 1, 2, 3]),
    (5, [0, 1, 2, 3, 4, 4]), (6, [0, 1, 2, 3, 4, 5]), (7, [0, 1, 3, 5, 6, 6]),
    (12, [0, 1, 5, 6, 10, 11]), (32, [0, 1, 15, 16, 30, 31]),
])
def test_select_layers(n, want):
    assert AT.select_layers(n) == want


def test_metric_bounds(spark):
    attn = TB.fx_attn(spark, MEDIUM)
    m = AT.vector_metrics(AT.head_mean_vectors(attn)).withColumn("L", F.size("vec")).collect()
    for r in m:
        assert -1e-9 <= r["entropy"] <= math.log(r["L"]) + 1e-9
        assert r["top5"] <= r["top10"] + 1e-12 <= 1 + 1e-9
        assert r["top10_pct"] == pytest.approx(100 * r["top10"])


def test_metrics_match_python(spark):
    vec = [0.5, 0.25, 0.0, 0.125, 0.125]
    df = spark.createDataFrame([(vec,)], "vec array<double>")
    r = AT.vector_metrics(df, (2, 10)).first()
    s = sum(vec) + 1e-12
    p = [x / s for x in vec]
    ent = -sum(max(x, 1e-12) * math.log(max(x, 1e-12)) for x in p)
    assert r["entropy"] == pytest.approx(ent)
    assert r["entropy_norm"] == pytest.approx(ent / math.log(5))
    assert r["top2"] == pytest.approx(0.75) and r["top10"] == pytest.approx(1.0)


def test_repeated_layer_counts_twice(spark):
    """n=5 chooses layer 4 twice: the averages weigh it twice, details once."""
    layers = AT.select_layers(5)
    metrics = spark.createDataFrame([(0, l, float(l)) for l in range(5)], "sample int, layer int, entropy double")
    picked = spark.createDataFrame([("sample", 1, 1, 0)], "analysis string, level int, sample_index int, sample int")
    avg = AT.sample_averages(picked, metrics.withColumn("entropy_norm", F.lit(0.0))
                             .withColumn("top5", F.lit(0.0)).withColumn("top5_pct", F.lit(0.0))
                             .withColumn("top10", F.lit(0.0)).withColumn("top10_pct", F.lit(0.0)),
                             AT.measured_slots(spark, layers)).first()
    assert avg["avg_entropy"] == pytest.approx((0 + 1 + 2 + 3 + 4 + 4) / 6)
    assert AT.detail_rows(picked, metrics).count() == 5


@pytest.mark.parametrize("how", ["min", "max", "sum", "count"])
@pytest.mark.parametrize("inclusive", [False, True])
def test_chunked_prefix_equals_window(spark, how, inclusive):
    rnd = random.Random(3)
    rows = []
    for run in range(4):
        n = 3000 if run == 0 else 50          # one hot run
        steps = rnd.sample(range(1, 100000), n)
        rows += [(run, s, None if rnd.random() < 0.2 else rnd.random()) for s in steps]
    df = spark.createDataFrame(rows, "run_id long, global_step long, v double")
    a = scan.prefix_agg(df, ["run_id"], "global_step", "v", how, "out", inclusive, chunk=1000)
    b = scan.prefix_agg(df, ["run_id"], "global_step", "v", how, "out", inclusive, chunk=None)
    key = lambda r: (r["run_id"], r["global_step"], None if r["out"] is None else round(r["out"], 9))
    assert sorted(map(key, a.collect()), key=str) == sorted(map(key, b.collect()), key=str)


def test_new_best_strictly_decreasing(spark):
    best = TL.new_best(TB.fx_trainlog(spark, MEDIUM).select("run_id", "global_step", "eval_loss"))
    w = Window.partitionBy("run_id").orderBy("global_step")
    bad = best.withColumn("prev", F.lag("eval_loss").over(w)).where("prev IS NOT NULL AND eval_loss >= prev")
    assert bad.count() == 0


def test_nan_loss_is_ignored(spark):
    log = spark.createDataFrame([(1, 1, float("nan")), (1, 2, 3.0), (1, 3, 2.0), (1, 4, None), (1, 5, 2.5)],
                                "run_id long, global_step long, eval_loss double")
    assert [r["global_step"] for r in TL.new_best(log).orderBy("global_step").collect()] == [2, 3]
    bc = TL.best_checkpoint(log, 2).first()
    assert (bc["best_step"], bc["next_eval_step"], bc["copied_step"]) == (3, 4, 3)
    bc = TL.best_checkpoint(log, 1).first()
    assert bc["copied_step"] == 3
    log2 = spark.createDataFrame([(1, 10, 1.0), (1, 25, 2.0)], "run_id long, global_step long, eval_loss double")
    assert TL.best_checkpoint(log2, 4).first()["copied_step"] == 24


def test_early_stop(spark):
    losses = [5.0, 4.0, 4.5, 4.2, None, 4.1, 3.0, 3.5]
    log = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(losses)],
                                "run_id long, global_step long, eval_loss double")
    assert TL.early_stop(log, 3, chunk=2).first()["stop_step"] == 6
    assert TL.early_stop(log, 4, chunk=None).first()["stop_step"] is None


def test_trailing_blocks_equal_window(spark):
    rnd = random.Random(5)
    rows = [(0 if i % 3 else 1, i * 7 + rnd.randint(0, 3), rnd.random()) for i in range(5000)]
    df = spark.createDataFrame(rows, "run_id long, global_step long, v double").dropDuplicates(["run_id", "global_step"])
    aggs = {"m": lambda w: F.avg("v").over(w), "s": lambda w: F.stddev_samp("v").over(w)}
    a = scan.trailing_agg(df, ["run_id"], "global_step", aggs, 20, block=64, chunk=500)
    b = scan.trailing_agg(df, ["run_id"], "global_step", aggs, 20, chunk=None)
    key = lambda r: (r["run_id"], r["global_step"], None if r["m"] is None else round(r["m"], 9),
                     None if r["s"] is None else round(r["s"], 9))
    assert a.count() == df.count()
    assert sorted(map(key, a.collect()), key=str) == sorted(map(key, b.collect()), key=str)


def test_best_checkpoint_by_accuracy(spark):
    log = spark.createDataFrame([(1, 10, 0.2), (1, 20, 0.5), (1, 30, 0.5), (1, 40, 0.1)],
                                "run_id long, global_step long, acc double")
    r = TL.best_checkpoint(log, 25, metric="acc", higher_is_better=True).first()
    assert (r["best_step"], r["best_loss"], r["next_eval_step"], r["copied_step"]) == (20, 0.5, 30, 25)


def test_spike_monitor_any_metric(spark):
    vals = [1.0, 1.1, 0.9, 1.0, 1.05, 0.95, 1.0, 9.0, 1.0, float("nan")]
    log = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(vals)],
                                "run_id long, global_step long, grad_norm double")
    got = TL.spike_monitor(log, window=5, z=3.0, chunk=4, metric="grad_norm").orderBy("global_step").collect()
    assert [r["global_step"] for r in got] == [8, 10]


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_other_operators_invariant_to_partitioning(spark, parts):
    from quillspark.operators import scoring as S
    from conftest import SMALL

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    pred = TB.fx_pred(spark, SMALL)
    base = rows(S.grade(pred).select("dataset", "sample_id", "pred_norm", "correct"))
    other = rows(S.grade(pred.repartition(parts).orderBy(F.rand(3))).select("dataset", "sample_id", "pred_norm", "correct"))
    assert base == other
    log = TB.fx_trainlog(spark, SMALL).select("run_id", "global_step", "eval_loss")
    shuffled = log.repartition(parts).orderBy(F.rand(5))
    assert rows(TL.new_best(log, chunk=64)) == rows(TL.new_best(shuffled, chunk=64))
    assert rows(TL.early_stop(log, 3, chunk=64)) == rows(TL.early_stop(shuffled, 3, chunk=64))
    attn = TB.fx_attn(spark, SMALL)
    picked = AT.pick_samples(TB.fx_attn_samples(spark, SMALL), "all", 5)
    d1 = AT.detail_rows(picked, AT.layer_metrics(attn, AT.select_layers(6), picked))
    attn2 = attn.repartition(parts).orderBy(F.rand(7))
    d2 = AT.detail_rows(picked, AT.layer_metrics(attn2, AT.select_layers(6), picked))
    r = lambda df: sorted((x["analysis"], x["sample"], x["layer"], round(x["entropy"], 9), round(x["top5"], 9))
                          for x in df.collect())
    assert r(d1) == r(d2)
