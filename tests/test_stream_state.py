"""K9: keyed state equals K1 whatever arrives when."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.operators import trainlog as TL
from quillspark.session import shared_dir
from quillspark.streaming import best_tracker as BT

SCHEMA = "user_id bigint, event_id bigint, event_type string, value double"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9), st.integers(-3, 3)), max_size=40))
def test_staircase(rows):
    run, step, loss = (np.array([r[i] for r in rows], float if i == 2 else np.int64) for i in range(3))
    want, best = [], {}
    for r, s, x in sorted(rows):
        if x < best.get(r, 99):
            best[r] = x
            want.append((r, s, x))
    keep = BT.staircase(run, step, loss)
    assert [(run[k], step[k], loss[k]) for k in keep] == want


def put(spark, folder, name, rows):
    """One file of the source folder."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}-{name}")
    part = next(f for f in os.listdir(f"{folder}-{name}") if f.endswith(".parquet"))
    os.makedirs(folder, exist_ok=True)
    os.link(f"{folder}-{name}/{part}", f"{folder}/{name}.parquet")


def log_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("global_step"),
                     F.when(F.col("event_type") != "error", F.col("value")).alias("eval_loss"))


def bag(df):
    return sorted((str(r.run_id), r.global_step, r.eval_loss) for r in df.collect())


def test_shuffled_files_and_restarts(spark, tmp_path):
    rnd = random.Random(7)
    rows = [(rnd.choice([1, 1, 1, 2, None]), i, rnd.choice(["view", "view", "error"]), float(rnd.randint(0, 400))) for i in range(1200)]
    rows += [(3, 5, "view", float("nan")), (3, 6, "view", None), (3, 7, "view", -0.5)]
    rnd.shuffle(rows)
    src, folder = str(tmp_path / "src"), shared_dir(spark, "stairs")
    cuts = [0, 100, 130, 700, len(rows)]
    done = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        put(spark, src, f"f{i}", rows[a:b])
        if i % 2 == 0 and i < 3:
            continue  # the next run finds two files
        done = rows[:b]
        stream = BT.events_stream_as_log(spark, src, SCHEMA, max_files_per_trigger=1)
        BT.track(stream, folder).awaitTermination()  # a new query on the same checkpoint
        assert bag(BT.best_so_far(spark, folder)) == bag(TL.new_best(log_of(spark, done)))
    assert done == rows
    # the changes put out add up to the state
    held = {}
    changes = spark.read.parquet(f"{folder}/changes").orderBy("batch", "added").collect()
    for c in changes:
        key = (str(c.run_id), c.global_step)
        if c.added:
            held[key] = c.eval_loss
        else:
            assert held.pop(key) == c.eval_loss
    assert sorted((*k, v) for k, v in held.items()) == bag(BT.best_so_far(spark, folder))
    # one state row a run
    state = spark.read.format("statestore").option("stateVarName", "stairs").load(f"{folder}/checkpoint")
    assert state.count() == 4
    # nothing new: nothing changes
    BT.track(BT.events_stream_as_log(spark, src, SCHEMA), folder).awaitTermination()
    assert spark.read.parquet(f"{folder}/changes").count() == len(changes)


def test_nothing_yet(spark, tmp_path):
    assert BT.best_so_far(spark, str(tmp_path / "none")).count() == 0


def test_repeated_steps(spark, tmp_path):
    rows = [(1, 10, "view", 5.0), (1, 10, "view", 4.0), (1, 20, "view", 4.0), (1, 30, "view", 3.0)]
    src = str(tmp_path / "src")
    put(spark, src, "a", rows[1:])
    put(spark, src, "b", rows[:1])
    got = BT.run_to_table(spark, BT.events_stream_as_log(spark, src, SCHEMA, max_files_per_trigger=1))
    assert bag(got) == [("1", 10, 4.0), ("1", 30, 3.0)]


@pytest.mark.parametrize("parts", [1, 5])
def test_a_hot_run_sends_its_staircase_only(spark, parts):
    """What a task sends for a run grows with its new bests, not with its events."""
    rows = 20_000
    df = spark.range(rows).select(F.lit(1).cast("long").alias("run_id"), F.col("id").alias("global_step"),
                                  (F.xxhash64("id") % 1_000_000).cast("double").alias("eval_loss")).repartition(parts)
    sent = df.mapInArrow(BT._reduced, BT.LOG_SCHEMA)
    assert sent.count() < 40 * parts
    assert bag(TL.new_best(sent)) == bag(TL.new_best(df))
