"""Sampling properties and invariance to partitioning / input order."""

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from quillspark.operators import sampling as SM
from quillspark.plans.sampling_q import usable
from quillspark.sources import tables as TB


@pytest.fixture(scope="module")
def pool(spark):
    return usable(spark, MEDIUM).select("sample_id", "level").cache()


def test_sample_counts_are_min_n_size(pool):
    sizes = {r["level"]: r["count"] for r in pool.groupBy("level").count().collect()}
    got = {r["level"]: r["count"] for r in SM.sample_per_level(pool, 5).groupBy("level").count().collect()}
    assert got == {lv: min(5, n) for lv, n in sizes.items()}


def test_balanced_levels_equal(pool):
    b = SM.balanced_sample(pool)
    counts = [r["count"] for r in b.groupBy("level").count().collect()]
    sizes = [r["count"] for r in pool.groupBy("level").count().collect()]
    assert len(set(counts)) == 1 and counts[0] == min(sizes)


def test_all_modes_one_rank(pool):
    a = SM.analysis_pass(pool, "all", 5)
    full = a.where("analysis = 'full'")
    assert full.count() == pool.count()
    # indices are 1..size within each level, with no gaps
    chk = full.groupBy("level").agg(F.min("sample_index").alias("lo"), F.max("sample_index").alias("hi"),
                                    F.count("*").alias("n")).collect()
    assert all(r["lo"] == 1 and r["hi"] == r["n"] for r in chk)
    # the sample mode draws are the first five of the same ranking
    s = {(r["level"], r["sample_id"]) for r in a.where("analysis = 'sample'").collect()}
    f5 = {(r["level"], r["sample_id"]) for r in full.where("sample_index <= 5").collect()}
    assert s == f5


def test_split_covers_each_id_once(spark):
    p = TB.fx_pred(spark, MEDIUM).select("dataset", "sample_id")
    s = SM.split_dataset(p)
    assert s.count() == p.count() == s.select("dataset", "sample_id").distinct().count()
    frac = {r["split"]: r["count"] / p.count() for r in s.groupBy("split").count().collect()}
    assert abs(frac["train"] - 0.8) < 0.03 and abs(frac["test"] - 0.1) < 0.03


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_invariant_to_partitioning(spark, pool, parts):
    base = {(r["level"], r["sample_index"], r["sample_id"])
            for r in SM.analysis_pass(pool, "balanced").collect()}
    shuffled = pool.repartition(parts).orderBy(F.rand(7))
    other = {(r["level"], r["sample_index"], r["sample_id"])
             for r in SM.analysis_pass(shuffled, "balanced").collect()}
    assert base == other
    pos1 = {(r["sample_id"], r["position"]) for r in SM.seeded_shuffle(pool, id_cols=("sample_id",)).collect()}
    pos2 = {(r["sample_id"], r["position"])
            for r in SM.seeded_shuffle(shuffled, id_cols=("sample_id",)).collect()}
    assert pos1 == pos2


def test_shuffle_is_a_permutation(pool):
    pos = [r["position"] for r in SM.seeded_shuffle(pool, id_cols=("sample_id",)).collect()]
    assert sorted(pos) == list(range(len(pos)))


def test_hot_level(spark):
    """One level holding most rows still ranks exactly (bucketed ranking)."""
    df = spark.range(0, 20000).select(F.col("id").alias("sample_id"),
                                       F.when(F.col("id") % 10 == 0, F.lit(2)).otherwise(F.lit(1)).alias("level"))
    b = SM.analysis_pass(df, "balanced")
    assert {r["level"]: r["count"] for r in b.groupBy("level").count().collect()} == {1: 2000, 2: 2000}
    plain = df.withColumn("_k", SM.hash_key(42, "sample_id"))
    from pyspark.sql import Window
    exact = plain.withColumn("r", F.row_number().over(Window.partitionBy("level").orderBy("_k", "sample_id")))
    want = {(r["level"], r["sample_id"], r["r"]) for r in exact.where("r <= 2000").collect()}
    got = {(r["level"], r["sample_id"], r["sample_index"]) for r in b.collect()}
    assert want == got


def test_sample_mode_equals_all_modes_sample(pool):
    one = {(r["level"], r["sample_index"], r["sample_id"]) for r in SM.analysis_pass(pool, "sample", 5).collect()}
    allm = {(r["level"], r["sample_index"], r["sample_id"])
            for r in SM.analysis_pass(pool, "all", 5).where("analysis = 'sample'").collect()}
    assert one == allm and len(one) > 0
