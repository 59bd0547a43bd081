"""Every registered query against its DuckDB oracle (the driver's gate, run here
on sf0.001; scripts/check_oracle.py runs the same at sf0.01)."""

import pytest

from conftest import SMALL
from quillspark.plans import registry as R
from quillspark.sources.tables import TABLES

R.load_all()
NAMES = sorted(R.QUERIES)


@pytest.fixture(scope="module")
def con():
    from compare import duck_connect

    return duck_connect(SMALL, TABLES)


def test_every_query_has_an_oracle():
    # only non-SQL operators may lack one; today all have SQL
    assert set(R.ORACLES) == set(R.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    from compare import compare

    ok, msg = compare(spark, con, name, SMALL)
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert {r["dataset"] for r in rows} == {"math", "gsm8k"}
    assert {n for n in E.queries() if n in R.QUERIES} == set(R.QUERIES) == set(R.ORACLES) <= set(E.oracle_sql())


def test_fixture_expectations(spark):
    """Figures stated in FIXTURES.md for sf0.01."""
    from conftest import MEDIUM

    acc = {r["dataset"]: (r["total"], r["correct"]) for r in R.QUERIES["accuracy_by_dataset"](spark, MEDIUM).collect()}
    assert {d: n for d, (n, _) in acc.items()} == {"math": 7500, "gsm8k": 7500}
    kinds = {r["error_type"]: r["n"] for r in R.QUERIES["error_types"](spark, MEDIUM).groupBy("error_type").count()
             .withColumnRenamed("count", "n").collect()}
    assert set(kinds) == {"correct", "wrong_value", "no_answer_marker", "format_only", "empty_prediction"}
    moved = R.QUERIES["numeric_match"](spark, MEDIUM).where("numeric_correct and not correct").count()
    assert moved > 100
    assert all(r["rescored_correct"] > r["correct"] for r in R.QUERIES["rescored"](spark, MEDIUM).collect())
    splits = {r["split"]: r["n"] for r in R.QUERIES["mix_then_split"](spark, MEDIUM).groupBy("split").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert splits["train"] > 7 * splits["test"] > 0 and splits["validation"] > 0
    assert R.QUERIES["new_best"](spark, MEDIUM).count() == 665
    assert R.QUERIES["prompts_union"](spark, MEDIUM).count() == 233
