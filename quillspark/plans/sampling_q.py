"""Level extraction, validation, sampling and splitting queries."""

from __future__ import annotations

from ..functions.answers import NUMBER
from ..operators import extraction as X
from ..operators import sampling as SM
from ..sources import tables as TB
from . import sqltext as Q
from .registry import query

SEED = SM.DEFAULT_SEED
PER_LEVEL = 5
FRACTIONS = {1: 0.1, 2: 0.2, 3: 0.3, 4: 0.4, 5: 0.5}
MIX_WEIGHTS = {"math": 0.3, "gsm8k": 0.7}

REC_VIEWS = dict(fx_graded=Q.FX_GRADED, fx_records=Q.FX_RECORDS)
PARSED_SQL = f"SELECT dataset, sample_id, raw, {Q.get_query('raw')} AS query, {Q.parse_level('raw')} AS level FROM fx_records"
USABLE_SQL = "SELECT dataset, sample_id, query, level FROM parsed WHERE query IS NOT NULL AND level BETWEEN 1 AND 5"
USABLE_VIEWS = dict(REC_VIEWS, parsed=PARSED_SQL, usable=USABLE_SQL)


def key_sql(*cols, salt=""):
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"md5(concat_ws('#', '{SEED}{salt}', {parts}))"


def unit_sql(*cols, salt):
    """A 52-bit draw as a fraction of one."""
    return f"(CAST(CAST(('0x' || substr({key_sql(*cols, salt=salt)}, 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496)"


def parsed(spark, sf_dir):
    r = TB.fx_records(spark, sf_dir)
    return X.with_query_and_level(r).select("dataset", "sample_id", "raw", "query", "level")


def usable(spark, sf_dir):
    return X.valid_level(X.has_query(parsed(spark, sf_dir))).select("dataset", "sample_id", "query", "level")


@query("query_pick", Q.with_views("SELECT dataset, sample_id, query FROM parsed", **dict(REC_VIEWS, parsed=PARSED_SQL)))
def query_pick(spark, sf_dir):
    return parsed(spark, sf_dir).select("dataset", "sample_id", "query")


@query("level_parse", Q.with_views("SELECT sample_id, level FROM parsed", **dict(REC_VIEWS, parsed=PARSED_SQL)))
def level_parse(spark, sf_dir):
    return parsed(spark, sf_dir).select("sample_id", "level")


@query("level_sizes", Q.with_views("""
SELECT CAST(s.level AS BIGINT) AS level, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES (1), (2), (3), (4), (5)) s(level)
LEFT JOIN (SELECT level, count(*) AS n FROM usable GROUP BY level) c ON c.level = s.level
""", **USABLE_VIEWS))
def level_sizes(spark, sf_dir):
    return X.level_sizes(usable(spark, sf_dir))


@query("validate", Q.with_views(f"""
SELECT dataset, CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(blank) AS BIGINT) AS n_blank,
       CAST(sum(corrupt) AS BIGINT) AS n_corrupt, CAST(sum(noq) AS BIGINT) AS n_no_query,
       CAST(sum(badlvl) AS BIGINT) AS n_bad_level, CAST(sum(noans) AS BIGINT) AS n_unparsed_answer,
       CAST(sum(CASE WHEN c > 1 THEN c ELSE 0 END) AS BIGINT) AS n_duplicate_id
FROM (
  SELECT dataset, sample_id, count(*) AS c,
         count_if(raw IS NULL OR {Q.pystrip('raw')} = '') AS blank,
         count_if(NOT json_valid(raw)) AS corrupt,
         count_if(json_valid(raw) AND query IS NULL) AS noq,
         count_if(json_valid(raw) AND coalesce(NOT (level BETWEEN 1 AND 5), true)) AS badlvl,
         count_if(CASE WHEN json_valid(raw) THEN coalesce(json_type(raw, '$.answer') = 'VARCHAR'
                  AND len(regexp_extract_all(json_extract_string(raw, '$.answer'), {Q.lit(NUMBER)}, 0)) = 0, false)
                  ELSE false END) AS noans
  FROM parsed GROUP BY dataset, sample_id)
GROUP BY dataset
""", **dict(REC_VIEWS, parsed=PARSED_SQL)))
def validate(spark, sf_dir):
    return X.validate_records(TB.fx_records(spark, sf_dir))


@query("shuffle_position", Q.with_views(f"""
SELECT dataset, sample_id,
       CAST(row_number() OVER (ORDER BY {key_sql('dataset', 'sample_id')}, dataset, sample_id) - 1 AS BIGINT) AS position
FROM fx_pred
""", fx_pred=Q.FX_PRED))
def shuffle_position(spark, sf_dir):
    p = TB.fx_pred(spark, sf_dir).select("dataset", "sample_id")
    return SM.seeded_shuffle(p, SEED, ("dataset", "sample_id"))


@query("level_sample", Q.with_views(f"""
SELECT level, sample_index, sample_id FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY level ORDER BY {key_sql('sample_id')}, sample_id) AS INT) AS sample_index
  FROM usable) WHERE sample_index <= {PER_LEVEL}
""", **USABLE_VIEWS))
def level_sample(spark, sf_dir):
    return SM.sample_per_level(usable(spark, sf_dir), PER_LEVEL, SEED).select("level", "sample_index", "sample_id")


RANKED_SQL = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY level ORDER BY {key_sql('sample_id')}, sample_id) AS BIGINT) AS sample_index,
       count(*) OVER (PARTITION BY level) AS size FROM usable
"""


@query("balanced_sample", Q.with_views("""
SELECT level, sample_index, sample_id FROM ranked WHERE sample_index <= (SELECT min(size) FROM ranked)
""", **USABLE_VIEWS, ranked=RANKED_SQL))
def balanced_sample(spark, sf_dir):
    return SM.balanced_sample(usable(spark, sf_dir), SEED).select("level", "sample_index", "sample_id")


@query("all_modes", Q.with_views(f"""
SELECT 'sample' AS analysis, level, sample_index, sample_id FROM ranked WHERE sample_index <= least({PER_LEVEL}, size)
UNION ALL
SELECT 'balanced', level, sample_index, sample_id FROM ranked WHERE sample_index <= (SELECT min(size) FROM ranked)
UNION ALL
SELECT 'full', level, sample_index, sample_id FROM ranked
""", **USABLE_VIEWS, ranked=RANKED_SQL))
def all_modes(spark, sf_dir):
    return SM.analysis_pass(usable(spark, sf_dir), "all", PER_LEVEL, SEED).select(
        "analysis", "level", "sample_index", "sample_id")


@query("split_811", Q.with_views(f"""
SELECT dataset, sample_id,
       CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, {unit_sql('dataset', 'sample_id', salt='.split')} AS u FROM fx_pred)
""", fx_pred=Q.FX_PRED))
def split_811(spark, sf_dir):
    p = TB.fx_pred(spark, sf_dir).select("dataset", "sample_id")
    return SM.split_dataset(p, (8, 1, 1), SEED, ("dataset", "sample_id"))


def _frac_sql():
    return "CASE level " + " ".join(f"WHEN {k} THEN {v!r}" for k, v in sorted(FRACTIONS.items())) + " ELSE 0.0 END"


@query("stratified", Q.with_views(f"""
SELECT level, sample_id FROM usable WHERE {unit_sql('sample_id', salt='.stratified')} < ({_frac_sql()})
""", **USABLE_VIEWS))
def stratified(spark, sf_dir):
    return SM.stratified_sample(usable(spark, sf_dir), FRACTIONS, SEED).select("level", "sample_id")


@query("mix", Q.with_views(f"""
SELECT dataset, sample_id,
       CAST(row_number() OVER (ORDER BY r, dataset) - 1 AS BIGINT) AS mix_position
FROM (SELECT dataset, sample_id,
             row_number() OVER (PARTITION BY dataset ORDER BY {key_sql('dataset', 'sample_id')}, dataset, sample_id) AS r
      FROM fx_pred)
""", fx_pred=Q.FX_PRED))
def mix(spark, sf_dir):
    p = TB.fx_pred(spark, sf_dir).select("dataset", "sample_id")
    return SM.mix_datasets(p, "alternate", seed=SEED)


def _weight_sql():
    return "CASE dataset " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in sorted(MIX_WEIGHTS.items())) + " ELSE 0.0 END"


@query("mix_weighted", Q.with_views(f"""
SELECT dataset, sample_id FROM fx_pred WHERE {unit_sql('dataset', 'sample_id', salt='.mix')} < ({_weight_sql()})
""", fx_pred=Q.FX_PRED))
def mix_weighted(spark, sf_dir):
    p = TB.fx_pred(spark, sf_dir).select("dataset", "sample_id")
    return SM.mix_datasets(p, "weighted", MIX_WEIGHTS, seed=SEED)


@query("mix_then_split", Q.with_views(f"""
SELECT dataset, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT *, {unit_sql('dataset', 'sample_id', salt='.split')} AS u FROM fx_pred
      WHERE {unit_sql('dataset', 'sample_id', salt='.mix')} < ({_weight_sql()}))
GROUP BY ALL
""", fx_pred=Q.FX_PRED))
def mix_then_split(spark, sf_dir):
    """E2 then F7 with one seed: two draws, so all splits keep their share."""
    from pyspark.sql import functions as F

    p = SM.mix_datasets(TB.fx_pred(spark, sf_dir).select("dataset", "sample_id"), "weighted", MIX_WEIGHTS, seed=SEED)
    return SM.split_dataset(p, (8, 1, 1), SEED).groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n"))
