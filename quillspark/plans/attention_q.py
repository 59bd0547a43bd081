"""Attention-statistics entry point."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attention as AT
from ..sources import tables as TB
from . import sqltext as Q
from .registry import query

NUM_LAYERS = 6             # layers in the attention fixture (model property)
PER_LEVEL = 5
KS = AT.DEFAULT_KS
MAX_PLOT_TOKENS = 128
SEED = 42


def _metrics_round(df):
    return df.withColumns({c: F.round(c, 6) for c in AT.metric_names(KS) if c in df.columns})


def prepared(spark, sf_dir, mode="all"):
    attn = TB.fx_attn(spark, sf_dir)
    layers = AT.select_layers(NUM_LAYERS)
    picked = AT.pick_samples(TB.fx_attn_samples(spark, sf_dir), mode, PER_LEVEL, SEED)
    metrics = AT.layer_metrics(attn, layers, picked, KS)
    return attn, layers, picked, metrics


def details(spark, sf_dir, mode="all"):
    _, _, picked, metrics = prepared(spark, sf_dir, mode)
    return AT.detail_rows(picked, metrics)


# ---- SQL ---------------------------------------------------------------------

LAYERS_SQL = ", ".join(str(x) for x in sorted(set(AT.select_layers(NUM_LAYERS))))
SLOTS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({i + 1}, {layer})" for i, layer in enumerate(AT.select_layers(NUM_LAYERS))) + ") s(slot, layer)"
GROUPS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({slot}, {layer}, '{group}', {place})" for slot, layer, group, place in AT.slot_rows(AT.select_layers(NUM_LAYERS))
) + ") s(slot, layer, slot_group, group_slot)"

ATTN_VIEWS = dict(
    fx_attn=Q.FX_ATTN,
    samples="SELECT DISTINCT sample, level FROM fx_attn",
    ranked=f"""SELECT *, CAST(row_number() OVER (PARTITION BY level ORDER BY md5(concat_ws('#', '{SEED}', CAST(sample AS VARCHAR))), sample) AS BIGINT) AS sample_index,
       count(*) OVER (PARTITION BY level) AS size FROM samples""",
    picked=f"""SELECT 'sample' AS analysis, level, sample_index, sample FROM ranked WHERE sample_index <= least({PER_LEVEL}, size)
UNION ALL SELECT 'balanced', level, sample_index, sample FROM ranked WHERE sample_index <= (SELECT min(size) FROM ranked)
UNION ALL SELECT 'full', level, sample_index, sample FROM ranked""",
    hm=f"""SELECT sample, layer, pos, avg(weight) AS w FROM fx_attn
WHERE layer IN ({LAYERS_SQL}) AND sample IN (SELECT sample FROM picked) GROUP BY sample, layer, pos""",
    nz="""SELECT sample, layer, pos, w / (sum(w) OVER (PARTITION BY sample, layer) + 1e-12) AS p,
       count(*) OVER (PARTITION BY sample, layer) AS L FROM hm""",
    rk="SELECT *, row_number() OVER (PARTITION BY sample, layer ORDER BY p DESC) AS r FROM nz",
    met="""SELECT sample, layer, -sum(greatest(p, 1e-12) * ln(greatest(p, 1e-12))) AS entropy, max(L) AS L,
       sum(CASE WHEN r <= 5 THEN p ELSE 0 END) AS top5, sum(CASE WHEN r <= 10 THEN p ELSE 0 END) AS top10
FROM rk GROUP BY sample, layer""",
    metrics="""SELECT sample, layer, entropy, CASE WHEN L > 1 THEN entropy / ln(L) ELSE 0.0 END AS entropy_norm,
       top5, top5 * 100.0 AS top5_pct, top10, top10 * 100.0 AS top10_pct FROM met""",
    details="SELECT p.analysis, p.level, p.sample_index, p.sample, m.* EXCLUDE (sample) FROM picked p JOIN metrics m ON m.sample = p.sample",
)
METRICS = AT.metric_names(KS)


def rnd(expr, name):
    return f"round({expr}, 6) AS {name}"


@query("attention_detail", Q.with_views(
    "SELECT analysis, level, sample_index, sample, layer, "
    + ", ".join(rnd(m, m) for m in METRICS) + " FROM details", **ATTN_VIEWS))
def attention_detail(spark, sf_dir):
    d = details(spark, sf_dir)
    return _metrics_round(d.select("analysis", "level", "sample_index", "sample", "layer", *METRICS))


@query("sample_avg", Q.with_views(
    "SELECT p.analysis, p.level, p.sample_index, p.sample, "
    + ", ".join(rnd(f"avg(m.{m})", f"avg_{m}") for m in METRICS)
    + f" FROM picked p JOIN metrics m ON m.sample = p.sample JOIN ({SLOTS_SQL}) s ON s.layer = m.layer"
      " GROUP BY p.analysis, p.level, p.sample_index, p.sample", **ATTN_VIEWS))
def sample_avg(spark, sf_dir):
    _, layers, picked, metrics = prepared(spark, sf_dir)
    out = AT.sample_averages(picked, metrics, AT.measured_slots(spark, layers), KS)
    return out.withColumns({f"avg_{m}": F.round(f"avg_{m}", 6) for m in METRICS})


@query("level_summary", Q.with_views(
    "SELECT analysis, level, "
    + ", ".join(rnd(f"avg({m})", f"mean_{m}") for m in METRICS) + ", "
    + ", ".join(rnd(f"coalesce(stddev_samp({m}), 0.0)", f"std_{m}") for m in METRICS)
    + " FROM details GROUP BY analysis, level", **ATTN_VIEWS))
def level_summary(spark, sf_dir):
    out = AT.level_stats(details(spark, sf_dir), KS).orderBy("analysis", "level")
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith(("mean_", "std_"))})


@query("layer_profile", Q.with_views(
    "SELECT g.slot, g.layer, g.slot_group, g.group_slot, "
    + ", ".join(rnd(f"avg(CASE WHEN d.level = {lv} THEN d.entropy END)", f"entropy_l{lv}") for lv in range(1, 6)) + ", "
    + ", ".join(rnd(f"avg(CASE WHEN d.level = {lv} THEN d.top10 END)", f"top10_l{lv}") for lv in range(1, 6))
    + f" FROM ({GROUPS_SQL}) g JOIN (SELECT * FROM details WHERE analysis = 'full') d ON d.layer = g.layer"
      " GROUP BY g.slot, g.layer, g.slot_group, g.group_slot", **ATTN_VIEWS))
def layer_profile(spark, sf_dir):
    d = details(spark, sf_dir, "full")
    prof = AT.layer_level_profile(d, AT.slot_table(spark, AT.select_layers(NUM_LAYERS)), KS)
    return prof.withColumns({c: F.round(c, 6) for c in prof.columns if c.startswith(("entropy_l", "top10_l"))})


def matrix_input(spark, sf_dir):
    """The fixture read as whole matrices: the head index stands for the query
    position (FIXTURES.md §3)."""
    a = TB.fx_attn(spark, sf_dir)
    return a.withColumnRenamed("head", "q_pos")


@query("attention_matrix", Q.with_views(f"""
SELECT a.sample, a.layer, a.head AS q_pos, a.pos AS k_pos, round(avg(a.weight), 6) AS weight
FROM fx_attn a JOIN picked p ON p.sample = a.sample AND p.analysis = 'sample'
WHERE a.layer IN ({LAYERS_SQL}) AND a.head < {MAX_PLOT_TOKENS} AND a.pos < {MAX_PLOT_TOKENS}
GROUP BY a.sample, a.layer, a.head, a.pos
""", **ATTN_VIEWS))
def attention_matrix(spark, sf_dir):
    a = matrix_input(spark, sf_dir)
    picked = AT.pick_samples(TB.fx_attn_samples(spark, sf_dir), "sample", PER_LEVEL, SEED)
    a = a.where(F.col("layer").isin(sorted(set(AT.select_layers(NUM_LAYERS)))))
    a = a.join(picked.select("sample"), "sample", "left_semi")
    m = AT.attention_matrix(a, MAX_PLOT_TOKENS)
    return m.withColumn("weight", F.round("weight", 6))


@query("last_query_vector", Q.with_views("""
SELECT a.sample, a.level, a.layer, a.pos, a.weight FROM fx_attn a
JOIN (SELECT sample, max(head) AS q FROM fx_attn GROUP BY sample) m ON m.sample = a.sample AND a.head = m.q
""", fx_attn=Q.FX_ATTN))
def last_query_vector(spark, sf_dir):
    """J2 (query_last) on the matrix reading of the fixture."""
    return AT.select_query_position(matrix_input(spark, sf_dir), "query_last").select(
        "sample", "level", "layer", "pos", "weight")


@query("first_gen_vector", Q.with_views("""
SELECT sample, level, layer, pos, weight FROM fx_attn WHERE head = 0 AND sample % 2 = 0
UNION ALL
SELECT a.sample, a.level, a.layer, a.pos, a.weight FROM fx_attn a
JOIN (SELECT sample, max(head) AS q FROM fx_attn GROUP BY sample) m ON m.sample = a.sample AND a.head = m.q
WHERE a.sample NOT IN (SELECT DISTINCT sample FROM fx_attn WHERE head = 0 AND sample % 2 = 0)
""", fx_attn=Q.FX_ATTN))
def first_gen_vector(spark, sf_dir):
    """J2 (first_gen): generation-step rows where a sample has them (stand-in:
    query position 0 of even samples), else the last query position."""
    m = matrix_input(spark, sf_dir)
    gen = m.where((F.col("q_pos") == 0) & (F.col("sample") % 2 == 0))
    return AT.select_query_position(m, "first_gen", gen).select("sample", "level", "layer", "pos", "weight")
