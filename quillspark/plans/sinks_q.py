"""Sources and sinks (A1, A4-A11) and the streaming best tracker (K9).

Each query writes its frame to a fresh folder under the shared checkpoint
folder and reads it back, so the check covers the written format.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS_CLASS
from ..operators import attention as AT
from ..operators import prompts as P
from ..operators import sampling as SM
from ..operators.features import words
from ..session import shared_dir, table_path
from ..sources import jsonl, sinks
from ..sources import tables as TB
from ..streaming import best_tracker as BT
from . import attention_q as AQ
from . import features_q as FQ
from . import grading_q as GQ
from . import prompting_q as PQ
from . import sqltext as Q
from .registry import ORACLES, query
from .sampling_q import USABLE_VIEWS, usable
from .trainlog_q import BEST_SQL, LOG_VIEWS

MODEL_PATH = "model"
MAX_PLOT_TOKENS = 128


@query("predictions_written", Q.with_views(
    "SELECT dataset, sample_id, concat('Question ', CAST(sample_id AS VARCHAR)) AS prompt, reference, prediction FROM fx_pred",
    fx_pred=Q.FX_PRED))
def predictions_written(spark, sf_dir):
    path = shared_dir(spark, "predictions")
    p = TB.fx_pred(spark, sf_dir).select(
        "dataset", "sample_id", F.concat(F.lit("Question "), F.col("sample_id").cast("string")).alias("prompt"),
        "reference", "prediction")
    sinks.write_predictions(p, path)
    back = jsonl.read_jsonl(spark, path, "sample_id bigint, prompt string, reference string, prediction string, "
                                         "dataset string, run_id string")
    return back.select("dataset", "sample_id", "prompt", "reference", "prediction")


@query("metrics_written", ORACLES["accuracy_by_dataset"])
def metrics_written(spark, sf_dir):
    path = shared_dir(spark, "metrics")
    sinks.write_metrics(GQ.accuracy_by_dataset(spark, sf_dir), path)
    return jsonl.read_jsonl(spark, path, "dataset string, total bigint, correct bigint, accuracy double")


_RECORD_VIEWS = {k: v for k, v in USABLE_VIEWS.items() if k != "usable"}


def _record_lines(spark, sf_dir):
    """The loosely typed records as a JSON-lines file (one in 13 is cut off) with
    a blank and a white-space line; returns its folder."""
    path = shared_dir(spark, "records")
    r = TB.fx_records(spark, sf_dir)
    line = F.concat(F.lit('{"dataset": "'), "dataset", F.lit('", "sample_id": '), F.col("sample_id").cast("string"),
                    F.lit(', "record": '), "raw", F.lit("}"))
    blank = spark.range(2).select(F.when(F.col("id") == 0, F.lit("   ")).otherwise(F.lit("")).alias("line"))
    r.select(line.alias("line")).unionByName(blank).write.text(path)
    return path


@query("records_jsonl", Q.with_views("SELECT dataset, sample_id, query, level FROM parsed WHERE json_valid(raw)", **_RECORD_VIEWS))
def records_jsonl(spark, sf_dir):
    """A1: the records of a JSON-lines file as VARIANT, malformed lines set apart."""
    from ..operators import extraction as X

    back = jsonl.read_jsonl_variant(spark, _record_lines(spark, sf_dir), mode="PERMISSIVE").where(F.col("record").isNotNull())
    inner = F.variant_get("record", "$.record", "variant")
    return back.select(F.variant_get("record", "$.dataset", "string").alias("dataset"),
                       F.variant_get("record", "$.sample_id", "bigint").alias("sample_id"), inner.alias("inner")).select(
        "dataset", "sample_id", X.get_query("inner").alias("query"), X.parse_level("inner").alias("level"))


@query("jsonl_audit", Q.with_views("""
SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(count_if(NOT json_valid(raw)) AS BIGINT) AS n_malformed FROM fx_records
""", **_RECORD_VIEWS))
def jsonl_audit(spark, sf_dir):
    """A1: no line is lost without a trace: lines and malformed lines of a file."""
    back = jsonl.read_jsonl_variant(spark, _record_lines(spark, sf_dir), mode="PERMISSIVE")
    return back.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("record").isNull()).alias("n_malformed"))


@query("splits_read", Q.with_views(
    "SELECT split, conv_id, turn, prompt, response FROM rendered WHERE dataset = 'math'", **PQ.QA_VIEWS))
def splits_read(spark, sf_dir):
    """One file a split, read as one frame with a literal split, rendered, pruned."""
    from dataclasses import replace

    folder = shared_dir(spark, "splits")
    math = P.filter_datasets(PQ.qa_records(spark, sf_dir), ["math"])
    files = {s: f"{folder}/{s}" for s in ("train", "validation", "test")}
    for split, path in files.items():
        math.where(F.col("split") == split).select("conv_id", "turn", "question", "answer").write.json(path)
    cfg = replace(PQ.MATH_CFG, train_file=files["train"], validation_file=files["validation"], test_file=files["test"])
    back = jsonl.read_splits(spark, cfg, "conv_id bigint, turn bigint, question string, answer string")
    return P.prune(P.build_prompt(back, cfg), ("split", "conv_id", "turn", "prompt", "response")).withColumn(
        "turn", F.col("turn").cast(math.schema["turn"].dataType))


@query("eval_samples_math", Q.with_views(
    "SELECT conv_id, prompt, response AS reference FROM rendered WHERE dataset = 'math'", **PQ.QA_VIEWS))
def eval_samples_math(spark, sf_dir):
    """C5 as it stands: (id, prompt, reference) of one dataset."""
    return P.eval_samples(P.filter_datasets(PQ.qa_records(spark, sf_dir), ["math"]), PQ.MATH_CFG, "conv_id")


@query("details_written", Q.with_views(
    "SELECT analysis, level, sample_index, sample, layer, "
    + ", ".join(AQ.rnd(m, m) for m in AQ.METRICS) + " FROM details", **AQ.ATTN_VIEWS))
def details_written(spark, sf_dir):
    path = shared_dir(spark, "details")
    d = AQ.attention_detail(spark, sf_dir)
    sinks.write_details(d, path)
    schema = ("sample_index bigint, sample int, layer int, "
              + ", ".join(f"{m} double" for m in AQ.METRICS) + ", analysis string, level int")
    return (spark.read.schema(schema).option("header", True).csv(path)
            .select("analysis", "level", "sample_index", "sample", "layer", *AQ.METRICS))


@query("summary_written", Q.with_views(
    "SELECT analysis, level, "
    + ", ".join(AQ.rnd(f"avg({m})", f"mean_{m}") for m in AQ.METRICS) + ", "
    + ", ".join(AQ.rnd(f"coalesce(stddev_samp({m}), 0.0)", f"std_{m}") for m in AQ.METRICS)
    + " FROM details GROUP BY analysis, level", **AQ.ATTN_VIEWS))
def summary_written(spark, sf_dir):
    path = shared_dir(spark, "summary")
    s = AQ.level_summary(spark, sf_dir)
    sinks.write_level_summary(s, path)
    cols = [c for c in s.columns if c != "analysis"]
    schema = ", ".join(f"{c} {'int' if c == 'level' else 'double'}" for c in cols) + ", analysis string"
    return spark.read.schema(schema).option("header", True).csv(path).select(*s.columns)


@query("sample_stats_written", Q.with_views(
    "SELECT p.analysis, p.level, p.sample_index, p.sample, "
    + ", ".join(AQ.rnd(f"avg(m.{m})", f"avg_{m}") for m in AQ.METRICS)
    + ", CAST(count(DISTINCT m.layer) AS INT) AS n_layers"
    + f" FROM picked p JOIN metrics m ON m.sample = p.sample JOIN ({AQ.SLOTS_SQL}) s ON s.layer = m.layer"
      " GROUP BY p.analysis, p.level, p.sample_index, p.sample", **AQ.ATTN_VIEWS))
def sample_stats_written(spark, sf_dir):
    back = _stats_back(spark, sf_dir)
    return back.select("analysis", "level", "sample_index", "sample",
                       *[F.round(f"avg_{m}", 6).alias(f"avg_{m}") for m in AQ.METRICS],
                       F.size("per_layer").alias("n_layers"))


def _stats_back(spark, sf_dir):
    """A5 written and read back with its schema."""
    path = shared_dir(spark, "sample_stats")
    _, layers, picked, metrics = AQ.prepared(spark, sf_dir)
    details = AT.detail_rows(picked, metrics)
    avgs = AT.sample_averages(picked, metrics, AT.measured_slots(spark, layers), AQ.KS)
    stats = sinks.sample_stats(details, avgs, layers, "query_last", AQ.KS, AQ.METRICS)
    sinks.write_sample_stats(stats, path)
    metrics_ddl = ", ".join(f"{m}: double" for m in AQ.METRICS)
    schema = ("sample_index bigint, sample int, per_layer map<string, struct<" + metrics_ddl + ">>, "
              + ", ".join(f"avg_{m} double" for m in AQ.METRICS) + ", analysis string, level int")
    return spark.read.schema(schema).json(path)


@query("sample_layers_written", Q.with_views(
    "SELECT analysis, level, sample_index, sample, layer, "
    + ", ".join(AQ.rnd(m, m) for m in AQ.METRICS) + " FROM details", **AQ.ATTN_VIEWS))
def sample_layers_written(spark, sf_dir):
    """A5: the per-layer values of the sample files."""
    rows = _stats_back(spark, sf_dir).select("analysis", "level", "sample_index", "sample",
                                             F.explode("per_layer").alias("layer", "m"))
    return rows.select("analysis", "level", "sample_index", "sample", F.col("layer").cast("int").alias("layer"),
                       *[F.round(f"m.{m}", 6).alias(m) for m in AQ.METRICS])


def _tokens_sql(q):
    w = (f"CASE WHEN {Q.pystrip(q)} = '' THEN []::VARCHAR[] "
         f"ELSE string_split_regex({Q.pystrip(q)}, {Q.lit(WS_CLASS + '+')}) END")
    cleaned = ("CASE WHEN length(replace(replace(replace(replace(x, 'Ġ', ' '), '▁', ' '), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't')) > 16 "
               "THEN concat(substr(replace(replace(replace(replace(x, 'Ġ', ' '), '▁', ' '), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't'), 1, 15), '…') "
               "ELSE replace(replace(replace(replace(x, 'Ġ', ' '), '▁', ' '), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't') END")
    return f"[{cleaned} for x in list_slice(list_concat(['<s>'], {w}), 1, {MAX_PLOT_TOKENS})]"


@query("query_meta_written", Q.with_views(f"""
SELECT level, sample_index AS index, query, CAST(len({_tokens_sql('query')}) AS INT) AS n_tokens,
       array_to_string({_tokens_sql('query')}, '|') AS tokens, '{','.join(str(x) for x in AT.select_layers(AQ.NUM_LAYERS))}' AS chosen_layers,
       '{MODEL_PATH}' AS model_path
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY level ORDER BY md5(concat_ws('#', '42', CAST(sample_id AS VARCHAR))), sample_id) AS INT) AS sample_index
      FROM usable) WHERE sample_index <= 5
""", **USABLE_VIEWS))
def query_meta_written(spark, sf_dir):
    path = shared_dir(spark, "query_meta")
    picked = SM.sample_per_level(usable(spark, sf_dir), 5, 42)
    toks = F.slice(F.concat(F.array(F.lit("<s>")), words("query")), 1, MAX_PLOT_TOKENS)
    meta = picked.select(
        "level", F.col("sample_index").alias("index"), "query",
        F.transform(toks, lambda t: P.clean_token(t)).alias("tokens"),
        F.array(*[F.lit(x) for x in AT.select_layers(AQ.NUM_LAYERS)]).alias("chosen_layers"),
        F.lit(MODEL_PATH).alias("model_path"))
    sinks.write_query_meta(meta, path)
    back = jsonl.read_jsonl(spark, path, "index int, query string, tokens array<string>, "
                                         "chosen_layers array<int>, model_path string, level bigint")
    return back.select("level", "index", "query", F.size("tokens").alias("n_tokens"),
                       F.array_join("tokens", "|").alias("tokens"),
                       F.array_join(F.col("chosen_layers").cast("array<string>"), ",").alias("chosen_layers"),
                       "model_path")


@query("features_cached", FQ.ENC_CTES + "," + FQ.FEAT_SQL + """
SELECT split, dataset, conv_id, turn, array_to_string(list_concat(prompt_ids, response_ids), ' ') AS input_ids,
       CAST(len(prompt_ids) AS INT) AS n_prompt FROM feat
""")
def features_cached(spark, sf_dir):
    path = shared_dir(spark, "features")
    f, _ = FQ.features(spark, sf_dir)
    sinks.cache_features(f.select("split", "dataset", "conv_id", "turn", "input_ids", "attention_mask",
                                  "labels", "prompt_ids"), path)
    back = spark.read.parquet(path)
    return back.select("split", "dataset", "conv_id", "turn", FQ.ids_text("input_ids").alias("input_ids"),
                       F.size("prompt_ids").alias("n_prompt"))


@query("features_reused", FQ.ENC_CTES + "," + FQ.FEAT_SQL + """,
bare AS (SELECT len(p.ids) + len(r.ids) AS n FROM p_enc p JOIN r_enc r USING (dataset, conv_id, turn))
SELECT 1 AS run, false AS reused, CAST(count(*) AS BIGINT) AS n, CAST(sum(len(prompt_ids) + len(response_ids)) AS BIGINT) AS n_ids FROM feat
UNION ALL SELECT 2, true, CAST(count(*) AS BIGINT), CAST(sum(len(prompt_ids) + len(response_ids)) AS BIGINT) FROM feat
UNION ALL SELECT 3, false, CAST(count(*) AS BIGINT), CAST(sum(n) AS BIGINT) FROM bare
""")
def features_reused(spark, sf_dir):
    """A10: features written once, read by the second run, written again for other settings."""
    root = shared_dir(spark, "feature-cache")
    inputs = [table_path(sf_dir, "conversations")]
    out = None
    for run, eos in ((1, True), (2, True), (3, False)):
        settings = {"templates": [[c.name, c.prompt_template, c.answer_template] for c in PQ.CONFIGS], "caps": FQ.CAPS, "append_eos": eos}
        rows, reused = sinks.cached_features(spark, root, settings, inputs, lambda eos=eos: FQ.features(spark, sf_dir, eos)[0])
        one = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("input_ids")).alias("n_ids")).select(
            F.lit(run).alias("run"), F.lit(reused).alias("reused"), "n", "n_ids")
        out = one if out is None else out.unionByName(one)
    return out


@query("report_written", Q.with_views("""
SELECT line FROM (
  SELECT '| dataset | level | total | correct | accuracy |' AS line
  UNION ALL SELECT '|---|---|---|---|---|'
  UNION ALL SELECT concat('| ', concat_ws(' | ', coalesce(dataset, ''), coalesce(CAST(level AS VARCHAR), ''),
                    CAST(total AS VARCHAR), CAST(correct AS VARCHAR), CAST(round(CAST(accuracy AS DECIMAL(38,18)), 4) AS VARCHAR)), ' |')
  FROM (SELECT dataset, level, count(*) AS total, count_if(correct) AS correct, count_if(correct) / count(*) AS accuracy
        FROM graded GROUP BY ROLLUP (dataset, level)))
""", fx_pred=Q.FX_PRED, graded=GQ.GRADED_SQL))
def report_written(spark, sf_dir):
    path = shared_dir(spark, "report")
    r = GQ.accuracy_rollup(spark, sf_dir)
    sinks.write_report(r, path, ["dataset", "level", "total", "correct", "accuracy"], "markdown")
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("report_csv", Q.with_views("""
SELECT dataset, level, CAST(count(*) AS BIGINT) AS total, CAST(count_if(correct) AS BIGINT) AS correct
FROM graded GROUP BY ROLLUP (dataset, level)
""", fx_pred=Q.FX_PRED, graded=GQ.GRADED_SQL))
def report_csv(spark, sf_dir):
    """A11 as CSV; the roll-up's null cells come back as nulls."""
    path = shared_dir(spark, "report")
    sinks.write_report(GQ.accuracy_rollup(spark, sf_dir), path, ["dataset", "level", "total", "correct"], "csv")
    return spark.read.schema("dataset string, level int, total bigint, correct bigint").option("header", True).csv(path)


EVENTS_SCHEMA = ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
                 "props string")


@query("best_stream", Q.with_views(BEST_SQL, **LOG_VIEWS))
def best_stream(spark, sf_dir):
    """K9: events as a file stream -> candidates per micro-batch -> new bests."""
    return BT.run_to_table(spark, BT.events_stream_as_log(spark, table_path(sf_dir, "events"), EVENTS_SCHEMA))
