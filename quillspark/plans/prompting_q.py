"""Training-data entry point, first half: sources, prompt rendering, chat text
(A1-A3, B1, C1-C7, C9-C11, E1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import template_parts
from ..operators import prompts as P
from ..operators import sampling as SM
from ..sources import tables as TB
from . import sqltext as Q
from .registry import query
from .sampling_q import USABLE_VIEWS, unit_sql, usable

# --- fixed values: the two dataset configurations ---------------------------
MATH_CFG = P.DatasetConfig(
    name="math",
    prompt_template="Solve the following math problem and provide the final answer.\nQuestion: {{question}}\nAnswer:",
    answer_template="{{answer}}", input_fields=("question",),
    max_source_length=2048, max_target_length=512)
GSM8K_CFG = P.DatasetConfig(
    name="gsm8k",
    prompt_template=("You are a helpful math tutor. Solve the word problem step by step and give the final "
                     "answer.\nProblem: {{question}}\nSolution:"),
    answer_template="{{answer}}", input_fields=("question",),
    max_source_length=1024, max_target_length=256)
# --------------------------------------------------------------------------
CONFIGS = [MATH_CFG, GSM8K_CFG]
SEED = SM.DEFAULT_SEED


def qa_records(spark, sf_dir):
    """fx_qa as two datasets (by conversation parity) with a hash split."""
    qa = TB.fx_qa(spark, sf_dir)
    qa = qa.withColumn("dataset", F.when(F.col("conv_id") % 2 == 0, F.lit("math")).otherwise(F.lit("gsm8k")))
    return SM.split_dataset(qa, (8, 1, 1), SEED, ("dataset", "conv_id", "turn"))


def rendered_union(spark, sf_dir, names=None, cot=False):
    """E1 over B1-selected configs: each dataset rendered with its own templates."""
    return P.build_prompts(qa_records(spark, sf_dir), P.filter_configs(CONFIGS, names), cot=cot)


def render_sql(template, ctx):
    out = []
    for kind, v in template_parts(template):
        out.append(Q.lit(v) if kind == "lit" else f"coalesce(CAST({ctx[v]} AS VARCHAR), '')")
    return "concat(" + ", ".join(out) + ")"


def _qa_sql():
    u = unit_sql("dataset", "conv_id", "turn", salt=".split")
    return f"""SELECT *, CASE WHEN {u} < 0.8 THEN 'train' WHEN {u} < 0.9 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, CASE WHEN conv_id % 2 = 0 THEN 'math' ELSE 'gsm8k' END AS dataset FROM fx_qa)"""


def _rendered_sql():
    parts = []
    for c in CONFIGS:
        parts.append(f"""SELECT dataset, split, conv_id, turn,
  {Q.pystrip(render_sql(c.prompt_template, {'question': 'question'}))} AS prompt,
  {Q.pystrip(render_sql(c.answer_template, {'answer': 'answer', 'question': 'question'}))} AS response
FROM qa WHERE dataset = '{c.name}'""")
    return "\nUNION ALL\n".join(parts)


QA_VIEWS = dict(fx_qa=Q.FX_QA, qa=_qa_sql(), rendered=_rendered_sql())


@query("prompts_union", Q.with_views("SELECT * FROM rendered", **QA_VIEWS))
def prompts_union(spark, sf_dir):
    return rendered_union(spark, sf_dir).select("dataset", "split", "conv_id", "turn", "prompt", "response")


@query("eval_samples", Q.with_views("""
SELECT r.dataset, conv_id, turn, prompt, response AS reference FROM rendered r
JOIN (SELECT dataset, max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS has_test FROM rendered GROUP BY dataset) h
  ON h.dataset = r.dataset
WHERE split = CASE WHEN has_test = 1 THEN 'test' ELSE 'validation' END
""", **QA_VIEWS))
def eval_samples(spark, sf_dir):
    r = P.eval_split(rendered_union(spark, sf_dir))
    return r.select("dataset", "conv_id", "turn", "prompt", F.col("response").alias("reference"))


@query("eval_samples_cot", Q.with_views("""
SELECT r.dataset, conv_id, turn, response AS reference, CASE WHEN r.dataset = 'math' THEN concat(prompt, chr(10),
  'Please reason step by step, and put your final answer within ', chr(92), 'boxed{}.') ELSE prompt END AS prompt
FROM rendered r
JOIN (SELECT dataset, max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS has_test FROM rendered GROUP BY dataset) h
  ON h.dataset = r.dataset
WHERE split = CASE WHEN has_test = 1 THEN 'test' ELSE 'validation' END
""", **QA_VIEWS))
def eval_samples_cot(spark, sf_dir):
    """C5 with chain-of-thought prompts for one of the datasets."""
    r = P.eval_split(rendered_union(spark, sf_dir, cot={"math"}))
    return r.select("dataset", "conv_id", "turn", "prompt", F.col("response").alias("reference"))


@query("prompts_math_only", Q.with_views("SELECT * FROM rendered WHERE dataset = 'math'", **QA_VIEWS))
def prompts_math_only(spark, sf_dir):
    """B1: the whitelist removes the other branch from the plan."""
    return rendered_union(spark, sf_dir, ["math"]).select(
        "dataset", "split", "conv_id", "turn", "prompt", "response")


@query("standard_schema", Q.with_views("""
SELECT conv_id, turn, coalesce(CAST(question AS VARCHAR), '') AS instruction, '' AS input,
       coalesce(CAST(answer AS VARCHAR), '') AS output FROM fx_qa
""", fx_qa=Q.FX_QA))
def standard_schema(spark, sf_dir):
    qa = TB.fx_qa(spark, sf_dir)
    return P.to_standard_schema(qa, {"instruction": ["question", "problem"], "output": "answer"},
                                "instruction", keep=["conv_id", "turn"])


@query("cot_messages", Q.with_views(f"""
SELECT sample_id, CAST(to_json([{{'role': 'user', 'content': concat(query, {Q.lit(P.COT_SUFFIX)})}}]) AS VARCHAR) AS messages_json,
       concat(query, {Q.lit(P.COT_SUFFIX)}) AS chat_text
FROM usable
""", **USABLE_VIEWS))
def cot_messages(spark, sf_dir):
    u = usable(spark, sf_dir).withColumn("messages", P.cot_messages("query"))
    return u.select("sample_id", F.to_json("messages").alias("messages_json"),
                    P.join_messages("messages").alias("chat_text"))


@query("chat_join", """
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       string_agg(coalesce(text, ''), concat(chr(10), chr(10)) ORDER BY turn) AS chat_text
FROM conversations GROUP BY conv_id
""")
def chat_join(spark, sf_dir):
    conv = TB.load(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    return P.join_turns(conv)


@query("split_solution", Q.with_views(f"""
SELECT conv_id, turn,
  CASE WHEN strpos(t, '####') > 0 THEN {Q.pystrip("substr(t, 1, length(t) - length(split_part(t, '####', -1)) - 4)")}
       ELSE {Q.pystrip('t')} END AS reasoning,
  CASE WHEN strpos(t, '####') > 0 THEN {Q.pystrip("split_part(t, '####', -1)")} END AS final_answer
FROM (SELECT conv_id, turn, CASE WHEN conv_id % 2 = 1
        THEN concat(answer, chr(10), '#### ', CAST(length(question) AS VARCHAR)) ELSE answer END AS t FROM fx_qa)
""", fx_qa=Q.FX_QA))
def split_solution(spark, sf_dir):
    qa = TB.fx_qa(spark, sf_dir)
    t = F.when(F.col("conv_id") % 2 == 1,
               F.concat("answer", F.lit("\n#### "), F.length("question").cast("string"))).otherwise(F.col("answer"))
    reasoning, final = P.split_solution(t, "####")
    return qa.select("conv_id", "turn", reasoning.alias("reasoning"), final.alias("final_answer"))


@query("token_clean", """
SELECT token, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN length(s) > 16 THEN concat(substr(s, 1, 15), '…') ELSE s END AS token FROM (
    SELECT replace(replace(replace(replace(w, 'Ġ', ' '), '▁', ' '), chr(10), concat(chr(92), 'n')), chr(9), concat(chr(92), 't')) AS s
    FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)))
GROUP BY token
""")
def token_clean(spark, sf_dir):
    docs = TB.load(spark, sf_dir, "documents", ["text"])
    words = docs.select(F.explode(F.split("text", " ")).alias("w"))
    return words.groupBy(P.clean_token("w").alias("token")).agg(F.count(F.lit(1)).alias("n"))
