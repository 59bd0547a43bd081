"""Evaluation entry point (grading family): H1-H14, C8, C5, B2."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers as A
from ..operators import scoring as S
from ..sources import tables as TB
from . import sqltext as Q
from .registry import query

EVAL_DATASETS = ["math", "gsm8k"]     # eval configuration: datasets to report


def graded_pred(spark, sf_dir):
    return S.grade(TB.fx_pred(spark, sf_dir))


def accuracy_by_dataset(spark, sf_dir):
    g = graded_pred(spark, sf_dir)
    return S.accuracy(g, requested=EVAL_DATASETS).select("dataset", "total", "correct", "accuracy")


GRADED_SQL = f"""
SELECT *, pred_norm = ref_norm AS correct FROM (
  SELECT *, {Q.normalize_for_dataset('dataset', 'prediction')} AS pred_norm,
            {Q.normalize_for_dataset('dataset', 'reference')} AS ref_norm
  FROM fx_pred)
"""

query("accuracy_by_dataset", Q.with_views("""
SELECT r.dataset, CAST(coalesce(count(g.sample_id), 0) AS BIGINT) AS total,
       CAST(coalesce(count_if(g.correct), 0) AS BIGINT) AS correct,
       CASE WHEN count(g.sample_id) > 0 THEN count_if(g.correct) / count(g.sample_id) ELSE 0.0 END AS accuracy
FROM (VALUES ('math'), ('gsm8k')) r(dataset) LEFT JOIN graded g ON g.dataset = r.dataset
GROUP BY r.dataset
""", fx_pred=Q.FX_PRED, graded=GRADED_SQL))(accuracy_by_dataset)


@query("scored_samples", Q.with_views("""
SELECT dataset, sample_id, pred_norm AS prediction, ref_norm AS reference,
       prediction AS raw_prediction, correct FROM graded
""", fx_pred=Q.FX_PRED, graded=GRADED_SQL))
def scored_samples(spark, sf_dir):
    return S.scored_samples(graded_pred(spark, sf_dir))


@query("accuracy_rollup", Q.with_views("""
SELECT dataset, level, CAST(count(*) AS BIGINT) AS total, CAST(count_if(correct) AS BIGINT) AS correct,
       round(avg(CAST(length(prediction) AS DOUBLE)), 6) AS mean_pred_len,
       CAST(grouping(dataset, level) AS INT) AS grouping_level,
       count_if(correct) / count(*) AS accuracy
FROM graded GROUP BY ROLLUP (dataset, level)
""", fx_pred=Q.FX_PRED, graded=GRADED_SQL))
def accuracy_rollup(spark, sf_dir):
    out = S.accuracy_by_category(graded_pred(spark, sf_dir), ["dataset", "level"])
    return out.withColumn("mean_pred_len", F.round("mean_pred_len", 6))


# The SQL spells the rules out by itself; it shares no pattern with the code.
_WS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _replaced(e, *rules):
    for pattern, new in rules:
        e = f"regexp_replace({e}, {Q.lit(pattern)}, {new if new.startswith('chr') or new.startswith('concat') else Q.lit(new)}, 'g')"
    return e


def latex_sql(e):
    """The rewrites on texts of the views: no text command or fraction stands in another's argument there."""
    one = r"(?:\{\s*([0-9]+)\s*\}|([0-9]))"
    arg = r"(?:\{([^{}]*)\}|([0-9A-Za-z]))"
    e = _replaced(e, (r"\\(?:text|mathrm|mathbf|textbf|mbox)\s*\{([^{}]*)\}", r"\1"), (r"\\boxed\s*\{", "{"),
                  (rf"([0-9])\s*\\[cdt]?frac\s*{one}\s*{one}", r"concat('\1', chr(1), '\2\3/\4\5')"),
                  (rf"\\[cdt]?frac\s*{arg}\s*{arg}", r"(\1\2)/(\3\4)"), (r"\\left|\\right", ""), (r"\^\{?\\circ\}?", ""),
                  (r"\\[,;:! ]", ""), (r"\\cdot|\\times", "*"), (r"\\%", "%"), (r"[{}]+", ""),
                  (r"([0-9])\s+([0-9]+)\s*/\s*([0-9]+)", r"concat('\1', chr(1), '\2/\3')"),
                  (r"\\?\$", ""), (r"\(([0-9.\-]+)\)", r"\1"), (_WS + "+", ""))
    return f"replace({e}, chr(1), ' ')"


def numstr_sql(e):
    """Units that occur in the views."""
    return _replaced(e, (r"\$", ""), (r"([0-9]),", r"\1"), (r"(?i)([0-9])" + _WS + r"*(?:%|km)\.?$", r"\1"),
                     (r"(?i)^([+-]?[0-9]+)" + _WS + r"*(?:tail|unsure|done)$", r"\1"), (_WS + "+$|^" + _WS + "+", ""), (r"\.$", ""))


def boxes_sql(source, key, text):
    """(key, box): content of the first closed box, from the running depth of every
    character; a brace after a single backslash does not count."""
    return f"""
  SELECT {key}, arg_min(substr(t, i + 7, j - i - 7), i) AS box
  FROM (SELECT o.{key}, o.t, o.i, min(c.i) AS j
        FROM (SELECT * FROM depths WHERE substr(t, i, 7) = '\\boxed{{') o
        JOIN (SELECT * FROM depths WHERE ch = '}}' AND step = -1) c ON c.{key} = o.{key} AND c.i > o.i AND c.after = o.after
        GROUP BY o.{key}, o.t, o.i) GROUP BY {key}""".replace("depths", f"""(
    SELECT *, sum(step) OVER (PARTITION BY {key} ORDER BY i) AS after
    FROM (SELECT {key}, t, i, substr(t, i, 1) AS ch,
                 CASE WHEN i > 1 AND substr(t, i - 1, 1) = '\\' AND (i < 3 OR substr(t, i - 2, 1) <> '\\') THEN 0
                      WHEN substr(t, i, 1) = '{{' THEN 1 WHEN substr(t, i, 1) = '}}' THEN -1 ELSE 0 END AS step
          FROM (SELECT {key}, {text} AS t, unnest(range(1, length({text}) + 1)) AS i FROM {source} WHERE contains({text}, '\\boxed{{'))))""")


def answers_sql(columns):
    """Graded rows with the answer texts pa and ra, as ``columns`` wants them."""
    return f"""
SELECT {columns} FROM (
  SELECT g.*, coalesce(pb.box, pred_norm) AS pa, coalesce(rb.box, ref_norm) AS ra
  FROM graded g LEFT JOIN ({boxes_sql('graded', 'sample_id', 'prediction')}) pb USING (sample_id)
  LEFT JOIN ({boxes_sql('graded', 'sample_id', 'reference')}) rb USING (sample_id))
"""


PRED_ANSWER, REF_ANSWER = "pa", "ra"


def _marker_sql():
    return (f"CASE WHEN lower(dataset) = 'math' THEN regexp_matches(prediction, {Q.lit(A.BOXED)}) "
            f"ELSE regexp_matches(prediction, {Q.lit(A.ANSWER_MARK)}) END")


ERROR_SQL = answers_sql(f"""dataset, sample_id, correct,
  CASE WHEN correct THEN 'correct'
       WHEN prediction IS NULL OR {Q.pystrip('prediction')} = '' THEN 'empty_prediction'
       WHEN {numstr_sql(latex_sql(PRED_ANSWER))} = {numstr_sql(latex_sql(REF_ANSWER))} THEN 'format_only'
       WHEN NOT ({_marker_sql()}) THEN 'no_answer_marker'
       ELSE 'wrong_value' END AS error_type""")


@query("error_types", Q.with_views(ERROR_SQL, fx_pred=Q.FX_PRED, graded=GRADED_SQL))
def error_types(spark, sf_dir):
    return S.error_type(graded_pred(spark, sf_dir)).select("dataset", "sample_id", "correct", "error_type")


def to_number_sql(e):
    s = numstr_sql(e)

    def part(pattern, group):
        return f"TRY_CAST(regexp_extract({s}, {Q.lit(pattern)}, {group}) AS DOUBLE)"

    num = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)"
    frac = rf"^([+-]?)\(?([+-]?{num})\)?/\(?([+-]?{num})\)?$"
    mixed = r"^([+-]?)([0-9]+) ([0-9]+)/([0-9]+)$"

    def sign(pattern):
        return f"CASE WHEN regexp_extract({s}, {Q.lit(pattern)}, 1) = '-' THEN -1 ELSE 1 END"

    plain = f"CASE WHEN regexp_matches({s}, {Q.lit(rf'^[+-]?{num}$')}) THEN TRY_CAST({s} AS DOUBLE) END"
    as_mixed = f"CASE WHEN {part(mixed, 4)} <> 0 THEN {sign(mixed)} * ({part(mixed, 2)} + {part(mixed, 3)} / {part(mixed, 4)}) END"
    as_frac = f"CASE WHEN {part(frac, 3)} <> 0 THEN {sign(frac)} * {part(frac, 2)} / {part(frac, 3)} END"
    return f"coalesce({plain}, {as_mixed}, {as_frac})"


def numbers_match_sql(a, b, tol=1e-6):
    x, y = to_number_sql(a), to_number_sql(b)
    return f"coalesce(abs({x} - {y}) <= {tol!r} * greatest(1.0, abs({y})), false)"


NUMERIC_SQL = answers_sql(f"""dataset, sample_id, correct,
       correct OR {numbers_match_sql(latex_sql(PRED_ANSWER), latex_sql(REF_ANSWER))} AS numeric_correct""")


@query("numeric_match", Q.with_views(NUMERIC_SQL, fx_pred=Q.FX_PRED, graded=GRADED_SQL))
def numeric_match(spark, sf_dir):
    return S.numeric_match(graded_pred(spark, sf_dir)).select(
        "dataset", "sample_id", "correct", "numeric_correct")


RESCORE_SQL = """
SELECT dataset, CAST(count(*) AS BIGINT) AS total, CAST(count_if(correct) AS BIGINT) AS correct,
       CAST(count_if(coalesce(ov, correct)) AS BIGINT) AS rescored_correct,
       count_if(coalesce(ov, correct)) / count(*) AS rescored_accuracy
FROM (SELECT g.*, o.ov FROM graded g LEFT JOIN (
        SELECT dataset, sample_id, true AS ov FROM errors WHERE error_type = 'format_only') o
      USING (dataset, sample_id))
GROUP BY dataset
"""


@query("rescored", Q.with_views(RESCORE_SQL, fx_pred=Q.FX_PRED, graded=GRADED_SQL, errors=ERROR_SQL))
def rescored(spark, sf_dir):
    """Re-grade with reviewed verdicts; here the review accepts rows whose
    answers differ only in formatting (error type ``format_only``)."""
    g = graded_pred(spark, sf_dir)
    overrides = (S.error_type(g).where(F.col("error_type") == "format_only")
                 .select("dataset", "sample_id", F.lit(True).alias("correct_override")))
    r = S.rescore(g, overrides)
    return r.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("correct").alias("correct"),
        F.count_if("rescored").alias("rescored_correct"),
        (F.count_if("rescored") / F.count(F.lit(1))).alias("rescored_accuracy"))


@query("latex_plain", Q.with_views(f"""
SELECT dataset, sample_id, {latex_sql('prediction')} AS plain_prediction,
       {numstr_sql(latex_sql('prediction'))} AS plain_number FROM fx_pred
""", fx_pred=Q.FX_PRED))
def latex_plain(spark, sf_dir):
    p = TB.fx_pred(spark, sf_dir)
    return p.select("dataset", "sample_id",
                    A.latex_to_plain("prediction").alias("plain_prediction"),
                    A.normalize_number_string(A.latex_to_plain("prediction")).alias("plain_number"))


# --- H10/H11: boxes of any depth, over whole documents --------------------------

NEST = 60


def deep_boxes(spark, sf_dir):
    """Answers that hold a whole document in a box nested up to 60 levels; one in
    five with another box in front that is never closed, one in three with escaped braces."""
    d = TB.load(spark, sf_dir, "documents", ["doc_id", "text"])
    k = (F.col("doc_id") % NEST).cast("int")
    inner = F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit(r"\left\{ ")).otherwise(F.lit("")), F.coalesce("text", F.lit("")))
    box = F.concat(F.lit("so \\boxed{"), F.repeat(F.lit("\\text{"), k), inner, F.repeat(F.lit("}"), k), F.lit("} not \\boxed{2}"))
    return d.select("doc_id", F.concat(F.when(F.col("doc_id") % 5 == 0, F.lit("see \\boxed{ or {")).otherwise(F.lit("")), box).alias("answer"))


DEEP_SQL = """
SELECT doc_id, concat(CASE WHEN doc_id % 5 = 0 THEN 'see \\boxed{ or {' ELSE '' END, 'so \\boxed{', repeat('\\text{', doc_id % 60),
  CASE WHEN doc_id % 3 = 0 THEN '\\left\\{ ' ELSE '' END, coalesce(text, ''), repeat('}', doc_id % 60), '} not \\boxed{2}') AS answer
FROM documents
"""


@query("boxed_answers", Q.with_views(f"""
SELECT d.doc_id, length(answer) AS n_chars, length(box) AS box_chars, md5(box) AS box_md5
FROM deep d LEFT JOIN ({boxes_sql('deep', 'doc_id', 'answer')}) b USING (doc_id)
""", deep=DEEP_SQL))
def boxed_answers(spark, sf_dir):
    """The first closed box of every answer, whatever its depth and length."""
    box = deep_boxes(spark, sf_dir).withColumn("box", A.boxed_answer("answer"))
    return box.select("doc_id", F.length("answer").cast("long").alias("n_chars"), F.length("box").cast("long").alias("box_chars"),
                      F.md5(F.col("box").cast("binary")).alias("box_md5"))


# --- H12: numbers with what they measure ----------------------------------------

#: (text, what must be left), written by hand; N stands for a number of the row.
UNIT_CASES = [
    ("N km/h", "N"), ("N sq ft", "N"), ("N apples", "N"), ("N red apples", "N"), ("$N", "N"), ("N%", "N"), ("N m^2", "N"), ("N.5 kg", "N.5"),
    ("N miles per hour", "N"), ("N cubic centimeters", "N"), ("€N", "N"), ("N1,000 dollars.", "N1000"), ("N sqrt", "N sqrt"), ("N x", "N x"),
    ("x = N cm", "x = N"), ("N kilowatt·hours", "N"), ("-N °C", "-N"), ("N/2 cups", "N/2"), ("Nth", "Nth"), ("N meters/s^2", "N"),
    ("about N", "about N"), ("N 1/2 feet", "N 1/2"), ("kg", "kg"), ("N log", "N log"), ("N ML", "N"),
]


def unit_texts(spark, sf_dir):
    p = TB.load(spark, sf_dir, "part", ["p_partkey", "p_size"])
    n = F.col("p_size").cast("string")
    case = F.element_at(F.array(*[F.lit(t) for t, _ in UNIT_CASES]), (F.col("p_partkey") % len(UNIT_CASES) + 1).cast("int"))
    return p.select("p_partkey", F.replace(case, F.lit("N"), n).alias("text"))


_CASES_SQL = ", ".join(f"({i}, {Q.lit(t)}, {Q.lit(w)})" for i, (t, w) in enumerate(UNIT_CASES))


@query("unit_strings", f"""
SELECT p_partkey, replace(t, 'N', CAST(p_size AS VARCHAR)) AS text, replace(w, 'N', CAST(p_size AS VARCHAR)) AS number
FROM part JOIN (VALUES {_CASES_SQL}) v(i, t, w) ON p_partkey % {len(UNIT_CASES)} = i
""")
def unit_strings(spark, sf_dir):
    """Numbers without units, currencies and counted things."""
    return unit_texts(spark, sf_dir).withColumn("number", A.normalize_number_string("text"))


def number_from_text_sql(e):
    nums = f"regexp_extract_all({e}, {Q.lit(A.NUMBER)}, 0)"
    return f"CASE WHEN len({nums}) > 0 THEN replace(list_extract({nums}, -1), ',', '') END"


@query("number_from_text", f"""
SELECT 'pred' AS src, CAST(sample_id AS BIGINT) AS id, {number_from_text_sql('prediction')} AS number
FROM ({Q.FX_PRED})
UNION ALL
SELECT 'doc' AS src, doc_id AS id, {number_from_text_sql('text')} AS number FROM documents
""")
def number_from_text(spark, sf_dir):
    p = TB.fx_pred(spark, sf_dir).select(
        F.lit("pred").alias("src"), F.col("sample_id").alias("id"),
        A.number_from_text("prediction").alias("number"))
    d = TB.load(spark, sf_dir, "documents", ["doc_id", "text"]).select(
        F.lit("doc").alias("src"), F.col("doc_id").alias("id"),
        A.number_from_text("text").alias("number"))
    return p.unionByName(d)


# --- C8 / C5 over fx_qa --------------------------------------------------------

@query("strip_echo", Q.with_views(f"""
SELECT conv_id, turn, {Q.pystrip("CASE WHEN starts_with(output, question) THEN substr(output, length(question) + 1) ELSE output END")} AS generated
FROM (SELECT *, CASE WHEN conv_id % 2 = 0 THEN concat(question, answer) ELSE answer END AS output FROM fx_qa)
""", fx_qa=Q.FX_QA))
def strip_echo(spark, sf_dir):
    qa = TB.fx_qa(spark, sf_dir)
    out = F.when(F.col("conv_id") % 2 == 0, F.concat("question", "answer")).otherwise(F.col("answer"))
    return qa.select("conv_id", "turn", S.strip_echo(out, F.col("question")).alias("generated"))


# --- H3 / B2 ---------------------------------------------------------------------

REQUESTED = ["math", "gsm8k", "aqua"]     # eval configuration naming a dataset that has no data


def _refs_preds(spark, sf_dir):
    p = TB.fx_pred(spark, sf_dir)
    refs = p.select("dataset", "sample_id", "reference")
    # generation returned nothing for one sample in eleven
    preds = p.where(F.col("sample_id") % 11 != 0).select("dataset", "sample_id", "prediction")
    return refs, preds


@query("paired_accuracy", Q.with_views(f"""
SELECT dataset, CAST(count(*) AS BIGINT) AS total, CAST(count_if(correct) AS BIGINT) AS correct,
       count_if(correct) / count(*) AS accuracy
FROM (SELECT *, pred_norm = ref_norm AS correct FROM (
  SELECT dataset, {Q.normalize_for_dataset('dataset', 'prediction')} AS pred_norm,
         {Q.normalize_for_dataset('dataset', 'reference')} AS ref_norm
  FROM (SELECT r.dataset, r.sample_id, r.reference, coalesce(p.prediction, '') AS prediction
        FROM (SELECT dataset, sample_id, reference FROM fx_pred) r
        LEFT JOIN (SELECT dataset, sample_id, prediction FROM fx_pred WHERE sample_id % 11 <> 0) p
        USING (dataset, sample_id))))
GROUP BY dataset
""", fx_pred=Q.FX_PRED))
def paired_accuracy(spark, sf_dir):
    """H3: references joined to predictions by key; a missing prediction is ""."""
    refs, preds = _refs_preds(spark, sf_dir)
    return S.accuracy(S.grade(S.pair(refs, preds))).select("dataset", "total", "correct", "accuracy")


# --- H3 with repeats, H13 as a process -------------------------------------------

def attempts(spark, sf_dir):
    """References from the orders; predictions from their lines: one to seven
    attempts a reference, numbered, some of them null; references of some orders have none."""
    o = TB.load(spark, sf_dir, "orders", ["o_orderkey"])
    line = TB.load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    refs = o.select(F.when(F.col("o_orderkey") % 2 == 0, F.lit("math")).otherwise(F.lit("gsm8k")).alias("dataset"),
                    F.col("o_orderkey").alias("sample_id"), (F.col("o_orderkey") % 97).cast("string").alias("reference"))
    answer = (F.col("l_orderkey") + F.when(F.col("l_quantity") > 25, 0).otherwise(1)) % 97
    preds = line.where("l_orderkey % 13 <> 0").select(
        F.when(F.col("l_orderkey") % 2 == 0, F.lit("math")).otherwise(F.lit("gsm8k")).alias("dataset"),
        F.col("l_orderkey").alias("sample_id"), F.col("l_linenumber").alias("attempt"),
        F.when(F.col("l_quantity") % 9 != 0, F.concat(F.lit("Answer: "), answer.cast("string"), F.lit("\n")))
        .alias("prediction"))
    math = F.regexp_replace("prediction", "Answer: ", "it is\n")
    return refs, preds.withColumn("prediction", F.when(F.col("dataset") == "math", math).otherwise(F.col("prediction")))


_ATTEMPT_SQL = """
SELECT l_orderkey AS sample_id, l_linenumber AS attempt, l_quantity % 9 = 0 AS nothing,
       (l_orderkey + CASE WHEN l_quantity > 25 THEN 0 ELSE 1 END) % 97 AS value
FROM lineitem WHERE l_orderkey % 13 <> 0
"""


@query("paired_repeats", Q.with_views("""
SELECT dataset, CAST(count(*) AS BIGINT) AS total, CAST(count_if(correct) AS BIGINT) AS correct, count_if(correct) / count(*) AS accuracy,
       CAST(sum(n) AS BIGINT) AS n_predictions, CAST(count_if(conflict) AS BIGINT) AS conflicts
FROM (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'math' ELSE 'gsm8k' END AS dataset, coalesce(n, 0) AS n, coalesce(conflict, false) AS conflict,
         coalesce(NOT nothing AND value = o_orderkey % 97, false) AS correct
  FROM orders LEFT JOIN (SELECT sample_id, nothing, value FROM attempts QUALIFY row_number() OVER (
         PARTITION BY sample_id ORDER BY attempt DESC, nothing, CAST(value AS VARCHAR) DESC) = 1) last ON last.sample_id = o_orderkey
  LEFT JOIN (SELECT sample_id, count(*) AS n, count(DISTINCT CASE WHEN nothing THEN -1 ELSE value END) > 1 AS conflict
             FROM attempts GROUP BY sample_id) c ON c.sample_id = o_orderkey)
GROUP BY dataset
""", attempts=_ATTEMPT_SQL))
def paired_repeats(spark, sf_dir):
    """H3: several attempts a reference; the last one counts, the total is that of the references."""
    refs, preds = attempts(spark, sf_dir)
    graded = S.grade(S.pair(refs, preds, order=["attempt"], report=True))
    acc = S.accuracy(graded)
    more = graded.groupBy("dataset").agg(F.sum("n_predictions").alias("n_predictions"), F.count_if("conflict").alias("conflicts"))
    return acc.join(more, "dataset").select("dataset", "total", "correct", "accuracy", "n_predictions", "conflicts")


def verdicts(spark, sf_dir):
    """A review log from the order lines: several versions a sample, a null verdict withdraws."""
    line = TB.load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_suppkey"])
    return line.where("l_suppkey % 3 = 0").select(
        F.when(F.col("l_orderkey") % 2 == 0, F.lit("math")).otherwise(F.lit("gsm8k")).alias("dataset"),
        F.col("l_orderkey").alias("sample_id"), F.col("l_linenumber").alias("version"), F.col("l_suppkey").alias("reviewer"),
        F.when(F.col("l_quantity") % 10 != 0, F.col("l_quantity") > 25).alias("verdict"))


_VERDICT_SQL = """
SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'math' ELSE 'gsm8k' END AS dataset, l_orderkey AS sample_id, l_linenumber AS version,
       l_suppkey AS reviewer, CASE WHEN l_quantity % 10 <> 0 THEN l_quantity > 25 END AS verdict
FROM lineitem WHERE l_suppkey % 3 = 0
"""
_HELD_SQL = """
SELECT dataset, sample_id, verdict, n_verdicts, disputed FROM (
  SELECT *, count(*) OVER k AS n_verdicts, coalesce(bool_or(verdict) OVER k <> bool_and(verdict) OVER k, false) AS disputed,
         row_number() OVER (PARTITION BY dataset, sample_id ORDER BY version DESC, reviewer DESC, verdict DESC NULLS LAST) AS last
  FROM log WINDOW k AS (PARTITION BY dataset, sample_id)) WHERE last = 1
"""


@query("reviewed", Q.with_views("""
SELECT g.dataset, CAST(count(*) AS BIGINT) AS total, CAST(count_if(correct) AS BIGINT) AS correct,
       CAST(count_if(coalesce(verdict, correct)) AS BIGINT) AS rescored_correct, CAST(count_if(coalesce(verdict, correct) <> correct) AS BIGINT) AS changed
FROM graded g LEFT JOIN held h ON h.dataset = g.dataset AND h.sample_id = g.sample_id GROUP BY g.dataset
""", fx_pred=Q.FX_PRED, graded=GRADED_SQL, log=_VERDICT_SQL, held=_HELD_SQL))
def reviewed(spark, sf_dir):
    """Accuracy after a review log in which samples occur repeatedly."""
    r = S.rescore(graded_pred(spark, sf_dir), verdicts(spark, sf_dir), order=["version", "reviewer"], verdict="verdict")
    return r.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("correct").alias("correct"), F.count_if("rescored").alias("rescored_correct"),
        F.count_if(F.col("rescored") != F.col("correct")).alias("changed"))


@query("review_conflicts", Q.with_views("""
SELECT dataset, sample_id, verdict, CAST(n_verdicts AS BIGINT) AS n_verdicts FROM held WHERE disputed
""", log=_VERDICT_SQL, held=_HELD_SQL))
def review_conflicts(spark, sf_dir):
    """Samples whose reviews disagree, with the verdict that holds."""
    return S.review_conflicts(verdicts(spark, sf_dir), order=["version", "reviewer"])


@query("eval_datasets", Q.with_views("""
SELECT r.dataset, CASE WHEN a.dataset IS NULL THEN 'skipped' ELSE 'kept' END AS status
FROM (VALUES ('math'), ('gsm8k'), ('aqua')) r(dataset)
LEFT JOIN (SELECT DISTINCT dataset FROM fx_pred) a ON a.dataset = r.dataset
""", fx_pred=Q.FX_PRED))
def eval_datasets(spark, sf_dir):
    """B2: requested datasets kept (semi join) or skipped (anti join)."""
    kept, skipped = S.select_eval_datasets(spark, REQUESTED, TB.fx_pred(spark, sf_dir))
    return (kept.withColumn("status", F.lit("kept"))
            .unionByName(skipped.withColumn("status", F.lit("skipped"))))


@query("unparsed_log", Q.with_views(f"""
SELECT dataset, sample_id, prediction FROM graded WHERE NOT coalesce({_marker_sql()}, false)
""", fx_pred=Q.FX_PRED, graded=GRADED_SQL))
def unparsed_log(spark, sf_dir):
    """Samples whose prediction has no answer marker, for review."""
    return S.unparsed(graded_pred(spark, sf_dir)).select("dataset", "sample_id", "prediction")
