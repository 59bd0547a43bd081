"""Grading: pairing, normalisation, exact match, accuracy and its roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.answers import (
    ANSWER_MARK, BOXED, boxed_answer, latex_to_plain, normalize_for_dataset, normalize_number_string, numbers_match, to_number,
)
from ..functions.text import col_of, pystrip
from ..session import literal_table

KEY = ["dataset", "sample_id"]


def one_prediction(predictions: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ()) -> DataFrame:
    """One row a key: the prediction that is last in ``order`` (columns, most
    important first; ties, and no order at all, by the text itself), how many
    there are, and whether they differ.

    ``max_by`` and the counts merge map-side, so a key with a third of all
    predictions is one row a task.  The outcome depends on the rows only, never
    on where or when they arrive.  A null prediction comes before every text.
    """
    rank = F.struct(*[F.col(c) for c in order], F.col("prediction"))
    return predictions.groupBy(*keys).agg(
        F.max_by("prediction", rank).alias("prediction"), F.count(F.lit(1)).alias("n_predictions"),
        ((F.min("prediction") != F.max("prediction")) | ((F.count("prediction") > 0) & (F.count("prediction") < F.count(F.lit(1)))))
        .alias("conflict"))


def pair(references: DataFrame, predictions: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = (),
         report: bool = False) -> DataFrame:
    """H3: every reference with its prediction (positional zip becomes a key join).

    As many rows as references: of several predictions with one key the one that
    ``one_prediction`` takes counts; a reference without any scores as an empty
    prediction.  ``report`` adds ``n_predictions`` and ``conflict``.  Both sides
    are hash-partitioned on the key (or the smaller one broadcast by AQE).
    """
    preds = one_prediction(predictions, keys, order)
    out = (references.join(preds, list(keys), "left")
           .withColumns({"prediction": F.coalesce(F.col("prediction"), F.lit("")),
                         "n_predictions": F.coalesce(F.col("n_predictions"), F.lit(0)),
                         "conflict": F.coalesce(F.col("conflict"), F.lit(False))}))
    return out if report else out.drop("n_predictions", "conflict")


def strip_echo(output, prompt) -> Column:
    """Cut a leading copy of the prompt from the generated text, strip either way."""
    out, p = col_of(output), col_of(prompt)
    cut = F.when(F.startswith(out, p), F.substr(out, F.length(p) + 1)).otherwise(out)
    return pystrip(cut)


def grade(df: DataFrame, dataset: str = "dataset", prediction: str = "prediction",
          reference: str = "reference") -> DataFrame:
    """H4/H5/H7: normalised prediction and reference and the exact-match flag.

    The strip is computed once per text in its own projection; the rules then
    work on the stripped column, which keeps each generated stage small.
    """
    staged = df.withColumns({"_p": pystrip(prediction), "_r": pystrip(reference)})
    return (staged.withColumns({"pred_norm": normalize_for_dataset(dataset, "_p", stripped=True),
                                "ref_norm": normalize_for_dataset(dataset, "_r", stripped=True)})
            .withColumn("correct", F.col("pred_norm") == F.col("ref_norm"))
            .drop("_p", "_r"))


def accuracy(graded: DataFrame, by: Sequence[str] = ("dataset",),
             requested: Sequence[str] | None = None) -> DataFrame:
    """H6: ``correct/total`` per group, 0.0 for a requested group with no rows.

    Partial aggregation happens map-side, so the shuffle carries one row per
    group per task whatever the skew.  ``requested`` (a short list of dataset
    names from the job's configuration) becomes a tiny spine that is
    broadcast-joined so absent datasets still report.
    """
    agg = graded.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("correct")).alias("correct"),
    )
    if requested is not None:
        if list(by) != ["dataset"]:
            raise ValueError("requested datasets need grouping by dataset")
        spark = graded.sparkSession
        spine = literal_table(spark, [(d,) for d in requested], "dataset string")
        agg = (F.broadcast(spine).join(agg, "dataset", "left")
               .select("dataset",
                       F.coalesce("total", F.lit(0)).cast("bigint").alias("total"),
                       F.coalesce("correct", F.lit(0)).cast("bigint").alias("correct")))
    return agg.withColumn(
        "accuracy",
        F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(F.lit(0.0)))


def select_eval_datasets(spark: SparkSession, requested: Sequence[str],
                         available: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B2: (kept, skipped) requested dataset names, by semi / anti join."""
    req = literal_table(spark, [(d,) for d in requested], "dataset string")
    avail = available.select("dataset").distinct()
    kept = req.join(avail, "dataset", "left_semi")
    skipped = req.join(avail, "dataset", "left_anti")
    return kept, skipped


def scored_samples(graded: DataFrame) -> DataFrame:
    """H7: per-row normalised prediction/reference plus the raw prediction."""
    return graded.select(
        "dataset", "sample_id",
        F.col("pred_norm").alias("prediction"),
        F.col("ref_norm").alias("reference"),
        F.col("prediction").alias("raw_prediction"),
        "correct",
    )


def accuracy_by_category(graded: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H8: accuracy and mean prediction length for every prefix of ``cols``.

    ``rollup`` expands each input row map-side into len(cols)+1 grouping sets
    and aggregates them in the same exchange.
    """
    cols = list(cols)
    return (graded.rollup(*cols)
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("correct")).alias("correct"),
                 F.avg(F.length("prediction").cast("double")).alias("mean_pred_len"),
                 F.grouping_id().cast("int").alias("grouping_level"))
            .withColumn("accuracy", F.col("correct") / F.col("total")))


def _cleaned(graded: DataFrame, prediction: str, reference: str) -> DataFrame:
    """``graded`` with ``_pc`` and ``_rc``: the plain number strings of both answers.

    An answer is read from the first balanced box of the raw text, else from the
    grader's normalised answer (which stops at the first brace).  Boxes, then
    clean-up, as projections of their own: each runs once a row.
    """
    boxes = graded.withColumns({"_pc": F.coalesce(boxed_answer(prediction), F.col("pred_norm")),
                                "_rc": F.coalesce(boxed_answer(reference), F.col("ref_norm"))})
    plain = boxes.withColumns({c: latex_to_plain(c) for c in ("_pc", "_rc")})
    return plain.withColumns({c: normalize_number_string(c) for c in ("_pc", "_rc")})


def error_type(graded: DataFrame, dataset: str = "dataset", prediction: str = "prediction",
               reference: str = "reference") -> DataFrame:
    """H9: a category per graded row.

    correct / empty_prediction / no_answer_marker (the grader had no marker to
    anchor on) / format_only (equal after LaTeX and number clean-up) /
    wrong_value.
    """
    d = F.lower(F.col(dataset))
    raw = F.col(prediction)
    marker = F.when(d == "math", raw.rlike(BOXED)).otherwise(raw.rlike(ANSWER_MARK))
    kind = (F.when(F.col("correct"), F.lit("correct"))
            .when(raw.isNull() | (pystrip(raw) == ""), F.lit("empty_prediction"))
            .when(F.col("_pc") == F.col("_rc"), F.lit("format_only"))
            .when(~marker, F.lit("no_answer_marker"))
            .otherwise(F.lit("wrong_value")))
    return _cleaned(graded, prediction, reference).withColumn("error_type", kind).drop("_pc", "_rc")


def numeric_match(graded: DataFrame, tol: float = 1e-6, prediction: str = "prediction",
                  reference: str = "reference") -> DataFrame:
    """Tolerant numeric comparison of the answers (see ``_cleaned``)."""
    parsed = _cleaned(graded, prediction, reference).withColumns({"_pn": to_number("_pc", cleaned=True),
                                                                  "_rn": to_number("_rc", cleaned=True)})
    return (parsed.withColumn("numeric_correct",
                              F.col("correct") | numbers_match("_pn", "_rn", tol, parsed=True))
            .drop("_pc", "_rc", "_pn", "_rn"))


def merge_verdicts(log: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ("version",),
                   verdict: str = "verdict") -> DataFrame:
    """One row a key of a review log: the verdict that is last in ``order``
    (ties: true wins), how many there are, and whether they disagree.

    A last verdict that is null withdraws the review of its key.  ``max_by``
    merges map-side, so a key that a third of the log is about is one row a task.
    """
    v = F.col(verdict).cast(T.BooleanType())
    return log.groupBy(*keys).agg(
        F.max_by(v, F.struct(*[F.col(c) for c in order], v)).alias("verdict"), F.count(F.lit(1)).alias("n_verdicts"),
        F.coalesce(F.min(v) != F.max(v), F.lit(False)).alias("disputed"))


def review_conflicts(log: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ("version",),
                     verdict: str = "verdict") -> DataFrame:
    """The keys whose verdicts disagree, with the one that holds."""
    return merge_verdicts(log, keys, order, verdict).where("disputed").drop("disputed")


def rescore(graded: DataFrame, overrides: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = (),
            verdict: str = "correct_override") -> DataFrame:
    """Apply manual / secondary verdicts ``(keys..., verdict)``, a log in which a
    key may occur any number of times (see ``merge_verdicts``).

    As many rows as ``graded``: the log is merged to one verdict a key first, and
    the left join keeps every graded row.
    """
    held = merge_verdicts(overrides, keys, order, verdict).select(*keys, F.col("verdict").alias("_verdict"))
    return (graded.join(held, list(keys), "left")
            .withColumn("rescored", F.coalesce(F.col("_verdict"), F.col("correct")))
            .drop("_verdict"))


def unparsed(graded: DataFrame, dataset: str = "dataset", prediction: str = "prediction") -> DataFrame:
    """H13 log: rows where the grader found no answer marker in the prediction."""
    d = F.lower(F.col(dataset))
    raw = F.col(prediction)
    marker = F.when(d == "math", raw.rlike(BOXED)).otherwise(raw.rlike(ANSWER_MARK))
    return graded.where(~F.coalesce(marker, F.lit(False)))
