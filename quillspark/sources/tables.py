"""Driver tables and the stand-in views derived from them.

The test data holds no word problems, attention weights or training logs, so
these views derive them from the given tables with plain Spark expressions
(see FIXTURES.md §3).  Each view reads only the columns it needs, so the
Parquet scan is pruned, and each grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    """Read a table (only ``cols`` when given).  How a file is split is the
    session's business (``spark.sql.files.*``), at every size."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols is not None else df


def fx_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it (turn + 1).

    An equi-join on the unique key (conv_id, turn): rows hash-spread evenly
    even when one conversation holds a large share of all turns (a ``lead``
    window would put that conversation in one task).
    """
    conv = load(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    u = conv.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"], "inner")


def fx_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with a difficulty level 1..5; one in seven is blank."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return o.select(
        F.col("o_orderkey").alias("sample_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("level"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("  "))
         .otherwise(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"),
                             F.lit(" status "), F.col("o_orderstatus"))).alias("question"),
    )


#: (prediction, reference) in other notations; C stands for a number of the row.
ODD_ANSWERS = [
    (r"so \boxed{\frac{C}{2}}", "C/2"), ("Answer: C.5 km", "C.5"), ("", "C"), ("Answer: $1,C", "1C"),
    (r"\boxed{C\frac{1}{2}}", "C.5"), ("+C", "C"), (".5", "0.5"), ("The answer is dog", "do"), (None, "C"),
    (r"Answer: C\%", "C"), ("Answer: C 1/2", "C.5"), (r"\boxed{\text{C}}", "C"), ("  ", "C"), (r"\boxed{\frac{1}{2}}", r"\boxed{\frac{1}{3}}"),
]


def fx_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions/references in the answer formats the graders distinguish."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    k, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    r = k % 6
    pred = (F.when(r == 0, F.concat(F.lit("so \\boxed{"), cust, F.lit("} done")))
            .when(r == 1, F.concat(F.lit("Answer: "), cust, F.lit(".")))
            .when(r == 2, F.concat(F.lit("step\n"), cust, F.lit("  .")))
            .when(r == 3, F.concat(F.lit("1,"), cust, F.lit("\ntail")))
            .when(r == 4, F.concat(cust, F.lit("\nunsure")))
            .otherwise(F.concat(F.lit("answer - \n"), (F.col("o_custkey") + 1).cast("string"))))
    ref = F.when(r == 3, F.concat(F.lit("Answer: 1"), cust)).otherwise(cust)
    # one row in five has an answer in another notation
    odd = (F.floor(k / 5) % len(ODD_ANSWERS) + 1).cast("int")

    def other(i: int):
        texts = F.array(*[F.lit(a[i]).cast("string") for a in ODD_ANSWERS])
        return F.replace(F.element_at(texts, odd), F.lit("C"), cust)

    pred, ref = F.when(k % 5 == 4, other(0)).otherwise(pred), F.when(k % 5 == 4, other(1)).otherwise(ref)
    return o.select(
        k.alias("sample_id"),
        F.when(k % 2 == 0, F.lit("math")).otherwise(F.lit("gsm8k")).alias("dataset"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("level"),
        pred.alias("prediction"),
        ref.alias("reference"),
    )


def fx_attn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long attention table: one 64-long key vector per (sample, layer, head).

    Every embedding row is used; 24 rows make one sample (6 layers x 4 heads),
    so a trailing partial sample simply has fewer layers.
    """
    e = load(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    s = F.floor(F.col("vec_id") / 24).cast("int")
    return e.select(
        s.alias("sample"),
        (s % 5 + 1).alias("level"),
        (F.floor(F.col("vec_id") / 4).cast("int") % 6).alias("layer"),
        (F.col("vec_id") % 4).cast("int").alias("head"),
        F.posexplode("embedding").alias("pos", "w"),
    ).select("sample", "level", "layer", "head", "pos",
             F.abs(F.col("w")).cast("double").alias("weight"))


def fx_attn_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (sample, level) pairs present in ``fx_attn``, from the vector rows
    themselves (no explode of the weights)."""
    e = load(spark, sf_dir, "embeddings", ["vec_id"])
    s = F.floor(F.col("vec_id") / 24).cast("int")
    return e.select(s.alias("sample"), (s % 5 + 1).alias("level")).distinct()


def fx_trainlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation log: run, step, nullable loss."""
    ev = load(spark, sf_dir, "events", ["user_id", "event_id", "event_type", "value", "ts"])
    return ev.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("global_step"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .otherwise(F.col("value")).alias("eval_loss"),
        "ts",
    )


def fx_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loosely typed JSON lines built from ``fx_graded``: the query sits in
    different fields (or an object), levels come as ints, floats, padded text,
    ``"Level n"``, ``"n.0"`` or out of range, and some lines are malformed.
    Columns: dataset, sample_id, raw (the line) and record (VARIANT)."""
    g = fx_graded(spark, sf_dir)
    k, q, lv = F.col("sample_id"), F.col("question"), F.col("level").cast("string")

    def j(*parts):
        return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])

    r = k % 8
    raw = (F.when(r == 0, j('{"problem": "  ", "question": "', q, '", "level": ', lv, '}'))
           .when(r == 1, j('{"query": {"problem": "', q, '"}, "level": "Level ', lv, '"}'))
           .when(r == 2, j('{"prompt": "', q, '", "level": " ', lv, ' "}'))
           .when(r == 3, j('{"problem": 7, "input": "', q, '", "level": ', lv, '.7}'))
           .when(r == 4, j('{"instruction": "", "query": "", "level": "', lv, '.0"}'))
           .when(r == 5, j('{"question": null, "query": {"question": "', q, '"}, "level": ', lv, '}'))
           .when(r == 6, j('{"question": "', q, '", "level": ', (F.col("level") + 1).cast("string"), '}'))
           .otherwise(j('{"question": "', q, '", "level": ', (F.col("level") - 1).cast("string"), '}')))
    raw = F.when(k % 13 == 0, j('{"question": "', q, '", ')).otherwise(raw)
    return g.select(
        F.when(k % 2 == 0, F.lit("math")).otherwise(F.lit("gsm8k")).alias("dataset"),
        k.alias("sample_id"), raw.alias("raw")).withColumn("record", F.try_parse_json("raw"))
