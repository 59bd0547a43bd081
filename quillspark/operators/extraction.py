"""Query text and difficulty level from loosely-typed records.

Records arrive as JSON; fields can be strings, numbers, objects or null.  The
rules look at the JSON type of each value, so they run on a ``VARIANT`` column
(``parse_json`` / ``try_parse_json``) and stay JVM-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.answers import number_from_text
from ..functions.text import WS_CLASS, col_of, let, pystrip
from ..session import literal_table

# --- fixed values: field names searched for the query text, in order --------
QUERY_FIELDS = ["problem", "question", "query", "prompt", "instruction", "input"]
NESTED_QUERY_FIELDS = ["problem", "question", "prompt"]
LEVELS = [1, 2, 3, 4, 5]
# --------------------------------------------------------------------------


def _json_string(v: Column, path: str) -> Column:
    """The value at ``path`` when it is a JSON string, else null."""
    sub = F.variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(sub) == "STRING", F.variant_get(sub, "$", "string"))


NON_BLANK = WS_CLASS[:1] + "^" + WS_CLASS[1:]      # any character that is not Python whitespace


def get_query(record) -> Column:
    """First non-blank string among the query fields, then inside a ``query``
    object; returned unstripped; null when there is none.

    The candidates form one array and a single lambda picks the first usable
    one.  This is faster than nine inlined checks here and keeps the generated
    code small (the inlined form overflows the 64 KB method limit once a
    filter on the result is pushed down and duplicates it).
    """
    v = col_of(record)
    paths = [f"$.{k}" for k in QUERY_FIELDS] + [f"$.query.{k}" for k in NESTED_QUERY_FIELDS]
    cands = F.array(*[F.variant_get(v, p, "variant") for p in paths])
    good = F.filter(cands, lambda x: (F.schema_of_variant(x) == "STRING")
                    & F.variant_get(x, "$", "string").rlike(NON_BLANK))
    return F.variant_get(F.try_element_at(good, F.lit(1)), "$", "string")


INT_TEXT = r"\A[+-]?[0-9]+(_[0-9]+)*\z"


def parse_level_text(c) -> Column:
    """D2 for text: an optionally signed integer with surrounding whitespace
    (``" 5 "`` -> 5); ``"5.0"`` and ``"Level 5"`` give null."""
    s = pystrip(col_of(c))
    return F.when(s.rlike(INT_TEXT), F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint"))


def parse_level(record) -> Column:
    """D2 on a VARIANT record: numbers truncate toward zero (5.7 -> 5), booleans
    count as 0/1, strings follow ``parse_level_text``; anything else is null."""
    def level(sub: Column) -> Column:
        def by_kind(kind: Column) -> Column:
            num = F.try_variant_get(sub, "$", "double")
            as_num = F.when(~F.isnan(num) & (F.abs(num) < F.lit(9.2e18)), num.cast("bigint"))
            return (F.when(kind == "STRING", parse_level_text(F.variant_get(sub, "$", "string")))
                    .when(kind == "BOOLEAN", F.variant_get(sub, "$", "boolean").cast("bigint"))
                    .when(kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"), as_num))

        return let(F.schema_of_variant(sub), by_kind)

    return let(F.variant_get(col_of(record), "$.level", "variant"), level)


def parse_level_column(c, dtype: T.DataType) -> Column:
    """D2 on a typed column (string or numeric)."""
    c = col_of(c)
    if isinstance(dtype, T.StringType):
        return parse_level_text(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c.cast("bigint"))
    return c.cast("bigint")


def with_query_and_level(df: DataFrame, record: str = "record") -> DataFrame:
    """D1 + D2 as columns ``query`` and ``level``.

    They come out of a one-row ``inline`` so that later filters on them
    (B3/B4) stay above this step instead of being pushed down, duplicated,
    into the scan stage (below a round-robin spread of a small input).
    """
    one = F.inline(F.array(F.struct(get_query(F.col(record)).alias("query"),
                                    parse_level(F.col(record)).alias("level"))))
    return df.select("*", one)


def has_query(df: DataFrame, query_col: str = "query") -> DataFrame:
    """B3"""
    return df.where(F.col(query_col).isNotNull())


def valid_level(df: DataFrame, level_col: str = "level") -> DataFrame:
    """Levels 1..5 only."""
    return df.where(F.col(level_col).between(LEVELS[0], LEVELS[-1]))


def level_sizes(df: DataFrame, level_col: str = "level") -> DataFrame:
    """D3: usable rows per level, zero-filled for 1..5 (tiny spine, broadcast)."""
    spark = df.sparkSession
    spine = literal_table(spark, [(lv,) for lv in LEVELS], f"{level_col} bigint")
    counts = df.groupBy(F.col(level_col).cast("bigint").alias(level_col)).agg(
        F.count(F.lit(1)).alias("n"))
    return (F.broadcast(spine).join(counts, level_col, "left")
            .select(level_col, F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def validate_records(df: DataFrame, by: Sequence[str] = ("dataset",), raw: str = "raw",
                     record: str = "record", id_col: str = "sample_id") -> DataFrame:
    """Format and annotation defects per dataset.

    Counts rows, blank lines, unparseable JSON, missing query, unusable level,
    answers with no number in them, and rows whose id occurs more than once.
    Duplicates are counted with a two-level aggregate (per id, then per dataset) so a hot id is pre-aggregated
    map-side rather than gathered by a window.
    """
    by = list(by)
    flags = df.select(
        *by, id_col,
        F.col(record).isNull().alias("_corrupt"),
        (F.col(record).isNotNull() & get_query(F.col(record)).isNull()).alias("_noq"),
        (F.col(record).isNotNull()
         & F.coalesce(let(parse_level(F.col(record)), lambda x: ~x.between(LEVELS[0], LEVELS[-1])), F.lit(True))
         ).alias("_badlvl"),
        (F.col(raw).isNull() | (pystrip(F.col(raw)) == "")).alias("_blank"),
        (F.col(record).isNotNull() & F.coalesce(
            (F.schema_of_variant(F.variant_get(F.col(record), "$.answer", "variant")) == "STRING")
            & number_from_text(F.variant_get(F.col(record), "$.answer", "string")).isNull(),
            F.lit(False))).alias("_noans"))
    per_id = flags.groupBy(*by, id_col).agg(
        F.count(F.lit(1)).alias("_c"),
        F.count_if("_corrupt").alias("_corrupt"),
        F.count_if("_noq").alias("_noq"),
        F.count_if("_badlvl").alias("_badlvl"),
        F.count_if("_blank").alias("_blank"),
        F.count_if("_noans").alias("_noans"))
    return per_id.groupBy(*by).agg(
        F.sum("_c").cast("bigint").alias("n_rows"),
        F.sum("_blank").cast("bigint").alias("n_blank"),
        F.sum("_corrupt").cast("bigint").alias("n_corrupt"),
        F.sum("_noq").cast("bigint").alias("n_no_query"),
        F.sum("_badlvl").cast("bigint").alias("n_bad_level"),
        F.sum("_noans").cast("bigint").alias("n_unparsed_answer"),
        F.sum(F.when(F.col("_c") > 1, F.col("_c")).otherwise(F.lit(0))).cast("bigint").alias("n_duplicate_id"))
