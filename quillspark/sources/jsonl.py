"""Line-delimited JSON sources (A1-A3) and the dataset union."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WS_CHARS
from ..operators.prompts import DatasetConfig

LOG = logging.getLogger(__name__)


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
               mode: str = "FAILFAST") -> DataFrame:
    """A1: one JSON object per line; blank and whitespace-only lines are skipped.

    With a schema there is no inference pass.  ``FAILFAST`` raises on a
    malformed line (the reference behaviour); ``PERMISSIVE`` keeps it in
    ``_corrupt_record`` for audits.
    """
    r = spark.read.option("mode", mode)
    if schema is not None:
        if mode == "PERMISSIVE" and isinstance(schema, T.StructType) and "_corrupt_record" not in schema.names:
            schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        r = r.schema(schema)
    return r.json(path if isinstance(path, str) else list(path))


#: Stands after a line's value while it is parsed: nothing may come between.
_END = "\u0007end of line"
#: What Python's ``json`` takes: repeated keys (the last one counts), NaN and infinities; nothing else beyond the standard.
TOLERANT = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "true", "allowSingleQuotes": "false", "allowUnquotedFieldNames": "false"}


def parse_lines(lines: DataFrame, raw: str = "raw", record: str = "record", mode: str = "FAILFAST") -> DataFrame:
    """``lines`` with each text of ``raw`` parsed into the VARIANT ``record``, taking what
    Python's ``json.loads`` takes: of a repeated key the last value counts, and
    ``NaN`` and ``Infinity`` are numbers.  One value a line: text after it makes the
    line malformed.  ``FAILFAST`` raises on a malformed line, ``PERMISSIVE`` gives a
    null record.

    Sets ``spark.sql.variant.allowDuplicateKeys`` for the session, which Spark reads
    when a query runs.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode}")
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # the value is the first of two: what follows a value is otherwise not looked at
    both = F.from_json(F.concat(F.lit("["), F.col(raw), F.lit(f',"{_END}"]'.replace("\u0007", "\\u0007"))), "variant", TOLERANT)
    d = lines.withColumn("_both", both)
    whole = F.coalesce(F.try_variant_get("_both", "$[1]", "string") == _END, F.lit(False))
    bad = F.lit(None) if mode == "PERMISSIVE" else F.raise_error(F.concat(F.lit("malformed JSON line: "), F.substring(raw, 1, 200)))
    return d.withColumn(record, F.when(whole, F.variant_get("_both", "$[0]", "variant")).otherwise(bad.cast("variant"))).drop("_both")


def read_jsonl_variant(spark: SparkSession, path: str | Sequence[str], mode: str = "FAILFAST") -> DataFrame:
    """A1 for loosely typed records: each line kept whole as ``raw`` and parsed
    into a ``record`` VARIANT (see ``parse_lines``).  Blank lines are dropped.
    ``PERMISSIVE`` leaves malformed lines with a null record, so that a caller can
    count them."""
    lines = spark.read.text(path if isinstance(path, str) else list(path)).withColumnRenamed("value", "raw")
    return parse_lines(lines.where(F.btrim("raw", F.lit(WS_CHARS)) != ""), mode=mode)


def read_splits(spark: SparkSession, cfg: DatasetConfig, schema: T.StructType | str | None = None,
                exists=None) -> DataFrame:
    """A2: every configured split file of one dataset as one frame with literal
    ``dataset`` and ``split`` columns.  A missing file only logs a warning when
    an ``exists`` callable is given (the read itself then fails as Spark does)."""
    frames = []
    for split, path in cfg.split_files().items():
        if exists is not None and not exists(path):
            LOG.warning("%s: nothing at %s to read the %s split from", cfg.name, path, split)
        frames.append(read_jsonl(spark, path, schema)
                      .withColumns({"dataset": F.lit(cfg.name), "split": F.lit(split)}))
    return concat_datasets(frames)


def concat_datasets(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name (no dedup); missing columns become null."""
    if not frames:
        raise ValueError("nothing to concatenate")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
