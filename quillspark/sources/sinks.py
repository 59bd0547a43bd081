"""Writers (A4-A11).  Every writer is a partitioned DataFrame write: file count
is bounded by the partition columns and the number of tasks, never one file per
sample as in a per-record loop."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import literal_table

# --- fixed values: output formats -------------------------------------------
RUN_ID_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
# --------------------------------------------------------------------------


def run_id_now(session_tz: str = "UTC") -> Column:
    """UTC run stamp like 20240101T000000Z, whatever the session time zone
    (``date_format`` renders in the session zone, so shift to UTC wall time)."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), session_tz), RUN_ID_FORMAT)


def write_predictions(df: DataFrame, path: str, run_id: str | Column | None = None) -> None:
    """A4: ``{prompt, reference, prediction}`` (+ ids) per dataset and run."""
    missing = {"prompt", "reference", "prediction"}.difference(df.columns)
    if missing:
        raise ValueError(f"predictions need the columns {sorted(missing)}")
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    rid = run_id_now(tz) if run_id is None else (F.lit(run_id) if isinstance(run_id, str) else run_id)
    (df.withColumn("run_id", rid).write.mode("append")
       .partitionBy("dataset", "run_id").json(path))


def sample_stats(details: DataFrame, averages: DataFrame, chosen_layers: Sequence[int], target: str,
                 ks: Sequence[int], metrics: Sequence[str],
                 keys: Sequence[str] = ("analysis", "level", "sample_index", "sample")) -> DataFrame:
    """A5 rows: one per sample with ``per_layer`` (layer -> metrics) and ``avg_*``.
    The map collects one sample's layers only (a handful of entries)."""
    keys = list(keys)
    per = details.groupBy(*keys).agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("layer"), F.struct(*[F.col(m) for m in metrics])))).alias("per_layer"))
    return (per.join(averages, keys)
            .withColumns({"chosen_layers": F.array(*[F.lit(int(x)) for x in chosen_layers]),
                          "target": F.lit(target),
                          "k_values": F.array(*[F.lit(int(k)) for k in ks])}))


def write_sample_stats(df: DataFrame, path: str) -> None:
    """A5: JSON per sample, folders by analysis and level."""
    df.write.mode("overwrite").partitionBy("analysis", "level").json(path)


def write_details(df: DataFrame, path: str) -> None:
    """Detail rows as CSV with a header, one folder per analysis and level."""
    df.write.mode("overwrite").partitionBy("analysis", "level").option("header", True).csv(path)


def write_level_summary(df: DataFrame, path: str) -> None:
    """The level summary (at most five rows per analysis) as one CSV per
    analysis, ordered by level.  ``coalesce(1)`` is safe: the input is the
    result of a five-group aggregate."""
    (df.orderBy("analysis", "level").coalesce(1).write.mode("overwrite")
       .partitionBy("analysis").option("header", True).csv(path))


def write_query_meta(df: DataFrame, path: str) -> None:
    """Level, index, query, tokens, chosen layers and model path per sampled query."""
    df.write.mode("overwrite").partitionBy("level").json(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics per dataset as JSON lines."""
    df.write.mode("overwrite").json(path)


def cache_features(df: DataFrame, path: str, partition_cols: Sequence[str] = ("split", "dataset")) -> None:
    """A10: tokenised features once, as Parquet partitioned by split and dataset."""
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)


#: Part of every cache key: entries of another layout are never read.
CACHE_FORMAT = 1


def input_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """What tells whether input files have changed: number, and a sum over the
    hashes of path, length and modification time.  Only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    r = files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
    return f"{r['n']}:{r['h']}"


def cache_key(settings: Mapping, inputs: str) -> str:
    """Name of a cache entry: a digest of the settings (JSON values) and the inputs' state."""
    text = json.dumps({"format": CACHE_FORMAT, "settings": settings, "inputs": inputs}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def _committed(spark: SparkSession, entry: str) -> dict | None:
    """The rows of an entry that were written to the end (of several writers', the first by name)."""
    try:
        mark = spark.read.text(f"{entry}/committed").agg(F.min("value")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(mark) if mark else None


def cached_features(spark: SparkSession, root: str, settings: Mapping, inputs: Sequence[str], build: Callable[[], DataFrame],
                    partition_cols: Sequence[str] = ("split", "dataset")) -> tuple[DataFrame, bool]:
    """A10: the features for these settings and input files, and whether they were
    there already.

    An entry's folder is named by its content: settings (templates, caps, seed,
    ...) and the state of the input files, so anything that could change the rows
    makes another entry.  Every writer writes to a folder of its own and leaves
    a mark when it is done; only marked rows are read, so one that was
    interrupted is never seen, and of two at a time both read the same rows.
    """
    entry = f"{root.rstrip('/')}/{cache_key(settings, input_state(spark, inputs))}"
    held = _committed(spark, entry)
    reused = held is not None
    if held is None:
        rows = build()
        name = f"rows-{uuid.uuid4().hex}"
        rows.write.partitionBy(*partition_cols).parquet(f"{entry}/{name}")
        mark = json.dumps({"rows": name, "schema": rows.schema.json()}, sort_keys=True)
        literal_table(spark, [(mark,)], "value string").write.mode("append").text(f"{entry}/committed")
        held = _committed(spark, entry)
    schema = StructType.fromJson(json.loads(held["schema"]))
    return spark.read.schema(schema).parquet(f"{entry}/{held['rows']}").select(*schema.names), reused


def report_lines(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """A11 (Markdown): a header, a rule and one ``| a | b |`` line per row.
    Doubles are printed with a fixed number of digits, rounded half-up on
    their decimal value (through DECIMAL, so the text does not depend on
    binary ties)."""
    spark = df.sparkSession
    cols = list(cols)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = [F.coalesce((F.round(F.col(c).cast("decimal(38,18)"), digits) if fields[c] in ("double", "float")
                         else F.col(c)).cast("string"), F.lit("")) for c in cols]
    body = df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"),
                     F.lit(2).alias("part"))
    head = literal_table(spark, [("| " + " | ".join(cols) + " |", 0),
                                  ("|" + "|".join(["---"] * len(cols)) + "|", 1)], "line string, part int")
    return head.unionByName(body)


def write_report(df: DataFrame, path: str, cols: Sequence[str], fmt: str = "csv") -> None:
    """The accuracy report as CSV or Markdown.  The report is an aggregate
    (tens of rows), so a single output file is fine."""
    if fmt == "csv":
        df.select(*cols).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "markdown":
        report_lines(df, cols).orderBy("part", "line").select("line").coalesce(1).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown report format {fmt}")
