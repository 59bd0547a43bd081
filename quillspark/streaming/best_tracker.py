"""K9: the running-best evaluation as a Structured Streaming job with keyed state.

An evaluation is a new best when its loss is below all earlier ones of its run.
The state of a run is one row: its new bests so far, as ascending steps with
falling losses (a staircase of some ln(n) steps when losses come in random
order).  An event is put in its place, whenever it arrives: it is left out
below an earlier step with no larger loss, and takes out later steps it is as
good as.  No watermark could tell that an earlier step will never come, so none
is used: after every micro-batch the state is K1 over all events so far, for any
file layout, arrival order, batch size or restart.  The state lives in RocksDB,
outside the heap, and the result is read from it, not from events kept aside.

Before events are dealt by run, every task reduces its own to their staircase: an
event that an earlier one of the same task beats cannot be a new best.  So a run
with a third of all events sends a few rows per task.

What changes is put out as it happens: (run, step, loss, added or withdrawn).

Of several events of one run and step the smallest loss counts; events without a
step, or whose loss is null or NaN, never count; a null run is a run.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.trainlog import clean_loss
from ..session import shared_dir

LOG_SCHEMA = "run_id long, global_step long, eval_loss double"
CHANGES = "run_id long, global_step long, eval_loss double, added boolean"
STATE = "steps array<long>, losses array<double>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def staircase(run: np.ndarray, step: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """Rows, by run and step, whose loss is below all earlier ones of their run."""
    order = np.lexsort((loss, step, run))
    r, x = run[order], loss[order]
    # the running minimum inside each run: ranks of losses keep runs apart in one pass
    rank = np.unique(x, return_inverse=True)[1].reshape(-1)
    first = np.concatenate(([True], r[1:] != r[:-1])) if len(r) else np.zeros(0, bool)
    number = np.cumsum(first)
    low = np.minimum.accumulate(rank - number * (len(rank) + 1))  # a later run starts below every earlier one
    before = np.concatenate(([1], low[:-1])) if len(low) else low
    return order[first | (low < before)]


def events_stream_as_log(spark: SparkSession, table: str, schema: str,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """A table of event rows (one file or a folder of part files) as a stream of
    the log columns (``fx_trainlog``)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # a pattern that matches this path only: the source takes a plain path for a folder
    ev = r.parquet(f"{table[:-1]}[{table[-1]}]")
    return ev.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("global_step"),
                     F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                      .otherwise(F.col("value")).alias("eval_loss"))


def _reduced(batches):
    """A task's events as their staircase; a null run is told by a flag."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        run = b.column(0)
        own = [run.is_null().to_numpy(zero_copy_only=False), run.fill_null(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()]
        held = own if held is None else [np.concatenate(x) for x in zip(held, own)]
        key = np.unique(np.column_stack([held[0], held[1]]), axis=0, return_inverse=True)[1].reshape(-1)
        keep = staircase(key, held[2], held[3])
        held = [x[keep] for x in held]
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[1], mask=held[0]), pa.array(held[2]), pa.array(held[3])],
                                         ["run_id", "global_step", "eval_loss"])


class Stairs(StatefulProcessor):
    """The staircase of one run."""

    def init(self, handle) -> None:
        self.stairs = handle.getValueState("stairs", STATE)

    def handleInputRows(self, key, rows, timerValues):
        held = self.stairs.get() if self.stairs.exists() else None
        old = dict(zip(*held)) if held else {}
        step, loss = [list(old)], [list(old.values())]
        for r in rows:
            step.append(r["global_step"].to_numpy())
            loss.append(r["eval_loss"].to_numpy())
        step, loss = np.concatenate(step).astype(np.int64), np.concatenate(loss).astype(np.float64)
        keep = staircase(np.zeros(len(step), np.int64), step, loss)
        new = dict(zip(step[keep].tolist(), loss[keep].tolist()))
        if new == old:
            return
        self.stairs.update((list(new), list(new.values())))
        gone = [(k, v, False) for k, v in old.items() if new.get(k) != v]
        come = [(k, v, True) for k, v in new.items() if old.get(k) != v]
        out = pd.DataFrame(gone + come, columns=["global_step", "eval_loss", "added"])
        out.insert(0, "run_id", pd.array([key[0]] * len(out), dtype="Int64"))
        yield out

    def close(self) -> None:
        pass


def best_changes(stream: DataFrame) -> DataFrame:
    """The stream of changes to the new bests of a log stream."""
    log = clean_loss(stream).where("eval_loss is not null and global_step is not null").select("run_id", "global_step", "eval_loss")
    few = log.mapInArrow(_reduced, LOG_SCHEMA)
    return few.groupBy("run_id").transformWithStateInPandas(Stairs(), CHANGES, "Update", "None")


def track(stream: DataFrame, folder: str):
    """Start the job over everything available; changes go under ``folder``, a folder
    for each micro-batch that is written again when the batch is run again, next to
    the checkpoint with the state, so a restarted job resumes."""
    spark = stream.sparkSession

    def put_out(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return (best_changes(stream).writeStream.outputMode("update").foreachBatch(put_out)
                .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def best_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """New-best rows of all events processed so far, read from the state."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        state = spark.read.format("statestore").option("stateVarName", "stairs").load(f"{folder}/checkpoint")
    except (AnalysisException, PySparkException) as e:
        if not (e.getCondition() or "").startswith("STDS_"):
            raise
        return spark.createDataFrame([], LOG_SCHEMA)  # no batch yet
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
    stairs = state.select(F.col("key.run_id").alias("run_id"), F.explode(F.arrays_zip("value.steps", "value.losses")).alias("s"))
    return stairs.select("run_id", F.col("s.steps").alias("global_step"), F.col("s.losses").alias("eval_loss"))


def run_to_table(spark: SparkSession, stream: DataFrame, name: str = "best_stream") -> DataFrame:
    """Run the tracker to the end of what is available; the new-best rows."""
    folder = shared_dir(spark, name)
    track(stream, folder).awaitTermination()
    return best_so_far(spark, folder)
