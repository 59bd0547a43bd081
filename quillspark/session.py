"""Session construction and the shared working folder.

Everything in the package is a lazy DataFrame transformation; this module is
the only place that knows about configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for every job in the package.  AQE re-plans joins
# (broadcast when the runtime size is small, skew-join splitting otherwise)
# and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quillspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A folder every executor can see.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (set by
    the cluster).  Only when the setting is absent (local tests) do we make one
    and register it, so that ``DataFrame.checkpoint()`` works too.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the conf is all we have
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # one machine: any folder is shared
        base = tempfile.mkdtemp(prefix="quillspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    base = base.rstrip("/")
    if name is None:
        return base
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per Spark context).

    Functions that run in Python workers refer to the package by name, so the
    workers must be able to import it; jobs started with ``--py-files`` or an
    installed package lose nothing by a second copy.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="quillspark-src-")
    target = os.path.join(folder, f"quillspark-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def literal_table(spark: SparkSession, rows, schema: str):
    """A small parameter table (a few dozen rows from the job's configuration)
    built JVM-side from literals.  ``createDataFrame`` on a Python list would
    become a Python RDD scan and start Python workers for a handful of rows."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    st = T._parse_datatype_string(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def cluster_conf(input_bytes: int, total_cores: int, split_bytes: int = 512 << 20,
                 shuffle_target_bytes: int = 256 << 20) -> dict:
    """Settings for a large run, sized from the input and the cluster.

    * scan splits of ``split_bytes`` (100 TB / 512 MB ~ 200k tasks);
    * initial shuffle partitions so that a full-width shuffle lands near
      ``shuffle_target_bytes`` per partition (at least 2 x cores); AQE then
      coalesces small ones and splits skewed join partitions;
    * a broadcast threshold that only AQE's runtime sizes can trigger beyond
      the explicit, size-bounded broadcasts in the operators;
    * Arrow batches for the one Python operator (G8) kept small;
    * the RocksDB state store for the streaming tracker (K9).
    """
    parts = max(2 * total_cores, int(input_bytes // shuffle_target_bytes) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.sql.execution.sortBeforeRepartition": "true",
        "spark.sql.session.timeZone": "UTC",
        # K9 keeps one state row per training run: RocksDB keeps it off-heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def saved(df, name: str, partition_cols=None):
    """Cut the lineage of an intermediate: write ``df`` as Parquet under the
    shared folder (an action: it runs now) and return a frame that reads it
    back, so recomputation after a lost executor stops here."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    w = df.write
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.select(*df.columns)
