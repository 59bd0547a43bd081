"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_WARMUP_DIR
(default /root/testdata/sf0.001; empty to skip).  Each query first runs once on
the small warm-up data (JIT and code generation are paid there, as they are
once per job on a cluster), then is timed on the target data.  Each run goes
to completion through the ``noop`` sink (whole plan executed, nothing
collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from quillspark.plans import registry  # noqa: E402
from quillspark.session import get_session  # noqa: E402

HEADLINE = [
    "accuracy_by_dataset", "paired_accuracy", "scored_samples", "error_types", "numeric_match",
    "query_pick", "validate", "all_modes", "level_sample", "shuffle_position", "split_811", "mix",
    "prompts_union", "chat_join", "token_clean",
    "vocab", "encode", "sft_features", "batches", "length_stats", "batch_predict",
    "attention_detail", "level_summary", "layer_profile", "attention_matrix",
    "new_best", "best_checkpoint", "early_stop", "save_plan", "retained", "spikes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    registry.load_all()
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm:
        for name in names:
            registry.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
