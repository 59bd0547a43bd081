"""Write PLANS.md: formatted physical plans of key queries with a note on each.

usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from quillspark.plans import registry  # noqa: E402
from quillspark.session import get_session  # noqa: E402

NOTES = {
    "accuracy_by_dataset": "The scan reads only o_orderkey and o_custkey (the unused level column is "
                           "pruned); the graders are one projection; partial count per dataset before the "
                           "only hash exchange; the requested-dataset spine is a literal table "
                           "(Range + inline) broadcast-joined at the end.",
    "all_modes": "Bucket counts per (level, bucket) are aggregated, their offsets and the per-mode pick "
                 "counts come from windows over that small table (single partition, bounded by "
                 "5 x 4096 rows) and are broadcast; the ranking window is partitioned by "
                 "(level, bucket); one Generate emits each row once per mode it belongs to.",
    "shuffle_position": "Global position without a global sort: 65,536 hash buckets, broadcast offsets, "
                        "row_number inside a bucket.",
    "level_sample": "row_number() <= 5 per level: WindowGroupLimit runs before the exchange.",
    "sft_features": "One hash exchange of the rendered texts by id; explode, the broadcast vocabulary "
                    "join and both re-assembly aggregates run in that partitioning; the vocabulary is "
                    "a partial/final count plus TakeOrderedAndProject.",
    "attention_detail": "Layer filter on the scan side; head mean is a partial/final aggregate keyed by "
                        "(sample, layer, pos); vectors are collected per (sample, layer) and all metrics "
                        "are higher-order array expressions.",
    "early_stop": "Chunked prefix scans: raw rows are exchanged and windowed by (run, chunk); only the "
                  "small chunk-total table is windowed by run (for the carries), so no task holds a "
                  "whole run's rows.",
    "spikes": "Trailing window in blocks of row index with a halo: window partitions are "
              "(run, block), never a whole run.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    registry.load_all()
    out = ["# PLANS", "",
           f"Formatted physical plans (`explain(\"formatted\")`, before adaptive re-planning) at `{sf_dir}`, "
           "generated by `scripts/explain_plans.py`.  An `Exchange RoundRobinPartitioning` right above a "
           "scan is the small-input spread (the test files are one row group each); it is absent when "
           "a scan already has enough splits.", ""]
    for name, note in NOTES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            registry.QUERIES[name](spark, sf_dir).explain("formatted")
        out += [f"## {name}", "", note, "", "```", buf.getvalue().rstrip(), "```", ""]
    with open(os.path.join(HERE, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
