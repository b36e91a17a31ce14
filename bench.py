"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion through the no-op sink (full execution, nothing collected
to the driver). The reported per-query time is the warm run; cold runs are in "cold".
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["gold_harmonise", "resolver", "csv_sweep", "hot_sweep", "non_blank_counts", "silver_order"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from driftsweep.plans.catalog import registry
    from driftsweep.session import local_session

    spark = local_session(cpus, app="driftsweep-bench",
                          extra={"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
                                 "spark.ui.showConsoleProgress": "false"})
    reg = registry()
    names = [n for n in HEADLINE if n in reg]
    cold, warm = {}, {}
    for n in names:
        for store in (cold, warm):
            t = time.time()
            reg[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            store[n] = round(time.time() - t, 3)
    total = round(sum(warm.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_warm_total", "value": total, "unit": "sec",
                      "queries": warm, "cold": cold, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
