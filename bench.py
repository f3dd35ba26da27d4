"""Bench: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS], print one JSON line.

Each query is fully executed through the ``noop`` sink (every row computed, nothing
collected to the driver). A short warm-up query starts the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hydroframe.plans import queries as Q  # noqa: E402
from hydroframe.session import get_spark  # noqa: E402

HEADLINE = ["daily_forcing", "hourly_climate_long", "climate_dense_cube", "dam_height",
            "reservoirs", "terrain_grid", "soil_long", "lai_cube", "image_fallback",
            "outlet_series", "upstream_cells", "model_cell_forcing", "clipped_polygons"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(Q.queries())
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus)
    # Warm-up (not counted): JIT, codegen and the parquet reader, with three query shapes
    # (grouped aggregation, pivot, column logic) on a small scale factor.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm_dir):
        for name in ("daily_forcing", "terrain_grid", "dam_height"):
            Q.queries()[name](spark, warm_dir).write.mode("overwrite").format("noop").save()
    times: dict[str, float] = {}
    for name in names:
        fn = Q.queries()[name]
        spark.sparkContext.setJobDescription(name)  # attributes stages in the event log
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.mode("overwrite").format("noop").save()
        times[name] = round(time.perf_counter() - t0, 3)
    head = [n for n in HEADLINE if n in times]
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "sum of headline query seconds",
        "value": round(sum(times[n] for n in head), 3),
        "unit": "sec",
        "queries": times,
        "total_all_queries": round(sum(times.values()), 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
