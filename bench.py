"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from walkgrid.plans.queries import QUERIES  # noqa: E402
from walkgrid.session import build_session  # noqa: E402

HEADLINE = (
    "cell_index", "ring_cells", "line_trace", "tag_municipality", "nearest_exact", "nearest_first_ring",
    "cell_scores", "livability", "hex_rollup", "municipality_table", "amenities_union", "poi_elements",
    "check_bundle_by_shard", "latest_verdicts", "changed_shards",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench", shuffle_partitions=int(cpus), **{"spark.driver.memory": "16g"}
    )
    QUERIES["livability"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
