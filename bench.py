"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from wayframe.plans import fixtures, registry  # noqa: F401 fixtures adds its queries
from wayframe.session import local_session

HEADLINE = ("type_stats", "list_all", "nodes_view", "edge_stats", "integrity_clean", "distances", "distances_geo", "tour_costs", "order_routes", "text_round_trip_nodes", "text_round_trip_matrix", "detect_changes", "stored_from_text", "layout_cells", "broken_instances")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    registry.QUERIES["list_all"](spark, sf_dir).count()  # the first query's warm-up isn't timed
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
