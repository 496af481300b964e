"""Time the headline queries; prints one JSON line.

Each query is run whole, from the parquet tables to a sink that takes every row, once to warm
up on the smallest tables and once for the time.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from grabqc.plans.catalog import queries  # noqa: E402
from grabqc.session import build_session  # noqa: E402

HEADLINE = ["template_melt_results", "identifiers", "replicate_precision", "batch_summary", "interval_grade",
            "graded_results", "station_percentiles", "anomaly_counts", "final_grade", "data_summary", "qc_summary",
            "box_plot_stats", "pair_scatter_bands", "table_activity", "table_result", "surrogate_keys", "template_metadata_long", "replicate_precision_of_many",
            "publish_again", "keyed_readback", "table_review"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("grabqc-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    known, warm = queries(), os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")

    def run(name, where):
        started = time.perf_counter()
        known[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    if os.path.isdir(warm):
        for name in HEADLINE:
            run(name, warm)
    seconds = {name: round(run(name, sf_dir), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0)}))


if __name__ == "__main__":
    main()
