"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from trendcast.plans.catalog import QUERIES
from trendcast.session import build_session

HEADLINE = [
    "clean_events", "dedup_first", "null_profile", "period_counts", "flag_shares", "measure_means",
    "segment_trends_topn", "segment_shares", "period_spine", "flag_correlation", "feature_evidence",
    "modelling_dataset", "segment_modelling_dataset", "naive_backtest", "linear_backtest", "segmented_future",
    "baseline_vs_segmented", "forest_backtest", "boosting_backtest", "pooled_forest_backtest", "tfidf_weights",
    "top_terms", "svd_projection", "silhouette_labels", "silhouette_squared", "nearest_centroid",
    "numeric_segmentation", "text_segmentation",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("trendcast-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["growth_rate"](spark, folder).collect()
    # One grouped function up front, so that starting the Python workers is not charged to a query.
    spark.range(int(cpus)).mapInPandas(lambda parts: parts, "id long").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
