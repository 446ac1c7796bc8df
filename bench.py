"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the
number of local cores. Each query runs to completion into a no-op sink; the
best of BENCH_RUNS (default 2) runs counts. "basket_tables" is the derivation
and bucketed write of the basket tables, once. The boosted trees run once, for
ten rounds; the registered queries boost for 80 to 300.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from trolley.operators import learn
from trolley.registry import QUERIES
from trolley.workspace import workspace

# The steps the reference's log times, then the rest of the pipeline.
HEADLINE = [
    "product_features",
    "user_features",
    "user_product_features",
    "feature_matrix",
    "purchase_ordinal",
    "order_streak",
    "group_stats_multi",
    "group_stats_single",
    "narrow_ints",
    "predicted_lists",
    "submission",
    "ground_truth",
    "mean_f1_lists",
    "cv_fold_scores",
    "top_products",
    "department_share",
    "aisle_reorder",
    "first_in_cart",
    "dow_hour_reorder",
    "order_any_reorder",
    "always_reorder_users",
    "group_box_stats",
    "user_aisle_counts",
    "cluster_top_aisles",
    "user_clusters",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trolley-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    start = time.perf_counter()
    tables = dict(workspace(spark, sf_dir).tables)
    seconds["basket_tables"] = time.perf_counter() - start
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = min(taken)
    if not sys.argv[1:]:
        ws = workspace(spark, sf_dir)
        few = {"maxIter": 10}
        for name, run in (
            ("gbt_10_rounds", lambda: learn.gbt_score(learn.gbt_train(ws.vectors, few), ws.test_vectors)),
            ("gbt_cv_10_rounds", lambda: learn.gbt_cv_f1(ws.train, ws.truth, ws.store, params=few)),
        ):
            start = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            seconds[name] = time.perf_counter() - start
    lines = tables["prior"].count()
    total = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "prior_lines": lines,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
