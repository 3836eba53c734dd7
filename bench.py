#!/usr/bin/env python
"""Headline-query timings at one scale factor; prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).  Each query is
built and run to completion through Spark's no-op sink (full computation, nothing
collected); the query's own writes (matrix round trips) are part of its time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankloom.queries import QUERIES  # noqa: E402
from rankloom.session import build_session  # noqa: E402

HEADLINE = [
    "scan_events",              # CSV scan + count
    "union_item_props",         # union + count
    "filter_category_props",    # filter categoryid + count
    "latest_ts_per_item",       # max timestamp per item
    "latest_category_join",     # join-back to latest category
    "events_with_category",     # events ⋈ latest category
    "model1_matrix",            # whole model-1 chain
    "write_read_roundtrip",     # write matrix (+ typed read back)
    "distinct_users",
    "distinct_products",
    "ratings_per_user_stats",   # describe()
    "user_rating_crosstab",     # crosstab user x rating
    "model2_matrix",
    "model3_matrix",
    "model4_matrix",
    "als_implicit_predict",     # implicit ALS train + predictAll
    "als_factors",              # factor export (the reference collects them)
    "als_recommend_products",   # top-10 products for every user
    "als_recommend_users",      # top-10 users for every product
    "als_explicit_predict",     # explicit ALS train (model 3) + predict
    "als_insample_metrics",     # explicit ALS + regression metrics
    "als_tuned",                # 3-fold CV over 8 settings + best-model RMSE
    "topn_products_per_user",   # top-N from factor tables
    "ranking_metrics",
    "regression_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=2 * cpus)
    # Warm the JVM (class loading, JIT, codegen caches; MLlib's first fit) outside the
    # timed section, on the smallest scale factor.
    for warm in ("model1_matrix", "als_implicit_predict"):
        QUERIES[warm](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
