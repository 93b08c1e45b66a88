"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected). After one cold pass over all queries, each query runs
three more times and the best (warm) time is reported, matching the "Gold query
< 2 s warm" target. Every query starts from the raw parquet tables (Bronze
derivation, Silver cleanse/dedup/enrich and the Gold step all included).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from swipeflow.plans.registry import REGISTRY  # noqa: E402
from swipeflow.session import build_session  # noqa: E402

SCORING_TREES = 100

HEADLINE = [
    "daily_txn_summary",
    "customer_360",
    "fraud_alerts_hourly",
    "state_performance",
    "executive_kpi",
    "daily_summary_sql",
    "customer_360_sql",
    "merge_upsert",
    "dq_metrics",
    "velocity",
    "impossible_travel",
    "rfm_scores",
    "vector_topk",
    "tfidf_search",
]


R_AS_OF = "2024-02-01 00:00:00"


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(app="swipeflow-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    for name in names:
        run(spark, name, sf_dir)  # cold pass: JIT, codegen cache, file listing
    times = {}
    for name in names:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(3)), 3)
    # Silver throughput, as the target defines it: cleanse + dedup + enrich +
    # upsert. Bronze is ingested once into a scratch folder; build_silver then
    # MERGEs into the existing Silver table (best of 3 runs).
    from swipeflow.plans import pipeline
    from swipeflow.session import materialize, scratch_dir

    paths = pipeline.layout(scratch_dir(spark, "bench-pipeline"))
    bronze_rows = pipeline.ingest_bronze(spark, sf_dir, paths, R_AS_OF)["bronze_txn"]
    pipeline.build_silver(spark, paths, R_AS_OF)  # first write
    t_silver = min(_timed(lambda: pipeline.build_silver(spark, paths, R_AS_OF)) for _ in range(3))
    t_transform = min(run(spark, "enrich_left_join", sf_dir) for _ in range(3))
    # Batch scoring: fit once (not timed), then time scoring every Silver row
    from pyspark.sql import functions as F

    from swipeflow.operators import ml
    from swipeflow.plans import registry as R

    feats = ml.build_feature_df(R.enriched(spark, sf_dir).filter(F.col("dq_passed")))
    train = materialize(ml.oversample(ml.split_hash(feats)[0]))  # every stage of the fit reads it
    model = ml.build_pipeline(max_iter=SCORING_TREES, max_depth=6).fit(train)
    scored_rows = feats.count()
    ml.score(model, feats).write.format("noop").mode("overwrite").save()
    t0 = time.perf_counter()
    ml.score(model, feats).write.format("noop").mode("overwrite").save()
    t_score = time.perf_counter() - t0
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "headline_queries_total_warm",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cores": cpus,
        "silver_rows": bronze_rows,
        "silver_rows_per_min": round(bronze_rows / t_silver * 60) if t_silver > 0 else None,
        "silver_transform_rows_per_min": round(bronze_rows / t_transform * 60) if t_transform > 0 else None,
        "scoring_model": f"GBT {SCORING_TREES} trees, depth 6",
        "scoring_rows": scored_rows,
        "scoring_rows_per_sec": round(scored_rows / t_score) if t_score > 0 else None,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
