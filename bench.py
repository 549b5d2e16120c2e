"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line with the wall time of each.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One untimed warm-up job
starts the JVM and Python workers first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # profile and cleaning
    "null_profile", "distinct_profile", "summary_profile", "pearson_long", "spearman_long",
    "crosstab_zero", "missingness_map", "impute_median", "numeric_sniff", "dummy_full",
    # sampling
    "split_stratified", "kfold", "downsample", "seq_split",
    # models and inference
    "glm_continuous", "glm_categorical", "compare_models", "std_residuals", "durbin_watson",
    "stepwise_both", "gvif",
    # evaluation and scoring
    "confusion", "roc_points", "auc", "hosmer_lemeshow", "leaderboard", "score_job",
    # resampled models and selection
    "glmnet_cv", "boruta", "pca",
]


def main() -> None:
    from dichot.plans.queries import QUERIES
    from dichot.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="dichot-bench")
    # untimed warm-up: JVM code paths, Arrow and the Python workers of mapInPandas
    spark.range(1000).selectExpr("sum(id)").collect()
    spark.read.parquet(f"{sf_dir}/orders.parquet").limit(1).toPandas()
    spark.range(100000, numPartitions=cpus).mapInPandas(lambda it: it, "id long") \
         .write.mode("overwrite").format("noop").save()

    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
