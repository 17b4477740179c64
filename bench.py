"""Wall times of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from reelspark.plans.queries import REGISTRY
from reelspark.session import build_session

HEADLINE = [
    "popular_movies",
    "dataset_overview",
    "data_quality",
    "movie_stats",
    "cold_start_summary",
    "hist_user_bias",
    "user_top_rated",
    "upsert_ratings",
    "split_n_batches",
    "train_split",
    "random_split",
    "sample_ratings",
    "train_rows_capped",
    "bias_baseline",
    "candidate_pool",
    "recommend_unsampled",
    "drift_ks",
    "promotion_decisions",
    "evaluate_model",
    "predict_ratings",
    "recommend",
    "recommend_uncentered",
    "stream_intake",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    # Intermediate tables of the run lie in one folder, which goes with it.
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        conf = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": f"{folder}/warehouse"}
        spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus), **conf)
        measure(spark, names, sf_dir, cpus)


def measure(spark, names: list[str], sf_dir: str, cpus: str) -> None:
    # Session start and first-query compilation are not part of any query.
    REGISTRY["load_check"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
