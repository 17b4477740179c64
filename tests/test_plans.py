"""Physical plans: pruned scans, no pair products, limits before shuffles."""

import re

import pytest

from reelspark.plans import queries
from reelspark.plans.queries import REGISTRY


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_schemas(text):
    return [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


LAZY = [
    "scan_ratings", "upsert_ratings", "quarantine_rows", "user_top_rated", "popular_movies", "movie_stats",
    "dataset_overview", "data_quality", "rating_distribution", "cold_start_summary", "user_bias", "hist_user_bias",
    "centered_cells", "bias_baseline", "known_id_filter", "eval_pairs", "evaluate_global_mean", "unrated_movies",
    "cold_user_recommendations", "drift_chi2", "promotion_decisions", "model_status",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_pair_products_or_row_python(spark, sf_dir, name):
    text = plan(REGISTRY[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


def test_scans_read_only_what_is_used(spark, sf_dir):
    schemas = read_schemas(plan(REGISTRY["popular_movies"](spark, sf_dir)))
    assert {"l_orderkey", "l_partkey", "l_quantity"} in schemas and {"o_orderkey"} in schemas
    schemas = read_schemas(plan(REGISTRY["distinct_movies"](spark, sf_dir)))
    assert {"l_orderkey", "l_partkey"} in schemas


def test_rank_limits_apply_before_the_shuffle(spark, sf_dir):
    text = plan(REGISTRY["user_top_rated"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(REGISTRY["popular_movies"](spark, sf_dir))


def test_exact_cut_neither_sorts_nor_shuffles_rows(spark, ratings_of):
    from reelspark.operators.sampling import random_split

    text = plan(random_split(ratings_of([(i, 1, 3.0, i) for i in range(100)])))
    assert "Exchange" not in text and "Sort" not in text


def test_broadcast_only_within_the_budget(spark):
    from reelspark.session import broadcast_if_small

    left, right = spark.range(10), spark.range(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(left.join(broadcast_if_small(right, 5, 8), "id"))
        large = plan(left.join(broadcast_if_small(right, 5, 8, limit=39), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_the_split_of_the_pivot_reads_stored_ratings(spark, sf_dir, monkeypatch):
    class Seen(Exception):
        pass

    plans = []

    def split(ratings):
        plans.append(plan(ratings))
        raise Seen

    monkeypatch.setattr(queries.sampling, "random_split", split)
    with pytest.raises(Seen):
        queries._pivot_trained(spark, sf_dir)
    assert "Join" not in plans[0] and "Scan parquet" in plans[0]
