import math

import pytest

from reelspark.operators import registry as ops
from reelspark.sources.models import Registry

NAN = float("nan")


def history(spark, metrics):
    rows = [("m", i + 1, f"run{i + 1}", metric) for i, metric in enumerate(metrics)]
    runs = spark.createDataFrame(rows, "name STRING, version INT, run_id STRING, metric DOUBLE")
    return [r["promoted"] for r in ops.promotion_history(runs).orderBy("version").collect()]


@pytest.mark.parametrize(
    "metrics, promoted",
    [
        ([0.9], [True]),
        ([NAN, 0.9], [True, True]),
        ([0.9, 0.9], [True, False]),
        ([0.9, 0.89], [True, True]),
        ([0.9, NAN], [True, False]),
        ([NAN, NAN], [True, True]),
        ([None, 0.9, None, 0.8, 0.85], [False, True, False, True, False]),
    ],
)
def test_champion_rule(spark, metrics, promoted):
    assert history(spark, metrics) == promoted


def test_event_log_gives_the_same_decisions(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    metrics = [NAN, 0.9, 0.9, 0.7, NAN, 0.8]
    decisions = []
    for metric in metrics:
        run = registry.log_run({"k": 5}, {"rmse": metric, "mae": 0.5})
        registry.register(run)
        decisions.append(registry.promote(run))
    assert decisions == history(spark, metrics) == [True, True, False, True, False, False]
    assert registry.resolve().endswith("version=4")
    registry.set_alias("production", 2)
    assert registry.resolve().endswith("version=2")
    assert registry.resolve(override="/elsewhere") == "/elsewhere"
    registry.set_alias("staging", 6)
    status = {r["alias"]: (r["version"], r["rmse"]) for r in registry.status().collect()}
    assert status["production"] == (2, 0.9) and status["staging"][0] == 6


def test_run_without_version_or_metric(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    run = registry.log_run({}, {})
    with pytest.raises(ValueError):
        registry.promote(run)
    first, second = registry.register(run), registry.register(run)
    assert (first, second) == (1, 2)
    latest = ops.latest_version_of_run(registry.versions()).first()
    assert latest["version"] == 2
    assert registry.promote(run) is False and registry.resolve() is None
    assert not math.isnan(registry.versions().count())
