import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.operators import drift


def frames(spark, a, b):
    schema = "x DOUBLE, g STRING"
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


def brute_ks(a, b):
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return np.abs(fa - fb).max()


def test_ks_matches_definition_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    a, b = np.round(rng.normal(0, 1, 300), 2), np.round(rng.normal(0.2, 1, 200), 2)
    a[:100] = 0.5
    ref, cur = frames(spark, [(float(x), "u") for x in a], [(float(x), "u") for x in b])
    ref, cur = ref.withColumn("y", F.col("x") * 2), cur.withColumn("y", F.col("x") * 0)
    rows = {r["column"]: r for r in drift.ks_statistics(ref, cur, ["x", "y"]).collect()}
    assert rows["x"]["ks"] == pytest.approx(brute_ks(a, b))
    assert rows["y"]["ks"] == pytest.approx(brute_ks(a * 2, b * 0))
    assert (rows["x"]["n_ref"], rows["x"]["n_cur"]) == (300, 200)


def test_same_frame_has_no_drift_and_shifted_frame_has(spark):
    a = [(float(i % 20), "abc"[i % 3]) for i in range(400)]
    b = [(x + 10, "a") for x, _ in a]
    ref, cur = frames(spark, a, b)
    same = {r["column"]: r["drift"] for r in drift.drift_report(ref, ref, ["x"], ["g"]).collect()}
    moved = {r["column"]: r["drift"] for r in drift.drift_report(ref, cur, ["x"], ["g"]).collect()}
    assert same == {"x": False, "g": False} and moved == {"x": True, "g": True}


def test_chi2_tail_for_even_degrees(spark):
    # With 2n degrees of freedom the tail is a Poisson sum.
    cases = [(chi2, dof) for chi2 in (0.5, 3.0, 12.0, 80.0, 500.0) for dof in (2, 4, 10, 60, 400)]
    df = spark.createDataFrame([(c, d) for c, d in cases], "chi2 DOUBLE, dof BIGINT")
    found = [r["p"] for r in df.withColumn("p", drift._chi2_tail()("chi2", "dof")).collect()]
    for (chi2, dof), p in zip(cases, found):
        half = chi2 / 2
        exact = sum(math.exp(-half + i * math.log(half) - math.lgamma(i + 1)) for i in range(dof // 2))
        assert p == pytest.approx(exact, rel=1e-9, abs=1e-13)


def test_ks_p_value_reference_points(spark):
    # Kolmogorov distribution: P(K > 1.3581) = 0.05, P(K > 1.6276) = 0.01.
    df = spark.createDataFrame([(1.3581 / math.sqrt(500.0),), (1.6276 / math.sqrt(500.0),), (0.0,)], "ks DOUBLE")
    p = [r[0] for r in df.select(drift.ks_p_value(F.col("ks"), F.lit(1000), F.lit(1000))).collect()]
    assert p == [pytest.approx(0.05, abs=1e-4), pytest.approx(0.01, abs=1e-4), 1.0]
