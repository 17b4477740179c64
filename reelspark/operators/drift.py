"""Drift between a reference and a current frame."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from reelspark.constants import DRIFT_ALPHA
from reelspark.operators.ordering import with_offsets

_SERIES_TERMS = 100


def _counted(reference: DataFrame, current: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """(column, value, n_ref, n_cur) over distinct non-null values of every column."""

    def long_form(df: DataFrame, is_ref: bool) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns])
        flat = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
        return flat.select("column", "value", F.lit(int(is_ref)).alias("r"), F.lit(int(not is_ref)).alias("c"))

    both = long_form(reference, True).unionByName(long_form(current, False)).where(F.col("value").isNotNull())
    return both.groupBy("column", "value").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))


def ks_p_value(statistic: F.Column, n_ref: F.Column, n_cur: F.Column) -> F.Column:
    """Asymptotic two-sample Kolmogorov distribution."""
    scale = statistic * F.sqrt(n_ref.cast("double") * n_cur / (n_ref + n_cur))
    sign = lambda j: F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)), lambda j: sign(j) * F.exp(F.lit(-2.0) * j * j * scale * scale)
    )
    series = 2.0 * F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
    # The alternating series does not converge near zero, where the value is one.
    return F.when(scale < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks_statistics(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Largest gap between the two empirical distributions of each numeric column."""
    counts = _counted(reference, current, columns, "double")
    running = with_offsets(counts, ["column", "value"], {"ref_before": "n_ref", "cur_before": "n_cur"})
    # One row per column; running totals do not restart, so each column has a base.
    bases = running.groupBy("column").agg(
        F.min("ref_before").alias("ref_base"),
        F.min("cur_before").alias("cur_base"),
        F.sum("n_ref").alias("n_r"),
        F.sum("n_cur").alias("n_c"),
    )
    ref_cdf = (F.col("ref_before") + F.col("n_ref") - F.col("ref_base")) / F.col("n_r")
    cur_cdf = (F.col("cur_before") + F.col("n_cur") - F.col("cur_base")) / F.col("n_c")
    return (
        running.join(F.broadcast(bases), "column")
        .groupBy("column")
        .agg(
            F.max(F.abs(ref_cdf - cur_cdf)).alias("ks"),
            F.first("n_r").alias("n_ref"),
            F.first("n_c").alias("n_cur"),
        )
    )


def drift_ks(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = DRIFT_ALPHA) -> DataFrame:
    stats = ks_statistics(reference, current, columns)
    scored = stats.withColumn("p_value", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
    return scored.withColumn("drift", F.col("p_value") < alpha)


def chi2_statistics(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Chi-square of the 2 x categories table of each column."""
    counts = _counted(reference, current, columns, "string")
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("n_r"), F.sum("n_cur").alias("n_c"), F.count(F.lit(1)).alias("categories")
    )
    both = F.col("n_r") + F.col("n_c")
    seen = F.col("n_ref") + F.col("n_cur")
    expected_ref, expected_cur = seen * F.col("n_r") / both, seen * F.col("n_c") / both
    gap = F.pow(F.col("n_ref") - expected_ref, F.lit(2)) / expected_ref + F.pow(
        F.col("n_cur") - expected_cur, F.lit(2)
    ) / expected_cur
    return (
        counts.join(F.broadcast(totals), "column")
        .groupBy("column")
        .agg(F.sum(gap).alias("chi2"), (F.first("categories") - 1).cast("bigint").alias("dof"))
    )


def _chi2_tail():
    """Upper tail of the chi-square distribution, one value per tested column."""

    # Nested so that it travels with the task: executors need not have this package.
    def upper_gamma(a: float, x: float) -> float:
        if x <= 0 or a <= 0:
            return 1.0
        front = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1:
            term = total = 1.0 / a
            step = a
            while abs(term) > abs(total) * 1e-15:
                step += 1
                term *= x / step
                total += term
            return max(0.0, 1.0 - front * total)
        # Continued fraction evaluated from the far end.
        tail = 0.0
        for i in range(200 + int(2 * math.sqrt(x)), 0, -1):
            tail = i * (i - a) / (x + 2 * i + 1 - a - tail)
        return front / (x + 1 - a - tail)

    def tail(chi2: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([upper_gamma(d / 2.0, c / 2.0) for c, d in zip(chi2, dof)])

    return F.pandas_udf(tail, DoubleType())


def drift_chi2(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = DRIFT_ALPHA) -> DataFrame:
    stats = chi2_statistics(reference, current, columns)
    return stats.withColumn("p_value", _chi2_tail()("chi2", "dof")).withColumn("drift", F.col("p_value") < alpha)


def drift_report(
    reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], alpha: float = DRIFT_ALPHA
) -> DataFrame:
    """One row per column: test, statistic, p-value and flag."""
    ks = drift_ks(reference, current, numeric, alpha).select(
        "column", F.lit("ks").alias("test"), F.col("ks").alias("statistic"), "p_value", "drift"
    )
    if not categorical:
        return ks
    chi2 = drift_chi2(reference, current, categorical, alpha).select(
        "column", F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"), "p_value", "drift"
    )
    return ks.unionByName(chi2)
