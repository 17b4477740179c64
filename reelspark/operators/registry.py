"""Run log, versions, aliases and promotion as table operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelspark.constants import PRODUCTION_ALIAS

SCHEMAS = {
    "runs": "run_id STRING, params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>, created_at TIMESTAMP",
    "model_versions": "name STRING, version INT, run_id STRING, created_at TIMESTAMP",
    "alias_events": "name STRING, alias STRING, version INT, seq BIGINT, created_at TIMESTAMP",
}


def beats(candidate: Column, champion: Column) -> Column:
    """Lower is better. No champion metric, or NaN, always loses; a missing candidate never wins."""
    wins = champion.isNull() | F.isnan(champion) | (~F.isnan(candidate) & (candidate < champion))
    return candidate.isNotNull() & F.coalesce(wins, F.lit(False))


def promotion_history(runs: DataFrame) -> DataFrame:
    """Replay of the champion rule over runs (name, version, run_id, metric) in version order.

    A promotion needs a strictly lower metric, so the champion is the running minimum;
    NaN sorts above every number, which makes it lose to all of them.
    """
    earlier = Window.partitionBy("name").orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    ranked = runs.withColumn("champion", F.min("metric").over(earlier))
    return ranked.select(
        "name",
        "version",
        "run_id",
        F.col("metric").alias("candidate"),
        "champion",
        beats(F.col("metric"), F.col("champion")).alias("promoted"),
    )


def promotion_events(history: DataFrame, alias: str = PRODUCTION_ALIAS) -> DataFrame:
    return history.where("promoted").select(
        "name", F.lit(alias).alias("alias"), "version", F.col("version").cast("bigint").alias("seq")
    )


def registration_events(versions: DataFrame, alias: str) -> DataFrame:
    """A stage alias that follows every newly registered version."""
    return versions.select("name", F.lit(alias).alias("alias"), "version", F.col("version").cast("bigint").alias("seq"))


def current_aliases(events: DataFrame) -> DataFrame:
    """Latest event of each alias."""
    return events.groupBy("name", "alias").agg(F.max_by("version", "seq").alias("version"))


def latest_version_of_run(versions: DataFrame) -> DataFrame:
    return versions.groupBy("name", "run_id").agg(F.max("version").alias("version"))


def compare_with_champion(
    runs: DataFrame, versions: DataFrame, events: DataFrame, run_id: str, metric: str
) -> DataFrame:
    """One row: the run's newest version, its metric, the champion's and the decision."""
    measured = runs.select("run_id", F.col("metrics")[metric].alias("metric"))
    champion = (
        current_aliases(events)
        .where(F.col("alias") == PRODUCTION_ALIAS)
        .join(versions.select("version", "run_id"), "version")
        .join(measured, "run_id")
        .agg(F.max("metric").alias("m"))
        .scalar()
    )
    candidate = latest_version_of_run(versions).where(F.col("run_id") == run_id).join(measured, "run_id")
    compared = candidate.withColumn("champion", champion)
    return compared.select(
        "run_id",
        "version",
        F.col("metric").alias("candidate"),
        "champion",
        beats(F.col("metric"), F.col("champion")).alias("promoted"),
    )


def run_summary(runs: DataFrame, versions: DataFrame) -> DataFrame:
    latest = latest_version_of_run(versions).select("run_id", "version")
    return runs.join(latest, "run_id", "left").select(
        "run_id", F.col("metrics")["rmse"].alias("rmse"), F.col("metrics")["mae"].alias("mae"), "version"
    )


def model_status(runs: DataFrame, versions: DataFrame, events: DataFrame) -> DataFrame:
    """What each alias serves: version, run, its metric and when it was trained."""
    return (
        current_aliases(events)
        .join(versions.select("version", "run_id", F.col("created_at").alias("last_trained")), "version")
        .join(runs.select("run_id", F.col("metrics")["rmse"].alias("rmse")), "run_id", "left")
        .select("name", "alias", F.lit(True).alias("models_loaded"), "version", "run_id", "rmse", "last_trained")
    )
