"""Batch file to promoted model: intake, train, evaluate, register, promote."""

from __future__ import annotations

from inspect import signature

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.constants import (
    HOLDOUT_PCT,
    N_COMPONENTS,
    SEED,
    STAGING_ALIAS,
    TRAIN_CHUNK_SIZE,
)
from reelspark.operators.drift import drift_ks
from reelspark.operators.evaluate import evaluate
from reelspark.operators.model import FactorModel, train_svd
from reelspark.operators.profile import fingerprint
from reelspark.operators.sampling import (
    capped_train_rows,
    distinct_movies,
    distinct_users,
    effective_cap,
    holdout_rows,
    latest_known_holdout,
    train_rows,
)
from reelspark.session import materialise, scratch
from reelspark.sources.models import Registry, load_model, save_model
from reelspark.sources.store import RatingsStore
from reelspark.streaming.intake import run_intake


def train_and_evaluate(
    ratings: DataFrame,
    k: int = N_COMPONENTS,
    base: int = 1,
    remainder: int = 0,
    percent: int = HOLDOUT_PCT,
    max_rows: int | None = None,
    chunk: int = TRAIN_CHUNK_SIZE,
    cap: int | None = None,
    batch_id: str | None = None,
) -> tuple[FactorModel, dict[str, float]]:
    """A model and its holdout errors; no errors when the holdout is empty.

    All users and rows take part; ``base``/``remainder`` draw a user sample, ``max_rows`` and ``cap``
    cut the training and the evaluation rows.
    """
    train = train_rows(ratings, base, remainder, percent, batch_id)
    if max_rows is not None and train.count() > effective_cap(max_rows, chunk):
        train = materialise(capped_train_rows(train.select("userId", "movieId", "timestamp", "rating"), max_rows, chunk))
    model = train_svd(train, k)
    pairs = latest_known_holdout(
        holdout_rows(ratings, base, remainder, percent),
        distinct_users(ratings, base, remainder),
        distinct_movies(ratings),
        cap,
    )
    row = evaluate(pairs, model).first()
    return model, {} if row is None else {name: float(row[name]) for name in ("rmse", "mae", "predictions")}


def data_version(ratings: DataFrame) -> str:
    """Rows and digests of the ratings a run has seen."""
    mark = fingerprint(ratings.select("userId", "movieId", "rating", "timestamp")).first()
    return f"{mark['n']}-{mark['xor_hash']}-{mark['sum_hash']}"


def newest_batch_drift(ratings: DataFrame) -> dict[str, float]:
    """KS statistic of the newest batch's ratings against all others; nothing with one batch."""
    newest = ratings.agg(F.max("batch_seq")).first()[0]
    before, after = (ratings.where(c) for c in (F.col("batch_seq") < newest, F.col("batch_seq") == newest))
    if newest is None or before.isEmpty():
        return {}
    row = drift_ks(before, after, ["rating"]).first()
    return {"rating_ks": float(row["ks"]), "rating_drift": float(row["drift"])}


def retrain(store: RatingsStore, registry: Registry, scope: str = "cumulative", **training) -> str:
    """Train on the stored ratings (or on the newest batch), log, register, stage and promote.

    The log holds every effective parameter, the split sizes, the version of the data and whether
    the newest batch has drifted. Intermediate tables go when the run ends.
    """
    with scratch(registry.spark):
        ratings = materialise(store.current().withColumn("rating", F.col("rating").cast("double")))
        batch_id = None
        if scope == "batch":
            batch_id = store.log().agg(F.max_by("batch_id", "batch_seq")).first()[0]
        model, metrics = train_and_evaluate(ratings, batch_id=batch_id, **training)
        defaults = {
            name: value.default
            for name, value in signature(train_and_evaluate).parameters.items()
            if name not in ("ratings", "batch_id", "k")
        }
        params = {
            **defaults, **training, "n_components": model.k, "random_state": SEED, "train_scope": scope,
            "batch_id": batch_id, "n_train": model.n_train, "n_ratings": ratings.count(), "data_version": data_version(ratings),
        }
        run_id = registry.log_run(params, {**metrics, **newest_batch_drift(ratings)})
        version = registry.register(run_id)
        save_model(model, registry.model_path(version))
        registry.set_alias(STAGING_ALIAS, version)
        if metrics:
            registry.promote(run_id)
        return run_id


def run_pipeline(
    spark: SparkSession,
    store: RatingsStore,
    registry: Registry,
    landing: str,
    processed: str,
    failed: str,
    checkpoint: str,
    scope: str = "cumulative",
    **training,
) -> None:
    """Intake of all landed batches; every trigger that publishes also retrains."""
    run_intake(
        spark,
        store,
        landing,
        processed,
        failed,
        checkpoint,
        after_publish=lambda trigger: retrain(store, registry, scope, **training) and None,
    )


def serving_model(registry: Registry, override: str | None = None) -> FactorModel:
    """The model the production alias points at, unless a location is given."""
    path = registry.resolve(override=override)
    if path is None:
        raise LookupError("no production model has been promoted")
    return load_model(registry.spark, path)
