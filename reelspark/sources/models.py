"""Model artefacts and the run log, versions and alias events as parquet tables."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelspark.constants import MODEL_NAME, PRODUCTION_ALIAS
from reelspark.operators import registry
from reelspark.operators.model import FactorModel
from reelspark.sources import files

_META = "global_mean DOUBLE, singular_values ARRAY<DOUBLE>, n_items BIGINT, n_train BIGINT"


def save_model(model: FactorModel, path: str) -> None:
    spark = model.user_factors.sparkSession
    model.user_factors.write.mode("overwrite").parquet(f"{path}/user_factors")
    model.item_factors.write.mode("overwrite").parquet(f"{path}/item_factors")
    meta = [(model.global_mean, model.singular_values, model.n_items, model.n_train)]
    # Written last: a model without it is incomplete.
    spark.createDataFrame(meta, _META).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> FactorModel:
    if not files.published(spark, f"{path}/meta"):
        raise FileNotFoundError(f"no complete model at {path}")
    meta = spark.read.schema(_META).parquet(f"{path}/meta").first()
    return FactorModel(
        meta["global_mean"],
        list(meta["singular_values"]),
        spark.read.parquet(f"{path}/user_factors"),
        spark.read.parquet(f"{path}/item_factors"),
        meta["n_items"],
        meta["n_train"],
    )


@dataclass(frozen=True)
class Registry:
    """Append-only metadata tables under one root; one row per run, version or alias event."""

    spark: SparkSession
    root: str
    name: str = MODEL_NAME

    def _read(self, table: str) -> DataFrame:
        path = f"{self.root}/{table}"
        schema = registry.SCHEMAS[table]
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)

    def _append(self, table: str, *row) -> None:
        frame = self.spark.createDataFrame([(*row, datetime.now(timezone.utc))], registry.SCHEMAS[table])
        # A folder for each row: two writers of one folder would clear each other's unfinished files.
        frame.coalesce(1).write.parquet(f"{self.root}/{table}/{uuid.uuid4().hex}")

    def _claims(self, table: str) -> str:
        return f"{self.root}/claims/{table}"

    def _last_event(self) -> int:
        return self._read("alias_events").agg(F.max("seq")).first()[0] or 0

    def runs(self) -> DataFrame:
        return self._read("runs")

    def versions(self) -> DataFrame:
        return self._read("model_versions").where(F.col("name") == self.name)

    def alias_events(self) -> DataFrame:
        return self._read("alias_events").where(F.col("name") == self.name)

    def model_path(self, version: int) -> str:
        return f"{self.root}/model/version={version}"

    def log_run(self, params: dict[str, str], metrics: dict[str, float], run_id: str | None = None) -> str:
        run_id = run_id or uuid.uuid4().hex
        self._append("runs", run_id, {k: str(v) for k, v in params.items()}, metrics)
        return run_id

    def register(self, run_id: str) -> int:
        """Next version number of the model for a logged run; no two callers get the same."""
        last = self.versions().agg(F.max("version")).first()[0] or 0
        version = files.claim_number(self.spark, f"{self._claims('model_versions')}/{self.name}", last, uuid.uuid4().hex)
        self._append("model_versions", self.name, version, run_id)
        return version

    def set_alias(self, alias: str, version: int) -> None:
        """Point an alias at a version; pointing it back is a rollback. The last caller wins."""
        seq = files.claim_number(self.spark, self._claims("alias_events"), self._last_event(), uuid.uuid4().hex)
        self._append("alias_events", self.name, alias, version, seq)

    def resolve(self, alias: str = PRODUCTION_ALIAS, override: str | None = None) -> str | None:
        """Model location for an alias; an explicit location wins."""
        if override:
            return override
        row = registry.current_aliases(self.alias_events()).where(F.col("alias") == alias).first()
        return None if row is None else self.model_path(row["version"])

    def promote(self, run_id: str, metric: str = "rmse", patience: float = 10.0) -> bool:
        """Move the production alias to the run's newest version if it beats the champion.

        The move takes the number right after the events the decision has seen. When another caller
        holds it, the decision is made anew with that caller's event; a claim whose event does not
        come within ``patience`` seconds belongs to a writer that was lost, and is passed over.
        """
        floor = 0
        while True:
            seen = self._last_event()
            events = self.alias_events().where(F.col("seq") <= seen)
            decision = registry.compare_with_champion(self.runs(), self.versions(), events, run_id, metric).first()
            if decision is None:
                raise ValueError(f"run {run_id} has no registered version")
            if not decision["promoted"]:
                return False
            seq = max(seen, floor) + 1
            if files.claim(self.spark, f"{self._claims('alias_events')}/{seq:012d}", uuid.uuid4().hex):
                self._append("alias_events", self.name, PRODUCTION_ALIAS, decision["version"], seq)
                return True
            until = time.monotonic() + patience
            while self._last_event() < seq and time.monotonic() < until:
                time.sleep(0.2)
            floor = seq

    def status(self) -> DataFrame:
        return registry.model_status(self.runs(), self.versions(), self.alias_events())

    def summary_json(self, run_id: str) -> str:
        """One-line run summary: run id, errors and version."""
        row = registry.run_summary(self.runs(), self.versions()).where(F.col("run_id") == run_id).first()
        return json.dumps({name: row[name] for name in ("run_id", "rmse", "mae", "version")})
