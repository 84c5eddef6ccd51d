"""Run manifest: one row per (run, entity)."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

MANIFEST_DDL = (
    "snapshot_id string, entity string, status string, row_count bigint, raw_path string, "
    "table_path string, extra_paths map<string,string>, duration_ms bigint, error string"
)


class Stage:
    """Collects the result of one entity while its stage runs."""

    def __init__(self) -> None:
        self.result: dict[str, Any] = {}
        self._counts: list[Observation] = []

    def counted(self, df: DataFrame) -> DataFrame:
        """The same table, counting its rows as a by-product of the next write."""
        seen = Observation()
        self._counts.append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("row_count"))

    def record(self, status: str = "success", **values: Any) -> None:
        """Mark the stage done; the row count comes from ``counted`` unless given."""
        if "row_count" not in values and self._counts:
            values["row_count"] = self._counts[-1].get["row_count"]
        self.result = {"status": status, **values}


class RunManifest:
    """Statistics of the stages of one run."""

    def __init__(self, spark: SparkSession, snapshot: str):
        self.spark, self.snapshot = spark, snapshot
        self._rows: dict[str, dict[str, Any]] = {}

    @contextmanager
    def stage(self, entity: str) -> Iterator[Stage]:
        """Time a stage. It is skipped unless recorded; an error is recorded and raised."""
        start, stage = time.perf_counter(), Stage()
        outcome: dict[str, Any] = {"status": "skipped"}
        try:
            yield stage
            outcome = stage.result or outcome
        except Exception as e:
            outcome = stage.result or {"status": "failed", "error": f"{type(e).__name__}: {e}"}
            raise
        finally:
            took = int((time.perf_counter() - start) * 1000)
            self._rows[entity] = {"row_count": 0, "duration_ms": took, **outcome}

    def failed(self) -> set[str]:
        """Entities whose stage failed in this run."""
        return {e for e, row in self._rows.items() if row["status"] == "failed"}

    def table(self) -> DataFrame:
        """The manifest so far."""
        names = [f.split()[0] for f in MANIFEST_DDL.split(", ")]
        rows = [
            tuple({"snapshot_id": self.snapshot, "entity": e, "extra_paths": {}, **r}.get(n)
                  for n in names)
            for e, r in self._rows.items()
        ]
        return self.spark.createDataFrame(rows, MANIFEST_DDL)

    def save(self, path: str) -> None:
        """Append this run's rows to the manifest table."""
        self.table().coalesce(1).write.mode("append").json(path)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).json(path)


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Per run: stages by outcome, total rows and total duration."""
    status = F.col("status")
    return manifest.groupBy("snapshot_id").agg(
        F.count_if(status == "success").alias("successful"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "skipped").alias("skipped"),
        F.count("*").alias("total_entities"),
        F.sum("row_count").alias("total_records"),
        F.sum("duration_ms").alias("duration_ms"),
    )
