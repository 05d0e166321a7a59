"""Job reports: metric lines, a bundle per run and a table of runs."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession

REPORT_SCHEMA = ("run_name string, mode string, job string, start_time double, status string, total_elapsed_s double, "
                 "throughput double, metrics map<string,double>")


class JobReport:
    """Collects the numbers of one run; counts come from the writes themselves."""

    def __init__(self, spark: SparkSession, job: str, mode: str = "cpu", run_name: str | None = None) -> None:
        self.spark = spark
        self.job = job
        self.mode = mode
        self.started = time.time()
        self.run_name = run_name or f"{mode}-{spark.conf.get('spark.executor.instances', '?')}ex"
        self.metrics: dict[str, float] = {}

    def metric(self, key: str, value: float, unit: str = "") -> None:
        self.metrics[key] = value
        print(f"[METRIC] {key}={value}{' ' + unit if unit else ''}")

    def timed(self, key: str, began: float) -> None:
        self.metric(f"{key}_elapsed_s", round(time.time() - began, 2), "s")

    def finish(self, rows: int | None = None, table: str | None = None, status: str = "FINISHED") -> dict:
        """Close the run: totals, the bundle, and one row appended to the report table."""
        elapsed = time.time() - self.started
        self.metric("total_elapsed_s", round(elapsed, 2), "s")
        if rows is not None:
            self.metric("throughput_rows_per_s", int(rows / elapsed) if elapsed > 0 else 0, "rows/s")
        bundle = {
            "run_name": self.run_name, "mode": self.mode, "job": self.job, "status": status,
            "metrics": self.metrics, "wall_clock_s": round(elapsed, 2),
            "spark": {"app_id": self.spark.sparkContext.applicationId, "version": self.spark.version},
        }
        print(json.dumps(bundle, indent=2))
        if table:
            self._row(elapsed, status).coalesce(1).write.mode("append").parquet(table)
        return bundle

    def _row(self, elapsed: float, status: str) -> DataFrame:
        numbers = {k: float(v) for k, v in self.metrics.items()}
        row = (self.run_name, self.mode, self.job, self.started, status, elapsed,
               numbers.get("throughput_rows_per_s", 0.0), numbers)
        return self.spark.createDataFrame([row], REPORT_SCHEMA)
