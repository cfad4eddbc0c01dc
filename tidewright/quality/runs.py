"""Ledgers of runs: what ran when with what outcome, from what it was built, and what was reprocessed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewright.sources.tables import Table

RUNS = "run_id string, model string, started_at timestamp_ntz, completed_at timestamp_ntz, status string, rows_written long, reason string"
LINEAGE = "run_id string, model string, upstream string"


class RunLedger:
    """Runs and lineage in two tables. A run that fails is entered as FAILED with its reason, and raises."""

    def __init__(self, runs: Table, lineage: Table, clock: Callable[[], datetime] = datetime.now):
        self.runs, self.lineage, self.clock = runs, lineage, clock

    def run(self, run_id: str, model: str, upstream: dict[str, DataFrame], build: Callable[..., DataFrame], target: Table) -> DataFrame:
        """Builds a model from its upstream tables into the target; the rows are counted as they are written."""
        spark, began, seen = target.spark, self.clock(), Observation()
        status, rows, reason = "SUCCESS", None, None
        try:
            target.overwrite(build(*upstream.values()).observe(seen, F.count(F.lit(1)).alias("n")))
            rows = seen.get["n"]
        except Exception as e:
            status, reason = "FAILED", str(e)[:500]
            raise
        finally:
            self.runs.append(spark.createDataFrame([(run_id, model, began, self.clock(), status, rows, reason)], RUNS))
            self.lineage.append(spark.createDataFrame([(run_id, model, u) for u in upstream], LINEAGE))
        return target.read()

    def latest(self) -> DataFrame:
        """The newest run of each model, by its start, or its end where it has no start."""
        w = Window.partitionBy("model").orderBy(F.coalesce("started_at", "completed_at").desc_nulls_last(), F.col("run_id").desc())
        return self.runs.read().withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def watermark_status(marks: DataFrame, runs: DataFrame, as_of: str, lookback_days: int) -> DataFrame:
    """Per pipeline: last_ts, lookback_start, lag_seconds up to as_of, and its latest run (see RunLedger.latest) with status and rows."""
    lag = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("last_ts").cast("timestamp"))) / 1_000_000
    last = runs.select(F.col("model").alias("pipeline"), "run_id", "status", "rows_written")
    return marks.join(last, "pipeline", "left").select("pipeline", "last_ts", (F.col("last_ts") - F.expr(f"interval {lookback_days} days")).alias("lookback_start"), F.floor(lag).alias("lag_seconds"), F.col("run_id").alias("last_run"), "status", "rows_written")
