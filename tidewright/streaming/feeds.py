"""Streaming forms: append-only feeds, exactly-once dedupe, current state by upsert, event-time windows, interval maps in keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.intervals import IntervalMap, day_names, merged_by_task, valid_days
from tidewright.operators.relational import latest_by
from tidewright.session import ship
from tidewright.sources.tables import Table


def read_feed(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    """New files of a folder; the checkpoint of the query that reads it holds the offset."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def dedupe(stream: DataFrame, keys: list[str], ts: str, within: str) -> DataFrame:
    """The first row of each key; state is held for `within` after a key was seen."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def keep_latest(stream: DataFrame, target: Table, keys: list[str], order: list, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Upserts the latest row of each key into the target, batch by batch. A batch that is applied again changes nothing, so the
    target is exact although batches are delivered at least once."""

    def apply(batch: DataFrame, _: int) -> None:
        old = target.read()
        both = batch if old is None else old.unionByName(batch)
        touched = both if old is None else both.join(batch.select(*keys).distinct(), keys, "left_semi")
        target.upsert(latest_by(touched, keys, order), keys)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def gated(stream: DataFrame, task, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Runs task(batch, number) only when there are new rows."""

    def apply(batch: DataFrame, n: int) -> None:
        if not batch.isEmpty():
            task(batch, n)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], width: str, lateness: str) -> DataFrame:
    """Counts per event-time window; a window is final once the watermark (lateness) has passed it."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"))


SPANS = "array<struct<kind:string,start_date:string,end_date:string>>"


def merged_periods(stream: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The periods and gaps of each entity whenever rows for it arrive, in whatever order: the keys (as text) and spans, an array of (kind, start_date,
    end_date). See intervals.merge_intervals for which rows count and how they are put out. The ordered map of an entity's disjoint
    intervals is its state; rows are merged within their tasks before they go to it."""
    ship(stream.sparkSession)
    days = merged_by_task(valid_days(stream, keys, start, end))
    ks = days.columns[:-2]

    def update(k: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        m = IntervalMap()
        if state.exists:
            m.starts, m.ends = (np.frombuffer(bytes(x), np.int32).tolist() for x in state.get)
        for p in parts:
            for s, e in zip(p["s"].tolist(), p["e"].tolist()):
                m.insert(s, e)
        state.update(tuple(np.array(x, np.int32).tobytes() for x in (m.starts, m.ends)))
        rows = [("period", s, e) for s, e in zip(m.starts, m.ends)] + [("gap", s, e) for s, e in m.gaps()]
        first, last = day_names([r[1] for r in rows]), day_names([r[2] for r in rows])
        yield pd.DataFrame([(*k, [{"kind": r[0], "start_date": s, "end_date": e} for r, s, e in zip(rows, first, last)])], columns=[*ks, "spans"])

    out = days.groupBy(*ks).applyInPandasWithState(update, ", ".join(f"{k} string" for k in ks) + f", spans {SPANS}", "starts binary, ends binary", "update", "NoTimeout")
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "spans")
