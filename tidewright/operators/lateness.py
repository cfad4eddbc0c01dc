"""Counts per month of event time, corrected as late rows arrive, with a cut-off for lateness.

Each partition is a shard with a finger tree of its own, keyed by the hour of event time, through which its rows pass in order of
arrival. As the clock of arrivals moves, months are reported and, at the cut-off, evicted in bulk; the tree says of a row that is put into it whether
it comes after its month's report, and corrects it, or behind the evicted edge, where it is too late. Partials of the shards are sums, so months are combined by one small
aggregation and rows are never moved."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.expr import micros
from tidewright.operators.fingertree import TOO_LATE, FingerTree
from tidewright.session import ship
from tidewright.sources.tables import Table

HOUR, DAY = 3_600_000_000, 86_400_000_000
OUTCOMES = ("on_time", "correction", "too_late")


def _month(us: int) -> int:
    return int(np.datetime64(us, "us").astype("datetime64[M]").astype(int))


def _starts(month: int) -> int:
    return int(np.datetime64(month, "M").astype("datetime64[us]").astype(int))


def month_name(month: int) -> str:
    return str(np.datetime64(month, "M"))


class MonthlyCounts:
    """One shard. grace: days from a month's end to its report; cut_off: days from its end until its rows are too late."""

    def __init__(self, grace: int, cut_off: int):
        self.grace, self.cut_off = grace * DAY, cut_off * DAY
        self.tree = FingerTree()
        self.turn = None
        self.closed: dict[int, np.ndarray] = {}

    def _advance(self, clock: int) -> None:
        """Moves the tree's edges: months that are over by more than the grace are reported, those over by more than the cut-off are closed."""
        reported, evicted = _starts(_month(clock - self.grace)), _starts(_month(clock - self.cut_off))
        self._close(evicted)
        self.tree.report(reported // HOUR)
        self.turn = min(_starts(_month(reported) + 1) + self.grace, _starts(_month(evicted) + 1) + self.cut_off)

    def _close(self, before: int) -> None:
        """Takes the totals of the months before out of the tree, a subtree at a time."""
        first = next(self.tree.items(), None)
        while first is not None and first[0] * HOUR < before:
            m = _month(first[0] * HOUR)
            end = min(_starts(m + 1), before)
            self._count(m, self.tree.total(first[0], end // HOUR))
            self.tree.evict(end // HOUR)
            first = next(self.tree.items(), None)
        self.tree.evict(before // HOUR)

    def _count(self, month: int, counts: np.ndarray) -> None:
        self.closed[month] = self.closed.get(month, 0) + counts

    def arrive(self, events: np.ndarray, arrivals: np.ndarray) -> np.ndarray:
        """Outcomes of rows in order of arrival (microseconds), as the tree judges them when they are put into it."""
        out = np.empty(len(events), np.int8)
        at, n = 0, len(events)
        while at < n:
            if self.turn is None or arrivals[at] >= self.turn:
                self._advance(int(arrivals[at]))
            to = int(np.searchsorted(arrivals, self.turn, "left")) if arrivals[-1] >= self.turn else n
            hours, where, count = np.unique(events[at:to] // HOUR, return_inverse=True, return_counts=True)
            judged = np.empty(len(hours), np.int8)
            for i, (k, c) in enumerate(zip(hours.tolist(), count.tolist())):
                judged[i] = outcome = self.tree.add(k, np.array([c, 0, 0]), np.array([0, c, 0]))
                if outcome == TOO_LATE:  # counted apart, the closed month stays as it is
                    self._count(_month(k * HOUR), np.array([0, 0, c]))
            out[at:to] = judged[where]
            at = to
        return out

    def months(self) -> dict[int, np.ndarray]:
        """(on time, corrections, too late) by month, of all rows so far."""
        out = dict(self.closed)
        for k, counts in self.tree.items():
            m = _month(k * HOUR)
            out[m] = out.get(m, 0) + counts
        return out


def _prepared(df: DataFrame, key: str, event: str, arrived: list[str]) -> DataFrame:
    ship(df.sparkSession)
    return (
        df.select(F.col(key).alias("key"), micros(event).alias("e"), micros(F.coalesce(*[F.col(a) for a in arrived])).alias("a"))
        .filter("e is not null and a is not null")
        .sortWithinPartitions("a")
    )


def late_rows(df: DataFrame, key: str, event: str, arrived: list[str], grace: int = 7, cut_off: int = 90) -> DataFrame:
    """key, period (yyyy-MM of event time) and outcome (on_time, correction, too_late) of each row with an event time and an arrival
    time, which is the first of `arrived` that isn't null. A row that arrives at or after its month's end plus `grace` days is a correction,
    at or after the end plus `cut_off` days too late. Rows without either time are left out; repeated rows count each time."""
    kind = df.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = MonthlyCounts(grace, cut_off)
        names = np.array(OUTCOMES, object)
        for p in parts:
            e = p["e"].to_numpy()
            outcome = shard.arrive(e, p["a"].to_numpy())
            months = e.astype("datetime64[us]").astype("datetime64[M]")
            yield pd.DataFrame({"key": p["key"], "period": months.astype(str), "outcome": names[outcome]})

    return _prepared(df, key, event, arrived).mapInPandas(run, f"key {kind}, period string, outcome string").withColumnRenamed("key", key)


def monthly_counts(df: DataFrame, event: str, arrived: list[str], grace: int = 7, cut_off: int = 90) -> DataFrame:
    """period, reported (rows in time for the month's report), corrections, corrected (both), too_late; one row per month that has
    rows. See late_rows for what is counted where."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = MonthlyCounts(grace, cut_off)
        for p in parts:
            shard.arrive(p["e"].to_numpy(), p["a"].to_numpy())
        rows = [(month_name(m), *map(int, v)) for m, v in shard.months().items()]
        yield pd.DataFrame(rows, columns=["period", "reported", "corrections", "too_late"])

    parts = _prepared(df.withColumn("_none", F.lit(0)), "_none", event, arrived).mapInPandas(run, "period string, reported long, corrections long, too_late long")
    return _summed(parts)


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("period").agg(
        F.sum("reported").alias("reported"), F.sum("corrections").alias("corrections"), F.sum(F.col("reported") + F.col("corrections")).alias("corrected"), F.sum("too_late").alias("too_late")
    )


class MonthLog:
    """Monthly counts that outlive a run: each batch adds the partials of its shards' trees, one row per month that it changes, to a table. Batches may
    come in any order, as a row is judged by its own arrival; a batch is counted each time it is given."""

    def __init__(self, table: Table, grace: int = 7, cut_off: int = 90):
        self.table, self.grace, self.cut_off = table, grace, cut_off

    def advance(self, batch: DataFrame, event: str, arrived: list[str]) -> DataFrame:
        """Takes a batch in and returns what it changes: period, reported, corrections, corrected and too_late, all as differences. A month with
        corrections was reported before."""
        changes = monthly_counts(batch, event, arrived, self.grace, self.cut_off)
        stats = self.table.append(changes)
        return self.table.written(stats)

    def months(self) -> DataFrame:
        return _summed(self.table.read().select("period", "reported", "corrections", "too_late"))
