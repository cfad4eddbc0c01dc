"""Continuous periods and gaps from intervals that overlap, nest, touch or leave gaps.

The state of an entity is an ordered map of disjoint intervals: an insert finds what it overlaps by binary search and merges it. Maps are
mergeable, so each partition first builds maps of its own rows and only their disjoint intervals are shuffled to the entity's task. In whole
days a map can't outgrow the calendar, however many rows an entity has."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.session import ship

OPEN = 2_932_896  # 9999-12-31 in days
HELD = 500_000  # intervals that a task holds before it passes its maps on


class IntervalMap:
    """Disjoint half-open intervals [start, end) in order; those that touch are one."""

    __slots__ = ("starts", "ends")

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def insert(self, start: int, end: int) -> None:
        if end <= start:
            return
        i = bisect_left(self.ends, start)  # the first that ends at or after start
        j = bisect_right(self.starts, end)  # the first that starts after end
        if i < j:
            start, end = min(start, self.starts[i]), max(end, self.ends[j - 1])
        self.starts[i:j] = [start]
        self.ends[i:j] = [end]

    def gaps(self) -> Iterator[tuple[int, int]]:
        return zip(self.ends, self.starts[1:])

    def __len__(self) -> int:
        return len(self.starts)


def day_names(days: list[int]) -> np.ndarray:
    return np.array(days, "datetime64[D]").astype(str).astype(object)


def valid_days(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """k0, k1, ... (the keys as text), s and e in days, of the rows that have keys, a start, and an end after it; a null end is open."""
    ks = [f"k{i}" for i in range(len(keys))]
    days = df.select(*[F.col(k).cast("string").alias(n) for n, k in zip(ks, keys)], F.unix_date(start).alias("s"), F.coalesce(F.unix_date(end), F.lit(OPEN)).alias("e"))
    return days.filter(" and ".join([f"{k} is not null" for k in ks] + ["e > s"]))


def merged_by_task(days: DataFrame) -> DataFrame:
    """The disjoint intervals of each entity among a task's rows; of a stream, among those of a micro-batch. A task that holds more than HELD intervals
    passes its maps on, so an entity may come several times."""
    ks = days.columns[:-2]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maps: dict[tuple, IntervalMap] = {}
        n = 0

        def flush() -> pd.DataFrame:
            rows = [(*k, s, e) for k, m in maps.items() for s, e in zip(m.starts, m.ends)]
            maps.clear()
            return pd.DataFrame(rows, columns=[*ks, "s", "e"])

        for p in parts:
            for *k, s, e in zip(*[p[c].tolist() for c in [*ks, "s", "e"]]):
                maps.setdefault(tuple(k), IntervalMap()).insert(s, e)
            n += len(p)
            if n > HELD:
                n = sum(map(len, maps.values()))
                if n > HELD // 2:
                    yield flush()
                    n = 0
        yield flush()

    return days.mapInPandas(run, ", ".join(f"{k} string" for k in ks) + ", s int, e int")


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The keys (as text), kind (period, gap), start_date and end_date (yyyy-MM-dd, the end not included) of each entity.

    start and end are dates; a null end, or 9999-12-31, is open and put out as 9999-12-31. Left out are rows with a null key or start, or
    with an end not after the start. Intervals that overlap or touch form one period; a gap runs from a period to the next. Repeated rows
    change nothing, other columns are ignored, and an empty table gives no rows."""
    ship(df.sparkSession)
    days = valid_days(df, keys, start, end)
    ks = days.columns[:-2]

    def final(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, out = None, IntervalMap(), []

        def close() -> None:
            out.extend((*key, "period", s, e) for s, e in zip(state.starts, state.ends))
            out.extend((*key, "gap", s, e) for s, e in state.gaps())

        def frame() -> pd.DataFrame:
            f = pd.DataFrame(out, columns=[*ks, "kind", "s", "e"])
            f["s"], f["e"] = day_names(f["s"].tolist()), day_names(f["e"].tolist())
            out.clear()
            return f

        for p in parts:
            for *k, s, e in zip(*[p[c].tolist() for c in [*ks, "s", "e"]]):
                if k != key:
                    if key is not None:
                        close()
                    key, state = k, IntervalMap()
                state.insert(s, e)
            if len(out) > 10_000:
                yield frame()
        if key is not None:
            close()
        if out:
            yield frame()

    merged = merged_by_task(days).repartition(*ks).sortWithinPartitions(*ks).mapInPandas(final, ", ".join(f"{k} string" for k in ks) + ", kind string, s string, e string")
    return merged.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "kind", F.col("s").alias("start_date"), F.col("e").alias("end_date"))
