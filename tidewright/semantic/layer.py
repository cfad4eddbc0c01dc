"""Metrics by name: a registry, and a compiler from (metrics, dimensions, filters) to DataFrames.

Each logical table is aggregated to the requested grain by itself and only then joined, so facts never fan out; ratios are computed
from their aggregated parts, never averaged; distinct counts can't be summed up."""

from __future__ import annotations

import difflib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    """table and aggregate for a base metric; over = (numerator, denominator) for a ratio of two metrics."""

    name: str
    table: str = ""
    aggregate: Callable[[], Column] | None = None
    over: tuple[str, str] | None = None
    additive: bool = True
    synonyms: tuple[str, ...] = ()
    description: str = ""
    certified: bool = True


@dataclass
class Model:
    """tables: a DataFrame for each logical table, with all its dimensions as columns."""

    tables: dict[str, DataFrame]
    metrics: dict[str, Metric]
    dimensions: dict[str, tuple[str, ...]]  # by table
    synonyms: dict[str, str] | None = None
    default_filter: dict[str, str] | None = None  # SQL by table

    def resolve(self, name: str) -> str:
        """A metric or dimension by name or synonym, whatever its case; an unknown name raises with the closest ones."""
        wanted = name.strip().lower().replace(" ", "_")
        names = {m: m for m in self.metrics} | {s.lower().replace(" ", "_"): m for m, x in self.metrics.items() for s in x.synonyms}
        names |= {d: d for ds in self.dimensions.values() for d in ds} | {k.lower().replace(" ", "_"): v for k, v in (self.synonyms or {}).items()}
        if wanted in names:
            return names[wanted]
        raise KeyError(f"{name}: unknown; close to {difflib.get_close_matches(wanted, names, 3)}")

    def query(self, metrics: list[str], dimensions: list[str] = (), filters: list[str] = (), limit: int | None = None) -> DataFrame:
        """The metrics by the dimensions; filters are SQL conditions on dimensions and hold for every table. With a limit the first rows
        by the dimensions' order, otherwise all, in no order."""
        wanted, dims = [self.resolve(m) for m in metrics], [self.resolve(d) for d in dimensions]
        base = list(dict.fromkeys(b for m in wanted for b in (self.metrics[m].over or (m,))))
        by_table: dict[str, list[str]] = {}
        for b in base:
            by_table.setdefault(self.metrics[b].table, []).append(b)
        out = None
        for t, names in by_table.items():
            missing = [d for d in dims if d not in self.dimensions[t]]
            if missing:
                raise ValueError(f"{t} has no dimension {missing}")
            df = self.tables[t]
            for f in [*filters, *([self.default_filter[t]] if (self.default_filter or {}).get(t) else [])]:
                df = df.filter(f)
            agg = df.groupBy(*dims).agg(*[self.metrics[n].aggregate().alias(n) for n in names])
            if out is None:
                out = agg
            elif dims:
                same = None
                for d in dims:
                    x = out[d].eqNullSafe(agg[d])
                    same = x if same is None else same & x
                out = out.join(agg, same, "full").select(*[F.coalesce(out[d], agg[d]).alias(d) for d in dims], *[out[c] for c in out.columns if c not in dims], *[agg[n] for n in names])
            else:
                out = out.crossJoin(agg)  # one row each
        ratios = {m: F.col(self.metrics[m].over[0]) / F.nullif(F.col(self.metrics[m].over[1]).cast("double"), F.lit(0.0)) for m in wanted if self.metrics[m].over}
        out = out.select(*dims, *[ratios[m].alias(m) if m in ratios else F.col(m) for m in wanted])
        return out.orderBy(*dims).limit(limit) if dims and limit is not None else out

    def allowed(self, metric: Metric) -> list[str]:
        """The dimensions by which a metric may be asked: of a ratio those that both parts have."""
        parts = [self.dimensions.get(self.metrics[m].table, ()) for m in metric.over] if metric.over else [self.dimensions.get(metric.table, ())]
        return sorted(set(parts[0]).intersection(*parts[1:]))

    def registry(self, spark: SparkSession) -> DataFrame:
        rows = [(m.name, m.table, "RATIO" if m.over else "BASE", m.additive, m.certified, self.allowed(m), m.description) for m in self.metrics.values()]
        return spark.createDataFrame(rows, "metric_name string, logical_table string, kind string, is_additive boolean, is_certified boolean, allowed_dimensions array<string>, description string")
