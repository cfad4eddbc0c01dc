"""A registry of models (DataFrame in, DataFrame out), run in order of their dependencies."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession


class Graph:
    def __init__(self):
        self.models: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {}

    def model(self, *needs: str):
        """Registers a function of the models or sources named."""

        def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.models[f.__name__] = (needs, f)
            return f

        return add

    def downstream(self, changed: set[str]) -> list[str]:
        """The changed models and all that depend on them, in order."""
        out: set[str] = set(changed)
        for name in self.order():
            if out & set(self.models[name][0]):
                out.add(name)
        return [n for n in self.order() if n in out]

    def order(self) -> list[str]:
        return [n for n in TopologicalSorter({k: set(v[0]) for k, v in self.models.items()}).static_order() if n in self.models]

    def build(self, sources: dict[str, DataFrame], select: list[str] | None = None) -> dict[str, DataFrame]:
        """Plans all models, or those selected and what they need; nothing runs yet."""
        out = dict(sources)
        need = set(select or self.models)
        for n in reversed(self.order()):
            if n in need:
                need |= set(self.models[n][0])
        for n in self.order():
            if n in need:
                out[n] = self.models[n][1](*[out[d] for d in self.models[n][0]])
        return out

    def write(self, spark: SparkSession, sources: dict[str, DataFrame], path: str, threads: int = 4) -> dict[str, DataFrame]:
        """Writes each model as a table and builds the next ones on what was written; models that don't depend on each other run at once."""
        out, sorter = dict(sources), TopologicalSorter({k: set(v[0]) & self.models.keys() for k, v in self.models.items()})
        sorter.prepare()

        def one(name: str) -> str:
            needs, f = self.models[name]
            f(*[out[d] for d in needs]).write.mode("overwrite").parquet(f"{path}/{name}")
            out[name] = spark.read.parquet(f"{path}/{name}")
            return name

        with ThreadPoolExecutor(threads) as pool:
            while sorter.is_active():
                for name in list(pool.map(one, sorter.get_ready())):
                    sorter.done(name)
        return out
