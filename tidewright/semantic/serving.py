"""Calls for those who may only read the marts: objects, metrics, summaries and guarded SQL, each answer bounded and logged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.semantic import guard, layer


@dataclass
class Server:
    """marts: by name, a function that gives the DataFrame. log: the statements that were asked (see guard.answer)."""

    spark: SparkSession
    marts: dict[str, Callable[[], DataFrame]]
    model: layer.Model
    log: list = field(default_factory=list)

    def objects(self) -> DataFrame:
        """mart, column, type of all marts."""
        rows = [(name, f.name, f.dataType.simpleString()) for name, df in sorted(self.marts.items()) for f in df().schema]
        return self.spark.createDataFrame(rows, "mart string, column string, type string")

    def metric(self, name: str) -> dict:
        """A metric's definition by name or synonym; for an unknown one the names closest to it, as suggestions."""
        try:
            found = self.model.resolve(name)
        except KeyError as e:
            return {"asked": name, "suggestions": e.args[0]}
        if found not in self.model.metrics:
            return {"asked": name, "suggestions": f"{found} is a dimension"}
        m = self.model.metrics[found]
        return {"asked": name, "metric_name": m.name, "description": m.description, "over": m.over, "is_additive": m.additive, "is_certified": m.certified, "dimensions": self.model.allowed(m)}

    def run_sql(self, sql: str, max_rows: int = 1000) -> guard.Answer:
        """A guarded statement over the marts, which it names without a schema."""
        try:
            for n in guard.check(self.spark, sql, set(self.marts)):
                self.marts[n]().createOrReplaceTempView(n)
        except guard.Blocked as e:
            self.log.append((sql, "BLOCKED", str(e), 0.0))
            raise
        return guard.answer(self.spark, sql, set(self.marts), max_rows, self.log)

    def summary(self, mart: str, by: list[str], measures: dict[str, str], where: dict[str, str] | None = None, max_rows: int = 1000) -> guard.Answer:
        """Measures (SQL aggregates by name) of a mart by columns, for the rows whose columns have the values given; in order of the columns. Values
        are compared as values, never as SQL."""
        df = self.marts[mart]()
        for c, v in (where or {}).items():
            df = df.filter(F.col(c) == F.lit(v))
        out = df.groupBy(*by).agg(*[F.expr(e).alias(n) for n, e in measures.items()]).orderBy(*by)
        rows = out.limit(max_rows + 1).collect()
        return guard.Answer(self.spark.createDataFrame(rows[:max_rows], out.schema), len(rows) > max_rows)
