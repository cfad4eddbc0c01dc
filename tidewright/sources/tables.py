"""Versioned Parquet tables: overwrite, append and upsert with an atomic swap; watermarks; reprocessing.

A table is a folder of Parquet files and a CURRENT file that lists those that count. A write adds files and then replaces CURRENT by one rename, so a
reader sees a table before or after a write, and a write that dies leaves the table as it was. An append writes only its own rows; an upsert
rewrites only the files that hold a key it replaces."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """The source of an upsert has a key twice."""


class Conflict(RuntimeError):
    """Another writer has replaced the state that a write began with."""


@dataclass(frozen=True)
class WriteStats:
    version: str
    rows: int  # written, those carried over from rewritten files included


class Pointer:
    """A small JSON file that is read whole and replaced by one rename."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder, name
        self._hp = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hp(folder).getFileSystem(self._conf)

    def get(self) -> dict | None:
        p = self._hp(f"{self.folder}/{self.name}")
        if not self._fs.exists(p):
            return None
        stream = self._fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def set(self, value: dict, instead_of: dict | None) -> None:
        """Replaces the file, which must still hold what the writer began with. Writers are expected to take turns: the test finds one that
        didn't, but two renames within moments of each other can both pass it."""
        if self.get() != instead_of:
            raise Conflict(f"{self.folder}/{self.name} has changed")
        tmp = self._hp(f"{self.folder}/{self.name}.{uuid.uuid4().hex}")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        jvm = self.spark._jvm
        option = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        option[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), self._conf).rename(tmp, self._hp(f"{self.folder}/{self.name}"), option)


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.pointer = Pointer(spark, self.path, "CURRENT")

    def version(self) -> str | None:
        now = self.pointer.get()
        return now and now["version"]

    def read(self) -> DataFrame | None:
        now = self.pointer.get()
        return None if now is None else self._frame(now["files"])

    def written(self, stats: WriteStats) -> DataFrame:
        """The rows of one write."""
        return self.spark.read.parquet(f"{self.path}/{stats.version}")

    def _frame(self, files: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", len({f.rsplit("/", 1)[0] for f in files}) > 1).parquet(*files)

    def _written(self, df: DataFrame) -> tuple[str, list[str], int]:
        """A new version's name, files and number of rows."""
        version, seen = f"v-{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{version}")
        found = self.pointer._fs.listStatus(self.pointer._hp(f"{self.path}/{version}"))
        return version, sorted(str(f.getPath()) for f in found if f.getPath().getName().endswith(".parquet")), seen.get["n"]

    def overwrite(self, df: DataFrame) -> WriteStats:
        before = self.pointer.get()
        version, files, n = self._written(df)
        self.pointer.set({"version": version, "files": files}, before)
        return WriteStats(version, n)

    def append(self, df: DataFrame) -> WriteStats:
        before = self.pointer.get()
        version, files, n = self._written(df)
        self.pointer.set({"version": version, "files": [*(before["files"] if before else []), *files]}, before)
        return WriteStats(version, n)

    def upsert(self, df: DataFrame, keys: list[str]) -> WriteStats:
        """Rows whose key exists are replaced whole, others added; columns that are new in either side are null in the other's rows.
        A key that comes twice is an error, as two rows can't both replace one. The source is written once, to a stage that is deleted after."""
        before = self.pointer.get()
        stage = f"{self.path}/stage-{uuid.uuid4().hex}"
        df.write.parquet(stage)
        source = self.spark.read.parquet(stage)
        try:
            if not source.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
                raise DuplicateKeys(", ".join(keys))
            if before is None:
                return self.overwrite(source)
            same = lambda old: [old[k].eqNullSafe(source[k]) for k in keys]
            old = self._frame(before["files"]).select(*keys, F.col("_metadata.file_path").alias("_file"))
            touched = {r[0] for r in old.join(source.select(*keys), same(old), "left_semi").select("_file").distinct().collect()}  # names of files
            bare = lambda f: f.split(":", 1)[-1].lstrip("/")
            rewritten = [f for f in before["files"] if bare(f) in {bare(t) for t in touched}]
            new = source
            if rewritten:
                old = self._frame(rewritten)
                new = old.join(source.select(*keys), same(old), "left_anti").unionByName(source, allowMissingColumns=True)
            version, files, n = self._written(new)
            self.pointer.set({"version": version, "files": [*[f for f in before["files"] if f not in rewritten], *files]}, before)
            return WriteStats(version, n)
        finally:
            self.pointer._fs.delete(self.pointer._hp(stage), True)


def reconcile(df: DataFrame, schema, how: str) -> DataFrame:
    """df fitted to a table's schema: sync (the table takes df's columns), append (it takes new ones and keeps its own), fail."""
    names = {f.name for f in schema}
    new = [c for c in df.columns if c not in names]
    if how == "fail" and (new or names - set(df.columns)):
        raise ValueError(f"columns differ: {sorted(new)}, {sorted(names - set(df.columns))}")
    if how == "sync":
        return df
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in df.columns]
    return df.select("*", *missing)


class Watermarks:
    """High-water marks by pipeline: pipeline, last_ts, prior_ts. A mark never goes back."""

    SCHEMA = "pipeline string, last_ts timestamp_ntz, prior_ts timestamp_ntz"

    def __init__(self, table: Table):
        self.table = table

    def last(self, pipeline: str):
        df = self.table.read()
        row = None if df is None else df.filter(F.col("pipeline") == pipeline).select("last_ts").first()
        return row and row[0]

    def filter(self, df: DataFrame, ts: str, pipeline: str, lookback_days: int) -> DataFrame:
        """Rows from the mark less the lookback on, all on the first run. The bound is a literal, so that files are pruned by it."""
        last = self.last(pipeline)
        return df if last is None else df.filter(F.col(ts) >= F.lit(last).cast("timestamp_ntz") - F.expr(f"interval {lookback_days} days"))

    def advance(self, pipeline: str, df: DataFrame, ts: str) -> None:
        """After the data are written: to the greatest ts in df, if that is later."""
        newest = df.agg(F.max(ts)).first()[0]
        last = self.last(pipeline)
        if newest is None:
            return
        row = [(pipeline, newest if last is None else max(last, newest), last)]
        self.table.upsert(self.table.spark.createDataFrame(row, self.SCHEMA), ["pipeline"])


def reprocess(source: DataFrame, ts: str, start: str, end: str, build, target: Table, keys: list[str]) -> WriteStats:
    """Recomputes the rows of a half-open window and upserts them; marks stay as they are."""
    window = source.filter((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))
    return target.upsert(build(window), keys)


def beyond_lookback(df: DataFrame, ts: str, arrived: str, lookback_days: int) -> DataFrame:
    """How many rows arrived later than the lookback would have seen, by month: what an incremental run skips and reprocessing must fetch."""
    lag = F.datediff(F.to_date(arrived), F.to_date(ts))
    return df.filter(lag > lookback_days).groupBy(F.date_format(ts, "yyyy-MM").alias("period")).agg(F.count("*").alias("rows_beyond"))
