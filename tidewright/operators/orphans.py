"""References whose target is missing, deleted, or arrived later than they did.

A parent index holds one row per key: whether it has a current row, and when it first arrived. References probe it; those without a
valid target are pending orphans. OrphanLedger keeps index, references and orphans across batches: arriving parents resolve waiting
orphans, deletions reopen them, and each batch can end with a snapshot of the counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.expr import norm_id
from tidewright.session import together
from tidewright.sources.tables import Pointer

SALTS = 8
SMALL = 20_000  # keys of a field whose index may be broadcast
HOT_LEAST, HOT_SHARE = 10_000, 10_000
MERGED = 8  # segments of a ledger from which they are merged into one


def parent_index(parents: DataFrame, key: str, current: str, arrived: str) -> DataFrame:
    """One row per id: key, has_current, first_seen. Null and blank ids are left out, a null flag counts as false; ids in
    several spellings are one. Pre-aggregated before the shuffle."""
    return (
        parents.select(norm_id(key).alias("key"), F.coalesce(F.col(current), F.lit(False)).alias("c"), F.col(arrived).alias("a"))
        .filter("key is not null")
        .groupBy("key")
        .agg(F.max("c").alias("has_current"), F.min("a").alias("first_seen"))
    )


def verdict(key: Column, found: Column, has_current: Column, first_seen: Column, at: Column) -> Column:
    """missing, deleted, late or null; null also where there is no id. With a null arrival on either side a reference isn't late."""
    return F.when(key.isNull(), None).when(found.isNull(), "missing").when(~has_current, "deleted").when(first_seen > at, "late")


def snapshot(orphans: DataFrame) -> DataFrame:
    """Counts by table, period, field and reason."""
    return orphans.groupBy("table_name", "period", "field", "reason").agg(F.count("*").alias("orphans"))


class OrphanLedger:
    """Pending-orphan state by key, in a shared folder that outlives the driver.

    A batch brings references (table_name, row_id, field, key, at) and parent events (field, key, current boolean, arrived timestamp,
    seq long): the newest event by seq says whether the key has a valid row, the earliest arrival since when there is one. New references probe
    the parent index; references of the keys whose events a batch brings are looked up and probed again, so that parents resolve
    what waits for them and deletions reopen it.

    Each batch writes a segment of references, index and pending orphans; for the keys in its index it overrules what older segments hold
    pending. MERGED segments are merged into one. The manifest that names the segments is replaced by one rename, so a batch counts
    as a whole or not at all, and a ledger on the same path goes on where the last one ended."""

    INDEX = "field string, key string, has_current boolean, first_seen timestamp_ntz, seq long, batch long"
    REFS = "table_name string, row_id long, field string, key string, at timestamp_ntz"
    PENDING = REFS + ", reason string, batch long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.pointer = Pointer(spark, self.path, "MANIFEST")

    def _segments(self) -> list[str]:
        now = self.pointer.get()
        return now["segments"] if now else []

    def _read(self, names: list[str], kind: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}/{kind}" for n in names]) if names else self.spark.createDataFrame([], schema)

    def index(self, names: list[str] | None = None, more: DataFrame | None = None) -> DataFrame:
        """One row per field and key: whether it has a valid row, since when, and the number of its newest event."""
        rows = self._read(self._segments() if names is None else names, "index", self.INDEX).drop("batch")
        newest = F.max(F.struct("seq", "has_current"))
        rows = rows if more is None else rows.unionByName(more)
        return rows.groupBy("field", "key").agg(newest.alias("n"), F.min("first_seen").alias("first_seen")).select("field", "key", "n.has_current", "first_seen", "n.seq")

    def advance(self, references: DataFrame, parents: DataFrame) -> DataFrame:
        """Applies one batch and returns the pending orphans after it. References without a key are none; of repeated ones (same table, row and
        field) in a batch one pending row is kept. Further columns are ignored."""
        before = self.pointer.get()
        names, batch = self._segments(), (before["batch"] + 1 if before else 0)
        at = f"{self.path}/s-{uuid.uuid4().hex}"
        fresh = references.select("table_name", F.col("row_id").cast("long").alias("row_id"), "field", norm_id("key").alias("key"), F.col("at").cast("timestamp_ntz").alias("at")).filter("key is not null")
        events = parents.select("field", norm_id("key").alias("key"), F.coalesce("current", F.lit(False)).alias("has_current"), F.col("arrived").cast("timestamp_ntz").alias("first_seen"), F.col("seq").cast("long").alias("seq")).filter("key is not null")
        indexed = self.index([], events).withColumn("batch", F.lit(batch).cast("long"))
        together(self.spark, lambda: fresh.write.parquet(f"{at}/refs"), lambda: indexed.write.parquet(f"{at}/index"))
        fresh, events = (self.spark.read.schema(s).parquet(f"{at}/{n}") for n, s in (("refs", self.REFS), ("index", self.INDEX)))
        judged = fresh
        if names:
            judged = fresh.unionByName(self._read(names, "refs", self.REFS).join(events.select("field", "key"), ["field", "key"], "left_semi"))
        index = self.index([*names, at.rsplit("/", 1)[1]])
        found = probe(judged, index).filter("reason is not null").dropDuplicates(["table_name", "row_id", "field"]).withColumn("batch", F.lit(batch).cast("long"))
        found.select("table_name", "row_id", "field", "key", "at", "reason", "batch").write.parquet(f"{at}/pending")
        names = [*names, at.rsplit("/", 1)[1]]
        if len(names) >= MERGED:
            names = [self._merged(names)]
        self.pointer.set({"segments": names, "batch": batch}, before)
        return self.pending()

    def _merged(self, names: list[str]) -> str:
        one = f"s-{uuid.uuid4().hex}"
        parts = {"refs": self._read(names, "refs", self.REFS), "index": self.index(names).withColumn("batch", F.lit(-1).cast("long")), "pending": self._pending(names)}
        together(self.spark, *[lambda n=n, df=df: df.write.parquet(f"{self.path}/{one}/{n}") for n, df in parts.items()])
        return one

    def _pending(self, names: list[str]) -> DataFrame:
        rows = self._read(names, "pending", self.PENDING)
        if len(names) > 1:
            since = self._read(names, "index", self.INDEX).groupBy("field", "key").agg(F.max("batch").alias("_since"))
            rows = rows.join(since, ["field", "key"], "left").filter("_since is null or batch >= _since").drop("_since")
        return rows.select("table_name", "row_id", "field", "key", "at", "reason", "batch")

    def pending(self) -> DataFrame:
        return self._pending(self._segments()).drop("batch").withColumn("period", F.date_format("at", "yyyy-MM"))


def probe(references: DataFrame, index: DataFrame) -> DataFrame:
    """references with the reason why their target isn't valid, or null. Fields whose index is proven to be small are looked up by broadcast. The others
    are joined by shuffle; a key with more than one in HOT_SHARE of the references is hot, so there are fewer than HOT_SHARE of them: its
    references are spread over tasks in proportion to their number, and its index row is repeated as often."""
    counts = {r[0]: r[1] for r in index.groupBy("field").count().collect()}  # a row per field
    small = [f for f, n in counts.items() if n <= SMALL]
    side = index.select("field", "key", F.lit(True).alias("_found"), "has_current", "first_seen")
    judged = verdict(F.col("key"), F.col("_found"), F.col("has_current"), F.col("first_seen"), F.col("at"))
    cols = ["table_name", "row_id", "field", "key", "at"]
    out = references.filter(F.col("field").isin(small)).join(F.broadcast(side.filter(F.col("field").isin(small))), ["field", "key"], "left").select(*cols, judged.alias("reason"))
    rest = references.filter(~F.col("field").isin(small))
    large = side.filter(~F.col("field").isin(small))
    limit = max(HOT_LEAST, rest.count() // HOT_SHARE)
    hot = F.broadcast(rest.groupBy("field", "key").count().filter(F.col("count") > limit).select("field", "key", F.ceil(F.col("count") / limit).cast("int").alias("_salts")))
    salted = rest.join(hot, ["field", "key"], "left").withColumn("_salt", F.pmod(F.xxhash64("row_id"), F.coalesce("_salts", F.lit(1))).cast("int"))
    spread = large.join(hot, ["field", "key"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return out.unionByName(salted.join(spread, ["field", "key", "_salt"], "left").select(*cols, judged.alias("reason")))


def parent_events(parents: DataFrame, field: str, key: str, current: str, arrived: str, since=None, until=None) -> DataFrame:
    """What a dimension says of its keys by the moment `until`: events for the keys of which a row arrived after `since`, and until then (null arrivals
    count as earliest). current is whether any row so far is; arrived is the earliest arrival."""
    rows = parents.select(norm_id(key).alias("key"), F.coalesce(F.col(current), F.lit(False)).alias("c"), F.col(arrived).alias("a")).filter("key is not null")
    if until is not None:
        rows = rows.filter(F.col("a").isNull() | (F.col("a") <= F.lit(until)))
    out = rows.groupBy("key").agg(F.max("c").alias("current"), F.min("a").alias("arrived"), F.max("a").alias("_last"))
    if since is not None:
        out = out.filter(F.col("_last") > F.lit(since))
    return out.select(F.lit(field).alias("field"), "key", "current", "arrived")


def references_of(rows: DataFrame, table_name: str, row_id: str, at: str, fields: list[str]) -> DataFrame:
    """One row per row and field with an id: table_name, row_id, field, key, at."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), norm_id(f).alias("key")) for f in fields])
    return rows.select(F.lit(table_name).alias("table_name"), F.col(row_id).alias("row_id"), F.col(at).alias("at"), F.inline(F.filter(pairs, lambda x: x.key.isNotNull())))
