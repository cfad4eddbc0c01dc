"""Exactly one copy of each message of an at-least-once feed.

Identities are dictionary-encoded exactly: an epoch writes a segment of the dictionary for the identities that it doesn't know, whose shards are the
partitions of the pre-aggregated identities and whose codes count from 0 within the shard, so codes are dense and take no sort. What has been
seen is a bitmap per shard and bucket of 32,768 codes, kept compressed, and the bitmaps alone say whether a message is new: an identity may be in the
dictionary without having been seen. An epoch selects one arrival for each bit that isn't set, and becomes visible with its new bits by one
rename of the manifest; until then, and if the job dies, nothing has happened."""

from __future__ import annotations

import uuid
import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidewright.session import scratch, ship
from tidewright.sources.tables import Pointer

SHARD_BITS = 33  # monotonically_increasing_id holds the partition above and the row below this bit
MERGED = 8  # dictionary segments from which they are written as one
REPLAYED = 64  # latest epochs whose result can be asked for again


def _deflate(maps: pd.Series) -> pd.Series:
    return maps.map(lambda b: None if b is None else zlib.compress(bytes(b), 1))


def _inflate(maps: pd.Series) -> pd.Series:
    return maps.map(lambda b: None if b is None else zlib.decompress(bytes(b)))


class SeenStore:
    """Dictionary segments and seen-bitmaps in a shared folder.

    MANIFEST names the files that count. It is replaced by one rename, so a reader sees the state before or after an epoch; files that
    no manifest names are left-overs of epochs that failed and are never read."""

    def __init__(self, spark: SparkSession, path: str):
        ship(spark)
        self.spark, self.path = spark, path.rstrip("/")
        self.pointer = Pointer(spark, self.path, "MANIFEST")

    def manifest(self) -> dict:
        return self.pointer.get() or {"segments": [], "bitmaps": None, "epochs": []}

    def _publish(self, manifest: dict, before: dict | None) -> None:
        self.pointer.set(manifest, before)

    def seen(self) -> DataFrame | None:
        """segment string, shard int, bucket long, bits binary (inflated); None before the first epoch."""
        at = self.manifest()["bitmaps"]
        if at is None:
            return None
        return self.spark.read.parquet(at).withColumn("bits", pandas_udf(_inflate, "binary")("bits"))

    def _write_bits(self, bits: DataFrame, name: str) -> str:
        at = f"{self.path}/bits-{name}"
        bits.withColumn("bits", pandas_udf(_deflate, "binary")("bits")).write.parquet(at)
        return at

    def accept(self, arrivals: DataFrame, identity: list[str], order: list, arrival: str, epoch: str) -> DataFrame:
        """The arrivals to keep, one row for each identity not seen before: the identity's columns and the arrival's id.

        Of several arrivals of one identity the least by `order`, then by the arrival's id, is kept. Null is a value of its own in
        each identity column. An epoch applied before gives what it gave then (of those before the last REPLAYED ones: nothing, as all its bits
        are set) and changes nothing. arrivals may be empty and may have further columns, which are ignored."""
        before = self.pointer.get()
        state = self.manifest()
        done = {e["epoch"]: e["stage"] for e in state["epochs"]}
        if epoch in done:
            return self._kept(done[epoch], identity, arrival)
        ids = [f"i{n}" for n in range(len(identity))]
        named = arrivals.select(*[F.col(c).alias(i) for c, i in zip(identity, ids)], F.struct(*[o.alias(f"o{n}") for n, o in enumerate(order)], F.col(arrival).alias("arrival")).alias("best"))
        best = named.groupBy(*ids).agg(F.min("best").alias("best")).select(*ids, "best.arrival")
        segment = f"s{len(state['epochs'])}-{uuid.uuid4().hex[:8]}"
        dictionary = f"{self.path}/dict-{segment}"
        stage = [dictionary]
        known = None
        if state["segments"]:
            entries = self.spark.read.parquet(*state["segments"])
            same = reduce(lambda a, b: a & b, [F.col(f"b.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ids])
            found = best.alias("b").join(entries.alias("k"), same, "left").select(*[F.col(f"b.{c}") for c in ids], "b.arrival", "segment", "shard", "code")
            found.write.parquet(f"{self.path}/found-{segment}")
            found = self.spark.read.parquet(f"{self.path}/found-{segment}")
            best, known = found.filter("code is null").select(*ids, "arrival"), found.filter("code is not null")
        spot = F.monotonically_increasing_id()
        fresh = best.select(*ids, "arrival", F.lit(segment).alias("segment"), spot.alias("spot"))  # counts fresh rows only, so codes are dense
        fresh.select(*ids, "arrival", "segment", F.shiftright("spot", SHARD_BITS).cast("int").alias("shard"), F.col("spot").bitwiseAND(F.lit((1 << SHARD_BITS) - 1)).alias("code")).write.parquet(dictionary)
        coded = self.spark.read.parquet(dictionary)
        bucket, position = F.bitmap_bucket_number(F.col("code") + 1), F.bitmap_bit_position(F.col("code") + 1)
        bits = self.seen()
        if known is not None:  # fresh codes are in no bitmap, and take no part in this join
            tested = known.withColumn("bucket", bucket).join(bits, ["segment", "shard", "bucket"], "left").withColumn("at", position)
            byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            seen = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.pmod("at", F.lit(8))).cast("int")) > 0, F.lit(False))
            stage.append(f"{self.path}/again-{segment}")  # in the dictionary, but not seen
            tested.filter(~seen).select(*coded.columns).write.parquet(stage[1])
        staged = self.spark.read.schema(coded.schema).parquet(*stage)
        now = staged.groupBy("segment", "shard", bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bits"))
        if bits is not None:
            now = now.unionByName(bits).groupBy("segment", "shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        at = self._write_bits(now, segment)
        segments = [*state["segments"], dictionary]
        if len(segments) >= MERGED:
            one = f"{self.path}/dict-all-{segment}"
            self.spark.read.parquet(*segments).drop("arrival").write.parquet(one)
            segments = [one]
        epochs = [*state["epochs"], {"epoch": epoch, "stage": stage}]
        self._publish({"segments": segments, "bitmaps": at, "epochs": [e if k >= len(epochs) - REPLAYED else e | {"stage": None} for k, e in enumerate(epochs)]}, before)
        if known is not None:
            self._delete(f"{self.path}/found-{segment}")
        for e in state["epochs"][: max(0, len(epochs) - REPLAYED)]:
            for path in e["stage"] or []:
                if path not in segments:
                    self._delete(path)
        held = {path for e in epochs[-REPLAYED:] for path in e["stage"] or []}
        for path in state["segments"]:
            if path not in segments and path not in held:
                self._delete(path)
        return self._kept(stage, identity, arrival)

    def _delete(self, path: str) -> None:
        self.pointer._fs.delete(self.pointer._hp(path), True)

    def _kept(self, stage: list[str] | None, identity: list[str], arrival: str) -> DataFrame:
        rows = self.spark.read.parquet(*(stage or self.manifest()["epochs"][-1]["stage"]))
        return (rows if stage else rows.limit(0)).select(*[F.col(f"i{n}").alias(c) for n, c in enumerate(identity)], F.col("arrival").alias(arrival))


def surplus(arrivals: DataFrame, identity: list[str], order: list, arrival: str, store: SeenStore | None = None, epoch: str = "all", rank: Column | None = None, parts: int = 1) -> DataFrame:
    """The ids of the arrivals that are not kept (see SeenStore.accept).

    rank numbers the epoch of an arrival from 0 to parts - 1; the epochs are accepted in turn, and what an earlier one kept is surplus in a later
    one. By `order` every arrival of an epoch must come before those of the next, so that the copies kept are the least over all."""
    store = store or SeenStore(arrivals.sparkSession, scratch(arrivals.sparkSession, "seen"))
    epochs = [(epoch, arrivals)] if rank is None else [(f"{epoch}-{k}", arrivals.filter(rank == k)) for k in range(parts)]
    kept = [store.accept(some, identity, order, arrival, name).select(arrival) for name, some in epochs]
    return arrivals.select(arrival).join(reduce(DataFrame.unionByName, kept), arrival, "left_anti")
