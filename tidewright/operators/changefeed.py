"""Current state from a feed of inserts, updates and deletes that arrive repeated and out of order.

A signed multiset of images. The changes of a batch are deduplicated; each that takes hold contributes its after-image once (+1), and takes the
before-image, which the base holds now, away once (-1). What a batch adds to the base are these signed rows and nothing else: base and signed rows are
united, multiplicities are summed, and rows with a positive sum are kept. A second multiplicity says whether an image is in force: a change that
ends an entity takes its images out of force without forgetting them, as one that arrives later may put them back.

Sums don't depend on how the feed is split into batches, and all are pre-aggregated before their shuffle, so that neither a hot entity nor
a change delivered a million times reaches one task as rows."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.expr import norm_id
from tidewright.session import cut, dropped, scratch, together
from tidewright.sources.tables import Pointer

HOT_LEAST, HOT_SHARE, SALTS = 10_000, 10_000, 64
MERGED = 8  # segments of a base from which they are merged into one
COLUMNS = ["entity", "row", "version", "ts", "ends", "ord"]


def compact(changes: DataFrame) -> DataFrame:
    """The deduplicated changes: repeats (same entity, row, version, ts and kind) collapse onto the smallest order number.

    Columns in and out: entity, row string, version int, ts timestamp, ends boolean, ord long. Of the changes of one row in
    one version only the last is kept (the images of those before it would be taken away again); of the changes that end
    an entity or carry no row, only the last of each version, as the entity's clock. compact(compact(a) + b) = compact(a + b)."""
    kept = F.max(F.struct("ts", (-F.col("ord")).alias("neg")))
    return (
        changes.filter(F.col("entity").isNotNull())
        .select("entity", F.when(~F.col("ends"), F.col("row")).alias("row"), F.coalesce("version", F.lit(0)).alias("version"), "ts", "ends", "ord")
        .groupBy("entity", "row", "version", "ends")
        .agg(kept.alias("k"))
        .select("entity", "row", "version", F.col("k.ts").alias("ts"), "ends", (-F.col("k.neg")).alias("ord"))
    )


def with_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """rows with the head of their entity. heads: entity, head, n (rows of the entity). An entity with more than one in HOT_SHARE of all rows is hot, so
    there are fewer than HOT_SHARE such entities, however large the feed; their rows are spread over SALTS tasks and their head is repeated as often."""
    limit = max(HOT_LEAST, rows.count() // HOT_SHARE)
    hot = F.col("n") > limit
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = rows.join(F.broadcast(heads.filter(hot).select("entity", F.lit(True).alias("_hot"))), "entity", "left").withColumn("_salt", salt)
    spread = heads.select("entity", "head", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("_salt"))
    return salted.join(spread, ["entity", "_salt"]).drop("_salt", "_hot")


class ChangeLog:
    """The base of a feed in a shared folder: signed images, and the head of each entity (its highest version with the latest ts there, and whether
    that ends it). A batch adds a segment of each, visible by one rename of the manifest; MERGED segments are merged into one. Batches may be
    repeated and come in any order."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.pointer = Pointer(spark, self.path, "MANIFEST")

    def _read(self, names: list[str], kind: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{n}/{kind}" for n in names])

    def images(self, names: list[str]) -> DataFrame:
        """The images that the base holds: entity, row, version, ts, ord, and whether they are in force."""
        summed = self._read(names, "images").groupBy("entity", "row", "version", "ts", "ord").agg(F.sum("n").alias("n"), F.sum("shown").alias("shown"))
        return summed.filter("n > 0").select("entity", "row", "version", "ts", "ord", (F.col("shown") > 0).alias("shown"))

    def heads(self, names: list[str]) -> DataFrame:
        return self._read(names, "heads").groupBy("entity").agg(F.max("head").alias("head"))

    def advance(self, batch: DataFrame) -> DataFrame:
        """Takes a batch of changes (see apply_changes) and returns the rows in force after it."""
        before = self.pointer.get()
        names = before["segments"] if before else []
        changes = cut(compact(batch.select(*COLUMNS)), "changes")
        written = F.col("row").isNotNull()
        image = lambda shown: F.struct("version", "ts", (-F.col("ord")).alias("neg"), shown.alias("shown"))
        new = changes.filter(written).select("entity", "row", image(F.lit(False)).alias("image"), F.lit(True).alias("is_new"))
        heads = changes.select("entity", F.struct("version", "ts", "ends").alias("head"))
        if names:
            touched = changes.select("entity").distinct()
            held = self.images(names).join(touched, "entity", "left_semi").select("entity", "row", image(F.col("shown")).alias("image"), F.lit(False).alias("is_new"))
            new = new.unionByName(held)
            heads = heads.unionByName(self._read(names, "heads").select("entity", "head").join(touched, "entity", "left_semi"))
        pick = lambda which: F.max(F.when(F.col("is_new") == which, F.col("image")))
        chains = cut(new.groupBy("entity", "row").agg(pick(False).alias("before"), pick(True).alias("after")), "chains")
        segment = f"s-{uuid.uuid4().hex}"
        own, of_entity = chains.groupBy("entity").agg(F.count("*").alias("n")), heads.groupBy("entity").agg(F.max("head").alias("head"))
        of_entity.join(own, "entity", "left").withColumn("n", F.coalesce("n", F.lit(0))).write.parquet(f"{self.path}/{segment}/heads")
        self._signed(with_heads(chains, self._read([segment], "heads"))).write.parquet(f"{self.path}/{segment}/images")
        names = [*names, segment]
        if len(names) >= MERGED:
            names = [self._merged(names)]
        self.pointer.set({"segments": names}, before)
        dropped(changes, chains)
        return self.current()

    @staticmethod
    def _signed(chains: DataFrame) -> DataFrame:
        """What a batch adds to the base: for every row that it changes the image that the base holds, taken away, and the one that takes hold."""
        current = lambda c: F.col(f"{c}.version") == F.col("head.version")
        last = F.greatest(F.when(current("before"), F.struct("before.version", "before.ts", "before.neg")), F.when(current("after"), F.struct("after.version", "after.ts", "after.neg")))
        after = last.isNotNull()
        row = lambda im, n, shown: F.struct(im["version"].alias("version"), im["ts"].alias("ts"), (-im["neg"]).alias("ord"), n.alias("n"), shown.alias("shown"))
        was = lambda c: F.when(c, 1).otherwise(0)
        minus = F.when(F.col("before").isNotNull(), row(F.col("before"), F.lit(-1), -was(F.col("before.shown"))))
        plus = F.when(after, row(F.col("last"), F.lit(1), was(~F.col("head.ends"))))
        both = chains.withColumn("last", last).select("entity", "row", "before", "last", F.array_compact(F.array(minus, plus)).alias("signed"), "head")
        same = F.col("before").isNotNull() & F.col("last").isNotNull() & (F.col("before.ts").eqNullSafe(F.col("last.ts"))) & (F.col("before.neg") == F.col("last.neg")) & (F.col("before.version") == F.col("last.version")) & (F.col("before.shown") == ~F.col("head.ends"))
        return both.filter(~F.coalesce(same, F.lit(False))).select("entity", "row", F.inline("signed"))

    def _merged(self, names: list[str]) -> str:
        one = f"s-{uuid.uuid4().hex}"
        images = self.images(names).select("entity", "row", "version", "ts", "ord", F.lit(1).alias("n"), F.col("shown").cast("int").alias("shown"))
        heads = self.heads(names).withColumn("n", F.lit(0).cast("long"))
        together(self.spark, lambda: images.write.parquet(f"{self.path}/{one}/images"), lambda: heads.write.parquet(f"{self.path}/{one}/heads"))
        return one

    def current(self) -> DataFrame:
        """The rows in force: entity, row, version, ord."""
        names = self.pointer.get()["segments"]
        return self.images(names).filter("shown").select("entity", "row", "version", "ord")


def apply_changes(changes: DataFrame, base: DataFrame | None = None, batches: Column | None = None, parts: int = 1) -> DataFrame:
    """The rows in force after all changes: entity, row, version, ord.

    changes, and base if given (changes of earlier runs, as they came or a result of compact()), have entity, row string, version int, ts
    timestamp, ends boolean, ord long. For each entity only its highest version counts (null is 0). If at the latest ts of that
    version (null is earliest) any change ends the entity, it has no rows. Else each row written in that version is in force, by its
    latest ts, then smallest ord. Rows without an entity are left out; changes without a row write none but move the entity's
    clock. An empty feed gives no rows; repeated rows count once; further columns are ignored.

    batches numbers the batch of a change from 0 to parts - 1; they are applied one after another, each against what the base holds then. The
    result is the same for any split."""
    log = ChangeLog(changes.sparkSession, scratch(changes.sparkSession, "log"))
    feeds = [] if base is None else [base]
    feeds += [changes] if batches is None else [changes.filter(batches == k) for k in range(parts)]
    return reduce(lambda _, batch: log.advance(batch), feeds, None)


def flagged_codes(table: DataFrame, code: str, flags: list[str]) -> DataFrame:
    """The normalized codes (column code) that have any of the flags set; a null flag counts as false, a null or blank code is none."""
    any_flag = F.lit(False)
    for f in flags:
        any_flag = any_flag | F.coalesce(F.col(f), F.lit(False))
    return table.filter(any_flag).select(norm_id(code).alias("code")).filter("code is not null").distinct()
