import pytest
from pyspark.sql import functions as F

from tidewright.operators.delivery import SeenStore, surplus
from tidewright.session import scratch


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, at int, id string, code int, segment string")


def test_one_arrival_per_message_across_epochs(spark, rows):
    store = SeenStore(spark, scratch(spark, "seen"))
    first = frame(spark, [("a", 1, 5, "x1", 0, ""), ("a", 1, 9, "x2", 0, ""), ("a", None, 1, "x3", 0, ""), (None, None, 1, "x4", 0, ""), (None, None, 1, "x0", 0, "")])
    order = [-F.col("at")]
    assert rows(store.accept(first, ["k", "v"], order, "id", "e1").select("id")) == [("x0",), ("x2",), ("x3",)]
    second = frame(spark, [("a", 1, 99, "y1", 0, ""), ("b", 1, 1, "y2", 0, ""), (None, None, 7, "y3", 0, ""), ("b", 1, 1, "y1b", 0, "")])
    assert rows(store.accept(second, ["k", "v"], order, "id", "e2").select("id")) == [("y1b",)]
    assert rows(store.accept(second, ["k", "v"], order, "id", "e2").select("id")) == [("y1b",)]  # the epoch applied again
    assert len(store.manifest()["epochs"]) == 2
    assert store.seen().selectExpr("sum(bitmap_count(bits))").first()[0] == 4
    assert rows(store.accept(second, ["k", "v"], order, "id", "e3")) == []


def test_an_epoch_that_dies_before_the_rename_leaves_no_trace(spark, rows, monkeypatch):
    store = SeenStore(spark, scratch(spark, "seen"))
    arrivals = frame(spark, [("a", 1, 5, "x1", 0, "")])
    with monkeypatch.context() as m:
        m.setattr(SeenStore, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.accept(arrivals, ["k", "v"], [F.col("at")], "id", "e1")
    assert store.manifest()["epochs"] == [] and store.seen() is None
    assert rows(store.accept(arrivals, ["k", "v"], [F.col("at")], "id", "e1").select("id")) == [("x1",)]


def test_the_bitmap_decides(spark, rows):
    """An identity whose bit is cleared is new again, though the dictionary has it; one whose bit is set isn't."""
    store = SeenStore(spark, scratch(spark, "seen"))
    first = frame(spark, [("a", 1, 5, "x1", 0, ""), ("b", 1, 5, "x2", 0, "")])
    store.accept(first, ["k", "v"], [F.col("at")], "id", "e1")
    code = {r.i0: (r.segment, r.shard, r.code) for r in spark.read.parquet(*store.manifest()["segments"]).collect()}
    bits = [(r.segment, r.shard, r.bucket, bytes(b ^ (1 << r2 % 8) if i == r2 // 8 else b for i, b in enumerate(r.bits))) for r in store.seen().collect() for r2 in [code["a"][2]] if (r.segment, r.shard) == code["a"][:2]]
    kept = [tuple(r) for r in store.seen().collect() if (r.segment, r.shard) != code["a"][:2]]
    before = store.manifest()
    at = store._write_bits(spark.createDataFrame(bits + [(a, b, c, bytes(d)) for a, b, c, d in kept], store.seen().schema), "flipped")
    store._publish(before | {"bitmaps": at}, before)
    second = frame(spark, [("a", 1, 9, "y1", 0, ""), ("b", 1, 9, "y2", 0, "")])
    assert rows(store.accept(second, ["k", "v"], [F.col("at")], "id", "e2").select("id")) == [("y1",)]
    assert rows(store.accept(second, ["k", "v"], [F.col("at")], "id", "e3").select("id")) == []
    assert store.seen().selectExpr("sum(bitmap_count(bits))").first()[0] == 2


def test_fresh_ids_of_a_later_epoch_are_spread(spark):
    store = SeenStore(spark, scratch(spark, "seen"))
    ids = lambda a, b: spark.range(a, b).selectExpr("cast(id as string) as k", "1 as v", "1 as at", "cast(id as string) as id")
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in plain}
    for k, v in plain.items():
        spark.conf.set(k, v)
    try:
        store.accept(ids(0, 10_000), ["k", "v"], [F.col("at")], "id", "e1")
        store.accept(ids(0, 200_000), ["k", "v"], [F.col("at")], "id", "e2")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    last = spark.read.parquet(store.manifest()["segments"][-1])
    shards = {r.shard: (r.n, r.m) for r in last.groupBy("shard").agg(F.count("*").alias("n"), F.max("code").alias("m")).collect()}
    assert sum(n for n, _ in shards.values()) == 190_000 and len(shards) >= spark.sparkContext.defaultParallelism and max(n for n, _ in shards.values()) < 1.2 * 190_000 / len(shards)
    assert all(m == n - 1 for n, m in shards.values())  # codes are dense


def test_segments_are_merged_and_old_epochs_dropped(spark, rows, monkeypatch):
    from tidewright.operators import delivery

    monkeypatch.setattr(delivery, "MERGED", 3)
    monkeypatch.setattr(delivery, "REPLAYED", 2)
    store = SeenStore(spark, scratch(spark, "seen"))
    for k in range(5):
        some = frame(spark, [("a", 1, 5, f"x{k}", 0, ""), (f"b{k}", 1, 5, f"y{k}", 0, "")])
        got = rows(store.accept(some, ["k", "v"], [F.col("at")], "id", f"e{k}").select("id"))
        assert got == ([("x0",), ("y0",)] if k == 0 else [(f"y{k}",)])
    assert len(store.manifest()["segments"]) < 3
    assert rows(store.accept(some, ["k", "v"], [F.col("at")], "id", "e0")) == [] and rows(store.accept(some, ["k", "v"], [F.col("at")], "id", "e4").select("id")) == [("y4",)]


def test_copies_over_several_epochs(spark, rows):
    df = frame(spark, [(f"k{i % 7}", 1, i, f"a{i:02}", 0, "") for i in range(40)])
    got = rows(surplus(df, ["k", "v"], [F.col("at")], "id", rank=(F.col("at") / 14).cast("int"), parts=3))
    assert got == [(f"a{i:02}",) for i in range(7, 40)]


def test_many_codes_in_several_buckets(spark):
    store = SeenStore(spark, scratch(spark, "seen"))
    ids = spark.range(100_000).selectExpr("cast(id as string) as k", "1 as v", "1 as at", "cast(id as string) as id")
    assert store.accept(ids.repartition(2), ["k", "v"], [F.col("at")], "id", "e1").count() == 100_000
    more = spark.range(90_000, 120_000).selectExpr("cast(id as string) as k", "1 as v", "1 as at", "cast(id as string) as id")
    assert store.accept(more, ["k", "v"], [F.col("at")], "id", "e2").count() == 20_000
    assert store.seen().selectExpr("sum(bitmap_count(bits))").first()[0] == 120_000


def test_surplus_of_empty_and_of_copies(spark, rows):
    assert rows(surplus(frame(spark, []), ["k", "v"], [F.col("at")], "id")) == []
    copies = frame(spark, [("h", 1, 1, f"{i:03}", 0, "") for i in range(200)])
    assert len(rows(surplus(copies, ["k", "v"], [F.col("at")], "id"))) == 199
