from datetime import datetime

from pyspark.sql import functions as F

from tidewright.operators import orphans as o
from tidewright.session import scratch

D = lambda d: datetime(2024, 1, d)


def test_reasons(spark, rows, monkeypatch):
    dim = spark.createDataFrame([("a", True, D(2), 1), (" A ", False, D(1), 1), ("b", None, D(1), 1), ("c", True, D(9), 1), (None, True, D(1), 1), (" ", True, D(1), 1), ("d", True, None, 1)], "id string, cur boolean, seen timestamp_ntz, key int")
    index = o.parent_index(dim, "id", "cur", "seen")
    refs = spark.createDataFrame([(1, "A", D(1), 0), (2, "B ", D(5), 0), (3, "c", D(5), 0), (4, "zz", D(5), 0), (5, None, D(5), 0), (6, "  ", D(5), 0), (7, "d", D(5), 0), (8, "c", None, 0), (9, "c", D(9), 0), (4, "zz", D(5), 0)], "rid long, ref string, at timestamp_ntz, row_id int")
    want = sorted([(2, "deleted"), (3, "late"), (4, "missing"), (4, "missing")], key=repr)
    long = lambda df: o.references_of(df.drop("row_id"), "t", "rid", "at", ["ref"])
    index = index.withColumn("field", F.lit("ref"))
    for small, least in ((o.SMALL, o.HOT_LEAST), (0, o.HOT_LEAST), (0, 1)):  # by broadcast, by shuffle, by shuffle with all keys hot
        monkeypatch.setattr(o, "SMALL", small)
        monkeypatch.setattr(o, "HOT_LEAST", least)
        monkeypatch.setattr(o, "HOT_SHARE", 10**9 if least == 1 else 10_000)
        assert rows(o.probe(long(refs), index).filter("reason is not null").select("row_id", "reason")) == want
        assert rows(o.probe(long(refs.limit(0)), index)) == []
        assert len(rows(o.probe(long(refs), index.limit(0)).filter("reason is not null"))) == 8
    led = o.OrphanLedger(spark, scratch(spark, "ledger"))
    events = o.parent_events(dim, "ref", "id", "cur", "seen").withColumn("seq", F.lit(0))
    assert rows(led.advance(long(refs), events).select("row_id", "reason")) == sorted(set(want), key=repr)


def test_ledger_resolves_and_reopens(spark, rows):
    led = o.OrphanLedger(spark, scratch(spark, "ledger"))
    refs = lambda x: spark.createDataFrame(x, "table_name string, row_id long, field string, key string, at timestamp_ntz")
    parents = lambda x: spark.createDataFrame(x, "field string, key string, current boolean, arrived timestamp_ntz, seq long")
    p = led.advance(refs([("t", 1, "f", "a", D(1)), ("t", 2, "f", "b", D(5)), ("t", 2, "f", "b", D(5)), ("t", 3, "f", None, D(1))]), parents([("f", "b", True, D(2), 1)]))
    assert rows(p.select("row_id", "reason")) == [(1, "missing")]
    p = led.advance(refs([]), parents([("f", "A", True, D(1), 2)]))  # the parent arrives
    assert rows(p.select("row_id", "reason")) == []
    p = led.advance(refs([("t", 4, "f", "b", D(1))]), parents([("f", "a", False, D(9), 3)]))  # and is deleted
    assert rows(p.select("row_id", "reason")) == [(1, "deleted"), (4, "late")]
    assert rows(o.snapshot(p)) == [("t", "2024-01", "f", "deleted", 1), ("t", "2024-01", "f", "late", 1)]
    p = led.advance(refs([]), parents([("f", "a", True, D(10), 4)]))
    assert rows(p.select("row_id", "reason")) == [(4, "late")]


def test_ledger_goes_on_after_a_restart(spark, rows, monkeypatch):
    path = scratch(spark, "ledger")
    refs = lambda *x: spark.createDataFrame([("t", i, "f", k, D(5)) for i, k in x], "table_name string, row_id long, field string, key string, at timestamp_ntz")
    none = spark.createDataFrame([], "field string, key string, current boolean, arrived timestamp_ntz, seq long")
    o.OrphanLedger(spark, path).advance(refs((1, "a"), (2, "b")), none)
    p = o.OrphanLedger(spark, path).advance(refs((3, "c")), none)
    assert rows(p.select("row_id")) == [(1,), (2,), (3,)]
    monkeypatch.setattr(o, "MERGED", 3)
    events = spark.createDataFrame([("f", "b", True, D(1), 1)], none.schema)
    p = o.OrphanLedger(spark, path).advance(refs((4, "b")), events)
    assert rows(p.select("row_id")) == [(1,), (3,)] and len(o.OrphanLedger(spark, path)._segments()) == 1
    gone = spark.createDataFrame([("f", "b", False, D(9), 2)], none.schema)
    p = o.OrphanLedger(spark, path).advance(refs(), gone)
    assert rows(p.select("row_id", "reason")) == [(1, "missing"), (2, "deleted"), (3, "missing"), (4, "deleted")]


def test_batches_in_any_split(spark, rows):
    import random

    r = random.Random(3)
    dim = [(f"k{r.randint(0, 12)}", r.random() < 0.3, D(r.randint(1, 28))) for _ in range(40)]
    some = [(i, r.choice([f"k{r.randint(0, 15)}", " K1 ", None, ""]), D(r.randint(1, 28))) for i in range(200)]
    refs = spark.createDataFrame([("t", i, "f", k, a) for i, k, a in some], "table_name string, row_id long, field string, key string, at timestamp_ntz")
    parents = spark.createDataFrame(dim, "id string, cur boolean, seen timestamp_ntz")
    out = []
    for edges in ([], [D(10)], [D(4), D(9), D(20)]):
        led = o.OrphanLedger(spark, scratch(spark, "ledger"))
        for seq, (a, b) in enumerate(zip([None, *edges], [*edges, None])):
            part = refs.filter((F.col("at") > F.lit(a) if a else F.lit(True)) & (F.col("at") <= F.lit(b) if b else F.lit(True)))
            p = led.advance(part, o.parent_events(parents, "f", "id", "cur", "seen", a, b).withColumn("seq", F.lit(seq)))
        out.append(rows(p.select("row_id", "key", "reason")))
    assert out[0] == out[1] == out[2] and len({x[2] for x in out[0]}) == 3
