import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.operators.fingertree import FingerTree
from tidewright.operators.lateness import MonthlyCounts, MonthLog, late_rows, monthly_counts
from tidewright.session import scratch
from tidewright.sources.tables import Table


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("aaaae"), st.integers(0, 400), st.integers(1, 9)), max_size=400))
def test_tree_against_a_dict(steps):
    tree, plain, edge = FingerTree(), {}, 0
    for what, t, n in steps:
        if what == "a":
            if t >= edge:
                tree.add(t, n)
                plain[t] = plain.get(t, 0) + n
        else:
            edge = max(edge, t // 2)
            tree.evict(edge)
            plain = {k: v for k, v in plain.items() if k >= edge}
    assert dict(tree.items()) == plain
    assert [k for k, _ in tree.items()] == sorted(plain)
    for lo, hi in ((0, 401), (50, 60), (100, 300), (7, 7), (399, 401)):
        assert tree.total(lo, hi) == sum(v for k, v in plain.items() if lo <= k < hi)


def test_tree_stays_balanced():
    tree = FingerTree()
    order = list(range(20_000))
    random.Random(1).shuffle(order)
    for t in order:
        tree.add(t, 1)
    depth, node = 0, tree.root
    while node.children is not None:
        depth, node = depth + 1, node.children[0]
    assert depth <= 4 and tree.root.total == 20_000
    assert tree.evict(15_000) < 200 and tree.root.total == 5_000


def end(d):
    return datetime(d.year + d.month // 12, d.month % 12 + 1, 1)


def brute(rows):
    out = []
    for i, b, a, s in rows:
        a = a or s
        if b is None or a is None:
            continue
        late = a - end(b)
        out.append((i, b.strftime("%Y-%m"), "too_late" if late >= timedelta(90) else "correction" if late >= timedelta(7) else "on_time"))
    return out


def test_rows_and_months(spark, rows):
    r = random.Random(5)
    base = datetime(2023, 1, 1)
    data = [(i, r.choice([None, *[base + timedelta(seconds=r.randint(0, 6 * 10**7))] * 9]), None if r.random() < 0.2 else base + timedelta(seconds=r.randint(0, 7 * 10**7)), None if r.random() < 0.2 else base + timedelta(seconds=r.randint(0, 7 * 10**7))) for i in range(1500)]
    data += [(9001, datetime(2023, 1, 31, 23, 59, 59, 999999), datetime(2023, 2, 8), None), (9002, datetime(2023, 1, 31), datetime(2023, 2, 7, 23, 59, 59, 999999), None), (9003, datetime(2023, 1, 1), datetime(2023, 5, 2), None), (9004, datetime(2023, 1, 1), datetime(2023, 5, 1, 23, 59, 59), None), (9005, datetime(1950, 5, 5), datetime(1951, 5, 5), None)]
    df = spark.createDataFrame(data, "id long, b timestamp_ntz, a timestamp_ntz, s timestamp_ntz").selectExpr("*", "'x' as key", "1 as e", "2 as outcome").repartition(3)
    want = brute(data)
    assert rows(late_rows(df, "id", "b", ["a", "s"])) == sorted(want, key=repr)
    c = Counter((p, o) for _, p, o in want)
    months = {p: (c[p, "on_time"], c[p, "correction"], c[p, "on_time"] + c[p, "correction"], c[p, "too_late"]) for p in {p for _, p, _ in want}}
    assert {r[0]: tuple(r[1:]) for r in monthly_counts(df, "b", ["a", "s"]).collect()} == months
    assert rows(late_rows(df.limit(0), "id", "b", ["a", "s"])) == [] and rows(monthly_counts(df.limit(0), "b", ["a", "s"])) == []


def test_the_tree_judges(spark, rows, monkeypatch):
    data = [(1, datetime(2023, 1, 5), datetime(2023, 1, 6), None), (2, datetime(2023, 1, 5), datetime(2023, 3, 1), None), (3, datetime(2023, 1, 5), datetime(2023, 9, 1), None)]
    df = spark.createDataFrame(data, "id long, b timestamp_ntz, a timestamp_ntz, s timestamp_ntz")
    shard = MonthlyCounts(7, 90)
    e, a = (np.array([r[c] for r in data], "datetime64[us]").astype(np.int64) for c in (1, 2))
    assert shard.arrive(e, a).tolist() == [0, 1, 2]
    monkeypatch.setattr(FingerTree, "report", lambda *_: None)  # without its edges the tree finds nothing late
    monkeypatch.setattr(FingerTree, "evict", lambda *_: 0)
    monkeypatch.setattr(FingerTree, "total", lambda *_: np.zeros(3, int))
    monkeypatch.setattr(MonthlyCounts, "_close", lambda *_: None)
    assert MonthlyCounts(7, 90).arrive(e, a).tolist() == [0, 0, 0]
    assert df.count() == 3


def test_months_over_several_batches(spark, rows):
    r = random.Random(8)
    base = datetime(2023, 1, 1)
    data = [(i, base + timedelta(days=r.randint(0, 300)), base + timedelta(days=r.randint(0, 500)), None) for i in range(600)]
    df = spark.createDataFrame(data, "id long, b timestamp_ntz, a timestamp_ntz, s timestamp_ntz")
    want = rows(monthly_counts(df, "b", ["a", "s"]))
    path = scratch(spark, "months")
    for k in (2, 0, 1):
        changes = MonthLog(Table(spark, path)).advance(df.filter(F.col("id") % 3 == k), "b", ["a", "s"])  # a new log on the same table
        assert changes.agg(F.sum(F.col("corrected") + F.col("too_late"))).first()[0] == 200
    assert rows(MonthLog(Table(spark, path)).months()) == want
