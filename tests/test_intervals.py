import random
from datetime import date, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewright.operators.intervals import IntervalMap, merge_intervals
from tidewright.streaming.feeds import merged_periods


def covered(spans):
    return {d for s, e in spans for d in range(s, e)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=40))
def test_map_keeps_days_and_disjointness(spans):
    m = IntervalMap()
    for s, e in spans:
        m.insert(s, e)
    out = list(zip(m.starts, m.ends))
    assert covered(out) == covered(spans)
    assert all(a[1] < b[0] for a, b in zip(out, out[1:]))
    assert list(m.gaps()) == [(a[1], b[0]) for a, b in zip(out, out[1:])]


D0 = date(2024, 1, 1)


def test_operator(spark, rows):
    r = random.Random(2)
    day = lambda i: D0 + timedelta(i)
    data = [(r.choice("abcde"), r.choice("xy"), day(a := r.randint(0, 500)), day(a + r.randint(-3, 30))) for _ in range(1200)]
    data += [("a", "z", day(3), None), ("a", "z", day(1), day(2)), ("b", "z", None, day(9)), (None, "z", day(1), day(2)), ("b", None, day(1), day(2)), ("c", "z", day(5), date(9999, 12, 31)), ("c", "z", day(9), None), ("d", "z", day(5), day(5)), ("d", "z", day(1), day(4)), ("d", "z", day(4), day(6))]
    df = spark.createDataFrame(data, "m string, p string, s date, e date").selectExpr("*", "'k' as kind", "1 as k0", "2 as start_date").repartition(4)
    want = []
    for k in {d[:2] for d in data if d[0] and d[1]}:
        m = IntervalMap()
        for d in data:
            if d[:2] == k and d[2]:
                m.insert(d[2].toordinal(), (d[3] or date(9999, 12, 31)).toordinal())
        name = lambda x: date.fromordinal(x).isoformat()
        want += [(*k, "period", name(s), name(e)) for s, e in zip(m.starts, m.ends)] + [(*k, "gap", name(s), name(e)) for s, e in m.gaps()]
    assert rows(merge_intervals(df, ["m", "p"], "s", "e")) == sorted(want, key=repr)
    assert rows(merge_intervals(df.limit(0), ["m", "p"], "s", "e")) == []


def test_stream_holds_the_map_in_state(spark, tmp_path):
    schema, at, checkpoint = "k string, s date, e date", str(tmp_path / "in"), str(tmp_path / "c")
    day = lambda n: D0 + timedelta(n)
    feed = [[("a", day(9), day(12)), ("a", day(0), day(5)), ("a", day(40), day(41))], [("a", day(5), day(9)), ("b", D0, None), ("b", None, D0), (None, D0, day(3))], [("a", day(20), day(30))]]
    out = {}
    for part in feed:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at)
        q = merged_periods(spark.readStream.schema(schema).parquet(at), ["k"], "s", "e").writeStream.outputMode("update")
        q.foreachBatch(lambda b, _: out.update({r.k: [tuple(x) for x in r.spans] for r in b.collect()})).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    name = lambda n: day(n).isoformat()
    assert out["a"] == [("period", name(0), name(12)), ("period", name(20), name(30)), ("period", name(40), name(41)), ("gap", name(12), name(20)), ("gap", name(30), name(40))]
    assert out["b"] == [("period", name(0), "9999-12-31")] and len(out) == 2
