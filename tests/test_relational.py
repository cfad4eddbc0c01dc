import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tidewright.functions import expr as E
from tidewright.operators import relational as R

D0 = date(2024, 1, 15)


def test_latest_by_nulls_ties_and_empty(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "x"), (None, None, "n"), (None, 2, "m")], "k string, t int, v string").withColumn("_rn", F.lit(9))
    order = [F.col("t").desc_nulls_last(), F.col("v")]
    assert rows(R.latest_by(df.drop("_rn"), ["k"], order)) == [("a", 3, "x"), (None, 2, "m")]
    assert rows(R.latest_values(df, ["k"], ["t", "v"], ["v"])) == [("a", "y"), (None, "m")]
    assert rows(R.latest_by(df.limit(0), ["k"], order)) == []


def test_chain_and_current(spark, rows):
    df = spark.createDataFrame([("a", 1, "N"), ("a", 2, "R"), ("b", 1, "R"), ("c", None, "N"), ("c", 5, "A")], "k string, v int, f string")
    got = rows(R.version_chain(df, "k", "v", [], {"REVERSAL": F.col("f") == "R", "ADJUSTMENT": F.col("f") == "A"}).select("k", "v", "chain_seq", "prior_version", "latest_version", "chain_class", "is_latest"))
    assert got == [("a", 1, 1, None, 2, "ORIGINAL", False), ("a", 2, 2, 1, 2, "REVERSAL", True), ("b", 1, 1, None, 1, "REVERSAL", True), ("c", 5, 2, None, 5, "ADJUSTMENT", True), ("c", None, 1, None, 5, "ORIGINAL", None)]
    bad = F.col("f") == "R"
    assert rows(R.resolve_current(df, "k", "v", [], bad).select("k", "v")) == [("a", 1), ("c", 5)]
    assert rows(R.resolve_current(df, "k", "v", [], bad, cancels=True).select("k", "v")) == [("c", 5)]


def test_spans_and_months(spark, rows):
    r = random.Random(1)
    data = [(r.choice("ab"), D0 + timedelta(a := r.randint(0, 300)), D0 + timedelta(a + r.randint(-2, 20))) for _ in range(200)] + [("c", D0, None), ("c", D0 - timedelta(5), D0), ("d", None, D0)]
    df = spark.createDataFrame(data, "k string, s date, e date")
    got = rows(R.merge_spans(df, ["k"], "s", "e").select("k", "span_start", "span_end"))
    for k in "ab":
        mine = sorted((s, e) for kk, s, e in got if kk == k)
        assert all(x[1] < y[0] for x, y in zip(mine, mine[1:]))
        days = lambda spans: {s + timedelta(i) for s, e in spans for i in range((e - s).days)}
        assert days(mine) == days([(s, e) for kk, s, e in data if kk == k])
    assert [x[1:] for x in got if x[0] in "cd"] == [(D0 - timedelta(5), None)]
    one = spark.createDataFrame([("a", date(2024, 1, 31), date(2024, 3, 1)), ("b", date(2024, 1, 5), None), ("c", date(2024, 5, 1), date(2024, 5, 1))], "k string, s date, e date")
    assert rows(R.expand_months(one, "s", "e", "2024-03-02").select("k", "month")) == [("a", date(2024, 1, 1)), ("a", date(2024, 2, 1)), ("b", date(2024, 1, 1)), ("b", date(2024, 2, 1)), ("b", date(2024, 3, 1))]
    assert R.date_spine(spark, "2024-02-28", "2024-03-01").count() == 2


def test_neighbours_and_joins(spark, rows):
    df = spark.createDataFrame([(1, 1, "L1"), (1, 2, None), (1, 3, "L2"), (2, 1, None)], "p int, i int, x string")
    assert rows(R.neighbors(df, ["p"], "i", {"b": F.col("x")}, {"a": F.col("x")})) == [(1, 1, "L1", "L1", "L1"), (1, 2, None, "L1", "L2"), (1, 3, "L2", "L2", "L2"), (2, 1, None, None, None)]
    t = lambda h: datetime(2024, 1, 1, h)
    left = spark.createDataFrame([("a", t(1), 1), ("a", t(5), 2), ("b", t(5), 3)], "k string, at timestamp_ntz, id int")
    right = spark.createDataFrame([("a", t(2), 10), ("a", t(5), 20), ("b", t(6), 30)], "k string, at timestamp_ntz, v int")
    assert rows(R.asof_join(left, right, ["k"], "at", ["v"]).select("id", "v")) == [(1, None), (2, 20), (3, None)]
    r = random.Random(4)
    points = [(r.choice("ab"), D0 + timedelta(r.randint(0, 200)), i) for i in range(60)]
    spans = [(r.choice("ab"), D0 + timedelta(a := r.randint(0, 200)), D0 + timedelta(a + r.randint(0, 90)), i) for i in range(40)]
    got = rows(R.range_join(spark.createDataFrame(points, "k string, at date, p int"), spark.createDataFrame(spans, "k string, s date, e date, q int"), ["k"], "at", "s", "e").select("p", "q"))
    assert got == sorted([(p, q) for k, at, p in points for kk, s, e, q in spans if k == kk and s <= at < e], key=repr)


def test_allocation_topk_dims_and_late(spark, rows):
    df = spark.createDataFrame([("a", 100.0, 1.0), ("a", 100.0, 3.0), ("b", 10.0, 0.0), ("b", 10.0, 0.0), ("c", None, 1.0)], "k string, amount double, w double")
    assert rows(df.select("k", R.allocate(F.col("amount"), F.col("w"), ["k"]).alias("s"))) == [("a", 25.0), ("a", 75.0), ("b", 5.0), ("b", 5.0), ("c", 0.0)]
    v = spark.createDataFrame([("g", "x", 1), ("g", "y", 5), ("g", "x", 4), ("g", "z", 9), ("g", None, 99)], "g string, v string, a int")
    assert rows(R.topk_array(v, ["g"], "v", F.col("a"), 2)) == [("g", ["z", "x"])]
    obs, seed = spark.createDataFrame([("a",), ("a",), (None,), ("q",)], "k string"), spark.createDataFrame([("a", "A"), ("b", "B")], "k string, n string")
    assert rows(R.conform_dim(obs, seed, "k", {"n": "?"})) == [("a", "A", True, True), ("b", "B", False, True), ("q", "?", True, False)]
    late = spark.createDataFrame([(date(2024, 1, 30), date(2024, 2, 10)), (date(2024, 1, 1), date(2024, 1, 30)), (None, date(2024, 1, 1))], "s date, r date").withColumns(R.late_flags(F.col("s"), F.col("r"), 7))
    assert rows(late.select("lag_days", "is_late", "impacted_period")) == [(11, True, date(2024, 1, 1)), (29, False, None), (None, False, None)]
    m = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", "w"), ("c", None)], "k string, v string")
    assert rows(R.mode_by(m, ["k"], "v")) == [("a", "y"), ("b", "w")]


def test_expressions(spark):
    one = spark.range(1)
    first = lambda *c: one.select(*c).first()
    s = lambda x: F.lit(x).cast("string")
    assert tuple(first(E.norm_id(s(" a\t")), E.norm_id(s("  ")), E.norm_id(s(None)))) == ("A", None, None)
    assert first(E.natural_key(s("a"), s(None)))[0] is None and first(E.natural_key(s("a"), F.lit(1)))[0] == "a|1"
    assert first(E.surrogate_key(s("a"), s(None)))[0] == first(F.md5(F.lit("a|_dbt_utils_surrogate_key_null_")))[0]
    assert first(E.json_get(F.lit('{"a":{"b":12.50}}'), "$.a.b", "decimal(18,2)"))[0].as_tuple().digits == (1, 2, 5, 0)
    assert tuple(first(E.json_get(F.lit("{broken"), "$.a", "int", 7), E.json_get(F.lit('{"a":"x"}'), "$.a", "int"))) == (7, None)
    ts = lambda x: F.lit(x).cast("timestamp_ntz")
    assert tuple(first(E.day_diff(ts("2024-01-01 23:00:00"), ts("2024-01-02 01:00:00")), E.hour_diff(ts("2024-01-01 23:59:00"), ts("2024-01-02 00:01:00")))) == (1, 1.0)
    assert tuple(first(E.div0(F.lit(1), F.lit(0)), E.ratio(F.lit(1), F.lit(0)))) == (0.0, None)
    assert tuple(first(E.loose_boolean(s("Y")), E.loose_boolean(s("on")), E.loose_boolean(s(None)))) == (True, False, False)
    assert tuple(first(E.first_failing([("A", F.lit(None).cast("boolean")), ("B", F.lit(True))]), E.first_failing([]))) == ("B", None)


def test_hot_keys_are_spread(spark, rows, monkeypatch):
    r = random.Random(5)
    left = spark.createDataFrame([(r.choice(["hot"] * 6 + ["a", "b", None]), i) for i in range(300)], "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("a", 3), (None, 4), ("z", 5)], "k string, v int")
    for how in ("inner", "left"):
        want = rows(left.join(right, "k", how))
        assert rows(R.hot_join(left, right, ["k"], how)) == want
        with monkeypatch.context() as m:
            m.setattr(R, "HOT_LEAST", 20)
            m.setattr(R, "HOT_SHARE", 10**9)
            got = R.hot_join(left, right, ["k"], how)
            assert rows(got) == want
        assert rows(R.hot_join(left.limit(0), right, ["k"], how)) == []


def test_chunks_carry_what_they_lack(spark, rows):
    r = random.Random(6)
    data = [(r.choice(["x", "y", None]), t, i, r.choice([None, None, None, i])) for i, t in enumerate(r.sample(range(4000), 300))]
    df = spark.createDataFrame(data, "k string, t int, i int, v int")
    plain = R.neighbors(df, ["k"], "t", {"b": F.col("v")}, {"a": F.col("v")})
    for width in (1, 50, 900, 10_000):
        assert rows(R.neighbors(df, ["k"], "t", {"b": F.col("v")}, {"a": F.col("v")}, F.floor(F.col("t") / width))) == rows(plain)
    left, right = df.filter("v is null").select("k", "t", "i"), df.filter("v is not null").select("k", "t", "v")
    assert rows(R.asof_join(left, right, ["k"], "t", ["v"], lambda c: F.floor(c / 70))) == rows(R.asof_join(left, right, ["k"], "t", ["v"]))
