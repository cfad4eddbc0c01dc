import pytest
from pyspark.sql import functions as F

from tidewright.quality import checks as c
from tidewright.semantic import guard, layer, search


def test_checks_pass_on_clean_and_fail_on_injected(spark):
    good = spark.createDataFrame([(1, "a", 5.0), (2, "b", 0.0)], "k int, v string, x double")
    bad = good.unionByName(spark.createDataFrame([(2, "zz", -1.0), (None, None, None)], "k int, v string, x double"))
    ref = spark.createDataFrame([(1,), (2,)], "r int")
    for f, n in (
        (lambda d: c.not_null(d, "k"), 1), (lambda d: c.unique(d, "k"), 1), (lambda d: c.unique_combination(d, ["k"]), 1), (lambda d: c.accepted_values(d, "v", ["a", "b"]), 1), (lambda d: c.relationships(d, "k", ref.filter("r = 1") if d is bad else ref, "r"), 2),
        (lambda d: c.accepted_range(d, "x", 0, 5), 1), (lambda d: c.expression_is_true(d, "x >= 0"), 1), (lambda d: c.nonnegative_unless(d, "x", F.col("v") == "q"), 1),
    ):
        assert f(good).count() == 0 and f(bad).count() == n
    assert c.accepted_range(good, "x", 0, inclusive=False).count() == 1
    assert c.header_line_reconciliation(good, good, "k", "x", "x", 0.01).count() == 0 and c.header_line_reconciliation(good, good.limit(0), "k", "x", "x", 0.01).count() == 1


def test_chain_violations(spark, rows):
    df = spark.createDataFrame([("a1", "a", 1, 10, False, None), ("a2", "a", 2, -99, True, "a1"), ("b1", "b", 1, 5, False, "nope"), ("b2", "b", 1, 5, False, None)], "k string, c string, v int, x int, r boolean, o string")
    assert rows(c.chain_violations(df, "k", "c", "v", "x", F.col("r"), "o")) == [("a", 2, "REVERSAL_EXCEEDS_PRIOR"), ("b", 1, "DANGLING_ORIGINAL"), ("b", 1, "VERSION_REPEATED"), ("b", 1, "VERSION_REPEATED")]


def test_runner_and_scorecard(spark, rows, tmp_path):
    t = {"t": spark.createDataFrame([(1,), (-1,)], "x int")}
    specs = [c.Check("range", "t", "error", lambda d: c.accepted_range(d, "x", 0), store=str(tmp_path / "bad")), c.Check("where", "t", "warn", lambda d: c.accepted_range(d, "x", 0), where="x > 0")]
    runs = [c.run_checks(spark, specs, {"t": t["t"].limit(n)}, f"r{n}", f"2024-01-0{n + 1}") for n in (0, 2)]
    assert rows(runs[1].select("check_name", "failing_rows", "status")) == [("range", 1, "ERROR"), ("where", 0, "PASS")]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    assert rows(c.scorecard(runs[0].unionByName(runs[1])).select("check_name", "latest_failing", "prior_failing", "trend", "pass_rate")) == [("range", 1, 0, "REGRESSING", 0.5), ("where", 0, 0, "STABLE", 0.5)]


def test_semantic_query_does_not_fan_out(spark, rows):
    a = spark.createDataFrame([("x", "c1", 10.0), ("x", "c1", 20.0), ("y", "c2", 5.0), (None, "c3", 1.0)], "plan string, claim string, paid double")
    b = spark.createDataFrame([("x",), ("x",), ("z",)], "plan string")
    ms = [layer.Metric("paid", "a", lambda: F.sum("paid"), synonyms=("total paid",)), layer.Metric("claims", "a", lambda: F.count_distinct("claim"), additive=False), layer.Metric("months", "b", lambda: F.count("*")), layer.Metric("pmpm", over=("paid", "months"))]
    m = layer.Model({"a": a, "b": b}, {x.name: x for x in ms}, {"a": ("plan",), "b": ("plan",)}, {"product": "plan"})
    assert rows(m.query(["Total Paid", "months", "pmpm"], ["product"])) == sorted([("x", 30.0, 2, 15.0), ("y", 5.0, None, None), ("z", None, 1, None), (None, 1.0, None, None)], key=repr)
    assert rows(m.query(["paid", "pmpm"])) == [(36.0, 12.0)]
    assert rows(m.query(["claims"], ["plan"], ["plan = 'x'"])) == [("x", 1)]
    with pytest.raises(KeyError, match="paid"):
        m.query(["payd"])


def test_guard(spark):
    spark.range(3).createOrReplaceTempView("ok_view")
    spark.range(3).createOrReplaceTempView("secret")
    allow = {"ok_view"}
    for sql in ("SELECT id FROM ok_view", "WITH c AS (SELECT id FROM ok_view) SELECT c.id FROM c WHERE c.id > 1", "SELECT count(*) AS n FROM ok_view GROUP BY id HAVING count(*) > 0 ORDER BY 1", "SELECT 'DROP TABLE x; --' AS t FROM ok_view /* secret */", "SELECT a.id FROM ok_view a JOIN ok_view b ON a.id = b.id"):
        assert guard.guarded_sql(spark, sql, allow).count() >= 0
    for sql in (
        "SELECT * FROM ok_view", "SELECT id FROM secret", "SELECT id FROM ok_view WHERE id IN (SELECT id FROM secret)", "SELECT id FROM ok_view WHERE EXISTS (SELECT 1 FROM secret)", "SELECT (SELECT max(id) FROM secret) AS m FROM ok_view", "WITH c AS (SELECT id FROM secret) SELECT id FROM c",
        "SELECT id FROM `secret`", "SELECT id FROM ok_view UNION SELECT id FROM secret", "DROP TABLE ok_view", "INSERT INTO ok_view VALUES (1)", "CREATE TABLE t AS SELECT id FROM ok_view", "SELECT id FROM ok_view; SELECT id FROM secret", "SET x = 1", "SELECT id FROM range(5)", "nonsense", "SELECT a.id FROM ok_view a, LATERAL (SELECT s.id FROM secret s) b",
        "SELECT id FROM parquet.`/tmp/x`", "SELECT reflect('java.lang.System', 'getProperty', 'user.dir') AS x FROM ok_view", "SELECT java_method('java.lang.System', 'exit', 1) AS x FROM ok_view", "SELECT try_reflect('java.lang.System', 'getProperty', 'user.dir') AS x FROM ok_view",
        "SELECT upper(reflect('java.lang.System', 'getProperty', 'user.dir')) AS x FROM ok_view", "SELECT id FROM ok_view WHERE reflect('java.lang.System', 'getProperty', 'a') = 'b'", "SELECT id FROM ok_view ORDER BY raise_error('x')", "SELECT system.builtin.reflect('a', 'b') AS x FROM ok_view", "SELECT input_file_name() AS f FROM ok_view",
        "SELECT t.c FROM ok_view LATERAL VIEW stack(2, 1, 2) t AS c", "SELECT transform(array(1), x -> raise_error('x')) AS y FROM ok_view", "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.dir') AS x FROM ok_view", "SELECT sum(id) OVER (ORDER BY reflect('a', 'b')) AS x FROM ok_view",
    ):
        with pytest.raises(guard.Blocked):
            guard.guarded_sql(spark, sql, allow)
    assert guard.guarded_sql(spark, "SELECT id FROM ok_view", allow, max_rows=2).count() == 2
    for cap, sql, n, cut in ((2, "SELECT id FROM ok_view LIMIT 500", 2, True), (2, "SELECT id FROM ok_view LIMIT 1", 1, False), (3, "SELECT id FROM ok_view", 3, False)):
        got = guard.answer(spark, sql, allow, cap)
        assert got.rows.count() == n and got.truncated == cut
    log = []
    for sql in ("SELECT no_such FROM ok_view", "SELECT CAST('x' AS INT) AS n FROM ok_view"):  # the second fails only as it runs
        with pytest.raises(Exception):
            guard.guarded_sql(spark, sql, allow, audit=log)
    guard.guarded_sql(spark, "SELECT max(id) AS m FROM ok_view", allow, audit=log)
    assert [x[1] for x in log] == ["ERROR", "ERROR", "SUCCESS"]


def test_search(spark, rows):
    corpus = spark.createDataFrame([(1, "denial rate of claims"), (2, "claims"), (3, None), (4, "Claims claims, rate!"), (5, "members")], "id int, t string")
    assert [r.id for r in search.search(corpus, "id", "t", "denial claims", 3).collect()][0] == 1
    assert {r.id for r in search.search(corpus, "id", "t", "claims").collect()} == {1, 2, 4}
    assert search.search(corpus, "id", "t", "!!").collect() == [] and search.search(corpus.limit(0), "id", "t", "claims").collect() == []
