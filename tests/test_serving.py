from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewright.quality.runs import RunLedger
from tidewright.semantic import guard, layer
from tidewright.semantic.serving import Server
from tidewright.session import scratch
from tidewright.sources.tables import Conflict, Table


@pytest.fixture
def server(spark):
    lines = spark.createDataFrame([("a", "x", 5.0), ("b", "x", 1.0), ("c", "y'z", 2.0)], "k string, plan string, paid double")
    months = spark.createDataFrame([("x", "m")], "plan string, month string")
    ms = [layer.Metric("paid_amount", "lines", lambda: F.sum("paid"), synonyms=("cost",)), layer.Metric("months", "months", lambda: F.count("*")), layer.Metric("pmpm", over=("paid_amount", "months"), additive=False)]
    return Server(spark, {"lines": lambda: lines, "months": lambda: months}, layer.Model({"lines": lines, "months": months}, {m.name: m for m in ms}, {"lines": ("plan", "k"), "months": ("plan", "month")}))


def test_objects_and_metrics(server, rows):
    assert rows(server.objects().filter("mart = 'months'")) == [("months", "month", "string"), ("months", "plan", "string")]
    assert server.metric("Cost")["metric_name"] == "paid_amount" and server.metric("pmpm")["dimensions"] == ["plan"]
    assert "paid_amount" in server.metric("paid_amoun")["suggestions"] and "dimension" in server.metric("plan")["suggestions"]


def test_statements_are_bounded_and_logged(server, rows):
    got = server.run_sql("SELECT k FROM lines ORDER BY k LIMIT 99", 2)
    assert rows(got.rows) == [("a",), ("b",)] and got.truncated
    with pytest.raises(guard.Blocked):
        server.run_sql("SELECT k FROM elsewhere")
    with pytest.raises(Exception):
        server.run_sql("SELECT CAST(k AS INT) AS n FROM lines")
    assert [x[1] for x in server.log] == ["SUCCESS", "BLOCKED", "ERROR"]


def test_summaries_compare_values(server, rows):
    got = server.summary("lines", ["plan"], {"paid": "sum(paid)"}, {"plan": "y'z"})
    assert rows(got.rows) == [("y'z", 2.0)] and not got.truncated
    assert rows(server.summary("lines", ["plan"], {"paid": "sum(paid)"}, {"plan": "x' OR '1'='1"}).rows) == []
    assert server.summary("lines", ["k"], {"n": "count(*)"}, max_rows=2).truncated


def test_runs_and_lineage(spark, rows):
    t = lambda n: Table(spark, scratch(spark, n))
    ticks = iter(range(99))
    book = RunLedger(t("runs"), t("lineage"), lambda: datetime(2024, 1, 1) + timedelta(hours=next(ticks)))
    out = t("out")
    with pytest.raises(ZeroDivisionError):
        book.run("r1", "m", {"a": spark.range(3)}, lambda a: 1 / 0, out)
    assert book.run("r2", "m", {"a": spark.range(3), "b": spark.range(4)}, lambda a, b: a.union(b), out).count() == 7
    assert rows(book.runs.read().select("run_id", "status", "rows_written")) == [("r1", "FAILED", None), ("r2", "SUCCESS", 7)]
    assert rows(book.latest().select("run_id")) == [("r2",)] and rows(book.lineage.read()) == [("r1", "m", "a"), ("r2", "m", "a"), ("r2", "m", "b")]


def test_writers_find_each_other(spark, rows):
    t = Table(spark, scratch(spark, "t"))
    t.overwrite(spark.range(2))
    before = t.pointer.get()
    t.append(spark.range(1))
    with pytest.raises(Conflict):
        t.pointer.set({"version": "x", "files": []}, before)
    files = set(t.pointer.get()["files"])
    t.upsert(spark.range(5, 6), ["id"])  # replaces nothing, so no file is rewritten
    assert files < set(t.pointer.get()["files"])
    t.upsert(spark.range(1, 2), ["id"])
    assert rows(t.read()) == [(0,), (0,), (1,), (5,)] and files & set(t.pointer.get()["files"])
