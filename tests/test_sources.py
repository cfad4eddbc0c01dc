import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewright.plans.graph import Graph
from tidewright.sources import readers, tables, x12
from tidewright.streaming import feeds

LOAD = {"now": "2025-01-01 00:00:00", "batch_id": "B", "load_id": "L", "run_id": "R"}


def test_landing_keeps_bad_lines_apart(spark, tmp_path, rows):
    good = json.dumps({"event_type": "CLAIM", "source_extract_ts": "2024-01-01T00:00:00+00:00", "business_event_ts": "nonsense", "natural_key": {"claim_id": "C"}, "payload": {"a": 1}})
    (tmp_path / "f.ndjson").write_text(f"{good}\n{{broken\n[1]\n\n{good}\n")
    landed, bad = readers.land(readers.read_numbered(spark, str(tmp_path)), LOAD)
    got = landed.orderBy("source_file_row_number").collect()
    assert [r.source_file_row_number for r in got] == [1, 5] and got[0].business_event_ts is None and got[0].source_extract_ts == datetime(2024, 1, 1)
    assert json.loads(got[0].natural_key) == {"claim_id": "C"} and got[0].record_status == "LANDED"
    assert len({r.bronze_event_id for r in got}) == 2
    assert rows(bad.select("row_number", "reason")) == [(2, "INVALID_JSON"), (3, "INVALID_JSON"), (4, "INVALID_JSON")]


def test_seed(spark, tmp_path, rows):
    (tmp_path / "s.csv").write_text('code,name\n 02 ,"a, b"\nNULL,null\n,x\n')
    assert rows(readers.read_seed(spark, str(tmp_path / "s.csv"), ["code", "name"])) == [("02", "a, b"), (None, "x"), (None, None)]
    (tmp_path / "bad.csv").write_text("code,name\n1,2,3\n")
    with pytest.raises(Exception):
        readers.read_seed(spark, str(tmp_path / "bad.csv"), ["code", "name"]).collect()


def test_table_upsert_append_and_schema(spark, tmp_path, rows):
    t = tables.Table(spark, "file://" + str(tmp_path / "t"))
    assert t.read() is None
    f = lambda r, s="k int, v string": spark.createDataFrame(r, s)
    t.upsert(f([(1, "a"), (2, "b"), (None, "n")]), ["k"])
    t.upsert(f([(2, "B", 7), (3, "c", 8), (None, "N", 9)], "k int, v string, w int"), ["k"])
    want = [(1, "a", None), (2, "B", 7), (3, "c", 8), (None, "N", 9)]
    assert rows(t.read()) == want
    t.upsert(f([(2, "B", 7), (3, "c", 8), (None, "N", 9)], "k int, v string, w int"), ["k"])  # again
    assert rows(t.read()) == want
    with pytest.raises(tables.DuplicateKeys):
        t.upsert(f([(1, "x"), (1, "y")]), ["k"])
    assert rows(t.read()) == want
    t.append(f([(9, "z")]))
    assert t.read().count() == 5
    with pytest.raises(ValueError):
        tables.reconcile(f([]), t.read().schema, "fail")
    assert tables.reconcile(f([]), t.read().schema, "append").columns == ["k", "v", "w"]


def test_watermark_never_goes_back(spark, tmp_path, rows):
    marks = tables.Watermarks(tables.Table(spark, "file://" + str(tmp_path / "m")))
    f = lambda *d: spark.createDataFrame([(datetime(2024, 1, x),) for x in d], "ts timestamp_ntz")
    assert marks.filter(f(1, 9), "ts", "p", 3).count() == 2
    marks.advance("p", f(1, 9), "ts")
    marks.advance("p", f(5), "ts")
    marks.advance("p", f(), "ts")
    marks.advance("q", f(2), "ts")
    assert marks.last("p") == datetime(2024, 1, 9) and marks.last("q") == datetime(2024, 1, 2)
    assert {r.ts.day for r in marks.filter(f(5, 6, 20), "ts", "p", 3).collect()} == {6, 20}
    t = tables.Table(spark, "file://" + str(tmp_path / "r"))
    build = lambda df: df.groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    tables.reprocess(f(1, 2, 2, 3), "ts", "2024-01-02", "2024-01-03", build, t, ["d"])
    tables.reprocess(f(1, 2, 2, 3), "ts", "2024-01-02", "2024-01-03", build, t, ["d"])
    assert t.read().count() == 1 and marks.last("p") == datetime(2024, 1, 9)


ISA = "ISA*00*          *00*          *ZZ*NORTHQUAY*ZZ*HARBOR*240301*0915*^*00501*000004711*0*P*<"
TEXT = "~\r\n".join([
    ISA, "GS*HC*NORTHQUAY", "ST*837*4711", "HL*1**20*1", "NM1*85*2*GROVE*****XX*9000000017",
    "HL*2*1*22*0", "NM1*IL*1*MARLOW*K****MI*M-77", "NM1*PR*2*COBALT*****PI*PYR3", "CLM*K1*80.5***21<A<1", "HI*BF<W10*BK<Y20**BF", "SV1*HC<P9*10.5*UN*1", "LX*4", "SV1*HC<P8<25*70*UN*2", "DTP*472*D8*20240229", "DTP*472*D8*20240230",
    "HL*3*1*22*0", "CLM*K2*x***", "LX*1", "SV1*HC*5*UN*1", "HL*4*3*23*0", "REF*G1*" + "*".join(f"e{i}" for i in range(2, 131)), "IEA*1*4711", "",
])


def test_x12(spark, rows):
    files = spark.createDataFrame([("f", TEXT), ("empty", ""), ("none", None), ("first", "HL*1**22*0~CLM*Z*1~")], "file_name string, text string")
    segs = x12.parse_interchange(files)
    mine = segs.filter("record_key = 'f'")
    assert mine.count() == 22 and mine.select("control_number").distinct().first()[0] == "000004711"
    assert [r.segment_index for r in mine.orderBy("segment_index").collect()] == list(range(22))
    assert {r.claim_seq: r.n for r in mine.groupBy("claim_seq").agg(F.count("*").alias("n")).collect()} == {0: 5, 1: 10, 2: 7}
    assert mine.filter("segment = 'REF'").select(F.size("elements"), F.element_at("elements", -1)).first() == (130, "e130")  # no element is cut off
    assert segs.filter("record_key = 'first'").select("claim_seq").distinct().collect()[0][0] == 1 and "none" not in {r.record_key for r in segs.collect()}
    got = rows(x12.claim_headers(mine).select("claim_seq", "claim_id", F.col("charge_amount").cast("string"), "place_of_service", "member_id", "payer_id", "billing_npi", "control_number", F.col("service_date").cast("string")))
    assert got == [(1, "K1", "80.50", "21", "M-77", "PYR3", "9000000017", "000004711", "2024-02-29"), (2, "K2", None, None, None, None, "9000000017", "000004711", None)]
    assert rows(x12.claim_lines(mine).select("claim_seq", "line_number", "procedure_code", F.col("service_date").cast("string"))) == sorted([(1, None, "P9", "2024-02-29"), (1, 4, "P8", "2024-02-29"), (2, 1, None, None)], key=repr)
    assert rows(x12.claim_diagnoses(mine).drop("record_key")) == sorted([(1, 1, "BF", "W10", False), (1, 2, "BK", "Y20", True), (1, 3, "BF", None, False)], key=repr)


def test_x12_files_get_a_status(spark, rows):
    files = spark.createDataFrame([("f", TEXT), ("empty", ""), ("none", None), ("cut", ISA + "~ST*837*1~HL*1**22*0~"), ("other", TEXT.replace("*837*", "*835*"))], "file_name string, text string")
    raw = x12.load_raw(files)
    assert {r.source_file_name: r.natural_key for r in raw.collect()} == {"f": "000004711", "empty": None, "none": None, "cut": "000004711", "other": "000004711"}
    out = x12.convert(raw).join(raw.select("bronze_event_id", "source_file_name"), "bronze_event_id")
    assert {r.source_file_name: (r.record_status, r.quarantine_reason and r.quarantine_reason.split(":")[0]) for r in out.collect()} == {
        "f": ("PROCESSED", None), "empty": ("QUARANTINE", "no interchange header (ISA) with a control number"), "none": ("QUARANTINE", "no interchange header (ISA) with a control number"),
        "cut": ("QUARANTINE", "no interchange trailer (IEA)"), "other": ("QUARANTINE", "transaction type is not 837"),
    }
    segs = x12.parse_interchange(files.filter("file_name = 'f'"))
    again = x12.document_segments(out.filter("document is not null"), "source_file_name", "document")
    cols = ["record_key", "segment_index", "segment", "claim_seq", "elements"]
    assert rows(again.select(*cols)) == rows(segs.select(*cols))  # what was parsed, written and read again


def test_x12_documents_with_objects_and_gaps(spark, rows):
    doc = {"segments": [{"_segment": "ISA", "13": "9"}, {"_segment": "CLM", "claim_seq": "1", "01": "K", "02": 5, "05": {"01": "11", "03": "1"}}, None, {"claim_seq": 1, "01": "x"}, {"_segment": "HI", "claim_seq": 1, "02": {"01": "BK", "02": "W1"}, "note": "z"}, {"_segment": "SE", "claim_seq": "one"}]}
    df = spark.createDataFrame([("d", json.dumps(doc)), ("s", json.dumps(json.dumps({"segments": json.dumps(doc["segments"][:1])}))), ("bad", "{"), ("none", None)], "k string, p string")
    got = {(r.record_key, r.segment_index): (r.segment, r.claim_seq, r.elements) for r in x12.document_segments(df, "k", "p").collect()}
    assert got == {("d", 0): ("ISA", 0, [None] * 12 + ["9"]), ("d", 1): ("CLM", 1, ["K", "5", None, None, "11<<1"]), ("d", 3): (None, 1, ["x"]), ("d", 4): ("HI", 1, [None, "BK<W1"]), ("d", 5): ("SE", 0, []), ("s", 0): ("ISA", 0, [None] * 12 + ["9"])}
    assert rows(x12.claim_diagnoses(x12.document_segments(df, "k", "p")).drop("record_key")) == [(1, 1, "BK", "W1", True)]


def test_streams(spark, tmp_path, rows):
    src = str(tmp_path / "in")
    f = lambda r: spark.createDataFrame(r, "k string, ts timestamp_ntz, v int").coalesce(1).write.mode("append").parquet(src)
    t, d = tables.Table(spark, "file://" + str(tmp_path / "t")), lambda x: datetime(2024, 1, x)
    run = lambda: feeds.keep_latest(feeds.read_feed(spark, src, "k string, ts timestamp_ntz, v int"), t, ["k"], [F.col("ts").desc(), F.col("v")], str(tmp_path / "c")).awaitTermination()
    f([("a", d(1), 1), ("a", d(3), 2), ("b", d(1), 3)])
    run()
    f([("a", d(2), 9), ("b", d(5), 4)])
    run()
    run()
    assert rows(t.read().select("k", "v")) == [("a", 2), ("b", 4)]
    seen = []
    feeds.gated(feeds.read_feed(spark, src, "k string, ts timestamp_ntz, v int"), lambda b, n: seen.append(b.count()), str(tmp_path / "g")).awaitTermination()
    assert sum(seen) == 5


def test_graph(spark, tmp_path, rows):
    g = Graph()

    @g.model("raw")
    def one(raw):
        return raw.filter("id > 1")

    @g.model("one", "raw")
    def two(a, raw):
        return a.join(raw, "id")

    @g.model("raw")
    def side(raw):
        return raw

    raw = {"raw": spark.range(4)}
    assert g.downstream({"one"}) == ["one", "two"]
    assert rows(g.build(raw, ["two"])["two"]) == [(2,), (3,)] and "side" not in g.build(raw, ["two"])
    assert rows(g.write(spark, raw, "file://" + str(tmp_path / "g"))["two"]) == [(2,), (3,)]
