import csv
import io
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidewright.operators import malformed as m
from tidewright.plans.problems import CLAIM_EXTRACT

GOOD = "S,2024-01-01T00:00:00Z,CLAIM,2024-02-29 10:00:00.123456+14:59,C1,1,M1,-12.50,LANDED,,B,note"


def changed(i, value):
    f = GOOD.split(",")
    f[i] = value
    return ",".join(f)


CASES = [
    (GOOD, None), (None, "COLUMN_COUNT"), ("", "COLUMN_COUNT"), ("a,b", "COLUMN_COUNT"), (GOOD + ",", "COLUMN_COUNT"), (changed(11, '"a, ""b""\nc"'), None), (changed(11, '"a"x'), "QUOTING"), (changed(11, 'a"'), "QUOTING"),
    (changed(11, '"a'), "QUOTING"), (changed(11, 'x "y" z'), "QUOTING"), (changed(11, ' "y"'), "QUOTING"), (changed(11, '"y" '), "QUOTING"), (changed(11, '""'), None), (changed(11, '"""'), "QUOTING"), ('"' * 4 + GOOD[1:], None),
    (changed(4, " null "), "INVALID_VALUE"), (changed(4, '"NULL"'), "INVALID_VALUE"), (changed(2, "claim"), "INVALID_VALUE"), (changed(2, " CLAIM "), None), (changed(8, "QUARANTINE"), "INVALID_VALUE"), (changed(8, ""), "INVALID_VALUE"),
    (changed(5, "1234567890"), "INVALID_VALUE"), (changed(5, " 7 "), None), (changed(5, "NULL"), None), (changed(5, "٣"), "INVALID_VALUE"), (changed(7, "1.234"), "INVALID_VALUE"), (changed(7, "+1"), "INVALID_VALUE"), (changed(7, "1."), "INVALID_VALUE"), (changed(7, ""), None),
    (changed(1, "2023-02-29T00:00:00"), "INVALID_VALUE"), (changed(1, "2024-02-29  00:00:00"), "INVALID_VALUE"), (changed(1, "2024-02-29T24:00:00"), "INVALID_VALUE"), (changed(1, "2024-02-29T23:59:60"), "INVALID_VALUE"), (changed(1, "2024-02-29T23:59:59+15:00"), "INVALID_VALUE"),
    (changed(1, "2024-02-29T23:59:59.1234567"), "INVALID_VALUE"), (changed(1, ""), "INVALID_VALUE"), (changed(3, "null"), None), (changed(3, "0000-01-01 00:00:00"), "INVALID_VALUE"), (changed(11, "line\nbreak"), None), (changed(11, "x\r"), None), (changed(11, "é" * 50_000), None),
]


@pytest.mark.parametrize("record,reason", CASES)
def test_strict(record, reason):
    assert m.diagnose(record, CLAIM_EXTRACT)[0] == reason


def test_blocks_agree_with_the_strict_parser():
    r = random.Random(3)
    for size in (1, 7, 50, 600):
        records = [r.choice(CASES)[0] if r.random() < 0.2 else GOOD for _ in range(size)]
        got: dict[int, tuple] = {}
        b = m.Bisection(CLAIM_EXTRACT)
        b.read(pa.array(records, pa.string()), lambda at, v: got.update({int(k): (None, [c[i].as_py() for c in v]) for i, k in enumerate(at)}), lambda i, reason, _: got.update({i: (reason, None)}))
        want = {i: (d[0], d[2]) for i, d in enumerate(m.diagnose(x, CLAIM_EXTRACT) for x in records)}
        assert got == want
        good = sum(x is None for x, _ in want.values())
        assert b.bulk == good and b.strict == size - good  # every good record lands in bulk


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="no test data here")
def test_good_records_land_in_bulk():
    records = pq.read_table("/root/testdata/sf0.1/raw_claim_record.parquet")["raw_text"].combine_chunks()
    b, bad = m.Bisection(CLAIM_EXTRACT), []
    for at in range(0, len(records), m.BLOCK):
        b.read(records.slice(at, m.BLOCK), lambda *_: None, lambda *x: bad.append(x))
    assert b.bulk >= 0.95 * (len(records) - len(bad)) and b.bulk + b.strict == len(records)


def test_times_as_the_strict_parser_reads_them():
    r = random.Random(4)
    texts = ["%04d-%02d-%02d%s%02d:%02d:%02d" % (r.choice([0, 1, 1900, 2000, 2023, 2024, 9999]), r.randint(0, 13), r.randint(0, 32), r.choice("T "), r.randint(0, 25), r.randint(0, 61), r.randint(0, 61)) for _ in range(3000)]
    texts += ["%04d-%02d-%02d 00:00:00" % (y, mo, d) for y in (1900, 2000, 2023, 2024) for mo in range(1, 13) for d in (28, 29, 30, 31)]
    column = m.Column("x", timestamp=True)
    assert m._whole_times(pa.array(texts)).tolist() == [m.fits(column, x) for x in texts]


def test_fields_as_a_csv_reader_reads_them():
    r = random.Random(1)
    for _ in range(300):
        fields = ["".join(r.choice('ab",\n ') for _ in range(r.randint(0, 6))) for _ in range(r.randint(2, 5))]
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(fields)
        assert m.split_fields(out.getvalue()) == fields


def test_operator(spark, rows):
    df = spark.createDataFrame([(i, x, "no", "clash") for i, (x, _) in enumerate(CASES)], "id long, t string, reason string, note string")
    out = m.read_records(df, "t", ["id"], CLAIM_EXTRACT)
    assert rows(out.select("id", "reason")) == sorted([(i, x) for i, (_, x) in enumerate(CASES)], key=repr)
    assert out.filter("id = 0").select("claim_id", "paid_amount", "raw_record").first() == ("C1", "-12.50", None)
    assert rows(m.read_records(df.limit(0), "t", ["id"], CLAIM_EXTRACT)) == []
