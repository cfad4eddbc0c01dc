"""Queries over all rows of their tables, counted here without their SQL."""

import os
import random
from collections import Counter
from datetime import date, timedelta
from itertools import combinations

import pyarrow.parquet as pq
import pytest

from tidewright.operators import relational as R
from tidewright.plans import registry

FAR = date(9999, 12, 31)
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test data here")


def test_ledger_has_every_load(spark):
    rows = pq.read_table(f"{SF}/br_raw_claim_event.parquet", columns=["load_id", "batch_id"]).to_pylist()
    want = Counter((r["load_id"], r["batch_id"]) for r in rows)
    got = registry.queries()["src7_load_ledger"](spark, SF).collect()
    assert {(r.load_id, r.batch_id): r.row_count for r in got} == want and len(got) == len(want)
    assert {r.status for r in got} == {"LOADED"}


def overlapping(spans):
    """(keys, a, b) of all pairs, a span being (ident, start, end)."""
    return sorted((k, *sorted((a, b))) for k, some in spans.items() for a, b in combinations(some, 2) if a[1] < b[2] and a[2] > b[1])


def test_overlap_pairs_against_all_pairs(spark):
    r, day, rows, spans = random.Random(4), date(2023, 1, 1), [], {}
    for i in range(400):
        s = day + timedelta(r.randrange(1500))
        e = r.choice([None, s, s - timedelta(40), *[s + timedelta(r.randrange(1, 900)) for _ in range(6)]])
        rows.append((k := f"m{r.randrange(12)}", i, s, e))
        spans.setdefault((k,), []).append((i, s, e or FAR))
    df = spark.createDataFrame([*rows, (None, 1000, day, None), ("m1", 1001, None, None)], "k string, i int, s date, e date")
    got = sorted(((x.k,), (x.i_a, x.s_a, x.e_a), (x.i_b, x.s_b, x.e_b)) for x in R.overlap_pairs(df, ["k"], "i", "s", "e").collect())
    assert got == overlapping(spans) and any(FAR in a for _, a, _ in got)


def test_coverages_have_all_their_partners(spark):
    spans = {}
    for r in pq.read_table(f"{SF}/eligibility_event.parquet").to_pylist():
        k = tuple((r[c] or "").strip().upper() for c in ("member_id", "plan_id"))
        if all(k) and r["coverage_start_date"]:
            spans.setdefault(k, []).append((r["eligibility_event_id"], r["coverage_start_date"], r["coverage_end_date"] or FAR))
    got = registry.queries()["jn9_overlap_pairs"](spark, SF).collect()
    want = overlapping(spans)
    assert want and sorted(((x.member_id, x.plan_id), (x.span_id_a, x.start_date_a, x.end_date_a), (x.span_id_b, x.start_date_b, x.end_date_b)) for x in got) == want
