import json
from datetime import datetime

import pytest

from tidewright.plans.bronze import FEEDS, bronze, fact_adjustment, pharmacy_claim

T = datetime(2024, 5, 1)
RAW = "bronze_event_id string, source_extract_ts timestamp_ntz, ingest_ts timestamp_ntz, payload_hash string, payload string, business_event_ts timestamp_ntz"


def landed(spark, payloads):
    return spark.createDataFrame([(f"e{i:02}", T, None, None, p if isinstance(p, (str, type(None))) else json.dumps(p), T) for i, p in enumerate(payloads)], RAW)


CASES = {
    "eligibility": [({"member_id": "m", "plan_id": "p", "coverage_start_date": "2024-01-01"}, None), ({"member_id": " ", "plan_id": "p", "coverage_start_date": "2024-01-01"}, "MISSING_REQUIRED_KEY"), ({"member_id": "m", "plan_id": "p", "coverage_start_date": "2024-02-30"}, "MISSING_REQUIRED_KEY"), ({"member_id": "m", "plan_id": "p", "coverage_start_date": "2024-02-02", "coverage_end_date": "2024-02-01"}, "IMPOSSIBLE_COVERAGE_SPAN"), ({"member_id": "m", "plan_id": "p", "coverage_start_date": "2031-01-01"}, "FUTURE_DATED_EVENT")],
    "provider": [({"npi": "9000000001"}, None), ({}, "MISSING_REQUIRED_KEY"), ({"npi": 9000000001}, None), ({"npi": "900000001"}, "INVALID_NPI_FORMAT"), ({"npi": "9000000001", "effective_date": "2031-01-01"}, "FUTURE_DATED_EVENT")],
    "pharmacy": [({"pharmacy_claim_id": "x", "member_id": "m", "days_supply": "30", "paid_amount": 5}, None), ({"pharmacy_claim_id": "x"}, "MISSING_REQUIRED_KEY"), ({"pharmacy_claim_id": "x", "member_id": "m", "paid_amount": "-1"}, "NEGATIVE_PAID_NON_ADJUSTMENT"), ({"pharmacy_claim_id": "x", "member_id": "m", "days_supply": 0}, "INVALID_DAYS_SUPPLY")],
    "adjudication": [({"adjudication_event_id": "a", "claim_id": "c", "paid_after": -5, "is_adjustment": "yes"}, None), ({"adjudication_event_id": "a", "claim_id": "c", "paid_after": -5}, "NEGATIVE_PAID_NON_ADJUSTMENT"), ({"adjudication_event_id": "a", "claim_id": "c", "paid_after": 9, "allowed_amount": 8}, "PAID_EXCEEDS_ALLOWED"), ({"claim_id": "c"}, "MISSING_REQUIRED_KEY")],
}


@pytest.mark.parametrize("feed", sorted(CASES))
def test_rules(spark, rows, feed):
    raw = landed(spark, [p for p, _ in CASES[feed]] + [None, "", "{broken", "[1]"])
    assert rows(bronze(raw, FEEDS[feed]).select("bronze_event_id", "quarantine_reason")) == sorted([(f"e{i:02}", r) for i, (_, r) in enumerate(CASES[feed])], key=repr)
    assert rows(bronze(raw.limit(0), FEEDS[feed])) == []


def test_repeats_and_what_follows(spark, rows):
    one = {"pharmacy_claim_id": " x ", "member_id": "m", "prescriber_npi": "77", "fill_date": "2024-02-01"}
    got = bronze(landed(spark, [one, one, one | {"days_supply": 3}]), FEEDS["pharmacy"])
    assert rows(got.select("bronze_event_id", "natural_key")) == [("e00", "X"), ("e02", "X")]  # the same message twice, and another of the same key
    assert got.select("idempotency_key").distinct().count() == 2
    assert rows(pharmacy_claim(got).select("pharmacy_claim_id", "prescriber_npi", "pharmacy_npi")) == [("X", "0000000077", None)]
    events = bronze(landed(spark, [{"adjudication_event_id": "a", "claim_id": "c", "paid_before": 5, "paid_after": 2, "event_status": "denied"}, {"adjudication_event_id": "b", "claim_id": "zz", "paid_after": 2}]), FEEDS["adjudication"])
    headers = spark.createDataFrame([("C", "M")], "claim_id string, member_id string")
    out = fact_adjustment(events, headers)
    assert rows(out.selectExpr("adjudication_event_id", "member_id", "cast(paid_delta as string)", "is_increase", "is_decrease", "is_denial")) == [("A", "M", "-3.00", False, True, True), ("B", None, None, False, False, False)]
