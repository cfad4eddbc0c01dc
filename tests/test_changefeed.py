import random

from tidewright.operators import changefeed
from tidewright.operators.changefeed import ChangeLog, apply_changes, compact, flagged_codes
from tidewright.session import scratch

SCHEMA = "entity string, row string, version int, ts timestamp_ntz, ends boolean, ord long"


def brute(changes):
    out = set()
    for e in {c[0] for c in changes if c[0] is not None}:
        mine = [c for c in changes if c[0] == e]
        v = max(c[2] or 0 for c in mine)
        mine = [c for c in mine if (c[2] or 0) == v]
        last = max(c[3] or "" for c in mine)
        if any((c[3] or "") == last and c[4] for c in mine):
            continue
        for r in {c[1] for c in mine if c[1] is not None and not c[4]}:
            best = sorted([c for c in mine if c[1] == r and not c[4]], key=lambda c: c[5])
            ts = max(c[3] or "" for c in best)
            out.add((e, r, v, next(c[5] for c in best if (c[3] or "") == ts)))
    return sorted(out)


def frame(spark, changes):
    from datetime import datetime

    return spark.createDataFrame([(*c[:3], datetime.fromisoformat(c[3]) if c[3] else None, *c[4:]) for c in changes], SCHEMA)


def some(seed, n=400):
    r = random.Random(seed)
    return [(r.choice(["A", "B", "C", None]), r.choice(["1", "2", "3", None]), r.choice([None, 0, 1, 2, 3]), r.choice([None, "2024-01-01", "2024-01-02", "2024-01-03"]), r.random() < 0.15, i) for i in range(n)]


def test_against_brute_force_in_any_order_and_split(spark, rows):
    for seed, n in ((1, 12), (2, 30), (3, 400)):
        changes = some(seed, n)
        want = brute(changes)
        assert rows(apply_changes(frame(spark, changes))) == want
        again = changes + random.Random(9).sample(changes, len(changes) // 2)  # delivered again
        random.Random(4).shuffle(again)
        assert rows(apply_changes(frame(spark, again))) == want
        a, b = again[: n // 3], again[n // 3 :]
        base = compact(frame(spark, a))
        assert rows(apply_changes(frame(spark, b), base)) == brute(a + b)


def test_empty_clashing_and_void_alone(spark, rows):
    assert rows(apply_changes(frame(spark, []))) == []
    void = frame(spark, [("A", "1", 1, "2024-01-01", False, 1), ("A", None, 2, "2024-01-01", True, 2)])
    assert rows(apply_changes(void)) == []
    extra = frame(spark, [("A", "1", None, None, False, 5), ("A", "1", 0, None, False, 3)]).selectExpr("*", "1 as n", "'x' as sign", "2 as head")
    assert rows(apply_changes(extra)) == [("A", "1", 0, 3)]


def test_hot_entities_are_spread(spark, rows, monkeypatch):
    changes = some(12, 600)
    want = rows(apply_changes(frame(spark, changes)))
    monkeypatch.setattr(changefeed, "HOT_LEAST", 1)
    monkeypatch.setattr(changefeed, "HOT_SHARE", 3)
    assert rows(apply_changes(frame(spark, changes))) == want == brute(changes)
    monkeypatch.setattr(changefeed, "HOT_SHARE", 10**9)
    assert rows(apply_changes(frame(spark, changes))) == want


def test_flags(spark, rows):
    t = spark.createDataFrame([(" void ", True, None), ("PAID", False, False), ("x", None, None), (None, True, True), (" ", True, True)], "c string, a boolean, b boolean")
    assert rows(flagged_codes(t, "c", ["a", "b"])) == [("VOID",)]


def test_log_takes_batches_in_any_order(spark, rows):
    changes = some(8, 90)
    for order in ((0, 1, 2), (2, 0, 1, 0)):
        log = ChangeLog(spark, scratch(spark, "log"))
        for i in order:
            out = log.advance(frame(spark, changes[30 * i : 30 * i + 30]))
        assert rows(out) == brute(changes)
