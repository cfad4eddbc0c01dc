import os

from pyspark.sql import functions as F

from tidewright import session


def test_broadcast_only_what_is_small_in_rows_and_bytes(spark):
    few, many = spark.range(10), spark.range(50)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert session.fits(few, 10, 1000) and not session.fits(many, 10, 1000) and not session.fits(wide, 10, 1000)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(session.lookup_side(few, 10)) and not hinted(session.lookup_side(many, 10)) and not hinted(session.lookup_side(wide, 10, 1000))
    assert session.fits(few.limit(0), 0, 0)


def test_what_was_written_is_deleted(spark):
    kept = dict(session._written)
    session._written.clear()
    a, b = session.cut(spark.range(5)), session.cut(spark.range(7))
    at = [os.path.dirname(f.removeprefix("file://")) for df in (a, b) for f in df.inputFiles()[:1]]
    session.dropped(a)
    assert not os.path.exists(at[0]) and os.path.exists(at[1]) and b.count() == 7
    session.cleared(spark)
    assert not os.path.exists(at[1])
    session._written.update(kept)
