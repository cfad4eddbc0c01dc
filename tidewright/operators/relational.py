"""Operators on keyed rows: latest per key, version chains, current state, spans, months, neighbours, allocation, top-k, dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.expr import first_failing, resolve_status


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by `order`, which should be total; null keys are one key. The filter stands next to the window, so that
    all but a partition's first rows are dropped before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_values(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """As latest_by with the greatest `order`, for a few values only: one aggregation with partial results, safe for hot keys."""
    best = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]))
    return df.groupBy(*keys).agg(best.alias("_m")).select(*keys, *[F.col(f"_m.v{i}").alias(v) for i, v in enumerate(values)])


def route_quarantine(df: DataFrame, rules: list[tuple[str, Column]], status: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """Rows split by the first rule that holds: valid and quarantined, both with record_status and quarantine_reason."""
    out = df.withColumns(resolve_status(first_failing(rules), F.col(status), F.col(reason)))
    return out.filter("record_status = 'VALID'"), out.filter("record_status = 'QUARANTINE'")


def version_chain(df: DataFrame, chain: str, version: str, ties: list[Column], flags: dict[str, Column]) -> DataFrame:
    """Adds chain_seq, prior_version, latest_version, is_latest and chain_class (the first flag that holds, else ORIGINAL). One sort serves all."""
    w = Window.partitionBy(chain).orderBy(F.col(version).asc_nulls_first(), *ties)
    return df.select(
        "*",
        F.row_number().over(w).alias("chain_seq"),
        F.lag(version).over(w).alias("prior_version"),
        F.max(version).over(Window.partitionBy(chain)).alias("latest_version"),
        F.coalesce(first_failing(list(flags.items())), F.lit("ORIGINAL")).alias("chain_class"),
    ).withColumn("is_latest", F.col(version) == F.col("latest_version"))


def resolve_current(df: DataFrame, key: str, version: str, ties: list[Column], ineligible: Column, cancels: bool = False) -> DataFrame:
    """One row per key at most: the highest version that is eligible. With cancels, a key whose highest version is ineligible has none."""
    bad = F.coalesce(ineligible, F.lit(False))
    first = [] if cancels else [bad.asc()]
    w = Window.partitionBy(key).orderBy(*first, F.col(version).desc_nulls_last(), *ties)
    return df.withColumn("_bad", bad).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1 and not _bad").drop("_rn", "_bad")


def merge_spans(df: DataFrame, keys: list[str], start: str, end: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """Gaps and islands in windows, for spans that carry values: keys, span_start, span_end (null if open), n and the carried aggregates.
    Spans that overlap or touch are one; rows without a start, or that end before it, are left out. (intervals.merge_intervals
    is the form for hot keys.)"""
    far = F.to_date(F.lit("9999-12-31"))
    rows = df.withColumn("_s", F.col(start)).withColumn("_e", F.coalesce(F.col(end), far)).filter("_s is not null and _e >= _s")
    w = Window.partitionBy(*keys).orderBy(F.unix_date("_s"))  # rows of one start are peers, so their order doesn't matter
    before = F.max("_e").over(w.rangeBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.when(before.isNull() | (F.col("_s") > before), 1).otherwise(0))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    out = rows.groupBy(*keys, "_island").agg(F.min("_s").alias("span_start"), F.nullif(F.max("_e"), far).alias("span_end"), F.count("*").alias("n"), *[c.alias(k) for k, c in (carry or {}).items()])
    return out.drop("_island")


def expand_months(df: DataFrame, start: str, end: str, as_of: str) -> DataFrame:
    """One row per month that the half-open span touches, in column month; an open end is capped at as_of. No join with a calendar."""
    last = F.date_sub(F.coalesce(F.col(end), F.to_date(F.lit(as_of))), 1)
    return df.filter(F.col(start) <= last).withColumn("month", F.explode(F.sequence(F.trunc(start, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))))


def date_spine(spark, start: str, end: str) -> DataFrame:
    """Days from start up to, not including, end."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.date_sub(F.to_date(F.lit(end)), 1))).alias("day"))


HOT_LEAST, HOT_SHARE = 10_000, 10_000


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left joined with right (inner or left) by shuffle, whatever key holds most rows of left. A key with more than one in HOT_SHARE of them is hot, so there
    are fewer than HOT_SHARE such keys: its rows are spread over tasks in proportion to their number, and its rows in right are repeated as often.
    Rows of left with a null key match nothing and are spread by hash."""
    limit = max(HOT_LEAST, left.count() // HOT_SHARE)
    hot = F.broadcast(left.dropna(subset=keys).groupBy(*keys).count().filter(F.col("count") > limit).select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("_salts")))
    rest = [c for c in left.columns if c not in keys]
    null = None
    for k in keys:
        null = F.col(k).isNull() if null is None else null | F.col(k).isNull()
    spread = F.xxhash64(*rest) if rest else F.lit(0)
    salted = left.join(hot, keys, "left").withColumn("_salt", F.pmod(spread, F.when(null, 1 << 16).otherwise(F.coalesce("_salts", F.lit(1)))).cast("int")).drop("_salts")
    many = right.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted.join(many, [*keys, "_salt"], how).drop("_salt")


def neighbors(df: DataFrame, partition: list[str], position: str, before: dict[str, Column], after: dict[str, Column], chunk: Column | None = None) -> DataFrame:
    """Adds for each row the nearest value at or before it, and at or after it, in the partition (an as-of join by position in one sort).
    The columns are null where they don't apply.

    chunk, which must never fall as position grows, cuts a partition into chunks that are sorted by tasks of their own; what a chunk lacks is carried over
    from the nearest chunk that has it, of which there is one row per chunk. Without it a partition is one task's."""
    keys = [*partition] if chunk is None else [*partition, "_chunk"]
    rows = df if chunk is None else df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*keys).orderBy(position)
    back, on = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    near = rows.select("*", *[F.last(c, ignorenulls=True).over(back).alias(k) for k, c in before.items()], *[F.first(c, ignorenulls=True).over(on).alias(k) for k, c in after.items()])
    if chunk is None:
        return near
    last = lambda c: F.max_by(F.when(c.isNotNull(), c), F.when(c.isNotNull(), F.col(position)))
    first = lambda c: F.min_by(F.when(c.isNotNull(), c), F.when(c.isNotNull(), F.col(position)))
    ends = rows.groupBy(*keys).agg(*[last(c).alias(f"_l_{k}") for k, c in before.items()], *[first(c).alias(f"_f_{k}") for k, c in after.items()])
    by = Window.partitionBy(*partition).orderBy("_chunk")
    earlier, later = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    carried = ends.select(*keys, *[F.last(f"_l_{k}", ignorenulls=True).over(earlier).alias(f"_c_{k}") for k in before], *[F.first(f"_f_{k}", ignorenulls=True).over(later).alias(f"_c_{k}") for k in after])
    same = None
    for k in keys:
        x = near[k].eqNullSafe(carried[k])
        same = x if same is None else same & x
    names = [*before, *after]
    return near.join(carried, same, "left").select(*[near[c] for c in df.columns], *[F.coalesce(near[k], carried[f"_c_{k}"]).alias(k) for k in names])


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, values: list[str], chunk=None) -> DataFrame:
    """Each left row with the values of the latest right row of its keys at or before it; null if there is none. Union and nearest neighbours
    instead of a range join; right rows of one moment should be unique. Both sides have keys and `at`. chunk: a function of the
    column `at` that cuts keys with many rows (see neighbors)."""
    l = left.select(*keys, at, F.struct(*[c for c in left.columns if c not in keys and c != at]).alias("_l"), F.lit(1).alias("_side"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_r"))
    r = right.select(*keys, at, F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), F.lit(0).alias("_side"), F.struct(*values).alias("_r"))
    both = l.unionByName(r).withColumn("_p", F.struct(at, "_side"))
    out = neighbors(both, keys, "_p", {"_v": F.col("_r")}, {}, None if chunk is None else chunk(F.col(at))).filter("_side = 1")
    return out.select(*keys, at, "_l.*", *[F.col(f"_v.{v}").alias(v) for v in values])


def range_join(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, width_days: int = 32) -> DataFrame:
    """Points with the half-open spans that hold them: spans are cut into buckets of days, so that the join has an equal key; the points of a hot
    key and bucket are spread."""
    bucket = lambda c: F.floor(F.unix_date(c) / width_days)
    last = F.date_sub(F.col(end), 1)
    cut_ = spans.withColumn("_b", F.explode(F.sequence(bucket(F.col(start)), bucket(last))))
    met = hot_join(points.withColumn("_b", bucket(F.col(at))), cut_, [*keys, "_b"])
    return met.filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_b")


def allocate(amount: Column, weight: Column, partition: list[str]) -> Column:
    """The row's share of amount by weight in its partition: even if all weights are 0; 0 if amount is null."""
    w = Window.partitionBy(*partition)
    total = F.sum(weight).over(w)
    return F.coalesce(F.when(total != 0, amount * weight / F.nullif(total, F.lit(0))).otherwise(amount / F.count(F.lit(1)).over(w)), F.lit(0))


def topk_array(df: DataFrame, group: list[str], value: str, amount: Column, k: int) -> DataFrame:
    """Per group the k values with the greatest summed amount, best first, ties by value; null values don't count. The ranks are cut
    before arrays are built, so an array never has more than k entries."""
    sums = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.sum(amount).alias("_a"))
    w = Window.partitionBy(*group).orderBy(F.col("_a").desc_nulls_last(), F.col(value))
    ranked = sums.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return ranked.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", value))), lambda x: x[value]).alias("top_values"))


def conform_dim(observed: DataFrame, seed: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """All observed and seeded keys once, with the seed's attributes or their defaults, and whether the key is observed and seeded."""
    keys = observed.select(key).unionByName(seed.select(key)).filter(F.col(key).isNotNull()).distinct()
    seen = observed.select(key).distinct().withColumn("is_observed", F.lit(True))
    known = seed.dropDuplicates([key]).withColumn("is_seeded", F.lit(True))
    out = keys.join(known, key, "left").join(seen, key, "left")
    return out.select(key, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()], F.coalesce("is_observed", F.lit(False)).alias("is_observed"), F.coalesce("is_seeded", F.lit(False)).alias("is_seeded"))


def late_flags(service: Column, received: Column, grace_days: int) -> dict[str, Column]:
    """lag_days, is_late (more than the grace, and of an earlier month) and impacted_period (first of the month)."""
    lag = F.datediff(received, service)
    late = F.coalesce((lag > grace_days) & (F.trunc(service, "month") < F.trunc(received, "month")), F.lit(False))
    return {"lag_days": lag, "is_late": late, "impacted_period": F.when(late, F.trunc(service, "month"))}


def restatement(df: DataFrame, period: str, amount: Column, late: str) -> DataFrame:
    """Per period: original, late and restated amounts, and the change in per cent (null where nothing was there before)."""
    zero = F.lit(0).cast("double")
    sums = df.groupBy(period).agg(F.sum(F.when(~F.col(late), amount).otherwise(zero)).alias("original_amount"), F.sum(F.when(F.col(late), amount).otherwise(zero)).alias("late_amount"), F.count_if(F.col(late)).alias("late_rows"))
    return sums.withColumn("restated_amount", F.col("original_amount") + F.col("late_amount")).withColumn("change_pct", F.col("late_amount") / F.nullif(F.col("original_amount"), zero) * 100)


def mode_by(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The commonest value of each key, ties by the least value; two aggregations, both with partial results."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_m")).select(*keys, F.col("_m.v").alias(value))


def overlap_pairs(df: DataFrame, keys: list[str], ident: str, start: str, end: str, width_days: int = 366) -> DataFrame:
    """All pairs of rows with the same keys whose half-open spans overlap (a.start < b.end and a.end > b.start), each once: keys, and ident,
    start and end of either row as _a and _b, a having the lesser ident. A null end is open and put out as 9999-12-31. Left out are rows with
    a null key, ident or start.

    Of two spans that overlap the one that starts later starts within the other, so starts are joined with the spans that hold them, by
    buckets of days; for the buckets a span ends after its key's last start, as an open one would have thousands."""
    rows = df.select(*keys, F.col(ident).alias("_i"), F.col(start).alias("_s"), F.coalesce(F.col(end), F.to_date(F.lit("9999-12-31"))).alias("_e")).filter("_i is not null and _s is not null")
    last = F.date_add(F.max("_s").over(Window.partitionBy(*keys)), 1)
    spans = rows.withColumn("_cap", F.least("_e", last)).filter("_e > _s").select(*keys, F.struct("_i", "_s", "_e").alias("_l"), F.col("_s").alias("_from"), "_cap")
    points = rows.select(*keys, F.struct("_i", "_s", "_e").alias("_r"), F.col("_s").alias("_at"))
    met = range_join(points, spans, keys, "_at", "_from", "_cap", width_days)
    # A span that ends before it starts overlaps those that hold both of its ends.
    met = met.filter("_l._s < _r._e and _l._i != _r._i and (_l._s < _r._s or _l._i < _r._i)")
    side = lambda x: [F.col(f"{x}.{c}") for c in ("_i", "_s", "_e")]
    first = F.col("_l._i") < F.col("_r._i")
    pair = [(F.when(first, l).otherwise(r), F.when(first, r).otherwise(l)) for l, r in zip(side("_l"), side("_r"))]
    return met.select(*keys, *[p[k].alias(f"{c}_{n}") for k, n in enumerate("ab") for p, c in zip(pair, (ident, start, end))])
