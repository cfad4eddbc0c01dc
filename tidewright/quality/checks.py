"""Checks: each returns the violating rows (empty means passed). Null values pass unless a check says otherwise."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(~F.col(column).isin(values))


def relationships(df: DataFrame, column: str, to: DataFrame, to_column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).join(to.select(F.col(to_column).alias(column)), column, "left_anti")


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return df.filter(bad)


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    e = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~e)


def not_future_date(df: DataFrame, column: str, as_of: str, allowance_days: int = 0) -> DataFrame:
    return df.filter(F.col(column) > F.date_add(F.to_date(F.lit(as_of)), allowance_days))


def recency(df: DataFrame, column: str, as_of: str, hours: int) -> DataFrame:
    newest = df.agg(F.max(column).cast("timestamp").alias("newest"))
    return newest.filter(F.coalesce(F.col("newest") < F.lit(as_of).cast("timestamp") - F.expr(f"interval {hours} hours"), F.lit(True)))


def nonnegative_unless(df: DataFrame, column: str, excused: Column) -> DataFrame:
    return df.filter((F.col(column) < 0) & ~F.coalesce(excused, F.lit(False)))


def header_line_reconciliation(headers: DataFrame, lines: DataFrame, key: str, header_amount: str, line_amount: str, tolerance: float) -> DataFrame:
    """Headers whose amount differs from the sum of their lines (0 if none) by more than the tolerance."""
    sums = lines.groupBy(key).agg(F.sum(line_amount).alias("line_total"))
    out = headers.select(key, F.col(header_amount).alias("header_total")).join(sums, key, "left").withColumn("line_total", F.coalesce("line_total", F.lit(0.0)))
    return out.filter(F.abs(F.col("header_total") - F.col("line_total")) > tolerance)


def chain_violations(df: DataFrame, key: str, chain: str, version: str, amount: str, reversal: Column, original: str) -> DataFrame:
    """(chain, version, violation): VERSION_REPEATED, REVERSAL_EXCEEDS_PRIOR (a reversal takes more than was paid before),
    DANGLING_ORIGINAL (the original named is no key of the table)."""
    w = Window.partitionBy(chain).orderBy(F.col(version).asc_nulls_first(), key)
    prior = F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    again = F.count(F.lit(1)).over(Window.partitionBy(chain, version)) > 1
    rows = df.select(chain, version, F.when(again, "VERSION_REPEATED").alias("a"), F.when(reversal & (-F.col(amount) > prior), "REVERSAL_EXCEEDS_PRIOR").alias("b"))
    found = rows.select(chain, version, F.explode(F.array_compact(F.array("a", "b"))).alias("violation"))
    dangling = df.filter(F.col(original).isNotNull()).join(df.select(F.col(key).alias(original)).distinct(), original, "left_anti").select(chain, version, F.lit("DANGLING_ORIGINAL").alias("violation"))
    return found.unionByName(dangling)


def one_current_per_key(df: DataFrame, key: str, current: str) -> DataFrame:
    return df.filter(F.col(current)).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    severity: str  # warn or error
    failing: Callable[[DataFrame], DataFrame]
    where: str = "true"
    store: str | None = None  # path that failing rows are written to
    extra: dict = field(default_factory=dict)


def run_checks(spark: SparkSession, checks: list[Check], tables: dict[str, DataFrame], run_id: str, run_at: str) -> DataFrame:
    """A row per check: run_id, run_at, check_name, table_name, severity, failing_rows, status (PASS, WARN, ERROR). The counts stay in
    Spark: one small aggregate per check, united."""
    out = None
    for c in checks:
        bad = c.failing(tables[c.table].filter(c.where))
        if c.store:
            bad.write.mode("overwrite").parquet(c.store)
        row = bad.agg(F.count("*").alias("failing_rows")).select(
            F.lit(run_id).alias("run_id"), F.lit(run_at).cast("timestamp_ntz").alias("run_at"), F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"), F.lit(c.severity).alias("severity"),
            "failing_rows", F.when(F.col("failing_rows") == 0, "PASS").otherwise(c.severity.upper()).alias("status"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def scorecard(results: DataFrame) -> DataFrame:
    """Per table and check the latest run with the one before it: pass rate of the table's latest checks and the trend NEW, IMPROVING, REGRESSING or
    STABLE. results: table_name, check_name, run_at, failing_rows. One window, then a conditional aggregation instead of a self join."""
    w = Window.partitionBy("table_name", "check_name").orderBy(F.col("run_at").desc_nulls_last())
    two = results.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    both = two.groupBy("table_name", "check_name").agg(F.max(F.when(F.col("_rn") == 1, F.col("failing_rows"))).alias("latest_failing"), F.max(F.when(F.col("_rn") == 2, F.col("failing_rows"))).alias("prior_failing"))
    trend = F.when(F.col("prior_failing").isNull(), "NEW").when(F.col("latest_failing") < F.col("prior_failing"), "IMPROVING").when(F.col("latest_failing") > F.col("prior_failing"), "REGRESSING").otherwise("STABLE")
    passed = F.count_if(F.col("latest_failing") == 0).over(Window.partitionBy("table_name"))
    return both.withColumn("trend", trend).withColumn("pass_rate", F.round(passed / F.count(F.lit(1)).over(Window.partitionBy("table_name")), 4))
