"""Read-only SQL for strangers: parsed by Spark's own parser, and checked on the plan rather than on the text."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Blocked(ValueError):
    """The statement may not run."""


#: Functions that a statement may call, by kind: those that compute a value from their arguments alone. (Spark has others that run code, read files or
#: tell about the cluster.)
FUNCTIONS = set(
    """
    count sum avg mean min max min_by max_by count_if bool_and bool_or every some any stddev stddev_pop stddev_samp variance var_pop var_samp corr median mode percentile
    percentile_approx approx_count_distinct collect_list collect_set array_agg first first_value last last_value any_value grouping grouping_id
    row_number rank dense_rank percent_rank cume_dist ntile lag lead nth_value
    abs ceil ceiling floor round bround sign signum sqrt power pow exp ln log log10 log2 mod pmod greatest least div try_divide try_add try_subtract try_multiply
    upper lower ucase lcase trim ltrim rtrim btrim length char_length substring substr left right lpad rpad replace translate concat concat_ws split split_part initcap reverse
    instr locate position contains startswith endswith like ilike rlike regexp regexp_like regexp_extract regexp_replace
    coalesce nvl nvl2 ifnull nullif nullifzero zeroifnull if isnull isnotnull
    year quarter month day dayofmonth dayofweek dayofyear weekday weekofyear hour minute second date date_add date_sub dateadd datediff date_diff months_between add_months last_day
    trunc date_trunc date_format to_date to_timestamp try_to_date try_to_timestamp make_date extract date_part current_date current_timestamp now
    int bigint smallint tinyint double float decimal string boolean timestamp cast
    array size cardinality element_at array_contains array_distinct array_join sort_array array_sort struct named_struct map explode
    and or not in between = == <=> != <> < <= > >= + - * / % & | ^ ~ || !
    """.split()
)

READS = {
    "Project", "Filter", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "Limit", "Join", "SubqueryAlias", "UnresolvedRelation", "UnresolvedWith", "CTERelationDef", "CTERelationRef", "WithCTE", "Union", "Distinct", "Except", "Intersect",
    "UnresolvedSubqueryColumnAliases", "OneRowRelation", "UnresolvedInlineTable", "UnresolvedHaving", "Generate", "Window", "WithWindowDefinition", "Deduplicate", "Offset", "Pivot", "UnresolvedOrdinal", "LateralJoin", "UnresolvedTableValuedFunction", "LocalRelation", "ResolvedInlineTable", "Tail", "Sample", "Expand",
}


def _called(e) -> str | None:
    """The function that an expression calls by name; None if it calls none. What names a function in a way that isn't known has a name that none has."""
    kind = e.getClass().getSimpleName()
    if kind == "UnresolvedFunction":
        return e.nameParts().mkString(".").lower()
    if kind == "UnresolvedGenerator":
        return e.name().unquotedString().lower()
    return f"<{kind}>" if "Function" in kind and kind != "LambdaFunction" or "Identifier" in kind or kind == "CallFunction" else None


def _nodes(plan, calls: list[str]):
    """All nodes of a parsed plan, those of subqueries and of WITH included. calls gets the names of all functions called."""
    todo = [plan]
    while todo:
        p = todo.pop()
        yield p
        for seq in (p.children(), p.innerChildren()):
            it = seq.iterator()
            while it.hasNext():
                x = it.next()
                if hasattr(x, "nodeName"):
                    todo.append(x)
        it = p.expressions().iterator()
        while it.hasNext():
            stack = [it.next()]
            while stack:
                e = stack.pop()
                if called := _called(e):
                    calls.append(called)
                name = e.getClass().getSimpleName()
                if "Subquery" in name or name in ("Exists", "InSubquery", "ListQuery", "LateralSubquery"):
                    try:
                        todo.append(e.plan())
                    except Exception:  # an IN whose query is a child of its own
                        pass
                kids = e.children().iterator()
                while kids.hasNext():
                    stack.append(kids.next())


def check(spark: SparkSession, sql: str, allow: set[str], forbid_star: bool = True) -> list[str]:
    """The relations that a statement reads. Raises Blocked unless it is one SELECT (or WITH ... SELECT) that reads nothing but relations of
    `allow` (lower case, qualified or not as they are to be named), has no SELECT *, calls none but FUNCTIONS and no table function."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise Blocked("it doesn't parse as one statement: " + str(e).split("\n")[0][:200]) from None
    read, defined, calls = [], set(), []
    for p in _nodes(plan, calls):
        kind = p.nodeName()
        kind = re.sub(r"^'", "", kind)
        if kind not in READS:
            raise Blocked(f"{kind} isn't a read")
        if kind == "UnresolvedTableValuedFunction":
            raise Blocked("table functions may not be called")
        if kind == "UnresolvedWith":
            it = p.cteRelations().iterator()
            while it.hasNext():
                defined.add(it.next()._1().lower())
        if kind == "UnresolvedRelation":
            read.append(p.tableName().replace("`", "").lower())
        if forbid_star and kind == "Project":
            it = p.projectList().iterator()
            while it.hasNext():
                if it.next().getClass().getSimpleName().startswith("UnresolvedStar"):
                    raise Blocked("SELECT * names no columns")
    if unknown := sorted({c for c in calls if c not in FUNCTIONS}):
        raise Blocked(f"functions that may not be called: {', '.join(unknown)}")
    read = sorted(set(read) - defined)
    bad = [r for r in read if r not in allow]
    if bad:
        raise Blocked(f"not allowed: {', '.join(bad)}")
    return read


@dataclass(frozen=True)
class Answer:
    """rows: at most as many as were allowed; truncated: whether there were more."""

    rows: DataFrame
    truncated: bool


def answer(spark: SparkSession, sql: str, allow: set[str], max_rows: int = 1000, audit: list | None = None) -> Answer:
    """Runs the statement if check() lets it pass. No more than max_rows rows leave Spark, whatever limit it has itself. audit gets (sql, status SUCCESS,
    BLOCKED or ERROR, reason, seconds) once the statement has run, or has been refused or failed."""
    began, status, reason = time.time(), "SUCCESS", None
    try:
        check(spark, sql, allow)
        df = spark.sql(sql)
        rows = df.limit(max_rows + 1).collect()
        return Answer(spark.createDataFrame(rows[:max_rows], df.schema), len(rows) > max_rows)
    except Blocked as e:
        status, reason = "BLOCKED", str(e)
        raise
    except Exception as e:
        status, reason = "ERROR", str(e)[:500]
        raise
    finally:
        if audit is not None:
            audit.append((sql, status, reason, round(time.time() - began, 3)))


def guarded_sql(spark: SparkSession, sql: str, allow: set[str], max_rows: int = 1000, audit: list | None = None) -> DataFrame:
    """The rows of answer()."""
    return answer(spark, sql, allow, max_rows, audit).rows


def audit_frame(spark: SparkSession, audit: list) -> DataFrame:
    return spark.createDataFrame(audit, "sql string, status string, reason string, seconds double").withColumn("logged_at", F.current_timestamp())
