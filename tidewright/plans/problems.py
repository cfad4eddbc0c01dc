"""The pN_ queries of the general problems, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.expr import micros, norm_id
from tidewright.operators import changefeed, delivery, intervals, lateness, malformed, nested, orphans
from tidewright.session import lookup_side, scratch
from tidewright.sources import tables
from tidewright.streaming import feeds


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# 1. changes


def claim_changes(spark: SparkSession, sf: str) -> DataFrame:
    """fact_claim_line as changes of claims (see changefeed.apply_changes)."""
    ending = changefeed.flagged_codes(table(spark, sf, "ref_claim_status"), "status_code", ["is_void", "is_reversal"])
    return (
        table(spark, sf, "fact_claim_line")
        .select(norm_id("claim_id").alias("entity"), norm_id("claim_line_id").alias("row"), F.col("claim_version").alias("version"), F.col("source_extract_ts").alias("ts"), norm_id("claim_status").alias("code"), F.col("change_id").alias("ord"))
        .join(lookup_side(ending.withColumn("_ends", F.lit(True))), "code", "left")
        .select("entity", "row", "version", "ts", F.coalesce("_ends", F.lit(False)).alias("ends"), "ord")
    )


def _in_force(out: DataFrame) -> DataFrame:
    return out.select(F.col("entity").alias("claim_id"), F.col("row").alias("claim_line_id"), F.col("version").alias("claim_version"), F.col("ord").alias("change_id"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """The feed in two batches, as it arrived: the later half against the base that the earlier half left."""
    changes = claim_changes(spark, sf)
    first, last = table(spark, sf, "fact_claim_line").agg(F.min("change_id"), F.max("change_id")).first()
    middle = ((first or 0) + (last or 0)) // 2
    return _in_force(changefeed.apply_changes(changes, batches=F.when(F.col("ord") <= middle, 0).otherwise(1), parts=2))


def p1_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The feed in four batches that have nothing to do with its order."""
    return _in_force(changefeed.apply_changes(claim_changes(spark, sf), batches=F.pmod(F.xxhash64("ord"), F.lit(4)).cast("int"), parts=4))


P1_SQL = """
WITH s AS (SELECT upper(trim(status_code, ' \t\r\n')) AS code, bool_or(coalesce(is_void, false) OR coalesce(is_reversal, false)) AS ends FROM ref_claim_status GROUP BY 1),
f AS (SELECT upper(trim(claim_id, ' \t\r\n')) AS claim_id, nullif(upper(trim(claim_line_id, ' \t\r\n')), '') AS claim_line_id, coalesce(claim_version, 0) AS v, source_extract_ts AS ts, change_id, coalesce(s.ends, false) AS ends
      FROM fact_claim_line LEFT JOIN s ON upper(trim(claim_status, ' \t\r\n')) = s.code WHERE trim(claim_id, ' \t\r\n') <> ''),
t AS (SELECT * FROM f QUALIFY v = max(v) OVER (PARTITION BY claim_id)),
u AS (SELECT *, rank() OVER (PARTITION BY claim_id ORDER BY ts DESC NULLS LAST) AS r FROM t),
w AS (SELECT *, bool_or(ends AND r = 1) OVER (PARTITION BY claim_id) AS over FROM u)
SELECT claim_id, claim_line_id, v AS claim_version, change_id FROM w WHERE NOT over AND NOT ends AND claim_line_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY claim_id, claim_line_id ORDER BY ts DESC NULLS LAST, change_id) = 1
"""


# 2. deliveries


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """br_raw_claim_event with the identity that natural_key and payload_hash state, however they are written."""
    key = F.btrim("natural_key", F.lit(" \t\r\n"))
    as_json = key.startswith("{")
    v = F.try_parse_json(F.when(as_json, key))
    stated = F.when(as_json, norm_id(F.try_variant_get(v, "$.claim_id", "string"))).otherwise(norm_id(F.regexp_extract(key, r"^([^|]*)", 1)))
    version = F.when(as_json, F.try_variant_get(v, "$.claim_version", "string")).otherwise(F.regexp_extract(key, r"\|\s*([0-9]+)\s*$", 1)).try_cast("int")
    stated_hash = F.lower(F.regexp_replace(F.btrim("payload_hash", F.lit(" \t\r\n")), r"^(?i)sha-?256\s*[:=]\s*", ""))
    text = F.coalesce(stated_hash, F.sha2("payload", 256))
    digest = F.when(text.rlike("^[0-9a-f]{64}$"), F.unhex(text)).otherwise(F.encode(text, "UTF-8"))  # what is no digest stands for itself
    return table(spark, sf, "br_raw_claim_event").select(
        "bronze_event_id",
        stated.alias("claim_id"),
        version.alias("claim_version"),
        digest.alias("digest"),
        "source_extract_ts",
        "ingest_ts",
    )


def latest_first(column: str):
    """Orders the latest first and nulls last, as an ascending number."""
    return F.coalesce(-micros(column), F.lit((1 << 63) - 1))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """The landed messages accepted in two epochs, the newer extracts first, as of a message's copies the one of the latest extract is kept."""
    rows = messages(spark, sf)
    first, last = table(spark, sf, "br_raw_claim_event").agg(F.min(micros("source_extract_ts")), F.max(micros("source_extract_ts"))).first()
    width = ((last or 0) - (first or 0)) // 2 + 1
    age = ((F.lit(last or 0) - micros("source_extract_ts")) / width).cast("int")
    return delivery.surplus(rows, ["claim_id", "claim_version", "digest"], [latest_first("source_extract_ts"), latest_first("ingest_ts")], "bronze_event_id", rank=F.coalesce(age, F.lit(1)), parts=2)


P2_SQL = r"""
WITH m AS (SELECT bronze_event_id, source_extract_ts, ingest_ts,
  CASE WHEN trim(natural_key, ' ') LIKE '{%' THEN upper(trim(json_extract_string(natural_key, '$.claim_id'))) ELSE upper(trim(split_part(natural_key, '|', 1))) END AS c,
  CASE WHEN trim(natural_key, ' ') LIKE '{%' THEN TRY_CAST(json_extract_string(natural_key, '$.claim_version') AS INT) ELSE TRY_CAST(trim(split_part(natural_key, '|', 2)) AS INT) END AS v,
  coalesce(lower(regexp_replace(trim(payload_hash), '^(?i)sha-?256:', '')), sha256(payload)) AS d
  FROM br_raw_claim_event)
SELECT bronze_event_id FROM m
QUALIFY row_number() OVER (PARTITION BY c, v, d ORDER BY source_extract_ts DESC NULLS LAST, ingest_ts DESC NULLS LAST, bronze_event_id) > 1
"""


# 3. records that don't parse

#: The columns of the claim extract (fixed values of the feed).
CLAIM_EXTRACT = (
    malformed.Column("source_system"),
    malformed.Column("source_extract_ts", required=True, timestamp=True),
    malformed.Column("event_type", values=("CLAIM",)),
    malformed.Column("business_event_ts", timestamp=True),
    malformed.Column("claim_id", required=True),
    malformed.Column("claim_version", pattern="[0-9]{1,9}"),
    malformed.Column("member_id"),
    malformed.Column("paid_amount", pattern=r"-?[0-9]{1,12}(?:\.[0-9]{1,2})?"),
    malformed.Column("record_status", values=("LANDED", "QUARANTINED", "SUPERSEDED")),
    malformed.Column("quarantine_reason"),
    malformed.Column("batch_id"),
    malformed.Column("note"),
)


def claim_records(spark: SparkSession, sf: str) -> DataFrame:
    return malformed.read_records(table(spark, sf, "raw_claim_record"), "raw_text", ["record_id"], CLAIM_EXTRACT)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return claim_records(spark, sf).filter("reason is not null").select("record_id", "reason")


def p3_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that can land, typed."""
    out = claim_records(spark, sf).filter("reason is null")
    return out.select("record_id", "claim_id", F.col("claim_version").cast("int").alias("claim_version"), "member_id", F.col("paid_amount").cast("decimal(18,2)").alias("paid_amount"), "record_status", "quarantine_reason", "batch_id", "note")


_FIELD = r'(?:[^",]*|"(?:[^"]|"")*")'
_P3_BASE = rf"""
WITH g AS (SELECT record_id, raw_text, regexp_full_match(raw_text, '{_FIELD}(?:,{_FIELD})*') AS ok FROM raw_claim_record),
p AS (SELECT *, list_transform(regexp_extract_all(raw_text || ',', '({_FIELD}),', 1), lambda x: CASE WHEN x LIKE '"%' THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END) AS f FROM g),
n AS (SELECT record_id, ok, len(f) AS k, list_transform(f, lambda x: CASE WHEN trim(x, e' \t\r\n') IN ('', 'NULL', 'null') THEN NULL ELSE trim(x, e' \t\r\n') END) AS v FROM p),
r AS (SELECT record_id, v, CASE WHEN ok IS NOT TRUE AND k IS NOT NULL THEN 'QUOTING' WHEN k IS NULL OR k <> 12 THEN 'COLUMN_COUNT'
  WHEN v[5] IS NULL OR v[2] IS NULL OR v[3] IS DISTINCT FROM 'CLAIM' OR coalesce(v[9], '') NOT IN ('LANDED', 'QUARANTINED', 'SUPERSEDED')
   OR NOT coalesce(regexp_full_match(v[6], '[0-9]{{1,9}}'), true) OR NOT coalesce(regexp_full_match(v[8], '-?[0-9]{{1,12}}(\.[0-9]{{1,2}})?'), true)
   OR NOT (regexp_full_match(v[2], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\.[0-9]{{1,6}})?(Z|[+-](0[0-9]|1[0-4]):[0-5][0-9])?') AND try_strptime(replace(left(v[2], 19), 'T', ' '), '%Y-%m-%d %H:%M:%S') IS NOT NULL)
   OR NOT (v[4] IS NULL OR (regexp_full_match(v[4], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\.[0-9]{{1,6}})?(Z|[+-](0[0-9]|1[0-4]):[0-5][0-9])?') AND try_strptime(replace(left(v[4], 19), 'T', ' '), '%Y-%m-%d %H:%M:%S') IS NOT NULL))
  THEN 'INVALID_VALUE' END AS reason FROM n)
"""
P3_SQL = _P3_BASE + "SELECT record_id, reason FROM r WHERE reason IS NOT NULL"
P3_LANDED_SQL = (
    _P3_BASE
    + "SELECT record_id, v[5] AS claim_id, v[6]::INT AS claim_version, v[7] AS member_id, v[8]::DECIMAL(18,2) AS paid_amount, v[9] AS record_status, v[10] AS quarantine_reason, v[11] AS batch_id, v[12] AS note FROM r WHERE reason IS NULL"
)


# 4. orphans


PARENTS = (("member_id", "dim_patient"), ("plan_id", "dim_plan"), ("payer_id", "dim_payer"))
REFERRERS = (("fact_claim_line", "change_id"), ("eligibility_event", "eligibility_event_id"))


def claim_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """The orphans that a ledger holds after two batches, as references and parents arrived: until the middle of the claims' arrivals, and after it."""
    first, last = table(spark, sf, "fact_claim_line").agg(F.min("created_at"), F.max("created_at")).first()
    middle = first + (last - first) / 2 if first else None
    ledger = orphans.OrphanLedger(spark, scratch(spark, "ledger"))
    out = None
    for seq, (since, until) in enumerate([(None, middle), (middle, None)] if middle else [(None, None)]):
        late = F.col("created_at") > F.lit(middle)
        arrived = F.lit(True) if not middle else late if since else ~F.coalesce(late, F.lit(False))
        refs = [orphans.references_of(table(spark, sf, name).filter(arrived), name, row_id, "created_at", [f for f, _ in PARENTS]) for name, row_id in REFERRERS]
        events = [orphans.parent_events(table(spark, sf, name), field, field, "is_current", "created_at", since, until) for field, name in PARENTS]
        out = ledger.advance(reduce(DataFrame.unionByName, refs), reduce(DataFrame.unionByName, events).withColumn("seq", F.lit(seq)))
    return out


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return claim_orphans(spark, sf).select("table_name", "row_id", "field", "reason", "period")


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.snapshot(claim_orphans(spark, sf))


_P4_BASE = """
WITH i AS (
  SELECT 'member_id' AS field, upper(trim(member_id)) AS id, bool_or(coalesce(is_current, false)) AS cur, min(created_at) AS first FROM dim_patient WHERE trim(member_id) <> '' GROUP BY 2
  UNION ALL SELECT 'plan_id', upper(trim(plan_id)), bool_or(coalesce(is_current, false)), min(created_at) FROM dim_plan WHERE trim(plan_id) <> '' GROUP BY 2
  UNION ALL SELECT 'payer_id', upper(trim(payer_id)), bool_or(coalesce(is_current, false)), min(created_at) FROM dim_payer WHERE trim(payer_id) <> '' GROUP BY 2),
r AS (
  SELECT 'fact_claim_line' AS table_name, change_id AS row_id, unnest(['member_id', 'plan_id', 'payer_id']) AS field, unnest([member_id, plan_id, payer_id]) AS id, created_at FROM fact_claim_line
  UNION ALL SELECT 'eligibility_event', eligibility_event_id, unnest(['member_id', 'plan_id', 'payer_id']), unnest([member_id, plan_id, payer_id]), created_at FROM eligibility_event),
o AS (SELECT table_name, row_id, r.field, CASE WHEN i.id IS NULL THEN 'missing' WHEN NOT cur THEN 'deleted' WHEN first > created_at THEN 'late' END AS reason, strftime(created_at, '%Y-%m') AS period
  FROM r LEFT JOIN i ON r.field = i.field AND upper(trim(r.id)) = i.id WHERE trim(r.id) <> '')
"""
P4_SQL = _P4_BASE + "SELECT * FROM o WHERE reason IS NOT NULL"
P4_REPORT_SQL = _P4_BASE + "SELECT table_name, period, field, reason, count(*) AS orphans FROM o WHERE reason IS NOT NULL GROUP BY ALL"


# 5. nested records

CLAIM_CHILDREN = [nested.Child("line", "lines", "claim_line_id"), nested.Child("diagnosis", "diagnoses", "diagnosis_code"), nested.Child("procedure", "procedures", "procedure_code")]
MEMBER_CHILDREN = [nested.Child("demographics", "", "zip3")]
X12_CHILDREN = [nested.Child("segment", "segments", "_segment", "claim_seq")]


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name, key, text, children in (
        ("br_raw_claim_event", "bronze_event_id", "payload", CLAIM_CHILDREN),
        ("eligibility_event", "eligibility_event_id", "demographics", MEMBER_CHILDREN),
        ("br_raw_x12_claim_json", "bronze_event_id", "payload", X12_CHILDREN),
    ):
        rows = nested.explode_children(table(spark, sf, name), key, text, children).select(F.lit(name).alias("source_table"), "record_key", "child", "parent_seq", "pos", "child_key")
        out = rows if out is None else out.unionByName(rows)
    return out


#: The fields of the flat tables: type by name.
CHILD_FIELDS = {
    "p5_lines": ("br_raw_claim_event", "bronze_event_id", "payload", CLAIM_CHILDREN[0], {"line_number": "int", "procedure_code": "string", "service_date": "date", "units": "int", "charge_amount": "decimal(18,2)", "paid_amount": "decimal(18,2)"}),
    "p5_diagnoses": ("br_raw_claim_event", "bronze_event_id", "payload", CLAIM_CHILDREN[1], {"diagnosis_position": "int", "diagnosis_type": "string"}),
    "p5_procedures": ("br_raw_claim_event", "bronze_event_id", "payload", CLAIM_CHILDREN[2], {"procedure_position": "int", "procedure_date": "date"}),
    "p5_demographics": ("eligibility_event", "eligibility_event_id", "demographics", MEMBER_CHILDREN[0], {"birth_year": "int", "gender": "string", "state": "string"}),
}


def _flat(name: str) -> Callable[[SparkSession, str], DataFrame]:
    source, key, text, child, fields = CHILD_FIELDS[name]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = nested.child_table(table(spark, sf, source), key, text, child, fields)
        return out.withColumns({f: F.col(f).cast("double") for f, t in fields.items() if t.startswith("decimal")})

    run.__doc__ = f"The flat table of {child.name} objects, over all records."
    return run


def _forms(text: str) -> str:
    """SQL: the entries of JSON text that may be an array, an object, or a string holding either, as a list."""
    opened = f"CASE WHEN json_type({text}) = 'VARCHAR' THEN CASE WHEN json_valid({text}->>'$') THEN ({text}->>'$')::JSON END ELSE {text} END"
    return f"CASE json_type({opened}) WHEN 'ARRAY' THEN from_json({opened}, '[\"json\"]') WHEN 'OBJECT' THEN [{opened}] END"


def _child_sql(name: str, key: str, text: str, child: nested.Child, fields: dict[str, str] | None = None) -> str:
    parent = f"coalesce(TRY_CAST(e->>'$.{child.parent}' AS INT), 0)" if child.parent else "0"
    roots = f"SELECT {key}::VARCHAR AS record_key, unnest({_forms('v')}) AS r, generate_subscripts({_forms('v')}, 1) - 1 AS p FROM (SELECT {key}, CASE WHEN json_valid({text}) THEN {text}::JSON END AS v FROM {name})"
    inner = f"SELECT record_key, r AS e, p FROM ({roots})" if not child.path else f"SELECT record_key, unnest({_forms('c')}) AS e, generate_subscripts({_forms('c')}, 1) - 1 AS p FROM (SELECT record_key, r->'$.{child.path}' AS c FROM ({roots}))"
    if fields is not None:
        typed = ", ".join(f"TRY_CAST(e->>'$.{f}' AS {'VARCHAR' if t == 'string' else t}){'::DOUBLE' if t.startswith('decimal') else ''} AS {f}" for f, t in fields.items())
        return f"SELECT record_key, {parent} AS parent_seq, p::INT AS pos, coalesce(e->>'$.{child.key}', '') AS child_key, {typed} FROM ({inner}) WHERE json_type(e) = 'OBJECT'"
    return f"SELECT '{name}' AS source_table, record_key, '{child.name}' AS child, {parent} AS parent_seq, p::INT AS pos, coalesce(e->>'$.{child.key}', '') AS child_key FROM ({inner}) WHERE json_type(e) = 'OBJECT'"


P5_SQL = " UNION ALL ".join(
    [_child_sql("br_raw_claim_event", "bronze_event_id", "payload", c) for c in CLAIM_CHILDREN]
    + [_child_sql("eligibility_event", "eligibility_event_id", "demographics", c) for c in MEMBER_CHILDREN]
    + [_child_sql("br_raw_x12_claim_json", "bronze_event_id", "payload", c) for c in X12_CHILDREN]
)


# 6. late events

ARRIVED = ["ingest_ts", "source_extract_ts"]


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.late_rows(table(spark, sf, "br_raw_claim_event"), "bronze_event_id", "business_event_ts", ARRIVED).filter("outcome <> 'on_time'")


def p6_months(spark: SparkSession, sf: str) -> DataFrame:
    """The months' counts: as first reported, as corrected, and beyond the cut-off."""
    return lateness.monthly_counts(table(spark, sf, "br_raw_claim_event"), "business_event_ts", ARRIVED)


def p6_batches(spark: SparkSession, sf: str) -> DataFrame:
    """As p6_months, of a table of partials that four batches, which have nothing to do with the order of arrival, added to."""
    rows = table(spark, sf, "br_raw_claim_event").select("bronze_event_id", "business_event_ts", *ARRIVED)
    log = lateness.MonthLog(tables.Table(spark, scratch(spark, "months")))
    for k in range(4):
        log.advance(rows.filter(F.pmod(F.xxhash64("bronze_event_id"), F.lit(4)) == k), "business_event_ts", ARRIVED)
    return log.months()


_P6_BASE = """
WITH e AS (SELECT bronze_event_id, business_event_ts AS b, coalesce(ingest_ts, source_extract_ts) AS a, date_trunc('month', business_event_ts) + INTERVAL 1 MONTH AS e FROM br_raw_claim_event),
o AS (SELECT bronze_event_id, strftime(b, '%Y-%m') AS period, CASE WHEN a >= e + INTERVAL 90 DAY THEN 'too_late' WHEN a >= e + INTERVAL 7 DAY THEN 'correction' ELSE 'on_time' END AS outcome FROM e WHERE a IS NOT NULL AND b IS NOT NULL)
"""
P6_SQL = _P6_BASE + "SELECT * FROM o WHERE outcome <> 'on_time'"
P6_MONTHS_SQL = (
    _P6_BASE
    + "SELECT period, count(*) FILTER (outcome = 'on_time') AS reported, count(*) FILTER (outcome = 'correction') AS corrections, count(*) FILTER (outcome <> 'too_late') AS corrected, count(*) FILTER (outcome = 'too_late') AS too_late FROM o GROUP BY 1"
)


# 7. intervals


def coverage_rows(rows: DataFrame) -> DataFrame:
    return rows.select(norm_id("member_id").alias("member_id"), norm_id("plan_id").alias("plan_id"), F.least("coverage_start_date", "retro_effective_date").alias("start"), F.col("coverage_end_date").alias("end"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merge_intervals(coverage_rows(table(spark, sf, "eligibility_event")), ["member_id", "plan_id"], "start", "end")


def p7_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The coverages as a stream in four micro-batches that have nothing to do with their order, the maps held in keyed state."""
    path, out = scratch(spark, "coverages"), tables.Table(spark, scratch(spark, "periods"))
    rows = table(spark, sf, "eligibility_event").select("eligibility_event_id", "member_id", "plan_id", "coverage_start_date", "retro_effective_date", "coverage_end_date")
    for k in range(4):
        rows.filter(F.pmod(F.xxhash64("eligibility_event_id"), F.lit(4)) == k).coalesce(1).write.mode("append").parquet(path)
    periods = feeds.merged_periods(coverage_rows(feeds.read_feed(spark, path, rows.schema, 1)), ["member_id", "plan_id"], "start", "end")
    q = periods.writeStream.outputMode("update").foreachBatch(lambda b, _: out.upsert(b, ["member_id", "plan_id"]) and None)
    q.option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return out.read().select("member_id", "plan_id", F.inline("spans"))


P7_SQL = """
WITH r AS (SELECT upper(trim(member_id)) AS m, upper(trim(plan_id)) AS p, least(coverage_start_date, retro_effective_date) AS s, coalesce(coverage_end_date, DATE '9999-12-31') AS e FROM eligibility_event WHERE trim(member_id) <> '' AND trim(plan_id) <> ''),
f AS (SELECT *, max(e) OVER (PARTITION BY m, p ORDER BY s RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS before FROM r WHERE s IS NOT NULL AND e > s),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY m, p ORDER BY s RANGE UNBOUNDED PRECEDING) AS k FROM f),
q AS (SELECT m, p, k, min(s) AS s, max(e) AS e FROM i GROUP BY 1, 2, 3),
g AS (SELECT m, p, e AS s, lead(s) OVER (PARTITION BY m, p ORDER BY s) AS e FROM q)
SELECT m AS member_id, p AS plan_id, 'period' AS kind, strftime(s, '%Y-%m-%d') AS start_date, strftime(e, '%Y-%m-%d') AS end_date FROM q
UNION ALL SELECT m, p, 'gap', strftime(s, '%Y-%m-%d'), strftime(e, '%Y-%m-%d') FROM g WHERE e IS NOT NULL
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_batches": p1_batches,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_landed": p3_landed,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p5_found": p5_found,
    **{name: _flat(name) for name in CHILD_FIELDS},
    "p6_found": p6_found,
    "p6_months": p6_months,
    "p6_batches": p6_batches,
    "p7_found": p7_found,
    "p7_stream": p7_stream,
}
SQL = {
    "p1_found": P1_SQL,
    "p1_batches": P1_SQL,
    "p2_found": P2_SQL,
    "p3_found": P3_SQL,
    "p3_landed": P3_LANDED_SQL,
    "p4_found": P4_SQL,
    "p4_report": P4_REPORT_SQL,
    "p5_found": P5_SQL,
    **{name: _child_sql(*spec) for name, spec in CHILD_FIELDS.items()},
    "p6_found": P6_SQL,
    "p6_months": P6_MONTHS_SQL,
    "p6_batches": P6_MONTHS_SQL,
    "p7_found": P7_SQL,
    "p7_stream": P7_SQL,
}
