"""Checks over rows some of which are wrong on purpose, ledgers, and what else of the sources, dimensions and feeds has a query of its own."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewright.functions import expr as E
from tidewright.operators import nested
from tidewright.operators import relational as R
from tidewright.plans import reference
from tidewright.plans.claims import _BRONZE, bronze_claim, claim_version
from tidewright.plans.problems import CLAIM_CHILDREN, table
from tidewright.plans.reference import AS_OF, _event_stream, _forms, claims, member_months, query
from tidewright.quality import checks, runs
from tidewright.session import lookup_side, scratch
from tidewright.sources import readers, tables
from tidewright.streaming import feeds

# checks that find something

_CHAIN = """k AS (SELECT change_id::VARCHAR AS key, upper(trim(claim_id)) AS chain, claim_version AS version, coalesce(paid_amount, 0) * CASE WHEN claim_type = 'VISION' THEN -9 ELSE 1 END AS amount, claim_type = 'VISION' AS rev,
 CASE WHEN change_id % 97 = 0 THEN 'gone-' || change_id::VARCHAR WHEN change_id % 89 = 0 THEN (change_id - 1)::VARCHAR END AS original FROM fact_claim_line WHERE trim(claim_id) <> '')"""


@query(f"""WITH {_CHAIN}, w AS (SELECT *, count(*) OVER (PARTITION BY chain, version) AS again, coalesce(sum(amount) OVER (PARTITION BY chain ORDER BY version NULLS FIRST, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM k)
SELECT chain, version, 'VERSION_REPEATED' AS violation FROM w WHERE again > 1 UNION ALL SELECT chain, version, 'REVERSAL_EXCEEDS_PRIOR' FROM w WHERE rev AND -amount > prior UNION ALL SELECT chain, version, 'DANGLING_ORIGINAL' FROM k WHERE original IS NOT NULL AND original NOT IN (SELECT key FROM k)""")
def dq10_all_violations(spark, sf):
    """Chains with violations of all three kinds, planted into the claim lines."""
    vision = F.coalesce(F.col("claim_type") == "VISION", F.lit(False))
    rows = claims(spark, sf).select(
        F.col("change_id").cast("string").alias("key"), E.norm_id("claim_id").alias("chain"), F.col("claim_version").alias("version"), (F.coalesce("paid_amount", F.lit(0)) * F.when(vision, -9).otherwise(1)).alias("amount"), vision.alias("rev"),
        F.when(F.col("change_id") % 97 == 0, F.concat(F.lit("gone-"), "change_id")).when(F.col("change_id") % 89 == 0, (F.col("change_id") - 1).cast("string")).alias("original"),
    ).filter("chain is not null")
    return checks.chain_violations(rows, "key", "chain", "version", "amount", F.col("rev"), "original")


_LATE = "l AS (SELECT date_trunc('month', service_to_date)::DATE AS m FROM fact_claim_line WHERE coalesce(datediff('day', service_to_date, created_at::DATE) > 7 AND date_trunc('month', service_to_date) < date_trunc('month', created_at), false))"


@query(f"WITH {_LATE} SELECT m AS impacted_period, count(*) AS late_rows FROM l WHERE month(m) = 5 GROUP BY 1")
def dq14_late_capture(spark, sf):
    """Periods with late lines that the report of late arrivals lacks: it was made without those of May."""
    late = claims(spark, sf).withColumns(R.late_flags(F.col("service_to_date"), F.to_date("created_at"), 7)).filter("is_late")
    report = late.filter(F.month("impacted_period") != 5).groupBy("impacted_period").agg(F.count("*").alias("n"))
    return late.join(report, "impacted_period", "left_anti").groupBy("impacted_period").agg(F.count("*").alias("late_rows"))


@query(f"WITH {reference._MONTHS}, f AS (SELECT p, month, count(*) AS expected FROM mm GROUP BY 1, 2), g AS (SELECT p, month, count(*) AS reported FROM mm WHERE NOT (month(month) = 3 AND p LIKE '%1') GROUP BY 1, 2) SELECT f.p AS plan_id, f.month, expected, coalesce(reported, 0) AS reported FROM f LEFT JOIN g ON f.p = g.p AND f.month = g.month WHERE expected <> coalesce(reported, 0)")
def dq15_unreconciled(spark, sf):
    """Months of plans whose reported member months differ from those counted: the report was made without March of some plans."""
    keys = ["plan_id", "month"]
    counted = member_months(spark, sf).groupBy(*keys).agg(F.count("*").alias("expected"))
    report = member_months(spark, sf).filter(~((F.month("month") == 3) & F.col("plan_id").endswith("1"))).groupBy(*keys).agg(F.count("*").alias("reported"))
    both = counted.join(report, keys, "left").withColumn("reported", F.coalesce("reported", F.lit(0)))
    return both.filter("expected <> reported")


@query("WITH d AS (SELECT upper(trim(member_id)) AS m FROM dim_patient WHERE is_current AND trim(member_id) <> '' UNION ALL SELECT upper(trim(member_id)) FROM dim_patient WHERE trim(member_id) <> '' AND patient_key % 50 = 0) SELECT m AS member_id, count(*) AS n FROM d GROUP BY 1 HAVING count(*) > 1")
def dq16_several_current(spark, sf):
    """Members with more than one current row: some rows were added again as current."""
    d = table(spark, sf, "dim_patient").select("patient_key", E.norm_id("member_id").alias("member_id"), F.coalesce("is_current", F.lit(False)).alias("is_current")).filter("member_id is not null")
    return checks.one_current_per_key(d.unionByName(d.filter("patient_key % 50 = 0").withColumn("is_current", F.lit(True))), "member_id", "is_current")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0)")
def jn11_not_in_some(spark, sf):
    return spark.sql("SELECT c_custkey FROM {c} WHERE c_custkey NOT IN (SELECT o_custkey FROM {o} WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0)", c=table(spark, sf, "customer"), o=table(spark, sf, "orders"))


# ledgers


def _ledger(spark) -> runs.RunLedger:
    ticks = iter(range(1000))
    return runs.RunLedger(tables.Table(spark, scratch(spark, "runs")), tables.Table(spark, scratch(spark, "lineage")), lambda: datetime(2025, 1, 1) + timedelta(minutes=next(ticks)))


def _claim_runs(spark, sf) -> runs.RunLedger:
    """Two models built under a ledger, one of which failed first."""
    book = _ledger(spark)
    raw = table(spark, sf, "br_raw_claim_event")
    t = lambda n: tables.Table(spark, scratch(spark, n))
    try:
        book.run("R0", "bronze_claim", {"br_raw_claim_event": raw}, lambda df: df.select("no_such_column"), t("bronze"))
    except Exception:
        pass
    built = book.run("R1", "bronze_claim", {"br_raw_claim_event": raw}, bronze_claim, t("bronze"))
    book.run("R1", "claim_version", {"bronze_claim": built}, claim_version, t("versions"))
    return book


@query(f"WITH {_BRONZE} SELECT 'bronze_claim' AS model, 'R1' AS run_id, 'SUCCESS' AS status, (SELECT count(*) FROM b) AS rows_written, 'br_raw_claim_event' AS upstream UNION ALL SELECT 'claim_version', 'R1', 'SUCCESS', (SELECT count(*) FROM v), 'bronze_claim'")
def aud2_runs_and_lineage(spark, sf):
    """The latest run of each model with the rows it wrote and what it read."""
    book = _claim_runs(spark, sf)
    return book.latest().join(book.lineage.read(), ["run_id", "model"]).select("model", "run_id", "status", "rows_written", "upstream")


@query(f"SELECT 'bronze_claim' AS pipeline, max(ingest_ts) AS last_ts, max(ingest_ts) - INTERVAL 3 DAY AS lookback_start, floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ingest_ts))) / 1000000.0)::BIGINT AS lag_seconds, 'R1' AS last_run, 'SUCCESS' AS status FROM br_raw_claim_event")
def ctl5_watermarks_and_runs(spark, sf):
    """The pipeline's mark, its lag, and its last run, which isn't the one that failed."""
    marks = tables.Watermarks(tables.Table(spark, scratch(spark, "marks")))
    marks.advance("bronze_claim", table(spark, sf, "br_raw_claim_event"), "ingest_ts")
    return runs.watermark_status(marks.table.read(), _claim_runs(spark, sf).latest(), AS_OF, 3).drop("rows_written")


@query("SELECT 'P1' AS request, TIMESTAMP '2024-01-10' AS window_start, TIMESTAMP '2024-01-12' AS window_end, (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12') AS rows_reprocessed UNION ALL SELECT 'P2', TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-21', (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21')")
def ctl6_reprocessing_ledger(spark, sf):
    """What was reprocessed: windows, and the rows in each."""
    events, book = table(spark, sf, "events"), tables.Table(spark, scratch(spark, "reprocessing"))
    t = tables.Table(spark, scratch(spark, "events"))
    t.overwrite(events.select("event_id", "ts", F.lit("").alias("request")))
    for name, start, end in (("P1", "2024-01-10", "2024-01-12"), ("P2", "2024-01-20", "2024-01-21")):
        tables.reprocess(events, "ts", start, end, lambda df, name=name: df.select("event_id", "ts", F.lit(name).alias("request")), t, ["event_id"])
        entry = t.read().filter(F.col("request") == name).agg(F.count("*").alias("rows_reprocessed"))
        book.append(entry.select(F.lit(name).alias("request"), F.lit(start).cast("timestamp_ntz").alias("window_start"), F.lit(end).cast("timestamp_ntz").alias("window_end"), "rows_reprocessed"))
    return book.read()


# sources, dimensions, feeds


@query("SELECT c_custkey::VARCHAR || ',' || c_mktsegment AS line, row_number() OVER (ORDER BY c_custkey) AS row_number FROM customer")
def src6_numbered_lines(spark, sf):
    """Lines of a file with their numbers; an id of each is the digest of file and number."""
    path = scratch(spark, "lines")
    table(spark, sf, "customer").coalesce(1).sortWithinPartitions("c_custkey").select(F.concat_ws(",", "c_custkey", "c_mktsegment").alias("value")).write.text(path)
    out = readers.read_numbered(spark, path).withColumn("id", readers.row_id(F.col("file_name"), F.col("row_number")))
    return out.filter(F.length("id") == 64).select("line", "row_number")


@query("SELECT r_regionkey AS k, r_name AS name, NULL::INT AS size FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey::INT FROM nation")
def src12_append_new_columns(spark, sf):
    t = tables.Table(spark, scratch(spark, "places"))
    t.append(table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")))
    t.append(table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("int").alias("size")))
    return t.read().select("k", "name", "size")


_COPIED = ("bronze_event_id", "source_system", "source_file_name", "source_file_row_number", "event_type", "natural_key", "payload_hash", "record_status")


@query(f"SELECT {', '.join(_COPIED)} FROM br_raw_claim_event UNION ALL SELECT bronze_event_id, NULL, source_file_name, NULL, NULL, natural_key, payload_hash, record_status FROM br_raw_x12_claim_json")
def src16_backfill(spark, sf):
    """Legacy rows copied into one landing table, column by column; columns that a source lacks are null."""
    landing = tables.Table(spark, scratch(spark, "landing"))
    for name in ("br_raw_claim_event", "br_raw_x12_claim_json"):
        df = table(spark, sf, name)
        landing.append(df.select(*[c for c in _COPIED if c in df.columns]))
    return landing.read().select(*_COPIED)


@query("SELECT r_regionkey, 36 AS id_length, true AS has_user FROM region")
def fn_system(spark, sf):
    ids = table(spark, sf, "region").select("r_regionkey", F.length(F.uuid()).alias("id_length"), (F.length(F.current_user()) > 0).alias("has_user"))
    return ids


@query("""WITH c AS (SELECT rendering_provider_npi AS npi, claim_type, count(*) AS n FROM fact_claim_line WHERE rendering_provider_npi IS NOT NULL AND claim_type IS NOT NULL GROUP BY 1, 2), m AS (SELECT npi, claim_type FROM c QUALIFY row_number() OVER (PARTITION BY npi ORDER BY n DESC, claim_type) = 1), p AS (SELECT DISTINCT rendering_provider_npi AS npi FROM fact_claim_line WHERE trim(rendering_provider_npi) <> '')
SELECT md5(p.npi) AS provider_sk, p.npi, coalesce(claim_type, 'UNKNOWN') AS specialty, NULL::VARCHAR AS state FROM p LEFT JOIN m ON p.npi = m.npi""")
def dim3_provider(spark, sf):
    """Providers with the claim type that they have most as specialty; the sources know no state of theirs."""
    f = claims(spark, sf).filter(F.trim("rendering_provider_npi") != "").select(F.col("rendering_provider_npi").alias("npi"), "claim_type")
    kind = R.mode_by(f, ["npi"], "claim_type")
    out = f.select("npi").distinct().join(kind, "npi", "left")
    return out.select(E.surrogate_key(F.col("npi")).alias("provider_sk"), "npi", F.coalesce("claim_type", F.lit("UNKNOWN")).alias("specialty"), F.lit(None).cast("string").alias("state"))


@query(f"""WITH o AS (SELECT DISTINCT upper(trim(procedure_code)) AS c FROM fact_claim_line WHERE trim(procedure_code) <> ''), s AS (SELECT DISTINCT nullif(upper(trim(e->>'$.procedure_code')), '') AS c FROM (SELECT unnest({_forms('x')}) AS e FROM (SELECT j->'$.procedures' AS x FROM (SELECT CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM br_raw_claim_event) WHERE json_type(j) = 'OBJECT')) WHERE json_type(e) = 'OBJECT')
SELECT k.c AS procedure_code, coalesce(left(k.c, 2), 'NONE') AS category, o.c IS NOT NULL AS is_observed, s.c IS NOT NULL AS is_seeded FROM (SELECT c FROM o UNION SELECT c FROM s WHERE c IS NOT NULL) k LEFT JOIN o ON k.c = o.c LEFT JOIN s ON k.c = s.c""")
def dim7_procedure(spark, sf):
    """Procedures observed on lines, and those known from the messages."""
    observed = claims(spark, sf).select(E.norm_id("procedure_code").alias("procedure_code"))
    raw = table(spark, sf, "br_raw_claim_event").filter(nested.is_object(F.try_parse_json("payload")))
    known = nested.explode_children(raw, "bronze_event_id", "payload", [CLAIM_CHILDREN[2]]).select(E.norm_id("child_key").alias("procedure_code")).filter("procedure_code is not null").distinct()
    out = R.conform_dim(observed, known, "procedure_code", {})
    return out.select("procedure_code", F.left("procedure_code", F.lit(2)).alias("category"), "is_observed", "is_seeded")


@query("WITH t AS (SELECT p_partkey, p_name, p_type FROM part) SELECT p_partkey, p_name, coalesce(g.code, 'UNGROUPED') AS group_code FROM t LEFT JOIN (SELECT DISTINCT p_type AS code FROM part WHERE p_type LIKE 'S%') g ON p_type = g.code")
def dim8_members_of_groups(spark, sf):
    """Rows with their group, those of no group in the catch-all one."""
    groups = table(spark, sf, "part").filter("p_type like 'S%'").select(F.col("p_type").alias("code")).distinct()
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return p.join(lookup_side(groups), F.col("p_type") == F.col("code"), "left").select("p_partkey", "p_name", F.coalesce("code", F.lit("UNGROUPED")).alias("group_code"))


@query("SELECT count(*) AS n FROM events")
def str2_gated_task(spark, sf):
    """A task that runs for each batch with rows, and what its batches had together."""
    t = tables.Table(spark, scratch(spark, "batches"))
    feeds.gated(_event_stream(spark, sf), lambda b, _: t.append(b.agg(F.count("*").alias("n"))) and None, scratch(spark, "checkpoint")).awaitTermination()
    return t.read().agg(F.sum("n").alias("n"))
