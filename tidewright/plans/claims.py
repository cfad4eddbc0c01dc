"""The claims pipeline as a graph of models over the test tables, and queries of its layers with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.functions import expr as E
from tidewright.operators import nested
from tidewright.operators import relational as R
from tidewright.plans import reference
from tidewright.plans.graph import Graph
from tidewright.plans.problems import CLAIM_CHILDREN, table
from tidewright.plans.reference import AS_OF, claims, query
from tidewright.quality import checks
from tidewright.semantic import guard
from tidewright.session import lookup_side, scratch
from tidewright.streaming import feeds

GRAPH = Graph()
LATEST = "source_extract_ts", "ingest_ts"


@GRAPH.model("br_raw_claim_event")
def bronze_claim(raw: DataFrame) -> DataFrame:
    """Typed and keyed messages with a payload object, judged by rules, one row per natural key and digest."""
    v = raw.select("bronze_event_id", *LATEST, "payload_hash", "payload", F.try_parse_json("payload").alias("v")).filter(nested.is_object(F.col("v")))
    get = lambda p, t="string", d=None: E.variant_get(F.col("v"), f"$.{p}", t, d)
    typed = v.select(
        "bronze_event_id", *LATEST, "payload", F.coalesce("payload_hash", F.sha2("payload", 256)).alias("digest"), E.norm_id(get("claim_id")).alias("claim_id"), get("claim_version", "int", 0).alias("claim_version"), E.norm_id(get("member_id")).alias("member_id"),
        E.norm_id(get("payer_id")).alias("payer_id"), E.norm_id(get("plan_id")).alias("plan_id"), get("claim_status").alias("claim_status"), F.try_to_date(get("service_from_date"), "yyyy-MM-dd").alias("service_from_date"),
        F.try_to_date(get("service_to_date"), "yyyy-MM-dd").alias("service_to_date"), get("paid_amount", "decimal(18,2)").alias("paid_amount"), E.loose_boolean(get("void_indicator")).alias("is_void"), E.loose_boolean(get("reversal_indicator")).alias("is_reversal"),
        get("rendering_provider_npi").alias("npi"),
    )
    rules = [
        ("MISSING_REQUIRED_KEY", F.col("claim_id").isNull() | F.col("member_id").isNull()),
        ("IMPOSSIBLE_DATE_SPAN", F.col("service_to_date") < F.col("service_from_date")),
        ("FUTURE_DATED_EVENT", F.col("service_from_date") > F.to_date(F.lit(AS_OF))),
        ("NEGATIVE_PAID_NON_ADJUSTMENT", (F.col("paid_amount") < 0) & ~F.col("is_void") & ~F.col("is_reversal")),
    ]
    keyed = typed.withColumn("natural_key", E.natural_key(F.col("claim_id"), F.col("claim_version"))).withColumns(E.resolve_status(E.first_failing(rules), F.lit("LANDED"), F.lit(None).cast("string")))
    return R.latest_by(keyed, ["natural_key", "digest"], [*[F.col(c).desc_nulls_last() for c in LATEST], F.col("bronze_event_id")])


@GRAPH.model("bronze_claim")
def claim_version(bronze: DataFrame) -> DataFrame:
    return R.latest_by(bronze.filter("record_status = 'VALID'"), ["claim_id", "claim_version"], [*[F.col(c).desc_nulls_last() for c in LATEST], F.col("bronze_event_id")])


@GRAPH.model("claim_version")
def claim_header(versions: DataFrame) -> DataFrame:
    return R.resolve_current(versions, "claim_id", "claim_version", [F.col("bronze_event_id")], F.col("is_void") | F.col("is_reversal"))


def _children(header: DataFrame, child: nested.Child, fields: dict[str, str]) -> DataFrame:
    rows = nested.child_table(header, "bronze_event_id", "payload", child, fields)
    return rows.join(header.select(F.col("bronze_event_id").alias("record_key"), "claim_id", "claim_version"), "record_key")


@GRAPH.model("claim_header")
def claim_line(header: DataFrame) -> DataFrame:
    return _children(header, CLAIM_CHILDREN[0], {"line_number": "int", "procedure_code": "string", "units": "int", "paid_amount": "decimal(18,2)"})


@GRAPH.model("claim_header")
def claim_diagnosis(header: DataFrame) -> DataFrame:
    return _children(header, CLAIM_CHILDREN[1], {"diagnosis_position": "int", "diagnosis_type": "string"})


@GRAPH.model("claim_header")
def claim_procedure(header: DataFrame) -> DataFrame:
    return _children(header, CLAIM_CHILDREN[2], {"procedure_position": "int", "procedure_date": "date"})


def built(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return GRAPH.build({"br_raw_claim_event": table(spark, sf, "br_raw_claim_event")}, [name])[name]


_FLAG = "coalesce(TRY_CAST(j->>'$.{0}' AS BOOLEAN), lower(trim(j->>'$.{0}')) IN ('y', 'yes', 'true', '1'), false)"
_ID = "nullif(upper(trim(j->>'$.{0}')), '')"
_BRONZE = f"""
r AS (SELECT bronze_event_id, source_extract_ts, ingest_ts, coalesce(payload_hash, sha256(payload)) AS digest, payload, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM br_raw_claim_event),
t AS (SELECT bronze_event_id, source_extract_ts, ingest_ts, digest, j, {_ID.format("claim_id")} AS claim_id, coalesce(TRY_CAST(j->>'$.claim_version' AS INT), 0) AS claim_version, {_ID.format("member_id")} AS member_id, {_ID.format("payer_id")} AS payer_id, {_ID.format("plan_id")} AS plan_id, j->>'$.claim_status' AS claim_status,
  TRY_CAST(j->>'$.service_from_date' AS DATE) AS f, TRY_CAST(j->>'$.service_to_date' AS DATE) AS e, TRY_CAST(j->>'$.paid_amount' AS DECIMAL(18,2)) AS paid, {_FLAG.format("void_indicator")} AS is_void, {_FLAG.format("reversal_indicator")} AS is_reversal, j->>'$.rendering_provider_npi' AS npi FROM r WHERE json_type(j) = 'OBJECT'),
b AS (SELECT *, claim_id || '|' || claim_version::VARCHAR AS natural_key, CASE WHEN claim_id IS NULL OR member_id IS NULL THEN 'MISSING_REQUIRED_KEY' WHEN e < f THEN 'IMPOSSIBLE_DATE_SPAN' WHEN f > DATE '{AS_OF}' THEN 'FUTURE_DATED_EVENT' WHEN paid < 0 AND NOT is_void AND NOT is_reversal THEN 'NEGATIVE_PAID_NON_ADJUSTMENT' END AS reason FROM t
  QUALIFY row_number() OVER (PARTITION BY natural_key, digest ORDER BY source_extract_ts DESC NULLS LAST, ingest_ts DESC NULLS LAST, bronze_event_id) = 1),
v AS (SELECT * FROM b WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY claim_id, claim_version ORDER BY source_extract_ts DESC NULLS LAST, ingest_ts DESC NULLS LAST, bronze_event_id) = 1),
h AS (SELECT * FROM v WHERE NOT (is_void OR is_reversal) QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY claim_version DESC, bronze_event_id) = 1)
"""


@query(f"WITH {_BRONZE} SELECT bronze_event_id, natural_key, CASE WHEN reason IS NULL THEN 'VALID' ELSE 'QUARANTINE' END AS record_status, reason AS quarantine_reason FROM b")
def ing1_bronze_claim(spark, sf):
    return built(spark, sf, "bronze_claim").select("bronze_event_id", "natural_key", "record_status", "quarantine_reason")


@query(f"WITH {_BRONZE} SELECT claim_id, claim_version, bronze_event_id FROM v")
def can1_claim_versions(spark, sf):
    return built(spark, sf, "claim_version").select("claim_id", "claim_version", "bronze_event_id")


@query(f"WITH {_BRONZE} SELECT claim_id, claim_version, claim_status, paid::DOUBLE AS paid_amount FROM h")
def can5_claim_header(spark, sf):
    return built(spark, sf, "claim_header").select("claim_id", "claim_version", "claim_status", F.col("paid_amount").cast("double").alias("paid_amount"))


def _list(path: str) -> str:
    c = f"(CASE WHEN json_type(j->'$.{path}') = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$.{path}') THEN (j->>'$.{path}')::JSON END ELSE j->'$.{path}' END)"
    return f"CASE json_type({c}) WHEN 'ARRAY' THEN from_json({c}, '[\"json\"]') WHEN 'OBJECT' THEN [{c}] END"


@query(f"WITH {_BRONZE}, x AS (SELECT claim_id, claim_version, unnest({_list('lines')}) AS e FROM h) SELECT claim_id, claim_version, coalesce(e->>'$.claim_line_id', '') AS claim_line_id, TRY_CAST(e->>'$.units' AS INT) AS units, TRY_CAST(e->>'$.paid_amount' AS DECIMAL(18,2))::DOUBLE AS paid_amount FROM x WHERE json_type(e) = 'OBJECT'")
def can6_claim_line(spark, sf):
    return built(spark, sf, "claim_line").select("claim_id", "claim_version", F.col("child_key").alias("claim_line_id"), "units", F.col("paid_amount").cast("double").alias("paid_amount"))


@query(f"WITH {_BRONZE}, x AS (SELECT claim_id, claim_version, unnest({_list('diagnoses')}) AS e FROM h) SELECT claim_id, claim_version, coalesce(e->>'$.diagnosis_code', '') AS diagnosis_code, coalesce(TRY_CAST(e->>'$.diagnosis_position' AS INT) = 1, false) AS is_primary FROM x WHERE json_type(e) = 'OBJECT'")
def can7_brg1_claim_diagnosis(spark, sf):
    return built(spark, sf, "claim_diagnosis").select("claim_id", "claim_version", F.col("child_key").alias("diagnosis_code"), F.coalesce(F.col("diagnosis_position") == 1, F.lit(False)).alias("is_primary"))


@query(f"WITH {_BRONZE}, x AS (SELECT claim_id, unnest({_list('procedures')}) AS e FROM h) SELECT md5(claim_id || '|' || coalesce(e->>'$.procedure_code', '')) AS bridge_sk, TRY_CAST(e->>'$.procedure_date' AS DATE) AS procedure_date FROM x WHERE json_type(e) = 'OBJECT'")
def can8_brg2_claim_procedure(spark, sf):
    return built(spark, sf, "claim_procedure").select(E.surrogate_key(F.col("claim_id"), F.col("child_key")).alias("bridge_sk"), "procedure_date")


@query(f"WITH {_BRONZE} SELECT lpad(trim(npi), 10, '0') AS npi, count(*) AS claims FROM h WHERE trim(npi) <> '' GROUP BY 1")
def can11_provider(spark, sf):
    return built(spark, sf, "claim_header").select(F.lpad(F.trim("npi"), 10, "0").alias("npi"), F.trim("npi").alias("t")).filter("t <> ''").groupBy("npi").agg(F.count("*").alias("claims"))


@query("""WITH c AS (SELECT upper(trim(payer_id)) AS payer_id, plan_type, count(*) AS n FROM eligibility_event WHERE trim(payer_id) <> '' AND plan_type IS NOT NULL GROUP BY 1, 2), m AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY payer_id ORDER BY n DESC, plan_type) = 1)
SELECT m.payer_id, m.plan_type, d.payer_name FROM m LEFT JOIN dim_payer d ON upper(trim(d.payer_id)) = m.payer_id""")
def can12_payer(spark, sf):
    e = table(spark, sf, "eligibility_event").select(E.norm_id("payer_id").alias("payer_id"), "plan_type").filter("payer_id is not null")
    names = table(spark, sf, "dim_payer").select(E.norm_id("payer_id").alias("payer_id"), "payer_name")
    return R.mode_by(e, ["payer_id"], "plan_type").join(lookup_side(names), "payer_id", "left")


@query("""WITH e AS (SELECT upper(trim(plan_id)) AS p, payer_id FROM eligibility_event WHERE trim(plan_id) <> '' QUALIFY row_number() OVER (PARTITION BY upper(trim(plan_id)) ORDER BY created_at DESC NULLS LAST, eligibility_event_id DESC) = 1), c AS (SELECT upper(trim(plan_id)) AS p, max(payer_id) AS payer_id FROM fact_claim_line WHERE trim(plan_id) <> '' GROUP BY 1)
SELECT coalesce(e.p, c.p) AS plan_id, coalesce(e.payer_id, c.payer_id) AS payer_id FROM e FULL JOIN c ON e.p = c.p""")
def can13_plan(spark, sf):
    e = table(spark, sf, "eligibility_event").withColumn("plan_id", E.norm_id("plan_id")).filter("plan_id is not null")
    newest = R.latest_values(e, ["plan_id"], ["created_at", "eligibility_event_id"], ["payer_id"]).withColumnRenamed("payer_id", "a")
    other = claims(spark, sf).groupBy(E.norm_id("plan_id").alias("plan_id")).agg(F.max("payer_id").alias("b")).filter("plan_id is not null")
    return newest.join(other, "plan_id", "full").select("plan_id", F.coalesce("a", "b").alias("payer_id"))


@query("SELECT claim_id, 'line' AS origin FROM fact_claim_line WHERE upper(trim(claim_status)) = 'DENIED' UNION ALL SELECT natural_key, 'message' FROM br_raw_claim_event WHERE json_valid(payload) AND payload->>'$.claim_status' = 'DENIED'")
def can16_denial_event(spark, sf):
    a = claims(spark, sf).filter(E.norm_id("claim_status") == "DENIED").select("claim_id", F.lit("line").alias("origin"))
    return a.unionByName(table(spark, sf, "br_raw_claim_event").filter(E.json_get(F.col("payload"), "$.claim_status") == "DENIED").select(F.col("natural_key").alias("claim_id"), F.lit("message").alias("origin")))


@query("""WITH d AS (SELECT * FROM dim_patient WHERE is_current AND trim(member_id) <> '' QUALIFY row_number() OVER (PARTITION BY upper(trim(member_id)) ORDER BY effective_from DESC NULLS LAST, patient_key) = 1)
SELECT upper(trim(member_id)) AS member_id, state, CASE WHEN 2025 - birth_year < 18 THEN '<18' WHEN 2025 - birth_year < 35 THEN '18-34' WHEN 2025 - birth_year < 50 THEN '35-49' WHEN 2025 - birth_year < 65 THEN '50-64' ELSE '65+' END AS age_band FROM d""")
def dim2_patient(spark, sf):
    d = table(spark, sf, "dim_patient").withColumn("member_id", E.norm_id("member_id")).filter("is_current and member_id is not null")
    age = F.lit(2025) - F.col("birth_year")
    band = F.when(age < 18, "<18").when(age < 35, "18-34").when(age < 50, "35-49").when(age < 65, "50-64").otherwise("65+")
    return R.latest_by(d, ["member_id"], [F.col("effective_from").desc_nulls_last(), F.col("patient_key")]).select("member_id", "state", band.alias("age_band"))


@query("SELECT payer_id, CASE WHEN upper(payer_name) LIKE '%TRUST%' THEN 'Trust' WHEN upper(payer_name) LIKE '%MUTUAL%' THEN 'Mutual' ELSE 'Other' END AS kind FROM dim_payer")
def dim4_payer(spark, sf):
    n = F.upper("payer_name")
    return table(spark, sf, "dim_payer").select("payer_id", F.when(n.like("%TRUST%"), "Trust").when(n.like("%MUTUAL%"), "Mutual").otherwise("Other").alias("kind"))


@query("SELECT p.plan_id, coalesce(nullif(trim(p.plan_name), ''), p.plan_type, 'plan ' || p.plan_id) AS plan_name, coalesce(y.payer_name, 'UNKNOWN') AS payer_name FROM dim_plan p LEFT JOIN dim_payer y ON p.payer_id = y.payer_id")
def dim5_plan(spark, sf):
    y = table(spark, sf, "dim_payer").select("payer_id", "payer_name")
    return table(spark, sf, "dim_plan").join(lookup_side(y), "payer_id", "left").select("plan_id", F.coalesce(E.clean_text("plan_name"), F.col("plan_type"), F.concat(F.lit("plan "), F.col("plan_id"))).alias("plan_name"), F.coalesce("payer_name", F.lit("UNKNOWN")).alias("payer_name"))


@query("SELECT DISTINCT plan_type AS group_code FROM dim_plan WHERE plan_type IS NOT NULL UNION ALL SELECT 'UNGROUPED'")
def dim8_catch_all(spark, sf):
    return table(spark, sf, "dim_plan").select(F.col("plan_type").alias("group_code")).filter("group_code is not null").distinct().unionByName(spark.range(1).select(F.lit("UNGROUPED").alias("group_code")))


@query("SELECT change_id, (paid_amount - lag(paid_amount) OVER (PARTITION BY upper(trim(claim_line_id)) ORDER BY claim_version NULLS FIRST, change_id))::DOUBLE AS paid_delta FROM fact_claim_line WHERE trim(claim_line_id) <> ''")
def fct3_claim_adjustment(spark, sf):
    f = claims(spark, sf).withColumn("line", E.norm_id("claim_line_id")).filter("line is not null")
    before = F.lag("paid_amount").over(Window.partitionBy("line").orderBy(F.col("claim_version").asc_nulls_first(), "change_id"))
    return f.select("change_id", (F.col("paid_amount") - before).cast("double").alias("paid_delta"))


@query("""WITH pl AS (SELECT upper(trim(plan_id)) AS k, any_value(plan_type) AS plan_type FROM dim_plan GROUP BY 1), py AS (SELECT upper(trim(payer_id)) AS k, any_value(payer_name) AS payer_name FROM dim_payer GROUP BY 1), st AS (SELECT upper(trim(status_code)) AS k, any_value(status_name) AS status_name FROM ref_claim_status GROUP BY 1),
pt AS (SELECT upper(trim(member_id)) AS k, bool_or(coalesce(is_current, false)) AS has_current FROM dim_patient GROUP BY 1)
SELECT change_id, plan_type, payer_name, status_name, has_current, strftime(service_from_date, '%Y%m%d')::INT AS date_key FROM fact_claim_line f LEFT JOIN pl ON upper(trim(f.plan_id)) = pl.k LEFT JOIN py ON upper(trim(f.payer_id)) = py.k LEFT JOIN st ON upper(trim(f.claim_status)) = st.k LEFT JOIN pt ON upper(trim(f.member_id)) = pt.k""")
def gld1_semantic_base(spark, sf):
    """Claim lines with the attributes of their dimensions: small ones are broadcast, members joined by shuffle with hot ones spread."""
    one = lambda n, k, v: table(spark, sf, n).select(E.norm_id(k).alias(f"_{k}"), v).filter(f"_{k} is not null").dropDuplicates([f"_{k}"])
    f = claims(spark, sf).select("change_id", E.norm_id("plan_id").alias("_plan_id"), E.norm_id("payer_id").alias("_payer_id"), E.norm_id("claim_status").alias("_status_code"), E.norm_id("member_id").alias("_member_id"), E.date_key(F.col("service_from_date")).alias("date_key"))
    out = f.join(lookup_side(one("dim_plan", "plan_id", "plan_type")), "_plan_id", "left").join(lookup_side(one("dim_payer", "payer_id", "payer_name")), "_payer_id", "left").join(lookup_side(one("ref_claim_status", "status_code", "status_name")), "_status_code", "left")
    members = table(spark, sf, "dim_patient").groupBy(E.norm_id("member_id").alias("_member_id")).agg(F.bool_or(F.coalesce("is_current", F.lit(False))).alias("has_current"))
    return R.hot_join(out, members, ["_member_id"], "left").select("change_id", "plan_type", "payer_name", "status_name", "has_current", "date_key")


@query(f"WITH {reference._MONTHS} SELECT p AS plan_id, month, count(*) AS member_months, count(DISTINCT m) AS members FROM mm GROUP BY 1, 2")
def gld2_member_months(spark, sf):
    return reference.member_months(spark, sf).groupBy("plan_id", "month").agg(F.count("*").alias("member_months"), F.count_distinct("member_id").alias("members"))


@query("SELECT rendering_provider_npi, count(DISTINCT claim_id)::DOUBLE / nullif(count(DISTINCT member_id), 0) AS claims_per_member, sum(paid_amount)::DOUBLE / nullif(count(DISTINCT member_id), 0) AS paid_per_member FROM fact_claim_line GROUP BY 1")
def gld6_provider_utilization(spark, sf):
    a = claims(spark, sf).groupBy("rendering_provider_npi").agg(F.count_distinct("claim_id").cast("double").alias("c"), F.count_distinct("member_id").alias("m"), F.sum("paid_amount").cast("double").alias("p"))
    return a.select("rendering_provider_npi", E.ratio(F.col("c"), F.col("m")).alias("claims_per_member"), E.ratio(F.col("p"), F.col("m")).alias("paid_per_member"))


@query("SELECT claim_type, claim_status, payer_id, plan_id, date_trunc('month', service_from_date)::DATE AS month, count(DISTINCT member_id) AS members, max(CASE WHEN units > 3 THEN 1 ELSE 0 END) AS any_many_units FROM fact_claim_line GROUP BY ALL")
def gld7_cohort(spark, sf):
    return claims(spark, sf).groupBy("claim_type", "claim_status", "payer_id", "plan_id", F.trunc("service_from_date", "month").alias("month")).agg(F.count_distinct("member_id").alias("members"), F.max(F.when(F.col("units") > 3, 1).otherwise(0)).alias("any_many_units"))


@query(f"WITH {_BRONZE} SELECT 'quarantine' AS kind, reason AS name, count(*) AS n FROM b WHERE reason IS NOT NULL GROUP BY 2 UNION ALL SELECT 'check', 'negative_paid', count(*) FROM fact_claim_line WHERE paid_amount < 0")
def gld9_quality_summary(spark, sf):
    q = built(spark, sf, "bronze_claim").filter("record_status = 'QUARANTINE'").groupBy(F.col("quarantine_reason").alias("name")).agg(F.count("*").alias("n")).select(F.lit("quarantine").alias("kind"), "name", "n")
    c = checks.accepted_range(claims(spark, sf), "paid_amount", 0).agg(F.count("*").alias("n")).select(F.lit("check").alias("kind"), F.lit("negative_paid").alias("name"), "n")
    return q.unionByName(c).orderBy(F.col("n").desc_nulls_last())


@query("SELECT load_id, batch_id, count(*) AS row_count, 'LOADED' AS status FROM br_raw_claim_event GROUP BY 1, 2")
def src7_load_ledger(spark, sf):
    """The ledger of all loads."""
    return table(spark, sf, "br_raw_claim_event").groupBy("load_id", "batch_id").agg(F.count("*").alias("row_count"), F.lit("LOADED").alias("status"))


@query("SELECT event_type, max(event_id) FILTER (WHERE value > 10) AS newest, ts::DATE AS day FROM events GROUP BY 1, 3 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY day DESC) = 1")
def ctl1_contract_version(spark, sf):
    """The latest version of each contract, and no older one."""
    runs = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.max(F.when(F.col("value") > 10, F.col("event_id"))).alias("newest"))
    return R.latest_by(runs, ["event_type"], [F.col("day").desc()])


_HOURS = f"datediff('hour', max(t), TIMESTAMP '{AS_OF}')::DOUBLE"


@query(f"""WITH f AS (SELECT 'claim' AS feed, 6 AS sla, {_HOURS} AS lag FROM (SELECT ingest_ts AS t FROM br_raw_claim_event) UNION ALL SELECT 'eligibility', 24, {_HOURS} FROM (SELECT created_at AS t FROM eligibility_event) UNION ALL SELECT 'event', 99999999, {_HOURS} FROM (SELECT ts AS t FROM events))
SELECT feed, lag AS lag_hours, CASE WHEN lag IS NULL THEN 'STALE' WHEN lag <= sla THEN 'FRESH' WHEN lag <= 2 * sla THEN 'STALE' ELSE 'BREACH' END AS status FROM f""")
def ctl3_freshness(spark, sf):
    out = None
    for feed, name, ts, sla in (("claim", "br_raw_claim_event", "ingest_ts", 6), ("eligibility", "eligibility_event", "created_at", 24), ("event", "events", "ts", 99999999)):
        lag = E.hour_diff(F.max(ts), F.lit(AS_OF).cast("timestamp_ntz"))
        row = table(spark, sf, name).agg(lag.alias("lag_hours")).select(F.lit(feed).alias("feed"), "lag_hours", F.when(F.col("lag_hours").isNull(), "STALE").when(F.col("lag_hours") <= sla, "FRESH").when(F.col("lag_hours") <= 2 * sla, "STALE").otherwise("BREACH").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


@query("SELECT 'events' AS pipeline, max(ts) AS last_ts, max(ts) - INTERVAL 3 DAY AS lookback_start FROM events")
def ctl5_watermark_status(spark, sf):
    from tidewright.sources import tables

    marks = tables.Watermarks(tables.Table(spark, scratch(spark, "marks")))
    marks.advance("events", table(spark, sf, "events"), "ts")
    return marks.table.read().select("pipeline", "last_ts", (F.col("last_ts") - F.expr("interval 3 days")).alias("lookback_start"))


@query("SELECT * FROM (VALUES ('paid_amount', true, true), ('claim_count', false, true), ('denied_claims', false, true), ('member_months', true, true), ('pmpm', false, true), ('denial_rate', false, true)) t(metric_name, is_additive, is_certified)")
def sem1_metric_registry(spark, sf):
    return reference.claims_model(spark, sf).registry(spark).select("metric_name", "is_additive", "is_certified")


@query("SELECT 'SUCCESS' AS status, 1 AS n UNION ALL SELECT 'BLOCKED', 3")
def sem9_audit_log(spark, sf):
    """A statement that may run and three that may not, as the audit log has them."""
    table(spark, sf, "region").createOrReplaceTempView("serving_region")
    log: list = []
    for sql in ("SELECT r_name FROM serving_region", "SELECT * FROM serving_region", "DROP TABLE serving_region", "SELECT r_name FROM secret_table"):
        try:
            guard.guarded_sql(spark, sql, {"serving_region"}, audit=log)
        except guard.Blocked:
            pass
    return guard.audit_frame(spark, log).groupBy("status").agg(F.count("*").cast("int").alias("n"))


@query("SELECT event_id FROM events")
def str1_exactly_once(spark, sf):
    """Events fed twice through a stream, each kept once."""
    path = scratch(spark, "twice")
    df = table(spark, sf, "events").select("event_id", "ts")
    df.unionByName(df).repartition(4).write.parquet(path)
    out = scratch(spark, "once")
    once = feeds.dedupe(feeds.read_feed(spark, path, spark.read.parquet(path).schema, 2), ["event_id"], "ts", "60 days")
    once.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("event_id")


@query(f"SELECT eligibility_event_id FROM eligibility_event WHERE coverage_start_date > DATE '{AS_OF}' + 30")
def dq5_not_future(spark, sf):
    return checks.not_future_date(table(spark, sf, "eligibility_event"), "coverage_start_date", AS_OF, 30).select("eligibility_event_id")


@query("SELECT max(ts) AS newest FROM events HAVING max(ts) < TIMESTAMP '2025-01-01' - INTERVAL 24 HOUR")
def dq6_recency(spark, sf):
    return checks.recency(table(spark, sf, "events"), "ts", AS_OF, 24).select(F.col("newest").cast("timestamp_ntz").alias("newest"))


@query("SELECT change_id FROM fact_claim_line WHERE paid_amount < 0 AND NOT coalesce(upper(trim(claim_status)) IN ('REVERSED', 'TAKEBACK', 'VOID'), false)")
def dq7_nonnegative_unless(spark, sf):
    return checks.nonnegative_unless(claims(spark, sf), "paid_amount", E.norm_id("claim_status").isin("REVERSED", "TAKEBACK", "VOID")).select("change_id")


@query("SELECT 'paid' AS check_name, 'ERROR' AS status, count(*) AS failing_rows FROM fact_claim_line WHERE paid_amount < 0 UNION ALL SELECT 'orders', 'PASS', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)")
def dq9_check_run(spark, sf):
    specs = [checks.Check("paid", "lines", "error", lambda df: checks.accepted_range(df, "paid_amount", 0)), checks.Check("orders", "orders", "warn", lambda df: checks.unique(df, "o_orderkey"))]
    return checks.run_checks(spark, specs, {"lines": claims(spark, sf), "orders": table(spark, sf, "orders")}, "R1", "2025-01-01").select("check_name", "status", "failing_rows")


@query(f"WITH {reference._MONTHS}, a AS (SELECT count(*) AS expected FROM mm), c AS (SELECT sum(n)::BIGINT AS actual FROM (SELECT p, month, count(DISTINCT m) AS n FROM mm GROUP BY 1, 2)) SELECT expected, actual, abs(expected - actual) <= 1 AS reconciles FROM a, c")
def dq15_member_months_reconcile(spark, sf):
    mm = reference.member_months(spark, sf)
    both = mm.agg(F.count("*").alias("expected")).crossJoin(gld2_member_months(spark, sf).agg(F.sum("members").alias("actual")))
    return both.select("expected", "actual", (F.abs(F.col("expected") - F.col("actual")) <= 1).alias("reconciles"))


@query(f"WITH {_BRONZE} SELECT claim_id, count(*) AS n FROM h GROUP BY 1 HAVING count(*) > 1")
def dq16_one_current(spark, sf):
    return checks.one_current_per_key(built(spark, sf, "claim_header").withColumn("is_current", F.lit(True)), "claim_id", "is_current")
