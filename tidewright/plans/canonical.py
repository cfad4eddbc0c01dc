"""Canonical entities and registries at their full width, over messages, claim lines and coverages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import expr as E
from tidewright.operators import relational as R
from tidewright.plans import marts
from tidewright.plans.claims import _BRONZE, LATEST, built
from tidewright.plans.problems import table
from tidewright.plans.reference import AS_OF, claims, query
from tidewright.quality import checks
from tidewright.semantic import search
from tidewright.session import lookup_side, scratch
from tidewright.sources import readers

_N = "nullif(upper(trim({0}, ' \t\r\n')), '')"


@query(f"""WITH {_BRONZE} SELECT bronze_event_id, claim_id, claim_version, CASE WHEN is_void THEN 'VOID' WHEN is_reversal THEN 'REVERSAL' WHEN claim_version > 1 THEN 'ADJUSTMENT' ELSE 'ORIGINAL' END AS chain_class, lag(claim_version) OVER w AS prior_version, row_number() OVER w AS chain_seq, claim_version = max(claim_version) OVER (PARTITION BY claim_id) AS is_latest
FROM v WINDOW w AS (PARTITION BY claim_id ORDER BY claim_version NULLS FIRST, bronze_event_id)""")
def can2_message_chains(spark, sf):
    """Chains of claim versions with all four classes."""
    flags = {"VOID": F.col("is_void"), "REVERSAL": F.col("is_reversal"), "ADJUSTMENT": F.col("claim_version") > 1}
    return R.version_chain(built(spark, sf, "claim_version"), "claim_id", "claim_version", [F.col("bronze_event_id")], flags).select("bronze_event_id", "claim_id", "claim_version", "chain_class", "prior_version", "chain_seq", "is_latest")


@query(f"""WITH {_BRONZE} SELECT claim_id, claim_version, payer_id, plan_id, claim_status, paid::DOUBLE AS paid_amount, datediff('day', e, ingest_ts::DATE)::INT AS lag_days, coalesce(datediff('day', e, ingest_ts::DATE) > 7 AND date_trunc('month', e) < date_trunc('month', ingest_ts::DATE), false) AS is_late,
CASE WHEN coalesce(datediff('day', e, ingest_ts::DATE) > 7 AND date_trunc('month', e) < date_trunc('month', ingest_ts::DATE), false) THEN date_trunc('month', e)::DATE END AS impacted_period FROM h""")
def can5_header_with_lateness(spark, sf):
    """Current claim headers with the flags of late arrival."""
    h = built(spark, sf, "claim_header").withColumns(R.late_flags(F.col("service_to_date"), F.to_date("ingest_ts"), 7))
    return h.select("claim_id", "claim_version", "payer_id", "plan_id", "claim_status", F.col("paid_amount").cast("double").alias("paid_amount"), "lag_days", "is_late", "impacted_period")


@query(f"""WITH e AS (SELECT {_N.format('member_id')} AS m, plan_id, payer_id, eligibility_event_id, CASE WHEN json_valid(demographics) AND json_type(demographics::JSON) = 'OBJECT' THEN demographics::JSON END AS d, created_at FROM eligibility_event),
n AS (SELECT m, plan_id, payer_id, TRY_CAST(d->>'$.birth_year' AS INT) AS birth_year, d->>'$.gender' AS gender, d->>'$.state' AS state FROM e WHERE m IS NOT NULL QUALIFY row_number() OVER (PARTITION BY m ORDER BY created_at DESC NULLS LAST, eligibility_event_id DESC) = 1),
a AS (SELECT m FROM n UNION SELECT {_N.format('member_id')} FROM fact_claim_line WHERE trim(member_id) <> '')
SELECT a.m AS member_id, plan_id, payer_id, gender, state, CASE WHEN birth_year IS NULL THEN 'UNKNOWN' WHEN 2025 - birth_year < 18 THEN '<18' WHEN 2025 - birth_year < 35 THEN '18-34' WHEN 2025 - birth_year < 50 THEN '35-49' WHEN 2025 - birth_year < 65 THEN '50-64' ELSE '65+' END AS age_band, n.m IS NOT NULL AS has_coverage FROM a LEFT JOIN n ON a.m = n.m""")
def can10_patient(spark, sf):
    """Members of coverages and claims, with what their latest coverage says of them."""
    get = lambda k, t="string": E.json_get(F.col("demographics"), f"$.{k}", t)
    e = table(spark, sf, "eligibility_event").select(E.norm_id("member_id").alias("member_id"), "plan_id", "payer_id", "created_at", "eligibility_event_id", get("birth_year", "int").alias("birth_year"), get("gender").alias("gender"), get("state").alias("state")).filter("member_id is not null")
    newest = R.latest_values(e, ["member_id"], ["created_at", "eligibility_event_id"], ["plan_id", "payer_id", "birth_year", "gender", "state"]).withColumn("_has", F.lit(True))
    known = newest.select("member_id").unionByName(claims(spark, sf).select(E.norm_id("member_id").alias("member_id")).filter("member_id is not null")).distinct()
    age = F.lit(2025) - F.col("birth_year")
    band = F.when(age.isNull(), "UNKNOWN").when(age < 18, "<18").when(age < 35, "18-34").when(age < 50, "35-49").when(age < 65, "50-64").otherwise("65+")
    return known.join(newest, "member_id", "left").select("member_id", "plan_id", "payer_id", "gender", "state", band.alias("age_band"), F.coalesce("_has", F.lit(False)).alias("has_coverage"))


@query(f"WITH {_BRONZE} SELECT lpad(left(trim(npi), 10), 10, '0') AS npi, claim_id AS latest_claim, source_extract_ts AS last_seen FROM v WHERE trim(npi) <> '' QUALIFY row_number() OVER (PARTITION BY lpad(left(trim(npi), 10), 10, '0') ORDER BY source_extract_ts DESC NULLS LAST, ingest_ts DESC NULLS LAST, bronze_event_id) = 1")
def can11_provider_latest(spark, sf):
    """Providers, padded to ten digits, by the latest message that names them."""
    v = built(spark, sf, "claim_version").filter(F.trim("npi") != "").withColumn("npi", F.lpad(F.trim("npi"), 10, "0"))
    out = R.latest_by(v, ["npi"], [*[F.col(c).desc_nulls_last() for c in LATEST], F.col("bronze_event_id")])
    return out.select("npi", F.col("claim_id").alias("latest_claim"), F.col("source_extract_ts").alias("last_seen"))


#: Category by plan type (a seed); other plan types are COMMERCIAL.
CATEGORIES = {"HDHP": "CONSUMER", "POS": "MANAGED", "HMO": "MANAGED"}


@query(f"""WITH p AS (SELECT {_N.format('payer_id')} AS k FROM fact_claim_line UNION SELECT {_N.format('payer_id')} FROM eligibility_event), c AS (SELECT {_N.format('payer_id')} AS k, plan_type, count(*) AS n FROM eligibility_event WHERE plan_type IS NOT NULL GROUP BY 1, 2), m AS (SELECT k, plan_type FROM c WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, plan_type) = 1)
SELECT p.k AS payer_id, 'Payer ' || p.k AS payer_name, plan_type AS representative_plan_type, CASE {' '.join(f"WHEN plan_type = '{k}' THEN '{v}'" for k, v in CATEGORIES.items())} ELSE 'COMMERCIAL' END AS payer_category, md5(p.k) AS payer_sk FROM p LEFT JOIN m ON p.k = m.k WHERE p.k IS NOT NULL""")
def can12_payer_conformed(spark, sf):
    """Payers of claims and coverages, with the category of their commonest plan type."""
    of = lambda n: table(spark, sf, n).select(E.norm_id("payer_id").alias("payer_id")).filter("payer_id is not null")
    e = table(spark, sf, "eligibility_event").select(E.norm_id("payer_id").alias("payer_id"), "plan_type").filter("payer_id is not null")
    seed = spark.createDataFrame(list(CATEGORIES.items()), "plan_type string, payer_category string")
    mode = R.mode_by(e, ["payer_id"], "plan_type").join(F.broadcast(seed), "plan_type", "left")
    out = of("fact_claim_line").unionByName(of("eligibility_event")).distinct().join(mode, "payer_id", "left")
    return out.select("payer_id", F.concat(F.lit("Payer "), "payer_id").alias("payer_name"), F.col("plan_type").alias("representative_plan_type"), F.coalesce("payer_category", F.lit("COMMERCIAL")).alias("payer_category"), E.surrogate_key(F.col("payer_id")).alias("payer_sk"))


@query(f"""WITH {_BRONZE}, u AS (SELECT claim_id, claim_version, {_N.format("j->>'$.denial_reason_code'")} AS code, 'CLAIM_HEADER' AS origin, ingest_ts AS ts FROM h WHERE upper(claim_status) = 'DENIED' UNION ALL SELECT {_N.format('claim_id')}, claim_version, NULL, 'LINE', created_at FROM fact_claim_line WHERE {_N.format('claim_status')} = 'DENIED'),
rr AS (SELECT DISTINCT {_N.format("j->>'$.denial_reason_code'")} AS code FROM t WHERE j->>'$.denial_reason_code' LIKE 'NX-%')
SELECT claim_id, claim_version, u.code AS denial_reason_code, CASE WHEN rr.code IS NOT NULL THEN 'Reason ' || rr.code END AS denial_reason, origin, ts AS denial_ts, md5(coalesce(claim_id, '_dbt_utils_surrogate_key_null_') || '|' || coalesce(u.code, '_dbt_utils_surrogate_key_null_') || '|' || origin) AS denial_sk FROM u LEFT JOIN rr ON u.code = rr.code""")
def can16_denials_with_reasons(spark, sf):
    """Denials of headers and lines, with the reason's name from a list of reasons."""
    h = built(spark, sf, "claim_header").filter(F.upper("claim_status") == "DENIED").select("claim_id", "claim_version", E.norm_id(E.json_get(F.col("payload"), "$.denial_reason_code")).alias("denial_reason_code"), F.lit("CLAIM_HEADER").alias("origin"), F.col("ingest_ts").alias("denial_ts"))
    lines = claims(spark, sf).filter(E.norm_id("claim_status") == "DENIED").select(E.norm_id("claim_id").alias("claim_id"), "claim_version", F.lit(None).cast("string").alias("denial_reason_code"), F.lit("LINE").alias("origin"), F.col("created_at").alias("denial_ts"))
    stated = E.json_get(F.col("payload"), "$.denial_reason_code")
    reasons = table(spark, sf, "br_raw_claim_event").filter(stated.like("NX-%")).select(E.norm_id(stated).alias("denial_reason_code")).distinct().withColumn("denial_reason", F.concat(F.lit("Reason "), "denial_reason_code"))
    out = h.unionByName(lines).join(lookup_side(reasons), "denial_reason_code", "left")
    return out.select("claim_id", "claim_version", "denial_reason_code", "denial_reason", "origin", "denial_ts", E.surrogate_key(F.col("claim_id"), F.col("denial_reason_code"), F.col("origin")).alias("denial_sk"))


@query("""WITH c AS (SELECT source_system, event_type AS object_name, batch_id AS schema_version, min(ingest_ts) AS effective_from FROM br_raw_claim_event GROUP BY 1, 2, 3)
SELECT *, row_number() OVER (PARTITION BY source_system, object_name ORDER BY coalesce(schema_version, '') DESC, coalesce(effective_from, TIMESTAMP '1900-01-01') DESC) = 1 AS is_current FROM c""")
def ctl1_contracts(spark, sf):
    """Versions of each contract, the greatest of which is current; batches stand for versions."""
    from pyspark.sql import Window

    c = table(spark, sf, "br_raw_claim_event").groupBy("source_system", F.col("event_type").alias("object_name"), F.col("batch_id").alias("schema_version")).agg(F.min("ingest_ts").alias("effective_from"))
    w = Window.partitionBy("source_system", "object_name").orderBy(F.coalesce("schema_version", F.lit("")).desc(), F.coalesce("effective_from", F.lit("1900-01-01").cast("timestamp_ntz")).desc())
    return c.withColumn("is_current", F.row_number().over(w) == 1)


@query("SELECT metric_name, unnest(dims) AS dimension FROM (VALUES ('pmpm', ['payer_name', 'payer_type', 'plan_type', 'month']), ('member_months', ['payer_name', 'payer_type', 'plan_type', 'month'])) t(metric_name, dims)")
def var11_allowed_dimensions(spark, sf):
    """The array of allowed dimensions of two metrics, unnested."""
    return marts.model(spark, sf).registry(spark).filter(F.col("metric_name").isin("pmpm", "member_months")).select("metric_name", F.explode("allowed_dimensions").alias("dimension"))


# documentation and search


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """mart, column, type and position of all marts."""
    rows = [(n, f.name, f.dataType.simpleString(), i) for n in ("base", "member_months") for i, f in enumerate(marts.mart(spark, sf, n).schema)]
    return spark.createDataFrame(rows, "mart string, column string, type string, position int")


@query("SELECT * FROM (VALUES ('member_months', 'member_id', 'string', 0), ('member_months', 'payer_id', 'string', 1), ('member_months', 'plan_id', 'string', 2), ('member_months', 'payer_name', 'string', 3), ('member_months', 'payer_type', 'string', 4), ('member_months', 'plan_type', 'string', 5), ('member_months', 'month_start', 'date', 6)) t(mart, \"column\", type, position)")
def sem13_dictionary(spark, sf):
    """The data dictionary's rows for one mart."""
    return dictionary(spark, sf).filter("mart = 'member_months'")


@query("SELECT 'negative_paid' AS ref_id, 'CHECK negative paid: ' || count(*)::VARCHAR || ' rows' AS doc_text FROM fact_claim_line WHERE paid_amount < 0")
def sem11_quality_search(spark, sf):
    """The summary of what was set aside or failed a check that fits a question best. The summaries hold no payloads."""
    q = built(spark, sf, "bronze_claim").filter("record_status = 'QUARANTINE'").groupBy(F.col("quarantine_reason").alias("ref_id")).agg(F.count("*").alias("n")).select("ref_id", F.lit("QUARANTINE ").alias("kind"), "n")
    for name, failing in (("negative_paid", checks.accepted_range(claims(spark, sf), "paid_amount", 0)), ("missing_member", checks.not_null(claims(spark, sf), "member_id"))):
        q = q.unionByName(failing.agg(F.count("*").alias("n")).select(F.lit(name).alias("ref_id"), F.lit("CHECK ").alias("kind"), "n"))
    docs = q.select("ref_id", F.concat("kind", F.replace("ref_id", F.lit("_"), F.lit(" ")), F.lit(": "), F.col("n").cast("string"), F.lit(" rows")).alias("doc_text"))
    return search.search(docs, "ref_id", "doc_text", "which lines were paid a negative amount?", 1).join(docs, "ref_id").select("ref_id", "doc_text")


@query(f"WITH {marts._BASE}, p AS (SELECT claim_type, claim_month, sum(paid_amount) AS paid FROM base GROUP BY 1, 2) SELECT claim_type, claim_month, paid::DOUBLE AS paid, (paid - lag(paid) OVER (PARTITION BY claim_type ORDER BY claim_month NULLS FIRST))::DOUBLE AS change FROM p")
def sem14_month_over_month(spark, sf):
    """An analysis: paid by claim type and month, and the change from the month before, asked of the marts in SQL."""
    sql = "WITH p AS (SELECT claim_type, claim_month, sum(paid_amount) AS paid FROM {base} GROUP BY claim_type, claim_month) SELECT claim_type, claim_month, CAST(paid AS DOUBLE) AS paid, CAST(paid - lag(paid) OVER (PARTITION BY claim_type ORDER BY claim_month NULLS FIRST) AS DOUBLE) AS change FROM p"
    return spark.sql(sql, base=marts.mart(spark, sf, "base"))


@query(f"WITH {marts._BASE} SELECT claim_month, claim_type, count(*) AS lines, sum(paid_amount)::DOUBLE AS paid FROM base WHERE NOT denial_flag GROUP BY 1, 2")
def sem12_view(spark, sf):
    """A view on a mart, read by name."""
    marts.mart(spark, sf, "base").createOrReplaceTempView("vw_base")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW vw_paid_lines AS SELECT claim_month, claim_type, count(*) AS lines, CAST(sum(paid_amount) AS DOUBLE) AS paid FROM vw_base WHERE NOT denial_flag GROUP BY claim_month, claim_type")
    return spark.table("vw_paid_lines")


# sources, all of them


@query("SELECT 'CLAIM' AS event_type, (SELECT count(*) FROM fact_claim_line) AS landed UNION ALL SELECT 'ELIGIBILITY', (SELECT count(*) FROM eligibility_event) UNION ALL SELECT 'MEMBER', (SELECT count(*) FROM dim_patient) UNION ALL SELECT 'PLAN', (SELECT count(*) FROM dim_plan) UNION ALL SELECT 'PAYER', (SELECT count(*) FROM dim_payer)")
def src5_five_feeds(spark, sf):
    """Five feeds of NDJSON files in one folder, landed together and counted by their envelope."""
    path = scratch(spark, "feeds")
    for kind, name in (("CLAIM", "fact_claim_line"), ("ELIGIBILITY", "eligibility_event"), ("MEMBER", "dim_patient"), ("PLAN", "dim_plan"), ("PAYER", "dim_payer")):
        df = table(spark, sf, name)
        line = F.to_json(F.struct(F.lit(kind).alias("event_type"), F.lit(AS_OF).alias("business_event_ts"), F.struct(*df.columns[:4]).alias("payload")))
        df.select(line.alias("value")).write.mode("append").text(path)
    landed, rejected = readers.land(readers.read_numbered(spark, path), {"now": f"{AS_OF} 00:00:00", "batch_id": "B", "load_id": "L", "run_id": "R"})
    return landed.filter("business_event_ts is not null").groupBy("event_type").agg(F.count("*").alias("landed"))


@query("SELECT 'dim_payer' AS seed, count(*) AS n, count(payer_name) AS named FROM dim_payer UNION ALL SELECT 'dim_plan', count(*), count(plan_name) FROM dim_plan UNION ALL SELECT 'nation', count(*), count(n_name) FROM nation UNION ALL SELECT 'ref_claim_status', count(*), count(status_name) FROM ref_claim_status UNION ALL SELECT 'region', count(*), count(r_name) FROM region")
def src14_all_seeds(spark, sf):
    """The small tables as CSV seeds, read as text and counted."""
    out = None
    for name, label in (("dim_payer", "payer_name"), ("dim_plan", "plan_name"), ("nation", "n_name"), ("ref_claim_status", "status_name"), ("region", "r_name")):
        df, path = table(spark, sf, name), scratch(spark, name)
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.option("header", True).csv(path)
        row = readers.read_seed(spark, path, df.columns).agg(F.count("*").alias("n"), F.count(label).alias("named")).select(F.lit(name).alias("seed"), "n", "named")
        out = row if out is None else out.unionByName(row)
    return out
