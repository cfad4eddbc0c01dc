"""The other feeds, each by a specification: typed fields of the payload, natural key, rules, and one row per key and digest.

The test tables have no messages of these feeds but coverages, so queries write such messages from the rows of other tables first."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import expr as E
from tidewright.operators import nested
from tidewright.operators import relational as R
from tidewright.plans.problems import table
from tidewright.plans.reference import AS_OF, query

LATEST = "source_extract_ts", "ingest_ts"


@dataclass(frozen=True)
class Feed:
    """fields: SQL type by name; ids are normalized. key: the fields of the natural key (null where one is null, unless it is in `optional`).
    rules: (reason, condition in SQL on the typed fields), of which the first that holds sets a message aside."""

    name: str
    fields: dict[str, str]
    ids: tuple[str, ...]
    key: tuple[str, ...]
    rules: tuple[tuple[str, str], ...]
    optional: tuple[str, ...] = ()


_FUTURE = "{0} > date'" + AS_OF + "'"
#: The feeds and the rules by which their messages are set aside (fixed values).
FEEDS = {
    f.name: f
    for f in (
        Feed("eligibility", {"member_id": "string", "plan_id": "string", "payer_id": "string", "coverage_start_date": "date", "coverage_end_date": "date", "eligibility_status": "string"}, ("member_id", "plan_id", "payer_id"), ("member_id", "coverage_start_date", "plan_id"),
             (("MISSING_REQUIRED_KEY", "member_id is null or plan_id is null or coverage_start_date is null"), ("IMPOSSIBLE_COVERAGE_SPAN", "coverage_end_date < coverage_start_date"), ("FUTURE_DATED_EVENT", _FUTURE.format("coverage_start_date"))), ("coverage_start_date", "plan_id")),
        Feed("provider", {"npi": "string", "provider_name": "string", "specialty": "string", "taxonomy_code": "string", "effective_date": "date"}, ("npi",), ("npi",),
             (("MISSING_REQUIRED_KEY", "npi is null"), ("INVALID_NPI_FORMAT", "npi not rlike '^[0-9]{10}$'"), ("FUTURE_DATED_EVENT", _FUTURE.format("effective_date")))),
        Feed("pharmacy", {"pharmacy_claim_id": "string", "member_id": "string", "ndc": "string", "days_supply": "int", "fill_date": "date", "paid_amount": "decimal(18,2)", "prescriber_npi": "string", "pharmacy_npi": "string"}, ("pharmacy_claim_id", "member_id"), ("pharmacy_claim_id",),
             (("MISSING_REQUIRED_KEY", "pharmacy_claim_id is null or member_id is null"), ("FUTURE_DATED_EVENT", _FUTURE.format("fill_date")), ("NEGATIVE_PAID_NON_ADJUSTMENT", "paid_amount < 0"), ("INVALID_DAYS_SUPPLY", "days_supply <= 0"))),
        Feed("adjudication", {"adjudication_event_id": "string", "claim_id": "string", "claim_version": "int", "event_status": "string", "paid_before": "decimal(18,2)", "paid_after": "decimal(18,2)", "allowed_amount": "decimal(18,2)", "event_date": "date", "is_adjustment": "string"}, ("adjudication_event_id", "claim_id"), ("adjudication_event_id",),
             (("MISSING_REQUIRED_KEY", "adjudication_event_id is null or claim_id is null"), ("FUTURE_DATED_EVENT", _FUTURE.format("event_date")), ("NEGATIVE_PAID_NON_ADJUSTMENT", "paid_after < 0 and not is_adjustment"), ("PAID_EXCEEDS_ALLOWED", "paid_after > allowed_amount"))),
    )
}


def bronze(raw: DataFrame, feed: Feed) -> DataFrame:
    """Messages (bronze_event_id, source_extract_ts, ingest_ts, payload_hash, payload, business_event_ts) typed, keyed and judged: natural_key, digest,
    idempotency_key (key, digest and event time), the fields, record_status and quarantine_reason. Of those with the same key and digest the latest stays.
    Payloads that hold no object are left out; a field that doesn't fit its type is null."""
    v = raw.withColumn("_v", F.try_parse_json("payload")).filter(nested.is_object(F.col("_v")))

    def typed(name: str, kind: str) -> Column:
        text = E.variant_get(F.col("_v"), f"$.{name}")
        if name.startswith("is_"):
            return E.loose_boolean(text)
        if name in feed.ids:
            return E.norm_id(text)
        return F.try_to_date(text, "yyyy-MM-dd") if kind == "date" else text if kind == "string" else text.try_cast(kind)

    rows = v.select("bronze_event_id", *LATEST, "business_event_ts", F.coalesce("payload_hash", F.sha2("payload", 256)).alias("digest"), *[typed(n, t).alias(n) for n, t in feed.fields.items()])
    key = E.natural_key(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")) if c in feed.optional else F.col(c) for c in feed.key])
    rows = rows.withColumn("natural_key", key).withColumns(E.resolve_status(E.first_failing([(n, F.expr(c)) for n, c in feed.rules]), F.lit("LANDED"), F.lit(None).cast("string")))
    rows = rows.withColumn("idempotency_key", F.concat_ws("|", "natural_key", "digest", F.date_format("business_event_ts", "yyyy-MM-dd HH:mm:ss")))
    return R.latest_by(rows, ["natural_key", "digest"], [*[F.col(c).desc_nulls_last() for c in LATEST], F.col("bronze_event_id")])


def latest_valid(rows: DataFrame, key: str) -> DataFrame:
    """The newest valid message of each key."""
    return R.latest_by(rows.filter("record_status = 'VALID'"), [key], [*[F.col(c).desc_nulls_last() for c in LATEST], F.col("bronze_event_id")])


def pharmacy_claim(rows: DataFrame) -> DataFrame:
    """One row per pharmacy claim, NPIs padded to ten digits."""
    return latest_valid(rows, "pharmacy_claim_id").withColumns({c: F.lpad(E.clean_text(c), 10, "0") for c in ("prescriber_npi", "pharmacy_npi")})


def fact_pharmacy(claims: DataFrame) -> DataFrame:
    """Fills with keys of member, day and either provider."""
    k = E.surrogate_key
    return claims.select(k(F.col("pharmacy_claim_id")).alias("pharmacy_claim_sk"), k(F.col("member_id")).alias("patient_sk"), k(F.col("prescriber_npi")).alias("prescriber_sk"), k(F.col("pharmacy_npi")).alias("pharmacy_sk"), E.date_key(F.col("fill_date")).alias("fill_date_key"), "ndc", "days_supply", "paid_amount")


def fact_adjustment(events: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per adjudication event: what it changed, whether it raised, lowered or denied, and the claim's member where the claim is known."""
    change = F.col("paid_after") - F.col("paid_before")
    known = R.hot_join(events.select("adjudication_event_id", "claim_id", "event_status", "paid_before", "paid_after", "is_adjustment"), headers.select("claim_id", "member_id"), ["claim_id"], "left")
    return known.select("adjudication_event_id", "claim_id", "member_id", change.alias("paid_delta"), (F.coalesce(change, F.lit(0)) > 0).alias("is_increase"), (F.coalesce(change, F.lit(0)) < 0).alias("is_decrease"), (F.coalesce(F.upper("event_status"), F.lit("")) == "DENIED").alias("is_denial"), "is_adjustment")


# messages written from other tables


def _messages(rows: DataFrame, ident: str, fields: dict[str, Column]) -> DataFrame:
    payload = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"dateFormat": "yyyy-MM-dd"})
    return rows.select(F.col(ident).cast("string").alias("bronze_event_id"), "source_extract_ts", F.col("created_at").alias("ingest_ts"), F.lit(None).cast("string").alias("payload_hash"), payload.alias("payload"), F.col("created_at").alias("business_event_ts"))


def messages(spark: SparkSession, sf: str, feed: str) -> DataFrame:
    c = F.col
    if feed == "eligibility":
        names = ("member_id", "plan_id", "payer_id", "coverage_start_date", "coverage_end_date", "eligibility_status")
        return _messages(table(spark, sf, "eligibility_event"), "eligibility_event_id", {n: c(n) for n in names})
    fact = table(spark, sf, "fact_claim_line")
    fields = {
        "provider": {"npi": c("rendering_provider_npi"), "provider_name": F.concat(F.lit("P"), c("rendering_provider_npi")), "specialty": c("claim_type"), "effective_date": c("service_from_date")},
        "pharmacy": {"pharmacy_claim_id": c("claim_line_id"), "member_id": c("member_id"), "ndc": c("procedure_code"), "days_supply": c("units") - 1, "fill_date": c("service_from_date"), "paid_amount": c("paid_amount").cast("string"), "prescriber_npi": c("rendering_provider_npi"), "pharmacy_npi": F.lit("77")},
        "adjudication": {"adjudication_event_id": c("change_id").cast("string"), "claim_id": c("claim_id"), "claim_version": c("claim_version"), "event_status": c("claim_status"), "paid_before": c("patient_responsibility").cast("string"), "paid_after": c("paid_amount").cast("string"), "allowed_amount": c("allowed_amount").cast("string"), "event_date": c("paid_date"), "is_adjustment": c("units") == 2},
    }[feed]
    return _messages(fact, "change_id", fields)


_ID = "nullif(upper(trim({0}, ' \t\r\n')), '')"


@query(f"""WITH t AS (SELECT eligibility_event_id, source_extract_ts AS x, created_at AS i, {_ID.format('member_id')} AS m, {_ID.format('plan_id')} AS p, coverage_start_date AS s, coverage_end_date AS e, (member_id, plan_id, payer_id, coverage_start_date, coverage_end_date, eligibility_status) AS d FROM eligibility_event),
r AS (SELECT *, m || '|' || coalesce(s::VARCHAR, 'NA') || '|' || coalesce(p, 'NA') AS k FROM t QUALIFY row_number() OVER (PARTITION BY m || '|' || coalesce(s::VARCHAR, 'NA') || '|' || coalesce(p, 'NA'), d ORDER BY x DESC NULLS LAST, i DESC NULLS LAST, eligibility_event_id::VARCHAR) = 1)
SELECT k AS natural_key, CASE WHEN reason IS NULL THEN 'VALID' ELSE 'QUARANTINE' END AS record_status, reason AS quarantine_reason, count(*) AS n, min(eligibility_event_id)::VARCHAR AS least FROM (SELECT *, CASE WHEN m IS NULL OR p IS NULL OR s IS NULL THEN 'MISSING_REQUIRED_KEY' WHEN e < s THEN 'IMPOSSIBLE_COVERAGE_SPAN' WHEN s > DATE '{AS_OF}' THEN 'FUTURE_DATED_EVENT' END AS reason FROM r) GROUP BY 1, 2, 3""")
def ing1b_eligibility(spark, sf):
    out = bronze(messages(spark, sf, "eligibility"), FEEDS["eligibility"])
    return out.groupBy("natural_key", "record_status", "quarantine_reason").agg(F.count("*").alias("n"), F.min(F.col("bronze_event_id").cast("long")).cast("string").alias("least"))


@query(f"""WITH t AS (SELECT change_id, source_extract_ts AS x, created_at AS i, {_ID.format('rendering_provider_npi')} AS npi, service_from_date AS s, (rendering_provider_npi, claim_type, service_from_date) AS d FROM fact_claim_line), r AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY npi, d ORDER BY x DESC NULLS LAST, i DESC NULLS LAST, change_id::VARCHAR) = 1)
SELECT npi, CASE WHEN npi IS NULL THEN 'MISSING_REQUIRED_KEY' WHEN NOT regexp_full_match(npi, '[0-9]{{10}}') THEN 'INVALID_NPI_FORMAT' WHEN s > DATE '{AS_OF}' THEN 'FUTURE_DATED_EVENT' END AS quarantine_reason, count(*) AS n FROM r GROUP BY 1, 2""")
def ing3c_provider(spark, sf):
    return bronze(messages(spark, sf, "provider"), FEEDS["provider"]).groupBy("npi", "quarantine_reason").agg(F.count("*").alias("n"))


_FILLS = f"""t AS (SELECT change_id, source_extract_ts AS x, created_at AS i, {_ID.format('claim_line_id')} AS k, {_ID.format('member_id')} AS m, units - 1 AS days, service_from_date AS s, paid_amount AS a, procedure_code AS ndc, rendering_provider_npi AS npi, (claim_line_id, member_id, procedure_code, units, service_from_date, paid_amount, rendering_provider_npi) AS d FROM fact_claim_line),
r AS (SELECT *, CASE WHEN k IS NULL OR m IS NULL THEN 'MISSING_REQUIRED_KEY' WHEN s > DATE '{AS_OF}' THEN 'FUTURE_DATED_EVENT' WHEN a < 0 THEN 'NEGATIVE_PAID_NON_ADJUSTMENT' WHEN days <= 0 THEN 'INVALID_DAYS_SUPPLY' END AS reason FROM t QUALIFY row_number() OVER (PARTITION BY k, d ORDER BY x DESC NULLS LAST, i DESC NULLS LAST, change_id::VARCHAR) = 1)"""


@query(f"WITH {_FILLS} SELECT k AS natural_key, reason AS quarantine_reason, count(*) AS n FROM r GROUP BY 1, 2")
def ing3d_pharmacy(spark, sf):
    return bronze(messages(spark, sf, "pharmacy"), FEEDS["pharmacy"]).groupBy("natural_key", "quarantine_reason").agg(F.count("*").alias("n"))


_KEY = "md5(coalesce({0}, '_dbt_utils_surrogate_key_null_'))"


@query(f"WITH {_FILLS}, c AS (SELECT * FROM r WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY x DESC NULLS LAST, i DESC NULLS LAST, change_id::VARCHAR) = 1), z AS (SELECT *, CASE WHEN trim(npi) <> '' THEN lpad(left(trim(npi), 10), 10, '0') END AS q FROM c) SELECT {_KEY.format('k')} AS pharmacy_claim_sk, {_KEY.format('m')} AS patient_sk, {_KEY.format('q')} AS prescriber_sk, md5('0000000077') AS pharmacy_sk, strftime(s, '%Y%m%d')::INT AS fill_date_key, ndc, days AS days_supply, a::DOUBLE AS paid_amount FROM z")
def fct4_can14_pharmacy(spark, sf):
    """Pharmacy messages to claims to fills."""
    out = fact_pharmacy(pharmacy_claim(bronze(messages(spark, sf, "pharmacy"), FEEDS["pharmacy"])))
    return out.withColumn("paid_amount", F.col("paid_amount").cast("double"))


_EVENTS = f"""t AS (SELECT change_id, {_ID.format('claim_id')} AS c, claim_status AS st, paid_date AS s, patient_responsibility AS b, paid_amount AS a, allowed_amount AS w, coalesce(units = 2, false) AS adj FROM fact_claim_line),
r AS (SELECT *, CASE WHEN c IS NULL THEN 'MISSING_REQUIRED_KEY' WHEN s > DATE '{AS_OF}' THEN 'FUTURE_DATED_EVENT' WHEN a < 0 AND NOT adj THEN 'NEGATIVE_PAID_NON_ADJUSTMENT' WHEN a > w THEN 'PAID_EXCEEDS_ALLOWED' END AS reason FROM t)"""


@query(f"WITH {_EVENTS} SELECT change_id::VARCHAR AS natural_key, CASE WHEN reason IS NULL THEN 'VALID' ELSE 'QUARANTINE' END AS record_status, reason AS quarantine_reason FROM r")
def ing3e_adjudication(spark, sf):
    return bronze(messages(spark, sf, "adjudication"), FEEDS["adjudication"]).select("natural_key", "record_status", "quarantine_reason")


@query(f"WITH {_EVENTS}, h AS (SELECT {_ID.format('claim_id')} AS c, max({_ID.format('member_id')}) AS m FROM fact_claim_line GROUP BY 1) SELECT change_id::VARCHAR AS adjudication_event_id, r.c AS claim_id, m AS member_id, (a - b)::DOUBLE AS paid_delta, coalesce(a > b, false) AS is_increase, coalesce(a < b, false) AS is_decrease, coalesce(upper(st) = 'DENIED', false) AS is_denial, adj AS is_adjustment FROM r LEFT JOIN h ON r.c = h.c WHERE reason IS NULL")
def fct3_can15_adjudication(spark, sf):
    """Adjudication messages to events to what they changed."""
    events = latest_valid(bronze(messages(spark, sf, "adjudication"), FEEDS["adjudication"]), "adjudication_event_id")
    headers = table(spark, sf, "fact_claim_line").groupBy(E.norm_id("claim_id").alias("claim_id")).agg(F.max(E.norm_id("member_id")).alias("member_id"))
    return fact_adjustment(events, headers).withColumn("paid_delta", F.col("paid_delta").cast("double"))


@query("SELECT upper(trim(natural_key)) || '|' || coalesce(payload_hash, sha256(payload)) || '|' || strftime(business_event_ts, '%Y-%m-%d %H:%M:%S') AS k, count(*) AS n FROM br_raw_claim_event WHERE json_valid(payload) AND payload LIKE '{%' AND business_event_ts IS NOT NULL AND trim(natural_key) <> '' GROUP BY 1")
def ing8_idempotency_key(spark, sf):
    """Messages by key, digest and event time."""
    rows = table(spark, sf, "br_raw_claim_event").filter(nested.is_object(F.try_parse_json("payload")) & F.col("payload").startswith("{") & F.col("business_event_ts").isNotNull() & (F.trim("natural_key") != ""))
    key = F.concat(F.upper(F.trim("natural_key")), F.lit("|"), F.coalesce("payload_hash", F.sha2("payload", 256)), F.lit("|"), F.date_format("business_event_ts", "yyyy-MM-dd HH:mm:ss"))
    return rows.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
