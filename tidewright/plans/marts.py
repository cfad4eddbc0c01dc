"""Marts at their full grain over the lines in force, the metrics on them, verified questions, and the calls that serve them.

The base and the member months are tables that are built once in an application for each input folder; all else reads them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright import session
from tidewright.functions import expr as E
from tidewright.operators import nested
from tidewright.operators import relational as R
from tidewright.plans import reference
from tidewright.plans.claims import dim2_patient
from tidewright.plans.problems import CLAIM_CHILDREN, P1_SQL, p1_found, table
from tidewright.plans.reference import query
from tidewright.semantic import layer, search, serving
from tidewright.session import lookup_side, scratch

_built: dict[tuple[str, str, str], str] = {}


def mart(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A mart by name, written to the shared folder when it is first asked for."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _built or _built[at] not in session._written.get(at[0], ()):
        path = scratch(spark, name)
        MARTS[name](spark, sf).write.parquet(path)
        _built[at] = path
    return spark.read.parquet(_built[at])


def dbl(c: str) -> Column:
    return F.sum(c).cast("double")


def claim_notes(spark: SparkSession, sf: str) -> DataFrame:
    """What the messages say of a claim: its least diagnosis code and its greatest denial reason."""
    rows = table(spark, sf, "br_raw_claim_event").select("payload", F.try_parse_json("payload").alias("v")).filter(nested.is_object(F.col("v")))
    keyed = rows.select("payload", E.norm_id(E.variant_get(F.col("v"), "$.claim_id")).alias("claim_id"), E.norm_id(E.variant_get(F.col("v"), "$.denial_reason_code")).alias("denial_reason_code")).filter("claim_id is not null")
    codes = nested.explode_children(keyed, "claim_id", "payload", [CLAIM_CHILDREN[1]]).select(F.col("record_key").alias("claim_id"), F.nullif("child_key", F.lit("")).alias("diagnosis_code"), F.lit(None).cast("string").alias("denial_reason_code"))
    return codes.unionByName(keyed.select("claim_id", F.lit(None).cast("string").alias("diagnosis_code"), "denial_reason_code")).groupBy("claim_id").agg(F.min("diagnosis_code").alias("diagnosis_code"), F.max("denial_reason_code").alias("denial_reason_code"))


def base(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in force with the attributes of all their dimensions: payers, plans and statuses by broadcast, members, claims and providers by joins that
    spread hot keys."""
    fact = table(spark, sf, "fact_claim_line").withColumns({c: E.norm_id(c) for c in ("claim_id", "claim_line_id", "member_id", "payer_id", "plan_id", "claim_status", "procedure_code")})
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    status = table(spark, sf, "ref_claim_status").select(E.norm_id("status_code").alias("claim_status"), "status_name", flag("is_denied").alias("denial_flag"), flag("is_adjustment").alias("_adj"), (flag("is_void") | flag("is_reversal")).alias("_rev")).filter("claim_status is not null")
    status = lookup_side(status.groupBy("claim_status").agg(F.min("status_name").alias("status_name"), *[F.bool_or(c).alias(c) for c in ("denial_flag", "_adj", "_rev")]))
    payer = table(spark, sf, "dim_payer").groupBy(E.norm_id("payer_id").alias("payer_id")).agg(F.min("payer_name").alias("payer_name"), F.min("payer_type").alias("payer_type")).filter("payer_id is not null")
    plan = table(spark, sf, "dim_plan").groupBy(E.norm_id("plan_id").alias("plan_id")).agg(F.min("plan_type").alias("plan_type")).filter("plan_id is not null")
    chains = fact.join(status.select("claim_status", "_adj", "_rev"), "claim_status").groupBy("claim_id").agg(F.bool_or("_adj").alias("adjustment_flag"), F.bool_or("_rev").alias("reversal_flag"))
    specialty = R.mode_by(fact.filter("rendering_provider_npi is not null"), ["rendering_provider_npi"], "claim_type").withColumnRenamed("claim_type", "specialty")
    lines = fact.join(p1_found(spark, sf).select("change_id"), "change_id", "left_semi")
    out = lines.join(lookup_side(payer), "payer_id", "left").join(lookup_side(plan), "plan_id", "left").join(status.drop("_adj", "_rev"), "claim_status", "left")
    members = dim2_patient(spark, sf).join(R.latest_by(table(spark, sf, "dim_patient").withColumn("member_id", E.norm_id("member_id")).filter("is_current and member_id is not null"), ["member_id"], [F.col("effective_from").desc_nulls_last(), F.col("patient_key")]).select("member_id", "gender"), "member_id")
    out = R.hot_join(out, members, ["member_id"], "left")
    out = R.hot_join(out, chains.join(claim_notes(spark, sf), "claim_id", "full"), ["claim_id"], "left")
    out = R.hot_join(out, specialty, ["rendering_provider_npi"], "left")
    unknown = lambda c, v="UNKNOWN": F.coalesce(F.col(c), F.lit(v)).alias(c)
    return out.select(
        "change_id", "claim_id", "claim_line_id", "member_id", "payer_id", "plan_id", unknown("payer_name"), unknown("payer_type"), unknown("plan_type"), unknown("claim_type"), unknown("claim_status"), unknown("status_name"), F.coalesce("denial_flag", F.lit(False)).alias("denial_flag"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("adjustment_flag", "reversal_flag")], F.coalesce("denial_reason_code", F.lit("NONE")).alias("denial_reason_code"), F.coalesce(F.left("diagnosis_code", F.lit(1)), F.lit("UNGROUPED")).alias("condition_group"),
        unknown("age_band"), unknown("gender"), unknown("state"), F.trunc("service_from_date", "month").alias("claim_month"), F.year("service_from_date").alias("service_year"), F.col("rendering_provider_npi").alias("provider_npi"), unknown("specialty"),
        F.coalesce(F.left("procedure_code", F.lit(2)), F.lit("NONE")).alias("procedure_category"), "charge_amount", "allowed_amount", "paid_amount", "patient_responsibility", "units",
    )


def member_months(spark: SparkSession, sf: str) -> DataFrame:
    """Member x payer x plan x month, named."""
    rows = table(spark, sf, "eligibility_event").select(E.norm_id("member_id").alias("member_id"), E.norm_id("payer_id").alias("payer_id"), E.norm_id("plan_id").alias("plan_id"), F.col("coverage_start_date").alias("s"), F.least(F.coalesce("coverage_end_date", F.to_date(F.lit(reference.AS_OF))), F.to_date(F.lit(reference.AS_OF))).alias("e"))
    months = R.expand_months(rows.filter("member_id is not null and s is not null"), "s", "e", reference.AS_OF).select("member_id", "payer_id", "plan_id", "month").distinct()
    payer = table(spark, sf, "dim_payer").groupBy(E.norm_id("payer_id").alias("payer_id")).agg(F.min("payer_name").alias("payer_name"), F.min("payer_type").alias("payer_type")).filter("payer_id is not null")
    plan = table(spark, sf, "dim_plan").groupBy(E.norm_id("plan_id").alias("plan_id")).agg(F.min("plan_type").alias("plan_type")).filter("plan_id is not null")
    out = months.join(lookup_side(payer), "payer_id", "left").join(lookup_side(plan), "plan_id", "left")
    return out.select("member_id", "payer_id", "plan_id", *[F.coalesce(c, F.lit("UNKNOWN")).alias(c) for c in ("payer_name", "payer_type", "plan_type")], F.col("month").alias("month_start"))


MARTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"base": base, "member_months": member_months}

_N = "nullif(upper(trim({0}, ' \t\r\n')), '')"
_ATTRS = f"""
py AS (SELECT {_N.format('payer_id')} AS k, min(payer_name) AS payer_name, min(payer_type) AS payer_type FROM dim_payer GROUP BY 1), pl AS (SELECT {_N.format('plan_id')} AS k, min(plan_type) AS plan_type FROM dim_plan GROUP BY 1),
mm AS (SELECT DISTINCT m, y, p, unnest(generate_series(date_trunc('month', s)::TIMESTAMP, date_trunc('month', e - 1)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month_start FROM (SELECT {_N.format('member_id')} AS m, {_N.format('payer_id')} AS y, {_N.format('plan_id')} AS p, coverage_start_date AS s, least(coalesce(coverage_end_date, DATE '{reference.AS_OF}'), DATE '{reference.AS_OF}') AS e FROM eligibility_event) WHERE m IS NOT NULL AND s < e),
months AS (SELECT m AS member_id, y AS payer_id, p AS plan_id, coalesce(payer_name, 'UNKNOWN') AS payer_name, coalesce(payer_type, 'UNKNOWN') AS payer_type, coalesce(plan_type, 'UNKNOWN') AS plan_type, month_start FROM mm LEFT JOIN py ON mm.y = py.k LEFT JOIN pl ON mm.p = pl.k)"""
_BASE = f"""{_ATTRS},
st AS (SELECT {_N.format('status_code')} AS k, min(status_name) AS status_name, bool_or(coalesce(is_denied, false)) AS denied, bool_or(coalesce(is_adjustment, false)) AS adj, bool_or(coalesce(is_void, false) OR coalesce(is_reversal, false)) AS rev FROM ref_claim_status GROUP BY 1),
ff AS (SELECT f.* REPLACE ({_N.format('claim_id')} AS claim_id, {_N.format('claim_line_id')} AS claim_line_id, {_N.format('member_id')} AS member_id, {_N.format('payer_id')} AS payer_id, {_N.format('plan_id')} AS plan_id, {_N.format('claim_status')} AS claim_status, {_N.format('procedure_code')} AS procedure_code) FROM fact_claim_line f),
ch AS (SELECT claim_id, bool_or(adj) AS adjustment_flag, bool_or(rev) AS reversal_flag FROM ff JOIN st ON claim_status = st.k GROUP BY 1),
sp AS (SELECT npi, ct FROM (SELECT rendering_provider_npi AS npi, claim_type AS ct, count(*) AS n FROM fact_claim_line WHERE claim_type IS NOT NULL AND rendering_provider_npi IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY npi ORDER BY n DESC, ct) = 1),
ms AS (SELECT nullif(upper(trim(j->>'$.claim_id')), '') AS c, nullif(upper(trim(j->>'$.denial_reason_code')), '') AS r, j FROM (SELECT CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM br_raw_claim_event) WHERE json_type(j) = 'OBJECT'),
dg AS (SELECT c, min(nullif(e->>'$.diagnosis_code', '')) AS dx FROM (SELECT c, unnest({reference._forms('x')}) AS e FROM (SELECT c, j->'$.diagnoses' AS x FROM ms)) WHERE json_type(e) = 'OBJECT' GROUP BY 1), dn AS (SELECT c, max(r) AS r FROM ms GROUP BY 1),
pt AS (SELECT {_N.format('member_id')} AS k, state, gender, CASE WHEN 2025 - birth_year < 18 THEN '<18' WHEN 2025 - birth_year < 35 THEN '18-34' WHEN 2025 - birth_year < 50 THEN '35-49' WHEN 2025 - birth_year < 65 THEN '50-64' ELSE '65+' END AS age_band FROM dim_patient WHERE is_current AND trim(member_id) <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY effective_from DESC NULLS LAST, patient_key) = 1),
base AS (SELECT ff.change_id, ff.claim_id, ff.claim_line_id, ff.member_id, ff.payer_id, ff.plan_id, coalesce(payer_name, 'UNKNOWN') AS payer_name, coalesce(payer_type, 'UNKNOWN') AS payer_type, coalesce(plan_type, 'UNKNOWN') AS plan_type, coalesce(claim_type, 'UNKNOWN') AS claim_type, coalesce(claim_status, 'UNKNOWN') AS claim_status, coalesce(status_name, 'UNKNOWN') AS status_name,
  coalesce(denied, false) AS denial_flag, coalesce(adjustment_flag, false) AS adjustment_flag, coalesce(reversal_flag, false) AS reversal_flag, coalesce(dn.r, 'NONE') AS denial_reason_code, coalesce(left(dx, 1), 'UNGROUPED') AS condition_group, coalesce(age_band, 'UNKNOWN') AS age_band, coalesce(gender, 'UNKNOWN') AS gender, coalesce(state, 'UNKNOWN') AS state,
  date_trunc('month', service_from_date)::DATE AS claim_month, year(service_from_date)::INT AS service_year, rendering_provider_npi AS provider_npi, coalesce(ct, 'UNKNOWN') AS specialty, coalesce(left(procedure_code, 2), 'NONE') AS procedure_category, charge_amount, allowed_amount, paid_amount, patient_responsibility, units
  FROM ff JOIN ({P1_SQL}) live ON ff.change_id = live.change_id LEFT JOIN py ON ff.payer_id = py.k LEFT JOIN pl ON ff.plan_id = pl.k LEFT JOIN st ON ff.claim_status = st.k LEFT JOIN ch ON ff.claim_id = ch.claim_id LEFT JOIN sp ON ff.rendering_provider_npi = sp.npi LEFT JOIN dg ON ff.claim_id = dg.c LEFT JOIN dn ON ff.claim_id = dn.c LEFT JOIN pt ON ff.member_id = pt.k)
"""
_MONEY = ("charge_amount", "allowed_amount", "paid_amount", "patient_responsibility")
_SUMS = "sum(paid_amount)::DOUBLE AS total_paid, sum(allowed_amount)::DOUBLE AS total_allowed, sum(charge_amount)::DOUBLE AS total_charge"
_RATIO = "count(DISTINCT CASE WHEN denial_flag THEN claim_id END)::DOUBLE / count(DISTINCT claim_id)"


def sums() -> list[Column]:
    return [dbl("paid_amount").alias("total_paid"), dbl("allowed_amount").alias("total_allowed"), dbl("charge_amount").alias("total_charge")]


def denied() -> Column:
    return F.count_distinct(F.when(F.col("denial_flag"), F.col("claim_id")))


@query(f"WITH {_BASE} SELECT * REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in _MONEY)}) FROM base")
def gld1_base(spark, sf):
    return mart(spark, sf, "base").withColumns({c: F.col(c).cast("double") for c in _MONEY})


@query(f"WITH {_ATTRS} SELECT payer_id, plan_id, payer_name, payer_type, plan_type, month_start, count(*) AS member_months, count(DISTINCT member_id) AS distinct_members FROM months GROUP BY ALL")
def gld2_payer_plan_months(spark, sf):
    return mart(spark, sf, "member_months").groupBy("payer_id", "plan_id", "payer_name", "payer_type", "plan_type", "month_start").agg(F.count("*").alias("member_months"), F.count_distinct("member_id").alias("distinct_members"))


_PAYER_PLAN = f"""c AS (SELECT payer_id, plan_id, claim_month, payer_name, payer_type, plan_type, {_SUMS}, sum(patient_responsibility)::DOUBLE AS total_patient_responsibility, count(DISTINCT claim_id) AS claim_count, count(*) AS claim_line_count, count(*) FILTER (denial_flag) AS denied_line_count, count(DISTINCT CASE WHEN denial_flag THEN claim_id END) AS denied_claim_count FROM base GROUP BY ALL),
n AS (SELECT payer_id, plan_id, month_start, count(*) AS member_months FROM months GROUP BY ALL), payer_plan AS (SELECT c.* EXCLUDE (claim_month), claim_month AS month_start, coalesce(member_months, 0) AS member_months, total_paid / nullif(member_months, 0) AS pmpm, denied_claim_count::DOUBLE / claim_count AS denial_rate FROM c LEFT JOIN n ON c.payer_id = n.payer_id AND c.plan_id = n.plan_id AND c.claim_month = n.month_start)"""


@query(f"WITH {_BASE}, {_PAYER_PLAN} SELECT * FROM payer_plan")
def gld3_payer_plan_summary(spark, sf):
    """Per payer, plan and month: amounts, claims, member months, PMPM and denial rate. Two aggregates to one grain, then a join."""
    c = mart(spark, sf, "base").groupBy("payer_id", "plan_id", "claim_month", "payer_name", "payer_type", "plan_type").agg(
        *sums(), dbl("patient_responsibility").alias("total_patient_responsibility"), F.count_distinct("claim_id").alias("claim_count"), F.count("*").alias("claim_line_count"), F.count_if("denial_flag").alias("denied_line_count"), denied().alias("denied_claim_count")
    )
    n = mart(spark, sf, "member_months").groupBy("payer_id", "plan_id", F.col("month_start").alias("claim_month")).agg(F.count("*").alias("_n"))
    out = c.join(n, ["payer_id", "plan_id", "claim_month"], "left").withColumnRenamed("claim_month", "month_start")
    return out.select("*", F.coalesce("_n", F.lit(0)).alias("member_months"), E.ratio(F.col("total_paid"), F.col("_n")).alias("pmpm"), (F.col("denied_claim_count") / F.col("claim_count")).alias("denial_rate")).drop("_n")


_DENIAL_KEYS = "payer_id, plan_id, payer_name, payer_type, plan_type, claim_month, claim_status, status_name, denial_reason_code, denial_reason"
_DENIALS = f"""d AS (SELECT *, CASE WHEN denial_reason_code <> 'NONE' THEN 'Reason ' || denial_reason_code WHEN denial_flag THEN 'Unspecified' ELSE 'Not Denied' END AS denial_reason FROM base),
denials AS (SELECT {_DENIAL_KEYS}, count(DISTINCT claim_id) AS total_claims, count(DISTINCT CASE WHEN denial_flag THEN claim_id END) AS denied_claims, {_RATIO} AS denial_rate, coalesce(sum(CASE WHEN denial_flag THEN allowed_amount - paid_amount ELSE 0 END), 0)::DOUBLE AS denied_paid_impact FROM d GROUP BY ALL)"""


@query(f"WITH {_BASE}, {_DENIALS} SELECT * FROM denials")
def gld4_denial_summary(spark, sf):
    """Denials by ten keys."""
    reason = F.when(F.col("denial_reason_code") != "NONE", F.concat(F.lit("Reason "), "denial_reason_code")).when(F.col("denial_flag"), "Unspecified").otherwise("Not Denied")
    rows = mart(spark, sf, "base").withColumn("denial_reason", reason)
    withheld = F.sum(F.when(F.col("denial_flag"), F.col("allowed_amount") - F.col("paid_amount")).otherwise(0))
    out = rows.groupBy(*_DENIAL_KEYS.split(", ")).agg(F.count_distinct("claim_id").alias("total_claims"), denied().alias("denied_claims"), F.coalesce(withheld, F.lit(0)).cast("double").alias("denied_paid_impact"))
    return out.withColumn("denial_rate", F.col("denied_claims") / F.col("total_claims"))


_CONDITIONS = f"""pr AS (SELECT condition_group, claim_month, procedure_category, row_number() OVER (PARTITION BY condition_group, claim_month ORDER BY sum(paid_amount) DESC NULLS LAST, procedure_category) AS rn FROM base GROUP BY 1, 2, 3), tp AS (SELECT condition_group, claim_month, list(procedure_category ORDER BY rn) AS top_procedures FROM pr WHERE rn <= 5 GROUP BY 1, 2),
ca AS (SELECT condition_group, claim_month, count(DISTINCT member_id) AS distinct_members_with_condition, count(DISTINCT claim_id) AS claims, {_SUMS} FROM base GROUP BY 1, 2), conditions AS (SELECT ca.*, CASE WHEN distinct_members_with_condition > 0 THEN total_paid / distinct_members_with_condition ELSE 0 END AS paid_per_member, top_procedures FROM ca LEFT JOIN tp ON ca.condition_group = tp.condition_group AND ca.claim_month IS NOT DISTINCT FROM tp.claim_month)"""


@query(f"WITH {_BASE}, {_CONDITIONS} SELECT * FROM conditions")
def gld5_condition_cost(spark, sf):
    """Per condition group and month: members, amounts, paid per member and the five costliest procedure categories."""
    rows, keys = mart(spark, sf, "base"), ["condition_group", "claim_month"]
    a = rows.groupBy(*keys).agg(F.count_distinct("member_id").alias("distinct_members_with_condition"), F.count_distinct("claim_id").alias("claims"), *sums())
    t = R.topk_array(rows, keys, "procedure_category", F.col("paid_amount"), 5).withColumnsRenamed({k: f"_{k}" for k in keys} | {"top_values": "top_procedures"})
    both = a.join(t, (a.condition_group == t._condition_group) & a.claim_month.eqNullSafe(t._claim_month), "left").drop("_condition_group", "_claim_month")
    per = F.when(F.col("distinct_members_with_condition") > 0, F.col("total_paid") / F.nullif("distinct_members_with_condition", F.lit(0))).otherwise(0.0)
    return both.withColumn("paid_per_member", per)


_PROVIDERS = f"providers AS (SELECT provider_npi, specialty, claim_month AS month_start, count(DISTINCT claim_id) AS claims, count(*) AS claim_lines, count(DISTINCT member_id) AS distinct_members, {_SUMS}, sum(paid_amount)::DOUBLE / nullif(count(DISTINCT member_id), 0) AS paid_per_member FROM base GROUP BY 1, 2, 3)"


@query(f"WITH {_BASE}, {_PROVIDERS} SELECT * FROM providers")
def gld6_provider_month(spark, sf):
    out = mart(spark, sf, "base").groupBy("provider_npi", "specialty", F.col("claim_month").alias("month_start")).agg(F.count_distinct("claim_id").alias("claims"), F.count("*").alias("claim_lines"), F.count_distinct("member_id").alias("distinct_members"), *sums())
    return out.withColumn("paid_per_member", E.ratio(F.col("total_paid"), F.col("distinct_members")))


_COHORT_KEYS = "member_id, condition_group, age_band, gender, state, payer_type, payer_id, plan_id, claim_month, service_year"


@query(f"WITH {_BASE} SELECT {_COHORT_KEYS}, count(DISTINCT claim_id) AS claims, count(*) AS claim_lines, {_SUMS}, sum(patient_responsibility)::DOUBLE AS total_patient_responsibility, max(CASE WHEN denial_flag THEN 1 ELSE 0 END) AS any_denial_flag FROM base GROUP BY ALL")
def gld7_cohort_cube(spark, sf):
    """Members' costs by ten keys."""
    out = mart(spark, sf, "base").groupBy(*_COHORT_KEYS.split(", "))
    return out.agg(F.count_distinct("claim_id").alias("claims"), F.count("*").alias("claim_lines"), *sums(), dbl("patient_responsibility").alias("total_patient_responsibility"), F.max(F.when(F.col("denial_flag"), 1).otherwise(0)).alias("any_denial_flag"))


@query(f"WITH {_BASE}, {_CONDITIONS}, {_PROVIDERS}, pm AS (SELECT month_start, sum(total_paid) AS provider_paid FROM providers GROUP BY 1), cm AS (SELECT claim_month, sum(total_paid) AS condition_paid FROM conditions GROUP BY 1) SELECT month_start, round(provider_paid, 2) AS provider_paid, round(condition_paid, 2) AS condition_paid FROM pm JOIN cm ON month_start = claim_month")
def jn15_mart_to_mart(spark, sf):
    """Two marts joined: what providers and conditions were paid per month."""
    p = gld6_provider_month(spark, sf).groupBy("month_start").agg(F.round(F.sum("total_paid"), 2).alias("provider_paid"))
    c = gld5_condition_cost(spark, sf).groupBy(F.col("claim_month").alias("month_start")).agg(F.round(F.sum("total_paid"), 2).alias("condition_paid"))
    return p.join(c, "month_start")


# the metrics

_DIMS = ("payer_name", "payer_type", "plan_type", "specialty", "condition_group", "claim_type", "claim_status", "denial_reason_code", "age_band", "month")


def model(spark: SparkSession, sf: str) -> layer.Model:
    """The certified metrics: base ones on lines and member months, ratios on those."""
    lines = mart(spark, sf, "base").withColumnRenamed("claim_month", "month")
    months = mart(spark, sf, "member_months").withColumnRenamed("month_start", "month")
    on = lambda name, f, text, additive=True, synonyms=(): layer.Metric(name, "lines", f, additive=additive, synonyms=synonyms, description=text)
    chain = lambda c: F.count_distinct(F.when(F.col(c), F.col("claim_id")))
    metrics = [
        on("total_paid_amount", lambda: dbl("paid_amount"), "Paid for the lines in force", synonyms=("paid", "cost", "spend")),
        on("allowed_amount", lambda: dbl("allowed_amount"), "Allowed by contract", synonyms=("allowed",)),
        on("charge_amount", lambda: dbl("charge_amount"), "Billed", synonyms=("charge", "billed")),
        on("patient_responsibility", lambda: dbl("patient_responsibility"), "Share of the member", synonyms=("cost share",)),
        layer.Metric("pmpm", over=("total_paid_amount", "member_months"), additive=False, description="Paid per member and month", synonyms=("per member per month",)),
        layer.Metric("member_months", "months", lambda: F.count("*"), description="Covered months of members"),
        on("distinct_members", lambda: F.count_distinct("member_id"), "Members with a claim", False, ("members",)),
        layer.Metric("denial_rate", over=("denied_claims", "claims_volume"), additive=False, description="Share of claims with a denied line"),
        on("adjustment_count", lambda: chain("adjustment_flag"), "Claims with an adjustment in their chain", False),
        on("reversal_count", lambda: chain("reversal_flag"), "Claims with a reversal or void in their chain", False),
        on("claims_volume", lambda: F.count_distinct("claim_id"), "Claims", False, ("claims", "volume")),
        layer.Metric("denied_claims", "lines", lambda: denied(), additive=False, certified=False, description="Claims with a denied line; a part of denial_rate"),
    ]
    return layer.Model({"lines": lines, "months": months}, {m.name: m for m in metrics}, {"lines": _DIMS, "months": ("payer_name", "payer_type", "plan_type", "month")}, {"payer": "payer_name", "plan": "plan_type", "period": "month", "diagnosis group": "condition_group"})


_NAMES = ("total_paid_amount", "allowed_amount", "charge_amount", "patient_responsibility", "pmpm", "member_months", "distinct_members", "denial_rate", "adjustment_count", "reversal_count", "claims_volume")


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', {n in ('total_paid_amount', 'allowed_amount', 'charge_amount', 'patient_responsibility', 'member_months')}, '{'RATIO' if n in ('pmpm', 'denial_rate') else 'BASE'}', {4 if n in ('pmpm', 'member_months') else 10})" for n in _NAMES) + ") t(metric_name, is_additive, kind, n_dimensions)")
def sem1_certified_metrics(spark, sf):
    """The registry of certified metrics, with the number of dimensions by which each may be asked (of a ratio: those of both parts)."""
    return model(spark, sf).registry(spark).filter("is_certified").select("metric_name", "is_additive", "kind", F.size("allowed_dimensions").alias("n_dimensions"))


_ALL = """sum(paid_amount)::DOUBLE AS total_paid_amount, sum(allowed_amount)::DOUBLE AS allowed_amount, sum(charge_amount)::DOUBLE AS charge_amount, sum(patient_responsibility)::DOUBLE AS patient_responsibility, count(DISTINCT member_id) AS distinct_members,
count(DISTINCT CASE WHEN adjustment_flag THEN claim_id END) AS adjustment_count, count(DISTINCT CASE WHEN reversal_flag THEN claim_id END) AS reversal_count, count(DISTINCT claim_id) AS claims_volume, """ + _RATIO + " AS denial_rate"


@query(f"WITH {_BASE}, l AS (SELECT plan_type, claim_month AS month, {_ALL} FROM base GROUP BY 1, 2), n AS (SELECT plan_type, month_start AS month, count(*) AS member_months FROM months GROUP BY 1, 2) SELECT coalesce(l.plan_type, n.plan_type) AS plan_type, coalesce(l.month, n.month) AS month, l.* EXCLUDE (plan_type, month), member_months, total_paid_amount / nullif(member_months, 0) AS pmpm FROM l FULL JOIN n ON l.plan_type = n.plan_type AND l.month IS NOT DISTINCT FROM n.month")
def sem2_all_metrics(spark, sf):
    """All certified metrics by plan type and month, from two logical tables that are aggregated before they meet."""
    return model(spark, sf).query(list(_NAMES), ["plan", "period"])


@query(f"WITH {_BASE} SELECT condition_group, claim_status, {_ALL} FROM base WHERE plan_type <> 'UNKNOWN' GROUP BY 1, 2")
def sem4_by_synonyms(spark, sf):
    """Metrics and dimensions named by their synonyms, with a filter."""
    return model(spark, sf).query(["cost", "allowed", "Billed", "cost share", "members", "adjustment_count", "reversal_count", "Claims", "denial_rate"], ["Diagnosis Group", "claim_status"], ["plan_type <> 'UNKNOWN'"])


# verified questions: the marts they read, what they ask, and the same in SQL

VERIFIED: dict[str, tuple[str, str]] = {
    "total_paid_by_month": ("base", "SELECT claim_month, sum(paid_amount) AS total_paid_amount FROM base GROUP BY claim_month"),
    "pmpm_by_plan_type": ("payer_plan", "SELECT plan_type, sum(total_paid) AS total_paid_amount, sum(member_months) AS member_months, sum(total_paid) / nullif(sum(member_months), 0) AS pmpm FROM payer_plan GROUP BY plan_type"),
    "pmpm_by_plan_type_and_month": ("payer_plan", "SELECT plan_type, month_start, sum(total_paid) AS total_paid_amount, sum(member_months) AS member_months, sum(total_paid) / nullif(sum(member_months), 0) AS pmpm FROM payer_plan GROUP BY plan_type, month_start"),
    "member_months_by_payer": ("months", "SELECT payer_name, count(*) AS member_months FROM months GROUP BY payer_name"),
    "claims_volume_by_status": ("base", "SELECT claim_status, count(DISTINCT claim_id) AS claims_volume FROM base GROUP BY claim_status"),
    "denial_rate_by_payer": ("denials", "SELECT payer_name, sum(denied_claims) AS denied_claims, sum(total_claims) AS total_claims, sum(denied_claims) / nullif(sum(total_claims), 0) AS denial_rate FROM denials GROUP BY payer_name"),
    "denial_rate_by_payer_plan": ("denials", "SELECT payer_name, plan_type, sum(denied_claims) AS denied_claims, sum(total_claims) AS total_claims, sum(denied_claims) / nullif(sum(total_claims), 0) AS denial_rate FROM denials GROUP BY payer_name, plan_type"),
    "top_denial_reasons": ("denials", "SELECT denial_reason, sum(denied_claims) AS denied_claims, sum(denied_paid_impact) AS denied_paid_impact FROM denials WHERE denial_reason NOT IN ('Not Denied') GROUP BY denial_reason"),
    "provider_utilization_by_specialty": ("providers", "SELECT specialty, sum(claims) AS claims, sum(claim_lines) AS claim_lines, sum(total_paid) AS total_paid_amount, sum(distinct_members) AS member_touches, sum(total_paid) / nullif(sum(distinct_members), 0) AS paid_per_member FROM providers GROUP BY specialty"),
    "top_providers_by_paid": ("providers", "SELECT provider_npi, specialty, round(sum(total_paid), 2) AS total_paid_amount, sum(claims) AS claims FROM providers GROUP BY provider_npi, specialty ORDER BY round(sum(total_paid), 2) DESC NULLS LAST, provider_npi LIMIT 50"),
    "condition_cost_summary": ("conditions", "SELECT condition_group, sum(total_paid) AS total_paid_amount, sum(distinct_members_with_condition) AS distinct_members, sum(total_paid) / nullif(sum(distinct_members_with_condition), 0) AS paid_per_member FROM conditions GROUP BY condition_group"),
    "unique_members_with_condition": ("base", "SELECT condition_group, count(DISTINCT member_id) AS unique_members FROM base WHERE condition_group ILIKE 'w%' GROUP BY condition_group"),
    "late_arrival_impact": ("late", "SELECT period AS impacted_period, original_amount, late_amount, original_amount + late_amount AS restated_amount, late_rows FROM late"),
    "late_arrival_share_of_paid": ("late", "SELECT period AS impacted_period, late_amount, late_amount / nullif(original_amount + late_amount, 0) AS late_paid_share FROM late"),
    "adjustment_and_reversal_counts": ("base", "SELECT claim_month, count(DISTINCT CASE WHEN adjustment_flag THEN claim_id END) AS adjustment_count, count(DISTINCT CASE WHEN reversal_flag THEN claim_id END) AS reversal_count FROM base GROUP BY claim_month"),
    "line_header_reconciliation": ("base", "SELECT claim_id, count(*) AS line_count, sum(paid_amount) AS header_paid_amount, sum(allowed_amount) AS header_allowed_amount, sum(charge_amount) AS header_charge_amount FROM base GROUP BY claim_id"),
    "distinct_members_by_plan": ("base", "SELECT plan_type, count(DISTINCT member_id) AS distinct_members FROM base GROUP BY plan_type"),
    "paid_allowed_charge_by_payer": ("payer_plan", "SELECT payer_name, sum(total_paid) AS total_paid_amount, sum(total_allowed) AS total_allowed_amount, sum(total_charge) AS total_charge_amount FROM payer_plan GROUP BY payer_name"),
}
_CTES = {"base": f"WITH {_BASE}", "months": f"WITH {_ATTRS}", "payer_plan": f"WITH {_BASE}, {_PAYER_PLAN}", "denials": f"WITH {_BASE}, {_DENIALS}", "providers": f"WITH {_BASE}, {_PROVIDERS}", "conditions": f"WITH {_BASE}, {_CONDITIONS}", "late": f"WITH late AS ({reference.SQL['gld8_restatement']})"}


def read_mart(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A mart as the serving layer has it."""
    views = {"months": lambda s, f: mart(s, f, "member_months"), "payer_plan": gld3_payer_plan_summary, "denials": gld4_denial_summary, "providers": gld6_provider_month, "conditions": gld5_condition_cost, "late": reference.gld8_restatement}
    return mart(spark, sf, "base") if name == "base" else views[name](spark, sf)


def _doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema if f.dataType.typeName() == "decimal"})


def _verified(name: str) -> Callable[[SparkSession, str], DataFrame]:
    source, sql = VERIFIED[name]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _doubles(spark.sql(sql.replace(f"FROM {source}", "FROM {" + source + "}"), **{source: read_mart(spark, sf, source)}))

    run.__name__, run.__doc__ = f"sem5_{name}", f"Verified question: {name.replace('_', ' ')}."
    return run


for _name, (_source, _sql) in VERIFIED.items():
    _money = [c for c in ("total_paid_amount", "header_paid_amount", "header_allowed_amount", "header_charge_amount") if f" AS {c}" in _sql and _source == "base"]
    query(f"{_CTES[_source]}, q AS ({_sql}) SELECT * {'REPLACE (' + ', '.join(f'{c}::DOUBLE AS {c}' for c in _money) + ')' if _money else ''} FROM q")(_verified(_name))


# serving


def server(spark: SparkSession, sf: str) -> serving.Server:
    marts = {name: (lambda n: lambda: read_mart(spark, sf, n))(name) for name in ("base", "months", "payer_plan", "denials", "providers", "conditions", "late")}
    return serving.Server(spark, marts, model(spark, sf))


@query(f"WITH {_BASE}, {_PAYER_PLAN} SELECT payer_name, sum(total_paid) AS total_paid, sum(member_months)::BIGINT AS member_months FROM payer_plan WHERE plan_type = 'HDHP' GROUP BY 1 QUALIFY row_number() OVER (ORDER BY payer_name) <= 1000")
def sem8_payer_plan(spark, sf):
    """A serving call: payers' sums for one plan type."""
    return server(spark, sf).summary("payer_plan", ["payer_name"], {"total_paid": "sum(total_paid)", "member_months": "sum(member_months)"}, {"plan_type": "HDHP"}).rows


@query(f"WITH {_BASE} SELECT plan_type, count(DISTINCT claim_id) AS claims FROM base GROUP BY 1 ORDER BY plan_type LIMIT 3")
def sem8_safe_sql(spark, sf):
    """A serving call: a statement that asks for more rows than it may have."""
    return server(spark, sf).run_sql("SELECT plan_type, count(DISTINCT claim_id) AS claims FROM base GROUP BY plan_type ORDER BY plan_type LIMIT 5000", max_rows=3).rows


@query("SELECT * FROM (VALUES ('claims_volume', 'claims_volume', true), ('cost', 'total_paid_amount', true), ('paid per month', NULL, false), ('pmpm', 'pmpm', true)) t(asked, metric_name, is_known)")
def sem8_metric_lookup(spark, sf):
    """A serving call: metrics by name or synonym, with suggestions where there is none."""
    s = server(spark, sf)
    rows = [(n, d.get("metric_name"), "metric_name" in d) for n in ("pmpm", "cost", "claims_volume", "paid per month") for d in [s.metric(n)]]
    return spark.createDataFrame(rows, "asked string, metric_name string, is_known boolean")


def metric_documents(spark: SparkSession, sf: str) -> DataFrame:
    r = model(spark, sf).registry(spark).filter("is_certified")
    return r.select("metric_name", F.concat(F.lit("METRIC: "), "metric_name", F.lit(". Definition: "), "description", F.lit(". By: "), F.array_join("allowed_dimensions", ", ")).alias("doc_text"))


@query("SELECT 'pmpm' AS metric_name")
def sem11_metric_search(spark, sf):
    """The metric whose documentation fits a question best."""
    return search.search(metric_documents(spark, sf), "metric_name", "doc_text", "paid per member and month", 1).select("metric_name")


_PROVIDER_TEXT = "'NPI ' || provider_npi || ' | specialty: ' || specialty"


@query(f"WITH {_BASE}, p AS (SELECT provider_npi, min(specialty) AS specialty FROM base WHERE provider_npi IS NOT NULL GROUP BY 1) SELECT provider_npi, {_PROVIDER_TEXT} AS doc_text FROM p WHERE provider_npi = (SELECT min(provider_npi) FROM p)")
def sem11_provider_search(spark, sf):
    """The provider that is named by number, from a corpus of one document per provider."""
    p = mart(spark, sf, "base").filter("provider_npi is not null").groupBy("provider_npi").agg(F.min("specialty").alias("specialty"))
    docs = p.select("provider_npi", F.concat(F.lit("NPI "), "provider_npi", F.lit(" | specialty: "), "specialty").alias("doc_text"))
    least = docs.agg(F.min("provider_npi")).first()[0]
    return search.search(docs, "provider_npi", "doc_text", f"provider {least}", 1).join(docs, "provider_npi").select("provider_npi", "doc_text")
