"""Queries for each family of operators, over the whole tables, with the SQL that says the same.

Amounts are summed as decimals and shown as doubles, so that sums are exact in any order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import expr as E
from tidewright.operators import relational as R
from tidewright.plans.problems import _forms, table
from tidewright.quality import checks
from tidewright.semantic import guard, layer, search
from tidewright.session import lookup_side, scratch
from tidewright.sources import readers, tables, x12
from tidewright.streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
AS_OF = "2025-01-01"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def rate(c: str):
    return F.col(c).cast("decimal(6,2)")


_LINE_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
_LINES = """l AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1)"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem without repeated keys."""
    order = [F.col("l_shipdate").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in _LINE_TIES]]
    return R.latest_by(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)


def allowed():
    return money("l_extendedprice") * (1 - rate("l_discount"))


_ALLOWED = "(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(6,2)))"


def claims(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "fact_claim_line")


# sources


@query("SELECT event_id, user_id, event_type, value FROM events")
def src1_ndjson(spark, sf):
    """Events written as NDJSON and read by schema."""
    path = scratch(spark, "ndjson")
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").write.option("compression", "gzip").json(path)
    return readers.read_ndjson(spark, path, T.StructType.fromDDL("event_id long, user_id long, event_type string, value double"))


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation")
def src2_csv_seed(spark, sf):
    path = scratch(spark, "seed")
    table(spark, sf, "nation").write.option("header", True).csv(path)
    return readers.read_seed(spark, path, ["n_nationkey", "n_name", "n_regionkey"])


@query("SELECT record_id % 7 AS shard, count(*) AS n_rows, count(*) FILTER (WHERE raw_text LIKE '%,%') AS with_comma FROM raw_claim_record GROUP BY 1")
def src3_whole_files(spark, sf):
    """Records written one per line (line breaks inside made visible) in files by shard, and counted from whole-file reads."""
    path = scratch(spark, "text")
    rows = table(spark, sf, "raw_claim_record").select((F.col("record_id") % 7).alias("shard"), F.concat(F.lit(">"), F.regexp_replace(F.coalesce("raw_text", F.lit("")), "[\r\n]+", " ")).alias("value"))
    rows.write.partitionBy("shard").text(path)
    spread = spark.read.text(path, wholetext=True).select("shard", F.explode(F.split("value", "\n")).alias("line")).filter("line <> ''")
    return spread.groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("n_rows"), F.count_if(F.col("line").contains(",")).alias("with_comma"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS null_values FROM events GROUP BY 1")
def src5_landing(spark, sf):
    """Events as lines of a feed, landed: envelope typed, ids of file and row, a bad line rejected and not counted."""
    path = scratch(spark, "feed")
    line = F.to_json(F.struct(F.lit("S").alias("source_system"), F.col("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("business_event_ts"), F.struct("value").alias("payload")))
    table(spark, sf, "events").select(line.alias("value")).unionByName(spark.range(1).select(F.lit("{broken").alias("value"))).write.text(path)
    landed, _ = readers.land(readers.read_numbered(spark, path), {"now": "2025-01-01 00:00:00", "batch_id": "B", "load_id": "L", "run_id": "R"})
    value = E.json_get(F.col("payload"), "$.value", "double")
    return landed.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(value.isNull()).alias("null_values"))


@query("SELECT max(ingest_ts) AS newest, CASE WHEN max(ingest_ts) >= TIMESTAMP '2024-12-31' THEN 'PASS' WHEN max(ingest_ts) >= TIMESTAMP '2024-12-30' THEN 'WARN' ELSE 'ERROR' END AS status FROM br_raw_claim_event")
def src15_freshness(spark, sf):
    return readers.freshness(table(spark, sf, "br_raw_claim_event"), "ingest_ts", AS_OF).select("newest", "status")


# semi-structured values

_P = "CASE WHEN json_valid(payload) THEN payload::JSON END"


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k, coalesce(TRY_CAST(json_extract_string(props, '$.none') AS INT), -1) AS none FROM events")
def var1_json_path(spark, sf):
    return table(spark, sf, "events").select("event_id", E.json_get(F.col("props"), "$.k", "int").alias("k"), E.json_get(F.col("props"), "$.none", "int", -1).alias("none"))


@query(f"SELECT bronze_event_id, ({_P})->>'$.claim_id' AS claim_id, ({_P})->>'$.lines[0].procedure_code' AS first_procedure FROM br_raw_claim_event")
def var2_nested_path(spark, sf):
    v = table(spark, sf, "br_raw_claim_event").select("bronze_event_id", F.try_parse_json("payload").alias("v"))
    return v.select("bronze_event_id", E.variant_get(F.col("v"), "$.claim_id").alias("claim_id"), E.variant_get(F.col("v"), "$.lines[0].procedure_code").alias("first_procedure"))


@query("SELECT change_id, TRY_CAST(charge_amount AS DECIMAL(38,0))::DOUBLE AS whole_units FROM fact_claim_line")
def var3_number_cast(spark, sf):
    return claims(spark, sf).select("change_id", F.col("charge_amount").try_cast("decimal(38,0)").cast("double").alias("whole_units"))


@query(f"SELECT bronze_event_id, TRY_CAST(({_P})->>'$.received_date' AS DATE) AS received_date, coalesce(TRY_CAST(({_P})->>'$.void_indicator' AS BOOLEAN), lower(({_P})->>'$.void_indicator') IN ('y', 'yes', 'true', '1'), false) AS is_void FROM br_raw_claim_event")
def var4_dates_and_flags(spark, sf):
    v = table(spark, sf, "br_raw_claim_event").select("bronze_event_id", F.try_parse_json("payload").alias("v"))
    return v.select("bronze_event_id", F.try_to_date(E.variant_get(F.col("v"), "$.received_date"), "yyyy-MM-dd").alias("received_date"), E.loose_boolean(E.variant_get(F.col("v"), "$.void_indicator")).alias("is_void"))


@query("SELECT event_id, unnest(json_keys(props)) AS key, json_extract_string(props, '$.' || unnest(json_keys(props))) AS value FROM events")
def var9_object_unpivot(spark, sf):
    return spark.sql("SELECT e.event_id, o.key, CAST(o.value AS STRING) AS value FROM {e} e, LATERAL variant_explode(try_parse_json(e.props)) o", e=table(spark, sf, "events"))


@query("SELECT event_id, sha256(json(props)::VARCHAR) AS payload_hash FROM events")
def var10_payload_hash(spark, sf):
    return table(spark, sf, "events").select("event_id", E.payload_hash(F.parse_json("props")).alias("payload_hash"))


# ingestion


@query("SELECT eligibility_event_id, trim(member_id) || '|' || coalesce(coverage_start_date::VARCHAR, 'NA') || '|' || coalesce(trim(plan_id), 'NA') AS natural_key FROM eligibility_event")
def ing2_natural_key(spark, sf):
    return table(spark, sf, "eligibility_event").select("eligibility_event_id", E.natural_key(F.trim("member_id"), F.coalesce(F.col("coverage_start_date").cast("string"), F.lit("NA")), F.coalesce(F.trim("plan_id"), F.lit("NA"))).alias("natural_key"))


def _coverage_rules():
    return [
        ("MISSING_REQUIRED_KEY", E.norm_id("member_id").isNull() | E.norm_id("plan_id").isNull() | F.col("coverage_start_date").isNull()),
        ("IMPOSSIBLE_COVERAGE_SPAN", F.col("coverage_end_date") < F.col("coverage_start_date")),
        ("FUTURE_DATED_EVENT", F.col("coverage_start_date") > F.to_date(F.lit(AS_OF))),
    ]


_REASON = f"CASE WHEN coalesce(trim(member_id), '') = '' OR coalesce(trim(plan_id), '') = '' OR coverage_start_date IS NULL THEN 'MISSING_REQUIRED_KEY' WHEN coverage_end_date < coverage_start_date THEN 'IMPOSSIBLE_COVERAGE_SPAN' WHEN coverage_start_date > DATE '{AS_OF}' THEN 'FUTURE_DATED_EVENT' END"


@query(f"SELECT eligibility_event_id, {_REASON} AS reason FROM eligibility_event")
def ing3_rule_cascade(spark, sf):
    return table(spark, sf, "eligibility_event").select("eligibility_event_id", E.first_failing(_coverage_rules()).alias("reason"))


@query("SELECT CASE WHEN upper(record_status) IN ('QUARANTINE', 'QUARANTINED') OR payload IS NULL THEN 'QUARANTINE' ELSE 'VALID' END AS record_status, CASE WHEN payload IS NULL THEN 'NO_PAYLOAD' ELSE quarantine_reason END AS quarantine_reason, count(*) AS n FROM br_raw_claim_event GROUP BY 1, 2")
def ing4_status_resolution(spark, sf):
    df = table(spark, sf, "br_raw_claim_event")
    out = df.select(*[c.alias(k) for k, c in E.resolve_status(F.when(F.col("payload").isNull(), "NO_PAYLOAD"), F.col("record_status"), F.col("quarantine_reason")).items()])
    return out.groupBy("record_status", "quarantine_reason").agg(F.count("*").alias("n"))


@query(f"WITH {_LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM l")
def ing5_dedupe_latest(spark, sf):
    return lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'upserted' ELSE 'kept' END AS origin FROM orders")
def ing6_upsert_result(spark, sf):
    """Orders until 1998 as a table, then those from 1998 on upserted, some of which it had."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    t = tables.Table(spark, scratch(spark, "orders"))
    t.overwrite(orders.filter("o_orderdate < timestamp_ntz'1999-01-01'").select("o_orderkey", "o_orderstatus", F.lit("kept").alias("origin")))
    t.upsert(orders.filter("o_orderdate >= timestamp_ntz'1998-01-01'").select("o_orderkey", "o_orderstatus", F.lit("upserted").alias("origin")), ["o_orderkey"])
    return t.read()


@query(f"SELECT eligibility_event_id, {_REASON} AS quarantine_reason FROM eligibility_event WHERE {_REASON} IS NOT NULL")
def ing7_quarantine(spark, sf):
    df = table(spark, sf, "eligibility_event").withColumns({"record_status": F.lit("LANDED"), "quarantine_reason": F.lit(None).cast("string")})
    return R.route_quarantine(df, _coverage_rules(), "record_status", "quarantine_reason")[1].select("eligibility_event_id", "quarantine_reason")


@query("SELECT bronze_event_id, coalesce(payload_hash, sha256(payload)) AS payload_hash FROM br_raw_claim_event")
def ing9_hash_fallback(spark, sf):
    return table(spark, sf, "br_raw_claim_event").select("bronze_event_id", F.coalesce("payload_hash", F.sha2("payload", 256)).alias("payload_hash"))


# keys


@query(f"WITH {_LINES} SELECT md5(l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR || '|' || coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_')) AS sk FROM l")
def key1_surrogate(spark, sf):
    return lines(spark, sf).select(E.surrogate_key(F.col("l_orderkey"), F.col("l_linenumber"), F.nullif("l_returnflag", F.lit("N"))).alias("sk"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INT AS date_key FROM orders")
def key3_date_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", E.date_key(F.col("o_orderdate")).alias("date_key"))


@query("SELECT r_regionkey, TIMESTAMP '2025-01-01' AS created_at, 'LOAD1' AS load_id, true AS is_current, TIMESTAMP '2025-01-01' AS effective_from FROM region")
def key4_audit_columns(spark, sf):
    run = {"now": "2025-01-01 00:00:00", "run_id": "RUN1", "load_id": "LOAD1"}
    return table(spark, sf, "region").withColumns(E.audit_columns(run)).select("r_regionkey", "created_at", "load_id", "is_current", "effective_from")


# projections and filters


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 9 END AS rank, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'much' END AS band, c_mktsegment = 'BUILDING' AS is_building FROM customer")
def prj4_case_mapping(spark, sf):
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    return table(spark, sf, "customer").drop("c_name").select("c_custkey", F.when(seg == "BUILDING", 1).when(seg == "MACHINERY", 2).otherwise(9).alias("rank"), F.when(bal < 0, "debt").when(bal < 5000, "some").otherwise("much").alias("band"), (seg == "BUILDING").alias("is_building"))


@query("SELECT p_partkey, p_type FROM part WHERE upper(p_type) LIKE '%A%' AND p_type ILIKE '%e%' AND regexp_matches(p_brand, '^Brand#[1-4]') AND p_size NOT IN (1, 2, 3)")
def flt_patterns(spark, sf):
    return table(spark, sf, "part").filter(F.upper("p_type").contains("A") & F.col("p_type").ilike("%e%") & F.col("p_brand").rlike("^Brand#[1-4]") & ~F.col("p_size").isin(1, 2, 3)).select("p_partkey", "p_type")


@query("SELECT c_custkey FROM customer WHERE upper(c_mktsegment) = 'BUILDING'")
def flt6_named_parameters(spark, sf):
    return spark.sql("SELECT c_custkey FROM {c} WHERE upper(c_mktsegment) = upper(:segment)", args={"segment": "building"}, c=table(spark, sf, "customer"))


# joins


@query(f"WITH {_LINES} SELECT o_orderstatus, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity FROM l JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def jn1_equi_inner(spark, sf):
    both = lines(spark, sf).join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(money("l_quantity")).cast("double").alias("quantity"))


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def jn2_semi(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey").join(returned, "o_orderkey", "left_semi")


@query("SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def jn3_dimension_lookup(spark, sf):
    places = table(spark, sf, "nation").join(lookup_side(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return table(spark, sf, "supplier").join(lookup_side(places), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name", "r_name")


@query(f"""SELECT r_name, c_mktsegment, substr(p_type, 1, 5) AS kind, count(*) AS n, sum({_ALLOWED})::DOUBLE AS allowed FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""")
def jn4_star(spark, sf):
    t = lambda n: table(spark, sf, n)
    out = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", allowed().alias("a")).join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    out = out.join(t("customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    out = out.join(t("part").select("p_partkey", F.substring("p_type", 1, 5).alias("kind")), F.col("l_partkey") == F.col("p_partkey"), "left")
    out = out.join(jn3_dimension_lookup(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return out.groupBy("r_name", "c_mktsegment", "kind").agg(F.count("*").alias("n"), F.sum("a").cast("double").alias("allowed"))


@query("WITH a AS (SELECT o_custkey AS k, count(*) AS orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1), b AS (SELECT c_nationkey, c_custkey FROM customer) SELECT c_custkey, coalesce(orders, 0) AS orders, total FROM b LEFT JOIN a ON k = c_custkey")
def jn6_aggregate_join(spark, sf):
    a = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.sum(money("o_totalprice")).cast("double").alias("total"))
    return table(spark, sf, "customer").select("c_custkey").join(a, "c_custkey", "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), "total")


_SPANS = "s AS (SELECT eligibility_event_id AS id, upper(trim(member_id)) AS m, upper(trim(plan_id)) AS p, coverage_start_date AS s, coverage_end_date AS e FROM eligibility_event WHERE trim(member_id) <> '' AND trim(plan_id) <> '' AND coverage_start_date IS NOT NULL)"


def coverages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "eligibility_event").select(F.col("eligibility_event_id").alias("id"), E.norm_id("member_id").alias("member_id"), E.norm_id("plan_id").alias("plan_id"), F.col("coverage_start_date").alias("s"), F.col("coverage_end_date").alias("e")).filter("member_id is not null and plan_id is not null and s is not null")


@query(f"WITH {_SPANS}, d AS (SELECT DISTINCT m, p, s, least(e, DATE '{AS_OF}') AS e FROM (SELECT m, p, s, coalesce(e, DATE '{AS_OF}') AS e FROM s) WHERE s < least(e, DATE '{AS_OF}')) SELECT change_id, d.p AS plan_id, d.s AS start_date FROM fact_claim_line f JOIN d ON upper(trim(f.member_id)) = d.m AND f.service_from_date >= d.s AND f.service_from_date < d.e")
def jn7_range_join(spark, sf):
    """Claim lines with the coverages that hold their service date; spans are cut into months, so that the join has an equal key."""
    end = F.least(F.coalesce("e", F.to_date(F.lit(AS_OF))), F.to_date(F.lit(AS_OF)))
    spans = coverages(spark, sf).select("member_id", "plan_id", "s", end.alias("e")).distinct().filter("s < e")
    points = claims(spark, sf).select("change_id", E.norm_id("member_id").alias("member_id"), F.col("service_from_date").alias("at")).filter("at is not null")
    return R.range_join(points, spans, ["member_id"], "at", "s", "e").select("change_id", "plan_id", F.col("s").alias("start_date"))


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS view_before,
first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS purchase_after FROM events""")
def jn8_asof_neighbors(spark, sf):
    df = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    kind = lambda k: F.when(F.col("event_type") == k, F.col("event_id"))
    return R.neighbors(df, ["user_id"], "at", {"view_before": kind("view")}, {"purchase_after": kind("purchase")}, F.to_date("ts")).select("event_id", "view_before", "purchase_after")


@query("""WITH c AS (SELECT user_id, ts, event_id AS view_id FROM events WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
SELECT e.event_id, c.view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN c ON e.user_id = c.user_id AND e.ts >= c.ts""")
def jn8_asof_join(spark, sf):
    df = table(spark, sf, "events")
    views = df.filter("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("event_id").alias("view_id"))
    return R.asof_join(df.filter("event_type = 'purchase'").select("user_id", "ts", "event_id"), views, ["user_id"], "ts", ["view_id"], F.to_date).select("event_id", "view_id")


@query(f"""WITH {_SPANS}, o AS (SELECT m, p, id, s, coalesce(e, DATE '9999-12-31') AS e FROM s)
SELECT a.m AS member_id, a.p AS plan_id, a.id AS span_id_a, a.s AS start_date_a, a.e AS end_date_a, b.id AS span_id_b, b.s AS start_date_b, b.e AS end_date_b FROM o a JOIN o b ON a.m = b.m AND a.p = b.p AND a.id < b.id AND a.s < b.e AND a.e > b.s""")
def jn9_overlap_pairs(spark, sf):
    """The pairs of coverages that overlap, open ends included."""
    spans = coverages(spark, sf).select("member_id", "plan_id", F.col("id").alias("span_id"), F.col("s").alias("start_date"), F.col("e").alias("end_date"))
    return R.overlap_pairs(spans, ["member_id", "plan_id"], "span_id", "start_date", "end_date")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def jn10_anti_missing(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey").join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def jn11_not_in(spark, sf):
    return spark.sql("SELECT c_custkey FROM {c} WHERE c_custkey NOT IN (SELECT o_custkey FROM {o} WHERE o_custkey IS NOT NULL)", c=table(spark, sf, "customer"), o=table(spark, sf, "orders"))


@query("SELECT (SELECT count(*) FROM orders) AS expected, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS actual")
def jn12_two_scalars(spark, sf):
    return table(spark, sf, "orders").agg(F.count("*").alias("expected")).crossJoin(table(spark, sf, "lineitem").agg(F.count_distinct("l_orderkey").alias("actual")))


@query("SELECT n_name, count(*)::DOUBLE / (SELECT count(*) FROM customer) AS share FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def jn14_scalar_share(spark, sf):
    return spark.sql("SELECT n_name, count(*) / CAST((SELECT count(*) FROM {c}) AS DOUBLE) AS share FROM {c} JOIN {n} ON c_nationkey = n_nationkey GROUP BY n_name", c=table(spark, sf, "customer"), n=table(spark, sf, "nation"))


# aggregates


@query(f"SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity, sum({_ALLOWED})::DOUBLE AS allowed, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2")
def agg1_sums(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(money("l_quantity")).cast("double").alias("quantity"), F.sum(allowed()).cast("double").alias("allowed"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query("SELECT claim_type, count(DISTINCT claim_id) AS claims, count(DISTINCT member_id) AS members, count(DISTINCT CASE WHEN claim_status = 'DENIED' THEN claim_id END) AS denied FROM fact_claim_line GROUP BY 1")
def agg2_several_distinct(spark, sf):
    return claims(spark, sf).groupBy("claim_type").agg(F.count_distinct("claim_id").alias("claims"), F.count_distinct("member_id").alias("members"), F.count_distinct(F.when(F.col("claim_status") == "DENIED", F.col("claim_id"))).alias("denied"))


@query("SELECT event_type, sum(CASE WHEN value > 50 THEN 1 ELSE 0 END)::BIGINT AS high, count(*) FILTER (WHERE value <= 50) AS low, max(CASE WHEN value > 99 THEN 1 ELSE 0 END) AS any_top, bool_or(value > 99) AS flag FROM events GROUP BY 1 HAVING count(*) > 1")
def agg4_conditional(spark, sf):
    v = F.col("value")
    out = table(spark, sf, "events").groupBy("event_type").agg(F.sum(F.when(v > 50, 1).otherwise(0)).alias("high"), F.count_if(v <= 50).alias("low"), F.max(F.when(v > 99, 1).otherwise(0)).alias("any_top"), F.bool_or(v > 99).alias("flag"), F.count("*").alias("_n"))
    return out.filter("_n > 1").drop("_n")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest_order FROM orders GROUP BY 1")
def agg6_max_by(spark, sf):
    return R.latest_values(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey"]).withColumnRenamed("o_orderkey", "latest_order")


@query("SELECT o_custkey, list(o_orderkey ORDER BY o_orderdate, o_orderkey) AS orders FROM orders GROUP BY 1")
def agg9_ordered_array(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))), lambda x: x.o_orderkey).alias("orders"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def agg10_distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("WITH c AS (SELECT payer_id, plan_id, count(*) AS n FROM fact_claim_line WHERE plan_id IS NOT NULL GROUP BY 1, 2) SELECT payer_id, plan_id FROM c QUALIFY row_number() OVER (PARTITION BY payer_id ORDER BY n DESC, plan_id) = 1")
def agg14_mode(spark, sf):
    return R.mode_by(claims(spark, sf), ["payer_id"], "plan_id")


# windows


@query("""WITH f AS (SELECT change_id, upper(trim(claim_id)) AS c, claim_version AS v, claim_status FROM fact_claim_line WHERE trim(claim_id) <> '')
SELECT change_id, row_number() OVER w AS chain_seq, lag(v) OVER w AS prior_version, max(v) OVER (PARTITION BY c) AS latest_version FROM f WINDOW w AS (PARTITION BY c ORDER BY v NULLS FIRST, change_id)""")
def win3_chain(spark, sf):
    df = claims(spark, sf).withColumn("c", E.norm_id("claim_id")).filter("c is not null")
    return R.version_chain(df, "c", "claim_version", [F.col("change_id")], {}).select("change_id", "chain_seq", "prior_version", "latest_version")


@query("""SELECT event_id, max(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before, sum(value::DECIMAL(18,2)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS running, sum(value::DECIMAL(18,2)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::DOUBLE AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win7_running(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before, to = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf, "events").select("event_id", F.max("value").over(before).alias("max_before"), F.sum(money("value")).over(to).cast("double").alias("running"), F.sum(money("value")).over(before).cast("double").alias("before"))


@query("WITH a AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) SELECT p_brand, p_type, n, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rank FROM a")
def win11_rank_of_aggregate(spark, sf):
    a = table(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return a.withColumn("rank", F.row_number().over(Window.partitionBy("p_brand").orderBy(F.col("n").desc(), "p_type")))


@query("WITH a AS (SELECT o_orderpriority, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1) SELECT o_orderpriority, total, total / (SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE FROM orders) AS share FROM a")
def win12_share_of_total(spark, sf):
    a = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.sum(money("o_totalprice")).alias("_t"))
    all_ = F.sum("_t").over(Window.partitionBy(F.lit(1)))
    return a.select("o_orderpriority", F.col("_t").cast("double").alias("total"), (F.col("_t").cast("double") / all_.cast("double")).alias("share"))


# sorting and sets


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50")
def srt2_top_n(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(50)


@query("SELECT 'customer' AS kind, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_nationkey FROM supplier")
def set1_union_all(spark, sf):
    a = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"))
    return a.unionByName(table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation")))


@query("SELECT upper(trim(member_id)) AS member_id FROM fact_claim_line WHERE trim(member_id) <> '' UNION SELECT upper(trim(member_id)) FROM eligibility_event WHERE trim(member_id) <> ''")
def set2_union_distinct(spark, sf):
    ids = lambda n: table(spark, sf, n).select(E.norm_id("member_id").alias("member_id")).filter("member_id is not null")
    return ids("fact_claim_line").unionByName(ids("eligibility_event")).distinct()


# scalar functions


@query("SELECT c_custkey, nullif(trim(c_name), '') AS name, lpad(left(c_custkey::VARCHAR, 10), 10, '0') AS padded, split_part(c_name, '#', 2) AS tail, md5(c_name) AS digest FROM customer")
def fn_strings(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.nullif(F.trim("c_name"), F.lit("")).alias("name"), F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("padded"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("tail"), F.md5("c_name").alias("digest"))


@query("""SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month, datediff('day', o_orderdate::DATE, DATE '2000-01-01')::INT AS days, datediff('hour', o_orderdate, TIMESTAMP '2000-01-01 00:30:00')::DOUBLE AS hours,
(o_orderdate::DATE + 30)::DATE AS due, quarter(o_orderdate)::INT AS quarter, isodow(o_orderdate)::INT AS weekday, left(monthname(o_orderdate), 3) AS month_name FROM orders""")
def fn_dates(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", F.trunc(d, "month").alias("month"), E.day_diff(d, F.lit("2000-01-01").cast("timestamp_ntz")).alias("days"), E.hour_diff(d, F.lit("2000-01-01 00:30:00").cast("timestamp_ntz")).alias("hours"), F.date_add(F.to_date(d), 30).alias("due"), F.quarter(d).alias("quarter"), (F.weekday(d) + 1).alias("weekday"), F.monthname(d).alias("month_name"))


@query("SELECT change_id, CASE WHEN units = 0 THEN 0.0 ELSE paid_amount::DOUBLE / units END AS per_unit, abs(paid_amount)::DOUBLE AS absolute, greatest(charge_amount, allowed_amount)::DOUBLE AS larger, least(charge_amount, allowed_amount)::DOUBLE AS smaller FROM fact_claim_line")
def fn_math(spark, sf):
    return claims(spark, sf).select("change_id", E.div0(F.col("paid_amount").cast("double"), F.col("units")).alias("per_unit"), F.abs("paid_amount").cast("double").alias("absolute"), F.greatest("charge_amount", "allowed_amount").cast("double").alias("larger"), F.least("charge_amount", "allowed_amount").cast("double").alias("smaller"))


# canonical entities


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats of a line as versions of it, in order of shipment."""
    w = Window.partitionBy("chain").orderBy(*[F.col(c).asc_nulls_first() for c in ("l_shipdate", *_LINE_TIES)])
    return table(spark, sf, "lineitem").withColumn("chain", F.concat_ws("-", "l_orderkey", "l_linenumber")).withColumn("version", F.row_number().over(w))


_VERSIONS = "v AS (SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS chain, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate NULLS FIRST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS version, l_returnflag AS f, l_partkey FROM lineitem)"


@query(f"WITH {_VERSIONS} SELECT chain, version, CASE WHEN f = 'R' THEN 'REVERSAL' WHEN f = 'A' THEN 'ADJUSTMENT' ELSE 'ORIGINAL' END AS chain_class, lag(version) OVER (PARTITION BY chain ORDER BY version) AS prior_version, version = max(version) OVER (PARTITION BY chain) AS is_latest FROM v")
def can2_adjustment_chain(spark, sf):
    return R.version_chain(versions(spark, sf), "chain", "version", [], {"REVERSAL": F.col("l_returnflag") == "R", "ADJUSTMENT": F.col("l_returnflag") == "A"}).select("chain", "version", "chain_class", "prior_version", "is_latest")


@query(f"WITH {_VERSIONS} SELECT chain, version FROM v WHERE f <> 'R' QUALIFY row_number() OVER (PARTITION BY chain ORDER BY version DESC) = 1")
def can3_current_version(spark, sf):
    return R.resolve_current(versions(spark, sf), "chain", "version", [], F.col("l_returnflag") == "R").select("chain", "version")


@query("SELECT change_id, datediff('day', service_to_date, created_at::DATE)::INT AS lag_days, coalesce(datediff('day', service_to_date, created_at::DATE) > 7 AND date_trunc('month', service_to_date) < date_trunc('month', created_at), false) AS is_late FROM fact_claim_line")
def can4_late_flag(spark, sf):
    return claims(spark, sf).withColumns(R.late_flags(F.col("service_to_date"), F.to_date("created_at"), 7)).select("change_id", "lag_days", "is_late")


@query(f"""WITH {_SPANS}, f AS (SELECT m, p, s, coalesce(e, DATE '9999-12-31') AS e, id FROM s WHERE coalesce(e, DATE '9999-12-31') >= s), b AS (SELECT *, max(e) OVER (PARTITION BY m, p ORDER BY s RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS before FROM f),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY m, p ORDER BY s RANGE UNBOUNDED PRECEDING) AS k FROM b)
SELECT m AS member_id, p AS plan_id, min(s) AS span_start, nullif(max(e), DATE '9999-12-31') AS span_end, count(*) AS n, max(id) AS latest_id FROM i GROUP BY m, p, k""")
def can9_span_merge(spark, sf):
    return R.merge_spans(coverages(spark, sf), ["member_id", "plan_id"], "s", "e", {"latest_id": F.max("id")})


@query("""WITH e AS (SELECT upper(trim(member_id)) AS m, plan_id FROM eligibility_event WHERE trim(member_id) <> '' QUALIFY row_number() OVER (PARTITION BY upper(trim(member_id)) ORDER BY created_at DESC NULLS LAST, eligibility_event_id DESC) = 1), a AS (SELECT upper(trim(member_id)) AS m FROM fact_claim_line WHERE trim(member_id) <> '' UNION SELECT m FROM e)
SELECT a.m AS member_id, e.plan_id, e.m IS NOT NULL AS has_coverage FROM a LEFT JOIN e ON a.m = e.m""")
def can10_party_master(spark, sf):
    elig = table(spark, sf, "eligibility_event").withColumn("member_id", E.norm_id("member_id")).filter("member_id is not null")
    newest = R.latest_values(elig, ["member_id"], ["created_at", "eligibility_event_id"], ["plan_id"]).withColumn("_has", F.lit(True))
    return set2_union_distinct(spark, sf).join(newest, "member_id", "left").select("member_id", "plan_id", F.coalesce("_has", F.lit(False)).alias("has_coverage"))


# X12

CLAIMS_A_FILE = 64


def x12_claims(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").filter("o_custkey is not null")
    li = lines(spark, sf).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.concat(F.lit("P"), F.col("l_partkey")).alias("procedure_code"), money("l_extendedprice").alias("charge"), F.col("l_quantity").cast("int").alias("units"), F.to_date("l_shipdate").alias("service_date")))).alias("lines"))
    w = Window.partitionBy("batch").orderBy("o_orderkey")
    return (
        o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("batch", F.floor(F.col("o_orderkey") / CLAIMS_A_FILE)).withColumn("claim_seq", F.row_number().over(w))
        .select("batch", "claim_seq", F.concat(F.lit("C"), F.col("o_orderkey")).alias("claim_id"), F.concat(F.lit("M"), F.col("o_custkey")).alias("member_id"), F.lit("PAYER1").alias("payer_id"), F.lit("9000000001").alias("npi"), money("o_totalprice").alias("charge"), F.col("o_orderstatus").alias("diagnosis_code"), "lines")
    )


def x12_segments(spark: SparkSession, sf: str) -> DataFrame:
    return x12.parse_interchange(x12.write_interchange(x12_claims(spark, sf)).withColumn("file_name", F.col("batch").cast("string")))


@query(f"WITH {_LINES} SELECT 'C' || o_orderkey::VARCHAR AS claim_id, 'M' || o_custkey::VARCHAR AS member_id, any_value(o_totalprice::DECIMAL(18,2))::DOUBLE AS charge_amount, min(l_shipdate::DATE) AS service_date FROM orders JOIN l ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey")
def x12_6_claim_headers(spark, sf):
    """Orders written as X12 interchanges, parsed again, and assembled into claim headers."""
    return x12.claim_headers(x12_segments(spark, sf)).select("claim_id", "member_id", F.col("charge_amount").cast("double").alias("charge_amount"), "service_date")


@query(f"WITH {_LINES} SELECT 'P' || l_partkey::VARCHAR AS procedure_code, l_extendedprice::DECIMAL(18,2)::DOUBLE AS charge_amount, l_shipdate::DATE AS service_date, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber))::INT AS line_number FROM orders JOIN l ON l_orderkey = o_orderkey")
def x12_7_claim_lines(spark, sf):
    return x12.claim_lines(x12_segments(spark, sf)).select("procedure_code", F.col("charge_amount").cast("double").alias("charge_amount"), "service_date", "line_number")


@query(f"WITH {_LINES} SELECT o_orderstatus AS diagnosis_code, true AS is_principal, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM l WHERE l_orderkey = o_orderkey) GROUP BY 1")
def x12_8_claim_diagnoses(spark, sf):
    return x12.claim_diagnoses(x12_segments(spark, sf)).groupBy("diagnosis_code", "is_principal").agg(F.count("*").alias("n"))


@query(f"WITH {_LINES}, b AS (SELECT DISTINCT o_orderkey // {CLAIMS_A_FILE} AS b FROM orders JOIN l ON l_orderkey = o_orderkey WHERE o_custkey IS NOT NULL) SELECT sha256('f' || b::VARCHAR) AS bronze_event_id, lpad(b::VARCHAR, 9, '0') AS natural_key, 'PROCESSED' AS record_status, NULL AS quarantine_reason FROM b UNION ALL SELECT sha256('broken'), NULL, 'QUARANTINE', 'no interchange header (ISA) with a control number' UNION ALL SELECT sha256('empty'), NULL, 'QUARANTINE', 'no interchange header (ISA) with a control number' UNION ALL SELECT sha256('other'), '7', 'QUARANTINE', 'transaction type is not 837: 835'")
def x12_4_status(spark, sf):
    """Files landed, converted and given their status; three of them are none that can be converted."""
    files = x12.write_interchange(x12_claims(spark, sf)).select(F.concat(F.lit("f"), F.col("batch")).alias("file_name"), "text")
    bad = spark.createDataFrame([("broken", "ST*837*1~CLM*C1*5~"), ("empty", ""), ("other", "ISA*" + "*".join(["00"] * 12) + "*7~ST*835*1~IEA*1*7~")], files.schema)
    raw = x12.load_raw(files.unionByName(bad))
    return raw.select("bronze_event_id", "natural_key").join(x12.convert(raw).drop("document"), "bronze_event_id")


def x12_documents(spark: SparkSession, sf: str) -> DataFrame:
    return x12.document_segments(table(spark, sf, "br_raw_x12_claim_json"), "bronze_event_id", "payload")


def _element(k: str) -> str:
    """SQL: element k of a segment e as text, a composite's parts joined by <."""
    parts = " || '<' || ".join(f"coalesce(e->'$.{k}'->>'$.0{i}', '')" for i in (1, 2, 3))
    return f"nullif(CASE json_type(e->'$.{k}') WHEN 'OBJECT' THEN rtrim({parts}, '<') ELSE e->>'$.{k}' END, '')"


_DATE = f"CASE WHEN regexp_full_match({_element('03')}, '[0-9]{{8}}') THEN TRY_CAST(try_strptime({_element('03')}, '%Y%m%d') AS DATE) END"
_DOCUMENTS = f"""
d AS (SELECT bronze_event_id AS k, unnest({{roots}}) AS r FROM (SELECT bronze_event_id, CASE WHEN json_valid(payload) THEN payload::JSON END AS v FROM br_raw_x12_claim_json)),
u AS (SELECT k, unnest({{items}}) AS e, generate_subscripts({{items}}, 1) - 1 AS i FROM (SELECT k, r->'$.segments' AS c FROM d)),
g AS (SELECT k, i, e, e->>'$._segment' AS s, coalesce(TRY_CAST(e->>'$.claim_seq' AS INT), 0) AS q FROM u WHERE json_type(e) = 'OBJECT')
""".format(roots=_forms("v"), items=_forms("c"))


@query(f"""WITH {_DOCUMENTS}, p AS (SELECT k, i, q, s, {_element('01')} AS e1, {_element('02')} AS e2, {_element('05')} AS e5, {_element('09')} AS e9, trim({_element('13')}) AS e13, {_DATE} AS d FROM g),
a AS (SELECT k, q, arg_min(e1, i) FILTER (s = 'CLM') AS claim_id, TRY_CAST(arg_min(e2, i) FILTER (s = 'CLM') AS DECIMAL(18,2)) AS charge, split_part(arg_min(e5, i) FILTER (s = 'CLM'), '<', 1) AS place, arg_min(e9, i) FILTER (s = 'NM1' AND e1 = 'IL') AS member_id, arg_min(e9, i) FILTER (s = 'NM1' AND e1 = 'PR') AS payer_id,
  arg_min(e9, i) FILTER (s = 'NM1' AND e1 = '82') AS rendering_npi, arg_min(e9, i) FILTER (s = 'NM1' AND e1 = '85') AS billing, min(d) FILTER (s = 'DTP' AND e1 = '472') AS service_date, max(e13) FILTER (s = 'ISA') AS control FROM p GROUP BY 1, 2),
w AS (SELECT *, max(billing) FILTER (q = 0) OVER (PARTITION BY k) AS b0, max(control) OVER (PARTITION BY k) AS c0 FROM a)
SELECT k AS record_key, q AS claim_seq, c0 AS control_number, claim_id, charge::DOUBLE AS charge_amount, nullif(place, '') AS place_of_service, member_id, payer_id, rendering_npi, coalesce(billing, b0) AS billing_npi, service_date FROM w WHERE claim_id IS NOT NULL""")
def x12_6_documents(spark, sf):
    """Claim headers of the parsed documents as they came."""
    out = x12.claim_headers(x12_documents(spark, sf))
    return out.select("record_key", "claim_seq", "control_number", "claim_id", F.col("charge_amount").cast("double").alias("charge_amount"), "place_of_service", "member_id", "payer_id", "rendering_npi", "billing_npi", "service_date")


@query(f"""WITH {_DOCUMENTS}, p AS (SELECT k, i, q, s, {_element('01')} AS e1, {_element('02')} AS e2, {_element('04')} AS e4, {_DATE} AS d FROM g),
w AS (SELECT *, last_value(CASE WHEN s = 'LX' THEN e1 END IGNORE NULLS) OVER (PARTITION BY k, q ORDER BY i ROWS UNBOUNDED PRECEDING) AS lx, first_value(CASE WHEN s = 'DTP' AND e1 = '472' THEN d END IGNORE NULLS) OVER (PARTITION BY k, q ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sd FROM p)
SELECT k AS record_key, q AS claim_seq, i::INT AS segment_index, TRY_CAST(lx AS INT) AS line_number, nullif(split_part(e1, '<', 2), '') AS procedure_code, TRY_CAST(e2 AS DECIMAL(18,4))::DOUBLE AS charge_amount, TRY_CAST(e4 AS DECIMAL(18,4))::DOUBLE AS units, sd AS service_date FROM w WHERE s = 'SV1'""")
def x12_7_documents(spark, sf):
    """Claim lines of the parsed documents, with the number before and the date after them."""
    out = x12.claim_lines(x12_documents(spark, sf))
    return out.withColumns({c: F.col(c).cast("double") for c in ("charge_amount", "units")})


@query(f"""WITH {_DOCUMENTS}, h AS (SELECT k, q, i, e, unnest(list_filter(json_keys(e), lambda x: regexp_full_match(x, '[0-9]+'))) AS n FROM g WHERE s = 'HI'),
c AS (SELECT k, q, i, n, CASE json_type(json_extract(e, '$.' || n)) WHEN 'OBJECT' THEN json_extract_string(e, '$.' || n || '.01') || '<' || coalesce(json_extract_string(e, '$.' || n || '.02'), '') ELSE json_extract_string(e, '$.' || n) END AS x FROM h)
SELECT k AS record_key, q AS claim_seq, row_number() OVER (PARTITION BY k, q ORDER BY i, n::INT)::INT AS position, nullif(split_part(x, '<', 1), '') AS qualifier, nullif(split_part(x, '<', 2), '') AS diagnosis_code, coalesce(split_part(x, '<', 1) = 'BK', false) AS is_principal FROM c WHERE x <> ''""")
def x12_8_documents(spark, sf):
    """Diagnoses of the parsed documents, with their place in the claim."""
    return x12.claim_diagnoses(x12_documents(spark, sf))


# dimensions, facts and marts


@query("SELECT d::DATE AS day, strftime(d, '%Y%m%d')::INT AS date_key, year(d)::INT AS year, isodow(d)::INT AS weekday, isodow(d) > 5 AS is_weekend FROM range(DATE '2018-01-01', DATE '2031-01-01', INTERVAL 1 DAY) t(d)")
def dim1_date_spine(spark, sf):
    d = F.col("day")
    return R.date_spine(spark, "2018-01-01", "2031-01-01").select("day", E.date_key(d).alias("date_key"), F.year(d).alias("year"), (F.weekday(d) + 1).alias("weekday"), (F.weekday(d) >= 5).alias("is_weekend"))


@query("""WITH o AS (SELECT DISTINCT upper(trim(payer_id)) AS payer_id FROM fact_claim_line WHERE trim(payer_id) <> ''), s AS (SELECT payer_id, any_value(payer_name) AS payer_name FROM dim_payer GROUP BY 1), k AS (SELECT payer_id FROM o UNION SELECT payer_id FROM s)
SELECT k.payer_id, coalesce(s.payer_name, 'UNKNOWN') AS payer_name, o.payer_id IS NOT NULL AS is_observed, s.payer_id IS NOT NULL AS is_seeded FROM k LEFT JOIN o USING (payer_id) LEFT JOIN s USING (payer_id)""")
def dim6_conformed_dim(spark, sf):
    observed = claims(spark, sf).select(E.norm_id("payer_id").alias("payer_id")).filter("payer_id is not null")
    return R.conform_dim(observed, table(spark, sf, "dim_payer").select("payer_id", "payer_name"), "payer_id", {"payer_name": "UNKNOWN"})


@query(f"""WITH {_LINES}, a AS (SELECT l_orderkey, l_linenumber, o_totalprice::DECIMAL(18,2)::DOUBLE AS amount, {_ALLOWED} AS w FROM l JOIN orders ON l_orderkey = o_orderkey), t AS (SELECT *, sum(w) OVER (PARTITION BY l_orderkey)::DOUBLE AS total, count(*) OVER (PARTITION BY l_orderkey) AS n FROM a)
SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN total <> 0 THEN amount * w::DOUBLE / total ELSE amount / n END, 0) AS share FROM t""")
def fct1_allocation(spark, sf):
    """An order's price over its lines, in proportion to what is allowed for them."""
    both = lines(spark, sf).join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("w", allowed())
    w = Window.partitionBy("l_orderkey")
    total, amount = F.sum("w").over(w).cast("double"), money("o_totalprice").cast("double")
    share = F.coalesce(F.when(total != 0, amount * F.col("w").cast("double") / F.nullif(total, F.lit(0.0))).otherwise(amount / F.count(F.lit(1)).over(w)), F.lit(0.0))
    return both.select("l_orderkey", "l_linenumber", share.alias("share"))


_MONTHS = f"{_SPANS}, x AS (SELECT m, p, s, least(coalesce(e, DATE '{AS_OF}'), DATE '{AS_OF}') AS e FROM s), mm AS (SELECT DISTINCT m, p, unnest(generate_series(date_trunc('month', s)::TIMESTAMP, date_trunc('month', e - 1)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM x WHERE s < e)"


def member_months(spark: SparkSession, sf: str) -> DataFrame:
    capped = coverages(spark, sf).withColumn("e", F.least(F.coalesce("e", F.to_date(F.lit(AS_OF))), F.to_date(F.lit(AS_OF))))
    return R.expand_months(capped, "s", "e", AS_OF).select("member_id", "plan_id", "month").distinct()


@query(f"WITH {_MONTHS} SELECT m AS member_id, p AS plan_id, month FROM mm")
def fct2_member_months(spark, sf):
    return member_months(spark, sf)


@query("SELECT rendering_provider_npi, date_trunc('month', service_from_date)::DATE AS month, count(DISTINCT claim_id) AS claims, count(DISTINCT member_id) AS members, sum(units)::BIGINT AS units, sum(paid_amount)::DOUBLE AS paid FROM fact_claim_line GROUP BY 1, 2")
def fct5_monthly_utilization(spark, sf):
    return claims(spark, sf).groupBy("rendering_provider_npi", F.trunc("service_from_date", "month").alias("month")).agg(F.count_distinct("claim_id").alias("claims"), F.count_distinct("member_id").alias("members"), F.sum("units").alias("units"), F.sum("paid_amount").cast("double").alias("paid"))


@query(f"WITH {_MONTHS}, n AS (SELECT p, month, count(*) AS member_months FROM mm GROUP BY 1, 2), c AS (SELECT upper(trim(plan_id)) AS p, date_trunc('month', service_from_date)::DATE AS month, sum(paid_amount)::DOUBLE AS paid FROM fact_claim_line GROUP BY 1, 2) SELECT n.p AS plan_id, n.month, member_months, coalesce(paid, 0) AS paid, coalesce(paid, 0) / member_months AS pmpm FROM n LEFT JOIN c ON n.p = c.p AND n.month = c.month")
def gld3_pmpm(spark, sf):
    """Paid per member and month: two aggregates to one grain, then a join and a guarded ratio."""
    n = member_months(spark, sf).groupBy("plan_id", "month").agg(F.count("*").alias("member_months"))
    paid = claims(spark, sf).groupBy(E.norm_id("plan_id").alias("plan_id"), F.trunc("service_from_date", "month").alias("month")).agg(F.sum("paid_amount").cast("double").alias("paid"))
    return n.join(paid, ["plan_id", "month"], "left").select("plan_id", "month", "member_months", F.coalesce("paid", F.lit(0.0)).alias("paid"), E.ratio(F.coalesce("paid", F.lit(0.0)), F.col("member_months")).alias("pmpm"))


@query("SELECT payer_id, claim_type, count(DISTINCT claim_id) AS claims, count(DISTINCT CASE WHEN claim_status = 'DENIED' THEN claim_id END)::DOUBLE / nullif(count(DISTINCT claim_id), 0) AS denial_rate FROM fact_claim_line GROUP BY 1, 2")
def gld4_denial_rate(spark, sf):
    out = claims(spark, sf).groupBy("payer_id", "claim_type").agg(F.count_distinct("claim_id").alias("claims"), F.count_distinct(F.when(F.col("claim_status") == "DENIED", F.col("claim_id"))).alias("denied"))
    return out.select("payer_id", "claim_type", "claims", E.ratio(F.col("denied").cast("double"), F.col("claims")).alias("denial_rate"))


@query("""WITH a AS (SELECT claim_type, procedure_code, sum(paid_amount) AS a FROM fact_claim_line WHERE procedure_code IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY claim_type ORDER BY a DESC NULLS LAST, procedure_code) AS rn FROM a)
SELECT claim_type, list(procedure_code ORDER BY rn) AS top_values FROM r WHERE rn <= 5 GROUP BY 1""")
def gld5_topk_array(spark, sf):
    return R.topk_array(claims(spark, sf), ["claim_type"], "procedure_code", F.col("paid_amount"), 5)


@query("""WITH r AS (SELECT strftime(service_to_date, '%Y-%m') AS period, paid_amount AS a, coalesce(datediff('day', service_to_date, created_at::DATE) > 7 AND date_trunc('month', service_to_date) < date_trunc('month', created_at), false) AS late FROM fact_claim_line)
SELECT period, sum(CASE WHEN NOT late THEN a ELSE 0 END)::DOUBLE AS original_amount, sum(CASE WHEN late THEN a ELSE 0 END)::DOUBLE AS late_amount, count(*) FILTER (WHERE late) AS late_rows FROM r GROUP BY 1""")
def gld8_restatement(spark, sf):
    df = claims(spark, sf).withColumns(R.late_flags(F.col("service_to_date"), F.to_date("created_at"), 7)).withColumn("period", F.date_format("service_to_date", "yyyy-MM"))
    return R.restatement(df.withColumn("cents", (F.col("paid_amount") * 100).cast("double")), "period", F.col("cents"), "is_late").select("period", (F.col("original_amount") / 100).alias("original_amount"), (F.col("late_amount") / 100).alias("late_amount"), "late_rows")


# incremental and streaming


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15') - INTERVAL 3 DAY")
def inc1_watermark_filter(spark, sf):
    events = table(spark, sf, "events")
    marks = tables.Watermarks(tables.Table(spark, scratch(spark, "marks")))
    marks.advance("events", events.filter("ts < timestamp_ntz'2024-01-15'"), "ts")
    return marks.filter(events, "ts", "events", 3).select("event_id")


@query("SELECT strftime(service_to_date, '%Y-%m') AS period, count(*) AS rows_beyond FROM fact_claim_line WHERE datediff('day', service_to_date, created_at::DATE) > 30 GROUP BY 1")
def inc4_beyond_lookback(spark, sf):
    return tables.beyond_lookback(claims(spark, sf), "service_to_date", "created_at", 30)


@query("SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' THEN 2 ELSE 1 END AS revision FROM events")
def inc5_reprocess(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    t = tables.Table(spark, scratch(spark, "events"))
    t.overwrite(events.select("event_id", F.lit(1).alias("revision")))
    tables.reprocess(events, "ts", "2024-01-10", "2024-01-12", lambda df: df.select("event_id", F.lit(2).alias("revision")), t, ["event_id"])
    return t.read()


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a feed of several files."""
    path = scratch(spark, "events-feed")
    table(spark, sf, "events").repartition(4, "event_id").write.parquet(path)
    return feeds.read_feed(spark, path, spark.read.parquet(path).schema, 2)


@query("SELECT user_id, event_type, max(event_id) AS event_id FROM events e WHERE ts = (SELECT max(ts) FROM events f WHERE f.user_id = e.user_id AND f.event_type = e.event_type) GROUP BY 1, 2")
def str4_current_state(spark, sf):
    """The latest event per user and type, upserted by a stream in micro-batches."""
    t = tables.Table(spark, scratch(spark, "current"))
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    feeds.keep_latest(_event_stream(spark, sf).select("user_id", "event_type", "ts", "event_id"), t, ["user_id", "event_type"], order, scratch(spark, "checkpoint")).awaitTermination()
    return t.read().select("user_id", "event_type", "event_id")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def str_windowed_counts(spark, sf):
    """Counts per day of event time, kept up by a stream; each window's last update holds."""
    t = tables.Table(spark, scratch(spark, "windows"))
    counts = feeds.windowed_counts(_event_stream(spark, sf), "ts", ["event_type"], "1 day", "60 days").select(F.col("window.start").alias("day"), "event_type", "n")
    q = counts.writeStream.outputMode("update").foreachBatch(lambda b, _: t.upsert(b, ["day", "event_type"]) and None).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    return t.read().select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "n")


# checks and control


@query("SELECT 'null_member' AS check_name, count(*) AS failing FROM fact_claim_line WHERE member_id IS NULL UNION ALL SELECT 'status', count(*) FROM fact_claim_line WHERE claim_status NOT IN ('PAID', 'DENIED') UNION ALL SELECT 'orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def dq1_built_in(spark, sf):
    f = claims(spark, sf)
    found = {"null_member": checks.not_null(f, "member_id"), "status": checks.accepted_values(f, "claim_status", ["PAID", "DENIED"]), "orders": checks.relationships(table(spark, sf, "lineitem"), "l_orderkey", table(spark, sf, "orders"), "o_orderkey")}
    out = None
    for k, df in found.items():
        row = df.agg(F.count("*").alias("failing")).select(F.lit(k).alias("check_name"), "failing")
        out = row if out is None else out.unionByName(row)
    return out


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq2_unique_combination(spark, sf):
    return checks.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT change_id, paid_amount::DOUBLE AS paid_amount FROM fact_claim_line WHERE paid_amount < 0 OR paid_amount > 5000")
def dq3_accepted_range(spark, sf):
    return checks.accepted_range(claims(spark, sf), "paid_amount", 0, 5000).select("change_id", F.col("paid_amount").cast("double").alias("paid_amount"))


@query("SELECT change_id FROM fact_claim_line WHERE NOT (service_to_date >= service_from_date)")
def dq4_expression_is_true(spark, sf):
    return checks.expression_is_true(claims(spark, sf), "service_to_date >= service_from_date").select("change_id")


@query("WITH s AS (SELECT l_orderkey AS k, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS t FROM lineitem GROUP BY 1) SELECT o_orderkey FROM orders LEFT JOIN s ON k = o_orderkey WHERE abs(o_totalprice::DECIMAL(18,2)::DOUBLE - coalesce(t, 0.0)) > 1.0")
def dq8_header_line_recon(spark, sf):
    h = table(spark, sf, "orders").select("o_orderkey", money("o_totalprice").cast("double").alias("total"))
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(money("l_extendedprice")).cast("double").alias("amount"))
    return checks.header_line_reconciliation(h, li, "o_orderkey", "total", "amount", 1.0).select("o_orderkey")


@query(f"WITH {_VERSIONS}, w AS (SELECT chain, version, f, l_partkey % 100 * CASE WHEN f = 'R' THEN -1 ELSE 1 END AS a FROM v), p AS (SELECT *, coalesce(sum(a) OVER (PARTITION BY chain ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM w) SELECT chain, version, 'REVERSAL_EXCEEDS_PRIOR' AS violation FROM p WHERE f = 'R' AND -a > prior")
def dq10_chain_validity(spark, sf):
    v = versions(spark, sf).withColumns({"amount": F.col("l_partkey") % 100 * F.when(F.col("l_returnflag") == "R", -1).otherwise(1), "key": F.concat_ws("/", "chain", "version"), "original": F.lit(None).cast("string")})
    return checks.chain_violations(v, "key", "chain", "version", "amount", F.col("l_returnflag") == "R", "original")


@query("""WITH r AS (SELECT event_type, ts::DATE AS d, count(*) FILTER (WHERE value > 50) AS failing FROM events GROUP BY 1, 2), w AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS rn FROM r), b AS (SELECT event_type, max(failing) FILTER (WHERE rn = 1) AS latest_failing, max(failing) FILTER (WHERE rn = 2) AS prior_failing FROM w WHERE rn <= 2 GROUP BY 1)
SELECT event_type, latest_failing, prior_failing, CASE WHEN prior_failing IS NULL THEN 'NEW' WHEN latest_failing < prior_failing THEN 'IMPROVING' WHEN latest_failing > prior_failing THEN 'REGRESSING' ELSE 'STABLE' END AS trend FROM b""")
def ctl2_scorecard_trend(spark, sf):
    runs = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("run_at")).agg(F.count_if(F.col("value") > 50).alias("failing_rows"))
    return checks.scorecard(runs.select(F.lit("events").alias("table_name"), F.col("event_type").alias("check_name"), "run_at", "failing_rows")).select(F.col("check_name").alias("event_type"), "latest_failing", "prior_failing", "trend")


@query("SELECT source_system, strftime(business_event_ts, '%Y-%m') AS period, count(*) AS n, count(*) FILTER (WHERE datediff('day', business_event_ts, ingest_ts) > 7) AS late FROM br_raw_claim_event GROUP BY 1, 2 HAVING count(*) FILTER (WHERE datediff('day', business_event_ts, ingest_ts) > 7) > 0")
def ctl4_late_summary(spark, sf):
    out = table(spark, sf, "br_raw_claim_event").groupBy("source_system", F.date_format("business_event_ts", "yyyy-MM").alias("period")).agg(F.count("*").alias("n"), F.count_if(E.day_diff(F.col("business_event_ts"), F.col("ingest_ts")) > 7).alias("late"))
    return out.filter("late > 0")


# semantic layer


def claims_model(spark: SparkSession, sf: str) -> layer.Model:
    lines_ = claims(spark, sf).select(E.norm_id("plan_id").alias("plan_id"), F.trunc("service_from_date", "month").alias("month"), "claim_type", "claim_id", "member_id", "paid_amount", "claim_status")
    metrics = [
        layer.Metric("paid_amount", "claim_lines", lambda: F.sum("paid_amount").cast("double"), synonyms=("paid", "total paid"), description="Paid amount"),
        layer.Metric("claim_count", "claim_lines", lambda: F.count_distinct("claim_id"), additive=False, synonyms=("claims",), description="Distinct claims"),
        layer.Metric("denied_claims", "claim_lines", lambda: F.count_distinct(F.when(F.col("claim_status") == "DENIED", F.col("claim_id"))), additive=False, description="Distinct denied claims"),
        layer.Metric("member_months", "member_months", lambda: F.count("*"), description="Covered months"),
        layer.Metric("pmpm", over=("paid_amount", "member_months"), additive=False, description="Paid per member and month"),
        layer.Metric("denial_rate", over=("denied_claims", "claim_count"), additive=False, description="Share of claims denied"),
    ]
    return layer.Model({"claim_lines": lines_, "member_months": member_months(spark, sf)}, {m.name: m for m in metrics}, {"claim_lines": ("plan_id", "month", "claim_type"), "member_months": ("plan_id", "month")}, {"plan": "plan_id", "period": "month"})


@query(f"WITH {_MONTHS}, n AS (SELECT month, count(*) AS mm FROM mm GROUP BY 1), c AS (SELECT date_trunc('month', service_from_date)::DATE AS month, sum(paid_amount)::DOUBLE AS paid FROM fact_claim_line GROUP BY 1) SELECT coalesce(c.month, n.month) AS month, paid AS paid_amount, mm AS member_months, paid / nullif(mm, 0) AS pmpm FROM c FULL JOIN n ON c.month IS NOT DISTINCT FROM n.month")
def sem2_metric_query(spark, sf):
    return claims_model(spark, sf).query(["paid", "member_months", "pmpm"], ["period"])


@query("SELECT claim_type, count(DISTINCT claim_id) AS claim_count, count(DISTINCT CASE WHEN claim_status = 'DENIED' THEN claim_id END)::DOUBLE / nullif(count(DISTINCT claim_id), 0) AS denial_rate FROM fact_claim_line GROUP BY 1")
def sem5_denial_by_type(spark, sf):
    return claims_model(spark, sf).query(["claims", "denial_rate"], ["claim_type"])


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def sem7_guarded_sql(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("serving_customer")
    return guard.guarded_sql(spark, "WITH c AS (SELECT c_mktsegment FROM serving_customer) SELECT c_mktsegment, count(*) AS n FROM c GROUP BY c_mktsegment", {"serving_customer"})


_TERMS = ("blue", "small", "widget")


@query(f"""WITH t AS (SELECT p_partkey, list_filter(regexp_split_to_array(lower(p_name), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM part), n AS (SELECT p_partkey, len(t) AS n, [{', '.join(f"len(list_filter(t, lambda x: x = '{w}'))" for w in _TERMS)}] AS c FROM t),
s AS (SELECT count(*) AS docs, avg(n) AS mean, [{', '.join(f'count(*) FILTER (c[{i}] > 0)' for i in (1, 2, 3))}] AS df FROM n),
r AS (SELECT p_partkey, {' + '.join(f'ln(1 + (docs - df[{i}] + 0.5) / (df[{i}] + 0.5)) * c[{i}] * 2.2 / (c[{i}] + 1.2 * (0.25 + 0.75 * n / mean))' for i in (1, 2, 3))} AS score FROM n, s)
SELECT p_partkey, round(score, 6) AS score FROM r WHERE score > 0 ORDER BY round(score, 9) DESC, p_partkey LIMIT 10""")
def sem11_search(spark, sf):
    """The ten parts whose names fit some words best."""
    return search.search(table(spark, sf, "part"), "p_partkey", "p_name", "small blue widget", 10).withColumn("score", F.round("score", 6))
