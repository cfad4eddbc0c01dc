"""Column expressions shared by all layers: ids, keys, hashes, variant paths, dates, ratios, rule cascades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"
#: What stands for null in surrogate keys (fixed value, so that keys stay comparable).
NULL_IN_KEYS = "_dbt_utils_surrogate_key_null_"


def norm_id(c: Column | str) -> Column:
    """Upper case without surrounding blanks; a blank id is no id (null)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.upper(F.btrim(c, F.lit(BLANKS))), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """Without surrounding blanks; null where nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.btrim(c, F.lit(BLANKS)), F.lit(""))


def micros(c: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def variant_get(v: Column, path: str, dtype: str = "string", default=None) -> Column:
    """The value at a path of a variant, by way of text, so that 12.50 and "12.50" read alike; null if absent or not castable."""
    out = F.try_variant_get(v, path, "string")
    if dtype != "string":
        out = out.try_cast(dtype)
    return out if default is None else F.coalesce(out, F.lit(default).cast(dtype))


def json_get(text: Column, path: str, dtype: str = "string", default=None) -> Column:
    """variant_get on JSON text; text that is not valid JSON gives null (or the default)."""
    return variant_get(F.try_parse_json(text), path, dtype, default)


def loose_boolean(c: Column) -> Column:
    """true/false by cast, then y, yes, true, 1 by word, else false."""
    return F.coalesce(c.try_cast("boolean"), F.lower(F.trim(c)).isin("y", "yes", "true", "1"), F.lit(False))


def natural_key(*parts: Column) -> Column:
    """Parts joined by |. A null part makes the key null, so that rows without an identity never share one."""
    out = []
    for p in parts:
        out += [F.lit("|"), p.cast("string")]
    return F.concat(*out[1:])


def surrogate_key(*cols: Column, absent: str = NULL_IN_KEYS) -> Column:
    """MD5 over the |-joined text of the columns, null being a sentinel."""
    out = []
    for c in cols:
        out += [F.lit("|"), F.coalesce(c.cast("string"), F.lit(absent))]
    return F.md5(F.concat(*out[1:]))


def payload_hash(v: Column) -> Column:
    """SHA-256 over the JSON text of a variant."""
    return F.sha2(F.to_json(v), 256)


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def div0(a: Column, b: Column) -> Column:
    """a / b; 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / F.nullif(b, F.lit(0)))


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0."""
    return a / F.nullif(b, F.lit(0))


def day_diff(a: Column, b: Column) -> Column:
    """Day boundaries between a and b."""
    return F.datediff(F.to_date(b), F.to_date(a))


def hour_diff(a: Column, b: Column) -> Column:
    """Hour boundaries between a and b."""
    return (micros(F.date_trunc("hour", b)) - micros(F.date_trunc("hour", a))) / F.lit(3_600_000_000)


def first_failing(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule whose condition holds; null where none does. A condition that is null doesn't hold."""
    out = None
    for name, condition in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return F.lit(None).cast("string") if out is None else out


def resolve_status(derived: Column, incoming_status: Column, incoming_reason: Column) -> dict[str, Column]:
    """Status and reason of a landed row: a derived reason or an incoming quarantine sets it aside."""
    return {
        "record_status": F.when(derived.isNotNull(), "QUARANTINE").when(F.upper(incoming_status).isin("QUARANTINE", "QUARANTINED"), "QUARANTINE").otherwise("VALID"),
        "quarantine_reason": F.coalesce(derived, incoming_reason),
    }


def audit_columns(run: dict, **more: Column) -> dict[str, Column]:
    """The columns that say when and by what a row was written. run holds literals (now, run_id, ...), frozen for the run."""
    now = F.lit(run["now"]).cast("timestamp_ntz")
    return {
        "created_at": now,
        "updated_at": now,
        "source_system": F.lit(run.get("source_system")).cast("string"),
        "batch_id": F.lit(run.get("batch_id")).cast("string"),
        "load_id": F.lit(run.get("load_id")).cast("string"),
        "pipeline_run_id": F.lit(run.get("run_id")).cast("string"),
        "is_current": F.lit(True),
        "effective_from": now,
        "effective_to": F.lit(None).cast("timestamp_ntz"),
    } | more
