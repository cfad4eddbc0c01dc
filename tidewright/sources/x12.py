"""X12 837P: interchange text or parsed documents to segments, and segments to claim relations. All in expressions; no process is called."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators import nested


def _name(i: Column) -> Column:
    """An element's number as it is written: 01, 02, ..., 99, 100."""
    return F.when(i < 10, F.concat(F.lit("0"), i.cast("string"))).otherwise(i.cast("string"))


def _in_arrays(df: DataFrame, text: str, key: str, segment_end: str, element: str) -> DataFrame:
    """record_key, control_number (ISA13), and all segments of a text in order: array of (claim_seq, e), e[0] being the segment's name."""
    end, sep = re.escape(segment_end), re.escape(element)
    none = f"[^{sep}{end}]*"
    loop = f"(?<={end})(?=HL{sep}{none}{sep}{none}{sep}22(?:[{sep}{end}]|$))"
    one = F.concat(F.lit(segment_end), F.regexp_replace(F.btrim(text, F.lit(" \t\r\n")), f"[ \t\r\n]*{end}[ \t\r\n]*", segment_end))
    segments = lambda loop_text, k: F.transform(F.filter(F.split(loop_text, end), lambda s: s != ""), lambda s: F.struct(k.cast("int").alias("claim_seq"), F.split(s, sep).alias("e")))
    rows = df.select(F.col(key).alias("record_key"), F.flatten(F.transform(F.split(one, loop), segments)).alias("all"))
    return rows.select("record_key", F.btrim(F.get(F.get(F.filter("all", lambda x: x.e[0] == "ISA"), F.lit(0)).e, F.lit(13))).alias("control_number"), "all")


def parse_interchange(df: DataFrame, text: str = "text", key: str = "file_name", segment_end: str = "~", element: str = "*") -> DataFrame:
    """One row per segment: key, control_number (ISA13), segment_index, segment, claim_seq (running count of subscriber loops) and elements, an
    array from element 01. Line ends around segments are dropped; a text without ISA gives rows without a control number.

    A text is first cut where subscriber loops begin and then into segments, within arrays, so that nothing is shuffled or sorted."""
    rows = _in_arrays(df, text, key, segment_end, element).select("record_key", "control_number", F.posexplode("all").alias("segment_index", "_s"))
    rest = F.slice("_s.e", F.lit(2), F.greatest(F.size("_s.e") - 1, F.lit(0)))
    return rows.select("record_key", "segment_index", F.col("_s.e")[0].alias("segment"), rest.alias("elements"), "_s.claim_seq", "control_number")


def document_segments(df: DataFrame, key: str, payload: str, separator: str = "<") -> DataFrame:
    """The segments of parsed documents in the form of parse_interchange. An element that is an object is put as the composite's text; fields that
    are absent leave null elements. control_number is that of the document's ISA segment."""
    rows = nested.explode_children(df, key, payload, [nested.Child("segment", "segments", "_segment", "claim_seq")])
    number = lambda m: F.array_max(F.filter(F.transform(F.map_keys(m), lambda k: k.try_cast("int")), lambda i: i.isNotNull()))
    places = lambda m: F.when(number(m) > 0, F.sequence(F.lit(1), number(m))).otherwise(F.array().cast("array<int>"))

    def shown(v: Column) -> Column:
        parts = F.try_variant_get(v, "$", "map<string,string>")
        composite = F.array_join(F.transform(places(parts), lambda i: F.coalesce(F.try_element_at(parts, _name(i)), F.lit(""))), separator)
        return F.when(nested.is_object(v), composite).otherwise(F.try_variant_get(v, "$", "string"))

    fields = F.try_variant_get("object", "$", "map<string,variant>")
    out = rows.select("record_key", F.col("pos").alias("segment_index"), F.nullif("child_key", F.lit("")).alias("segment"), F.col("parent_seq").alias("claim_seq"), fields.alias("_f"))
    out = out.select("record_key", "segment_index", "segment", "claim_seq", F.transform(places(F.col("_f")), lambda i: shown(F.try_element_at("_f", _name(i)))).alias("elements"))
    return out.withColumn("control_number", F.when(F.col("segment") == "ISA", F.btrim(F.get("elements", F.lit(12)))))


def load_raw(files: DataFrame) -> DataFrame:
    """Landing rows of whole files (file_name, text): bronze_event_id (SHA-256 of the name), source_file_name, natural_key (ISA13; null without ISA), payload,
    payload_hash (SHA-256 of the text), record_status LANDED."""
    first = F.split_part("text", F.lit("~"), F.lit(1))
    isa = F.when(F.ltrim(first).startswith("ISA"), F.btrim(F.get(F.split(first, r"\*"), F.lit(13))))
    return files.select(F.sha2("file_name", 256).alias("bronze_event_id"), F.col("file_name").alias("source_file_name"), isa.alias("natural_key"), F.col("text").alias("payload"), F.sha2("text", 256).alias("payload_hash"), F.lit("LANDED").alias("record_status"))


def convert(raw: DataFrame) -> DataFrame:
    """What becomes of landed files (see load_raw): their id, record_status PROCESSED or QUARANTINE, quarantine_reason (at most 500 characters), and the
    parsed document as JSON text: control number, transaction type, number of segments, and the segments with their elements by number."""
    named = lambda x: F.map_concat(F.create_map(F.lit("_segment"), x.e[0], F.lit("claim_seq"), x.claim_seq.cast("string")), F.map_from_arrays(F.transform(F.slice(x.e, F.lit(2), F.size(x.e) - 1), lambda _, i: _name(i + 1)), F.slice(x.e, F.lit(2), F.size(x.e) - 1)))
    is_ = lambda name: F.filter("all", lambda x: x.e[0] == name)
    docs = _in_arrays(raw, "payload", "bronze_event_id", "~", "*").select(
        F.col("record_key").alias("bronze_event_id"), F.nullif("control_number", F.lit("")).alias("interchange_control_number"), F.get(F.get(is_("ST"), F.lit(0)).e, F.lit(1)).alias("transaction_type"),
        (F.size(is_("IEA")) > 0).alias("_ended"), F.size("all").alias("segment_count"), F.transform("all", named).alias("segments"),
    )
    reason = (
        F.when(F.col("interchange_control_number").isNull(), "no interchange header (ISA) with a control number")
        .when(F.coalesce("transaction_type", F.lit("")) != "837", F.concat(F.lit("transaction type is not 837: "), F.coalesce("transaction_type", F.lit("none"))))
        .when(~F.coalesce("_ended", F.lit(False)), "no interchange trailer (IEA)")
    )
    out = docs.withColumn("quarantine_reason", F.left(reason, F.lit(500)))
    document = F.to_json(F.struct("interchange_control_number", "transaction_type", "segment_count", "segments"))
    good = F.col("quarantine_reason").isNull()
    return out.select("bronze_event_id", F.when(good, "PROCESSED").otherwise("QUARANTINE").alias("record_status"), "quarantine_reason", F.when(good, document).alias("document"))


def component(c: Column, i: int, separator: str = "<") -> Column:
    """The i-th component (from 1) of a composite; null if absent."""
    return F.nullif(F.split_part(c, F.lit(separator), F.lit(i)), F.lit(""))


def element(i: int) -> Column:
    return F.nullif(F.get("elements", F.lit(i - 1)), F.lit(""))


def claim_headers(segments: DataFrame) -> DataFrame:
    """One row per claim: one conditional aggregation instead of a join per segment kind. The billing provider stands before the claims."""
    at = F.col("segment_index")
    pick = lambda cond, v: F.min_by(F.when(cond, v), F.when(cond & v.isNotNull(), at))
    nm1 = lambda code: (F.col("segment") == "NM1") & (element(1) == code)
    by_claim = segments.groupBy("record_key", "claim_seq").agg(
        F.max("control_number").alias("control_number"),
        pick(F.col("segment") == "CLM", element(1)).alias("claim_id"),
        pick(F.col("segment") == "CLM", element(2)).try_cast("decimal(18,2)").alias("charge_amount"),
        component(pick(F.col("segment") == "CLM", element(5)), 1).alias("place_of_service"),
        pick(nm1("IL"), element(9)).alias("member_id"),
        pick(nm1("PR"), element(9)).alias("payer_id"),
        pick(nm1("82"), element(9)).alias("rendering_npi"),
        pick(nm1("85"), element(9)).alias("_billing"),
        F.min(F.when((F.col("segment") == "DTP") & (element(1) == "472"), F.try_to_date(element(3), "yyyyMMdd"))).alias("service_date"),
    )
    whole = Window.partitionBy("record_key")
    billing = F.max(F.when(F.col("claim_seq") == 0, F.col("_billing"))).over(whole)
    out = by_claim.withColumns({"billing_npi": F.coalesce("_billing", billing), "control_number": F.max("control_number").over(whole)})
    return out.drop("_billing").filter("claim_id is not null")


def claim_lines(segments: DataFrame) -> DataFrame:
    """One row per SV1 with the line number of the nearest LX before and the date of the nearest DTP 472 after it. The latter has no bound:
    a line without its own date takes the next line's."""
    w = Window.partitionBy("record_key", "claim_seq").orderBy("segment_index")
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    rows = segments.select(
        "*",
        F.last(F.when(F.col("segment") == "LX", element(1)), ignorenulls=True).over(before).alias("line_number"),
        F.first(F.when((F.col("segment") == "DTP") & (element(1) == "472"), F.try_to_date(element(3), "yyyyMMdd")), ignorenulls=True).over(after).alias("service_date"),
    )
    return rows.filter("segment = 'SV1'").select("record_key", "claim_seq", "segment_index", F.col("line_number").try_cast("int").alias("line_number"), component(element(1), 2).alias("procedure_code"), element(2).try_cast("decimal(18,4)").alias("charge_amount"), element(4).try_cast("decimal(18,4)").alias("units"), "service_date")


def claim_diagnoses(segments: DataFrame) -> DataFrame:
    """One row per composite of HI: position in the claim, qualifier, code, is_principal (qualifier BK)."""
    rows = segments.filter("segment = 'HI'").select("record_key", "claim_seq", "segment_index", F.posexplode("elements").alias("_p", "_c")).filter("_c <> ''")
    w = Window.partitionBy("record_key", "claim_seq").orderBy("segment_index", "_p")
    return rows.select("record_key", "claim_seq", F.row_number().over(w).alias("position"), component(F.col("_c"), 1).alias("qualifier"), component(F.col("_c"), 2).alias("diagnosis_code"), F.coalesce(component(F.col("_c"), 1) == "BK", F.lit(False)).alias("is_principal"))


def write_interchange(claims: DataFrame, batch: str = "batch", sender: str = "SENDER", place: str = "11<B<1") -> DataFrame:
    """Claims (batch, claim_seq, claim_id, member_id, payer_id, npi, charge decimal, diagnosis_code, lines: array of (procedure_code, charge,
    units, service_date)) as one X12 text per batch: batch, text. place: the composite of element 05 of all claims. A batch is one text and one task's
    array, so batches should have a bounded number of claims. Trailing empty elements are left out."""
    seg = lambda *e: F.regexp_replace(F.concat_ws("*", *[F.coalesce(x.cast("string"), F.lit("")) if isinstance(x, Column) else F.lit(x) for x in e]), "\\*+$", "")
    lines = F.flatten(F.transform("lines", lambda x, i: F.array(seg("LX", i + 1), seg("SV1", F.concat(F.lit("HC<"), x.procedure_code), x.charge, "UN", x.units), seg("DTP", "472", "D8", F.date_format(x.service_date, "yyyyMMdd")))))
    head = F.array(seg("HL", F.col("claim_seq") + 1, "1", "22", "0"), seg("NM1", "IL", "1", "", "", "", "", "", "MI", F.col("member_id")), seg("NM1", "PR", "2", "", "", "", "", "", "PI", F.col("payer_id")), seg("CLM", F.col("claim_id"), F.col("charge"), "", "", place), seg("HI", F.concat(F.lit("BK<"), F.col("diagnosis_code"))), seg("NM1", "82", "1", "", "", "", "", "", "XX", F.col("npi")))
    body = claims.select(batch, "claim_seq", F.concat(head, lines).alias("_segs"))
    joined = body.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct("claim_seq", "_segs"))).alias("_all"))
    control = F.lpad(F.col(batch).cast("string"), 9, "0")
    start = F.array(seg("ISA", "00", "", "00", "", "ZZ", sender, "ZZ", "RECEIVER", "", "", "^", "00501", control, "0", "P", "<"), seg("GS", "HC", sender), seg("ST", "837", "0001"), seg("HL", "1", "", "20", "1"))
    segs = F.concat(start, F.flatten(F.transform("_all", lambda x: x["_segs"])), F.array(seg("SE"), seg("GE", "1"), seg("IEA", "1", control)))
    return joined.select(batch, F.concat(F.concat_ws("~\n", segs), F.lit("~")).alias("text"))
