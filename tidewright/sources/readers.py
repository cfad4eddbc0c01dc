"""Readers: NDJSON feeds that keep their bad lines, seeds, whole-file texts, and landing with file metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The envelope of all feeds.
ENVELOPE = T.StructType([
    T.StructField("source_system", T.StringType()), T.StructField("source_file_name", T.StringType()), T.StructField("source_extract_ts", T.StringType()),
    T.StructField("event_type", T.StringType()), T.StructField("business_event_ts", T.StringType()), T.StructField("natural_key", T.StringType()),
    T.StructField("payload_hash", T.StringType()), T.StructField("payload", T.VariantType()),
])


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line by a given schema (no inference pass); compression by file extension."""
    return spark.read.schema(schema).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, file_name, and offset_id: a number that grows with the line's place in its file."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("_at")).withColumn("offset_id", F.monotonically_increasing_id())


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """line, file_name and row_number from 1: exact, for files that fit in one task (see read_lines for others)."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "\\r?\\n\\z", "").alias("v"), F.col("_metadata.file_name").alias("file_name"))
    return whole.select("file_name", F.posexplode(F.split("v", "\\r?\\n")).alias("p", "line")).select("line", "file_name", (F.col("p") + 1).cast("long").alias("row_number"))


def row_id(file_name: Column, row_number: Column) -> Column:
    """SHA-256 over name:row."""
    return F.sha2(F.concat(file_name, F.lit(":"), row_number.cast("string")), 256)


def land(lines: DataFrame, load: dict) -> tuple[DataFrame, DataFrame]:
    """Numbered lines (line, file_name, row_number) as landing rows and rejects. A line that is no JSON object is rejected with its text;
    it doesn't stop the load. Timestamps that don't parse become null. load: batch_id, load_id, run_id, now (literals, frozen for the run)."""
    parsed = lines.withColumn("_v", F.try_parse_json("line"))
    good = F.coalesce(F.schema_of_variant(F.col("_v")).startswith("OBJECT"), F.lit(False))
    get = lambda p: F.try_variant_get(F.col("_v"), f"$.{p}", "string")
    landed = parsed.filter(good).select(
        row_id(F.col("file_name"), F.col("row_number")).alias("bronze_event_id"), get("source_system").alias("source_system"), F.col("file_name").alias("source_file_name"), F.col("row_number").alias("source_file_row_number"),
        get("source_extract_ts").try_cast("timestamp_ntz").alias("source_extract_ts"), F.lit(load["now"]).cast("timestamp_ntz").alias("ingest_ts"), get("event_type").alias("event_type"),
        get("business_event_ts").try_cast("timestamp_ntz").alias("business_event_ts"), get("natural_key").alias("natural_key"), F.try_variant_get(F.col("_v"), "$.payload", "string").alias("payload"), get("payload_hash").alias("payload_hash"),
        F.lit("LANDED").alias("record_status"), F.lit(load["batch_id"]).alias("batch_id"), F.lit(load["load_id"]).alias("load_id"), F.lit(load["run_id"]).alias("pipeline_run_id"),
    )
    rejected = parsed.filter(~good).select("file_name", "row_number", F.col("line").alias("raw_line"), F.lit("INVALID_JSON").alias("reason"))
    return landed, rejected


def read_seed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV seed: header, quotes, blanks trimmed, '', NULL and null read as null, a wrong column count an error; codes stay text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return raw.select(*[F.when(~F.col(c).isin("", "NULL", "null"), F.col(c)).alias(c) for c in columns])


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: file_name, text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def freshness(df: DataFrame, column: str, as_of: str, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """newest, hours_old, status (PASS, WARN, ERROR); an empty table is an ERROR."""
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3_600_000_000
    return df.agg(F.max(column).alias("newest")).select("newest", F.round(age, 2).alias("hours_old"), F.when(age <= warn_hours, "PASS").when(age <= error_hours, "WARN").otherwise("ERROR").alias("status"))
