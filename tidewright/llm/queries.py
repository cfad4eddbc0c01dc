"""The pN_ queries of the text problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import bpe, mojibake, packing
from tidewright.session import cut


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode_column(documents(spark, sf), "doc_id", "text")


def p9_packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), "doc_id", "text")


def invariants(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """What must hold of the containers: every text whole and once, none over the capacity, places without holes, little room left: all but one
    container, the last, are full to 0.98 on average (a corpus seldom is a multiple of the capacity).

    Ids that several rows share are whole if each row has its first piece, and no piece follows but full ones."""
    boxes = packed.groupBy("container").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"), F.count_distinct("place").alias("p"), F.max("place").alias("m"))
    full = F.coalesce(F.sum("t") > F.lit(0.98 * 2048) * (F.count("*") - 1), F.lit(True)).alias("is_full")
    a = boxes.agg(F.count_if(F.expr("t > 2048")).alias("over_capacity"), F.count_if(F.expr("n <> p or n <> m + 1")).alias("with_holes"), full)
    rows = docs.select("doc_id", F.lit(-1).alias("piece"), F.lit(-2048).cast("long").alias("first"), F.lit(2048).cast("long").alias("tokens"))
    pieces = packed.select("doc_id", "piece", "first", "tokens").unionByName(rows).groupBy("doc_id", "piece")
    pieces = pieces.agg(F.count("*").alias("n"), F.count_if(F.expr("tokens = 2048")).alias("whole"), F.count_if(F.expr("first <> piece * 2048L")).alias("off"))
    texts = pieces.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "n", "whole", "off"))).alias("p"))
    torn = "size(p) < 2 or p[1].n <> p[0].n or exists(transform(p, (x, i) -> x.piece <> i - 1 or x.off > 0 or (i > 0 and x.n > p[i - 1].whole)), x -> x)"
    b = texts.agg(F.count_if(F.expr("doc_id is not null and p[size(p) - 1].piece >= 0")).alias("texts"), F.count_if(F.expr(torn)).alias("torn"))
    return b.crossJoin(a).select("texts", "torn", "over_capacity", "with_holes", "is_full")  # one row each


def p9_invariants(spark: SparkSession, sf: str) -> DataFrame:
    return invariants(documents(spark, sf), cut(p9_packed(spark, sf), "packed"))


P9_INVARIANTS_SQL = "SELECT count(DISTINCT doc_id) AS texts, 0::BIGINT AS torn, 0::BIGINT AS over_capacity, 0::BIGINT AS with_holes, true AS is_full FROM documents"


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.repair(documents(spark, sf), "doc_id", "text", "source", with_text=False).select("doc_id")


def p10_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.repair(documents(spark, sf), "doc_id", "text", "source")


QUERIES = {"p8_ids": p8_ids, "p9_packed": p9_packed, "p9_invariants": p9_invariants, "p10_found": p10_found, "p10_repaired": p10_repaired}
SQL: dict[str, str] = {"p9_invariants": P9_INVARIANTS_SQL}
