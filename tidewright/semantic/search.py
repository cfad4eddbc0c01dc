"""Lexical search: BM25 over a corpus of rows, in DataFrame operations."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), "[^\\p{L}\\p{N}]+"), lambda t: t != "")


def search(corpus: DataFrame, key: str, text: str, query: str, k: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k rows that fit the query best: key, score. Only rows that hold a term of the query are scored; the statistics are of all
    rows. Ties, to nine places, go by key; a query without terms, or an empty corpus, gives none."""
    terms = sorted({t for t in re.split(r"[\W_]+", query.lower()) if t})
    rows = corpus.select(F.col(key).alias("_k"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("_t")).withColumn("_n", F.size("_t"))
    is_term = lambda t: lambda x: x == F.lit(t)
    counts = [F.size(F.filter("_t", is_term(t))).alias(f"c{i}") for i, t in enumerate(terms)]
    stats = corpus.sparkSession.createDataFrame([], f"`{key}` {corpus.schema[key].dataType.simpleString()}, score double")
    if not terms:
        return stats
    counted = rows.select("_k", "_n", *counts)
    totals = counted.agg(F.count("*"), F.avg("_n"), *[F.count_if(F.col(f"c{i}") > 0) for i in range(len(terms))]).first()
    n, mean = totals[0], totals[1] or 1.0
    score = F.lit(0.0)
    for i in range(len(terms)):
        df = totals[2 + i]
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        tf = F.col(f"c{i}").cast("double")
        score = score + F.lit(idf) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("_n") / F.lit(float(mean))))
    return counted.withColumn("score", score).filter("score > 0").orderBy(F.round("score", 9).desc(), "_k").limit(k).select(F.col("_k").alias(key), "score")
