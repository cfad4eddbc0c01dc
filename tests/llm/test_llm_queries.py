import os

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewright.llm import bpe, packing, queries
from tidewright.session import cut

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="no test data here")
def test_ids_of_all_documents(spark):
    t = Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = {r.doc_id: r.text for r in queries.documents(spark, SF).select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in queries.p8_ids(spark, SF).collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in texts.items()}


@pytest.mark.skipif(not os.path.exists(SF), reason="no test data here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() >= 0


@pytest.mark.skipif(not os.path.exists(SF), reason="no test data here")
def test_containers_of_a_small_corpus_are_full(spark):
    """The one row of SQL, on tables of 100 texts, of texts whose ids repeat or are null, and of none."""
    docs = queries.documents(spark, SF)
    n = docs.count()
    odd = docs.unionByName(docs.withColumn("text", docs.text.substr(1, 700))).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    for df, texts in ((docs, n), (odd, n), (docs.limit(0), 0)):
        packed = cut(packing.pack(df, "doc_id", "text"))
        assert [tuple(r) for r in queries.invariants(df, packed).collect()] == [(texts, 0, 0, 0, True)]


def test_invariants_find_what_is_wrong(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "doc_id long, text string")
    good = [(1, 0, 7, 0, 0, 2048), (1, 1, 8, 0, 2048, 2000), (2, 0, 9, 0, 0, 1000), (2, 0, 9, 1, 0, 1000), (3, 0, 8, 1, 0, 40)]
    of = lambda rows: tuple(queries.invariants(docs, spark.createDataFrame(rows, "doc_id long, piece int, container long, place int, first long, tokens long")).first())
    assert of(good) == (3, 0, 0, 0, True)
    assert of(good[:-1]) == (2, 1, 0, 0, True)  # a text is missing
    assert of(good[:3] + good[4:]) == (3, 1, 0, 0, True)  # one of two rows is
    assert of([*good, (1, 0, 10, 0, 0, 2048)])[1] == 1  # a piece twice
    assert of([*good[1:], (1, 0, 7, 0, 0, 2000)])[1] == 1  # a hole within a text
    assert of([*good[:-1], (3, 0, 8, 2, 0, 90)]) == (3, 0, 1, 1, True)
    assert of([*good[:2], *((2, 0, 20 + k, 0, 0, 10) for k in range(2)), good[4]])[4] is False
