"""Texts are encoded and decoded in one pass, with one Python worker a task."""

import public_tokenizers

from cases import awkward, empty
from terrier.llm import bpe, queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def python_steps(df):
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow ")


def test_decoded_with_the_ids(spark):
    docs = awkward(spark)
    both = bpe.encode(docs, BYTES, decoded=True)
    after = bpe.decode(bpe.encode(docs, BYTES), BYTES)
    assert both.columns == after.columns == ["doc_id", "ids", "text"]
    assert sorted(map(str, both.collect())) == sorted(map(str, after.collect()))
    assert bpe.encode(empty(spark), BYTES, decoded=True).count() == 0


def test_the_query_has_one_python_step(spark):
    assert python_steps(queries.op8_bpe(spark, "/root/testdata/sf0.001")) == 1
