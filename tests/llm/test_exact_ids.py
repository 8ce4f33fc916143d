"""Ids that carry several texts."""

from cases import frame
from terrier.llm import exact


def test_a_copy_goes_without_the_other_text_of_its_id(spark):
    docs = frame(spark, [(1, "only here"), (1, "Twice"), (2, "twice"), (3, None), (4, "")])
    kept = exact.keep_one(docs)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "only here"), (2, "twice"), (4, "")]
    assert kept.columns == docs.columns
