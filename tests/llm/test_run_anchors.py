"""Windows are listed only where an anchor of 33 words repeats, and all equal windows are."""

import random

import numpy as np

from cases import frame
from terrier.llm import paragraphs


def texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    some = lambda n: [word() for _ in range(n)]
    return some, [" ".join(some(60) + (p := some(30)) + some(60)), " ".join(some(40) + p + some(80))]


def test_short_shared_passages_make_no_windows(spark, monkeypatch):
    seen, settle = {}, paragraphs.settle
    monkeypatch.setattr(paragraphs, "settle", lambda df, name: seen.setdefault(name, settle(df, name)))
    _, both = texts()
    assert paragraphs.shared_runs(frame(spark, list(enumerate(both)))).count() == 0
    assert seen["anchors"].count() > 0 and seen["windows"].count() == 0


def test_equal_windows_have_equal_anchors():
    some, _ = texts()
    passage = some(70)
    own = []
    for before in (0, 5, 90):
        words = paragraphs._Words(["x", " ".join(some(before) + passage + some(20)), ""])
        at, code, prints = paragraphs._anchors(words, 50, 15)
        named = dict(zip(np.unique(code).tolist(), prints.tolist(), strict=True))
        first = words.first[1] + before
        own.append([named[c] for p, c in zip(at.tolist(), code.tolist(), strict=True) if first <= p <= first + 20])
        assert len(at) == before + 41 and len(own[-1]) == 21
    assert own[0] == own[1] == own[2]


def test_a_run_goes_on_across_batches(spark):
    some, _ = texts()
    passage = " ".join(some(300))
    docs = frame(spark, [(i, passage) for i in range(4)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = paragraphs.shared_runs(docs).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.doc_id, r.start, r.end, r.first_doc, r.copies, r.removed) for r in found) == [
        (i, 0, len(passage), 0, 4, i > 0) for i in range(4)
    ]
