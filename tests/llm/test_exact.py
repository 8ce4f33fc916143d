import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cases import LONG, awkward, empty, frame
from terrier.llm import exact


def brute(rows):
    lower = [(i, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for i, t in rows]
    groups = defaultdict(list)
    for i, t in lower:
        groups[t].append(i)
    found = []
    for i, t in lower:
        ids = [x for x in groups[t] if x is not None]
        keep = max(ids) if ids else None
        found.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(found, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bits", [64, 3])
def test_brute_force(spark, bits):
    docs = awkward(spark).union(frame(spark, [(20, LONG + "x"), (21, LONG + "X"), (22, "y" + LONG), (23, LONG[:5000])]))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(exact.exact_duplicates(docs, bits=bits)) == brute(rows)


def test_empty(spark):
    assert exact.exact_duplicates(empty(spark)).count() == 0


def test_chunks_join_to_the_text(spark):
    docs = awkward(spark).select(F.coalesce("text", F.lit("")).alias("t"))
    assert docs.filter(F.concat_ws("", exact.cut(F.col("t"))) != F.col("t")).count() == 0


def test_keep_one(spark):
    kept = exact.keep_one(awkward(spark))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [3, 4, 5, 7, 8, 9, 10]
    assert "component" in kept.columns


def test_no_python_in_the_plan(spark):
    plan = exact.exact_duplicates(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
