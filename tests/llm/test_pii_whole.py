"""The trees, their counts and their thresholds come from all documents."""

import inspect
import random

import numpy as np
from cases import frame
from terrier.llm import pii


def _rows(rng, n):
    rows = []
    for i in range(n):
        a, b, c = rng.randint(100, 999), rng.randint(1000, 9999), rng.randint(1000, 9999)
        date = f"{rng.randint(1990, 2029)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"
        rows.append((i, [f"phone: {a} {b} {c} here", f"met on {date} there", f"item {b}{c} there"][i % 3]))
    return rows


def test_no_bound_unless_asked_for():
    assert inspect.signature(pii.fit).parameters["most"].default is None


def test_every_example_counts(spark):
    """More documents than the fit once read at most: the weight shows how many examples it has seen."""
    rng = random.Random(3)
    keys = ["".join(rng.choice("abcdef") + rng.choice("0123456789") for _ in range(12)) for _ in range(24_000)]
    rows = [(i, f"token = {k} end" if i % 2 else f"version {k} end") for i, k in enumerate(keys)]
    docs = frame(spark, rows).select("doc_id", "text")
    examples = pii._examples(docs.selectExpr("doc_id as k", "text")).filter("kind = 4")
    assert examples.count() == len(rows)
    fewer = min(r[0] for r in examples.filter("half = 0").groupBy("y").agg({"*": "count"}).selectExpr("`count(1)`").collect())
    model = pii.fit(docs)
    assert fewer > 5000 and model.weights["secret"] == fewer / (fewer + pii.SHRINK)


def test_the_same_trees_however_rows_are_dealt(spark):
    rows = _rows(random.Random(5), 600)
    one, other = (pii.fit(frame(spark, given, parts)) for given, parts in ((rows, 2), (rows[::-1], 7)))
    assert one.thresholds == other.thresholds and one.weights == other.weights
    assert [t[0] for t in one.trees] == [t[0] for t in other.trees]
    assert all(np.array_equal(a[1], b[1]) for a, b in zip(one.trees, other.trees, strict=True))


def test_equal_rows_are_one_example(spark):
    rows = [(7, f"pay {i} 4845168114407329 now") for i in (1, 1, 1, 1, 2)] + [(None, "pay 4845168114407329"), (8, None), (9, "")]
    examples = pii._examples(frame(spark, rows).selectExpr("doc_id as k", "text"))
    assert examples.filter(f"kind = {pii.KINDS.index('card')}").count() == 2


def test_thresholds_are_of_all_counts():
    steps = np.zeros((len(pii.KINDS), pii.STEPS, 2))
    steps[3, 3000, 1], steps[3, 2900] = 40, (40, 40)
    model = pii.Boosted()
    pii.calibrate(model, steps)
    assert model.thresholds["phone"] == 3000 / pii.STEPS and model.thresholds["card"] == pii.UNCALIBRATED
