"""The trees add spans that no rule supports, and reject spans that a rule proposes."""

import random

from cases import frame
from terrier.llm import pii


def _table(rng, n=1200):
    """Numbers in groups of 3, 4 and 4 digits after telling words, dates, and digits of one piece."""
    rows = []
    for i in range(n):
        a, b, c = rng.randint(100, 999), rng.randint(1000, 9999), rng.randint(1000, 9999)
        date = f"{rng.randint(1990, 2029)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"
        rows.append((i, [f"phone: {a} {b} {c} here", f"met on {date} there", f"item {b}{c} there"][i % 3]))
    return rows


def _spans(spark, docs, model):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in pii.detect(docs, model).collect()}


def test_the_trees_add_and_reject(spark):
    rng = random.Random(11)
    rows = _table(rng)
    unsupported = [(5000 + i, f"ask under {rng.randint(100, 999)} {rng.randint(1000, 9999)} {rng.randint(1000, 9999)} today") for i in range(40)]
    proposed = [(6000 + i, f"call {rng.randint(1990, 2029)}-11-{rng.randint(10, 28)} again") for i in range(40)]
    for _, text in unsupported:
        (c,) = pii.candidates(text)
        assert pii.weak_label(text, *c, set()) == 0 and pii.evidence(text, *c, set()) == 0
    for _, text in proposed:
        (c,) = pii.candidates(text)
        assert pii.weak_label(text, *c, set()) == 1 and pii.evidence(text, *c, set()) == 0
    model = pii.fit(frame(spark, rows))
    assert pii.UNCALIBRATED != model.thresholds["phone"] <= 1
    docs = frame(spark, rows + unsupported + proposed)
    found, without = _spans(spark, docs, model), _spans(spark, docs, pii.Boosted())
    assert all([s[0] for s in found[i]] == ["phone"] for i, _ in unsupported)
    assert not any(found[i] for i, _ in proposed)
    assert not any(without[i] for i, _ in unsupported + proposed)
    assert all(bool(found[i]) == (i % 3 == 0) for i, _ in rows)


def test_the_trees_overrule_evidence():
    text = "tel 12345678 end"
    assert pii.evidence(text, "phone", 4, 12, set()) == 1
    assert pii.find(text, pii.Boosted())[1] == [("phone", 4, 12)]
    against = pii.Boosted(bias=-3.0, weights={"phone": 1.0})
    assert pii.find(text, against)[1] == []


def test_base_spans_stay_whatever_the_model_says():
    text = "mail a.b@c.org, ip 10.0.0.1, +1 (017) 555-7713"
    model = pii.Boosted(bias=-50.0, weights=dict.fromkeys(pii.KINDS, 1.0))
    assert pii.find(text, model) == (pii.base_spans(text), sorted(pii.base_spans(text), key=lambda s: (pii.KINDS.index(s[0]), s[1])))


def test_what_speaks_against_a_span():
    cases = [
        ("commit 04dbebab91ab85687d33eeaa now", "secret", True),
        ("key is 04dbebab91ab85687d33eeaa now", "secret", False),
        ("a 04dbebab91ab85687d33eeaa b", "secret", True),
        ("at 1700000000000 ms", "card", True),
        ("v 10.0.0.1 x", "ip", True),
        ("jo@home now", "email", True),
        ("in 2024-11-05 or", "phone", True),
        ("or 020 7946 0958 or", "phone", False),
    ]
    for text, kind, against in cases:
        spans = [c for c in pii.candidates(text) if c[0] == kind]
        assert spans and pii.contradicted(text, *spans[0], set()) == against, text


def test_repeated_rows_are_one_example_and_the_bound_holds(spark):
    rows = [(7, f"pay {i} 4845168114407329 now") for i in (1, 1, 1, 1, 2)] + [(None, "pay 4845168114407329"), (8, None), (9, "")]
    rows += [(100 + i, f"ask 020 7946 {1000 + i}") for i in range(60)]
    docs = frame(spark, rows).selectExpr("doc_id as k", "text")
    held = sorted(tuple(r) for r in pii._holding(docs, 1000).collect())
    assert held == sorted({r for r in rows if r[0] is not None and r[1]})
    assert pii._holding(docs, 20).count() <= 20
