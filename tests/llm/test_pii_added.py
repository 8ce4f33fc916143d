"""Personal data beyond the base spans."""

import random

from cases import frame
from terrier.llm import pii


def _keys(rng, n):
    return ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(n)]


def test_few_secrets_are_found(spark):
    rows = [(i, "nothing here, but 12345678 or so") for i in range(50)]
    rows += [(100 + i, f'prose token = "{key}" prose') for i, key in enumerate(_keys(random.Random(1), 3))]
    docs = frame(spark, rows)
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.detect(docs, pii.fit(docs)).collect()}
    assert {i for i, kinds in found.items() if kinds == ["secret"]} == {100, 101, 102}
    assert not any(found[i] for i in range(50))


def test_a_rare_kind_has_its_share_of_the_sample(spark):
    rng = random.Random(2)
    rows = [(i, f"plain {rng.randint(10**8, 10**9)}") for i in range(1500)]
    rows += [(2000 + i, f'prose token = "{key}" prose') for i, key in enumerate(_keys(rng, 60))]
    rows += [(3000 + i, f"version {key} of it") for i, key in enumerate(_keys(rng, 4))]
    model = pii.fit(frame(spark, rows), most=400)
    assert model.thresholds["secret"] <= 1


def test_a_planted_span_of_each_kind_beyond_the_base_spans(spark):
    planted = {
        "email": [("write to jo.doe (at) example.org now", "jo.doe (at) example.org"), ("or jo[at]mail.example.org", "jo[at]mail.example.org")],
        "card": [("pay with 3782 822463 10005 today", "3782 822463 10005"), ("pay 30569309025904 now", "30569309025904")],
        "phone": [("reach us under 555-123-4567 now", "555-123-4567"), ("phone: 020 7946 0958.", "020 7946 0958")],
        "secret": [("api_key = abcdefgh12345678 end", "abcdefgh12345678")],
    }
    rows, expected = [], {}
    for kind, cases in planted.items():
        for text, span in cases:
            assert not pii.base_spans(text)
            expected[len(rows)] = [(kind, text.index(span), text.index(span) + len(span))]
            rows.append((len(rows), text))
    plain = ["order 1234567 of 2024", "meet (at) home", "version 10.0.0.256", "no 3782822463100051 here", "recall 12345678"]
    for text in plain:
        expected[len(rows)] = []
        rows.append((len(rows), text))
    docs = frame(spark, rows)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.detect(docs, pii.fit(docs)).collect()}
    assert found == expected


def test_evidence_is_no_feature():
    text = "call 12345678 and"
    other = "said 12345678 and"
    assert pii.features(text, "phone", 5, 13) == pii.features(other, "phone", 5, 13)
    assert pii.weak_label(text, "phone", 5, 13, set()) == 1 and pii.weak_label(other, "phone", 5, 13, set()) == 0
