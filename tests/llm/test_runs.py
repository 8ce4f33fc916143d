"""Runs of 50 words that other places share word for word, against counting every window."""

import random
from collections import defaultdict

import pytest

from cases import awkward, empty, frame
from terrier.llm import paragraphs


def brute(rows):
    """Words (doc, position) of windows of 50 words that stand twice, and those of later ones."""
    places = defaultdict(list)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        for p in range(len(w) - 49):
            places[tuple(w[p : p + 50])].append((i, p))
    every, later = set(), set()
    for own in places.values():
        if len(own) > 1:
            first = min(own)
            for i, p in own:
                every |= {(i, p + j) for j in range(50)}
                if (i, p) != first and not (i == first[0] and p - first[1] < 50):
                    later |= {(i, p + j) for j in range(50)}
    return every, later


def covered(rows, found):
    text, out = dict(rows), set()
    for r in found:
        before = len(text[r.doc_id][: r.start].split())
        out |= {(r.doc_id, before + j) for j in range(len(text[r.doc_id][r.start : r.end].split()))}
        assert text[r.doc_id][: r.start].count("\n") == r.paragraph
    return out


def corpus():
    rng = random.Random(16)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(5))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 81, 120)]
    rows = []
    for i in range(40):
        own = passages[i % 5]
        if i % 2:
            wrap = rng.randint(6, 15)
            own = [w + ("\n" if j % wrap == 0 else "") for j, w in enumerate(own)]
        around = [[word() for _ in range(rng.randint(0, 90))] for _ in range(2)]
        rows.append((i, " ".join(around[0] + own + around[1])))
    return [*rows, (40, "buy now " * 90)]


def test_every_shared_window_is_found(spark):
    rows = corpus()
    found = paragraphs.shared_runs(frame(spark, rows)).collect()
    every, later = brute(rows)
    assert covered(rows, [r for r in found if r.removed]) == later and later
    assert covered(rows, found) == every


@pytest.mark.parametrize("wrap", [8, 1000])
def test_wrapped_and_embedded_passages(spark, wrap):
    rng = random.Random(wrap)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    passage = [word() for _ in range(81)]
    long = " ".join([word() for _ in range(77)] + passage)
    other = "\n".join(" ".join(passage[i : i + wrap]) for i in range(0, 81, wrap))
    docs = frame(spark, [(1, " ".join(word() for _ in range(40)) + "\n" + long), (2, "Title\n" + other + "\nrest")])
    found = paragraphs.repeated_text(docs)
    assert [(r.doc_id, r.first_doc, r.copies) for r in found.filter("removed").collect()] == [(2, 1, 2)]
    text = {r.doc_id: r.text for r in paragraphs.remove_passages(docs, found).collect()}
    assert text[2] == "Title\nrest" and text[1].endswith(long)


def test_awkward_and_empty(spark):
    assert paragraphs.repeated_text(awkward(spark)).filter("removed and doc_id not in (6, 7)").count() == 0
    assert paragraphs.repeated_text(empty(spark)).count() == 0
