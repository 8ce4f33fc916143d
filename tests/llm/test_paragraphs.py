import random

from cases import awkward, empty, frame
from terrier.llm import paragraphs
from test_jaccard import sets


def brute(rows, min_words=20):
    places = []
    for i, t in rows:
        start = 0
        for at, line in enumerate((t or "").split("\n")):
            if len(line.encode().split()) >= min_words:
                places.append((i, at, start, start + len(line), sets(line)))
            start += len(line) + 1
    root = list(range(len(places)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(places)):
        for y in range(x):
            a, b = places[x][4], places[y][4]
            both = len(a & b)
            if 100 * both >= 75 * (len(a) + len(b) - both):
                p, q = sorted((find(x), find(y)))
                root[q] = p
    groups = {}
    for x in range(len(places)):
        groups.setdefault(find(x), []).append(places[x])
    found = set()
    for own in groups.values():
        first = min(p[:2] for p in own)
        if len(own) > 1:
            found |= {(*p[:4], *first, len(own), p[:2] != first) for p in own}
    return found


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(5))
    passages = [[word() for _ in range(rng.randint(50, 90))] for _ in range(5)]
    rows = []
    for i in range(60):
        lines = [" ".join(word() for _ in range(rng.randint(3, 40))) for _ in range(3)]
        own = list(rng.choice(passages))
        if i % 2:
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = word()
            lines.insert(rng.randint(0, 3), "  ".join(own).upper() if i % 5 == 0 else " ".join(own))
        rows.append((i, "\n".join(lines)))
    return rows


def test_brute_force(spark):
    rows = corpus()
    found = paragraphs.repeated_passages(frame(spark, rows))
    assert {tuple(r) for r in found.collect()} == brute(rows)


def test_removal(spark):
    rows = corpus()
    docs = frame(spark, rows)
    found = paragraphs.repeated_passages(docs)
    gone = {(r.doc_id, r.paragraph) for r in found.filter("removed").collect()}
    text = {r.doc_id: r.text for r in paragraphs.remove_passages(docs, found).collect()}
    for i, t in rows:
        assert text[i] == "\n".join(line for at, line in enumerate(t.split("\n")) if (i, at) not in gone)


def test_awkward_and_empty(spark):
    found = paragraphs.repeated_passages(awkward(spark)).collect()
    assert {(r.doc_id, r.removed) for r in found} == {(6, False), (7, True)}
    assert paragraphs.repeated_passages(empty(spark)).count() == 0


def test_bands():
    bands, rows = paragraphs.tune(0.75, 1e-4)
    assert (1 - 0.75**rows) ** bands <= 1e-4
