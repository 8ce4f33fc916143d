import random

import pytest

from cases import awkward, empty, frame
from terrier.llm import jaccard
from terrier.llm.common import components


def sets(text, width=5):
    parts = (text or "").encode().lower().split()
    if not parts:
        return frozenset()
    return frozenset(tuple(parts[i : i + width]) for i in range(max(1, len(parts) - width + 1)))


def brute(rows):
    own = {i: sets(t) for i, t in rows}
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(own)
    for a in ids:
        for b in ids:
            if a < b and own[a] and own[b]:
                both = len(own[a] & own[b])
                if 100 * both >= 75 * (len(own[a]) + len(own[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(own[i]), find(i)) for i in ids}


def corpus(seed=3):
    """Families of near copies, a passage that many texts share, short texts and exact copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    common = [word() for _ in range(60)]
    texts = []
    for size in (2, 3, 30):
        base = [word() for _ in range(rng.randint(80, 200))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 7)):
                own[rng.randrange(len(own))] = word()
            texts.append(own)
    for _ in range(40):
        texts.append([word() for _ in range(20)] + common + [word() for _ in range(rng.randint(0, 30))])
    texts += [[word() for _ in range(rng.randint(1, 8))] for _ in range(10)] + texts[:3] + [texts[0][:-1], []]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("hot", "block"), [(64, 1024), (3, 8)])
def test_brute_force(spark, hot, block):
    rows = corpus()
    found = jaccard.jaccard_components(frame(spark, rows), hot=hot, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_awkward(spark):
    docs = awkward(spark)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    assert {k: v for k, v in found.items() if k is not None} == brute(rows)
    assert found[None][1] is None
    assert jaccard.jaccard_components(docs).count() == docs.count()


def test_empty(spark):
    assert jaccard.jaccard_components(empty(spark)).count() == 0


def test_keep_one(spark):
    rows = corpus()
    expected = {i for i, (_, c) in brute(rows).items() if i == c}
    assert {r.doc_id for r in jaccard.keep_one(frame(spark, rows)).collect()} == expected


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert set(found.values()) == {0, 100} and found[40] == 0 and found[159] == 100


def test_keep_one_tells_rows_from_ids(spark):
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(1, a), (5, a + " more"), (5, "nothing like it, all by itself here"), (None, a), (7, "x"), (7, "x"), (8, None)]
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(frame(spark, rows)).collect()), key=str)
    assert kept == sorted([(1, a), (5, rows[2][1]), (None, a), (7, "x"), (8, None)], key=str)
