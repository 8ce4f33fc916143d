"""All rows of a tree go down it at once: the same leaves as one row at a time."""

import random

import numpy as np

from terrier.operators.boosting import leaves_of


def test_leaves_of_odd_rows():
    rng = random.Random(4)
    inside = lambda codes, top: bytes(sum(1 << b for b in range(8) if 8 * a + b in codes) for a in range(top // 8 + 1))
    # 0: numeric; 1: a set of codes; 2: taken back (its children stay in the table); 3, 4: leaves; 5: another set
    feature, cut = [0, 1, -1, -1, 1, -1, -1, -1, -1], [3, 0, 2, 0, 0, 0, 0, 0, 0]
    sets = {1: {0, 3, 9}, 4: {1, 17}}
    chosen = [inside(sets[n], max(sets[n])) if n in sets else None for n in range(9)]
    left, right = [1, 3, 5, 0, 7, 0, 0, 0, 0], [2, 4, 6, 0, 8, 0, 0, 0, 0]
    rows = [(rng.randrange(-1, 8), rng.choice([-1, 0, 1, 3, 9, 15, 16, 17, 18, 1000])) for _ in range(500)]

    def walk(row):
        node = 0
        while feature[node] >= 0:
            value = row[feature[node]]
            goes = value in sets[node] if node in sets else 0 <= value <= cut[node]
            node = left[node] if goes else right[node]
        return node

    bins = [np.array([r[0] for r in rows], np.int8), np.array([r[1] for r in rows], np.int32)]
    tree = feature, cut, chosen, left, right, [0.0] * 9
    assert leaves_of(tree, bins, len(rows)).tolist() == [walk(r) for r in rows]
    assert leaves_of(tree, np.stack(bins), len(rows)).tolist() == [walk(r) for r in rows]
    assert leaves_of(tree, [b[:0] for b in bins], 0).tolist() == []
