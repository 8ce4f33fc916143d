"""Boosted trees against a plain loop, sets of nominal codes, the stop inside the loop, saving."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrier.operators import boosting
from terrier.operators.boosting import BoostedTrees, fit_trees


def plain_booster(rows, numeric, nominal, edges, rounds, depth, rate, l2, gamma, least):
    """The same trees by loops over rows: predictions for ``rows`` [(features, target)]."""
    base = sum(y for _, y in rows) / len(rows)
    score = [base] * len(rows)

    def bin_of(f, v):
        return v if f >= numeric else sum(e < v for e in edges[f])

    def gain_of(g, h):
        return g * g / (h + l2)

    def grow(here, level, gradient):
        g, h = sum(gradient[i] for i in here), len(here)
        best = None
        for f in range(numeric + nominal):
            groups = {}
            for i in here:
                s = groups.setdefault(bin_of(f, rows[i][0][f]), [0.0, 0])
                s[0] += gradient[i]
                s[1] += 1
            order = sorted(groups, key=lambda b: (groups[b][0] / groups[b][1], b) if f >= numeric else b)
            left_g = left_h = 0
            for k, b in enumerate(order):
                left_g, left_h = left_g + groups[b][0], left_h + groups[b][1]
                if left_h < least or h - left_h < least:
                    continue
                gain = gain_of(left_g, left_h) + gain_of(g - left_g, h - left_h) - gain_of(g, h)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, set(order[: k + 1]))
        if level == depth or best is None or best[0] <= 1e-9:
            return -g / (h + l2)
        gain, f, left = best
        sides = [[i for i in here if (bin_of(f, rows[i][0][f]) in left) == side] for side in (True, False)]
        below = [grow(side, level + 1, gradient) for side in sides]
        if gain < gamma and not any(isinstance(b, tuple) for b in below):
            return -g / (h + l2)
        return f, left, *below

    def value(tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if bin_of(tree[0], x[tree[0]]) in tree[1] else tree[3]
        return tree

    for _ in range(rounds):
        tree = grow(list(range(len(rows))), 0, [s - y for s, (_, y) in zip(score, rows)])
        score = [s + rate * value(tree, x) for s, (x, _) in zip(score, rows)]
    return score


def table(spark, n=400, cities=30, seed=3):
    rng = random.Random(seed)
    good = {c for c in range(cities) if rng.random() < 0.5}
    rows = []
    for i in range(n):
        a, b, c = rng.random(), float(rng.randrange(4)), rng.randrange(cities)
        rows.append((i, a, b, c, math.sin(5 * a) + 0.3 * b + (2.0 if c in good else 0.0) + rng.gauss(0, 0.1)))
    return rows, spark.createDataFrame(rows, "k long, a double, b double, city long, y double").repartition(3)


def test_agrees_with_a_plain_loop(spark):
    rows, df = table(spark)
    how = dict(rounds=4, depth=3, rate=0.3, l2=1.0, gamma=0.5, least=3.0)
    model = fit_trees(df, "y", ["a", "b"], ["city"], row_share=1.0, column_share=1.0, bins=16, prediction="p", **how)
    edges = [model.edges["a"], model.edges["b"]]
    want = plain_booster([(r[1:4], r[4]) for r in rows], 2, 1, edges, **how)
    got = {r.k: r.p for r in model.transform(df).collect()}
    assert model.rounds == 4 and any(t.chosen[0] for t in model.trees)
    assert [got[i] for i in range(len(rows))] == pytest.approx(want, abs=1e-9)


def test_a_scattered_set_of_cities_is_found_in_one_split(spark):
    n, cities = 6000, 300
    good = F.expr("abs(hash(id % 300)) % 3 = 0")
    df = spark.range(n).select((F.col("id") % cities).alias("city"), F.rand(5).alias("a"), F.when(good, 1.0).otherwise(0.0).alias("y"))
    df = spark.createDataFrame(df.toPandas())
    how = dict(rounds=1, depth=1, rate=1.0, l2=0.0, gamma=0.0, row_share=1.0, column_share=1.0, prediction="p")
    error = lambda m: m.transform(df).agg(F.avg((F.col("p") - F.col("y")) ** 2)).first()[0]
    assert error(fit_trees(df, "y", ["a"], ["city"], **how)) < 1e-20
    assert error(fit_trees(df, "y", ["a", "city"], [], **how)) > 0.1


def test_fitting_ends_inside_the_loop_and_keeps_the_best(spark, monkeypatch):
    rows, df = table(spark, 600)
    fit, held = df.filter("k % 3 > 0"), df.filter("k % 3 = 0").withColumn("y", F.rand(1))
    calls = []
    plain = boosting._level
    monkeypatch.setattr(boosting, "_level", lambda *a: calls.append(1) or plain(*a))
    model = fit_trees(fit, "y", ["a", "b"], ["city"], held, patience=2, rounds=50, depth=2, rate=0.5, prediction="p")
    assert model.rounds <= 6 and len(calls) <= 2 * (model.rounds + 2) + 1
    assert len(model.losses) == model.rounds and min(model.losses) == model.losses[-1]
    curve = [r.loss for r in model.curve(held, "y").collect()]
    assert curve == pytest.approx(model.losses)


def test_scores_survive_rewriting_saving_and_odd_values(spark, tmp_path):
    rows, df = table(spark, 300)
    held = df.filter("k % 5 = 0")
    model = fit_trees(df, "y", ["a", "b"], ["city"], held, patience=30, rounds=2 * boosting.REFRESH + 3, depth=2, prediction="p")
    assert model.rounds > boosting.REFRESH
    assert [r.loss for r in model.curve(held, "y").collect()] == pytest.approx(model.losses)
    model.save(spark, str(tmp_path / "m"))
    again = BoostedTrees.load(spark, str(tmp_path / "m"))
    odd = spark.createDataFrame([(None, 1.0, 5), (float("nan"), None, None), (0.5, 1.0, 10**6)], "a double, b double, city long")
    for rows in (df, odd):
        got, want = (sorted(r.p for r in m.transform(rows).collect()) for m in (again, model))
        assert got == want and all(math.isfinite(x) for x in got)


def test_sampling_is_a_property_of_the_row():
    import numpy as np

    ids = np.arange(100_000)
    taken = boosting.sampled(ids, 3, 42, 0.8)
    assert abs(taken.mean() - 0.8) < 0.01
    assert (boosting.sampled(ids[::-1], 3, 42, 0.8) == taken[::-1]).all()
    assert (boosting.sampled(ids, 4, 42, 0.8) != taken).any()
    assert boosting.sampled(ids, 3, 42, 1.0).all()
