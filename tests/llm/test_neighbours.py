import numpy as np
import pytest

from terrier.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, leaf string, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(4)


def brute(rows, queries, k=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    found = {}
    for q in queries:
        d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(axis=1))
        own = ids != q
        order = np.lexsort((ids[own], d[own]))[:k]
        found[q] = [(int(i), float(s)) for i, s in zip(ids[own][order], d[own][order], strict=True)]
    return found


def result(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return found


@pytest.mark.parametrize("block", [4096, 16])
def test_all_leaves_give_the_exact_answer(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 8)))]
    rows += [(600 + i, [1.0] * 8) for i in range(200)]  # one very common vector
    vectors = frame(spark, rows)
    queries = [0, 50, 100, 650]
    found = result(neighbours.nearest(vectors, vectors.filter(f"vec_id in {tuple(queries)}"), recall=1.1, block=block, leaf_sample=20))
    assert found == brute(rows, queries)


def test_recall(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((3000, 16)))]
    vectors = frame(spark, rows)
    found = result(neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"), leaf_sample=20))
    true = brute(rows, range(0, 3000, 20))
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in own}) for q, own in true.items())
    assert hits / (10 * len(true)) >= 0.9


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0])]
    rows += [(7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, []), (10, [1.0, 0.0])]
    vectors = frame(spark, rows)
    found = result(neighbours.nearest(vectors, vectors))
    assert found == {1: [(10, 0.0), (2, 2**0.5)], 2: [(1, 2**0.5), (10, 2**0.5)], 10: [(1, 0.0), (2, 2**0.5)]}


def test_empty(spark):
    vectors = frame(spark, [(3, None)])
    assert neighbours.nearest(vectors, vectors).count() == 0
    assert neighbours.nearest(vectors.limit(0), vectors).count() == 0
