import random
import re
from collections import Counter, defaultdict

import pytest

from cases import awkward, empty
from terrier.llm import collocations
from terrier.llm.collocations import Counting, HatTrie

SCHEMA = "lang string, text string, phrase string, f long, k int, score double"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", 1, 2, 0.5) for r in rows], SCHEMA).repartition(parts)


def brute(rows, least, top, longest=5, covered=100):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i : i + m])] += 1
    found = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        hidden = {}
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    hidden[p[i : i + m]] = max(hidden.get(p[i : i + m], 0), a)
        scored = []
        for p, a in cand.items():
            if 100 * hidden.get(p, -1) >= covered * a:
                continue
            cuts = [(1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(found)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["of", "The", "é", "big", "DOG", "x\x00y", "東京", "-", "'s", "a\x1cb"]
    weights = [9, 8, 3, 5, 5, 1, 2, 2, 2, 1]
    for _ in range(n):
        words = rng.choices(vocabulary, weights, k=rng.randrange(40))
        yield "".join(w + rng.choice(["  ", " ", "\t", ". ", ",", "\n", " ; "] if rng.random() < 0.3 else [" "]) for w in words)


@pytest.mark.parametrize("how", [{}, {"held": 40, "most": 8, "burst": 3}])
def test_brute_force(spark, how):
    rng = random.Random(1)
    rows = [(rng.choice(["en", "fr", None, ""]), t) for t in texts(2, 300)]
    rows += [("en", "very common pair"), ("en", None), (None, "")] * 30
    expected = brute(rows, 10, 40)
    assert len(expected) > 80
    assert got(collocations.collocations(frame(spark, rows), least=10, top=40, **how)) == expected


def test_covered_phrases_and_longest(spark):
    rows = [("en", t) for t in texts(3, 120)]
    for covered, longest in ((60, 4), (100, 2)):
        expected = brute(rows, 5, 2000, longest, covered)
        assert got(collocations.collocations(frame(spark, rows), least=5, longest=longest, covered=covered)) == expected


def test_trie_bursts_and_spills_whole_subtrees():
    rng = random.Random(4)
    trie, counts = HatTrie(burst=4), Counter()
    for _ in range(3000):
        key = b"".join(rng.randrange(1, 7).to_bytes(4, "big") for _ in range(rng.randrange(2, 6)))
        counts[key] += 2
        trie.add(key, 2)
    assert any(type(child) is dict for child in trie.root.values())
    assert trie.size == len(counts)
    for subtree in trie.largest(trie.size // 2):
        taken = dict(trie.take(subtree))
        assert taken == {k: v for k, v in counts.items() if k[:4] == subtree}
        counts = Counter({k: v for k, v in counts.items() if k[:4] != subtree})
    assert trie.size == len(counts) and trie.size <= 3000


def test_a_task_holds_a_bounded_number_of_entries():
    every = b"\xff" * (collocations.FILTER_BITS // 8)
    counting = Counting(range(3, 6), every, every, held=200, burst=8)
    rows, rng = Counter(), random.Random(6)

    def taken(spilled):
        for _, prefixes, phrases, counts in spilled:
            assert len(set(prefixes.to_pylist())) == len(prefixes)
            for run, numbers in zip(phrases.to_pylist(), counts.to_pylist(), strict=True):
                assert sorted(run.split(b"\n")) == run.split(b"\n")
                rows.update(dict(zip(run.split(b"\n"), numbers, strict=True)))

    for _ in range(50):
        counting.add("en", [" ".join(str(rng.randrange(12)) for _ in range(30)).encode()])
        if counting.full():
            taken(counting.spill())
            assert sum(t.size for t in counting.tries.values()) <= 200
    taken(counting.spill(everything=True))
    assert sum(rows.values()) == 50 * (28 + 27 + 26)


def test_large_numbers_are_exact(spark):
    rows = [("en", "new york " * 3 + "old " * 7)] * 50
    expected = brute(rows, 100, 10)
    assert got(collocations.collocations(frame(spark, rows), top=10)) == expected


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark).withColumnRenamed("kind", "lang")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(collocations.collocations(docs)) == brute(rows, 100, 2000)
    assert collocations.collocations(empty(spark).withColumnRenamed("kind", "lang")).count() == 0
