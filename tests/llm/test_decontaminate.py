import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cases import LONG, awkward, empty, frame
from terrier.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    found = []
    for i, text in docs:
        w = words(text)
        hit, held = set(), set()
        for name, item in items:
            v = words(item)
            k = min(len(v), width)
            windows = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in windows:
                    hit.update(range(j, j + k))
                    held.add(name)
        ids = sorted(str(h) for h in held if h is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        found.append((i, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(found, key=str)


def got(df):
    return sorted((tuple(r) for r in decontaminate.digests(df).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").repartition(2)


ITEMS = [
    (1, "Two three, FOUR"),
    (2, None),
    (3, "..."),
    (4, LONG[:4000]),
    (4, LONG[:4000]),
    (None, "four five"),
    (5, "x" * 100_000),
    (6, "東京"),
    (77, "two three four"),
]


@pytest.mark.parametrize("part", [1 << 23, 60_000])
def test_awkward_rows(spark, part):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(decontaminate.leaks(docs, table(spark, ITEMS), part_bytes=part)) == brute(rows, ITEMS)


@pytest.mark.parametrize("part", [1 << 23, 250])
def test_random_texts(spark, part):
    rng = random.Random(5)
    text = lambda n: rng.choice(" \n-,.").join(rng.choice("abcdé") + rng.choice(" A \t") for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(150)]
    items = [(i, text(rng.randrange(9))) for i in range(30)]
    found = got(decontaminate.leaks(frame(spark, docs), table(spark, items), width=4, part_bytes=part))
    assert found == brute(docs, items, 4)
    assert any(f[5] for f in found) and not all(f[5] for f in found)


def test_segments_of_long_items_and_clashing_hashes(spark, monkeypatch):
    text = " ".join(str(i * i) for i in range(9000))
    docs = [(i, f"head {' '.join(str(j * j) for j in range(i, i + 12))} tail") for i in (0, 4090, 4095, 8985, 9001)]
    assert got(decontaminate.leaks(frame(spark, docs), table(spark, [(9, text)]))) == brute(docs, [(9, text)])
    plain = decontaminate.window_hashes
    weak = lambda h, w, seed: plain(h, w, seed) if seed else plain(h, w, seed) >> decontaminate.np.uint64(60)
    monkeypatch.setattr(decontaminate, "window_hashes", weak)
    grams = decontaminate.NgramSet.of([("9", text.encode())], 10)
    assert grams.seed == 1 and len(grams.keys) == 8991


def test_spans_are_cut_and_documents_dropped(spark):
    rows = [(1, "Ich sage: Äpfel, Birnen UND Nüsse! Danke."), (2, "nothing here"), (3, None), (1, "äpfel")]
    items = table(spark, [(1, "pfel birnen und"), (2, "äpfel birnen und nüsse")])
    docs = frame(spark, rows).withColumn("_leak", F.lit(1))
    cut = {(r.doc_id, r.text) for r in decontaminate.remove_spans(docs, items).collect()}
    # A-Z only are lower-cased, so the capital umlaut of the first text differs from the item's.
    assert cut == set(rows)
    items = table(spark, [(1, "birnen und"), (2, "nüsse")])
    cut = decontaminate.remove_spans(docs, items)
    assert {(r.doc_id, r.text) for r in cut.collect()} == {
        (1, "Ich sage: Äpfel, ! Danke."), (2, "nothing here"), (3, None), (1, "äpfel")
    }
    assert cut.columns == docs.columns
    assert sorted(r.doc_id for r in decontaminate.drop_documents(docs, items).collect()) == [1, 2, 3]
    assert decontaminate.drop_documents(docs, items, share=0.5).count() == 4


def test_empty_tables(spark):
    items = table(spark, ITEMS)
    assert decontaminate.leaks(empty(spark), items).count() == 0
    none = decontaminate.digests(decontaminate.leaks(awkward(spark), items.limit(0)))
    assert none.count() == 12 and none.filter("contaminated or n_hit > 0 or n_items > 0").isEmpty()


def test_a_taken_name_is_refused(spark):
    with pytest.raises(ValueError):
        decontaminate.leaks(awkward(spark), table(spark, ITEMS), leak="kind")
