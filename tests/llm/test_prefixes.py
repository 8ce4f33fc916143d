import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from terrier.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, node string, chars string, level int, pos string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], SCHEMA).repartition(parts)


def order(turn):
    number, role, text = turn
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
    return number is not None, number or 0, role, digest


def conversations(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns, key=order)] for c, turns in held.items()}


def rebuilt(rows):
    own = conversations(rows)
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), [])
        found[c] = base[:h] + turns[h:]
    return found


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for path, ids in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(ids) - 1) * (len(path[-1][1]) if path else 0)
            leaves[path[:d]] += path not in children
    found = []
    for path, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(ids), len(path), parent, len(ids), children.get(path, 0), leaves[path], saved[path], digest))
    return sorted(found, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def dialogues(seed, n, start=0):
    rng = random.Random(seed)
    rows = []
    for c in range(start, start + n):
        length = rng.choice([1, 2, 3, 5, 9, 13])
        for turn in range(length):
            rows.append((c, turn, "user" if turn % 2 else "assistant", rng.choice("ab") * rng.randrange(1, 3)))
    return rows


@pytest.mark.parametrize("block", [1, 3, 4])
def test_brute_force(spark, block):
    rows = dialogues(block, 120)
    assert got(prefixes.conversation_trie(frame(spark, rows), block=block)) == brute(conversations(rows))


def test_rebuilt(spark):
    rows = dialogues(1, 90) + dialogues(2, 60, 130) + dialogues(3, 30, -150) + [(1000, 0, "user", "x"), (1001, 0, "user", "x")]
    expected = brute(rebuilt(rows))
    assert any(not t for t in rebuilt(rows).values())
    assert got(prefixes.rebuilt_trie(frame(spark, rows))) == expected


def test_copies_and_a_long_conversation(spark):
    text = "long " * 40_000
    rows = [(c, t, "user", f"t{t}") for c in range(400) for t in range(6)]
    rows += [(1000 + c, t, "user", f"t{t}" if t < 5 else f"own {c}") for c in range(50) for t in range(7)]
    rows += [(5000, t, None, text if t == 7 else "same") for t in range(300)]
    assert got(prefixes.conversation_trie(frame(spark, rows))) == brute(conversations(rows))


def test_awkward_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (1, 0, "user", "a"),
        (2, 0, None, None), (3, 0, "", ""), (None, 0, "user", "no id"), (-7, 3, "user", "été"), (4, 0, "u", "ser"),
        (5, 0, "us", "er"),
    ]
    expected = brute(conversations(rows))
    assert got(prefixes.conversation_trie(frame(spark, rows))) == expected
    assert got(prefixes.conversation_trie(frame(spark, rows, 1))) == expected


def test_empty(spark):
    assert prefixes.conversation_trie(frame(spark, [])).count() == 0
    assert prefixes.rebuilt_trie(frame(spark, [])).count() == 0
