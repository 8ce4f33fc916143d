import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import awkward, empty, frame
from terrier.llm import bpe, packing

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n=300):
    rng = random.Random(5)
    pool = "aB zé'ßst \n\t\r\x0b\x85\xa0\x1c\x00.,;!?_-+=|<>½²9 0東İΣσς́ǅﬁ😀​ "
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    plain = "abcXYZ éÜñ'd's're  \n\n .,!¿«»0123ſÿª"
    return texts + ["".join(rng.choice(plain) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pairs(spark):
    docs = awkward(spark).filter("doc_id <> 5 and doc_id is not null")
    return docs.union(frame(spark, list(enumerate(odd_texts(), 100))))


@pytest.mark.parametrize("most", [200_000, 3])
def test_bpe_is_the_library(spark, most):
    docs = pairs(spark)
    tokenizer = library(BYTES)
    found = {r.doc_id: r for r in bpe.digests(bpe.decode(bpe.encode(docs, BYTES, most=most), BYTES)).collect()}
    for row in docs.collect():
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids
        own = found[row.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert own.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_packing_holds_each_id_once(spark):
    docs = pairs(spark)
    tokenizer = library(WORDS)
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, WORDS, batch=64).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for row in docs.collect():
        ids = np.array([*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[row.doc_id], key=lambda r: r.start):
            own = ids[at : at + r.length].tobytes()
            assert (r.start, r.doc_tokens, bytes(r.ids), r.ids_crc32) == (at, len(ids), own, zlib.crc32(own))
            at += r.length
        assert at == len(ids)
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW


def test_packing_of_odd_rows(spark):
    assert packing.pack(empty(spark), WORDS).count() == 0
    lone = frame(spark, [(None, None), (4, ""), (4, "")])
    assert sorted(r.length for r in packing.pack(lone, WORDS, ids=False).collect()) == [1, 1, 1]


def test_bpe_of_odd_rows(spark):
    assert bpe.encode(empty(spark), BYTES).count() == 0
    assert [r.n_tokens for r in bpe.digests(bpe.decode(bpe.encode(frame(spark, [(None, None)]), BYTES), BYTES)).collect()] == [0]


def test_differencing():
    known = [8, 7, 6, 5, 4]  # differencing is known to end at 14 and 16 here
    assert sorted(sum(known[i] for i in p) for p in packing.difference(known, 2)) == [14, 16]
    rng = random.Random(1)
    sizes = [rng.randint(1, 512) for _ in range(900)]
    parts = packing.balance(sizes)
    assert sorted(i for p in parts for i in p) == list(range(len(sizes)))
    totals = [sum(sizes[i] for i in p) for p in parts]
    assert max(totals) <= 2048 and max(totals) - min(totals) <= 64
    assert len(parts) <= -(-sum(sizes) // 2048) + 1


def test_the_window_count_rises():
    # Three of 1500 fit no two windows, though their total does.
    assert len(packing.balance([1500, 1500, 1000])) == 3
    assert packing.balance([]) == []
