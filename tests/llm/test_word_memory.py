"""What workers remember: looked up without going through all of it, and given up for the next operator."""

from terrier.llm import common, quality


class _Key(str):
    hashed = 0

    def __hash__(self):
        _Key.hashed += 1
        return super().__hash__()


def test_new_words_are_found_without_going_through_the_known_ones():
    memory = {_Key(f"known{i}"): b"0" for i in range(50)} | {"a": b"1"}
    ids = common.WordIds(lambda words: [w.encode() for w in words], 100, memory=memory)
    _Key.hashed = 0
    assert ids.of([["a", "b", "a"], [], ["c"]]) == [b"1b1", b"", b"c"]
    assert ids.of([["b"]]) == [b"b"]
    assert _Key.hashed == 0


def test_a_worker_remembers_for_one_operator():
    packing = common.worker_memory("packing x")
    packing["a"] = b"1"
    assert common.worker_memory("packing x") is packing
    quality.Reader()
    assert common.worker_memory("packing x") == {}
