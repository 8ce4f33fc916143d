"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over whole texts."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.llm.common import _BYTE, _power_tables, map_rows, mix, portions
from terrier.sources.scratch import settle

#: Words of a window.
WIDTH = 10
#: Item text that one broadcast set is built from, in bytes. Larger benchmarks are scanned for in several parts.
PART_BYTES = 8 << 20
#: Windows of one segment of a long item, and bytes whose words are hashed at once.
SEGMENT = 4096
STRETCH = 1 << 20

#: Upper-case letters become lower-case; whatever is no ASCII letter, no digit and not beyond ASCII, a blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _ranges_of(first: str) -> T.ArrayType:
    return T.ArrayType(T.StructType().add(first, "integer").add("until", "integer"))


LEAK = (
    T.StructType()
    .add("n_words", "long")
    .add("n_hit", "long")
    .add("runs", _ranges_of("first"))
    .add("spans", _ranges_of("start"))
    .add("item_ids", T.ArrayType(T.StringType()))
)


def word_places(folded: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word of folded bytes, hashed a stretch at a time."""
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(folded):
        stop = min(at + STRETCH, len(folded))
        if stop < len(folded):
            blank = folded.rfind(b" ", at, stop)
            stop = blank + 1 if blank >= 0 else folded.find(b" ", stop) + 1 or len(folded)
        part = np.frombuffer(folded, np.uint8, stop - at, at)
        edge = np.diff((part != 32).astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _power_tables(len(part) + 1)
        total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[part] * power[: len(part)], dtype=np.uint64)))
        hashes.append(mix((total[last] - total[first]) * inverse[first]))
        starts.append(first + at)
        ends.append(last + at)
        at = stop
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def window_hashes(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, (seed * 1_000_003 + width) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for j in range(width):
        total = total * _STEP + hashes[j : j + n]
    return mix(total)


@dataclass
class NgramSet:
    """A hash set of the windows of some items, with each window's words and the items that hold it."""

    text: bytes
    seed: int
    widths: list[int]
    keys: np.ndarray
    start: np.ndarray
    until: np.ndarray
    first: np.ndarray
    items: np.ndarray
    names: list[str]
    shift: int = 44
    present: np.ndarray | None = field(default=None, repr=False)

    @classmethod
    def of(cls, segments: list[tuple[str | None, bytes]], width: int) -> NgramSet:
        """``segments``: an item's id and words (one blank between), at most a window's if it has fewer."""
        names = sorted({n for n, _ in segments if n is not None})
        number = {n: i for i, n in enumerate(names)}
        text = b" ".join(t for _, t in segments)
        begin = np.cumsum([0, *(len(t) + 1 for _, t in segments)])[:-1]
        start, end, hashes = word_places(text)
        owner = np.searchsorted(begin, start, "right") - 1
        least = np.minimum(np.bincount(owner, minlength=len(segments)), width)
        item = np.array([number.get(n, -1) for n, _ in segments], np.int64)
        widths = sorted({int(w) for w in least if w})
        seed = 0
        while True:
            found = []
            for w in widths:
                keys = window_hashes(hashes, w, seed)
                at = np.flatnonzero((owner[: len(keys)] == owner[w - 1 :]) & (least[owner[: len(keys)]] == w))
                found.append((keys[at], start[at], end[at + w - 1], item[owner[at]]))
            keys, begins, ends, items = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (
                np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
            order = np.lexsort((items, keys))
            keys, begins, ends, items = keys[order], begins[order], ends[order], items[order]
            same = np.flatnonzero(keys[1:] == keys[:-1])
            if all(text[begins[i] : ends[i]] == text[begins[i + 1] : ends[i + 1]] for i in same.tolist()):
                break
            seed += 1  # two different windows of the items share a hash: hash anew
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        single = new.copy()
        single[1:] |= items[1:] != items[:-1]
        at = np.flatnonzero(new)
        first = np.append(np.searchsorted(np.flatnonzero(single), at), np.count_nonzero(single))
        shift = 64 - max(16, int(len(at)).bit_length() + 4)
        return cls(text, seed, widths, keys[at], begins[at], ends[at], first, items[single], names, shift)

    def sent(self) -> tuple:
        """Plain values, which can be broadcast to executors without this package."""
        return tuple(getattr(self, f.name) for f in fields(self) if f.init and f.name != "present")

    def hits(self, folded: bytes, start, end, hashes, owner) -> list[tuple[int, int, int]]:
        """(first word, width, window number) of every window that occurs, verified word for word."""
        if self.present is None:
            self.present = np.zeros(1 << (64 - self.shift), bool)
            self.present[self.keys >> np.uint64(self.shift)] = True
        found = []
        for w in self.widths:
            keys = window_hashes(hashes, w, self.seed)
            at = np.flatnonzero(self.present[keys >> np.uint64(self.shift)])
            at = at[owner[at] == owner[at + w - 1]]
            place = np.searchsorted(self.keys, keys[at])
            known = np.flatnonzero(self.keys[np.minimum(place, len(self.keys) - 1)] == keys[at])
            for i, k in zip(at[known].tolist(), place[known].tolist(), strict=True):
                here = b" ".join(folded[start[i] : end[i + w - 1]].split())
                if here == self.text[self.start[k] : self.until[k]]:
                    found.append((i, w, k))
        return found


def _segments(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """item, words: the items' words with one blank between, long items in overlapping segments."""

    def rows(batches):
        for batch in batches:
            names, parts = [], []
            for name, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = text.translate(FOLD).split()
                for at in range(0, max(1, len(words) - width + 1) if words else 0, SEGMENT):
                    names.append(name)
                    parts.append(b" ".join(words[at : at + SEGMENT + width - 1]))
            yield names, parts

    given = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return map_rows(given.filter("text is not null"), rows, "item string, words binary").distinct()


def _parts(items: DataFrame, id_col: str, text_col: str, width: int, most: int):
    """The n-gram sets of the items, one after the other, each of at most about ``most`` bytes of text."""
    segments = settle(_segments(items, id_col, text_col, width), "segments").withColumn(
        "deal", F.pmod(F.xxhash64("item", "words"), F.lit(1 << 30))
    )
    size = F.octet_length("words")
    total, rows = segments.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    count = max(1, min(rows, -(-total // most)))
    while 1 < count < 4 * rows:
        largest = segments.groupBy(F.col("deal") % count).agg(F.sum(size).alias("n"), F.max(size).alias("one"))
        n, one = largest.agg(F.max("n"), F.max("one")).first()
        if n <= 2 * most + one:
            break
        count *= 2
    for part in range(count):
        rows = segments.filter(F.col("deal") % count == part).select("item", "words").toArrow()
        yield NgramSet.of(list(zip(rows["item"].to_pylist(), rows["words"].to_pylist(), strict=True)), width)


def _ranges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(marked.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _scan(grams: NgramSet, texts: list[bytes | None], before: list[dict | None]) -> list[dict]:
    """The LEAK of each text; ``before`` holds what other parts found in it."""
    folded = b" ".join((t or b"").translate(FOLD) for t in texts)
    begin = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])[:-1]
    start, end, hashes = word_places(folded)
    owner = np.searchsorted(begin, start, "right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    base = np.concatenate(([0], np.cumsum(counts)))
    step = np.zeros(len(start) + 1, np.int64)
    items: dict[int, set] = {}
    for i, w, k in grams.hits(folded, start, end, hashes, owner) if len(grams.keys) else ():
        step[i] += 1
        step[i + w] -= 1
        items.setdefault(int(owner[i]), set()).add(k)
    marked = np.cumsum(step)[:-1] > 0
    found = []
    for d, old in enumerate(before):
        low, high = int(base[d]), int(base[d + 1])
        leak = {"n_words": high - low, "n_hit": 0, "runs": [], "spans": [], "item_ids": []}
        if old and old["n_hit"]:
            for run in old["runs"]:
                marked[low + run["first"] : low + run["until"]] = True
        if d in items or (old and old["n_hit"]):
            first, until = _ranges(marked[low:high])
            letters = np.cumsum((np.frombuffer(texts[d], np.uint8) & 0xC0) != 0x80)
            a, b = start[low + first] - begin[d], end[low + until - 1] - begin[d]
            names = {
                grams.names[i] for k in items.get(d, ()) for i in grams.items[grams.first[k] : grams.first[k + 1]] if i >= 0
            }
            leak["n_hit"] = int((until - first).sum())
            leak["runs"] = [{"first": int(x), "until": int(y)} for x, y in zip(first, until, strict=True)]
            leak["spans"] = [
                {"start": int(letters[x]) - 1, "until": int(letters[y - 1])} for x, y in zip(a, b, strict=True)
            ]
            leak["item_ids"] = sorted(names | set(old["item_ids"] if old else ()))
        found.append(leak)
    return found


def leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    leak: str = "leak",
    width: int = WIDTH,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``docs`` and a struct ``leak`` of what each whole text shares with the benchmark ``items``.

    ``n_words``; ``n_hit``, the words inside any occurrence of a window of an item; ``runs`` of such words
    (first, until; from 0); ``spans``, the same in code points of the text; ``item_ids`` as sorted strings.
    Texts are lower-cased (A-Z only) and cut into words of ASCII letters, digits and letters beyond ASCII.
    A window is ``width`` consecutive words of an item; an item of fewer, but not none, is one window.

    The windows are a hash set of bounded size that is broadcast; hits are compared word for word, so
    clashes of hashes do no harm. A benchmark of more than ``part_bytes`` is dealt into parts, each
    scanned for in a pass of its own over the whole texts; the result is the same.

    Null and empty texts have no words and no leak. Repeated rows stay, each with its leak; other columns
    pass through, and ``leak`` must not be among them. Items without words take no part; repeated items
    count once; the windows of an item without an id mark words, but no id stands for it.
    """
    if leak in docs.columns:
        raise ValueError(f"a column is named {leak} already")
    names, at = docs.columns, docs.columns.index(text_col)
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    schema = T.StructType([*plain, T.StructField(leak, LEAK)])
    found, number = docs, 0
    for grams in _parts(items, item_id, item_text, width, part_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(grams.sent())
        if number:
            found = settle(found, "leaks")

        def rows(batches, sent=sent):
            from pyspark.sql.pandas.types import to_arrow_type

            kind, grams = to_arrow_type(LEAK), NgramSet(*sent.value)
            for batch in batches:
                texts = batch.column(at).cast(pa.binary()).to_pylist()
                before = batch.column(len(names)).to_pylist() if batch.num_columns > len(names) else [None] * len(texts)
                marks = []
                for part in portions([t or b"" for t in texts], STRETCH * 4):
                    marks += _scan(grams, texts[part], before[part])
                columns = [batch.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(marks, kind)], names=[*names, leak])

        found, number = found.mapInArrow(rows, schema), number + 1
    return found


def _unused(docs: DataFrame) -> str:
    name = "_leak"
    while name in docs.columns:
        name += "_"
    return name


def drop_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", share: float = 0.0, **how) -> DataFrame:
    """``docs`` without those that have hit words, more than ``share`` of all. Rows without words stay."""
    mark = _unused(docs)
    found = leaks(docs, items, text_col, leak=mark, **how)
    return found.filter(~(F.col(f"{mark}.n_hit") > share * F.col(f"{mark}.n_words"))).drop(mark)


def remove_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the spans of hit words cut out of the text. Null texts stay null; all rows stay."""
    mark = _unused(docs)
    found = leaks(docs, items, text_col, leak=mark, **how)
    spans, text = F.col(f"{mark}.spans"), F.col(text_col)
    start = lambda i: F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["until"])
    until = lambda i: F.coalesce(F.get(spans, i)["start"], F.length(text))
    kept = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.substring(text, start(i) + 1, until(i) - start(i)))
    cut = F.when(F.size(spans) > 0, F.array_join(kept, "")).otherwise(text)
    return found.select(*(cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def digests(found: DataFrame, leak: str = "leak") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    of = lambda name: F.col(f"{leak}.{name}")
    return found.select(
        "doc_id",
        of("n_words").alias("n_words"),
        of("n_hit").alias("n_hit"),
        F.size(of("item_ids")).cast("long").alias("n_items"),
        F.sha2(F.array_join(of("item_ids"), ","), 256).alias("items_sha256"),
        (of("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
SQL = f"""with d as (select row_number() over () as r, doc_id, coalesce({_WORDS}, []) as w from documents),
i as (select item_id, {_WORDS} as w from benchmark where text is not null),
win as (select distinct item_id, least(len(w), 10) as k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') as t
  from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) as s from i where len(w) > 0)),
places as (select r, k, s, array_to_string(w[s:s + k - 1], ' ') as t from (
  select r, k, w, unnest(range(1, len(w) - k + 2)) as s from d, (select distinct k from win) where len(w) >= k)),
hits as (select r, p.k, s, item_id from places p join win on win.t = p.t and win.k = p.k),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + k)) as p from hits) group by 1),
found as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct r, item_id::varchar as id from hits where item_id is not null) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join found using (r)"""
