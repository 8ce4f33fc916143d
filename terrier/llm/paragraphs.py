"""Repeated passages: MinHash banding of paragraphs, runs of words that are shared word for word, removal."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.common import map_rows, mix, portions, shingles, words
from terrier.llm.jaccard import bitmap, connect
from terrier.sources.scratch import settle

#: Paragraphs (lines) of fewer words are left alone.
MIN_WORDS = 20
#: Members of a bucket that others are compared with, beside its smallest key, before the trees.
HUBS = 6
#: Words of a shared run at least, and words of the anchors that runs are found by.
RUN_WORDS = 50
ANCHOR_WORDS = 15


def tune(threshold: float = 0.75, miss: float = 1e-4, stray: float = 0.05, chance: float = 0.05) -> tuple[int, int]:
    """(bands, rows): the fewest bands that lose a pair at ``threshold`` with at most ``miss``.

    Among numbers of rows, those count at which unrelated pairs, of similarity ``stray``, collide with
    at most ``chance``.
    """
    found = []
    for rows in range(1, 9):
        bands = int(np.ceil(np.log(miss) / np.log(1 - threshold**rows)))
        if 1 - (1 - stray**rows) ** bands <= chance:
            found.append((bands, rows))
    return min(found)


def _paragraphs(docs: DataFrame, bands: int, rows_each: int, min_words: int, width: int) -> DataFrame:
    """doc_id, paragraph, start, end, key (of the normalised words), bands."""
    # Fingerprints are mixed already: an odd factor deals each seed another order of them.
    seeds = mix(np.arange(1, bands * rows_each + 1, dtype=np.uint64)) | np.uint64(1)
    factors = mix(np.arange(1001, 1001 + bands * rows_each, dtype=np.uint64)).reshape(bands, rows_each)

    def sketched(lines: list[bytes]) -> np.ndarray:
        # All lines at once: their shingles lie one after the other, and a minimum of each stretch is a line's.
        words = _Words(lines, 1)
        n = np.diff(np.append(words.first, len(words.owner)))
        every = _windows(words.prints[0], width) if len(words.owner) >= width else np.empty(0, np.uint64)
        inside = words.owner[: len(every)] == words.owner[width - 1 :]
        own, long = every[inside], n >= width
        starts = np.concatenate([[0], np.cumsum(n[long] - width + 1)[:-1]]).astype(int)
        out = np.empty((len(lines), bands), np.int32)
        with np.errstate(over="ignore"):
            least = np.empty((len(lines), bands * rows_each), np.uint64)
            for i in np.flatnonzero(~long).tolist():  # fewer words than a shingle has
                least[i] = (shingles(lines[i].split(), width)[:1] * seeds).min(axis=0)
            for i, seed in enumerate(seeds):
                if len(own):
                    least[long, i] = np.minimum.reduceat(own * seed, starts)
            for i in range(bands):
                both = least[:, i * rows_each : (i + 1) * rows_each] * factors[i]
                out[:, i] = mix(both.sum(axis=1, dtype=np.uint64)) >> np.uint64(33)
        return out

    def rows(batches):
        for columns in batches:
            texts, ids = columns["text"].to_pylist(), columns["doc_id"].to_pylist()
            for part in portions([t or "" for t in texts], PORTION):
                found = []
                known: dict[int, bytes] = {}
                for doc, text in zip(ids[part], texts[part], strict=True):
                    start = 0
                    for at, line in enumerate((text or "").split("\n")):
                        if len(line) >= 2 * min_words - 1 and len(parts := words(line)) >= min_words:
                            joined = b" ".join(parts)
                            key = int.from_bytes(blake2b(joined, digest_size=8).digest(), "little", signed=True)
                            known.setdefault(key, joined)
                            found.append((doc, at, start, start + len(line), key))
                        start += len(line) + 1
                if found:
                    place = {key: i for i, key in enumerate(known)}
                    bits = sketched(list(known.values()))
                    columns_out = list(map(list, zip(*found, strict=True)))
                    yield *columns_out, list(bits[[place[key] for key in columns_out[-1]]])

    schema = "doc_id long, paragraph int, start long, end long, key long, bands array<int>"
    return map_rows(docs, rows, schema)


def _texts(docs: DataFrame, wanted: DataFrame, min_words: int) -> DataFrame:
    """key, text of the wanted keys, each once."""

    def rows(batches):
        for columns in batches:
            keys, texts = [], []
            for text in columns["text"].to_pylist():
                for line in (text or "").split("\n"):
                    if len(line) >= 2 * min_words - 1 and len(parts := words(line)) >= min_words:
                        joined = b" ".join(parts)
                        keys.append(int.from_bytes(blake2b(joined, digest_size=8).digest(), "little", signed=True))
                        texts.append(joined.decode())
            yield keys, texts

    lines = map_rows(docs.select("text"), rows, "key long, text string")
    return lines.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))


def _features(texts: DataFrame, width: int) -> DataFrame:
    def rows(batches):
        for columns in batches:
            sets = [shingles(words(t), width) for t in columns["text"].to_pylist()]
            yield columns["doc_id"], [len(s) for s in sets], [bitmap(s) for s in sets]

    return map_rows(texts, rows, "doc_id long, n_shingles long, bitmap binary")


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    width: int = 5,
    percent: int = 75,
    miss: float = 1e-4,
) -> DataFrame:
    """One row per paragraph that repeats: doc_id, paragraph, start, end, first_doc, first_paragraph, copies, removed.

    A paragraph is a line of at least ``min_words`` words; ``start`` and ``end`` are code points. Paragraphs
    of equal words have one key. Keys that collide in a band are compared on whole paragraphs (five-word
    shingles, Jaccard of ``percent`` or more); components of the links, and equal keys, are clusters. The
    first occurrence of a cluster, by document and position, stays; the others are ``removed``.

    A bucket of any size is no one task's list: its members are compared with its smallest key, and what
    is then not connected is compared in blocks by signature trees. Null and empty texts have no
    paragraphs. Rows with a null id take no part; repeated rows repeat their paragraphs, and the
    occurrences at one place are all first or all removed. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    source = source.filter("doc_id is not null")
    bands, rows_each = tune(percent / 100, miss)
    found = settle(_paragraphs(source, bands, rows_each, min_words, width), "paragraphs")
    posts = found.select("key", F.posexplode("bands").alias("band", "value")).select(
        "key", F.shiftleft(F.col("band").cast("long"), 32).bitwiseOR(F.col("value").cast("long")).alias("bucket")
    )
    # Copies of one key combine before the shuffle; a bucket counts once it has two different keys.
    buckets = posts.groupBy("bucket").agg(F.min("key").alias("pivot"), F.max("key").alias("last")).filter("pivot <> last")
    stars = settle(
        posts.join(buckets.select("bucket", "pivot"), "bucket")
        .filter("key <> pivot")
        .select(F.col("key").alias("doc_id"), "pivot")
        .distinct(),
        "bucket_stars",
    )
    wanted = stars.select(F.col("doc_id").alias("key")).union(stars.select("pivot")).distinct()
    texts = settle(_texts(source, wanted, min_words), "passages").select(F.col("key").alias("doc_id"), "text")
    part = connect(stars, _features(texts, width), texts, width, percent, hubs=HUBS)
    labels = settle(part.select(F.col("node").alias("key"), "component"), "passage_clusters")
    placed = found.drop("bands").join(labels, "key", "left").withColumn("cluster", F.coalesce("component", "key"))
    place = F.struct("doc_id", "paragraph")
    clusters = placed.groupBy("cluster").agg(F.min(place).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    return placed.join(clusters, "cluster").select(
        "doc_id",
        "paragraph",
        "start",
        "end",
        F.col("first.doc_id").alias("first_doc"),
        F.col("first.paragraph").alias("first_paragraph"),
        "copies",
        (place != F.col("first")).alias("removed"),
    )


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Letters of the texts whose words are read at once (about).
PORTION = 1 << 18
#: Two tables of what a byte counts for; white space counts nothing.
_BYTES = [mix(np.arange(i * 1000 + 1, i * 1000 + 257, dtype=np.uint64)) * ~_SPACE for i in (1, 2)]
#: Bits of a window's place beside those of its fingerprint.
_PLACE = np.uint64(31)


class _Words:
    """The words of some texts (or lower-cased bytes), one after the other: fingerprints (``sides`` of them), and where they stand."""

    def __init__(self, texts: list, sides: int = 2):
        parts = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass").lower() for t in texts]
        self.raw = raw = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
        space = _SPACE[raw]
        self.starts = starts = np.flatnonzero(~space & np.append(True, space[:-1]))
        self.bytes = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])  # where texts begin
        self.owner = np.searchsorted(self.bytes, starts, side="right") - 1
        self.first = np.searchsorted(self.owner, np.arange(len(texts)))  # the first word of each text
        self.prints = []
        if not len(starts):
            self.prints = [np.empty(0, np.uint64)] * sides
            return
        # A word's bytes, weighted by numbers that go by their place in it, summed modulo 2^64.
        edges = np.concatenate([[0], starts])
        place = np.arange(len(raw)) - np.repeat(edges, np.diff(np.append(edges, len(raw))))
        for side in range(sides):
            weight = mix(np.arange(side << 40, (side << 40) + int(place.max()) + 1, dtype=np.uint64)) | np.uint64(1)
            with np.errstate(over="ignore"):
                self.prints.append(mix(np.add.reduceat(_BYTES[side][raw] * weight[place], starts)))

    def places(self) -> tuple[np.ndarray, ...]:
        """Start and end of each word in code points, and its line, within its text."""
        space = _SPACE[self.raw]
        ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
        point = np.cumsum((self.raw & 0xC0) != 0x80)  # of the code point that a byte belongs to, from 1
        line = np.cumsum(self.raw == 10)
        at = self.bytes[self.owner]
        return point[self.starts] - point[at], point[ends] - point[at], line[self.starts] - line[at] + (self.raw[at] == 10)


def _windows(prints: np.ndarray, width: int) -> np.ndarray:
    """A fingerprint of each ``width`` successive words, by doubling."""
    done, turn = 1, 1
    while done < width:
        step = min(done, width - done)
        a, b = (mix(np.array([2 * turn + i], np.uint64)) | np.uint64(1) for i in (0, 1))
        with np.errstate(over="ignore"):
            prints = mix(prints[: len(prints) - step] * a + prints[step:] * b)
        done, turn = done + step, turn + 1
    return prints


def _slide(x: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """The minimum (or maximum) of each ``width`` successive values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = least(x[: len(x) - step], x[step:])
        done += step
    return x


def _anchors(words: _Words, run: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the windows of ``run`` words, the anchor of each, and the fingerprints of these anchors.

    A window's anchor is the least of its windows of ``width`` words (the first of equal ones), with the words
    before it in the window's first half, or else behind it, that any window holds of which it is in that half.
    So equal windows have equal anchors. An anchor is twice its position, and one more in the first half;
    fingerprints are those of the distinct anchors, which ascend.
    """
    prints = words.prints[0]
    empty = np.empty(0, np.int64)
    if len(prints) < run:
        return empty, empty, np.empty(0, np.uint64)
    own = _windows(prints, width)
    near, half = run - width + 1, (run - width + 1) // 2
    place = np.arange(len(own), dtype=np.uint64)
    least = _slide(own >> _PLACE << _PLACE | place, near, np.minimum)
    at = np.flatnonzero(words.owner[: len(least)] == words.owner[run - 1 :])  # windows within one text
    spot = (least[at] & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
    early = spot - at < half
    code = 2 * spot + early
    distinct = code[np.append(True, code[1:] != code[:-1])] if len(code) else code
    before, behind = _windows(prints, width + half), _windows(prints, width + near - half)
    side, spot = (distinct & 1).astype(bool), distinct >> 1
    found = np.empty(len(distinct), np.uint64)
    found[side] = behind[spot[side]]
    found[~side] = ~before[spot[~side] - half]
    return at, code, found


def _pairs(lists: pa.Array) -> np.ndarray:
    """The members of each list, each with the number of its list before it."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(n)), n) << 32 | lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def shared_runs(
    docs: DataFrame,
    found: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = RUN_WORDS,
    width: int = ANCHOR_WORDS,
) -> DataFrame:
    """Runs of ``run`` or more words that stand elsewhere word for word, wherever lines break: columns as of ``repeated_passages``.

    Words are compared after lower-casing A-Z; white space of any kind counts alike. Every window of ``run``
    words has an anchor, its least window of ``width`` words with the words around; windows are counted where
    their anchor stands twice, which leaves out no window that repeats.
    Windows are equal if two independent 64-bit fingerprints are. The first of equal windows, by document
    and position, stays; one that overlaps its own first place (a loop) stays too. Successive windows that
    stay, or that are removed, are one row: ``paragraph`` is the line where it starts, ``first_doc`` and
    ``first_paragraph`` the first place of its first window, ``copies`` the most of any of its windows.

    With ``found`` (of ``repeated_passages``), what stands in its removed lines takes no part, so
    nothing is removed for the sake of a copy that is removed itself. Rows with a null id take no part;
    of repeated rows each run is listed once.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    source = source.filter("doc_id is not null and text is not null")

    def anchors(batches):
        for columns in batches:
            texts, ids = columns["text"].to_pylist(), columns["doc_id"].to_numpy()
            for part in portions(texts, PORTION):
                words = _Words(texts[part], 1)
                _, code, own = _anchors(words, run, width)
                if len(own):
                    code = code[np.append(True, code[1:] != code[:-1])]
                    owner = words.owner[code >> 1]
                    yield ids[part][owner], (code - 2 * words.first[owner]).astype(np.int32), own.astype(np.int64)

    placed = settle(map_rows(source, anchors, "doc_id long, at int, anchor long"), "anchors")
    twice = placed.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    marks = placed.join(twice, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_set("at").alias("marks"))
    if found is not None:
        gone = found.filter("removed").groupBy("doc_id").agg(F.collect_set("paragraph").alias("gone"))
        marks = marks.join(gone, "doc_id", "left")
    else:
        marks = marks.withColumn("gone", F.lit(None).cast("array<int>"))
    marked = source.join(settle(marks, "marks"), "doc_id")

    def windows(batches):
        for columns in batches:
            texts, ids = columns["text"].to_pylist(), columns["doc_id"].to_numpy()
            for part in portions(texts, PORTION):
                words = _Words(texts[part])
                at, code, _ = _anchors(words, run, width)
                owner = words.owner[at]
                # Windows whose anchor stands twice, without those that touch a removed line.
                good = np.isin(owner << 32 | code - 2 * words.first[owner], _pairs(columns["marks"][part]))
                start, end, line = words.places()
                lost = np.concatenate([[0], np.isin(words.owner << 32 | line, _pairs(columns["gone"][part])).cumsum()])
                at = at[good & (lost[at + run] == lost[at])]
                if not len(at):
                    continue
                owner = words.owner[at]
                named = np.zeros(len(texts[part]), np.int64)
                for i in np.unique(owner).tolist():
                    digest = blake2b(texts[part][i].encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    named[i] = int.from_bytes(digest, "little", signed=True)
                pair = [_windows(p, run)[at].astype(np.int64) for p in words.prints]
                spots = [x.astype(np.int32) for x in (at - words.first[owner], start[at], end[at + run - 1], line[at])]
                yield ids[part][owner], named[owner], *pair, *spots

    schema = "doc_id long, text_id long, low long, high long, pos int, start int, end int, line int"
    places = settle(map_rows(marked, windows, schema), "windows")
    groups = (
        places.groupBy("low", "high")
        .agg(F.min(F.struct("doc_id", "pos", "line")).alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    near = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("pos") - F.col("first.pos") < run)
    repeats = places.join(groups, ["low", "high"]).select(
        "doc_id", "text_id", "pos", "start", "end", "line",
        F.col("first.doc_id").alias("of_doc"), F.col("first.line").alias("of_line"),
        "copies", (~near).alias("removed"),
    )
    keys, others = ["doc_id", "text_id"], ["start", "end", "line", "of_doc", "of_line", "copies"]

    def merge(batches):
        # Successive windows of one text that are all kept, or all removed, are one row; the last may go on in the next batch.
        held = None
        for columns in batches:
            rows = [columns[f].to_numpy(zero_copy_only=False) for f in (*keys, "pos", "removed", *others)]
            if not len(rows[0]):
                continue
            if held:
                rows = [np.concatenate([[h], r]) for h, r in zip(held, rows, strict=True)]
            doc, text, pos, removed = rows[:4]
            new = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (pos[1:] > pos[:-1] + 1) | (removed[1:] != removed[:-1])
            first = np.flatnonzero(np.append(True, new))
            last = np.append(first[1:], len(doc)) - 1
            runs = [r[first] for r in rows]
            runs[2], runs[5] = pos[last], rows[5][last]
            runs[-1] = np.maximum.reduceat(rows[-1], first)
            held = [r[-1] for r in runs]
            doc, _, _, removed, *rest = (r[:-1] for r in runs)
            start, end, line, of_doc, of_line, copies = rest
            yield doc, line, start, end, of_doc, of_line, copies, removed.astype(bool)
        if held:
            doc, _, _, removed, start, end, line, of_doc, of_line, copies = ([h] for h in held)
            yield doc, line, start, end, of_doc, of_line, copies, [bool(removed[0])]

    dealt = repeats.repartition(*keys).sortWithinPartitions(*keys, "pos")
    schema = "doc_id long, paragraph int, start long, end long, first_doc long, first_paragraph int, copies long, removed boolean"
    return map_rows(dealt, merge, schema)


def repeated_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Repeated paragraphs, and the runs of words that repeat in what these leave."""
    found = settle(repeated_passages(docs, id_col, text_col), "repeated")
    return found.unionByName(shared_runs(docs, found, id_col, text_col))


def remove_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without what is ``removed``: lines that it covers whole, and its part of others. Other documents stay as they are."""
    spans = found.filter("removed").groupBy(F.col("doc_id").alias("_doc")).agg(
        F.array_sort(F.collect_set(F.array(F.col("start"), F.col("end")))).alias("_gone")
    )

    def cut(text: str, gone: list) -> str:
        kept, start = [], 0
        for line in text.split("\n"):
            end = start + len(line)
            parts, last, touched = [], start, False
            for a, b in gone:
                if a < end and b > start:
                    touched = True
                    parts.append(text[last : max(last, min(a, end))])
                    last = max(last, min(b, end))
            rest = "".join([*parts, text[last:end]])
            if not touched or rest.strip():
                kept.append(rest)
            start = end + 1
        return "\n".join(kept)

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, gone in batches:
            yield pd.Series([t if g is None or t is None else cut(t, g) for t, g in zip(texts, gone, strict=True)], dtype=object)

    joined = docs.join(spans, F.col(id_col) == F.col("_doc"), "left")
    cleared = F.pandas_udf(run, "string")(F.col(text_col), F.col("_gone"))
    return joined.withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(cleared)).drop("_doc", "_gone")
