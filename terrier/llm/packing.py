"""Packing documents into windows of tokens by multiway differencing."""

from __future__ import annotations

import heapq
import os
import re
import zlib
from bisect import insort
from itertools import count
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.common import LETTERS, PLAIN, WordIds, map_rows, portions, worker_memory
from terrier.sources.scratch import settle

#: Tokens of a window, of the pieces that the end of a document is cut into, and the documents' ends
#: that are packed together (about; it bounds a task's memory and the work of differencing).
WINDOW = 2048
GRAIN = 512
BATCH = 512
#: Batches that one task packs, one after the other.
DEAL = 8
#: Words whose ids a worker remembers at most before it starts afresh.
MEMORY = 400_000
#: The tokenizer's own words, for plain texts in lower case.
_WORD = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
#: Its special tokens, which it looks for before it cuts words.
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def _encoder(vocabulary: str):
    """A function from texts to token ids as little-endian unsigned 32-bit bytes.

    A plain text's ids are those of its words, one after the other, so each distinct word is encoded
    once; other texts are encoded whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as file:
        tokenizer = Tokenizer.from_str(file.read())
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def raw(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    final = np.zeros(tokenizer.get_vocab_size(), bool)
    final[[i for piece, i in tokenizer.get_vocab().items() if piece.endswith("</w>")]] = True

    def raw_words(words: list[str]) -> list[bytes]:
        # One call for some hundred words: the piece that ends a word says so. Where the ends are not as
        # many as the words, each is encoded by itself.
        out: list[bytes] = []
        lines = [words[i : i + 256] for i in range(0, len(words), 256)]
        for line, e in zip(lines, tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = (4 * (np.flatnonzero(final[ids]) + 1)).tolist()
            if len(ends) != len(line) or ends[-1] != 4 * len(ids):
                out += raw(line)
                continue
            whole = ids.tobytes()
            out += [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    known = WordIds(raw_words, MEMORY, memory=worker_memory(f"packing {vocabulary}"))

    def encode(texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for part in portions(texts):
            plain = [bool(PLAIN.fullmatch(t)) and not any(x in t for x in _SPECIAL) for t in texts[part]]
            # The tokenizer lower-cases; for plain texts that goes letter by letter, before or after.
            split = [_WORD.findall(t.lower()) if p else [] for t, p in zip(texts[part], plain, strict=True)]
            found = known.of(split)
            out += [f if p else raw([t])[0] for t, p, f in zip(texts[part], plain, found, strict=True)]
        return out

    return encode


def cut_pieces(tokens: int, window: int = WINDOW, grain: int = GRAIN) -> list[tuple[int, int]]:
    """(start, length): whole windows, then the rest in pieces of at most ``grain``."""
    whole = tokens // window * window
    steps = [(s, window) for s in range(0, whole, window)]
    return steps + [(s, min(grain, tokens - s)) for s in range(whole, tokens, grain)]


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp differencing into ``windows`` parts: positions of each part's items.

    Every item starts as a partial partition with one filled part. The two partitions with the widest
    spread merge, the fullest parts of one with the emptiest of the other, until one is left. Only
    filled parts are stored, fullest first. The first merges always gather the largest items, one to a
    part, so that partition is made at once.
    """
    if not sizes:
        return []
    # A part is (minus its size, its items), so that ascending order is fullest first.
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    head = [(-sizes[i], (i,)) for i in order[:windows]]
    heap = [(-_spread(head, windows), 0, head)]
    heap += [(-sizes[i], n, [(-sizes[i], (i,))]) for n, i in enumerate(order[windows:], 1)]
    heapq.heapify(heap)
    number = count(len(heap))
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        if len(b) == 1 and len(a) == windows:
            # One item joins the emptiest part, which then moves to its place.
            size, items = a.pop()
            insort(a, (size + b[0][0], (items, b[0][1])), key=_SIZE)
        else:
            over = max(0, len(a) + len(b) - windows)
            x, y = len(a) - over, len(b) - over
            pairs = zip(a[x:], reversed(b[y:]), strict=True)
            a = a[:x] + b[:y] + [(p[0] + q[0], (p[1], q[1])) for p, q in pairs]
            a.sort(key=_SIZE)
        heapq.heappush(heap, (-_spread(a, windows), next(number), a))
    return [_flat(items) for _, items in heap[0][2]]


_SIZE = itemgetter(0)


def _spread(parts: list, windows: int) -> int:
    return (parts[-1][0] if len(parts) == windows else 0) - parts[0][0]


def _flat(items: tuple) -> list[int]:
    found, stack = [], [items]
    while stack:
        x = stack.pop()
        if isinstance(x, int):
            found.append(x)
        else:
            stack.extend(reversed(x))
    return found


def balance(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """Near-equal windows: as few as the total needs, one more whenever the fullest exceeds ``capacity``."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        parts = difference(sizes, windows)
        if all(sum(sizes[i] for i in p) <= capacity for p in parts):
            return parts
        windows += 1


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 1,
    window: int = WINDOW,
    grain: int = GRAIN,
    batch: int = BATCH,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids: bool = True,
) -> DataFrame:
    """Cut documents into pieces and place each in a window.

    One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit; left out when
    ``ids`` is false), ids_crc32, doc_tokens, sequence_id, offset. A document is its text's ids and
    ``end_id``; null and empty texts are ``end_id`` alone. Whole windows stand for themselves; the rest
    of each document is packed by differencing with about ``batch`` others, dealt by a hash. Rows with null or repeated ids are packed as they come. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches):
        encode = _encoder(vocabulary)
        for columns in batches:
            texts = columns["text"].to_pylist()
            found = []
            for key, blob in zip(columns["doc_id"].to_pylist(), encode(texts), strict=True):
                blob += end
                tokens = len(blob) // 4
                for start, length in cut_pieces(tokens, window, grain):
                    piece = blob[4 * start : 4 * (start + length)]
                    found.append((key, start, length, piece if ids else None, zlib.crc32(piece), tokens))
            if found:
                yield tuple(map(list, zip(*found, strict=True)))

    schema = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long"
    pieces = settle(map_rows(source, rows, schema), "pieces")
    whole = pieces.filter(F.col("length") == window).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.filter(F.col("length") < window)
    last = F.col("start") + F.col("length") == F.col("doc_tokens")
    ends, rows_in = rest.agg(F.count_if(last), F.count("*")).first()
    chunk = max(1, round(batch * rows_in / max(1, ends)))
    dealt = rest.repartition(max(1, round(ends / (DEAL * batch))), "doc_id", F.floor(F.col("start") / window))
    placed = dealt.sortWithinPartitions("doc_id", "start").mapInArrow(_place(window, chunk), whole.schema)
    found = whole.union(placed)
    return found if ids else found.drop("ids")


def _place(window: int, chunk: int):
    """Pack each partition, in order, by ``chunk`` pieces; its end takes up to twice as many."""

    def run(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        held = None

        def placed(table):
            nonlocal made
            lengths = table["length"].to_pylist()
            order, sequence, offset = [], [], []
            for part in balance(lengths, window):
                at = 0
                for i in part:
                    order.append(i)
                    sequence.append((base + made) * 2)
                    offset.append(at)
                    at += lengths[i]
                made += 1
            table = table.take(pa.array(order)).append_column("sequence_id", pa.array(sequence, pa.int64()))
            return table.append_column("offset", pa.array(offset, pa.int64())).to_batches()

        for given in batches:
            table = pa.Table.from_batches([given])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= 2 * chunk:
                yield from placed(held.slice(0, chunk))
                held = held.slice(chunk)
        if held is not None and held.num_rows:
            yield from placed(held)

    return run
