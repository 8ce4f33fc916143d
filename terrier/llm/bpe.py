"""Byte-level BPE through a table of distinct words, and decoding through a table of pieces."""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.llm.common import LETTERS, PLAIN, WordIds, map_rows, portions
from terrier.sources.scratch import settle

#: The tokenizer's own words, for plain texts: a blank before a word belongs to it.
WORD = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
#: Its special token, which it looks for before it cuts words.
SPECIAL = "<|endoftext|>"
#: Words of the table at most: the most frequent ones, which every task gets. The bound on the
#: broadcast is this number of words of up to WORD_BYTES; other words are encoded where they stand.
TABLE_WORDS = 200_000
WORD_BYTES = 64
#: Other words that a task remembers at most before it starts afresh.
MEMORY = 120_000


def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as file:
        tokenizer = Tokenizer.from_str(file.read())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _ids(tokenizer, texts: list[str]) -> list[bytes]:
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n: every distinct word of all plain texts and how often it stands there. Null texts have none."""

    def rows(batches):
        seen: Counter[str] = Counter()
        for columns in batches:
            for text in columns["text"].to_pylist():
                if text and plain(text):
                    seen.update(WORD.findall(text))
                if len(seen) > MEMORY:
                    yield list(seen), list(seen.values())
                    seen = Counter()
        if seen:
            yield list(seen), list(seen.values())

    found = map_rows(docs.select(F.col(text_col).alias("text")), rows, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def plain(text: str) -> bool:
    """Whether the text is one that ``WORD`` cuts; others are encoded whole."""
    return bool(PLAIN.fullmatch(text)) and SPECIAL not in text


def word_table(counts: DataFrame, vocabulary: str, most: int = TABLE_WORDS) -> DataFrame:
    """word, ids: each of the most frequent words, encoded once. At most ``most`` rows.

    Words are taken by whole frequencies, down to the last that fits; at equal counts none or all go in.
    """
    short = settle(counts.filter(F.octet_length("word") <= WORD_BYTES), "words")
    steps = short.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    least, total = None, 0
    for n, here in steps.toLocalIterator():
        total += here
        if total > most:
            break
        least = n

    def rows(batches):
        tokenizer = _tokenizer(vocabulary)
        for columns in batches:
            found = columns["word"].to_pylist()
            yield found, _ids(tokenizer, found)

    wanted = short.filter(F.lit(False) if least is None else F.col("n") >= least)
    return map_rows(wanted.select("word"), rows, "word string, ids binary")


def piece_table(spark: SparkSession, vocabulary: str) -> DataFrame:
    """id, piece: the bytes that each id of the vocabulary stands for. As many rows as the vocabulary."""
    with open(vocabulary, encoding="utf-8") as file:
        data = json.load(file)
    special = {t["id"]: t["content"].encode() for t in data["added_tokens"]}
    letter = _byte_letters()
    pieces = {i: bytes(letter[c] for c in w) for w, i in data["model"]["vocab"].items() if i not in special}
    return spark.createDataFrame(sorted((pieces | special).items()), "id int, piece binary")


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", most: int = TABLE_WORDS, decoded: bool = False
) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit): every text as the tokenizer encodes it.

    The ids of the words in the table are joined back by position inside the task that reads the text,
    so no text moves. Words outside the table are encoded once a task. Null text counts as empty and
    has no ids; rows with null or repeated ids are encoded as they come. Other columns are ignored.

    With ``decoded``, the column text is what ``decode`` makes of the ids, in the same pass: a task then has one
    Python worker, where one after the other takes two.
    """
    spark = docs.sparkSession
    table = word_table(word_counts(docs, text_col), vocabulary, most).toArrow()
    known = spark.sparkContext.broadcast((table["word"].to_pylist(), table["ids"].to_pylist()))
    pieces = _sent_pieces(spark, vocabulary) if decoded else None

    def rows(batches):
        piece = dict(zip(*pieces.value, strict=True)).__getitem__ if decoded else None
        tokenizer = _tokenizer(vocabulary)
        known_ids = WordIds(lambda texts: _ids(tokenizer, texts), MEMORY, dict(zip(*known.value, strict=True)))
        for columns in batches:
            keys, texts = columns["doc_id"].to_pylist(), columns["text"].to_pylist()
            for part in portions(texts):
                cut = [WORD.findall(t) if plain(t) else [] for t in texts[part]]
                found = known_ids.of(cut)
                # Empty though there is a text: it isn't plain.
                blobs = [f if c or not t else _ids(tokenizer, [t])[0] for t, c, f in zip(texts[part], cut, found, strict=True)]
                yield (keys[part], blobs, [_joined(b, piece) for b in blobs]) if decoded else (keys[part], blobs)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return map_rows(source, rows, "doc_id long, ids binary" + ", text string" * decoded)


def _sent_pieces(spark: SparkSession, vocabulary: str) -> Broadcast:
    table = piece_table(spark, vocabulary).toArrow()
    return spark.sparkContext.broadcast((table["id"].to_pylist(), table["piece"].to_pylist()))


def _joined(ids: bytes | None, piece: Callable[[int], bytes]) -> str:
    return b"".join(map(piece, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` and the column text: each id is looked up in the piece table, whose size is that of
    the vocabulary, and the pieces are joined. Bytes that are no UTF-8 become U+FFFD."""
    known = _sent_pieces(encoded.sparkSession, vocabulary)

    def run(batches):
        pieces = dict(zip(*known.value, strict=True)).__getitem__
        small = (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512))
        for given in small:
            texts = [_joined(blob, pieces) for blob in given.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*given.columns, pa.array(texts, pa.string())], names=[*given.schema.names, "text"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())]))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of a decoded table."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
