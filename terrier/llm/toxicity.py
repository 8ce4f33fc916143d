"""Toxicity by subword-bag embeddings averaged into a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.llm.common import bounded_sample, map_rows

#: Rows of the embedding table, its width, and the lengths of the character n-grams (of bytes).
BUCKETS = 1 << 16
WIDTH = 8
GRAMS = (3, 4, 5, 6)
#: Words averaged together. A text's score is that of its most toxic stretch, so that a few words in a
#: long text count as much as in a short one; every stretch of the whole text is scored.
STRETCH = 2
#: Labelled rows that the model is fitted on at most.
FIT_ROWS = 4_000
#: Words whose value a task remembers at most.
MEMORY = 400_000
#: N-grams of fewer texts than this learn nothing; the factor that keeps an average over many visible.
RARE = 12
SCALE = 10.0
_EDGE = b".,;:!?\"'()[]{}|&#$%*"


@dataclass
class Toxicity:
    """``value``: what each n-gram adds to the difference of the two logits; ``bias``: its constant."""

    value: np.ndarray
    bias: float


def tokens(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split() if text else []


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, number of the word it is in) of ``<word>`` without outer punctuation."""
    marked = [b"<" + (w.strip(_EDGE) or w[:8]) + b">" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    letters = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked), dtype=np.int32), lengths)
    ends = np.repeat(np.cumsum(lengths).astype(np.int32), lengths)
    at = np.arange(len(letters), dtype=np.int32)
    buckets, owners = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            inside = at[at + n <= ends]
            code = np.full(len(inside), np.uint64(n))
            for k in range(n):
                code = (code ^ letters[inside + k]) * np.uint64(0x100000001B3)
                code ^= code >> np.uint64(29)
            buckets.append((code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int32) % BUCKETS)
            owners.append(owner[inside])
    return np.concatenate(buckets), np.concatenate(owners)


def stretches(n: int) -> np.ndarray:
    """Where stretches of about STRETCH words start in a text of ``n`` words."""
    return np.linspace(0, n, max(1, round(n / STRETCH)), endpoint=False).astype(np.int64)


def train(texts: list[str], labels: np.ndarray, epochs: int = 80, rate: float = 0.05, decay: float = 0.05, seed: int = 7) -> Toxicity:
    """Embeddings and softmax together, by Adam on all rows at once.

    First every stretch carries its text's label; later only the most toxic one of each text does.
    N-grams of fewer than ``RARE`` texts are left at zero, so that no text is learnt by heart. With labels of one
    kind or none, the score is constant.
    """
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.0
        share = min(max(share, 0.01), 0.99)
        return Toxicity(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    split = [tokens(t) or [b"."] for t in texts]
    index: dict[bytes, int] = {}
    words = np.concatenate([[index.setdefault(w, len(index)) for w in s] for s in split])
    lengths = np.array([len(s) for s in split])
    begins = np.cumsum(lengths) - lengths
    starts = [stretches(n) for n in lengths]
    counts = np.array([len(s) for s in starts])
    first = np.concatenate([s + b for s, b in zip(starts, begins, strict=True)])
    size = np.diff(np.append(first, len(words)))
    doc, doc_first = np.repeat(np.arange(len(split)), counts), np.cumsum(counts) - counts
    stretch = np.repeat(np.arange(len(first)), size)
    bucket, owner = grams(list(index))
    per_word = np.maximum(np.bincount(owner, minlength=len(index)), 1)
    # How many texts each n-gram is in: from the distinct words of each text.
    texts_of = np.zeros(BUCKETS, np.int64)
    by_word = np.argsort(owner, kind="stable")
    bucket, owner = bucket[by_word], owner[by_word]
    offset = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(index)))))
    for start, n in zip(begins, lengths, strict=True):
        own = np.unique(words[start : start + n])
        texts_of[np.unique(np.concatenate([bucket[offset[w] : offset[w + 1]] for w in own]))] += 1
    used = np.flatnonzero(texts_of >= min(RARE, 1 + len(split) // 100))
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    live = place[bucket] >= 0
    column, owner = place[bucket[live]], owner[live]
    rng = np.random.default_rng(seed)
    table, soft, bias = rng.standard_normal((len(used), WIDTH)) * 0.1, rng.standard_normal((2, WIDTH)), np.zeros(2)
    y = labels.astype(float)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, soft, bias)]
    for epoch in range(1, epochs + 1):
        # The two logits differ by a sum over n-grams, so one number for each n-gram carries all there is.
        toward = soft[1] - soft[0]
        of_word = np.bincount(owner, (table @ toward)[column], len(index)) / per_word
        margin = SCALE * np.add.reduceat(of_word[words], first) / size + bias[1] - bias[0]
        error = np.zeros(len(first))
        if epoch <= epochs // 4:
            error = (1 / (1 + np.exp(-margin)) - y[doc]) / counts[doc]
        else:
            top = np.maximum.reduceat(margin, doc_first)
            hit = np.flatnonzero(margin == top[doc])
            _, one = np.unique(doc[hit], return_index=True)
            error[hit[one]] = 1 / (1 + np.exp(-margin[hit[one]])) - y
        error /= len(split)
        pull = np.bincount(words, (SCALE * error / size)[stretch], len(index)) / per_word
        pull = np.bincount(column, pull[owner], len(used))
        mean = pull @ table
        shift = np.array([-error.sum(), error.sum()])
        grads = (np.outer(pull, toward), np.stack([-mean, mean]), shift)
        for p, g, s in zip((table, soft, bias), grads, state, strict=True):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            p -= rate * (s[0] / (1 - 0.9**epoch)) / (np.sqrt(s[1] / (1 - 0.99**epoch)) + 1e-5)
        table *= 1 - decay
    value = np.zeros(BUCKETS)
    value[used] = SCALE * (table @ (soft[1] - soft[0]))
    return Toxicity(value, float(bias[1] - bias[0]))


def scorer(model: Toxicity):
    """A function from texts to scores that remembers the value of each word."""
    known: dict[bytes, float] = {}

    def score(texts: list[str | None]) -> np.ndarray:
        split = [tokens(t) for t in texts]
        new = list(set().union(*split) - known.keys())
        if len(known) + len(new) > MEMORY:
            known.clear()
            new = list(set().union(*split))
        for start in range(0, len(new), 50_000):
            part = new[start : start + 50_000]
            bucket, owner = grams(part)
            n = np.bincount(owner, minlength=len(part))
            values = np.bincount(owner, model.value[bucket], len(part)) / np.maximum(n, 1)
            known.update(zip(part, values.tolist(), strict=True))
        out = np.full(len(texts), model.bias)
        for i, found in enumerate(split):
            if found:
                values = np.fromiter(map(known.__getitem__, found), float, len(found))
                starts = stretches(len(found))
                sizes = np.diff(np.append(starts, len(found)))
                out[i] = model.bias + (np.add.reduceat(values, starts) / sizes).max()
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))

    return score


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no label is learnt from: crc32 of the id as text is divisible by 5. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = FIT_ROWS) -> Toxicity:
    """Train on at most ``most`` labelled rows that aren't held out, chosen by a hash of the id.

    Rows without a label or id are left out; of several labels of an id the highest counts. The training
    runs in one task on these rows alone: the bound is on rows, and their texts are taken whole.
    """
    marks = (
        labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("k"))
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = bounded_sample(marks, "k", most)
    source = docs.select(F.col(id_col).alias("k"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = source.join(F.broadcast(chosen), "k").repartition(1).sortWithinPartitions("k", "text")

    def run(batches):
        texts, marked = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            marked += batch.column("toxic").to_pylist()
        model = train(texts, np.array(marked, float))
        value = np.append(model.value, model.bias)
        yield pa.RecordBatch.from_arrays([pa.array([value.tobytes()], pa.binary())], names=["model"])

    found = rows.mapInArrow(run, "model binary").collect()
    if not found:
        return train([], np.empty(0))
    value = np.frombuffer(found[0][0])
    return Toxicity(value[:-1].copy(), float(value[-1]))


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Null, empty and blank texts have the score of the constant term. Rows with null or repeated ids are
    scored as they come. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.value, model.bias))

    def rows(batches):
        rate = scorer(Toxicity(*sent.value))
        for columns in batches:
            yield columns["doc_id"], columns["held_out"], rate(columns["text"].to_pylist())

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    scored = map_rows(source, rows, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
