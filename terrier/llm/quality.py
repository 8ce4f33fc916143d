"""Quality from weak labels: labellers, their accuracies by expectation-maximisation, a hashed linear scorer."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.common import bounded_sample, portions, worker_memory

#: Buckets of the hashed features, documents that the scorer is fitted on at most, words that a task
#: remembers at most.
BUCKETS = 1 << 13
FIT_DOCS = 10_000
MEMORY = 600_000
#: Frequent words of the languages expected (fixed values). A text abstains where a tenth of its words or
#: more hold letters that none of these languages has; other languages without such letters are not told apart.
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are with as his they be at this have from or by not "
    "le la les de des du et un une en que qui dans pour pas sur au avec est "
    "der die das und ist von zu den mit ein eine nicht im auf dem für sich "
    "el los las y del una por con no para se su al lo como".split()
)
_SHAPES = {i: ("A" if chr(i).isupper() else "a" if chr(i).isalpha() else "9" if chr(i).isdigit() else chr(i)) for i in range(0x250)}
_OTHER = re.compile("[^\x00-\u024f]")
_RUN = re.compile(r"(.)\1+", re.S)
_FOREIGN = re.compile("[^\\W\\d_a-zA-ZªºÀÁÂÄÆÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜŒßàáâäæçèéêëìíîïñòóôöùúûüÿœŸſ]")
_SYMBOL = re.compile(r"[#&$%*|~^<>{}=\\_@]")

LABELLERS = ["symbols", "shouting", "exclaiming", "repeating", "distinct", "sentences", "function words", "word length"]


def _outline(word: str) -> str:
    """Letters as a and A, digits as 9, other characters as they are."""
    if not word.isascii():
        word = _OTHER.sub(lambda m: "a" if m.group().isalpha() else "?", word)
    return word.translate(_SHAPES)


def shape(word: str) -> str:
    """The outline with runs of one character made single."""
    return _RUN.sub(r"\1", _outline(word))


def _outline_row(outline: str) -> tuple:
    big = outline.count("A")
    bare = outline.strip(".,;:!?\"'()")
    return (
        big + outline.count("a"),
        big,
        len(_SYMBOL.findall(outline)),
        outline.count("!"),
        len(bare),
        outline[-1] in ".!?",
        zlib.crc32(_RUN.sub(r"\1", outline).encode("utf-8", "replace")) % BUCKETS,
    )


class Reader:
    """Counts of texts from the outlines of their words, which are remembered."""

    def __init__(self):
        worker_memory("quality")  # what other operators left in the worker goes
        self.forget()

    def forget(self):
        # A word's code is four times its outline's number, two more with a foreign letter, and one more for a function word.
        self.codes: dict[str, int] = {}
        self.outlines: dict[str, int] = {}
        self.table = np.empty((0, 7))

    def read(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: its statistics (n words, then shares), buckets and their weights."""
        for part in portions([t or "" for t in texts]):
            split = [(t or "").split() for t in texts[part]]
            new = set().union(*split).difference(self.codes)
            if len(self.codes) + len(new) > MEMORY:
                self.forget()
                new = set().union(*split)
            rows = []
            for word in new:
                outline = _outline(word)
                number = self.outlines.get(outline)
                if number is None:
                    number = self.outlines[outline] = len(self.outlines)
                    rows.append(_outline_row(outline))
                stop = len(word) <= 8 and word.strip(".,;:!?\"'()").lower() in STOP_WORDS
                foreign = not word.isascii() and bool(_FOREIGN.search(word))
                self.codes[word] = 4 * number + 2 * foreign + stop
            if rows:
                self.table = np.concatenate([self.table, np.array(rows, float)])
            for words in split:
                yield self._one(words)

    def _one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(words)
        if not n:
            return np.zeros(10), np.array([0]), np.array([1.0])
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, n)
        # Equal words have equal hashes within a process, which is all that is asked of them here.
        at = np.fromiter(map(hash, words), np.int64, n)
        kinds, counts = np.unique(codes >> 2, return_counts=True)
        rows = self.table[kinds]
        letters, upper, symbols, bangs, length, ends = counts @ rows[:, :6]
        same = float((at[1:] == at[:-1]).mean()) if n > 1 else 0.0
        # Windows of 64 words, the last one ending with the text and weighted by its words that no other holds.
        cut = at[: n // 64 * 64].reshape(-1, 64) if n >= 64 else at[None, :]
        rest = n % 64 if n > 64 else 0
        window = np.sort(np.concatenate([cut, at[None, -64:]]) if rest else cut, axis=1)
        each = (1 + (window[:, 1:] != window[:, :-1]).sum(axis=1)) / window.shape[1]
        distinct = float(np.average(each, weights=[64] * len(cut) + [rest])) if rest else float(each.mean())
        stops, foreign = float((codes & 1).mean()), float((codes >> 1 & 1).mean())
        stats = np.array([n, symbols / n, upper / max(letters, 1.0), bangs / n, same, distinct, ends / n, stops, length / n, foreign])
        # Each statistic but the share of foreign words also enters as a bucket of its own, in steps.
        steps = [_step(i, int(10 * min(v, 3.0))) for i, v in enumerate(stats[1:9].tolist())]
        buckets = np.concatenate([rows[:, 6].astype(np.int64), steps])
        return stats, buckets, np.concatenate([counts / n, np.full(len(steps), 0.25)])


def _step(statistic: int, value: int) -> int:
    return zlib.crc32(f"{statistic}:{value}".encode()) % BUCKETS


def vote(stats: np.ndarray) -> str:
    """One letter per labeller: g (good), b (bad), or a dot where it abstains. A text without words is bad to all."""
    n, symbols, upper, bangs, same, distinct, ends, stops, length, foreign = stats
    if not n:
        return "b" * len(LABELLERS)

    def judge(bad: bool, good: bool) -> str:
        return "b" if bad else "g" if good else "."

    return "".join(
        [
            judge(symbols > 0.3, symbols < 0.05),
            judge(upper > 0.5 and n >= 4, upper < 0.2),
            judge(bangs > 0.3, bangs < 0.05),
            judge(same > 0.2, same < 0.05 and n >= 10),
            judge(distinct < 0.35 and n >= 30, distinct > 0.5 and n >= 10),
            judge(ends < 0.01 and n >= 60, 0.02 < ends < 0.5),
            judge(stops < 0.02 and n >= 30 and foreign < 0.1, stops > 0.08),
            judge(length > 15 or length < 1.5, 2.5 < length < 10),
        ]
    )


def estimate(patterns: list[str], counts: np.ndarray, steps: int = 50) -> tuple[np.ndarray, dict[str, float]]:
    """Expectation-maximisation over vote patterns.

    Where a labeller votes, it says good or bad with probabilities that depend on the class alone; they
    are estimated together with the classes' shares, starting from the faults found. Returns the
    labellers' accuracies where they vote, and each pattern's posterior of good.
    """
    if not patterns:
        return np.full(len(LABELLERS), np.nan), {}
    votes = np.array([["bg.".index(v) for v in p] for p in patterns])
    good, bad = (votes == 1).sum(axis=1), (votes == 0).sum(axis=1)
    # A labeller that calls a text bad has seen a fault; two that do outweigh the rest.
    belief = np.where(bad >= 2, 0.05, np.where(bad == 1, np.where(good >= 5, 0.6, 0.4), 0.95))
    weight = counts.astype(float)
    says = np.eye(3)[votes][:, :, :2]  # nothing said is no evidence
    for _ in range(steps):
        share = np.clip((weight * belief).sum() / weight.sum(), 0.01, 0.99)
        odds = np.log(share / (1 - share)) * np.ones(len(patterns))
        tables = []
        for w in (weight * (1 - belief), weight * belief):
            table = np.einsum("p,plv->lv", w, says) + 0.5
            tables.append(table / table.sum(axis=1, keepdims=True))
        change = np.log(tables[1]) - np.log(tables[0])
        odds += np.einsum("plv,lv->p", says, change)
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    accuracy = share * tables[1][:, 1] + (1 - share) * tables[0][:, 0]
    return accuracy, dict(zip(patterns, belief.tolist(), strict=True))


@dataclass
class Quality:
    """Posterior of each vote pattern, accuracies of the labellers, and the linear scorer."""

    posterior: dict
    accuracy: list
    weights: np.ndarray
    bias: float


def _train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 200, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on hashed features against posteriors, by Adam on all rows at once."""
    if not rows:
        return np.zeros(BUCKETS), 0.0
    owner = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    bucket, value = (np.concatenate(c) for c in zip(*rows, strict=True))
    w, bias = np.zeros(BUCKETS + 1), 0.0
    first, second = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for t in range(1, epochs + 1):
        margin = np.bincount(owner, w[bucket] * value, len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-margin)) - target) / len(rows)
        grad = np.append(np.bincount(bucket, error[owner] * value, BUCKETS), error.sum()) + 1e-6 * w
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    bias = float(w[-1])
    return w[:-1], bias


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = FIT_DOCS) -> Quality:
    """Estimate the labellers on all documents and train the scorer on at most ``most`` of them.

    The vote patterns of all texts are counted (there are at most three to the power of the labellers);
    the documents for the scorer are chosen by a hash of the id. Of an empty table, the model calls every
    text undecided.
    """
    votes = F.pandas_udf(_votes, "string")
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text"))
    counted = texts.select(votes("text").alias("votes")).groupBy("votes").count().orderBy("votes").collect()
    accuracy, posterior = estimate([r[0] for r in counted], np.array([r[1] for r in counted]))
    read = F.pandas_udf(_features, "votes string, buckets array<int>, weights array<double>")
    sample = bounded_sample(texts, "k", most).select(read("text").alias("r")).select("r.*").toPandas()
    sample = sample.iloc[np.lexsort((sample["weights"].map(np.sum), sample["buckets"].map(np.sum), sample["votes"]))] if len(sample) else sample
    rows = [(np.array(b, int), np.array(w, float)) for b, w in zip(sample["buckets"], sample["weights"], strict=True)]
    weights, bias = _train(rows, np.array([posterior[v] for v in sample["votes"]]))
    return Quality(posterior, accuracy.tolist(), weights, bias)


def _votes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    reader = Reader()
    for texts in batches:
        yield pd.Series([vote(stats) for stats, _, _ in reader.read(texts.tolist())], dtype=object)


def _features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    reader = Reader()
    for texts in batches:
        rows = [(vote(s), b.tolist(), w.tolist()) for s, b, w in reader.read(texts.tolist())]
        yield pd.DataFrame(rows, columns=["votes", "buckets", "weights"])


def judge(docs: DataFrame, model: Quality, text_col: str = "text") -> DataFrame:
    """``docs`` and the column quality: votes, posterior of good by the labellers, and the scorer's score.

    Null, empty and blank texts are read as a text without words, which every labeller calls bad. A vote
    pattern that was not there when the model was fitted has a null posterior.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.posterior, model.weights, model.bias))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        posterior, weights, bias = sent.value
        reader = Reader()
        for texts in batches:
            rows = []
            for stats, buckets, values in reader.read(texts.tolist()):
                votes = vote(stats)
                margin = float(weights[buckets] @ values) + bias if stats[0] else -30.0
                rows.append((votes, posterior.get(votes), 1 / (1 + np.exp(-np.clip(margin, -30, 30)))))
            yield pd.DataFrame(rows, columns=["votes", "posterior", "score"])

    read = F.pandas_udf(run, "votes string, posterior double, score double")
    return docs.withColumn("quality", read(F.col(text_col)))


def classify(docs: DataFrame, model: Quality, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, votes, posterior, score, keep (a score of 0.5 or more). Repeated rows are all judged."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return judge(source, model).select("doc_id", "quality.*", (F.col("quality.score") >= 0.5).alias("keep"))


def keep_good(docs: DataFrame, model: Quality, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the scorer rejects (a score under 0.5)."""
    marked = docs.withColumnRenamed("quality", "_own_quality") if "quality" in docs.columns else docs
    kept = judge(marked, model, text_col).filter(F.col("quality.score") >= 0.5).drop("quality")
    return kept.withColumnRenamed("_own_quality", "quality") if "_own_quality" in kept.columns else kept
