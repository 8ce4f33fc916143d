"""Personal data: rules propose, boosted trees on format and context select, thresholds are calibrated.

The trees are grown from the examples of all documents. These are binned and counted once; each level of a tree
is a job that sums gradients by leaf, feature and bin, and the driver sees these sums alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.common import bounded_sample, map_rows, worker_memory
from terrier.sources.scratch import settle

KINDS = ["email", "ip", "card", "phone", "secret"]
#: Bins of a feature at most, and steps of the probability by which thresholds are found.
BINS = 16
STEPS = 4096
#: Whole numbers that gradients are summed as, so that the order of the sums changes no tree.
UNIT = 1 << 26
#: Log odds that evidence for or against a span adds to what the trees say.
EVIDENCE = 4.0
#: The trees' margin for a kind counts n / (n + SHRINK) with n candidates of its smaller class in the fit.
SHRINK = 20
#: Threshold of a kind that can't be calibrated.
UNCALIBRATED = 0.9

_ANY = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUP = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the local part is the run before it, back to the last match."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        else:
            # What stands before a failing @ can be no local part of a later one.
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))


def _octets(text: str) -> bool:
    return all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in _GROUP.findall(text))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each run of dotted numbers is read four numbers at a time, which is what leftmost matches do."""
    for chain in _CHAIN.finditer(text):
        if chain.group().count(".") < 3:
            continue
        groups = [g.span() for g in _GROUP.finditer(text, *chain.span())]
        for i in range(0, len(groups) - 3, 4):
            start, end = groups[i][0], groups[i + 3][1]
            if _octets(text[start:end]):
                yield start, end


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start. Failing matches are dropped without retries."""
    if not text or not _ANY.search(text):
        return []
    found = [("email", *s) for s in _emails(text)]
    found += [("ip", *s) for s in _addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


# ---- candidates ------------------------------------------------------------------------------------

_NUMBER = re.compile(r"\+?[0-9][0-9 ().\-]{5,}[0-9]")
_MAILISH = re.compile(r"[^\s@<>\"',;]{1,64} ?(?:@|\(at\)|\[at\]) ?[^\s@<>\"',;]{3,255}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?![A-Za-z0-9+/_-])")
_ASSIGNED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[ ]*[=:][ ]*[\"']?$")
_CONTEXT = {
    "email": re.compile(r"(?i)mail|contact|write|@"),
    "ip": re.compile(r"(?i)\bip\b|host|server|addr|port"),
    "card": re.compile(r"(?i)card|visa|pay|credit|account|iban"),
    "phone": re.compile(r"(?i)call|phone|tel|fax|mobile|sms"),
    "secret": re.compile(r"(?i)key|token|secret|passw|auth"),
}


# Evidence beyond the base spans; none of it is a feature.
_HIDDEN = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_GROUPED = re.compile(r"(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}")
_TOLD = re.compile(r"(?i)\b(?:call|phone|telephone|tel|fax|mobile|sms)(?: (?:me|us|at|on|to|is|number|no)\b)*[.:]{0,2} ?$")


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping proposals of every kind, wider than the rules."""
    if not text or not (_ANY.search(text) or "(at)" in text or "[at]" in text):
        return []
    found = []
    if "@" in text or "[at]" in text or "(at)" in text:
        found += [("email", *m.span()) for m in _MAILISH.finditer(text)]
    for m in _NUMBER.finditer(text):
        digits = len(_digits(m.group()))
        if 7 <= digits <= 15:
            opened = m.start() > 0 and text[m.start() - 1] == "(" and m.group().count(")") > m.group().count("(")
            found.append(("phone", m.start() - opened, m.end()))
        if 13 <= digits <= 19:
            found.append(("card", *m.span()))
        if m.group().count(".") == 3 and digits <= 12:
            found.append(("ip", *m.span()))
    for m in _TOKEN.finditer(text):
        if any(c.isdigit() for c in m.group()) and any(c.isalpha() for c in m.group()):
            found.append(("secret", *m.span()))
    return found


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span. The checks that give weak labels (Luhn, octets, grouping, telling words) aren't among them."""
    span = text[start:end]
    n = len(span)
    digits = sum("0" <= c <= "9" for c in span)
    letters = sum(c.isalpha() for c in span)
    upper = sum(c.isupper() for c in span)
    hexes = sum(c in "0123456789abcdefABCDEF" for c in span)
    _, counts = np.unique(list(span), return_counts=True)
    share = counts / counts.sum()
    groups = _GROUP.findall(span)
    before, after = text[max(0, start - 24) : start], text[end : end + 24]
    tail = span.rsplit("@", 1)[-1] if "@" in span else ""
    return [
        float(KINDS.index(kind)),
        min(n, 200),
        digits / n,
        letters / n,
        upper / n,
        hexes / n,
        float(-(share * np.log2(share)).sum()),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        sum(c in " -.()" for c in span),
        float(span[0] == "+"),
        float("@" in span),
        tail.count("."),
        sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:], strict=False)) / n,
        float(before[-1:] in ('"', "'")),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(kind not in ("phone", "secret") and bool(_CONTEXT[kind].search(before))),
        float(bool(_CONTEXT[kind].search(after))),
    ]


N_FEATURES = 20


def weak_label(text: str, kind: str, start: int, end: int, base: set) -> int:
    """1 where evidence agrees: a base span, or what the kind shows beyond those.

    An address with (at) or [at]; 13 to 19 digits that pass Luhn and touch no letter or digit; a phone number
    in groups or after a telling word; a secret that is assigned to a telling name.
    """
    if (kind, start, end) in base:
        return 1
    span, before = text[start:end], text[max(0, start - 32) : start]
    alone = not before[-1:].isalnum() and not text[end : end + 1].isalnum()
    if kind == "email":
        return int(bool(_HIDDEN.fullmatch(span.rstrip(".!?:)]"))))
    if kind == "card":
        return int(alone and 13 <= len(d := _digits(span)) <= 19 and luhn(d))
    if kind == "phone":
        if not alone or not 7 <= len(_digits(span)) <= 15 or any(True for _ in _addresses(span)):
            return 0
        return int(bool(_GROUPED.fullmatch(span) or _TOLD.search(before)))
    return int(kind == "secret" and bool(_ASSIGNED.search(before)))


_DATED = re.compile(r"(?:19|20)[0-9]{2}([-. ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-. ])[0-9]{1,2}\2(?:19|20)[0-9]{2}")
_VERSION = re.compile(r"(?i)\b(?:v|ver|version|release|section)[ .:]*$")
_REVISION = re.compile(r"(?i)\b(?:commit|sha[0-9]*|md5|hash|checksum|revision|version|id)[ =:#\"']*$")


def contradicted(text: str, kind: str, start: int, end: int, base: set) -> bool:
    """Whether something speaks against a span; it may be supported all the same.

    Part of a longer word or number; a piece of a base span, or more than one; digits that fail Luhn or a time in
    milliseconds; a date, a dotted address, or digits in one piece that nothing tells of, as a phone number; numbers
    beyond 255 or of a version; an address without a dot; a token that no telling word is near, that is told to be a
    digest, or of fewer than six characters.
    """
    span, before = text[start:end], text[max(0, start - 32) : start]
    if before[-1:].isalnum() or text[end : end + 1].isalnum():
        return True
    if any(s < end and start < e and (k, s, e) != (kind, start, end) for k, s, e in base):
        return True
    digits = _digits(span)
    if kind == "email":
        return "." not in re.split(r"@|\(at\)|\[at\]", span)[-1].strip(" .")
    if kind == "card":
        return not luhn(digits) or len(digits) == 13 and digits[:2] in ("15", "16", "17") and digits == span
    if kind == "ip":
        return not _octets(span) or bool(_VERSION.search(before))
    if kind == "phone":
        bare = digits == span and not _TOLD.search(before)
        return bare or bool(_DATED.fullmatch(span)) or span.count(".") == 3 and _octets(span)
    return not _CONTEXT["secret"].search(before[-24:]) or bool(_REVISION.search(before)) or len(set(span)) < 6


def evidence(text: str, kind: str, start: int, end: int, base: set) -> int:
    """1 where a span is supported and nothing speaks against it, -1 the other way round, else 0."""
    return weak_label(text, kind, start, end, base) - contradicted(text, kind, start, end, base)


# ---- boosted trees ---------------------------------------------------------------------------------


@dataclass
class Boosted:
    """Symmetric trees: every level asks one question of all rows, so a leaf is a binary number."""

    trees: list[tuple[list[tuple[int, float]], np.ndarray]] = field(default_factory=list)
    bias: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, x: np.ndarray, told: np.ndarray) -> np.ndarray:
        """Log odds: what the trees say, as far as they know the kind, and what evidence there is."""
        weight = np.array([self.weights.get(kind, 0.0) for kind in KINDS])
        return weight[x[:, 0].astype(int)] * self.margin(x) + EVIDENCE * told

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _odds(self.margin(x))

    def margin(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.bias)
        for questions, leaves in self.trees:
            leaf = np.zeros(len(x), int)
            for feature, edge in questions:
                leaf = 2 * leaf + (x[:, feature] > edge)
            margin += leaves[leaf]
        return margin


def _odds(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-score))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The number of edges below each value, one column per feature."""
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1).astype(np.uint8)


def _sums(bins: np.ndarray, y: np.ndarray, n: np.ndarray, model: Boosted, questions: list[tuple[int, float]]) -> np.ndarray:
    """Gradients and curvatures of rows that stand for ``n`` each: whole numbers by (leaf, feature, bin, which)."""
    p = _odds(model.margin(bins))
    units = [np.rint(UNIT * w) * n for w in (y - p, p * (1 - p))]
    leaf = np.zeros(len(bins), int)
    for f, cut in questions:
        leaf = 2 * leaf + (bins[:, f] > cut)
    size = (1 << len(questions)) * BINS
    cells = [[np.bincount(leaf * BINS + column, u, size).reshape(-1, BINS) for u in units] for column in bins.T]
    return np.array(cells).transpose(2, 0, 3, 1).astype(np.int64)


def _grow(sums: Callable[[Boosted, list], np.ndarray], edges: list[np.ndarray], mean: float, rounds: int, depth: int, rate: float) -> Boosted:
    """Gradient boosting of the log loss with second-order leaf values, from what ``sums`` adds up over all rows."""
    mean = min(max(mean, 1e-3), 1 - 1e-3)
    model = Boosted(bias=float(np.log(mean / (1 - mean))))
    for _ in range(rounds):
        questions: list[tuple[int, float]] = []
        for _ in range(depth):
            cells = sums(model, questions) / UNIT
            best = (-1.0, 0, 0)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                left = cells[:, f].cumsum(axis=1)[:, : len(edge)]
                right = cells[:, f].sum(axis=1)[:, None] - left
                gain = (left[..., 0] ** 2 / (left[..., 1] + 1) + right[..., 0] ** 2 / (right[..., 1] + 1)).sum(axis=0)
                cut = int(gain.argmax())
                if gain[cut] > best[0]:
                    best = (float(gain[cut]), f, cut)
            _, f, cut = best
            if not len(edges[f]):  # all rows are alike
                halves = cells[:, f].sum(axis=1)
                break
            halves = np.stack([cells[:, f, : cut + 1].sum(axis=1), cells[:, f, cut + 1 :].sum(axis=1)], axis=1)
            questions.append((f, cut))
        leaves = halves.reshape(-1, 2)
        model.trees.append((questions, rate * leaves[:, 0] / (leaves[:, 1] + 1)))
    # Grown on bins; from here on, values are asked for.
    model.trees = [([(f, float(edges[f][cut])) for f, cut in asked], leaves) for asked, leaves in model.trees]
    return model


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3) -> Boosted:
    """Boosted trees of rows that are at hand."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins, one = _binned(x, edges), np.ones(len(x))
    return _grow(lambda model, asked: _sums(bins, y, one, model, asked), edges, float(y.mean()), rounds, depth, rate)


def calibrate(model: Boosted, steps: np.ndarray, precision: float = 0.95) -> None:
    """Per kind, the lowest threshold at which held-out candidates reach ``precision`` by the trees alone.

    ``steps`` counts them all by kind, step of their probability and label. One false candidate more is counted
    than there are, so a few that are right don't suffice. A kind that never gets there, or of which all held-out
    candidates are of one class, has UNCALIBRATED.
    """
    for kind, counts in zip(KINDS, steps, strict=True):
        above = counts[::-1].cumsum(axis=0)[::-1]
        good = (above[:, 1] >= precision * (above.sum(axis=1) + 1)) & (counts.sum(axis=1) > 0)
        mixed = (counts.sum(axis=0) > 0).all()
        model.thresholds[kind] = max(0.5, float(np.flatnonzero(good).min() / STEPS)) if mixed and good.any() else UNCALIBRATED


def _holding(texts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct rows (k, text) that hold candidates: for each kind, those with the smallest hashes of their key.

    Rows without candidates teach nothing, and a kind that few rows hold has its share all the same. Rows are
    chosen by key and a hash of the text, so only those chosen move, and no task sees all their texts.
    """

    def kinds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([sum(1 << KINDS.index(k) for k in {c[0] for c in candidates(t or "")}) for t in series], dtype="int32")

    texts = texts.withColumn("h", F.xxhash64("text"))
    held = settle(texts.select("k", "h", F.pandas_udf(kinds, "int")("text").alias("kinds")).filter("kinds > 0 and k is not null"), "pii_kinds")
    distinct = held.distinct()
    share = max(1, most // len(KINDS))
    own = [bounded_sample(distinct.filter(F.col("kinds").bitwiseAND(F.lit(1 << i)) > 0).select("k", "h"), "k", share) for i in range(len(KINDS))]
    keys = own[0]
    for more in own[1:]:
        keys = keys.union(more)
    # At most ``most`` rows; settled, so that their size is known.
    chosen = settle(bounded_sample(keys.distinct(), "k", most), "pii_sample")
    same = texts.join(F.broadcast(chosen), ["k", "h"], "left_semi")
    return same.groupBy("k", "h").agg(F.first("text").alias("text")).select("k", "text")


def _examples(texts: DataFrame) -> DataFrame:
    """kind, y, half, x of each candidate of (k, text) that evidence supports or speaks against, once for equal rows."""

    def rows(batches):
        worker_memory("pii")
        for columns in batches:
            found: list[tuple] = []
            for k, h, text in zip(*(columns[c].to_pylist() for c in ("k", "h", "text")), strict=True):
                proposed = candidates(text)
                base = set(base_spans(text)) if proposed else set()
                half = zlib.crc32(text.encode("utf-8", "surrogatepass")) % 2
                for at, c in enumerate(proposed):
                    if told := evidence(text, *c, base):
                        found.append((k, h, at, KINDS.index(c[0]), int(told > 0), half, features(text, *c)))
            if found:
                yield tuple(map(list, zip(*found, strict=True)))

    source = texts.filter("k is not null and text is not null").select(F.col("k").cast("string").alias("k"), F.xxhash64("text").alias("h"), "text")
    found = map_rows(source, rows, "k string, h long, at int, kind int, y int, half int, x array<double>")
    return settle(found.dropDuplicates(["k", "h", "at"]).drop("k", "h", "at"), "pii_examples")


def _bin_edges(learn: DataFrame) -> list[np.ndarray]:
    """Quantiles of each feature over all rows, of values to three decimals, so that there are few to count."""
    cuts = [i / BINS for i in range(1, BINS)]
    found = learn.agg(*[F.percentile(F.round(F.col("x")[f], 3), cuts).alias(f"x{f}") for f in range(N_FEATURES)]).first()
    return [np.unique(np.array(q, float)) for q in found]


def _table(columns: dict) -> tuple[np.ndarray, ...]:
    """Bins, label, count and kind of a batch of counted examples."""
    bins = np.frombuffer(b"".join(columns["bins"].to_pylist()), np.uint8).reshape(-1, N_FEATURES)
    return bins, *(columns[c].to_numpy().astype(float) for c in ("y", "n")), columns["kind"].to_numpy()


def _summed(counted: DataFrame) -> Callable[[Boosted, list], np.ndarray]:
    """What ``_sums`` adds up over all rows of ``counted``. A task sends its sums alone, at most 41 KB whatever it reads."""

    def sums(model: Boosted, questions: list) -> np.ndarray:
        def rows(batches):
            total = np.zeros((1 << len(questions), N_FEATURES, BINS, 2), np.int64)
            for columns in batches:
                bins, y, n, _ = _table(columns)
                total += _sums(bins, y, n, model, questions)
            yield ([total.tobytes()],)

        parts = [np.frombuffer(r[0], np.int64) for r in map_rows(counted, rows, "sums binary").collect()]
        return np.sum(parts, axis=0).reshape(-1, N_FEATURES, BINS, 2)

    return sums


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int | None = None,
    rounds: int = 40,
    depth: int = 3,
    rate: float = 0.3,
) -> Boosted:
    """Fit on the candidates of all documents; those of half the texts calibrate the thresholds.

    A candidate is an example if evidence supports it or speaks against it; where it does both or neither, only
    ``find`` sees it, and the trees decide. The halves are of texts, so copies of one fall on one side. Equal
    rows count once; rows with a null id are not fitted on. With ``most``, at most so many documents are read, a
    fifth for each kind, chosen by a hash.
    """
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text"))
    examples = _examples(texts if most is None else _holding(texts, most))
    halves = {half: (n, positive) for half, n, positive in examples.groupBy("half").agg(F.count("*"), F.sum("y")).collect()}
    if not halves:
        return Boosted(thresholds=dict.fromkeys(KINDS, UNCALIBRATED))
    both = len(halves) == 2  # else all rows do both
    n, positive = halves[0] if both else next(iter(halves.values()))
    edges = _bin_edges(examples.filter("half = 0") if both else examples)

    def binned(batches):
        for columns in batches:
            x = columns["x"].flatten().to_numpy().reshape(-1, N_FEATURES)
            yield columns["kind"], columns["y"], columns["half"], [b.tobytes() for b in _binned(x, edges)]

    rows = map_rows(examples, binned, "kind int, y int, half int, bins binary")
    counted = settle(rows.groupBy("kind", "y", "half", "bins").agg(F.count("*").alias("n")), "pii_bins")
    learn, held = (counted.filter(f"half = {i}") if both else counted for i in (0, 1))
    model = _grow(_summed(learn), edges, positive / n, rounds, depth, rate)
    known = np.zeros((len(KINDS), 2))
    for k, y, count in learn.groupBy("kind", "y").agg(F.sum("n")).collect():
        known[k, y] = count
    model.weights = {kind: float(few / (few + SHRINK)) for kind, few in zip(KINDS, known.min(axis=1), strict=True)}
    # Bins of a row say on which side of an edge it lies, which is all that a tree asks.
    asked = Boosted([([(f, int(np.searchsorted(edges[f], e))) for f, e in q], v) for q, v in model.trees], model.bias)

    def stepped(batches):
        for columns in batches:
            bins, y, n, kind = _table(columns)
            weight = np.array([model.weights[k] for k in KINDS])[kind]
            step = np.minimum((STEPS * _odds(weight * asked.margin(bins))).astype(int), STEPS - 1)
            yield kind, step, y.astype(int), n.astype(int)

    steps = np.zeros((len(KINDS), STEPS, 2))
    for kind, step, y, count in map_rows(held, stepped, "kind int, step int, y int, n long").groupBy("kind", "step", "y").agg(F.sum("n")).collect():
        steps[kind, step, y] = count
    calibrate(model, steps)
    return model


def find(text: str, model: Boosted) -> tuple[list, list]:
    """Base spans, and base spans with those candidates that the model selects.

    A candidate's score is the trees' margin and what evidence adds or takes; it must reach the threshold of
    its kind. So the trees decide where there is no evidence, or where it disagrees, and may overrule it. An
    added span lies in no base span, though it may hold one, and overlaps no likelier added one.
    """
    base = base_spans(text)
    known = set(base)
    proposed = [c for c in candidates(text) if c not in known]
    if not proposed:
        return base, base
    told = np.array([evidence(text, *c, known) for c in proposed], float)
    p = _odds(model.score(np.array([features(text, *c) for c in proposed]), told))
    added: list[tuple[str, int, int]] = []
    for i in np.argsort(-p, kind="stable"):
        kind, start, end = proposed[i]
        inside = any(s <= start and end <= e for _, s, e in base)
        if p[i] >= model.thresholds.get(kind, UNCALIBRATED) and not inside and all(end <= s or start >= e for _, s, e in added):
            added.append(proposed[i])
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def detect(docs: DataFrame, model: Boosted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base and spans (arrays of kind, start, end; code points, end exclusive).

    Null and empty texts have none. Rows with null or repeated ids are scanned as they come. Other
    columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def rows(batches):
        for columns in batches:
            found = [find(t, model) for t in columns["text"].to_pylist()]
            both = [[[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in side] for side in zip(*found, strict=True)]
            if found:
                yield columns["doc_id"].to_pylist(), both[0], both[1]

    span = "array<struct<kind:string,start:long,end:long>>"
    return map_rows(source, rows, f"doc_id long, base {span}, spans {span}")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(kind) for kind in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, model: Boosted, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping ones by that of the first. Null stays null."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            out = []
            for text in series:
                if not isinstance(text, str):
                    out.append(None)
                    continue
                parts, last = [], 0
                for kind, start, end in sorted(find(text, model)[1], key=lambda s: (s[1], -s[2])):
                    if start >= last:
                        parts += [text[last:start], f"[{kind.upper()}]"]
                    last = max(last, end)
                out.append("".join([*parts, text[last:]]) if parts else text)
            yield pd.Series(out, dtype=object)

    return docs.withColumn(text_col, F.pandas_udf(run, "string")(F.col(text_col)))
