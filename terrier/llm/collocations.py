"""Phrases that stand together more often than their parts would, counted in HAT-tries of word ids."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm.common import look_up, map_rows, portions
from terrier.sources.scratch import settle

#: Longest phrase, least frequency, and rows of the report for each language.
LONGEST = 5
LEAST = 100
TOP = 2000
#: A container of more entries becomes a node of the trie. Entries and words a task holds before it spills.
BURST = 2048
HELD = 400_000
WORDS = 200_000
#: Prefix partitions that runs are dealt into; rows of the shuffle hold a run's phrases of one of them.
PREFIXES = 4096
#: Bits of the filters of frequent words and pairs: 16 MB, whatever the corpus.
FILTER_BITS = 1 << 27

#: A-Z become lower-case; a piece ends at ``.,;:!?`` and line ends, written as a line end; a tab is a blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_GAP, _BREAK = -2, -1
_PAIR = 1_000_003


class HatTrie:
    """Counts of phrases of word ids, four bytes each: a shallow trie of ids over hash containers.

    A container hashes what follows the ids that lead to it. When it holds more than ``burst`` entries, it
    bursts into a node of the trie with a smaller container for each next id.
    """

    class Container(dict):
        pass

    def __init__(self, burst: int = BURST):
        self.burst, self.root, self.sizes, self.size = burst, {}, Counter(), 0

    def add(self, key: bytes, count: int) -> None:
        self.add_all(key[:4], [key[4:]], [count])

    def add_all(self, head: bytes, rests: list[bytes], counts: list[int]) -> None:
        """Add phrases that begin with the word ``head`` and go on with ``rests``."""
        grown = self._into(self.root, head, zip(rests, counts))
        self.sizes[head] += grown
        self.size += grown

    def _into(self, node: dict, head: bytes, items) -> int:
        child = node.get(head)
        if child is None:
            child = node[head] = self.Container()
        grown = 0
        if type(child) is self.Container:
            before, known = len(child), child.get
            for rest, count in items:
                child[rest] = known(rest, 0) + count
            grown = len(child) - before
            if len(child) > self.burst and any(len(rest) > 4 for rest in child):
                node[head] = self._burst(child)
            return grown
        for rest, count in items:
            if rest:
                grown += self._into(child, rest[:4], ((rest[4:], count),))
            else:  # the phrase ends at a node
                grown += rest not in child
                child[rest] = child.get(rest, 0) + count
        return grown

    def _burst(self, container: Container) -> dict:
        node: dict = {}
        for rest, count in container.items():
            if rest:
                node.setdefault(rest[:4], self.Container())[rest[4:]] = count
            else:
                node[rest] = count
        return node

    def take(self, subtree: bytes) -> Iterator[tuple[bytes, int]]:
        """Remove a whole subtree and yield its phrases and counts."""
        self.size -= self.sizes.pop(subtree)
        stack = [(subtree, self.root.pop(subtree))]
        while stack:
            key, node = stack.pop()
            if isinstance(node, int):
                yield key, node
            elif type(node) is self.Container:
                for rest, count in node.items():
                    yield key + rest, count
            else:
                stack += [(key + head, child) for head, child in node.items()]

    def largest(self, keep: int) -> list[bytes]:
        """The largest subtrees, so many that at most ``keep`` entries stay."""
        chosen, left = [], self.size
        for subtree, size in self.sizes.most_common():
            if left <= keep:
                break
            chosen.append(subtree)
            left -= size
        return chosen


class Counting:
    """Counts the phrases of ``sizes`` words in the texts of a task; ``spill`` gives sorted runs.

    ``words`` and ``pairs`` are filters of bits: a phrase with a word or a pair that is not frequent is not
    frequent either, so it isn't counted. Filters may let others pass, which the counts then drop.
    """

    def __init__(self, sizes: range, words: bytes, pairs: bytes | None, held: int = HELD, most: int = WORDS, burst: int = BURST):
        self.sizes, self.held, self.most, self.burst = sizes, held, most, burst
        self.words, self.pairs = np.frombuffer(words, np.uint8), pairs and np.frombuffer(pairs, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.tries: dict[str, HatTrie] = {}
        self.names: list[bytes] = []
        self.sums: list[int] = []
        counting = self

        class Ids(dict):
            def __missing__(self, word):
                bit = zlib.crc32(word) % FILTER_BITS
                if not word:
                    number = _GAP
                elif word == b"\n" or not counting.words[bit >> 3] >> (bit & 7) & 1:
                    number = _BREAK
                else:
                    number = len(counting.names)
                    counting.names.append(word)
                    counting.sums.append(zlib.crc32(word))
                self[word] = number
                return number

        self.ids = Ids()

    def add(self, lang: str, texts: list[bytes]) -> None:
        tokens = b"\n".join(texts).translate(FOLD).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        ids = ids[ids != _GAP]
        if len(ids) < 2:
            return
        good = (ids[:-1] >= 0) & (ids[1:] >= 0)
        if self.pairs is not None:
            at = np.flatnonzero(good)
            sums = np.array(self.sums, np.int64)
            bits = (sums[ids[at]] * _PAIR + sums[ids[at + 1]]) % FILTER_BITS
            good[at] = self.pairs[bits >> 3] >> (bits & 7).astype(np.uint8) & 1
        trie = self.tries.setdefault(lang, HatTrie(self.burst))
        chain = good  # chain[i]: all pairs of the phrase that begins at i are good
        for size in range(2, self.sizes.stop):
            if size > 2:
                chain = chain[:-1] & good[size - 2 :]
            if size not in self.sizes or not chain.any():
                continue
            at = np.flatnonzero(chain)
            if size == 2:
                pairs, counts = np.unique((ids[at] << 32) + ids[at + 1], return_counts=True)
                keys = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1).astype(">u4")
            else:
                whole = np.ascontiguousarray(np.stack([ids[at + j] for j in range(size)], axis=1).astype(">u4"))
                found = sorted(Counter(whole.view(f"V{4 * size}").ravel().tolist()).items())
                counts = np.array([n for _, n in found])
                keys = np.frombuffer(b"".join(k for k, _ in found), ">u4").reshape(-1, size)
            heads = np.flatnonzero(np.append(True, keys[1:, 0] != keys[:-1, 0]))
            names = np.ascontiguousarray(keys[heads, :1]).view("V4").ravel().tolist()
            rests = np.ascontiguousarray(keys[:, 1:]).view(f"V{4 * (size - 1)}").ravel().tolist()
            counts, heads = counts.tolist(), [*heads.tolist(), len(keys)]
            for name, start, end in zip(names, heads, heads[1:], strict=False):
                trie.add_all(name, rests[start:end], counts[start:end])

    def full(self) -> bool:
        return len(self.ids) > self.most or sum(t.size for t in self.tries.values()) > self.held

    def spill(self, everything: bool = False) -> Iterator[tuple[str, pa.Array, pa.Array, pa.Array]]:
        """Runs of whole subtrees: lang, and for each prefix partition its phrases, sorted, and their counts."""
        everything = everything or len(self.ids) > self.most
        words, sums = pa.array(self.names, pa.binary()), np.array(self.sums, np.int64)
        for lang, trie in self.tries.items():
            taken: dict[int, tuple[list, list]] = {}
            for subtree in trie.largest(0 if everything else self.held // (2 * len(self.tries))):
                for key, count in trie.take(subtree):
                    keys, counts = taken.setdefault(len(key) // 4, ([], []))
                    keys.append(key)
                    counts.append(count)
            for size, (keys, counts) in taken.items():
                ids = np.frombuffer(b"".join(keys), ">u4").reshape(-1, size).astype(np.int64)
                phrases = pc.binary_join_element_wise(*[words.take(pa.array(ids[:, j])) for j in range(size)], b" ")
                prefix = pa.array((sums[ids[:, 0]] * _PAIR + sums[ids[:, 1]]) % PREFIXES)
                run = pa.table({"prefix": prefix, "phrase": phrases, "n": pa.array(counts, pa.int32())})
                run = run.sort_by([("prefix", "ascending"), ("phrase", "ascending")]).combine_chunks()
                held = run["prefix"].to_numpy()
                starts = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
                ends = pa.array([*starts.tolist(), len(held)], pa.int32())
                listed = pa.ListArray.from_arrays(ends, run["phrase"].combine_chunks())
                numbers = pa.ListArray.from_arrays(ends, run["n"].combine_chunks())
                yield lang, pa.array(held[starts], pa.int32()), pc.binary_join(listed, b"\n"), numbers
        if everything:
            self._forget()


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )


def _by_language(batch: dict, letters: int = 1 << 20) -> Iterator[tuple[str, list[bytes]]]:
    held: dict[str, list[bytes]] = {}
    for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
        held.setdefault(lang, []).append(text)
    for lang, texts in held.items():
        for part in portions(texts, letters):
            yield lang, texts[part]


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, phrase, f: every word, also single ones of a piece."""

    def rows(batches):
        held: dict[str, Counter] = {}

        def emptied():
            for lang, counts in held.items():
                counts.pop(b"", None)
                counts.pop(b"\n", None)
                yield [lang] * len(counts), list(counts), list(counts.values())
            held.clear()

        for batch in batches:
            for lang, some in _by_language(batch):
                held.setdefault(lang, Counter()).update(b"\n".join(some).translate(FOLD).replace(b"\n", b" \n ").split(b" "))
                if sum(map(len, held.values())) > WORDS:
                    yield from emptied()
        yield from emptied()

    found = map_rows(texts, rows, "lang string, phrase binary, n long")
    return found.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("f"))


def _filter(bits: DataFrame) -> bytes:
    """The set bits of a column ``bit``, gathered as a bitmap: at most FILTER_BITS / 8 bytes, whatever their number."""
    pages = bits.groupBy(F.expr("bit div 32768").alias("page")).agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("map"))
    held = bytearray(FILTER_BITS // 8)
    for page, found in pages.toLocalIterator():
        held[page * 4096 : page * 4096 + len(found)] = found
    return bytes(held)


def _sum(word: Column) -> Column:
    return F.crc32(word.cast("binary"))


def phrase_counts(
    texts: DataFrame, sizes: range, words: bytes, pairs: bytes | None, least: int, held: int = HELD, most: int = WORDS, burst: int = BURST
) -> DataFrame:
    """lang, phrase, f of the phrases of ``sizes`` words with f >= ``least``.

    Each task counts in HAT-tries of bounded size and spills whole subtrees as sorted runs, cut into one row
    for each prefix partition. A partition is a hash of the first two words, so a frequent first word is in
    many; its runs are merged where they meet.
    """
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast((words, pairs))

    def runs(batches):
        def written(spilled):
            for lang, prefix, phrases, numbers in spilled:
                langs = pa.array([lang] * len(prefix))
                yield pa.RecordBatch.from_arrays(
                    [langs, prefix, phrases.cast(pa.string()), numbers], names=["lang", "prefix", "phrases", "counts"]
                )

        counting = Counting(sizes, *sent.value, held=held, most=most, burst=burst)
        for batch in batches:
            for lang, some in _by_language({n: batch.column(i) for i, n in enumerate(("lang", "text"))}):
                counting.add(lang, some)
                if counting.full():
                    yield from written(counting.spill())
        yield from written(counting.spill(everything=True))

    dealt = texts.mapInArrow(runs, "lang string, prefix int, phrases string, counts array<int>").repartition("lang", "prefix")
    # A line end parts pieces, so no phrase holds one.
    found = dealt.select("lang", "prefix", F.inline(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("counts").alias("n"))))
    merged = found.groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    return merged.select("lang", "phrase", "f")


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, **how):
    """(phrases, totals): lang, phrase, f of all phrases of up to ``longest`` words with f >= ``least``; lang, n.

    Three passes: words, pairs of frequent words, and longer phrases whose pairs are all frequent. A
    phrase is never more frequent than a part of it, so nothing is lost.
    """
    texts = _texts(docs, lang_col, text_col)
    words = settle(word_counts(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    single = settle(words.filter(F.col("f") >= least), "frequent_words")
    known = _filter(single.select((_sum(F.col("phrase")) % FILTER_BITS).alias("bit")))
    found = [single]
    if longest > 1:
        pairs = settle(phrase_counts(texts, range(2, 3), known, None, least, **how), "frequent_pairs")
        found.append(pairs)
    if longest > 2:
        both = F.split("phrase", " ")
        bit = (_sum(both[0]) * _PAIR + _sum(both[1])) % FILTER_BITS
        longer = phrase_counts(texts, range(3, longest + 1), known, _filter(pairs.select(bit.alias("bit"))), least, **how)
        found.append(settle(longer, "frequent_phrases"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole, totals


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    covered: int = 100,
    **how,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two words and more.

    Texts are lower-cased (A-Z only) and split at ``.,;:!?`` and line ends into pieces, those at blanks and
    tabs into words. n counts a language's words, f a phrase's occurrences inside pieces. A phrase with
    a = f >= ``least`` has, for each cut into two parts, the score floor(1000 * a * n / (l * r)) of the parts'
    f; its lowest counts, ties go to the first cut. It is left out if a longer phrase with
    100 * f >= ``covered`` * a holds its words. Order: score and a descending, then the phrase's bytes.

    Null texts are empty, null languages are ``und``; repeated rows count again; an empty table has no rows.
    Ids and other columns are ignored. Products are exact decimals of 38 digits.
    """
    counted, totals = frequent_phrases(docs, lang_col, text_col, least, longest, **how)
    words = F.split("phrase", " ")
    candidates = settle(counted.withColumn("words", words).filter("size(words) > 1"), "candidates")
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    )
    join = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = cuts.select(
        "lang", "phrase", "a", "k", join(1, F.col("k")).alias("head"), join(F.col("k") + 1, F.size("words") - F.col("k")).alias("tail")
    )
    part = lambda name, value: counted.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    cuts = settle(look_up(cuts, part("head", "l"), ["lang", "head"], ["phrase", "k"]), "cuts")
    cuts = look_up(cuts, part("tail", "r"), ["lang", "tail"], ["phrase", "k"])
    # A language is a row of a small table only if there are few: the totals' size decides, not a hint.
    cuts = cuts.join(settle(totals, "totals"), "lang")
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    product = (wide("a") * wide("n")).cast("decimal(38,0)") * F.lit(1000).cast("decimal(38,0)")
    cuts = cuts.withColumn("over", product.cast("decimal(38,0)")).withColumn("under", (wide("l") * wide("r")).cast("decimal(38,0)"))
    best = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(F.expr("over div under").alias("score"), "k", "a", "l", "r", "n")).alias("best")
    )
    spans = F.explode(F.expr("flatten(transform(sequence(2, size(words) - 1), k -> transform(sequence(1, size(words) - k + 1), s -> array_join(slice(words, s, k), ' '))))"))
    inner = candidates.filter("size(words) > 2").select("lang", F.col("f").alias("longer"), spans.alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.select("lang", "phrase", "best.*").join(inner, ["lang", "phrase"], "left")
    kept = kept.filter(~F.coalesce(F.col("longer") * 100 >= F.col("a") * covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = """with p as (select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n-\\r]')), '[^ \\t]+') as w
  from documents),
grams as (select lang, m, w[s:s + m - 1] as g from (
  select lang, w, m, unnest(range(1, len(w) - m + 2)) as s from p, range(1, 6) t(m) where len(w) >= m)),
f as (select lang, array_to_string(g, ' ') as phrase, any_value(g) as g, m, count(*) as f from grams group by lang, phrase, m
  having count(*) >= 100),
n as (select lang, sum(len(w))::hugeint as n from p group by 1),
c as (select * from f where m > 1),
cuts as (select lang, phrase, f as a, k, array_to_string(g[:k], ' ') as h, array_to_string(g[k + 1:], ' ') as t
  from (select *, unnest(range(1, m)) as k from c)),
s as (select cuts.lang, cuts.phrase, a, k, x.f as l, y.f as r, n, 1000 * a::hugeint * n // (x.f::hugeint * y.f) as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = h join f y on y.lang = cuts.lang and y.phrase = t
  join n on n.lang = cuts.lang),
best as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_ as (select lang, array_to_string(g[b:b + k - 1], ' ') as phrase, max(f) as longer from (
  select lang, g, f, k, unnest(range(1, m - k + 2)) as b from (select *, unnest(range(2, m)) as k from c where m > 2)) group by 1, 2)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank, phrase, a, l, r,
  n::bigint as n, score::bigint as score
from best left join inner_ using (lang, phrase) where longer is null or not (100 * longer >= 100 * a)
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000"""
