"""Exact duplicates through recipes of content-defined chunks. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.llm.common import lower_ascii
from terrier.sources.scratch import settle

#: A chunk ends, from its 512th character on, after two letters of these ranges and white space; after
#: 4096 characters it ends anywhere. Equal texts have equal cuts wherever they stand.
CUT = r"(?s).{512,4093}?[a-m][n-z][ \n]|.{1,4096}"


def cut(text: Column) -> Column:
    """The chunks of a text, in order; their concatenation is the text. An empty text has none."""
    return F.regexp_extract_all(text, F.lit(CUT), F.lit(0))


def _digest(chunk: Column, bits: int) -> Column:
    return F.xxhash64(chunk) if bits >= 64 else F.xxhash64(chunk).bitwiseAND(F.lit((1 << bits) - 1))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    A document becomes a recipe: the digests of its chunks, in order. Each distinct chunk moves once
    (copies are combined before the shuffle) and shows whether its digest belongs to one text alone.
    Where several texts share a digest, the recipe gets each one's number beside it, so an identifier
    stands for exactly one text. Equal recipes are then equal texts, and only recipes are compared.

    Null text counts as empty; all empty texts are one group. Rows that repeat an id and a text count
    separately in ``group_size`` and are all ``kept`` if that id is kept. A null id takes part and is
    kept only when its whole group has null ids (``keep_id`` is null then). Other columns are ignored.
    ``bits`` narrows the digest, for tests of the clash path.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("text")
    )
    recipes = settle(
        texts.select(
            "doc_id",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform(cut(F.col("text")), lambda c: _digest(c, bits)).alias("recipe"),
        ),
        "recipes",
    )
    chunks = texts.select(F.explode(cut(F.col("text"))).alias("chunk"))
    distinct = chunks.select(_digest(F.col("chunk"), bits).alias("digest"), "chunk").distinct()
    clashes = settle(distinct.groupBy("digest").count().filter("count > 1").select("digest"), "clashes")
    if clashes.isEmpty():
        recipes = recipes.withColumn("numbers", F.lit(None).cast("array<struct<at:int,number:string>>"))
    else:
        recipes = _numbered(texts, recipes, clashes, bits)
    groups = recipes.groupBy("recipe", "numbers").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    same = (recipes.recipe == groups.recipe) & recipes.numbers.eqNullSafe(groups.numbers)
    return recipes.join(groups, same).select(
        recipes.doc_id, "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _numbered(texts: DataFrame, recipes: DataFrame, clashes: DataFrame, bits: int) -> DataFrame:
    """Add the verified numbers of chunks whose digest several texts share.

    The number of such a chunk is its SHA-256 and, were two of one digest to share even that, the texts
    are told apart by their length and text: the chunk itself is then the number.
    """
    placed = texts.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), F.posexplode(cut(F.col("text"))).alias("at", "chunk")
    ).withColumn("digest", _digest(F.col("chunk"), bits))
    shared = placed.join(clashes, "digest", "left_semi")
    names = settle(
        shared.select("digest", "chunk")
        .distinct()
        .select("digest", "chunk", F.sha2("chunk", 256).alias("sha")),
        "clash_names",
    )
    double = names.groupBy("digest", "sha").count().filter("count > 1").select("digest", "sha")
    names = names.join(double.withColumn("double", F.lit(True)), ["digest", "sha"], "left").select(
        "digest", "chunk", F.when(F.col("double"), F.col("chunk")).otherwise(F.col("sha")).alias("number")
    )
    numbers = (
        shared.join(names, ["digest", "chunk"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.array_sort(F.collect_set(F.struct("at", "number"))).alias("numbers"))
    )
    left, right = recipes.alias("l"), numbers.alias("r")
    same = F.expr("l.doc_id <=> r.doc_id and l.text_sha256 = r.text_sha256")
    return settle(
        left.join(right, same, "left").select("l.doc_id", "l.text_sha256", "l.recipe", "r.numbers"), "numbered"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: of equal texts, one row with the largest id stays. Rows with a null id stay.

    What goes is told by id and text, so an id that carries two texts can lose one and keep the other.
    Of rows that repeat an id and a text (A-Z lower-cased), the smallest by all columns stays.
    Only ids and digests are looked up, in written tables whose size Catalyst knows.
    """
    found = exact_duplicates(docs, id_col, text_col).filter("doc_id is not null")
    known = found.select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha"), "kept")
    marked = settle(known.groupBy("_id", "_sha", "kept").count().filter("not kept or count > 1"), "marked")
    sha = F.unhex(F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), 256))
    same = (F.col(id_col) == F.col("_id")) & (sha == F.col("_sha"))
    once = docs.join(marked, same, "left_anti")
    again = settle(marked.filter("kept"), "repeated")
    if again.isEmpty():
        return once
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = docs.join(again, same).groupBy("_id", "_sha").agg(F.min(row).alias("row"))
    return once.unionByName(least.select("row.*"))


SQL = """with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from t"""
