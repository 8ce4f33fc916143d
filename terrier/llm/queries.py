"""The numbered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.llm import (
    bpe,
    chat,
    collocations,
    decontaminate,
    exact,
    jaccard,
    neighbours,
    packing,
    paragraphs,
    pii,
    prefixes,
    quality,
    toxicity,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).selectExpr(
        "-7L conv_id", "id turn", "if(id = 0, 'user', 'assistant') role", f"'{probe}' text"
    )
    messages = given.union(more).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.digests(chat.read_back(chat.format_chats(messages)))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality.classify(docs, quality.fit(docs))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_text(_table(spark, folder, "documents"))


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, folder, "labels")))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    words = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode(_table(spark, folder, "documents"), words, decoded=True))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, folder, "documents"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pii.digests(pii.detect(docs, pii.fit(docs)))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.rebuilt_trie(_table(spark, folder, "conversations"))


def op13_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.digests(decontaminate.leaks(docs, _table(spark, folder, "benchmark")))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_quality": op2_quality,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_neighbours": op4_neighbours,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pii": op10_pii,
    "op11_collocations": op11_collocations,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_decontaminate": op13_decontaminate,
}
SQL = {
    "op1_chat_format": chat.SQL,
    "op5_jaccard_join": jaccard.SQL,
    "op9_exact_dedup": exact.SQL,
    "op11_collocations": collocations.SQL,
    "op12_prefix_trie": prefixes.SQL,
    "op13_decontaminate": decontaminate.SQL,
}
