"""Corpus pipeline: five training-data stages applied one after another to
``documents``. Each stage works on all rows its predecessor kept; its output
is written as Parquet and reread as the next stage's input. All but the last
return the columns of ``documents``; the last adds each text's token ids.

Defined cases, of every stage: null texts count as empty, null ids, languages and
sources are kept as they are; repeated rows are rows of their own (so copies
of one row are near duplicates of each other); texts of any length are read
whole; an empty table gives an empty table; further columns of ``documents``
go through all stages, but a column named like what a stage adds (``shard``,
``epoch``, ``words``; ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``ids``) has the stage's
values after it. What one stage leaves of a tie is said in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.bpe import encode_decode
from ledgerlens.llm.common import documents, stored
from ledgerlens.llm.jaccard import keep_one
from ledgerlens.llm.mixing import mix
from ledgerlens.llm.quality import quality_filter
from ledgerlens.llm.suffixes import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule accepts; the others go, empty texts
    among them."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id (null last), of each group
    linked by n-gram Jaccard similarity; texts without words are groups of one."""
    return keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes covered by strings that occur elsewhere, in
    this text or another; a text may be left empty, its row stays."""
    return remove_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row for each time a document is taken, its text cut
    to the words taken. Texts without words are never taken."""
    return mix(docs).select(*docs.columns).withColumn("n_chars", F.length("text").cast("long"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its token ids, their count, and the hashes that show
    that decoding gives the text back."""
    return encode_decode(docs, with_ids=True).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mix", source_mix),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL has no byte-level BPE: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
