"""A corpus pipeline: language, near duplicates, repeated passages, benchmark, tokens.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept.
All but the last return the columns of ``docs``. Null and empty texts go in the first
stage; other columns, nulls and extra columns pass through. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.llm import decontaminate, language_id, near_dedup, sentencepiece_codec, substring_dedup
from funnelspark.llm.common import table
from funnelspark.llm.queries import TOKENIZERS
from funnelspark.sources.storage import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose text is null or has no letter; learns from ``lang``."""
    found = language_id.identify(docs, language_id.fitted(docs))
    label = found.columns[-2]
    return found.where(F.col(label) != language_id.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id."""
    return near_dedup.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the words of passages that an earlier document has.

    A text that loses no word stays as it is, and one that loses all goes.
    """
    found = substring_dedup.remove_repeated(docs)
    n_words, n_removed, kept = map(F.col, found.columns[-3:])
    found = found.where((n_removed == 0) | (n_removed < n_words))
    changed = {"text": F.when(n_removed > 0, kept).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        size = F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(n_removed > 0, size).otherwise(F.col("n_chars"))
    return found.withColumns(changed).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text."""
    model = sentencepiece_codec.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    coded = sentencepiece_codec.encode(docs.select("doc_id", "lang", "source", "text"), model)
    return coded.select("doc_id", "lang", "source", "n_tokens", "same", "ids")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode),
]

#: Two stages learn or search beyond SQL; tests hold the rows against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
