"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns documents, the last one sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbour vote does not call low quality; null and empty texts are scored as well."""
    from .quality import LOW, QualityModel

    model = QualityModel.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                             spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(model.score(F.col("text")) >= LOW)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without a letter and texts that fit no language go."""
    from .langid import LanguageModel

    model = LanguageModel.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return docs.where(model.accepts(F.col("text")))


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), its smallest id."""
    from .neardup import without_copies

    return without_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the source mix, repeated where a source is taken more than once.

    A null or empty text has 0 words, a null source is a source of its own, the last; identical rows share a hash
    and are taken alike, also where that misses a target; texts are counted whole and an empty table gives an empty one.
    """
    from .mixing import mixed

    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in packed sequences.

    A null or empty text is one piece with the end id alone; repeated rows and null ids give pieces of their own; only
    texts of more tokens than a sequence holds are cut; pieces of equal size go by doc_id, null first, and piece; an
    empty table gives an empty one.
    """
    from .packing import pack, token_pieces

    return pack(token_pieces(docs, tokenizer_path("word_bpe_49k.json")))
