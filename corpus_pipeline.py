"""Documents to packed training sequences: quality, language, near copies, source mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statline.llm import stages
from statline.llm.runtime import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", stages.keep_quality),
    ("language id", stages.keep_language),
    ("minhash near-dedup", stages.keep_one_of_copies),
    ("source mix", stages.mix_sources),
    ("best-fit packing", stages.pack_sequences),
]

#: Fitted models, hashed links and BPE have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
