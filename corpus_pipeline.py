"""A training corpus from raw documents: filtered, de-duplicated, decontaminated, packed."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, langid, packing, simhash
from tidemark.llm.common import noted, read, staged
from tidemark.session import configure
from tidemark.sinks.files import remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", langid.stage),
    ("exact_dedup", exact_dedup.stage),
    ("simhash", simhash.stage),
    ("decontamination", decontaminate.stage),
    ("packing", packing.stage),
]

ORACLE_SQL = None  # a fitted classifier and a tokenizer's ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again.

    What a stage wrote on its way, and the rows it read, go once its own rows are written: at
    any time the shared folder holds one stage's tables, in the end the last rows alone.
    """
    docs, before = read(configure(spark), sf_dir), []
    for name, function in STAGES:
        with noted() as paths:
            docs = staged(function(spark, docs, sf_dir), name)
        for path in [*before, *paths[:-1]]:
            remove(spark, path)
        before = paths[-1:]
    return docs
