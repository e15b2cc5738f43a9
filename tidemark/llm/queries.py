"""The operators as registered queries, and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    conversations,
    curriculum,
    decontaminate,
    exact_dedup,
    langid,
    licenses,
    lm,
    packing,
    pii,
    simhash,
    substring_dedup,
    toxicity,
    variants,
)
from tidemark.llm.common import read
from tidemark.session import configure

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_language_id(spark, folder):
    return langid.identify(read(spark, folder))


@query
def op2_exact_dedup(spark, folder):
    return exact_dedup.exact_dedup(read(spark, folder))


ORACLES["op2_exact_dedup"] = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
    FROM documents
), g AS (
    SELECT doc_id, sha256(body) AS text_sha256,
           min(doc_id) OVER (PARTITION BY body) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size
    FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query
def op3_license_scan(spark, folder):
    return licenses.scan(read(spark, folder))


ORACLES["op3_license_scan"] = licenses.oracle()


@query
def op4_decontamination(spark, folder):
    return decontaminate.contaminated(read(spark, folder), read(spark, folder, "benchmark"))


@query
def op5_pii(spark, folder):
    return pii.personal_data(read(spark, folder))


ORACLES["op5_pii"] = pii.oracle()


@query
def op6_toxicity(spark, folder):
    return toxicity.toxicity(read(spark, folder), read(spark, folder, "labels"))


@query
def op7_substring_dedup(spark, folder):
    return substring_dedup.remove_repeats(read(spark, folder))


@query
def op8_lm_score(spark, folder):
    return lm.lm_scores(read(spark, folder))


@query
def op9_packing(spark, folder):
    return packing.pack(read(spark, folder))


@query
def op10_simhash(spark, folder):
    return simhash.simhash_groups(read(spark, folder))


@query
def op11_conversation_repair(spark, folder):
    return conversations.repair(read(spark, folder, "conversations"))


@query
def op12_curriculum(spark, folder):
    return curriculum.mix(read(spark, folder))


ORACLES["op12_curriculum"] = curriculum.oracle()


@query
def op13_spelling_variants(spark, folder):
    return variants.variants(read(spark, folder))
