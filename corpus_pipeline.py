"""From raw documents to packed sequences: five operators of ``sigweave.llm`` in a row.

Every stage takes (spark, docs, sf_dir), prepares the session, and works on all that its predecessor kept. All but
the last return the columns of ``docs``; ``run`` writes each stage's rows as Parquet below the
shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigweave.llm import langid, mixing, nearcopies, packing, toxicity
from sigweave.llm.common import stored
from sigweave.llm.queries import MIX_REST, MIX_WEIGHTS
from sigweave.session import prepare


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity; null and empty texts stay."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def unknown_language_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` names; texts without a letter go."""
    prepare(spark)
    return langid.without_unknown(docs, langid.fit(docs))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of near copies (five words, 0.8).

    Rows that repeat a doc_id and its text stay once. Rows without a doc_id cannot name a
    group and stay.
    """
    prepare(spark)
    return nearcopies.without_copies(docs)


def mixed_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which training is to read the sources."""
    prepare(spark)
    return mixing.mixed(docs, MIX_WEIGHTS, MIX_REST).orderBy("position").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids, numbered in the mixed order."""
    prepare(spark)
    return packing.pack(docs, with_ids=False, ordered=True).drop("ids")


STAGES = [
    ("toxicity", toxic_out),
    ("language", unknown_language_out),
    ("near_copies", near_copies_out),
    ("mixing", mixed_by_source),
    ("packing", packed),
]

# Fitted models and tokenizers have no SQL form; the tests run a brute-force pipeline instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
