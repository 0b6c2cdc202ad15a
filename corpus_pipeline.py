"""Documents to packed training rows, in five stages.

Every stage takes all rows its predecessor wrote. The first four return the columns of ``documents``; the last
returns one row per packed piece.

1. Language ID: rows without a recognised language go; code-switched texts stay.
2. Near duplicates: of each group linked by five-word shingles (similarity 0.8 or more) the row with the smallest
   id stays.
3. Secrets: what the scan finds is masked in the text; no row goes.
4. Mixing: rows are taken as often as the source targets say, so some go and some appear twice.
5. Packing: texts are put into bins of 2,048 words; a copy never shares a bin with its twin.

Empty tables pass through as empty tables; extra columns are carried along by the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import budget, jaccard, language, novelty, packing
from feedloom.llm.common import remainder, stored, table

# No SQL: a trained model, a compressor and a packing order decide the rows; tests hold them to plain versions.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs, remainder("doc_id", 5) != 0)
    return language.keep_spoken(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_duplicates(docs, words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = novelty.mask_secrets(docs)
    # The column with the length follows the masked text.
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return budget.take(docs, stored(budget.mix(docs), "mixed"))


def pack_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_rows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each on all rows its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
