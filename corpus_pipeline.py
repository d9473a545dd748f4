"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, PII, packing.

``STAGES`` lists the stages; each function takes (spark, docs, sf_dir) and
returns a DataFrame: all but the last with the columns of ``documents``.
``run`` writes what a stage keeps as Parquet in the shared checkpoint folder
and reads it again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import bottomk, decontaminate, packing, surrogates, toxicity
from cohortkit.llm.common import prepare, table, written


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject (score below 0.5)."""
    prepare(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, name="__ck_toxicity").filter(F.col("__ck_toxicity") < 0.5).drop("__ck_toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return bottomk.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; those that are little else go."""
    prepare(spark)
    return _with_length(decontaminate.remove(docs, table(spark, sf_dir, "benchmark")))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data."""
    prepare(spark)
    return _with_length(surrogates.replace(docs)[0].drop("__ck_replaced"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a sequence."""
    prepare(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("PII", replace_pii),
    ("best-fit packing", pack),
]

#: SQL can't express the trained and packing stages; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
