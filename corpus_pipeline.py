"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its rows are
written as Parquet and read back as the next stage's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, packing, pii, simhash
from tidemark.llm.common import free_name
from tidemark.session import run_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts and texts without a letter, also where no row has a language to learn."""
    mark = free_name(docs, "language")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    if not model.families:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return langid.predict(docs, model, out=mark).where(F.col(mark)["lang_pred"] != langid.UNKNOWN).drop(mark)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id: fingerprints of three-word shingles at most two bits apart."""
    return simhash.drop_near_duplicates(docs, width=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses get pseudonyms; all documents stay."""
    return pii.rewrite(docs)


def best_fit_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", pseudonyms),
    ("best-fit packing", best_fit_pack),
]

#: Trained classifiers, XXH64 and subword ids are no SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
