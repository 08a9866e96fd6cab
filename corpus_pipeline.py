"""The corpus pipeline: stages over documents, each written before the next reads it.

Language ID takes out documents whose language cannot be told, SimHash leaves
one document of each near-duplicate group, secrets are replaced by a mark, the
mix takes words of each source near its target (a text becomes what is taken of
it, up to three times), and packing gives the pieces of all texts their places
in sequences. All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsense.llm import language_id, mixing, packing, secret_scan, simhash
from clipsense.llm.queries import documents
from clipsense.session import forget, staged


def _counted(docs: DataFrame) -> DataFrame:
    """Texts that changed have a new length."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.coalesce(length, "n_chars"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.determined(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secret_scan.redact_secrets(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mix_texts(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]
#: Language ID, fingerprints and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages one after the other to all documents; a table is deleted when the next one is written."""
    docs, before = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir.rstrip("/")))
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir.rstrip("/"))
