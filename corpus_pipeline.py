"""From raw documents to token ids: five stages, each over all that the one before it kept.

A stage is ``(spark, docs, sf_dir) -> DataFrame``. All but the last return the columns of
``documents``; what a stage decides shows in its rows: rejected documents and near copies are
gone, secrets are replaced, and documents occur as often as the mix takes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.bpe import encode_documents
from roadpulse.llm.common import saved, ship_code, table
from roadpulse.llm.minhash import one_per_group
from roadpulse.llm.mixing import mixed_documents
from roadpulse.llm.quality import good_documents
from roadpulse.llm.secret_scan import find_secrets, redact

#: Words of a shingle in the near_dedup stage; four are the contract of op5_minhash alone.
STAGE_SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return good_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    ship_code(spark)
    return one_per_group(docs, STAGE_SHINGLE_WORDS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; ``n_chars`` follows the text where it changes."""
    found = find_secrets(docs).withColumn("_has_secrets", F.size("secret_spans") > 0)
    clean = redact(found)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new_length = F.when(F.col("_has_secrets"), F.length("text").cast(kind))
        clean = clean.withColumn("n_chars", F.coalesce(new_length, F.col("n_chars")))
    return clean.select([F.col(f"`{name}`") for name in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in place of its text."""
    ship_code(spark)
    encoded = encode_documents(docs).drop("text", "n_chars")
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Scores, signatures and token ids cannot be told in SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
