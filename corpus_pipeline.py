"""From raw documents to packed sequences: language, near copies, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before has kept; all but the
last return the columns of ``documents``. ``run`` writes each stage's result as Parquet under the
session's checkpoint folder and reads it again, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from candor.llm import hyperminhash, langid, packing, pii
from candor.session import ensure_checkpoint_dir


NEAR_PERCENT = 80
# Rows are whole texts: Arrow batches of this many keep executors' memory outside the heap small.
BATCH_ROWS = "2000"


def _sized(spark: SparkSession) -> None:
    """Set before a stage's plan is made and left set, because the caller runs the plan."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; ``lang`` becomes the predicted one.

    NULL and empty texts, texts without a letter, and texts of which no language has the least share of letters have none and go. Whole texts count, however long; a word's
    tie goes to the language before it, then to the first by name. Repeated rows stay as often as they come, NULL ids and sources stay as they are, an empty table stays empty, and other columns are carried along.
    """
    _sized(spark)
    return langid.with_language(docs, langid.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays.

    That is the one of the smallest ``doc_id`` (NULL after all others). Texts without words are linked with nothing and stay. Of rows that repeat id and text one
    stays. An empty table stays empty, and other columns are carried along.
    """
    _sized(spark)
    return hyperminhash.keep_one(docs, percent=NEAR_PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes placeholders; ``n_chars`` follows.

    Every row stays, repeated ones too; NULL and empty texts have nothing to replace. Whole texts are searched. An empty table stays empty, and other columns are carried along.
    """
    _sized(spark)
    return pii.redact_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 1024 ids.

    NULL and empty texts are one end mark. Repeated rows and NULL ids are packed row by row; longer documents are cut; an empty table gives no rows; other columns are left out.
    """
    _sized(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)


STAGES = [("languages", languages), ("near_copies", near_copies), ("personal_data", personal_data), ("packed", packed)]

# Language models, sketches and token merges are not SQL: tests/llm/test_pipeline.py holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
