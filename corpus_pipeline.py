"""The corpus pipeline: language, near duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
a stage's rows as Parquet into the shared checkpoint folder and reads them
again as the next one's docs, so a stage is never worked out twice and a lost
executor costs no more than its own stage's tasks. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontam, jaccard, langid, packing, pii
from starloom.llm.common import table
from starloom.session import checkpoint_dir

#: Near duplicates share four fifths of their five-word shingles.
NEAR = jaccard.Similarity(5, 80, 100)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a score of 0.3 or more, that is all but the barely guessed (operator 10).

    Rows whose text is null, empty or without letters go; repeated rows and null
    doc_ids are kept as they are; an empty table stays empty.
    """
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, the smallest doc_id's (operator 1).

    Of repeated rows one stays; a null doc_id is taken only where its group has
    no other; texts without words link with nothing and stay.
    """
    return jaccard.keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 3).

    Null and empty texts hold none and stay, as do null doc_ids and repeated
    rows; an empty benchmark lets all documents stay.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind's name; n_chars follows the text (operator 9).

    A null text stays null; repeated rows are masked alike; an empty table stays empty.
    """
    masked = pii.mask(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in the training sequences (operator 6).

    A null text is packed as an empty one; repeated rows are packed each; an
    empty table gives no pieces.
    """
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: Neither the classifier nor the tagger can be written in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
