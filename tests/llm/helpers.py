"""Awkward tables the operators must live with."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Null and repeated ids, null, empty and blank texts, repeated rows, clashing extra columns are added by ``odd_docs``.
ROWS = [
    (1, "the cat sat on the mat and looked at the dog for a long while", "en", "a", 62),
    (1, "the cat sat on the mat and looked at the dog for a long while", "en", "a", 62),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \n\t ", "en", "b", 4),
    (None, "a row without an id that has some words in it all the same", None, "b", 58),
    (5, "mail me at some.one@example.com or call +1 (269) 555-5822 now", "en", None, 61),
    (5, "another text under the same id with its own words", "en", "a", 49),
    (6, "x", "de", "c", 1),
    (7, "word " * 3000, "en", "c", 15000),
    (8, "é" * 40 + " über straße naïve 日本語 text", "fr", "c", 66),
]

#: Names that operators use inside or return.
CLASHES = ["node", "sig", "host", "kept", "bin", "hash", "label", "text_key", "n_tokens", "shard", "lang_pred", "spans"]


def odd_docs(spark, rows=None):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS if rows is None else rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf_dir):
    """The table's rows as a dict by doc_id (ids are unique there)."""
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
