"""A pipeline over ``documents``: language, exact copies, near copies, mixture, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again before the next. All of
them bear null, empty and very long texts, ties, repeated rows, no rows, and columns of any name: see each one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.llm.exact_dedup import drop_copies
from addrloom.llm.language import identify, learned
from addrloom.llm.mixing import mixed_rows
from addrloom.llm.packing import packed_digest
from addrloom.llm.simhash import drop_near_copies
from addrloom.shared import drop_table, write_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay; null texts and texts without a letter have none and go. Repeated rows stay."""
    return identify(docs, learned(docs)).where("not lang_rejected").select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the row with the largest id stays, all such rows if it repeats; null and empty are equal."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that with the smallest id; rows with a null id all stay."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it, which is never for texts without a word; a null source is the last one."""
    return mixed_rows(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixture's documents and where they lie in the packed sequences; a null text is the end token alone."""
    return packed_digest(docs)


STAGES = [
    ("language", known_language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("mixture", mixture),
    ("packing", sequences),
]

#: Compression, fingerprints and packing can't be put in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        kept = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            drop_table(before)
        docs = before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
