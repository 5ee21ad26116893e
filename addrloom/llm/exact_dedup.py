"""Exact deduplication by 128-bit content hash, with bytes compared inside each hash's group (native)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.shared import write_table

from .common import ascii_lower, broadcast_if_small, table, text_of, without


def content_hash(text: Column) -> Column:
    """The first 128 bits of the SHA-256 of a text's UTF-8 bytes."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _packed(docs: DataFrame, id_col: str, text: Column, hash_of: Callable[[Column], Column]) -> DataFrame:
    """``(row, id, t, sha, h)``: the row in one column, so that no name of the input can meet one of ours."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), text.alias("t"))
    return rows.select("*", F.sha2("t", 256).alias("sha"), hash_of(F.col("t")).alias("h"))


def _groups(rows: DataFrame, keep: str) -> tuple[DataFrame, DataFrame | None]:
    """Hashes that more than one row has, ``(h, n, first)``, and, where different texts share a hash, ``(h, t, n, first)``.

    Hashes alone are counted first. Of rows that share one the text is a key of the aggregate, so bytes are compared, and copies fold
    before the shuffle; texts that are alone are never moved.
    """
    pick = F.max if keep == "max" else F.min
    twice = write_table(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "hashes")
    each = rows.join(broadcast_if_small(twice, 64), "h", "left_semi").groupBy("h", "t").agg(F.count("*").alias("n"), pick("id").alias("first"))
    found = each.groupBy("h").agg(F.count("*").alias("texts"), F.sum("n").alias("n"), pick("first").alias("first")).where("n > 1")
    found = write_table(found, "copies")
    shared = found.where("texts > 1").select("h")
    if not shared.head(1):
        return found.select("h", "n", "first"), None
    return found.where("texts = 1").select("h", "n", "first"), rows.join(shared, "h", "left_semi").groupBy("h", "t").agg(F.count("*").alias("n"), pick("id").alias("first"))


def _labelled(docs: DataFrame, id_col: str, text_col: str, keep: str, normalised: Column | None, hash_of: Callable[[Column], Column]) -> DataFrame:
    """``(row, sha, n, first, kept)``; a text that no other row has needs no partner in the joins."""
    rows = _packed(docs, id_col, ascii_lower(text_of(text_col)) if normalised is None else normalised, hash_of)
    groups, texts = _groups(rows, keep)
    # One row a repeated text, not one a copy. Beyond the bound adaptive execution splits the rows of a large group.
    out = rows.join(broadcast_if_small(groups, 96), "h", "left")
    if texts is not None:
        out = out.join(texts.withColumnsRenamed({"n": "n2", "first": "first2"}), ["h", "t"], "left")
        n, first = F.coalesce("n2", "n"), F.when(F.col("n2").isNotNull(), F.col("first2")).otherwise(F.col("first"))
    else:
        n, first = F.col("n"), F.col("first")
    alone = n.isNull()
    first = F.when(alone, F.col("id")).otherwise(first)
    return out.select("row", "sha", F.coalesce(n, F.lit(1)).alias("n"), first.alias("first"), F.col("id").eqNullSafe(first).alias("kept"))


def label_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", normalised: Column | None = None,
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` added.

    Rows are equal when their normalised texts (default: A-Z lower-cased, null is empty) have the same
    bytes. The group's row with the largest id (``keep="min"``: the smallest) stays. Groups come from a
    128-bit hash; the aggregate that counts their rows has the text as a key, so bytes are compared, and different
    texts that share a hash are told apart by their bytes. Jobs run here: they write down the repeated hashes.

    Null texts and empty ones are one group; texts of any length are read whole. Rows that repeat an id within
    one group are labelled alike. A null id never wins over another; where all ids of a group are null, keep_id
    is null and all its rows are kept. Ties can't be: equal ids are labelled alike. An input column named like
    one of the four results is replaced, any other name may occur. An empty table gives an empty result.
    """
    docs = without(docs, "keep_id", "group_size", "kept", "text_sha256")
    out = _labelled(docs, id_col, text_col, keep, normalised, hash_of)
    return out.select("row.*", F.col("first").alias("keep_id"), F.col("n").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", normalised: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`label_copies` marks as kept, with the columns that they came with."""
    return _labelled(docs, id_col, text_col, keep, normalised, content_hash).where("kept").select("row.*")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of all ``documents``: null text counts as empty, of equal texts the largest doc_id stays; see :func:`label_copies`."""
    return label_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, g.text_sha256 FROM d JOIN g ON d.t = g.t
"""
