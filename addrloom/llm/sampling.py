"""Bounded samples of rows for fitting models. What is fitted on is bounded; what is scored never is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def all_parts(text: Column, chars: int, parts: int = 8) -> Column:
    """A text of up to ``chars`` characters as it is; of a longer one that many, in equal parts spread from its start to
    its end, a newline between."""
    size = max(1, (chars - parts + 1) // parts)
    spare = F.length(text) - size
    pieces = [F.substring(text, F.floor(spare * i / (parts - 1)).cast("int") + 1, F.lit(size)) for i in range(parts)]
    return F.when(F.length(text) > chars, F.concat_ws("\n", *pieces)).otherwise(text)


def hash_sample(df: DataFrame, rows: int | dict, on: list[str], by: str | None = None, seed: int = 11) -> DataFrame:
    """At most ``rows`` rows, of each value of ``by`` where one is named: those with the smallest hashes of the columns ``on``.

    ``rows`` may give a number for each value of ``by``; rows of other values are left out, and so are those whose ``by`` is null.
    Rows that agree in ``on`` count once, and one of them is drawn. The bound is exact, whatever repeats or is null, and the draw is
    the same in every run. Hashes alone are sorted, as many as are asked for; the rows themselves are filtered where they are.
    One job runs here.
    """
    marked = df.withColumn("_draw", F.xxhash64(F.lit(seed), *[F.col(c) for c in on]))
    if by is None:
        last = marked.select("_draw").distinct().orderBy("_draw").limit(rows).agg(F.max("_draw")).first()[0]
        some = marked.where(F.col("_draw") <= F.lit(last)) if last is not None else marked.limit(0)
        return some.dropDuplicates(["_draw"]).drop("_draw")
    marked = marked.where(F.col(by).isNotNull())
    most = F.lit(rows)
    if isinstance(rows, dict):
        most = F.lit(0)
        for value, n in rows.items():
            most = F.when(F.col(by) == F.lit(value), F.lit(n)).otherwise(most)
    place = F.row_number().over(Window.partitionBy(by).orderBy("_draw"))
    largest = max(rows.values()) if isinstance(rows, dict) else rows
    placed = marked.select(by, "_draw").distinct().withColumn("_place", place).where(F.col("_place") <= largest).where(F.col("_place") <= most)
    last = {r[0]: r[1] for r in placed.groupBy(by).agg(F.max("_draw")).collect()}
    drawn = F.lit(False)
    for value, cut in last.items():
        drawn = F.when(F.col(by) == F.lit(value), F.col("_draw") <= F.lit(cut)).otherwise(drawn)
    return marked.where(drawn).dropDuplicates([by, "_draw"]).drop("_draw")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: dict, id_col: str, text: Column, label_col: str, seed: int = 11) -> DataFrame:
    """``(id, text, label)``: at most so many rows of each label, drawn by :func:`hash_sample`.

    An id that is labelled more than once has its largest label; null ids and labels that ``rows`` doesn't name teach nothing. Where
    many rows have one id, rows are drawn among these too, so the bound is on rows, not on ids.
    """
    label = F.col(f"`{label_col}`").alias("label")
    told = labels.select(F.col(f"`{id_col}`").alias("id"), label).where(F.col("label").isin(*rows) & F.col("id").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
    ids = hash_sample(told, rows, ["id"], "label", seed)
    found = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).join(F.broadcast(ids), "id")  # at most the rows asked for
    return hash_sample(found, rows, ["id", "text"], "label", seed)
