"""Connected components by alternating large-star and small-star rounds.

Every round is two grouped minima (combined before the shuffle) and two equi-joins, so neither a hub
nor a large component meets in one task, and nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.shared import drop_table, write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them, over both directions or the smaller ends."""
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = around.join(least, "a")
    if large:
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that an edge touches; component: its smallest node.

    Edges with a null end and loops are ignored, repeated and reversed edges count once, no edge at all
    gives an empty table. Ids are integers of any sign. Rounds go on until one changes nothing; their number
    grows with the logarithm of the largest component.
    """
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    table, seen = write_table(pairs.distinct(), "edges"), None
    while True:
        now = table.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.max(F.col("a") < F.col("b"))).first()
        if now == seen or not now[0]:
            return table.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                table.select("b", "b").distinct()
            )
        seen = now
        step = write_table(_star(_star(table, True), False), "edges")
        drop_table(table)
        table = step
