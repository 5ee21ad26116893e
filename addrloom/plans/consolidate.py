"""Consolidation: exact groups, similar addresses among the rest, merged rows, reasons for review."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.functions import rules as R
from addrloom.functions.text import is_undeliverable, null_like, strip
from addrloom.operators.matching import address_clusters, exact_key, has_no_street, match_columns
from addrloom.operators.merging import merge_clusters
from addrloom.shared import drop_table, write_table
from addrloom.sources.feeds import keep_first

#: Room for each of up to seven feeds in ``_ord``: 2^27 partitions of rows numbered where they are read.
FEED_ROWS = 1 << 60
_COLUMNS = [*R.FIELDS, *R.LINEAGE]


def union_feeds(*feeds: DataFrame | None, own_sources: bool = False) -> DataFrame:
    """All feeds in order, rows numbered through, copies left out; a column that a feed lacks is blank.

    A feed without one of the thirteen result columns is refused, and so are more than seven feeds. own_sources: each feed says a source
    of its own and has no copies and no nulls, as ``sources.feeds`` make them, so that no copies are left to look for.
    """
    some = []
    given = [f for f in feeds if f is not None]
    if len(given) > 7:
        raise ValueError("rows of more than seven feeds can't be numbered through")
    for i, feed in enumerate(given):
        missing = [c for c in R.FIELDS if c not in feed.columns]
        if missing:
            raise ValueError(f"the feed lacks {missing}")
        some.append(feed.withColumn("_ord", F.col("_ord") + F.lit(i * FEED_ROWS)))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), some)
    both = both.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in _COLUMNS if c in both.columns], *[F.lit("").alias(c) for c in _COLUMNS if c not in both.columns], "_ord")
    return both if own_sources else keep_first(both)


def place_rows(rows: DataFrame, least: float = R.ADDRESS_RATIO, unit_mode: str = "reference") -> DataFrame:
    """``rows`` with ``phase`` (0: exact groups, 1: matched or lone rows, 2: rows never matched), ``cluster`` and ``n``.

    cluster: the place of its first row; n: its size. Only what rows are placed by is written and shuffled on the way, once each; rows meet
    their places in the end, in one join. ``rows`` are read twice, so they should be a written table or cheap.
    """
    apart = null_like(strip(F.col("full_name"))) | has_no_street(F.col("street"))
    whole = write_table(rows.select("_ord", "street", "city", "state", "zip", "second_line", apart.alias("_apart"), exact_key(unit_mode).alias("_key")), "keys")  # keys cost more than writing them
    groups = whole.groupBy("_key").agg(F.count("*").alias("n"), F.min("_ord").alias("cluster"))
    keyed = write_table(whole.join(groups, "_key").drop("_key"), "keyed")
    drop_table(whole)
    lone = keyed.where("n = 1").select("_ord", F.when(F.col("_apart"), 2).otherwise(1).alias("phase"))
    found = address_clusters(match_columns(keyed.where("n = 1 and not _apart"), unit_mode), least)
    sizes = found.groupBy("cluster").agg(F.count("*").alias("n"))
    lone = lone.join(found.join(sizes, "cluster"), "_ord", "left")
    lone = lone.select("_ord", "phase", F.coalesce("cluster", "_ord").alias("cluster"), F.coalesce("n", F.lit(1)).cast("long").alias("n"))
    places = keyed.where("n > 1").select("_ord", F.lit(0).alias("phase"), "cluster", "n").unionByName(lone)
    return rows.join(places, "_ord")


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a written table, themselves if they are one."""
    return rows if hasattr(rows, "_addrloom_path") else write_table(rows, name)


def review_reason(flags: list[Column]) -> Column:
    """All reasons that apply, in order."""
    name, street = strip(F.col("full_name")), strip(F.col("street"))
    gap = (strip(F.col("city")) == "") | (strip(F.col("state")) == "") | (strip(F.col("zip")) == "")
    return F.concat_ws(
        "; ", *flags,
        F.when(name == "", "Empty name"),
        F.when(street == "", "Empty address"),
        F.when(gap, "Missing address field (City/State/Zip)"),
        F.when(name.contains(","), "Possible unparsed name (LAST, FIRST)"),
        F.when(F.lower(name).startswith("parcel "), "No owner name (parcel ID used)"),
        F.when(is_undeliverable(street), "Undeliverable/returned address"),
        F.when(name.contains("Life Estate"), "Life Estate owner (verify estate contact)"),
    )


def add_review(merged: DataFrame) -> DataFrame:
    joined = (F.col("phase") == 0) & (F.col("sources") > 1) & F.col("full_name").contains("&")
    capped = F.concat(F.lit(f"Household capped at {R.HOUSEHOLD_CAP} (had "), F.col("household"), F.lit(")"))
    flags = [
        F.when(joined, "Cross-source household merge"),
        F.when((F.col("phase") > 0) & (F.col("n") > 1), "Fuzzy address match"),
        F.when(F.col("household") > R.HOUSEHOLD_CAP, capped),
    ]
    out = merged.withColumn("review_reason", review_reason(flags))
    return out.withColumn("needs_review", F.when(F.col("review_reason") != "", "Yes").otherwise(""))


def consolidate(rows: DataFrame, least: float = R.ADDRESS_RATIO, unit_mode: str = "reference") -> DataFrame:
    """The consolidated list. ``phase, cluster, sub`` is its order; sort by them only where order is needed."""
    out = add_review(merge_clusters(write_table(place_rows(written(rows, "combined"), least, unit_mode), "placed")))
    return out.select("phase", "cluster", "sub", *_COLUMNS, "needs_review", "review_reason")


def in_order(result: DataFrame) -> DataFrame:
    return result.orderBy("phase", "cluster", "sub")


def volumes(combined: DataFrame, consolidated: DataFrame) -> DataFrame:
    """How many rows came and went, the rate and what it saves."""
    a = combined.agg(F.count("*").alias("input_records"))
    b = consolidated.agg(F.count("*").alias("output_records"))
    gone = F.col("input_records") - F.col("output_records")
    rate = F.when(F.col("input_records") > 0, gone / F.col("input_records")).otherwise(0.0)
    return a.join(F.broadcast(b)).select("input_records", "output_records", gone.alias("records_consolidated"), rate.alias("consolidation_rate"), F.round(gone * R.COST_PER_PIECE, 2).alias("cost_savings"))
