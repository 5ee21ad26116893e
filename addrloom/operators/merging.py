"""Merging the rows of one address: which become one row, and what that row says.

Nothing here gathers whole rows. Persons are told apart by components of rows that share a surname; sources, second lines and
lineage are folded to their distinct values before they meet; only the names of a group, in order, go to one task, where
an index finds what each may be (``functions.similar``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrloom.functions import rules as R
from addrloom.functions.household import merge_names, surnames
from addrloom.functions.names import classify
from addrloom.functions.text import strip
from addrloom.operators.components import connected_components
from addrloom.shared import write_table

_COLUMNS = [*R.FIELDS, *R.LINEAGE]
_CLUSTER = ["phase", "cluster"]


def split_clusters(rows: DataFrame) -> DataFrame:
    """``rows`` of clusters of two rows or more, with ``person``, ``part`` and ``sub``: rows of one part become one row.

    Organisations are one part, the first; persons follow. Persons of one source are one part. Those of several sources stay together
    only where a surname, or the lack of one, joins them, however many rows away: parts are the components of rows and
    surnames, and where any person's name says no surname all persons are one. part: -1, or the first row of persons; sub: its
    number in the cluster.
    """
    known = write_table(rows.withColumn("person", classify(strip(F.col("full_name"))) == "person"), "members")
    people = known.where("person")
    source = strip(F.col("data_source"))
    sides = people.groupBy(*_CLUSTER).agg((F.min(source) != F.max(source)).alias("several"), F.min("_ord").alias("first_person"))
    named = people.join(sides.where("several").drop("several"), _CLUSTER).select(*_CLUSTER, "_ord", "first_person", surnames(F.col("full_name")).alias("names"))
    named = write_table(named, "surnames")
    whole = named.groupBy(*_CLUSTER).agg(F.min(F.size("names")).alias("least"))
    told = named.join(whole.where("least > 0").select(*_CLUSTER), _CLUSTER)
    of_name = told.select(*_CLUSTER, "_ord", F.explode("names").alias("surname"))
    first = of_name.groupBy(*_CLUSTER, "surname").agg(F.min("_ord").alias("first"))
    edges = of_name.join(first, [*_CLUSTER, "surname"]).where("_ord <> first").select(F.col("_ord").alias("a"), F.col("first").alias("b"))
    # A row without a partner is its own part; rows of clusters that are not split have no entry and take the first person's.
    parts = told.select("_ord").join(connected_components(edges).withColumnRenamed("node", "_ord"), "_ord", "left").select("_ord", F.coalesce("component", "_ord").alias("component"))
    out = known.select(*_CLUSTER, "_ord", "person").join(parts, "_ord", "left").join(sides.select(*_CLUSTER, "first_person"), _CLUSTER, "left")
    out = write_table(out.select(*_CLUSTER, "_ord", F.when(~F.col("person"), F.lit(-1)).otherwise(F.coalesce("component", "first_person")).alias("part")), "parts")
    # One row a part; organisations sort before all persons, parts by their first row.
    numbered = out.groupBy(*_CLUSTER, "part").agg(F.count("*").alias("rows"))
    numbered = numbered.withColumn("sub", (F.row_number().over(Window.partitionBy(*_CLUSTER).orderBy("part")) - 1).cast("int"))
    return known.join(out.join(numbered, [*_CLUSTER, "part"]).select("_ord", "part", "sub", "rows"), "_ord")


def _folded(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the sources and second lines, sorted, and of each lineage column the different values in the order of rows."""
    sets = ("data_source", "second_line")
    each = F.array(*[F.struct(F.lit(c).alias("of"), strip(F.col(c)).alias("said")) for c in (*sets, *R.LINEAGE)])
    said = rows.select(*keys, "_ord", F.explode(F.filter(each, lambda x: x["said"] != "")).alias("x")).groupBy(*keys, "x.of", "x.said").agg(F.min("_ord").alias("at"))

    def joined(of: str) -> Column:
        at = F.lit(0) if of in sets else F.col("at")
        found = F.array_sort(F.collect_list(F.when(F.col("of") == of, F.struct(at.cast("long").alias("at"), "said"))))
        return F.array_join(F.transform(found, lambda x: x["said"]), ", " if of in sets else " | ").alias(of)

    sources = F.count(F.when(F.col("of") == "data_source", 1)).cast("int").alias("sources")
    return said.groupBy(*keys).agg(*[joined(c) for c in (*sets, *R.LINEAGE)], sources)


def merge_clusters(placed: DataFrame) -> DataFrame:
    """One row for each cluster, or for each part of one that becomes a row; rows that merge with none pass by unchanged.

    The name is merged, sources and second lines are united, the address is the first row's, lineage is kept; the split names are
    blank, for they would say less than the merged name. household: how many persons; sources: how many sources.
    """
    keys = ["phase", "cluster", "n", "sub"]
    split = write_table(split_clusters(placed.where("n > 1")), "split")
    one = F.when(strip(F.col("data_source")) == "", 0).otherwise(1)
    single = placed.where("n = 1").select("phase", "cluster", "n", F.lit(0).alias("sub"), *_COLUMNS, F.lit(0).alias("household"), F.lit(1).alias("sources"))
    alone = split.where("rows = 1").select(*keys, *_COLUMNS, F.lit(0).alias("household"), one.alias("sources"))
    several = split.where("rows > 1")
    first = ["street", "city", "state", "zip"]
    told = several.groupBy(*keys).agg(
        F.first("person").alias("person"), F.min_by(F.struct(*first), "_ord").alias("at"), F.array_sort(F.collect_list(F.struct("_ord", "full_name"))).alias("names"))
    told = told.select(*keys, "at", merge_names(F.transform("names", lambda x: x["full_name"]), F.col("person")).alias("merged"))
    blank = {c: F.lit("").alias(c) for c in R.FIELDS[7:]}
    values = {"full_name": F.col("merged.name").alias("full_name"), **{c: F.col(f"at.{c}").alias(c) for c in first}, **blank}
    folded = _folded(several, keys)
    made = told.join(folded, keys, "left").select(*keys, *[values.get(c, F.coalesce(F.col(c), F.lit("")).alias(c)) for c in _COLUMNS], F.col("merged.persons").alias("household"), F.coalesce("sources", F.lit(0)).alias("sources"))
    return single.unionByName(alone).unionByName(made)
