"""Checks of a consolidated list: boxes with several names, repeated addresses, poor fields."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrloom.functions.address import address_key, extract_po_box, is_po_box
from addrloom.functions.names import is_trust
from addrloom.functions.text import is_valid_state, normalize_zip, strip, words, zip_is_valid
from addrloom.shared import write_table

TRUST_TWICE = r"(?i)\bTrust\s+Trust\b"
ORDER = ["phase", "cluster", "sub"]


def with_row_numbers(result: DataFrame) -> DataFrame:
    """Rows numbered from 0 in the result's order, as messages name them.

    The rows are sorted once and written down; each part's number and counts, a row a part, add up to where it begins.
    """
    parts = write_table(result.orderBy(*ORDER).withColumn("_part", F.spark_partition_id()), "ordered")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("n"))
    begins = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*ORDER)) - 1
    return parts.withColumn("_at", inside).join(F.broadcast(begins), "_part").select(*result.columns, (F.col("_begin") + F.col("_at")).alias("row"))


def _sources(c: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(c, ","), strip), lambda s: s != ""))


def _box() -> Column:
    """A box and its place, null where a row has no box."""
    place = [F.upper(strip(F.col(c))) for c in ("city", "state")]
    return F.when(is_po_box(F.col("street")), F.concat_ws("|", F.coalesce(extract_po_box(F.col("street")), F.lit("")), *place, normalize_zip(F.col("zip"))))


def _key(unit_mode: str = "reference") -> Column:
    """An address key, null where a row has no street."""
    fields = [strip(F.col(c)) for c in ("street", "city", "state", "zip")]
    return F.when(strip(F.col("street")) != "", address_key(*fields, unit_mode))


def _shared_keys(rows: DataFrame) -> DataFrame:
    """``(key, n)`` of keys of which two rows share a source: some source has more than one row. rows: ``key``, ``data_source``.

    Rows fold to counts of the different values before anything is taken apart; a null source counts all rows of the key.
    """
    folded = rows.where("key is not null").groupBy("key", "data_source").agg(F.count("*").alias("c"))
    each = folded.select("key", "c", F.explode(F.concat(F.coalesce(_sources(F.col("data_source")), F.array().cast("array<string>")), F.array(F.lit(None).cast("string")))).alias("source"))
    sums = each.groupBy("key", "source").agg(F.sum("c").alias("c"))
    told = sums.groupBy("key").agg(F.max(F.when(F.col("source").isNull(), F.col("c"))).alias("n"), F.max(F.when(F.col("source").isNotNull(), F.col("c"))).alias("most"))
    return told.where("most > 1").select("key", "n")


def _odd_boxes(rows: DataFrame) -> DataFrame:
    """``(key, names)`` of :func:`duplicate_boxes`; rows: a written table of ``key``, ``name``, ``data_source`` and the order."""
    rows = rows.where("key is not null")
    named = rows.where("name <> ''")
    first = named.groupBy("key", "name").agg(F.min(F.struct(*ORDER)).alias("at"))
    groups = first.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "name"))).alias("g")).where(F.size("g") > 1)
    groups = groups.withColumn("sets", F.transform("g", lambda x: F.array_distinct(words(F.upper(x["name"])))))
    richest = F.aggregate("sets", F.array().cast("array<string>"), lambda best, s: F.when(F.size(s) > F.size(best), s).otherwise(best))
    groups = groups.withColumn("richest", richest)
    variants = F.forall("sets", lambda s: F.size(F.array_except(s, F.col("richest"))) == 0)
    found = groups.where(~variants).select("key", F.transform("g", lambda x: x["name"]).alias("names"))
    return found.join(_shared_keys(rows).select("key"), "key", "left_semi")


def duplicate_boxes(result: DataFrame) -> DataFrame:
    """``(key, names)``: boxes with different names, not all parts of the fullest one, where two rows share a source."""
    rows = result.where(is_po_box(F.col("street"))).select(*ORDER, "data_source", strip(F.col("full_name")).alias("name"), _box().alias("key"))
    return _odd_boxes(write_table(rows, "boxes"))


def duplicate_keys(result: DataFrame, unit_mode: str = "reference") -> DataFrame:
    """``(key, n)``: address keys that rows of one source share, second lines aside."""
    return _shared_keys(result.select(_key(unit_mode).alias("key"), "data_source"))


def quality_counts(result: DataFrame) -> DataFrame:
    """How many rows have which fault, in one row."""
    def count(c: Column) -> Column:
        return F.coalesce(F.sum(c.cast("long")), F.lit(0))

    blank = {f: strip(F.col(c)) == "" for f, c in (("empty_name", "full_name"), ("empty_address", "street"), ("empty_city", "city"), ("empty_state", "state"))}
    faults = blank | {
        "invalid_state": bad_state(),
        "malformed_zip": bad_zip(),
        "trust_twice": F.col("full_name").rlike(TRUST_TWICE),
    }
    return result.agg(*[count(c).alias(n) for n, c in faults.items()])


def quality_reason() -> Column:
    """A row's own fault: a doubled trust hides the others, state and ZIP are both named."""
    state = F.when(bad_state(), F.concat(F.lit("Unrecognized state code ("), F.col("state"), F.lit(")")))
    zip_ = F.when(bad_zip(), F.concat(F.lit("Malformed ZIP ("), F.col("zip"), F.lit(")")))
    both = F.nullif(F.concat_ws("; ", state, zip_), F.lit(""))
    return F.when(F.col("full_name").rlike(TRUST_TWICE), "Name formatting issue (Trust Trust)").otherwise(both)


def flag_rows(result: DataFrame, unit_mode: str = "reference") -> DataFrame:
    """``result`` with the faults that the checks find added to its reasons; of several checks the last one's counts.

    Keys and boxes are worked out once and written with the rows. Rows without one stay out of the join, where all would meet in one task.
    """
    names = ["_b", "_k", "_box", "_key"]
    rows = write_table(result.select(*result.columns, _box().alias("_box"), _key(unit_mode).alias("_key"), strip(F.col("full_name")).alias("_name")), "checked")
    boxes = _odd_boxes(rows.select(*ORDER, "data_source", F.col("_name").alias("name"), F.col("_box").alias("key"))).select(F.col("key").alias("_box"), F.lit(True).alias("_b"))
    keys = _shared_keys(rows.select(F.col("_key").alias("key"), "data_source")).select(F.col("key").alias("_key"), F.lit(True).alias("_k"))
    cols, no = [*result.columns, *names], F.lit(None).cast("boolean")
    boxed = rows.where("_box is not null").join(boxes, "_box", "left").unionByName(rows.where("_box is null").withColumn("_b", no))
    held = boxed.where("_key is not null").join(keys, "_key", "left").select(*cols)
    rows = held.unionByName(boxed.where("_key is null").withColumn("_k", no).select(*cols))
    reason = F.coalesce(
        quality_reason(),
        F.when(F.col("_k"), F.concat(F.lit("Duplicate address key ("), F.col("_key"), F.lit(")"))),
        F.when(F.col("_b"), F.concat(F.lit("Duplicate PO box ("), F.col("_box"), F.lit(")"))),
    )
    whole = F.concat_ws("; ", F.nullif(strip(F.col("review_reason")), F.lit("")), reason)
    flagged = rows.withColumn("needs_review", F.when(reason.isNotNull(), "Yes").otherwise(F.col("needs_review"))).withColumn("review_reason", F.when(reason.isNotNull(), whole).otherwise(F.col("review_reason")))
    return flagged.select(*result.columns)


def _python_list(values: list[str]) -> str:
    return "[" + ", ".join(map(repr, values)) + "]"


def samples(result: DataFrame, fault: Column, column: str, most: int = 10) -> DataFrame:
    """The first distinct values of a column among the rows that have a fault."""
    return result.where(fault).select(column).distinct().orderBy(column).limit(most)


def bad_state() -> Column:
    return (strip(F.col("state")) != "") & ~is_valid_state(F.col("state"))


def bad_zip() -> Column:
    return ~zip_is_valid(F.col("zip"), F.col("state"))


@F.arrow_udf(T.StringType())
def _listed(values: pa.Array) -> pa.Array:
    return pa.array([_python_list(v or []) for v in values.to_pylist()], pa.string())


def issue_lines(result: DataFrame, unit_mode: str = "reference") -> DataFrame:
    """``(part, at, key, line)``: what a report says, in the order of part, at and key. Lines grow with the list, so they are a table."""
    boxes = duplicate_boxes(result)
    errors = boxes.select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("at"), "key", F.concat(F.lit("ERROR: Duplicate PO Box with distinct names at "), F.col("key"), F.lit(": "), _listed("names")).alias("line"))
    rows = write_table(with_row_numbers(result).select("row", "data_source", _key(unit_mode).alias("key")), "numbered")
    listed = rows.join(_shared_keys(rows).select("key"), "key").groupBy("key").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    said = F.concat(F.lit("WARNING: Duplicate address key '"), F.col("key"), F.lit("' at rows ["), F.array_join(F.transform("rows", lambda r: r.cast("string")), ", "), F.lit("]"))
    repeated = listed.select(F.lit(1).alias("part"), F.get("rows", F.lit(0)).cast("long").alias("at"), "key", said.alias("line"))
    poor = [(2, i, "", line) for i, line in enumerate(_poor_fields(result))]
    return errors.unionByName(repeated).unionByName(result.sparkSession.createDataFrame(poor, "part int, at long, key string, line string"))


def issues(result: DataFrame, unit_mode: str = "reference") -> list[str]:
    """All lines of :func:`issue_lines` at once, for lists whose report fits where it is read."""
    return [r.line for r in issue_lines(result, unit_mode).orderBy("part", "at", "key").select("line").collect()]


def _poor_fields(result: DataFrame) -> list[str]:
    """Counts of poor fields with ten samples at most of each kind."""
    out = []
    n = quality_counts(result).first()
    for field, words_ in (("empty_name", "empty name"), ("empty_address", "empty street address"), ("empty_city", "empty city"), ("empty_state", "empty state")):
        if n[field]:
            out.append(f"WARNING: {n[field]} record(s) have {words_}")

    def sample(fault: Column, c: str) -> list[str]:
        return [r[0] for r in samples(result, fault, c).collect()]

    if n.invalid_state:
        bad = sample(bad_state(), "state")
        out.append(f"WARNING: {n.invalid_state} record(s) have unrecognized state code (sample: {_python_list(bad)})")
    if n.malformed_zip:
        bad = sample(bad_zip(), "zip")
        out.append(f"WARNING: {n.malformed_zip} record(s) have malformed ZIP (short, missing leading zero, or wrong format) — sample: {_python_list(bad)}")
    if n.trust_twice:
        names = [r[0] for r in result.where(F.col("full_name").rlike(TRUST_TWICE)).orderBy(*ORDER).select("full_name").limit(10).collect()]
        out.append(f"WARNING: {n.trust_twice} record(s) have 'Trust Trust' doubling (review needed): {', '.join(names)}")
    return out


def status(found: list[str]) -> str:
    return "FAIL" if any(x.startswith("ERROR:") for x in found) else "PASS"


def trusts(result: DataFrame) -> DataFrame:
    return result.where((strip(F.col("full_name")) != "") & is_trust(strip(F.col("full_name"))))


def source_breakdown(result: DataFrame) -> DataFrame:
    """Rows by source; those of several are ``Multi-source``. The four usual kinds are there even with no row."""
    parts = F.filter(F.transform(F.split("data_source", ","), strip), lambda s: s != "")
    kind = F.when(F.size(parts) > 1, "Multi-source").when(F.size(parts) == 1, F.get(parts, 0))
    counted = result.select(kind.alias("source"), F.lit(1).alias("one")).where("source is not null")
    usual = result.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in ("Consumer", "Business", "Parcel", "Multi-source")])).alias("source"), F.lit(0).alias("one"))
    return counted.unionByName(usual).groupBy("source").agg(F.sum("one").cast("long").alias("records"))
