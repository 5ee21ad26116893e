"""Reports in plain text, and the whole run from files to a result."""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions import rules as R
from addrloom.functions.text import strip
from addrloom.shared import fresh_path, write_table
from addrloom.sources import feeds
from addrloom.sources.files import empty_feed, for_print, read_feed, write_csv_with_mark

from .consolidate import consolidate, in_order, union_feeds
from .validate import flag_rows, issue_lines, source_breakdown, trusts


def elapsed(seconds: float) -> str:
    return f"{int(seconds) // 60}:{int(seconds) % 60:02d}"


@dataclass
class Run:
    """What a run made and found."""

    counts: dict[str, int] = field(default_factory=dict)
    combined: DataFrame | None = None
    consolidated: DataFrame | None = None
    #: The report's lines, as :func:`issue_lines` gives them, and how many errors and warnings there are.
    lines: DataFrame | None = None
    errors: int = 0
    warnings: int = 0
    #: What was odd about a feed: one that can't be read, a likely wrong one, owners that the grammar couldn't read.
    notes: list[str] = field(default_factory=list)

    @property
    def status(self) -> str:
        return "FAIL" if self.errors else "PASS"


def validation_report(found: list[str]) -> str:
    errors = [x for x in found if x.startswith("ERROR:")]
    return "\n".join([*_head(len(errors), len(found) - len(errors)), *found]) + "\n"


def read_validation_report(text: str | None) -> dict:
    """Status, counts and issues of a report; UNKNOWN and none where there is no report."""
    out = {"status": "UNKNOWN", "errors": 0, "warnings": 0, "details": []}
    for line in map(str.strip, (text or "").splitlines()):
        name, colon, value = line.partition(":")
        if line.startswith(("ERROR:", "WARNING:")):
            out["details"].append(line)
        elif colon and name == "Overall status" and value.strip():
            out["status"] = value.split()[0].upper()
        elif colon and name in ("Errors", "Warnings") and value.strip().isdigit():
            out[name.lower()] = int(value)
    return out


def _counted(lines: DataFrame) -> tuple[int, int]:
    errors = F.coalesce(F.sum(F.col("line").startswith("ERROR:").cast("long")), F.lit(0))
    n = lines.agg(errors.alias("errors"), F.count("*").alias("every")).first()
    return n.errors, n.every - n.errors


def _head(errors: int, warnings: int) -> list[str]:
    return ["VALIDATION REPORT", f"Overall status: {'FAIL' if errors else 'PASS'}", f"Errors: {errors}", f"Warnings: {warnings}", ""]


def write_report(lines: DataFrame) -> str:
    """Write a report of :func:`issue_lines` as a folder of text in the shared folder, in order; its path."""
    spark = lines.sparkSession
    lines = write_table(lines, "issues")
    head = spark.createDataFrame([(-1, i, "", line) for i, line in enumerate(_head(*_counted(lines)))], "part int, at long, key string, line string")
    path = fresh_path(spark, "validation-report")
    head.unionByName(lines).orderBy("part", "at", "key").select("line").write.text(path)
    return path


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``(status, errors, warnings)`` of a report in text, one row, as :func:`read_validation_report` reads them; details stay where they are."""
    line = strip(F.col("value"))
    value = strip(F.regexp_extract(line, "^[^:]*:(.*)$", 1))
    told = spark.read.text(path).select(F.substring_index(line, ":", 1).alias("name"), value.alias("value"), line.contains(":").alias("colon")).where("colon and value <> ''")

    def said(name: str, pattern: str) -> Column:
        return F.max(F.when((F.col("name") == name) & F.col("value").rlike(pattern), F.regexp_extract("value", pattern, 0)))

    number = [F.coalesce(said(n, r"^[0-9]+$").cast("long"), F.lit(0)).alias(n.lower()) for n in ("Errors", "Warnings")]
    return told.agg(F.coalesce(F.upper(said("Overall status", r"^\S+")), F.lit("UNKNOWN")).alias("status"), *number)


def statistics(run: Run, show: int = 50) -> str:
    """Volumes, consolidation, validation, coverage by source, trusts to look at."""
    combined, final = run.combined.count(), run.consolidated.count()
    gone = combined - final
    part = (lambda n, of: n / of * 100 if of else 0.0)
    sources = {r.source: r.records for r in source_breakdown(run.consolidated).collect()}
    found = trusts(run.consolidated)
    n_trusts = found.count()
    out = ["PIPELINE STATISTICS", "", "INPUT VOLUMES"]
    out += [f"  {k.title()} records: {run.counts.get(k, 0):,}" for k in ("consumer", "business", "parcel")]
    out += [f"  Total input records: {sum(run.counts.values()):,}", "", "CONSOLIDATION", f"  Combined (after exact dedup): {combined:,}", f"  Consolidated (final): {final:,}"]
    out += [f"  Consolidation rate: {part(gone, combined):.1f}%", f"  Suppressed records: {gone:,}", f"  Cost savings (@ ${R.COST_PER_PIECE:.2f}/pc): ${gone * R.COST_PER_PIECE:,.2f}"]
    out += ["", "VALIDATION", f"  Overall status: {run.status}", f"  Errors: {run.errors}", f"  Warnings: {run.warnings}", "", "SOURCE COVERAGE"]
    out += [f"  {s}: {sources.get(s, 0):,} ({part(sources.get(s, 0), final):.1f}%)" for s in ("Consumer", "Business", "Parcel", "Multi-source")]
    out += [f"  Cross-source validation rate: {part(sources.get('Multi-source', 0), final):.1f}%", "", "TRUSTS / ESTATES FLAGGED FOR HUMAN REVIEW"]
    out += [f"  {n_trusts} record(s) flagged:"] if n_trusts else ["  None."]
    for r in in_order(found).limit(show).collect():
        out += [f"    - {r.full_name}", f"      {r.street}, {r.city}, {r.state} {r.zip}"]
    if n_trusts > show:
        out.append(f"    ... and {n_trusts - show} more.")
    return "\n".join(out) + "\n"


def _write(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def feed_notes(kind: str, raw: DataFrame, show: int = 10) -> list[str]:
    """Streets where companies should be, and owners that couldn't be read: how many, and the first ones."""
    if kind == "business" and feeds.looks_like_streets(raw):
        return ["business: the company column looks like street addresses; is this the right feed?"]
    if kind != "parcel":
        return []
    bad = feeds.parse_errors(raw)
    n = bad.count()
    return [f"parcel: {n} owner(s) could not be read and stay as they are"] * (n > 0) + [f"parcel: {r.owner!r}: {r.error}" for r in bad.limit(show).collect()]


def run(spark: SparkSession, consumer: str | None = None, business: str | None = None, parcel: str | None = None, least: float = R.ADDRESS_RATIO, unit_mode: str = "reference") -> Run:
    """All stages over the feeds that are given; a feed that fails counts as empty, and all missing is an error."""
    given = {"consumer": consumer, "business": business, "parcel": parcel}
    if not any(given.values()):
        raise FileNotFoundError("no feed is given")
    out, parts = Run(), []
    for kind, path in given.items():
        feed = empty_feed(spark)
        if path:
            try:
                raw = read_feed(spark, path)
                feed = write_table(getattr(feeds, kind)(raw), kind)
                out.notes += feed_notes(kind, raw)
            except Exception as e:  # one feed that can't be read doesn't stop the others
                out.notes.append(f"{kind}: {type(e).__name__}: {e}")
        out.counts[kind] = feed.count()
        parts.append(feed)
    out.combined = write_table(union_feeds(*parts), "combined")
    result = write_table(consolidate(out.combined, least, unit_mode), "consolidated")
    out.lines = write_table(issue_lines(result, unit_mode), "issues")
    out.errors, out.warnings = _counted(out.lines)
    out.consolidated = write_table(flag_rows(result, unit_mode), "flagged")
    return out


def run_to_folder(spark: SparkSession, folder: str, **given) -> Run:
    began = time.time()
    out = run(spark, **given)
    write_csv_with_mark(for_print(in_order(out.consolidated)), os.path.join(folder, "consolidated.csv"))
    with open(os.path.join(folder, "validation_report.txt"), "w", encoding="utf-8") as f:
        f.writelines(x + "\n" for x in _head(out.errors, out.warnings))
        for r in out.lines.orderBy("part", "at", "key").toLocalIterator():  # a part at a time
            f.write(r.line + "\n")
    _write(os.path.join(folder, "stats.txt"), statistics(out))
    for note in out.notes:
        print(note)
    print(f"{out.status} after {elapsed(time.time() - began)}")
    return out
