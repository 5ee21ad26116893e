"""Reading feeds and writing results: CSV of any usual encoding, XLSX, Parquet. Every column is text, nothing is null."""

from __future__ import annotations

import io
import posixpath
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrloom.functions import rules as R
from addrloom.shared import spread
from addrloom.sources.csv_lines import read_csv

SHEETS = ["owners", "owner", "parcel owners"]
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _suffix(path: str) -> str:
    return posixpath.splitext(path.rstrip("/"))[1].lower()


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """A feed by its file's extension, with ``_ord``, the place of each row; a feed of few parts is dealt over all cores."""
    kind = _suffix(path)
    if kind not in READERS:
        raise ValueError(f"Unsupported file format: {kind}. Use XLSX, CSV or Parquet.")
    return spread(READERS[kind](spark, path), "_ord")


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def with_order(df: DataFrame) -> DataFrame:
    """Adds ``_ord``, which grows with the place of a row in its file; files of one part keep their order."""
    return df.withColumn("_ord", F.monotonically_increasing_id())


def _cell(cell: ET.Element, shared: list[str]) -> str:
    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    text = value.text or "" if value is not None else ""
    return shared[int(text)] if kind == "s" and text else text


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if c.isalpha():
            n = 26 * n + ord(c.upper()) - 64
    return n - 1


def sheet_rows(content: bytes, preferred: list[str] = SHEETS) -> Iterator[list[str]]:
    """The rows of a workbook's preferred sheet, or of its first, as text."""
    book = zipfile.ZipFile(io.BytesIO(content))
    sheets = ET.fromstring(book.read("xl/workbook.xml")).findall(f"{_MAIN}sheets/{_MAIN}sheet")
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    named = {s.get("name").lower(): s for s in sheets}
    sheet = next((named[p] for p in preferred if p in named), sheets[0])
    target = targets[sheet.get(_LINK)]
    path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ET.fromstring(book.read("xl/sharedStrings.xml"))]
    for row in ET.fromstring(book.read(path)).iter(f"{_MAIN}row"):
        cells: list[str] = []
        for cell in row.findall(f"{_MAIN}c"):
            at = _column(cell.get("r")) if cell.get("r") else len(cells)
            cells += [""] * (at - len(cells) + 1)
            cells[at] = _cell(cell, shared)
        yield cells


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """A workbook's sheet of owners. The header is read on the driver, the rows where the file is scanned."""
    files = spark.read.format("binaryFile").load(path).select("content")
    head = files.first()
    header = next(sheet_rows(bytes(head[0])), []) if head else []
    names = [h or f"Unnamed: {i}" for i, h in enumerate(header)]
    schema = T.StructType([T.StructField("_ord", T.LongType()), *[T.StructField(n, T.StringType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = [r + [""] * (len(names) - len(r)) for r in list(sheet_rows(content))[1:] if any(r)]
                cols = [pa.array(list(range(len(rows))), pa.int64()), *[pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))]]
                yield pa.RecordBatch.from_arrays(cols, ["_ord", *names])

    return files.mapInArrow(run, schema).select(*[f"`{n}`" for n in names], "_ord")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return with_order(as_text(spark.read.parquet(path)))


READERS = {".csv": read_csv, ".xlsx": read_xlsx, ".parquet": read_parquet}


def empty_feed(spark: SparkSession) -> DataFrame:
    """What stands for a feed that is missing: no rows, all columns."""
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in [*R.FIELDS, *R.LINEAGE]) + ", _ord long")


def row_count(df: DataFrame | None) -> int:
    return 0 if df is None else df.count()


def for_print(df: DataFrame) -> DataFrame:
    """The result's columns under the names that mail houses expect."""
    names = dict(zip([*R.FIELDS, *R.LINEAGE, "needs_review", "review_reason"], [*R.OUTPUT, *R.ORIGINAL, *R.REVIEW], strict=True))
    return df.select(*[F.col(c).alias(n) for c, n in names.items() if c in df.columns])


def write_csv(df: DataFrame, folder: str, parts: int | None = None) -> None:
    """CSV with quotes doubled and blanks bare; ``parts=1`` for one file."""
    (df.coalesce(parts) if parts else df).write.mode("overwrite").options(header=True, escape='"', emptyValue="", encoding="UTF-8").csv(folder)


def write_csv_with_mark(df: DataFrame, path: str) -> None:
    """One CSV file on the driver that begins with a byte-order mark, for spreadsheets. Rows stream through, none are held."""
    import csv
    import os

    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
