"""CSV files read by several tasks each, though records may span lines and nobody says how the bytes are encoded.

Files are split at line ends wherever Spark splits them. Whether a line begins inside quotes depends on all lines before it, but
only through one bit, so each stretch of a file is summed up by what it makes of that bit: one row a stretch, whose prefix
products say how every stretch begins. With that each task cuts its own lines into records; only a record that crosses the edge
of a stretch is put together afterwards. Encodings are told by the same sums, for no line end lies inside a character.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrloom.shared import write_table

#: Bytes that have no meaning in the Windows code page.
_UNDEFINED = bytes([0x81, 0x8D, 0x8F, 0x90, 0x9D])
#: Room for the records of one stretch in ``_ord``.
STRETCH_ROWS = 1 << 33
WHOLE, BEGINS, GOES_ON, ENDS = 0, 1, 2, 3


def stays_open(line: bytes, inside: bool) -> bool:
    """Whether a line ends inside quotes, given whether it begins so. Quotes count at the beginning of a field only."""
    i = 0
    if not inside and line[:1] == b'"':
        inside, i = True, 1
    while True:
        if inside:
            i = line.find(b'"', i)
            while i >= 0 and line[i + 1 : i + 2] == b'"':
                i = line.find(b'"', i + 2)
            if i < 0:
                return True
            inside, i = False, i + 1
        i = line.find(b",", i) + 1
        if not i:
            return False
        if line[i : i + 1] == b'"':
            inside, i = True, i + 1


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each stretch that a task reads: how it ends if it begins outside quotes and if inside, and what its bytes may be."""
    names = ["file", "block", "closed", "open", "utf8", "windows"]
    found: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        for file, block, line in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("line").to_pylist(), strict=True):
            s = found.setdefault((file, block), [False, True, True, True])
            if b'"' in line:
                s[0], s[1] = stays_open(line, s[0]), stays_open(line, s[1])
            if not line.isascii():
                try:
                    line.decode("utf-8")
                except UnicodeDecodeError:
                    s[2] = False
                s[3] &= not any(b in line for b in _UNDEFINED)
    rows = [(*k, *v) for k, v in found.items()]
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.string(), pa.int64(), *[pa.bool_()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and, at the edges of a stretch, parts of them, decoded and numbered."""
    at: tuple[int, str] | None = None
    inside, begun, nth, held = False, False, 0, []

    def kind() -> int:
        return (GOES_ON if inside else ENDS) if begun else (BEGINS if inside else WHOLE)

    for batch in batches:
        out: list[tuple] = []
        for stretch, opened, encoding, line in zip(*(batch.column(c).to_pylist() for c in ("stretch", "opened", "encoding", "line")), strict=True):
            if at is None or at[0] != stretch:
                if held:
                    out.append((at[0], nth, kind(), b"\n".join(held).decode(at[1], "replace")))
                at, inside, begun, nth, held = (stretch, encoding), opened, opened, 0, []
            held.append(line)
            inside = stays_open(line, inside)
            if not inside:
                out.append((stretch, nth, kind(), b"\n".join(held).decode(encoding, "replace")))
                nth, held, begun = nth + 1, [], False
        yield _records(out)
    if held:
        yield _records([(at[0], nth, kind(), b"\n".join(held).decode(at[1], "replace"))])


def _records(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["stretch", "nth", "kind", "record"])


def fields_of(record: str) -> list[list[str]]:
    """The rows of one record's text: one, or more where bare carriage returns end lines."""
    csv.field_size_limit(1 << 30)
    return [r for r in csv.reader(io.StringIO(record.rstrip("\r"), newline="")) if r]


def _column_names(header: list[str]) -> list[str]:
    """The names as they are; an empty one by its place, a repeated one with its place behind it."""
    known = [h.lower() for h in header]
    return [f"_c{i}" if not h else f"{h}{i}" if known.count(h.lower()) > 1 else h for i, h in enumerate(header)]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(stretch, nth, head, record)``: the records of all files under ``path``, decoded; stretches are numbered in the order of file
    and place, and head says that one begins its file.

    UTF-8 where all bytes of a file are; else the Windows code page where all bytes have a meaning in it, else Latin-1. A record
    whose quotes never close goes on to the end of its file. The sums of the stretches are written to the shared folder.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    sums = lines.mapInArrow(_summed, "file string, block long, closed boolean, open boolean, utf8 boolean, windows boolean")
    sums = write_table(sums, "stretches")
    in_file, so_far = Window.partitionBy("file"), Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row a stretch. A stretch that ends alike either way decides; those since then turn the bit or leave it.
    fixed, turns = F.col("closed") == F.col("open"), F.col("closed") & ~F.col("open")
    start = F.coalesce(F.last(F.when(fixed, F.col("closed")), ignorenulls=True).over(so_far), F.lit(False))
    told = sums.withColumn("start", start).withColumn("turned", turns.cast("int"))
    total = told.withColumn("all_turns", F.coalesce(F.sum("turned").over(so_far), F.lit(0)))
    before = F.coalesce(F.max(F.when(fixed, F.col("all_turns"))).over(so_far), F.lit(0))
    encoding = F.when(F.min("utf8").over(in_file), "utf-8").when(F.min("windows").over(in_file), "cp1252").otherwise("latin-1")
    stretches = total.select(
        "file", "block", (F.row_number().over(Window.orderBy("file", "block")) - 1).cast("long").alias("stretch"),
        (F.col("start").cast("int") + F.col("all_turns") - before).bitwiseAND(1).cast("boolean").alias("opened"), encoding.alias("encoding"))
    stretches = write_table(stretches, "stretches")
    # Rows of a stretch stay in their order: the small side is broadcast, one row for each split that Spark reads.
    cut = lines.join(F.broadcast(stretches), ["file", "block"]).select("stretch", "opened", "encoding", "line").mapInArrow(_cut, "stretch long, nth long, kind int, record string")
    cut = cut.join(F.broadcast(stretches.select("stretch", "file", (F.col("block") == 0).alias("head"))), "stretch")
    done = cut.where(F.col("kind") == WHOLE).select("stretch", "nth", "head", "record")
    parts = write_table(cut.where(F.col("kind") != WHOLE), "edges-of-stretches")
    if not parts.head(1):
        return done
    order = Window.partitionBy("file").orderBy("stretch", "nth")
    parts = parts.withColumn("of", F.sum((F.col("kind") == BEGINS).cast("int")).over(order))
    joined = parts.groupBy("file", "of").agg(F.array_sort(F.collect_list(F.struct("stretch", "nth", "head", "record"))).alias("p"))
    whole = joined.select(*[F.col("p")[0][c].alias(c) for c in ("stretch", "nth", "head")], F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    return done.unionByName(whole)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, none null, with ``_ord``, which grows with file and place and so doesn't depend on how files are split.

    Each file's first record is its header; the names are those of the first file. Short rows are filled up, what a row has beyond
    the header is left out, empty lines are no rows. No rows at all, no columns.
    """
    records = read_records(spark, path)
    first = records.where("head and nth = 0").orderBy("stretch").first()
    header = fields_of(first["record"].removeprefix("\ufeff"))[0] if first else []
    names, n = _column_names(header), len(header)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders, rows = [], []
            for stretch, nth, head, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, row in enumerate(fields_of(record)):
                    if not (head and nth == 0 and i == 0):
                        orders.append(stretch * STRETCH_ROWS + nth)
                        rows.append([*row[:n], *[""] * (n - len(row))])
            cols = list(zip(*rows, strict=True)) or [[]] * n
            yield pa.RecordBatch.from_arrays([*[pa.array(list(c), pa.string()) for c in cols], pa.array(orders, pa.int64())], [*[f"c{i}" for i in range(n)], "_ord"])

    found = records.mapInArrow(run, ", ".join([*[f"c{i} string" for i in range(n)], "_ord long"]))
    return found.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)], "_ord")
