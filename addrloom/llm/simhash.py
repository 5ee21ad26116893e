"""SimHash near-deduplication by pigeonhole blocks.

Fingerprints are split into ``distance + 3`` blocks. Two that differ in at most ``distance`` bits agree in at
least three blocks, so each fingerprint is filed under every choice of three and candidates are those
filed together; their Hamming distance is then verified. Copies share a fingerprint, and distinct
fingerprints alone are filed. A block with more than ``BLOCK_PAIRS`` fingerprints is not compared pair by
pair: two values differ in at most two bits exactly when some value lies within one bit of both, and
within a block that value agrees with the key. Every member is filed under itself and its one-bit neighbours
there; those filed together are links, at most 65 by construction. No link is lost and no group is squared.
Both ways give the same components: of a block they find exactly the pairs within the distance, directly or
through a chain of such pairs, since values filed under one neighbour differ in two bits at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.operators.components import connected_components
from addrloom.shared import write_table

from .common import broadcast_if_small, small_batches, table, text_of

BLOCK_PAIRS = 32


def fingerprint(text: bytes, words_each: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, A-Z lower-cased; a bit is set if over half the hashes set it."""
    words = text.lower().split()  # of bytes: A-Z alone, and exactly the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - words_each + 1)
    if n == 1:
        starts, ends = [0], [len(joined)]
    else:
        length = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length + 1) - 1
        starts, ends = (end - length)[:n].tolist(), end[words_each - 1 :].tolist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends)), repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [fingerprint(t or b"") for t in batch.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(out, np.uint64).view(np.int64))], ["id", "h", "fp"])


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def _blocks(distance: int) -> list[int]:
    """One mask for each choice of three of the blocks."""
    parts = [p.tolist() for p in np.array_split(np.arange(64), distance + 3)]
    return [_mask(sum(some, [])) for some in combinations(parts, 3)]


def near_links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """``(a, b)``: links between the distinct 64-bit values in column ``fp``, enough that components are exact.

    Any distance works with blocks of up to ``BLOCK_PAIRS`` values; for larger blocks the one-bit
    neighbours need distance 2 (or 1, where they are verified like other candidates).
    """
    if distance > 2:
        raise ValueError("blocks of any size are handled for distances up to 2")
    masks = _blocks(distance)
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    filed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.i", "k.key")
    sizes = filed.groupBy("i", "key").agg(F.count("*").alias("n")).where("n > 1")
    filed = write_table(filed.join(sizes, ["i", "key"]), "blocks")

    def near(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b)) <= distance

    small = filed.where(F.col("n") <= BLOCK_PAIRS).groupBy("i", "key").agg(F.collect_list("fp").alias("v"))
    pairs = small.select(F.explode("v").alias("a"), "v").select("a", F.explode(F.filter("v", lambda b: (b < F.col("a")) & near(F.col("a"), b))).alias("b"))

    one_bit = F.array(*[F.lit(_mask([b])) for b in range(64)])
    mask = reduce(lambda c, m: c.when(F.col("i") == m[0], F.lit(m[1])), enumerate(masks[1:], 1), F.when(F.col("i") == 0, F.lit(masks[0])))
    flips = F.transform(F.filter(one_bit, lambda b: b.bitwiseAND(F.col("mask")) == 0), lambda b: F.col("fp").bitwiseXOR(b))
    large = filed.where(F.col("n") > BLOCK_PAIRS).withColumn("mask", mask)
    large = large.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("mid")).distinct()
    stars = large.groupBy("mid").agg(F.collect_list("fp").alias("v")).where(F.size("v") > 1)
    stars = stars.select(F.array_min("v").alias("b"), F.explode("v").alias("a")).where((F.col("a") != F.col("b")) & near(F.col("a"), F.col("b"))) if distance == 2 else stars.select(F.explode("v").alias("a"), "v").select("a", F.explode(F.filter("v", lambda b: (b < F.col("a")) & near(F.col("a"), b))).alias("b"))
    return pairs.unionByName(stars.select("a", "b")).distinct()


def _links_of(docs: DataFrame, id_col: str, text_col: str, distance: int) -> tuple[DataFrame, DataFrame]:
    """``(id, h, fp)`` of every row, written down, and ``(fp, component, component_id)`` of every fingerprint.

    h: a 64-bit hash of the text, which with the id tells rows apart.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    fps = write_table(small_batches(rows).mapInArrow(_fingerprints, f"id {kind}, h long, fp long"), "fingerprints")
    values = fps.groupBy("fp").agg(F.min("id").alias("least"))
    parts = connected_components(near_links(values.select("fp"), distance))
    joined = values.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    return fps, joined.select("fp", "component").join(named, "component").select("fp", "component", "component_id")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2) -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row; component_id: the smallest id linked to it, however far.

    Null text is empty; texts without a word have fingerprint zero and link like any other; texts of any length are
    read whole. Ids are of any type that has an order. A null id never names a component unless all its ids are null;
    repeated rows are in one component. Other columns are not read, so their names don't matter. No rows, no result.
    Jobs run here: fingerprints are written down, then links and components are.
    """
    fps, named = _links_of(docs, id_col, text_col, distance)
    # Many rows may share one fingerprint: adaptive execution splits their side of this join.
    return fps.join(named, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2) -> DataFrame:
    """One row of each component, with the columns that it came with: that with the smallest id.

    Where several texts or rows have that id, the text with the smallest hash stays, and of rows that repeat both any
    one. Rows with a null id all stay, for they can't be named. Null and empty texts are one component. Columns
    may have any name; no rows, no result.
    """
    fps, named = _links_of(docs, id_col, text_col, distance)
    keys = fps.where("id is not null").join(named.select("fp", "component"), "fp").groupBy("component", "id", "h").agg(F.count("*").alias("n"))
    best = keys.groupBy("component").agg(F.min(F.struct("id", "h")).alias("best"))
    marks = keys.join(best, "component").select("id", "h", "n", (F.struct("id", "h") == F.col("best")).alias("stays")).where("not stays or n > 1")
    marks = write_table(marks, "near-copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(text_of(f"`{text_col}`")).alias("h"))
    gone, twice = marks.where("not stays").select("id", "h"), marks.where("stays").select("id", "h")
    kept = rows.join(broadcast_if_small(gone, 128), ["id", "h"], "left_anti")
    if twice.head(1):
        twice = broadcast_if_small(twice, 128)
        one = kept.join(twice, ["id", "h"], "left_semi").groupBy("id", "h").agg(F.first("row").alias("row"))
        kept = kept.join(twice, ["id", "h"], "left_anti").select("row").unionByName(one.select("row"))
    return kept.select("row.*")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all ``documents``; null text: fingerprint zero. See :func:`near_copies`."""
    return near_copies(table(spark, sf_dir, "documents"))
