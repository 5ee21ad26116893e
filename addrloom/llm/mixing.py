"""Mixing sources to target weights by Efraimidis-Spirakis keys and token budgets (native).

Per source: complete epochs first, then the fraction that is left, filled by ascending exponential keys
``-ln(u) / weight`` up to the budget. The order matters at one place only, where the budget ends. Sizes and keys
are worked out once and written down without the texts; sums over buckets of the key (combined before the
shuffle) find the bucket in which the budget ends, sums over finer buckets inside it the finer one, and only the
rows of that one, some millionths of a source, are put in order. A source with a third of all rows so never meets
in one task. The result is one threshold a source, against which every row is held where it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrloom.shared import write_table

from .common import WORD, broadcast_if_small, table, text_of, without

#: Buckets for each doubling of the key, and finer ones for each doubling. Most keys lie within some three doublings.
BUCKETS, FINER = 1 << 10, 1 << 20


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality_weight(text: Column, words: Column) -> Column:
    """1 for plain prose, falling towards 1/9 as marks of junk come to one or more a word."""
    marks = F.regexp_count(text, F.lit(r"[#*$%&|<>!]")).cast("double")
    return 1.0 / (1.0 + 8.0 * F.least(F.lit(1.0), marks / F.greatest(F.lit(1.0), words.cast("double"))))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from rows of ``(source, source_size)``, one row a source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times the sum of
    sizes. A target stops at ``most`` times its source's size; the excess goes to the others by weight
    until none is above. That fixed point is a water level: with sources sorted by cap / weight, the level
    is what remains after the caps below it, over the weights from it on. The list of sources, a row each, is
    sorted in one task; rows of documents never are.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    ranked = ranked.withColumn("cap", most * F.col("source_size"))
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    levels = ranked.withColumn("level", level)
    # Past the right place the levels fall: the largest of those that fit is the first.
    found = F.max(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))).over(Window.partitionBy())
    found = F.coalesce(found, F.lit(float("inf")))
    return levels.select("source", "source_size", F.least(F.col("cap"), found * F.col("w")).alias("target"))


def _bucket(fine: int) -> Column:
    return F.floor(F.log2("key") * fine)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, size: Column | None, quality: Column | None) -> DataFrame:
    """``(row, s, id, size, key)``: the row in one column, so that no name of the input can meet one of ours."""
    ident, text = F.col(f"`{id_col}`"), text_of(text_col)
    words = word_count(text) if size is None else size
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(F.col(f"`{source_col}`").alias("source")).alias("s"), ident.alias("id"), words.alias("size"), text.alias("text"), *([] if quality is None else [quality.alias("quality")]))
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double")
    weight = quality_weight(F.col("text"), F.col("size")) if quality is None else F.col("quality")
    return sized.select("row", "s", "id", "size", (-F.ln((u + 0.5) / float(2**52)) / weight).alias("key"))


def _first_over(sums: DataFrame, bucket: str) -> DataFrame:
    """Of each source the first bucket with which its sum passes what is left, and the sum before it."""
    running = F.sum("b").over(Window.partitionBy("s").orderBy(bucket))
    spans = sums.withColumn("before", F.coalesce(F.col("before"), F.lit(0)) + running - F.col("b"))
    return spans.where(F.col("before") + F.col("b") > F.col("left")).groupBy("s").agg(F.min(F.struct(bucket, "before")).alias("edge")).select("s", f"edge.{bucket}", "edge.before")


def thresholds(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(s, source_size, target, epochs, edge, last)`` from rows of ``(s, id, size, key)``, one row a source.

    A row is in the fraction if its fine bucket lies before ``edge``, or is ``edge`` and its (key, id) does not
    come after ``last``; a null edge takes all, a null last none of the edge's rows.
    """
    coarse = sized.groupBy("s", _bucket(BUCKETS).alias("coarse")).agg(F.sum("size").alias("b"))
    targets = source_targets(coarse.groupBy(F.col("s.source").alias("source")).agg(F.sum("b").alias("source_size")), weights, share, most)
    targets = targets.select(F.struct("source").alias("s"), "source_size", "target")
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = write_table(targets.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    few = broadcast_if_small(targets, 512)
    one = write_table(_first_over(coarse.join(few, "s").withColumn("before", F.lit(0).cast("long")), "coarse").join(targets.select("s", "left"), "s"), "edges")
    inside = sized.withColumn("coarse", _bucket(BUCKETS)).join(broadcast_if_small(one, 512), ["s", "coarse"])
    fine = inside.groupBy("s", "before", "left", _bucket(FINER).alias("edge")).agg(F.sum("size").alias("b"))
    two = write_table(_first_over(fine, "edge").join(targets.select("s", "left"), "s"), "edges")
    final = sized.withColumn("edge", _bucket(FINER)).join(broadcast_if_small(two, 512), ["s", "edge"])
    order = Window.partitionBy("s", "edge").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    at = F.col("before") + F.sum("size").over(order) - F.col("size")
    # The row at the end of the budget goes to the nearer side.
    fits = final.withColumn("fits", at + F.col("size") / 2 <= F.col("left")).where("fits").groupBy("s").agg(F.max(F.struct("key", "id")).alias("last"))
    return targets.drop("left").join(two.select("s", "edge"), "s", "left").join(fits, "s", "left")


def _taken(sized: DataFrame, limits: DataFrame) -> DataFrame:
    rows = sized.join(broadcast_if_small(limits, 1024), "s")
    fine, key = _bucket(FINER), F.struct("key", "id")
    within = F.col("edge").isNull() | (fine < F.col("edge")) | ((fine == F.col("edge")) & F.coalesce(key <= F.col("last"), F.lit(False)))
    return rows.withColumn("taken", (F.col("size") * (F.col("epochs") + within.cast("long"))).cast("long"))


def mix_sizes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5, most: float = 2.0, seed: int = 7, size: Column | None = None, quality: Column | None = None,
) -> DataFrame:
    """``(id, source, size, source_size, target, taken)`` of every row; taken: the words that the mix takes of it.

    A row is taken whole: 0 times, once, or as often as there are epochs. Key: from the MD5 of seed and id,
    so reruns agree; ties go by id. Null and empty texts have size 0 and are never taken; texts of any length are
    counted whole. A null id is text ``null`` for the key; a null source is a source of its own, last. Rows that
    repeat both id and key are taken alike, so that where the budget ends they come in or stay out together. No
    rows, no result. Jobs run here: sizes and keys are written down, then sums are.
    """
    kept = write_table(_sized(docs.select(*dict.fromkeys([id_col, text_col, source_col])) if size is None and quality is None else docs, id_col, text_col, source_col, seed, size, quality).drop("row"), "sizes")
    out = _taken(kept, thresholds(kept, weights, share, most))
    return out.select(F.col("id").alias(id_col), F.col("s.source").alias(source_col), "size", "source_size", "target", "taken")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5, most: float = 2.0, seed: int = 7, size: Column | None = None, quality: Column | None = None,
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``taken`` added, as :func:`mix_sizes` has them.

    Rows stay where they are: beyond a counted bound on the number of sources they are shuffled by source, and adaptive
    execution splits a large one. Input columns named like a result are replaced; any other name may occur.
    """
    docs = without(docs, "size", "source_size", "target", "taken")
    sized = _sized(docs, id_col, text_col, source_col, seed, size, quality)
    limits = thresholds(write_table(sized.drop("row"), "sizes"), weights, share, most)
    return _taken(sized, limits).select("row.*", "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns that it came with."""
    names, options = docs.columns, {"id_col": "doc_id", "text_col": "text", "source_col": "source", "seed": 7, "size": None, "quality": None} | options
    limit = {k: options.pop(k) for k in ("weights", "share", "most") if k in options}
    sized = _sized(docs, **options)
    out = _taken(sized, thresholds(write_table(sized.drop("row"), "sizes"), **limit)).where("taken > 0")
    times = F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))
    return out.select("row", times.alias("copy")).select("row.*").select(*[F.col(f"`{c}`") for c in names])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each of all ``documents``; null text: size 0, null source: the last one. See :func:`mix_sizes`."""
    return mix_sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH c AS (
  SELECT doc_id, source, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS size FROM documents
), k AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / (1.0 / (1.0 + 8.0 * least(1.0, len(regexp_extract_all(text, '[#*$%&|<>!]'))::DOUBLE / greatest(1.0, size::DOUBLE)))) AS key
  FROM c
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM c GROUP BY source
), w AS (
  SELECT *, 2.0 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM s
), l AS (
  SELECT *, (1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, least(cap, w * (SELECT max(CASE WHEN level <= cap / w THEN level END) FROM l)) AS target FROM l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t
), r AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS left_,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k.size AS at_
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target,
  (size * (epochs + CASE WHEN at_ + size / 2.0 <= left_ THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""
