"""Candidate pairs for a similarity ratio by an equi-join on grams, so that texts needn't all meet.

The ratio is 2M/S: S characters in both texts, M of them in matching runs. Between two runs some character is left
out, so there are at most S - 2M + 1 runs, and a run of n characters holds n - q + 1 grams of q characters. Texts of a
ratio thus share at least M - (q - 1)(S - 2M + 1) grams. Of two sets that share t members, the first n - t + 1 of each,
in any order common to both, share one: grams are ordered from rare to common, so the joined ones are the rare ones.
No pair is lost, and none is returned twice. The matching runs are a common subsequence, so one text becomes the other by
S - 2M insertions and deletions, each of which turns one bit of a signature: texts further apart than that are left out
before anything dearer is asked of them.
"""

from __future__ import annotations

from math import inf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.shared import drop_table, write_table

#: Sizes of grams. The size is the largest of which a pair as long as its longer text must share one.
SIZES = (1, 2, 3)


def _shared(total: Column | float, least: float, q: int) -> Column | float:
    """How many grams of ``q`` characters two texts of a ratio of ``least`` share, given the characters in both."""
    return (2 * q - 1) * least / 2 * total - (q - 1) * (total + 1)


def _shortest(least: float, q: int) -> float:
    """The length from which a longer text is sure to share a gram of ``q`` characters with whatever is similar."""
    slope = _shared(1.0, least, q) - _shared(0.0, least, q)
    return (1 - _shared(0.0, least, q)) / slope * (2 - least) / 2 if slope > 0 else inf


def _size(length: Column, least: float) -> Column:
    bounds = sorted((q for q in SIZES if q > 1 and _shortest(least, q) < inf), reverse=True)
    size = F.lit(1)
    for q in reversed(bounds):
        size = F.when(length >= F.lit(_shortest(least, q)), F.lit(q)).otherwise(size)
    return size


def _per_size(least: float, total: Column) -> Column:
    """The number of shared grams of the row's size ``q``, one at least; a little is taken off for rounding."""
    some = F.lit(None)
    for q in SIZES:
        some = F.when(F.col("q") == q, F.ceil(_shared(total, least, q) - F.lit(1e-6))).otherwise(some)
    return F.greatest(F.lit(1), some).cast("int")


def _cut(text: Column, q: Column) -> Column:
    """The grams of a text, sorted."""
    return F.array_sort(F.transform(F.sequence(F.lit(1), (F.length(text) - q + 1).cast("int")), lambda i: F.substring(text, i, q)))


def _told(cut: str) -> Column:
    """Hashes of sorted grams; a repeated one is told from the others by its place among them."""
    return F.transform(cut, lambda g, i: F.xxhash64(g, i - F.array_position(cut, g)))


def with_letters(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with a signature of 64 bits of the letters of a text that isn't empty: each letter more or less turns one bit."""
    cut = rows.withColumn(name, _cut(F.col(text), F.lit(1)))
    one = F.lit(1).cast("long")
    bits = F.transform(_told(name), lambda h: F.call_function("shiftleft", one, F.pmod(h, F.lit(64)).cast("int")))
    return cut.withColumn(name, F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b)))


def _edits(total: Column, least: float) -> Column:
    return F.floor(F.lit(1 - least + 1e-9) * total + F.lit(1e-6))


def _sides(rows: DataFrame, least: float) -> DataFrame:
    """Every row once for each size of grams that it may be met by, with its grams, the rarest first, and how many of them it is
    filed under as either text of a pair."""
    length = F.length("text")
    longest = F.floor(length * F.lit((2 - least) / least) + F.lit(1e-6))
    sized = rows.where(length > 0).select("id", "text", F.explode(F.sequence(_size(length, least), _size(longest, least))).alias("q"))
    sized = sized.where(length >= F.col("q"))
    each = sized.select("id", "q", _cut(F.col("text"), F.col("q")).alias("cut")).select("id", "q", F.explode(_told("cut")).alias("gram"))
    each = write_table(each, "grams")
    often = write_table(each.groupBy("q", "gram").agg(F.count("*").alias("n")), "gram-counts")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "gram"))), lambda g: g["gram"])
    found = each.join(often, ["q", "gram"]).groupBy("id", "q").agg(ordered.alias("grams"))
    found = with_letters(found.join(rows, "id"), "text", "letters").withColumn("len", length)

    def first(total: Column) -> Column:
        return F.greatest(F.lit(0), F.size("grams") - _per_size(least, total) + 1)

    as_longer = F.when(F.col("q") == _size(length, least), first(F.col("len") * F.lit(2 / (2 - least))))
    sides = write_table(found.withColumn("as_longer", as_longer).withColumn("as_shorter", first(F.col("len") * 2)), "gram-sides")
    drop_table(each)
    drop_table(often)
    return sides


def close(a: str, b: str, total: Column, least: float) -> Column:
    """Whether the signatures of two texts with so many letters in both differ by no more than the ratio allows."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= _edits(total, least)


def may_reach(a: str, b: str, least: float) -> Column:
    """Whether two texts are near enough for the ratio, by the edits between them: a bound in columns, before any Python."""
    return F.levenshtein(F.col(a), F.col(b)) <= _edits(F.length(a) + F.length(b), least)


def near_candidates(rows: DataFrame, least: float, keys: list[str] | None = None, met: list[tuple[Column, Column]] | None = None) -> DataFrame:
    """``(x, x_text, y, y_text)``: each pair of rows that may reach the ratio ``least``, once; x is the longer text.

    rows: ``id``, ``text`` and whatever else is named here; a pair agrees in ``keys``, none of which is null. met: conditions
    on the longer and the shorter text's row, any one of which a pair has to pass; they must exclude each other.
    Empty and null texts meet nothing, equal texts meet. Ids are unique. Jobs run here.
    """
    if not 0 < least <= 1:
        raise ValueError("least is above 0 and 1 at most")
    sides, keys = _sides(rows, least), keys or []
    out = None
    for longer, shorter in met or [(F.lit(True), F.lit(True))]:
        # What a row is met by is one number, and its grams stay behind: rows are moved once for each gram.
        def filed(name: str, which: str, under: str) -> DataFrame:
            first = F.slice("grams", F.lit(1), F.col(under))
            each = sides.where(which).where(F.col(under).isNotNull()).select(*keys, "q", F.col("id").alias(name), F.col("text").alias(f"{name}_text"), F.col("letters").alias(f"{name}_letters"), F.explode(first).alias("gram"))
            return each.select(F.xxhash64(*keys, "q", "gram").alias("at"), name, f"{name}_text", f"{name}_letters")

        one, two = filed("x", longer, "as_longer"), filed("y", shorter, "as_shorter")
        x_len, y_len = F.length("x_text"), F.length("y_text")
        ordered = (y_len < x_len) | ((y_len == x_len) & (F.col("y") < F.col("x")))
        near = 2.0 * y_len >= F.lit(least - 1e-9) * (x_len + y_len)
        # What costs most is asked inside the condition of what costs least: Spark would else work it out first for all that meet.
        cheap = ordered & near & close("x_letters", "y_letters", x_len + y_len, least)
        met_here = one.join(two, "at").where(F.when(cheap, may_reach("x_text", "y_text", least)).otherwise(False))
        found = met_here.select("x", "x_text", "y", "y_text").distinct()  # met at several grams
        out = found if out is None else out.unionByName(found)
    if keys:  # numbers of different keys may agree
        of = rows.select("id", F.struct(*keys).alias("of"))
        out = out.join(of.toDF("x", "x_of"), "x").join(of.toDF("y", "y_of"), "y").where("x_of = y_of").drop("x_of", "y_of")
    return out
