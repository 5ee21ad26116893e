"""Grouping by exact key, similar pairs within a block, similar company names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.functions import rules as R
from addrloom.functions.address import address_key, extract_po_box, extract_unit, is_po_box, normalize_for_matching, remove_unit
from addrloom.functions.household import ratio
from addrloom.functions.names import comparison_key, display_order, format_company, without_noise
from addrloom.functions.text import clean, is_undeliverable, let, normalize_zip, null_like, strip
from addrloom.operators.components import connected_components
from addrloom.operators.grams import close, may_reach, near_candidates, with_letters
from addrloom.shared import write_table


def second_line_key(c: Column) -> Column:
    """Second lines compare in small letters, with ``&`` for and."""
    return F.regexp_replace(F.lower(strip(c)), r"(?U)\band\b", "&")


def has_no_street(street: Column) -> Column:
    s = strip(street)
    return (s == "") | null_like(s) | is_undeliverable(s)


def exact_key(unit_mode: str = "reference") -> Column:
    """What rows are grouped by. Rows without a usable street have a key of their own; boxes go by box and place.

    An address with both a rural route and a box has no box to extract and so the key ``None``. Null columns count as
    blank. The key says of itself that it is never null: a join on it would else work it out twice, once to find nulls.
    """
    place = [strip(clean(F.col(c))) for c in ("city", "state", "zip")]
    keyed = let(strip(F.col("street")), lambda street: _street_key(street, *place, unit_mode))
    second = let(second_line_key(clean(F.col("second_line"))), lambda s: F.when(s == "", "").otherwise(F.concat(F.lit("|"), s)))
    key = F.when(has_no_street(clean(F.col("street"))), F.concat(F.lit("NO_STREET::"), F.col("_ord"))).otherwise(F.concat(keyed, second))
    return F.coalesce(key, F.lit(""))


def _street_key(street: Column, city: Column, state: Column, zip_: Column, unit_mode: str) -> Column:
    box = F.concat_ws("|", F.coalesce(extract_po_box(street), F.lit("None")), F.upper(city), F.upper(state), normalize_zip(zip_))
    return F.when(is_po_box(street), box).otherwise(address_key(street, city, state, zip_, unit_mode))


def exact_groups(rows: DataFrame, unit_mode: str = "reference") -> DataFrame:
    """One row a key: how many rows it has and the first one's place."""
    return rows.select(exact_key(unit_mode).alias("key"), "_ord").groupBy("key").agg(F.count("*").alias("n"), F.min("_ord").alias("first_ord"))


def match_columns(rows: DataFrame, unit_mode: str = "reference") -> DataFrame:
    """What pairs are compared by, computed once a row."""
    street = F.col("street")
    rows = rows.withColumn("base", normalize_for_matching(remove_unit(street)))
    return rows.select(
        "_ord",
        F.concat_ws("|", F.upper(strip(F.col("city"))), F.upper(strip(F.col("state"))), normalize_zip(F.col("zip"))).alias("block"),
        second_line_key(F.col("second_line")).alias("second"),
        is_po_box(street).alias("po"),
        F.coalesce(extract_po_box(street), F.lit("")).alias("box"),
        F.coalesce(extract_unit(street, unit_mode), F.lit("")).alias("unit"),
        "base",
        F.regexp_extract("base", r"^(\d+)", 1).alias("house"),
    )


def gated_pairs(rows: DataFrame, least: float = R.ADDRESS_RATIO) -> DataFrame:
    """Pairs of one block that no rule keeps apart, the earlier row first, with ``sure`` where no ratio is needed.

    Boxes must be equal, and never meet streets; units must be equal; second lines may differ only if one is
    blank. House numbers must agree where both have one, so they are part of the join key; addresses without
    one meet all of their block and unit. A pair whose lengths rule the ratio out is left out too.
    """
    rows = write_table(rows, "match")  # read for every kind of pair
    names = [c for c in rows.columns if c not in ("block", "unit", "house", "box")]

    def pairs(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
        one = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in names])
        two = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in names])
        return one.join(two, list(keys)).select(*[f"{s}_{c}" for s in "ab" for c in names])

    boxes, streets = rows.where("po"), rows.where("not po and base <> ''")
    numbered, open_ = streets.where("house <> ''"), streets.where("house = ''")
    swap = [F.col(f"{'ba'[i]}_{c}").alias(f"{s}_{c}") for i, s in enumerate("ab") for c in names]
    first = F.col("a__ord") < F.col("b__ord")
    found = pairs(numbered, numbered, "block", "unit", "house").where(first).unionByName(pairs(open_, open_, "block", "unit").where(first))
    mixed = pairs(numbered, open_, "block", "unit")
    found = found.unionByName(mixed.where(first)).unionByName(mixed.where(~first).select(*swap))
    found = found.withColumn("sure", F.col("a_base") == F.col("b_base"))
    found = found.unionByName(pairs(boxes, boxes, "block", "box").where(first).withColumn("sure", F.lit(True)))
    la, lb = F.length("a_base"), F.length("b_base")
    near = F.col("sure") | (2.0 * F.least(la, lb) >= least * (la + lb))
    apart = (F.col("a_second") != "") & (F.col("b_second") != "") & (F.col("a_second") != F.col("b_second"))
    return found.where(near & ~apart).select(F.col("a__ord").alias("a"), F.col("b__ord").alias("b"), "a_base", "b_base", "sure")


#: Addresses of one block, unit and house number up to which all are held against each other; more of them meet by grams. Both
#: ways lead to the same pairs.
ALL_PAIRS = 32


def address_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that compare alike in everything are one class: ``(_ord, id)`` of each row that can meet others, and the classes.

    A class has ``id`` and ``last``, its first and last row; ``address``, the first row of its address whatever the second line;
    and what it is compared by. Boxes are compared by number alone, streets by all but the box. Both tables are written.
    """
    po = F.col("po")
    keyed = rows.select("_ord", "block", "po", F.when(po, F.col("box")).otherwise("").alias("box"), *[F.when(po, "").otherwise(F.col(c)).alias(c) for c in ("unit", "base", "house")], "second")
    keyed = write_table(keyed.withColumn("key", F.xxhash64("block", "po", "box", "unit", "base")), "match").where("po or base <> ''")  # before, the filter would work out all columns again
    address = ["key", "block", "po", "box", "unit", "base", "house"]
    classes = keyed.groupBy(*address, "second").agg(F.min("_ord").alias("id"), F.max("_ord").alias("last"))
    firsts = keyed.groupBy(*address).agg(F.min("_ord").alias("address"))
    classes = write_table(classes.join(firsts, address), "classes")
    # The rows of a hot address are many, its classes are not: adaptive execution splits the rows' side.
    members = keyed.join(classes.select(*address, "second", "id"), [*address, "second"]).select("_ord", "id")
    return members, classes


def _address_pairs(addresses: DataFrame, least: float) -> DataFrame:
    """``(x, x_text, x_last, y, y_text, y_last)``: pairs of different addresses that may reach the ratio and that no rule keeps
    apart, each once. addresses: ``id, last, block, unit, house, text``."""
    spot, place = ["block", "unit", "house"], ["block", "unit"]
    sizes = addresses.groupBy(*spot).agg(F.count("*").alias("here"))
    around = sizes.groupBy(*place).agg(F.sum("here").alias("every"), F.sum(F.when(F.col("house") == "", F.col("here")).otherwise(0)).alias("open_"))
    sized = write_table(with_letters(addresses.join(sizes, spot).join(around, place), "text", "letters"), "addresses")
    numbered, opened = sized.where("house <> ''"), F.col("house") == ""
    many = F.col("open_") * F.col("every") > ALL_PAIRS * ALL_PAIRS

    def side(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        return df.select(*keys, F.col("id").alias(name), F.col("text").alias(f"{name}_text"), F.col("last").alias(f"{name}_last"), F.length("text").alias(f"{name}_len"), F.col("letters").alias(f"{name}_letters"), (F.col("house") != "").alias(f"{name}_numbered"))

    def each(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        lengths = F.col("x_len") + F.col("y_len")
        return side(a, "x", keys).join(side(b, "y", keys), keys).where(F.when((2.0 * F.least("x_len", "y_len") >= F.lit(least) * lengths) & close("x_letters", "y_letters", lengths, least), may_reach("x_text", "y_text", least)))

    def grams(df: DataFrame, keys: list[str], met: list[tuple[Column, Column]] | None = None) -> DataFrame:
        found = near_candidates(df.select("id", "text", *dict.fromkeys([*keys, "house"])), least, keys, met)
        last = df.select("id", "last")
        return found.join(last.toDF("x", "x_last"), "x").join(last.toDF("y", "y_last"), "y")

    few = numbered.where(F.col("here") <= ALL_PAIRS)
    parts = [each(few, few, spot).where("x < y"), each(sized.where(opened & ~many), sized.where((F.col("open_") > 0) & ~many), place).where("x < y or y_numbered")]
    crowded, lively = numbered.where(F.col("here") > ALL_PAIRS), sized.where((F.col("open_") > 0) & many)
    if crowded.head(1):
        parts.append(grams(crowded, spot))
    if lively.head(1):
        parts.append(grams(lively, place, [(opened, opened), (opened, ~opened), (~opened, opened)]))
    return reduce(DataFrame.unionByName, [p.select("x", "x_text", "x_last", "y", "y_text", "y_last") for p in parts])


def class_links(classes: DataFrame, least: float = R.ADDRESS_RATIO) -> DataFrame:
    """``(a, b, ab, ba, sure)``: classes whose rows are one address, each pair once at least; a class with itself is left out.

    ab: a row of a and a later one of b are; ba: the other way round (the ratio depends on the order). Classes of one address are, if
    their second lines are equal or one is blank; those of similar ones are too. Links are as many as classes, not as their pairs:
    second lines meet by equality, or through the blank one.
    """
    yes = F.lit(True)
    blank, other = classes.where("second = ''"), classes.where("second <> ''")
    here = blank.select("address", F.col("id").alias("a")).join(other.select("address", F.col("id").alias("b")), "address").select("a", "b", yes.alias("ab"), yes.alias("ba"), yes.alias("sure"))
    streets = classes.where("not po")
    addresses = streets.groupBy("block", "unit", "house", F.col("base").alias("text")).agg(F.min("id").alias("id"), F.max("last").alias("last"))
    pairs = _address_pairs(addresses, least)
    ways = F.array(*[F.when(F.col(a) < F.col(f"{b}_last"), F.struct(F.lit(a == "x").alias("forth"), F.col(f"{a}_text").alias("one"), F.col(f"{b}_text").alias("two"))) for a, b in ("xy", "yx")])
    tried = pairs.select("x", "y", F.explode(F.filter(ways, lambda w: w.isNotNull())).alias("w"))
    alike = tried.withColumn("r", ratio(F.col("w.one"), F.col("w.two"), least)).where(F.col("r") >= least)
    alike = write_table(alike.groupBy("x", "y").agg(F.max(F.col("w.forth")).alias("ab"), F.max(~F.col("w.forth")).alias("ba")), "alike")

    def side(df: DataFrame, address: str, name: str, *more: str) -> DataFrame:
        return df.select(F.col("address").alias(address), *more, F.col("id").alias(name), F.col("last").alias(f"{name}_last"))

    empty, told = streets.where("second = ''"), streets.where("second <> ''")
    same = alike.join(side(streets, "x", "a", "second"), "x").join(side(streets, "y", "b", "second"), ["y", "second"])
    left = alike.join(side(empty, "x", "a"), "x").join(side(told, "y", "b"), "y")
    right = alike.join(side(told, "x", "a"), "x").join(side(empty, "y", "b"), "y")
    cols = ["a", "b", "ab", "ba", "a_last", "b_last"]
    near = same.select(*cols).unionByName(left.select(*cols)).unionByName(right.select(*cols))
    near = near.where((F.col("ab") & (F.col("a") < F.col("b_last"))) | (F.col("ba") & (F.col("b") < F.col("a_last"))))
    return here.unionByName(near.select("a", "b", "ab", "ba", F.lit(False).alias("sure")))


def similar_links(rows: DataFrame, least: float = R.ADDRESS_RATIO) -> DataFrame:
    """``(a, b, sure)``: links enough to make the components of rows that are one address, as many as rows and alike classes."""
    members, classes = address_classes(rows)
    inside = members.where("_ord <> id").select(F.col("id").alias("a"), F.col("_ord").alias("b"), F.lit(True).alias("sure"))
    return inside.unionByName(class_links(classes, least).select("a", "b", "sure"))


def similar_pairs(rows: DataFrame, least: float = R.ADDRESS_RATIO) -> DataFrame:
    """``(a, b)``: every pair of rows that is one address, the earlier row first. Clusters take :func:`similar_links`, which are fewer."""
    members, classes = address_classes(rows)
    yes = F.lit(True)
    own = classes.where("id <> last").select(F.col("id").alias("a"), F.col("id").alias("b"), yes.alias("ab"), yes.alias("ba"))
    links = own.unionByName(class_links(classes, least).select("a", "b", "ab", "ba"))
    both = links.join(members.toDF("p", "a"), "a").join(members.toDF("q", "b"), "b")
    out = both.select(F.when(F.col("ab") & (F.col("p") < F.col("q")), F.struct(F.col("p").alias("a"), F.col("q").alias("b"))).when(F.col("ba") & (F.col("q") < F.col("p")), F.struct(F.col("q").alias("a"), F.col("p").alias("b"))).alias("s"))
    return out.where("s is not null").select("s.*").distinct()


def address_clusters(rows: DataFrame, least: float = R.ADDRESS_RATIO) -> DataFrame:
    """``(_ord, cluster)`` of rows that are one address with another, however many steps away; cluster: the first row."""
    parts = connected_components(similar_links(rows, least))
    return parts.select(F.col("node").alias("_ord"), F.col("component").alias("cluster"))


def same_place(a: str, b: str) -> Column:
    """Whether two sides of a join are in one city, state and ZIP."""
    def place(side: str) -> Column:
        return F.struct(*[F.upper(strip(F.col(f"{side}.{c}"))) for c in ("city", "state")], normalize_zip(F.col(f"{side}.zip")))

    return place(a) == place(b)


def canonical_names(names: DataFrame, name: str = "name", least: float = R.ENTITY_RATIO) -> DataFrame:
    """``(name, canonical)`` for each distinct name: of similar names the one with most words, then the longest, for print.

    Names of one key are one. Keys are compared if they share grams that the ratio forces them to share. The ratio depends on
    which key comes first, so it is asked for in each order in which two names come.
    """
    first = names.groupBy(name).agg(F.min("_ord").alias("_ord")) if "_ord" in names.columns else names.select(name).distinct().withColumn("_ord", F.xxhash64(name))
    keyed = write_table(first.withColumn("key", comparison_key(F.col(name))), "name-keys")
    keys = keyed.where("key <> ''").groupBy("key").agg(F.min("_ord").alias("id"), F.max("_ord").alias("last"))
    some = near_candidates(keys.select("id", F.col("key").alias("text"), "last"), least)
    last = keys.select("id", "last")
    some = some.join(last.toDF("x", "x_last"), "x").join(last.toDF("y", "y_last"), "y")
    both = F.array(*[F.when(F.col(a) < F.col(f"{b}_last"), F.struct(F.col(f"{a}_text").alias("one"), F.col(f"{b}_text").alias("two"))) for a, b in ("xy", "yx")])
    tried = some.select("x", "y", F.explode(F.filter(both, lambda p: p.isNotNull())).alias("p"))
    links = tried.withColumn("r", ratio(F.col("p.one"), F.col("p.two"), least)).where(F.col("r") >= least).select("x", "y")
    parts = connected_components(links, "x", "y").select(F.col("node").alias("id"), "component")
    of_key = keys.join(parts, "id", "left").select("key", F.coalesce("component", "id").alias("component"))
    placed = keyed.join(of_key, "key", "left").withColumn("component", F.coalesce("component", "_ord"))
    order = display_order(F.col(name))
    best = placed.groupBy("component").agg(F.max_by(name, F.struct(order["words"], order["length"], -F.col("_ord"))).alias("best"))
    return placed.join(best, "component").select(name, format_company(without_noise(F.col("best"))).alias("canonical"))
