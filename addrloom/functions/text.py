"""Text, state and postal code functions as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R


def clean(c: Column) -> Column:
    """Nothing is missing: null is the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once: where it is named often, plans would else repeat all of it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def settled(value: Column) -> Column:
    """``value``, planned as if it could vary: a filter on it or on its neighbours isn't moved below, where all would be worked out again."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


#: White space of any script, which is what ``(?U)\s`` matches.
SPACES = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


#: What a text holds whose white space isn't single plain spaces alone, or that isn't plain ASCII: looked for before dearer patterns.
_UNEVEN = "[^ -~]|  "


def squeeze(c: Column) -> Column:
    """Runs of white space, of any script, become one space; none at the ends."""
    return let(c, lambda s: F.trim(F.when(s.rlike(_UNEVEN), F.regexp_replace(s, rf"[{SPACES}]+", " ")).otherwise(s)))


def strip(c: Column) -> Column:
    """No white space of any script at either end."""
    return F.btrim(c, F.lit(SPACES))


def words(c: Column) -> Column:
    """White-space separated words; none for blank text."""
    return F.filter(F.split(squeeze(c), " "), lambda w: w != "")


def joined(array: Column, sep: str = " ") -> Column:
    return F.array_join(array, sep)


def title(c: Column) -> Column:
    """Every run of letters starts with a capital and goes on small."""

    def any_text(s: Column) -> Column:
        runs = F.regexp_extract_all(s, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
        return joined(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))), "")

    return let(c, lambda s: F.when(s.rlike("^[A-Za-z ]*$"), F.initcap(s)).otherwise(any_text(s)))  # letters and spaces: the built-in does the same


def title_column(c: Column) -> Column:
    return squeeze(title(strip(c)))


def lookup(table: dict[str, str], key: Column) -> Column:
    """The table's value, null where it has none. Maps are searched from end to end, so keys are held against a set first."""
    return F.when(key.isin(list(table)), F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key))


def code_in(c: Column, *codes: list[str]) -> Column:
    return F.upper(strip(c)).isin(*[x for some in codes for x in some])


def is_us_state(c: Column) -> Column:
    return code_in(c, R.US_STATES, R.TERRITORIES)


def is_canadian_province(c: Column) -> Column:
    return code_in(c, R.PROVINCES)


def is_military_state(c: Column) -> Column:
    return code_in(c, R.MILITARY)


def is_valid_state(c: Column) -> Column:
    return code_in(c, R.US_STATES, R.TERRITORIES, R.MILITARY, R.PROVINCES)


def normalize_state(c: Column) -> Column:
    return F.when(is_valid_state(c), F.upper(strip(c))).otherwise("")


def normalize_zip(c: Column) -> Column:
    """Five digits, or what digits there are; ``A1A 1A1`` for a Canadian code; other text with letters in capitals."""

    def normal(s: Column) -> Column:
        solid = F.replace(s, F.lit(" "), F.lit(""))
        canadian = F.concat(F.upper(F.substring(solid, 1, 3)), F.lit(" "), F.upper(F.substring(solid, 4, 3)))
        lettered = F.when(solid.rlike(R.POSTAL_CODE), canadian).otherwise(squeeze(F.upper(s)))
        return F.when(s.rlike(r"\p{L}"), lettered).otherwise(F.substring(F.regexp_replace(s, r"[^0-9]", ""), 1, 5))

    return let(strip(c), normal)


def zip_is_valid(zip_: Column, state: Column) -> Column:
    z = strip(zip_)
    return F.when(z == "", True).when(is_canadian_province(state), z.rlike(r"^[A-Z]\d[A-Z]\s?\d[A-Z]\d$")).otherwise(z.rlike(r"^\d{5}$"))


def null_like_address(c: Column) -> Column:
    return c.rlike(R.NULL_ADDRESS)


def null_like(c: Column) -> Column:
    return c.rlike(R.NULL_NAME)


def null_like_parcel(c: Column) -> Column:
    return c.rlike(R.NULL_PARCEL)


def is_undeliverable(c: Column) -> Column:
    return c.rlike(R.UNDELIVERABLE)


def is_routing_line(c: Column) -> Column:
    return c.rlike(R.ROUTING_LINE)


def raw_copy(c: Column) -> Column:
    """The source's text for lineage, blank where it says nan or none."""
    s = strip(c)
    return F.when(F.lower(s).isin("nan", "none"), "").otherwise(s)


def city_state_zip(c: Column) -> Column:
    """City, state and ZIP of a combined value, blank where it isn't one."""
    s = strip(c)
    part = [strip(F.regexp_extract(s, "(?i)^" + R.CITY_STATE_ZIP[4:], i)) for i in (1, 2, 3)]
    return F.struct(part[0].alias("city"), part[1].alias("state"), part[2].alias("zip"))
