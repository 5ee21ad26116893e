"""Postal addresses as columns: boxes, routes, units, the form for matching, the key and the form for print."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .text import clean, joined, let, lookup, normalize_zip, null_like_address, squeeze, strip, title, words

#: Stands for "State Route" while street types are replaced.
_ROUTE = "\ue000"


def _found(c: Column, pattern: str, value: Column) -> Column:
    return F.when(c.rlike(pattern), value)


def _may_be_box(c: Column) -> Column:
    """Whether a text has what all patterns of boxes need; few have, and the patterns are dear."""
    return c.rlike("[Bb][Oo][Xx]|[Pp][Oo][Bb]")


def _may_have_unit(up: Column) -> Column:
    """Whether a text in capitals has a word that units begin with, inside others too."""
    return reduce(Column.__or__, [up.contains(w) for w in ("STE", "SUITE", "UNIT", "APT", "APARTMENT", "LOT", "SPACE", "SPC", "BLDG", "BUILDING", "FL", "RM", "ROOM", "#")])


def _without_unit(c: Column, up: Column) -> Column:
    return F.when(_may_have_unit(up), F.regexp_replace(c, R.UNIT_TAIL, "")).otherwise(c)


def is_po_box(c: Column) -> Column:
    return _may_be_box(clean(c)) & clean(c).rlike(R.PO_BOX)


def is_rural_route(c: Column) -> Column:
    return clean(c).rlike(R.RURAL)


def is_military_address(c: Column) -> Column:
    return clean(c).rlike(R.MILITARY_BOX)


def extract_rural_route(c: Column) -> Column:
    """``RR n BOX x`` or ``HC n BOX x``; null where there is none."""
    kind, n, box = (F.upper(F.regexp_extract(c, R.RURAL, i)) for i in (1, 2, 3))
    kind = F.replace(F.replace(kind, F.lit("."), F.lit("")), F.lit(" "), F.lit(""))
    short = F.when(kind.startswith("RR") | (kind == "RURALROUTE"), "RR").otherwise("HC")
    return _found(c, R.RURAL, F.concat(short, F.lit(" "), n, F.lit(" BOX "), box))


def extract_military_box(c: Column) -> Column:
    kind, n, box = (F.upper(F.regexp_extract(c, R.MILITARY_BOX, i)) for i in (1, 2, 3))
    return _found(c, R.MILITARY_BOX, F.concat(kind, F.lit(" "), n, F.lit(" BOX "), box))


def extract_po_box(c: Column) -> Column:
    """``PO BOX x`` or ``PO BOX DRAWER x``; null where there is none, and for rural and military boxes."""
    drawer = _found(c, R.PO_DRAWER, F.concat(F.lit("PO BOX DRAWER "), F.upper(F.regexp_extract(c, R.PO_DRAWER, 1))))
    number = _found(c, R.PO_NUMBER, F.concat(F.lit("PO BOX "), F.upper(F.regexp_extract(c, R.PO_NUMBER, 1))))
    return F.when(~(is_rural_route(c) | is_military_address(c)), F.coalesce(drawer, number))


def _boxes(c: Column) -> Column:
    """The rural, military or post office box of an address, null where there is none."""
    return F.when(_may_be_box(c), F.coalesce(extract_rural_route(c), extract_military_box(c), extract_po_box(c)))


def extract_unit(c: Column, mode: str = "reference") -> Column:
    """The unit as short designator and value, null where there is none.

    ``reference``: keywords may begin a longer word (FLORENCE reads as floor ORENCE), and a period after
    them hides the unit. ``strict``: whole keywords only, a period allowed.
    """
    return let(F.upper(c), lambda up: _unit_of(up, mode))


def _unit_of(up: Column, mode: str) -> Column:
    if mode == "strict":
        names = "|".join(n for n in R.UNIT_ORDER if n != "#")
        strict = rf"(?:\b({names})\.?\s+#?\s*|(?<!\w)(#)\s*)([A-Z0-9][A-Z0-9\-]*)\b"
        kind = F.concat(F.regexp_extract(up, strict, 1), F.regexp_extract(up, strict, 2))
        return _found(up, strict, F.concat(lookup(R.UNIT_ORDER, kind), F.lit(" "), F.regexp_extract(up, strict, 3)))

    def unit(at: Column) -> Column:
        kind = F.lit(None).cast("string")
        for name, short in reversed(R.UNIT_ORDER.items()):
            place = F.locate(name[::-1], at["back"])
            last = F.length(at["back"]) - (place - 1) - len(name)
            kind = F.when((place > 0) & (last <= at["start"]), F.lit(short)).otherwise(kind)
        return F.concat(kind, F.lit(" "), F.regexp_extract(up, R.UNIT_VALUE, 1))

    start = F.regexp_instr(up, F.lit(R.UNIT_VALUE)) - 1
    upto = F.substring(up, F.lit(1), start + F.length(F.regexp_extract(up, R.UNIT_VALUE, 0)))
    return F.when(_may_have_unit(up) & up.rlike(R.UNIT_VALUE), let(F.struct(start.alias("start"), F.reverse(upto).alias("back")), unit))  # once: fifteen names ask for both


def remove_unit(c: Column) -> Column:
    return let(c, lambda s: squeeze(_without_unit(s, F.upper(s))))


def normalize_for_matching(c: Column) -> Column:
    """Capitals without periods; a box or route alone if there is one; else without ZIP+4 and unit, all words short."""

    def short(w: Column) -> Column:
        return F.coalesce(lookup(R.DIRECTION_SHORT | R.STREET_SHORT, F.btrim(w, F.lit(","))), w)

    def form(up: Column) -> Column:
        bare = let(F.regexp_replace(up, R.ZIP4, ""), lambda s: _without_unit(s, s))
        return F.coalesce(_boxes(up), joined(F.transform(words(bare), short)))

    return let(F.replace(F.upper(c), F.lit("."), F.lit("")), form)


def address_key(address: Column, city: Column, state: Column, zip_: Column, unit_mode: str = "reference") -> Column:
    """What addresses are grouped by: the matching form, city, state, ZIP, the unit, a hash where the form is empty."""
    rest = F.concat_ws("|", F.upper(strip(city)), F.upper(strip(state)), normalize_zip(zip_))
    unit = F.when(~is_po_box(address), F.concat(F.lit("|UNIT:"), extract_unit(address, unit_mode)))
    hashed = F.concat(F.lit("|HASH:"), F.substring(F.md5(F.concat_ws("|", address, city, state, zip_)), 1, 8))
    end = F.concat(F.lit("|"), rest, F.coalesce(unit, F.lit("")))
    return let(normalize_for_matching(address), lambda norm: F.concat(norm, end, F.when(norm == "", hashed).otherwise("")))


def format_street(c: Column) -> Column:
    """The address for print."""

    def told(s: Column) -> Column:
        out, up = s, F.upper(s)
        for text in R.INLINE_NULLS:
            out = F.regexp_replace(out, "(?i)" + text, "")
        return F.when(up.contains("NULL") | up.contains("N/A") | up.contains("NONE"), strip(out)).otherwise(s)

    return F.when(null_like_address(c), "").otherwise(let(let(strip(c), told), _shown_street))


def _shown_street(s: Column) -> Column:
    marked = F.regexp_replace(F.regexp_replace(s, R.CARE_OF, "C/O"), R.STATE_ROUTE, _ROUTE)
    tokens = words(F.replace(F.upper(marked), F.lit("."), F.lit("")))

    def shown(w: Column) -> Column:
        unit = F.coalesce(lookup(R.UNIT_DISPLAY, w), lookup(R.UNIT_DISPLAY, F.rtrim(w, F.lit(","))))
        ordinal = F.concat(F.regexp_extract(w, R.ORDINAL, 1), F.lower(F.regexp_extract(w, R.ORDINAL, 2)))
        return (
            F.when(w.contains(_ROUTE), "State Route")
            .when(unit.isNotNull(), unit)
            .otherwise(F.coalesce(lookup(R.DIRECTION_DISPLAY | R.STREET_DISPLAY, w), F.when(w.rlike(R.ORDINAL), ordinal).when(w == "C/O", w).otherwise(title(w))))
        )

    whole = F.coalesce(_boxes(s), joined(F.transform(tokens, shown)))
    return F.when(s == "", "").otherwise(whole)
