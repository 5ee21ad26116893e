"""The name grammar over Arrow batches. Nothing here fails on a row: what can't be read comes back as it was, with the error."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import grammar as G
from .similar import merged_name

_FLAGS = ("business", "life_estate")
_PARTS = ["full", "first", "middle", "last", "first2", "middle2", "last2", *_FLAGS, "error"]
# Types as objects, not as text: workers import this module without a session that could read text.
OWNER = T.StructType([T.StructField(n, T.BooleanType() if n in _FLAGS else T.StringType()) for n in _PARTS])
NAMES = T.ArrayType(T.StringType())
NAMES_IN_ARROW = pa.list_(pa.string())


def _each_once(raw: pa.Array, f: Callable[[list[str | None]], pa.Array]) -> pa.Array:
    """``f`` of the texts of a batch, each different one worked out once; nothing is kept from one batch to the next."""
    coded = raw.dictionary_encode(null_encoding="encode")
    return f(coded.dictionary.to_pylist()).take(coded.indices)


def _owners(raw: list[str | None]) -> pa.Array:
    out = []
    for name in raw:
        try:
            owner, error = G.parse_owner(name or ""), ""
        except Exception as e:  # a row that the grammar can't read stays, and says so
            owner, error = G.Owner(full=(name or "").strip()), f"{type(e).__name__}: {e}"
        out.append({**owner.__dict__, "error": error})
    kinds = [(n, pa.bool_() if n in _FLAGS else pa.string()) for n in _PARTS]
    return pa.array(out, pa.struct(kinds))


@F.arrow_udf(OWNER)
def _parse_owner(raw: pa.Array) -> pa.Array:
    return _each_once(raw, _owners)


def _strings(f, raw: pa.Array) -> pa.Array:
    return _each_once(raw, lambda texts: pa.array([f(x or "") for x in texts], pa.string()))


@F.arrow_udf(T.StringType())
def _trust(raw: pa.Array) -> pa.Array:
    return _strings(G.trust, raw)


@F.arrow_udf(T.StringType())
def _person(raw: pa.Array) -> pa.Array:
    return _strings(G.person_from_last_first, raw)


@F.arrow_udf(T.StringType())
def _segment(raw: pa.Array) -> pa.Array:
    return _strings(G.segment, raw)


@F.arrow_udf(NAMES)
def _individuals(raw: pa.Array) -> pa.Array:
    return _each_once(raw, lambda texts: pa.array([G.individuals(x or "") for x in texts], NAMES_IN_ARROW))


@F.arrow_udf(T.StringType())
def _combine(names: pa.Array) -> pa.Array:
    known: dict[tuple[str, ...], str] = {}
    out = []
    for x in names.to_pylist():
        key = tuple(n or "" for n in x or [])
        if key not in known:
            known[key] = G.combine(list(key))
        out.append(known[key])
    return pa.array(out, pa.string())


@F.arrow_udf(T.DoubleType())
def _ratio(a: pa.Array, b: pa.Array, least: pa.Array) -> pa.Array:
    # Pairs come once each: to remember them would only fill every worker's memory.
    return pa.array([G.ratio.__wrapped__(x or "", y or "", z) for x, y, z in zip(a.to_pylist(), b.to_pylist(), least.to_pylist(), strict=True)], pa.float64())


@F.arrow_udf(T.BooleanType())
def _same_person(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([G.same_person(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())


#: Planned as if its results could vary: a filter on them would else be moved below the column, and every name read twice.
_parse_owner_once = _parse_owner.asNondeterministic()


def parse_owner(c: Column) -> Column:
    return _parse_owner_once(c)


def format_trust(c: Column) -> Column:
    return _trust(c)


def person_from_last_first(c: Column) -> Column:
    return _person(c)


def format_segment(c: Column) -> Column:
    return _segment(c)


def individuals(c: Column) -> Column:
    return _individuals(c)


def combine_household(c: Column) -> Column:
    return _combine(c)


def ratio(earlier: Column, later: Column, least: float = 0.0) -> Column:
    """Ratcliff-Obershelp similarity, which depends on the order of its arguments: the earlier row comes first.

    Where it is sure to be under ``least`` the result may be 0.
    """
    return _ratio(earlier, later, F.lit(float(least)))


def same_person(a: Column, b: Column) -> Column:
    return _same_person(a, b)


@F.arrow_udf(NAMES)
def _surnames(raw: pa.Array) -> pa.Array:
    return _each_once(raw, lambda texts: pa.array([sorted(G.family_names((x or "").strip())) for x in texts], NAMES_IN_ARROW))


def surnames(c: Column) -> Column:
    """The surnames of a printed name's persons, in capitals; none where it says none."""
    return _surnames(c)


_HOUSE = T.StructType([T.StructField("name", T.StringType()), T.StructField("persons", T.IntegerType())])


@F.arrow_udf(_HOUSE)
def _merge_names(names: pa.Array, persons: pa.Array) -> pa.Array:
    out = [merged_name(n or [], p) for n, p in zip(names.to_pylist(), persons.to_pylist(), strict=True)]
    return pa.array([{"name": n, "persons": p} for n, p in out], pa.struct([("name", pa.string()), ("persons", pa.int32())]))


def merge_names(names: Column, persons: Column) -> Column:
    """``(name, persons)``: what the names of one group, in the order of its rows, come down to, and how many persons there were."""
    return _merge_names(names, persons)
