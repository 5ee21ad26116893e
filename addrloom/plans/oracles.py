"""The functions of this engine as DuckDB expressions, for comparing results. Patterns and lists are their own."""

from __future__ import annotations

import re

from . import literals as K


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def items(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def group(x: str, pattern: str, n: int) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {n})"


def sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def squeeze(x: str) -> str:
    return f"trim({sub(x, r'\s+', ' ')})"


def words(x: str) -> str:
    return f"list_filter(string_split({squeeze(x)}, ' '), lambda w: w <> '')"


def each(array: str, to: str, var: str = "w") -> str:
    return f"list_transform({array}, lambda {var}: {to})"


def join(array: str, sep: str = " ") -> str:
    return f"coalesce(array_to_string({array}, {q(sep)}), '')"


def capital(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def title(x: str) -> str:
    return join(each(f"regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)')", capital("r"), "r"), "")


def lookup(x: str, table: dict[str, str], otherwise: str) -> str:
    return f"(CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + f" ELSE {otherwise} END)"


def state(x: str) -> str:
    codes = items(K.US_STATES + K.TERRITORIES + K.MILITARY + K.PROVINCES)
    return f"(CASE WHEN upper(trim({x})) IN {codes} THEN upper(trim({x})) ELSE '' END)"


def zip_(x: str) -> str:
    solid = f"replace(trim({x}), ' ', '')"
    canadian = f"upper(substr({solid}, 1, 3)) || ' ' || upper(substr({solid}, 4, 3))"
    lettered = f"CASE WHEN {has(solid, K.POSTAL_CODE)} THEN {canadian} ELSE {squeeze(f'upper({x})')} END"
    return f"(CASE WHEN {has(x, r'\p{L}')} THEN {lettered} ELSE substr({sub(x, '[^0-9]')}, 1, 5) END)"


def zip_valid(z: str, s: str) -> str:
    return f"(CASE WHEN trim({z}) = '' THEN true WHEN upper(trim({s})) IN {items(K.PROVINCES)} THEN {has(f'trim({z})', r'^[A-Z]\d[A-Z]\s?\d[A-Z]\d$')} ELSE {has(f'trim({z})', r'^\d{5}$')} END)"


def rural(x: str) -> str:
    kind = f"replace(replace(upper({group(x, K.RURAL, 1)}), '.', ''), ' ', '')"
    short = f"CASE WHEN {kind} LIKE 'RR%' OR {kind} = 'RURALROUTE' THEN 'RR' ELSE 'HC' END"
    return f"(CASE WHEN {has(x, K.RURAL)} THEN ({short}) || ' ' || {group(x, K.RURAL, 2)} || ' BOX ' || upper({group(x, K.RURAL, 3)}) END)"


def military(x: str) -> str:
    m = K.MILITARY_BOX
    return f"(CASE WHEN {has(x, m)} THEN upper({group(x, m, 1)}) || ' ' || {group(x, m, 2)} || ' BOX ' || upper({group(x, m, 3)}) END)"


def po(x: str) -> str:
    return (
        f"(CASE WHEN {has(x, K.RURAL)} OR {has(x, K.MILITARY_BOX)} THEN NULL WHEN {has(x, K.PO_DRAWER)} THEN 'PO BOX DRAWER ' || upper({group(x, K.PO_DRAWER, 1)}) "
        f"WHEN {has(x, K.PO_NUMBER)} THEN 'PO BOX ' || upper({group(x, K.PO_NUMBER, 1)}) END)"
    )


def is_po(x: str) -> str:
    return has(x, K.PO_BOX)


def unit(x: str) -> str:
    found = sub(group(f"upper({x})", K.UNIT_VALUE, 0), r"^[^A-Z0-9_]+#", "#")
    kind = group(found, "^(" + "|".join(K.UNIT_ORDER) + ")", 1)
    return f"(CASE WHEN {has(f'upper({x})', K.UNIT_VALUE)} THEN {lookup(kind, K.UNIT_ORDER, 'NULL')} || ' ' || {group(f'upper({x})', K.UNIT_VALUE, 1)} END)"


def remove_unit(x: str) -> str:
    return squeeze(sub(x, K.UNIT_TAIL))


def normalize(x: str) -> str:
    up = f"replace(upper({x}), '.', '')"
    bare = sub(sub(up, K.ZIP4), K.UNIT_TAIL)
    short = join(each(words(bare), lookup("trim(w, ',')", K.DIRECTION_SHORT | K.STREET_SHORT, "w")))
    return f"coalesce({rural(up)}, {military(up)}, {po(up)}, {short})"


def address_key(a: str, c: str, s: str, z: str) -> str:
    norm = normalize(a)
    key = f"{norm} || '|' || upper(trim({c})) || '|' || upper(trim({s})) || '|' || {zip_(z)}"
    return f"({key} || CASE WHEN {is_po(a)} THEN '' ELSE coalesce('|UNIT:' || {unit(a)}, '') END || CASE WHEN {norm} = '' THEN '|HASH:' || substr(md5({a} || '|' || {c} || '|' || {s} || '|' || {z}), 1, 8) ELSE '' END)"


def street(x: str) -> str:
    s = f"trim({x})"
    for text in K.INLINE_NULLS:
        s = sub(s, "(?i)" + text)
    s = f"trim({s})"
    marked = sub(sub(s, K.CARE_OF, "C/O"), K.STATE_ROUTE, "@@ROUTE@@")
    ordinal = f"{group('w', K.ORDINAL, 1)} || lower({group('w', K.ORDINAL, 2)})"
    plain = lookup("w", K.DIRECTION_DISPLAY | K.STREET_DISPLAY, f"CASE WHEN {has('w', K.ORDINAL)} THEN {ordinal} WHEN w = 'C/O' THEN w ELSE {title('w')} END")
    shown = f"CASE WHEN w LIKE '%@@ROUTE@@%' THEN 'State Route' ELSE {lookup('w', K.UNIT_DISPLAY, lookup(sub('w', ',+$'), K.UNIT_DISPLAY, plain))} END"
    tokens = words(f"replace(upper({marked}), '.', '')")
    return f"(CASE WHEN {has(x, K.NULL_ADDRESS)} OR {s} = '' THEN '' ELSE coalesce({rural(s)}, {military(s)}, {po(s)}, {join(each(tokens, shown))}) END)"


def raw_copy(x: str) -> str:
    return f"(CASE WHEN lower(trim({x})) IN ('nan', 'none') THEN '' ELSE trim({x}) END)"


def _any(padded: str, some: list[str]) -> str:
    return has(padded, "(?: " + " | ".join(some) + " )")


def _padded(x: str) -> str:
    return f"(' ' || {squeeze(f'upper({x})')} || ' ')"


def is_trust(x: str) -> str:
    return _any(_padded(x), K.TRUST_WORDS)


def is_government(x: str) -> str:
    return f"({has(_padded(x), '|'.join(K.GOVERNMENT_PHRASES))} OR {_any(_padded(x), K.GOVERNMENT_WORDS)})"


def is_company(x: str) -> str:
    return _any(_padded(sub(x, "[.,;]+", " ")), K.COMPANY_WORDS)


def classify(x: str) -> str:
    return f"(CASE WHEN {x} = '' OR {has(x, K.NULL_NAME)} THEN 'person' WHEN {is_trust(x)} THEN 'trust' WHEN {is_company(x)} THEN 'entity' WHEN {is_government(x)} THEN 'government' ELSE 'person' END)"


def title_word(w: str, deep: bool = True) -> str:
    plain = f"CASE WHEN {w} LIKE '%-%' THEN {join(each(f"string_split({w}, '-')", title_word('p', False), 'p'), '-')} ELSE {capital(w)} END" if deep else capital(w)
    return (
        f"(CASE WHEN length({w}) <= 1 OR (length({w}) = 2 AND {w} LIKE '_.') THEN upper({w}) WHEN upper({w}) LIKE 'O''%' AND length({w}) > 2 THEN 'O''' || {capital(f'substr({w}, 3)')} "
        f"WHEN upper({w}) LIKE 'MC%' AND length({w}) > 2 THEN 'Mc' || {capital(f'substr({w}, 3)')} WHEN upper({w}) LIKE 'MAC%' AND length({w}) > 5 THEN 'Mac' || {capital(f'substr({w}, 4)')} ELSE {plain} END)"
    )


def strip_transactions(x: str) -> str:
    return squeeze(sub(x, K.TRANSACTION_TAIL))


def join_spaced(x: str) -> str:
    for pattern, form in K.SPACED.items():
        x = sub(x, pattern, form)
    return x


def acronym(w: str) -> str:
    return f"({has(w, r'^\p{L}{1,3}$')} AND (NOT {has(f'upper({w})', '[AEIOU]')} OR upper({w}) NOT IN {items(K.SHORT_WORDS)}))"


def company(x: str) -> str:
    tokens = words(join_spaced(strip_transactions(x)))
    bare, plain = "trim(w, ',.')", "replace(upper(trim(w, ',.')), '.', '')"
    shown = (
        f"CASE WHEN {plain} IN {items(K.COMPANY_CAPITALS)} THEN {plain} WHEN {plain} IN {items(K.COMPANY_TITLED)} THEN {capital(plain)} "
        f"WHEN {acronym(bare)} THEN upper({bare}) WHEN i > 1 AND i < len({tokens}) AND {plain} IN {items(K.SMALL_WORDS)} THEN lower({plain}) ELSE {title_word(bare)} END"
    )
    return f"trim({join(f'list_transform({tokens}, lambda w, i: {shown})')})"


def government(x: str) -> str:
    dept = group(squeeze(f"upper({x})"), r"^DEPT\.?\s+(.+)$", 1)
    out = join(each(words(x), f"CASE WHEN upper(w) IN {items(K.SMALL_WORDS)} THEN lower(w) ELSE {title_word('w')} END"))
    return f"(CASE WHEN {dept} <> '' THEN {join(each(words(dept), title_word('w')))} || ' Dept' ELSE upper(substr({out}, 1, 1)) || substr({out}, 2) END)"


def comparison_key(x: str) -> str:
    up = squeeze(f"upper({x})")
    bare = sub(up, K.NAME_MARKS)
    suffix = r"(?: (?:" + "|".join(re.escape(s) for s in K.SUFFIXES) + "))+$"
    # Suffixes are cut from the text, with a space before it so that a name of suffixes alone goes too.
    kept = words(sub("(' ' || " + join(f"list_filter({words(bare)}, lambda w: w NOT IN ('AND', '&'))") + ")", suffix))
    signals = f"len(list_filter({kept}, lambda w: w IN {items(K.ENTITY_SIGNALS)})) > 0"
    return f"(CASE WHEN {is_trust(up)} OR {is_government(up)} OR {is_company(up)} THEN {squeeze(bare)} WHEN {signals} THEN {join(kept)} ELSE {join(f'list_sort({kept})')} END)"


def life_estate_cut(x: str) -> str:
    return f"trim(rtrim(trim({sub(x, K.LIFE_ESTATE)}), ','))"


def second_key(x: str) -> str:
    return sub(f"lower(trim({x}))", r"\band\b", "&")


def no_street(x: str) -> str:
    return f"(trim({x}) = '' OR {has(f'trim({x})', K.NULL_NAME)} OR {has(f'trim({x})', K.UNDELIVERABLE)})"


def exact_key() -> str:
    box = f"coalesce({po('trim(street)')}, 'None') || '|' || upper(trim(city)) || '|' || upper(trim(state)) || '|' || {zip_('trim(zip)')}"
    key = f"CASE WHEN {is_po('trim(street)')} THEN {box} ELSE {address_key('trim(street)', 'trim(city)', 'trim(state)', 'trim(zip)')} END"
    second = second_key("second_line")
    return f"CASE WHEN {no_street('street')} THEN 'NO_STREET::' || _ord ELSE {key} || CASE WHEN {second} = '' THEN '' ELSE '|' || {second} END END"
