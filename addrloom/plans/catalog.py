"""One query for each operator of the engine over the mail views, and the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions import address as A
from addrloom.functions import household as H
from addrloom.functions import names as N
from addrloom.functions import rules as R
from addrloom.functions import text as T
from addrloom.operators.components import connected_components
from addrloom.operators.matching import address_clusters, canonical_names, exact_groups, exact_key, gated_pairs, match_columns, same_place, second_line_key, similar_links, similar_pairs
from addrloom.shared import write_table
from addrloom.sources import feeds
from addrloom.sources.files import row_count

from . import literals as K
from . import oracles as O
from . import validate as V
from .consolidate import consolidate, in_order, merge_clusters, place_rows, review_reason, union_feeds, volumes
from .report import read_report, write_report
from .views import sql_of, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


def _scalar(name: str, source: str, cols: dict[str, tuple[Column, str]]) -> None:
    """A query of columns, each beside its SQL, with the rows' places."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return view(spark, sf_dir, source).select("_ord", *[c().alias(n) for n, (c, _) in cols.items()])

    _add(name, query, f"SELECT _ord, {', '.join(f'{s} AS {n}' for n, (_, s) in cols.items())} FROM ({sql_of(source)}) v")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "mail_rows")


def c(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def f(fn: Callable[..., Column], *names: str) -> Callable[[], Column]:
    return lambda: fn(*[F.col(n) for n in names])


_scalar("zip_normalize", "mail_rows", {"zip5": (f(T.normalize_zip, "zip"), O.zip_("zip"))})
_scalar("state_normalize", "mail_rows", {"code": (f(T.normalize_state, "state"), O.state("state"))})
_scalar(
    "state_kinds", "mail_rows",
    {n: (f(fn, "state"), f"upper(trim(state)) IN {O.items(codes)}") for n, fn, codes in (
        ("us", T.is_us_state, K.US_STATES + K.TERRITORIES), ("canada", T.is_canadian_province, K.PROVINCES), ("military", T.is_military_state, K.MILITARY),
        ("valid", T.is_valid_state, K.US_STATES + K.TERRITORIES + K.MILITARY + K.PROVINCES))},
)
_scalar("whitespace", "mail_rows", {"city_plain": (f(T.squeeze, "city"), O.squeeze("city"))})
_scalar("title_case", "mail_rows", {"city_title": (f(T.title_column, "city"), O.squeeze(O.title("trim(city)")))})
_scalar("po_extract", "mail_rows", {"box": (f(A.extract_po_box, "street"), O.po("street")), "is_po": (f(A.is_po_box, "street"), O.is_po("street"))})
_scalar("rural_extract", "mail_rows", {"route": (f(A.extract_rural_route, "street"), O.rural("street")), "is_route": (f(A.is_rural_route, "street"), O.has("street", K.RURAL))})
_scalar("military_extract", "mail_rows", {"military": (f(A.extract_military_box, "street"), O.military("street")), "is_military": (f(A.is_military_address, "street"), O.has("street", K.MILITARY_BOX))})
_scalar("unit_extract", "mail_rows", {"unit": (f(A.extract_unit, "street"), O.unit("street"))})
_scalar("unit_remove", "mail_rows", {"base": (f(A.remove_unit, "street"), O.remove_unit("street"))})
_scalar("addr_normalize", "mail_rows", {"form": (f(A.normalize_for_matching, "street"), O.normalize("street"))})
_scalar("addr_key", "mail_rows", {"address_key": (f(A.address_key, "street", "city", "state", "zip"), O.address_key("street", "city", "state", "zip"))})
_scalar("street_format", "mail_rows", {"shown": (f(A.format_street, "street"), O.street("street"))})
_scalar(
    "null_like", "mail_rows",
    {"in_address": (f(T.null_like_address, "street"), O.has("street", K.NULL_ADDRESS)), "in_name": (f(T.null_like, "full_name"), O.has("full_name", K.NULL_NAME)), "in_parcel": (f(T.null_like_parcel, "second_line"), O.has("second_line", K.NULL_PARCEL))},
)
_scalar("undeliverable", "mail_rows", {"undeliverable": (f(T.is_undeliverable, "street"), O.has("street", K.UNDELIVERABLE))})
_scalar("routing_line", "mail_parcel", {"routing": (f(T.is_routing_line, "line2"), O.has("line2", K.ROUTING_LINE))})
_scalar(
    "csz_split", "mail_parcel",
    {n: ((lambda n=n: T.city_state_zip(F.col("csz"))[n]), f"trim({O.group('trim(csz)', K.ONE_CITY_STATE_ZIP, i)})") for i, n in enumerate(("city", "state", "zip"), 1)}
    | {"bare": ((lambda: T.strip(F.regexp_replace("addr", R.CITY_STATE_ZIP, ""))), f"trim({O.sub('addr', K.CITY_STATE_ZIP)})")},
)
_scalar("company_or_dba", "mail_business", {"name": (f(feeds.company_or_dba, "company", "dba"), "CASE WHEN trim(company) = '' THEN trim(dba) ELSE trim(company) END")})
_scalar(
    "title_dept", "mail_business",
    {"line": (f(feeds.title_and_department, "contact", "title"), f"{O.squeeze('contact')} || CASE WHEN {O.squeeze('contact')} <> '' AND {O.squeeze('title')} <> '' THEN ', ' ELSE '' END || {O.squeeze('title')}")},
)
_scalar("lineage_raw", "mail_consumer", {"raw": (f(T.raw_copy, "addr2"), O.raw_copy("addr2"))})
_scalar(
    "consumer_address", "mail_consumer",
    {"street": ((lambda: A.format_street(feeds._glue(T.strip(F.col("addr1")), feeds._present(F.col("addr2")), " "))), O.street("(trim(addr1) || CASE WHEN lower(trim(addr2)) IN ('', 'nan', 'none') THEN '' ELSE ' ' || trim(addr2) END)"))},
)
_scalar("consumer_names", "mail_consumer", {n: ((lambda n=n: T.title(feeds._present(F.col(n)))), O.title(f"trim({n})")) for n in ("first", "last")})
_scalar(
    "name_class", "mail_rows",
    {"kind": (f(N.classify, "full_name"), O.classify("full_name")), "trust": (f(N.is_trust, "full_name"), O.is_trust("full_name")), "government": (f(N.is_government, "full_name"), O.is_government("full_name")), "company": (f(N.is_company, "full_name"), O.is_company("full_name"))},
)
_scalar("title_word", "mail_consumer", {"shown": (f(N.title_word, "last"), O.title_word("last"))})
_scalar("entity_format", "mail_business", {"shown": (f(N.format_company, "company"), O.company("company"))})
_scalar("acronym", "mail_business", {"acronym": ((lambda: N.is_acronym(F.substring_index("company", " ", 1))), O.acronym("string_split(company, ' ')[1]"))})
_add(
    "acronym_words",
    lambda s, d: view(s, d, "mail_business").select("_ord", F.posexplode(F.split("company", " "))).select("_ord", (F.col("pos") + 1).cast("long").alias("place"), N.is_acronym(F.col("col")).alias("acronym")),
    f"WITH v AS ({sql_of('mail_business')}), w AS (SELECT _ord, generate_subscripts(string_split(company, ' '), 1) AS place, unnest(string_split(company, ' ')) AS word FROM v) "
    f"SELECT _ord, place, {O.acronym('word')} AS acronym FROM w",
)
_scalar("government_format", "mail_rows", {"shown": (f(N.format_government, "full_name"), O.government("full_name"))})
_scalar("transaction_strip", "mail_business", {"bare": (f(N.strip_transactions, "company"), O.strip_transactions("company"))})
_scalar("lp_normalize", "mail_business", {"joined": (f(N.join_spaced_forms, "company"), O.join_spaced("company"))})
_scalar(
    "life_estate", "mail_rows",
    {"life_estate": ((lambda: N.without_life_estate(F.col("full_name"))["life_estate"]), f"{O.life_estate_cut('full_name')} <> trim(rtrim(trim(full_name), ','))")},
)
_scalar("name_compare_key", "mail_rows", {"name_key": (f(N.comparison_key, "full_name"), O.comparison_key("full_name"))})
_scalar("noise_strip", "mail_business", {"bare": (f(N.without_noise, "company"), f"trim({O.sub('company', K.NAME_NOISE)})")})
_scalar("second_line", "mail_business", {"line_key": (f(second_line_key, "title"), O.second_key("title"))})
_scalar("zip_valid", "mail_rows", {"valid": (f(T.zip_is_valid, "zip", "state"), O.zip_valid("zip", "state"))})

# --- sets of rows

_ROWS = f"rows_ AS ({sql_of('mail_rows')})"
_KEYED = f"{_ROWS}, keyed AS (SELECT *, {O.exact_key()} AS key FROM rows_)"


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).withColumn("key", exact_key())


_HEADERS = {
    "mail_consumer": {"first": "First Name", "last": "Last Name", "addr1": "Street Address 1", "addr2": "Street Address 2", "city": "City", "state": "State", "zip": "Zip"},
    "mail_business": {"company": "Company", "dba": "DBA", "contact": "Contact", "title": "Title", "addr": "Street Address", "city": "City", "state": "State", "zip": "Zip"},
    "mail_parcel": {"owner": "OWNER_NAME_FULL", "line2": "Name Line 2", "addr": "MAIL_ADDRESS", "city": "MAIL_CITY", "state": "MAIL_STATE", "zip": "MAIL_ZIP", "pid": "Parcel ID"},
}


def _feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = view(spark, sf_dir, name)
    return rows.select("_ord", *[F.col(a).alias(b) for a, b in _HEADERS[name].items()])


def _count_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("data_source").agg(F.count("*").alias("records"))


_SAME = ["data_source", "full_name", "second_line", "street", "city", "state", "zip"]


def _as_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as a combined list: all fields, the name as it came for lineage."""
    rows = _rows(spark, sf_dir).withColumn("owner1_original", F.col("full_name"))
    return rows.select(*[(F.col(x) if x in rows.columns else F.lit("")).alias(x) for x in [*R.FIELDS, *R.LINEAGE]], "_ord")


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, room = _as_list(spark, sf_dir), 1_000_000_000
    return union_feeds(*[rows.where(F.floor(F.col("_ord") / room) == i).withColumn("_ord", F.col("_ord") % room) for i in range(3)])


_add("union_sources", lambda s, d: _count_by_source(_union(s, d)), f"WITH {_ROWS} SELECT data_source, count(*) AS records FROM (SELECT DISTINCT {', '.join(_SAME)} FROM rows_) x GROUP BY data_source")
_add(
    "dedup_keep_first",
    lambda s, d: feeds.keep_first(_as_list(s, d).withColumn("city_original", F.col("_ord").cast("string"))).select(*_SAME, F.col("_ord").alias("first_ord"), F.col("city_original").alias("lineage")),
    f"WITH {_ROWS} SELECT {', '.join(_SAME)}, min(_ord) AS first_ord, CAST(min(_ord) AS VARCHAR) AS lineage FROM rows_ GROUP BY {', '.join(_SAME)}",
)
_add("exact_groups", lambda s, d: exact_groups(_rows(s, d)), f"WITH {_KEYED} SELECT key, count(*) AS n, min(_ord) AS first_ord FROM keyed GROUP BY key")


def _merged(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """Exact groups through the merge: those of several rows whose persons are of one source, which is what the SQL of names and lineage can say; or every one."""
    keyed = write_table(_as_list(spark, sf_dir).withColumn("key", exact_key()), "keyed")
    groups = keyed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("_ord").alias("cluster"), F.count_distinct(F.when(N.classify(T.strip(F.col("full_name"))) == "person", T.strip(F.col("data_source")))).alias("of")
    )
    groups = groups if every else groups.where("n > 1 and of < 2")
    return merge_clusters(keyed.join(groups, "key").withColumn("phase", F.lit(0)))


_MERGED = (
    f"{_KEYED}, kinds AS (SELECT *, trim(full_name) AS name, {O.classify('trim(full_name)')} = 'person' AS person FROM keyed), "
    "g AS (SELECT key, min(_ord) AS cluster, max(CASE WHEN person THEN 0 ELSE 1 END) AS others FROM kinds GROUP BY key HAVING count(*) > 1 AND count(DISTINCT CASE WHEN person THEN trim(data_source) END) < 2), "
    "s AS (SELECT k.*, g.cluster, CASE WHEN person THEN others ELSE 0 END AS sub FROM kinds k JOIN g ON k.key = g.key), "
    "w AS (SELECT *, row_number() OVER (PARTITION BY cluster, sub ORDER BY _ord) AS place, row_number() OVER (PARTITION BY cluster, sub, name ORDER BY _ord) AS again FROM s)"
)
_add(
    "group_sources",
    lambda s, d: _merged(s, d).select("cluster", "sub", "data_source", "second_line"),
    f"WITH {_MERGED} SELECT cluster, sub, string_agg(DISTINCT trim(data_source), ', ' ORDER BY trim(data_source)) AS data_source, "
    "coalesce(string_agg(DISTINCT nullif(trim(second_line), ''), ', ' ORDER BY nullif(trim(second_line), '')), '') AS second_line FROM w GROUP BY cluster, sub",
)
_add(
    "group_lineage",
    lambda s, d: _merged(s, d).select("cluster", "sub", F.trim("owner1_original").alias("lineage")),
    f"WITH {_MERGED} SELECT cluster, sub, coalesce(string_agg(CASE WHEN again = 1 AND name <> '' THEN name END, ' | ' ORDER BY _ord), '') AS lineage FROM w GROUP BY cluster, sub",
)


def _families() -> str:
    """``fams``: the surnames that the names of ``told`` say, by the grammar of households: parts by slashes, commas or ``and``, all but the first
    of which may lack a surname. Of each part the last word for print (``ends``) and how many words it has (``size``) are what counts."""
    suffix = " (?:" + "|".join(x.replace(".", "[.]") for x in ("JR", "SR", "II", "III", "IV", "MD", "M.D", "PHD", "PH.D", "ESQ")) + ")[.]*"
    initial = "regexp_matches(t[2], '^\\p{L}[.]*$')"
    last = "list_extract({0}, len({0}))".format
    county = "CASE WHEN len(k) < 2 THEN coalesce(k[1], '') WHEN len(k) = 4 AND length(rtrim(k[4], '.')) = 1 THEN k[2] WHEN len(k) = 5 AND length(rtrim(k[3], '.')) = 1 THEN k[5] ELSE k[1] END"
    org = f"({O.is_trust('part')} OR {O.is_government('part')} OR {O.is_company('part')})"
    shown = {"ends": ["'TRUST'", last(O.words(O.government("part"))), last(O.words(O.company("part"))), last(O.words("before")), county, last("t")],
             "size": ["2", f"len({O.words(O.government('part'))})", f"len({O.words(O.company('part'))})", "2", "len(k)", "len(t)"]}
    tests = [O.is_trust("part"), O.is_government("part"), O.is_company("part"), "capitals AND before <> '' AND after <> ''", "capitals", "true"]
    segment = ", ".join(f"CASE {' '.join(f'WHEN {w} THEN {x}' for w, x in zip(tests, xs, strict=True))} END AS {n}" for n, xs in shown.items())
    own = f"CASE WHEN {org} THEN ends WHEN tail <> '' THEN {last(O.words('tail'))} WHEN upper({last('k')}) = upper(head) THEN head ELSE k[1] END"
    short = f"(len(t) = 1 OR (len(t) = 2 AND (way = 1 OR {initial})))"
    lent = f"head <> '' AND CASE way WHEN 2 THEN size = 1 ELSE {short} END"
    return (
        f"masked AS (SELECT *, regexp_replace(regexp_replace(raw, '(?i)\\b(C)/(O)\\b', '\\1' || chr(1) || '\\2', 'g'), '(?i)\\b(A)/(C)($|[^A-Za-z0-9_' || chr(1) || '])', '\\1' || chr(1) || '\\2\\3', 'g') AS m FROM told), "
        "ways AS (SELECT *, CASE WHEN regexp_matches(m, '[/\\\\]') THEN 1 WHEN contains(raw, ',') AND regexp_matches(raw, '[^, ]') THEN 2 WHEN regexp_matches(raw, '(?i)\\s(?:&|AND)\\s') THEN 3 ELSE 4 END AS way FROM masked), "
        "split AS (SELECT cluster, _ord, way, CASE way WHEN 1 THEN list_filter(list_transform(string_split_regex(m, '[/\\\\]'), lambda p: trim(replace(p, chr(1), '/'))), lambda p: p <> '') "
        "WHEN 2 THEN list_transform(list_filter(list_transform(string_split(raw, ','), lambda p: trim(p)), lambda p: p <> ''), lambda p: trim(regexp_replace(p, '(?i)^\\s*(?:AND|&)\\s+', ''))) "
        "WHEN 3 THEN string_split_regex(raw, '(?i)\\s+&\\s+|\\s+AND\\s+') ELSE [raw] END AS parts FROM ways), "
        "each_ AS (SELECT cluster, _ord, way, generate_subscripts(parts, 1) AS i, unnest(parts) AS part FROM split), "
        f"tokens AS (SELECT *, {O.words('part')} AS t, {O.words(f"CASE WHEN {O.squeeze('part')} LIKE '% %' THEN regexp_replace(' ' || {O.squeeze('part')}, '(?i)(?:{suffix})+$', '') ELSE part END")} AS k, "
        f"trim(regexp_extract(' ' || {O.squeeze('part')}, '(?i)((?:{suffix})+)$', 1)) AS tail, part = upper(part) AND regexp_matches(part, '\\p{{L}}') AS capitals, trim(split_part(part, ',', 1)) AS before, trim(substr(part, strpos(part || ',', ',') + 1)) AS after FROM each_), "
        f"shown AS (SELECT *, {segment} FROM tokens), "
        "headed AS (SELECT *, coalesce(first_value(ends) OVER (PARTITION BY _ord ORDER BY i), '') AS head FROM shown), "
        f"told_ AS (SELECT *, CASE WHEN i = 1 THEN ends WHEN {lent} THEN head WHEN way = 1 AND len(t) > 2 THEN {own} WHEN way = 1 OR (way = 3 AND {short}) THEN {last('t')} ELSE ends END AS said, "
        f"CASE WHEN i = 1 THEN size WHEN {lent} THEN 2 WHEN way = 1 OR (way = 3 AND {short}) THEN len(t) ELSE size END AS words FROM headed), "
        # Behind an initial stands the surname of the next person who has one.
        "next_ AS (SELECT _ord, arg_min(said, i) AS said FROM told_ WHERE way = 3 AND i > 1 AND words > 1 AND length(rtrim(said, '.')) > 1 GROUP BY _ord), "
        "named AS (SELECT t.cluster, t._ord, CASE WHEN i = 1 AND regexp_matches(t.said, '^\\p{L}[.]*$') AND n.said IS NOT NULL THEN n.said WHEN words > 1 THEN t.said ELSE '' END AS said FROM told_ t LEFT JOIN next_ n ON t._ord = n._ord), "
        "fams AS (SELECT DISTINCT cluster, _ord, upper(trim(said, '.')) AS family FROM named WHERE length(trim(said, '.')) > 1)"
    )


_PARTS = (
    f"{_KEYED}, kinds AS (SELECT *, trim(full_name) AS name, {O.classify('trim(full_name)')} = 'person' AS person FROM keyed), "
    "g AS (SELECT key, min(_ord) AS cluster, min(CASE WHEN person THEN _ord END) AS first_person, count(DISTINCT CASE WHEN person THEN trim(data_source) END) > 1 AS several FROM kinds GROUP BY key), "
    "k AS (SELECT kinds.*, cluster, first_person, several FROM kinds JOIN g ON kinds.key = g.key), "
    f"people AS (SELECT cluster, _ord, name FROM k WHERE person AND several), told AS (SELECT cluster, _ord, {O.squeeze('name')} AS raw FROM people WHERE name <> '' AND NOT {O.has('name', K.NULL_NAME)}), {_families()}, "
    "whole AS (SELECT DISTINCT cluster FROM people WHERE _ord NOT IN (SELECT _ord FROM fams)), "
    "apart AS (SELECT * FROM fams WHERE cluster NOT IN (SELECT cluster FROM whole)), "
    "e AS (SELECT DISTINCT a._ord AS x, b._ord AS y FROM apart a JOIN apart b ON a.cluster = b.cluster AND a.family = b.family), "
    "reach AS (SELECT x AS node, x AS other FROM e UNION SELECT reach.node, e.y FROM reach JOIN e ON reach.other = e.x), "
    "joined AS (SELECT node, min(other) AS part FROM reach GROUP BY node), "
    "p AS (SELECT k.*, CASE WHEN person THEN coalesce(part, first_person) ELSE -1 END AS part FROM k LEFT JOIN joined ON k._ord = node), "
    "s AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY cluster ORDER BY part) - 1 AS INTEGER) AS sub FROM p), "
    "w AS (SELECT *, row_number() OVER (PARTITION BY cluster, sub ORDER BY _ord) AS place FROM s)"
)
_add(
    "first_record",
    lambda s, d: _merged(s, d, every=True).select("cluster", "sub", "street", "city", "state", "zip"),
    f"WITH RECURSIVE {_PARTS} SELECT cluster, sub, street, city, state, zip FROM w WHERE place = 1",
)
_add(
    "group_split",
    lambda s, d: place_rows(_as_list(s, d)).select("_ord", "phase", F.when(F.col("phase") == 0, F.col("cluster")).otherwise(-1).alias("first_ord"), F.when(F.col("phase") == 0, F.col("n")).otherwise(0).alias("n")),
    f"WITH {_KEYED}, g AS (SELECT key, count(*) AS n, min(_ord) AS first_ord FROM keyed GROUP BY key) SELECT _ord, CASE WHEN n > 1 THEN 0 WHEN {O.has('trim(full_name)', K.NULL_NAME)} OR {O.no_street('street')} THEN 2 ELSE 1 END AS phase, "
    "CASE WHEN n > 1 THEN first_ord ELSE -1 END AS first_ord, CASE WHEN n > 1 THEN n ELSE 0 END AS n FROM keyed JOIN g ON keyed.key = g.key",
)
_scalar("mailable", "mail_rows", {"mailable": ((lambda: feeds.mailable(F.col("full_name"), A.format_street(F.col("street")))), f"(trim(full_name) <> '' AND NOT {O.has(O.street('street'), K.NULL_PARCEL)})")})
_add(
    "same_place",
    lambda s, d: _rows(s, d).alias("a").join(_rows(s, d).alias("b"), F.col("b._ord") == F.col("a._ord") + 1).select("a._ord", same_place("a", "b").alias("same")),
    f"WITH {_ROWS}, p AS (SELECT _ord, upper(trim(city)) || '|' || upper(trim(state)) || '|' || {O.zip_('zip')} AS place FROM rows_) SELECT a._ord, a.place = b.place AS same FROM p a JOIN p b ON b._ord = a._ord + 1",
)
_add("row_count", lambda s, d: s.createDataFrame([(row_count(_rows(s, d)), row_count(None))], "rows long, missing long"), f"WITH {_ROWS} SELECT count(*) AS rows, 0::BIGINT AS missing FROM rows_")
_add(
    "street_in_company",
    lambda s, d: s.createDataFrame([(feeds.looks_like_streets(_feed(s, d, "mail_business")),)], "streets boolean"),
    f"WITH v AS ({sql_of('mail_business')}), f AS (SELECT company FROM v ORDER BY _ord LIMIT 20), h AS (SELECT count(*) AS n, coalesce(sum(CASE WHEN regexp_matches(company, '^\\s*\\d+\\s+\\S') THEN 1 ELSE 0 END), 0) AS hits FROM f WHERE trim(company) <> '') "
    "SELECT n > 0 AND hits >= greatest(3, n // 2) AS streets FROM h",
)


def _singles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an exact partner, which is what pairs are sought among."""
    rows = write_table(_keyed(spark, sf_dir), "keyed")  # read twice, and keys cost more than writing them
    lone = rows.groupBy("key").agg(F.count("*").alias("n")).where("n = 1").select("key")
    return rows.join(lone, "key", "left_semi").where(~T.null_like(T.strip(F.col("full_name"))) & ~F.col("key").startswith("NO_STREET::"))


_MATCH = (
    f"{_KEYED}, singles AS (SELECT * FROM keyed WHERE key IN (SELECT key FROM keyed GROUP BY key HAVING count(*) = 1) AND NOT {O.has('trim(full_name)', K.NULL_NAME)} AND key NOT LIKE 'NO_STREET::%'), "
    f"m0 AS (SELECT _ord, upper(trim(city)) || '|' || upper(trim(state)) || '|' || {O.zip_('zip')} AS block, {O.second_key('second_line')} AS second, {O.is_po('street')} AS po, "
    f"coalesce({O.po('street')}, '') AS box, coalesce({O.unit('street')}, '') AS unit, {O.remove_unit('street')} AS cut FROM singles), "
    f"m AS (SELECT *, {O.normalize('cut')} AS base FROM m0)"
)
_PAIRS = (
    f"{_MATCH}, h AS (SELECT *, {O.group('base', '^([0-9]+)', 1)} AS house FROM m), "
    "pairs AS (SELECT a._ord AS a, b._ord AS b, a.base AS a_base, b.base AS b_base, (a.po OR a.base = b.base) AS sure FROM h a JOIN h b ON a.block = b.block AND a._ord < b._ord WHERE a.po = b.po "
    "AND CASE WHEN a.po THEN a.box = b.box ELSE a.unit = b.unit AND a.base <> '' AND b.base <> '' AND (a.house = '' OR b.house = '' OR a.house = b.house) END "
    "AND NOT (a.second <> '' AND b.second <> '' AND a.second <> b.second) "
    f"AND (a.po OR a.base = b.base OR 2.0 * least(length(a.base), length(b.base)) >= {K.ADDRESS_RATIO} * (length(a.base) + length(b.base))))"
)
_add("match_columns", lambda s, d: match_columns(_singles(s, d)).drop("house"), f"WITH {_MATCH} SELECT _ord, block, second, po, box, unit, base FROM m")
_add(
    "sure_clusters",
    lambda s, d: connected_components(similar_links(match_columns(_singles(s, d))).where("sure").select("a", "b")),
    f"WITH RECURSIVE {_PAIRS}, e AS (SELECT a AS x, b AS y FROM pairs WHERE sure UNION SELECT b, a FROM pairs WHERE sure), "
    "reach AS (SELECT x AS node, x AS other FROM e UNION SELECT reach.node, e.y FROM reach JOIN e ON reach.other = e.x) SELECT node, min(other) AS component FROM reach GROUP BY node",
)
_add("blocked_pairs", lambda s, d: _blocked(s, d), f"WITH {_MATCH} SELECT block, count(*) AS n, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS pairs FROM m GROUP BY block")
_add("pair_gates", lambda s, d: gated_pairs(match_columns(_singles(s, d))).select("a", "b", "sure"), f"WITH {_PAIRS} SELECT a, b, sure FROM pairs")


def _run(x: str, y: str) -> str:
    """The longest run that both texts hold, the earliest in the first: 1000 times its length less its place."""
    found = f"CASE WHEN strpos({y}, substr({x}, i, k)) > 0 THEN 1000 * k - i ELSE -1 END"
    return f"list_max(flatten(list_transform(range(1, length({x}) + 1), lambda i: list_transform(range(1, length({x}) - i + 2), lambda k: {found}))))"


#: The ratio by its definition: the longest run, the earliest in the first text and then in the second; then the same on either side of
#: it. A step of the recursion takes every stretch that is left; the runs' lengths add up to the letters matched.
_RATIOS = (
    f"{_PAIRS}, texts AS (SELECT DISTINCT a_base AS one, b_base AS two FROM pairs WHERE NOT sure), "
    f"stretches AS (SELECT one, two, one AS x, two AS y, {_run('one', 'two')} AS run FROM texts "
    f"UNION ALL SELECT one, two, x, y, {_run('x', 'y')} AS run FROM ("
    "SELECT one, two, CASE side WHEN 1 THEN substr(x, 1, i - 1) ELSE substr(x, i + k) END AS x, CASE side WHEN 1 THEN substr(y, 1, j - 1) ELSE substr(y, j + k) END AS y FROM ("
    "SELECT *, strpos(y, substr(x, i, k)) AS j FROM (SELECT *, 1000 * k - run AS i FROM (SELECT one, two, x, y, run, CAST(ceil(run / 1000.0) AS BIGINT) AS k FROM stretches WHERE run > 0) s0) s1) s2, (SELECT unnest([1, 2]) AS side) sides) s3 WHERE x <> '' AND y <> ''), "
    f"alike AS (SELECT one, two FROM stretches GROUP BY one, two HAVING 2.0::DOUBLE * sum(CASE WHEN run > 0 THEN ceil(run / 1000.0) ELSE 0 END) / (length(one) + length(two)) >= {K.ADDRESS_RATIO}::DOUBLE), "
    "near AS (SELECT a, b FROM pairs WHERE sure UNION SELECT a, b FROM pairs JOIN alike ON NOT sure AND a_base = one AND b_base = two)"
)


def _blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    return match_columns(_singles(spark, sf_dir)).groupBy("block").agg(F.count("*").alias("n")).withColumn("pairs", (n * (n - 1) / 2).cast("long"))


def _as_result(df: DataFrame) -> DataFrame:
    return df.withColumn("phase", F.lit(0)).withColumn("cluster", F.col("_ord")).withColumn("sub", F.lit(0))


_add("source_breakdown", lambda s, d: V.source_breakdown(_rows(s, d)), f"WITH {_ROWS} SELECT source, sum(one)::BIGINT AS records FROM (SELECT CASE WHEN data_source LIKE '%,%' THEN 'Multi-source' ELSE data_source END AS source, 1 AS one FROM rows_ UNION ALL SELECT unnest(['Consumer', 'Business', 'Parcel', 'Multi-source']), 0) x GROUP BY source")
_add(
    "dq_counters",
    lambda s, d: V.quality_counts(_rows(s, d)),
    f"WITH {_ROWS} SELECT " + ", ".join(f"coalesce(sum(CASE WHEN {w} THEN 1 ELSE 0 END), 0)::BIGINT AS {n}" for n, w in {
        "empty_name": "trim(full_name) = ''", "empty_address": "trim(street) = ''", "empty_city": "trim(city) = ''", "empty_state": "trim(state) = ''",
        "invalid_state": f"trim(state) <> '' AND {O.state('state')} = ''", "malformed_zip": f"NOT {O.zip_valid('zip', 'state')}", "trust_twice": O.has("full_name", K.TRUST_TWICE)}.items()) + " FROM rows_",
)
_SHARED = "shared AS (SELECT DISTINCT key FROM (SELECT key, trim(s.source) AS source, count(*) AS n FROM k, unnest(string_split(data_source, ',')) AS s(source) GROUP BY key, trim(s.source)) x WHERE n > 1)"
_add(
    "dup_keys",
    lambda s, d: V.duplicate_keys(_rows(s, d)),
    f"WITH {_ROWS}, k AS (SELECT *, {O.address_key('trim(street)', 'trim(city)', 'trim(state)', 'trim(zip)')} AS key FROM rows_ WHERE trim(street) <> ''), {_SHARED} "
    "SELECT key, count(*) AS n FROM k WHERE key IN (SELECT key FROM shared) GROUP BY key HAVING count(*) > 1",
)
_add(
    "dup_po",
    lambda s, d: V.duplicate_boxes(_as_result(_rows(s, d))).select("key", F.array_join("names", " | ").alias("names")),
    f"WITH {_ROWS}, k AS (SELECT *, coalesce({O.po('street')}, '') || '|' || upper(trim(city)) || '|' || upper(trim(state)) || '|' || {O.zip_('zip')} AS key, trim(full_name) AS name FROM rows_ WHERE {O.is_po('street')}), {_SHARED}, "
    f"one AS (SELECT key, name, min(_ord) AS o, list_distinct({O.words('upper(name)')}) AS w FROM k WHERE name <> '' GROUP BY key, name), "
    "best AS (SELECT key, w AS richest FROM (SELECT key, w, row_number() OVER (PARTITION BY key ORDER BY len(w) DESC, o) AS n FROM one) x WHERE n = 1), "
    "odd AS (SELECT DISTINCT one.key FROM one JOIN best ON one.key = best.key WHERE len(list_filter(w, lambda t: NOT list_contains(richest, t))) > 0) "
    "SELECT key, string_agg(name, ' | ' ORDER BY o) AS names FROM one WHERE key IN (SELECT key FROM odd) AND key IN (SELECT key FROM shared) GROUP BY key HAVING count(*) > 1",
)
_REASONS = [
    ("trim(full_name) = ''", "Empty name"), ("trim(street) = ''", "Empty address"), ("trim(city) = '' OR trim(state) = '' OR trim(zip) = ''", "Missing address field (City/State/Zip)"),
    ("full_name LIKE '%,%'", "Possible unparsed name (LAST, FIRST)"), ("lower(trim(full_name)) LIKE 'parcel %'", "No owner name (parcel ID used)"),
    (O.has("trim(street)", K.UNDELIVERABLE), "Undeliverable/returned address"), ("full_name LIKE '%Life Estate%'", "Life Estate owner (verify estate contact)"),
]
_add(
    "review_reasons",
    lambda s, d: _rows(s, d).select("_ord", review_reason([]).alias("reason")),
    f"WITH {_ROWS} SELECT _ord, concat_ws('; ', {', '.join(f'CASE WHEN {w} THEN {O.q(t)} END' for w, t in _REASONS)}) AS reason FROM rows_",
)
_add(
    "consolidation_stats",
    lambda s, d: volumes(_rows(s, d), exact_groups(_rows(s, d))),
    f"WITH {_KEYED}, n AS (SELECT count(*) AS a, count(DISTINCT key) AS b FROM keyed) SELECT a AS input_records, b AS output_records, a - b AS records_consolidated, (a - b) / a::DOUBLE AS consolidation_rate, round((a - b) * {K.COST_PER_PIECE}::DOUBLE, 2) AS cost_savings FROM n",
)
_add("trust_list", lambda s, d: V.trusts(_rows(s, d)).select("_ord", "full_name"), f"WITH {_ROWS} SELECT _ord, full_name FROM rows_ WHERE trim(full_name) <> '' AND {O.is_trust('trim(full_name)')}")
_add(
    "bad_samples",
    lambda s, d: V.samples(_rows(s, d), V.bad_zip(), "zip"),
    f"WITH {_ROWS} SELECT DISTINCT zip FROM rows_ WHERE NOT {O.zip_valid('zip', 'state')} ORDER BY zip LIMIT 10",
)

_add("trusts_shown", lambda s, d: in_order(V.trusts(_as_result(_rows(s, d)))).limit(50).select("_ord", "full_name"), SQL["trust_list"] + " ORDER BY _ord LIMIT 50")
_BOX = f"CASE WHEN {O.is_po('street')} THEN coalesce({O.po('street')}, '') || '|' || upper(trim(city)) || '|' || upper(trim(state)) || '|' || {O.zip_('zip')} END"
_KEY = f"CASE WHEN trim(street) <> '' THEN {O.address_key('trim(street)', 'trim(city)', 'trim(state)', 'trim(zip)')} END"
_QUALITY = (
    f"CASE WHEN {O.has('full_name', K.TRUST_TWICE)} THEN 'Name formatting issue (Trust Trust)' ELSE nullif(concat_ws('; ', CASE WHEN trim(state) <> '' AND {O.state('state')} = '' THEN 'Unrecognized state code (' || state || ')' END, "
    f"CASE WHEN NOT {O.zip_valid('zip', 'state')} THEN 'Malformed ZIP (' || zip || ')' END), '') END"
)
_add(
    "flagged_rows",
    lambda s, d: V.flag_rows(_as_result(_rows(s, d)).withColumn("needs_review", F.lit("")).withColumn("review_reason", F.lit("seen"))).select("_ord", "needs_review", "review_reason"),
    f"WITH boxes AS ({SQL['dup_po']}), keys AS ({SQL['dup_keys']}), {_ROWS}, r AS (SELECT _ord, {_QUALITY} AS quality, {_KEY} AS address_key, {_BOX} AS box FROM rows_), "
    "f AS (SELECT _ord, coalesce(quality, CASE WHEN address_key IN (SELECT key FROM keys) THEN 'Duplicate address key (' || address_key || ')' END, CASE WHEN box IN (SELECT key FROM boxes) THEN 'Duplicate PO box (' || box || ')' END) AS reason FROM r) "
    "SELECT _ord, CASE WHEN reason IS NULL THEN '' ELSE 'Yes' END AS needs_review, CASE WHEN reason IS NULL THEN 'seen' ELSE 'seen; ' || reason END AS review_reason FROM f",
)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_report(spark, write_report(V.issue_lines(_as_result(_rows(spark, sf_dir)))))


_add(
    "report_read_back", _report,
    f"WITH b AS (SELECT count(*) AS n FROM ({SQL['dup_po']}) x), k AS (SELECT count(*) AS n FROM ({SQL['dup_keys']}) x), c AS ({SQL['dq_counters']}) "
    "SELECT CASE WHEN b.n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, b.n AS errors, k.n + (empty_name > 0)::BIGINT + (empty_address > 0)::BIGINT + (empty_city > 0)::BIGINT + (empty_state > 0)::BIGINT "
    "+ (invalid_state > 0)::BIGINT + (malformed_zip > 0)::BIGINT + (trust_twice > 0)::BIGINT AS warnings FROM b, k, c",
)

# --- what SQL has no words for: the grammar of names, ratios, merging

def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [fn(_feed(spark, sf_dir, n)) for fn, n in ((feeds.consumer, "mail_consumer"), (feeds.business, "mail_business"), (feeds.parcel, "mail_parcel"))]
    return union_feeds(*made, own_sources=True)


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate(combined(spark, sf_dir))


def consolidation_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of a run: the combined list against the consolidated one. ``consolidation_stats`` has the part of
    it that SQL can express, the exact groups of the rows as they come."""
    rows = write_table(combined(spark, sf_dir), "combined")
    return volumes(rows, consolidate(rows))


_add("consumer_feed", lambda s, d: feeds.consumer(_feed(s, d, "mail_consumer")))
_add("business_feed", lambda s, d: feeds.business(_feed(s, d, "mail_business")))
_add("parcel_feed", lambda s, d: feeds.parcel(_feed(s, d, "mail_parcel")))
_add("owner_parse", lambda s, d: view(s, d, "mail_parcel").select("_ord", H.parse_owner(F.col("owner")).alias("o")).select("_ord", "o.*"))
_add("person_lastfirst", lambda s, d: view(s, d, "mail_parcel").select("_ord", H.person_from_last_first(F.col("owner")).alias("shown")))
_add("trust_format", lambda s, d: V.trusts(_rows(s, d)).select("_ord", H.format_trust(F.col("full_name")).alias("shown")))
_add("household_split", lambda s, d: _rows(s, d).select("_ord", H.individuals(F.col("full_name")).alias("persons")))
_add("household_combine", lambda s, d: _rows(s, d).select("_ord", H.combine_household(H.individuals(F.col("full_name"))).alias("household")))
_add("fuzzy_pairs", lambda s, d: similar_pairs(match_columns(_singles(s, d))), f"WITH RECURSIVE {_RATIOS} SELECT a, b FROM near")
_add(
    "fuzzy_clusters",
    lambda s, d: address_clusters(match_columns(_singles(s, d))),
    f"WITH RECURSIVE {_RATIOS}, e AS (SELECT a AS x, b AS y FROM near UNION SELECT b, a FROM near), "
    "reach AS (SELECT x AS node, x AS other FROM e UNION SELECT reach.node, e.y FROM reach JOIN e ON reach.other = e.x) SELECT node AS _ord, min(other) AS cluster FROM reach GROUP BY node",
)
_add("entity_canonical", lambda s, d: canonical_names(view(s, d, "mail_business").where("company <> ''").select("_ord", F.col("company").alias("name"))))
_add("placed_rows", lambda s, d: place_rows(write_table(combined(s, d), "combined")).select("_ord", "phase", "cluster", "n"))
_add("consolidated", consolidated)
_add("consolidation_volumes", consolidation_volumes)
_add("validated", lambda s, d: V.flag_rows(consolidated(s, d)))
_add("output_order", lambda s, d: in_order(consolidated(s, d)))
