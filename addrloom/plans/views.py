"""Feeds made of the star schema, in SQL that Spark and DuckDB both run: every form of name and address that the rules know."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from addrloom.shared import spread


def _pick(key: str, values: list[str]) -> str:
    quoted = [v.replace("'", "''") for v in values]
    return f"CASE ({key}) % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(quoted)) + " END"


_FIRST = ["JOHN", "MARY", "ROBERT", "LINDA", "MICHAEL", "ANA", "WILLIAM", "MARTHA", "AARON", "JOSE", "KAREN", "PATRICK", "SUE"]
_LAST = ["SMITH", "JOHNSON", "DE LA CRUZ", "OBRIEN", "MCDONALD", "GARCIA", "VAN DYKE", "CHEN", "O'NEIL", "MACARTHUR", "ROLON-MEZA", "LEE", "DAVIS", "TRUJILLO", "WELLS", "NGUYEN", "ORTEGA"]
_STREET = ["OAK", "MAIN", "DESERT ROSE", "FLORENCE", "2ND", "PIMA", "E MAPLE", "STATE ROUTE 87", "LOTUS", "12TH", "WEST PARK", "ELM"]
_LONG = ["STREET", "AVENUE", "ROAD", "DRIVE", "BOULEVARD", "LANE", "WAY", "COURT", "LOOP", "PARKWAY", "TRAIL"]
_SHORT = ["St", "Ave.", "Rd", "Dr", "Blvd", "Ln", "Way", "Ct.", "Loop", "Pkwy", "Trl"]
_WAY = ["", "N ", "South ", "E. ", "SW "]
_COMPANY = ["ACME HARDWARE", "WESTPARK OZ VENTURES", "VALLEY MEDICAL GROUP", "ABC INVESTMENTS", "THE HOUSE OF TEA", "MCKAY AND SONS", "KEMF WP 3 EAST", "CITY OF MESA", "DEPT OF WATER", "ST MARY CHURCH"]
_FORM = ["LLC", "INC.", "L L C", "Corp", "LTD PMT # 123", "CO", "L P", "", "PARTNERS"]
_STATE = ["AZ", " ca ", "NV", "ON", "XX", "AE", "NM"]


def _number(key: str) -> str:
    return f"CAST(100 + ({key}) % 877 AS STRING)"


def _zip(nation: str, key: str) -> str:
    return f"CASE WHEN ({key}) % 41 = 3 THEN 'm5v' || '3a8' WHEN ({key}) % 43 = 5 THEN '8' || CAST({nation} AS STRING) ELSE CAST(85000 + {nation} * 4 + ({key}) % 4 AS STRING) END"


#: Name to SQL over the tables; ``{customer}`` and so on stand for them.
VIEWS = {
    "mail_consumer": f"""
        SELECT c_custkey AS _ord,
          {_pick('c_custkey', _FIRST)} || CASE WHEN c_custkey % 9 = 4 THEN ' ' || substr('ABCDEFGHIJ', CAST(1 + c_custkey % 10 AS INT), 1) ELSE '' END AS first,
          {_pick('c_custkey', _LAST)} AS last,
          {_number('c_custkey')} || ' ' || {_pick('c_custkey', _WAY)} || {_pick('c_custkey', _STREET)} || ' ' || {_pick('c_custkey', _SHORT)} AS addr1,
          CASE c_custkey % 8 WHEN 1 THEN 'Apt ' || CAST(c_custkey % 30 AS STRING) WHEN 5 THEN 'Ste. 200' WHEN 6 THEN '# 7B' WHEN 7 THEN 'nan' ELSE '' END AS addr2,
          '  ' || n_name || '  beach' AS city, {_pick('c_custkey', _STATE)} AS state, {_zip('n_nationkey', 'c_custkey')} AS zip
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "mail_business": f"""
        SELECT s_suppkey AS _ord,
          CASE WHEN s_suppkey % 6 = 2 THEN '' ELSE {_pick('s_suppkey', _COMPANY)} || ' ' || {_pick('s_suppkey', _FORM)} END AS company,
          {_pick('s_suppkey + 3', _COMPANY)} || ' dba' AS dba,
          CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE ' Tom   Wilson ' END AS contact, CASE s_suppkey % 3 WHEN 0 THEN 'Store  Manager' WHEN 1 THEN '' ELSE 'and Owner' END AS title,
          {_number('s_suppkey')} || ' ' || {_pick('s_suppkey', _WAY)} || {_pick('s_suppkey', _STREET)} || ' ' || {_pick('s_suppkey', _LONG)}
            || CASE s_suppkey % 5 WHEN 1 THEN ', SUITE 12-A' WHEN 2 THEN ' - NULL' WHEN 3 THEN ' c/o Front Desk' ELSE '' END AS addr,
          n_name || ' beach' AS city, {_pick('s_suppkey', _STATE)} AS state, {_zip('n_nationkey', 's_suppkey')} AS zip
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "mail_parcel": f"""
        SELECT o_orderkey AS _ord,
          CASE o_orderkey % 23
            WHEN 1 THEN {_pick('o_custkey', _LAST)} || ' ' || {_pick('o_custkey', _FIRST)} || ' & ' || {_pick('o_custkey + 1', _FIRST)}
            WHEN 2 THEN {_pick('o_custkey', _LAST)} || ' ' || {_pick('o_custkey', _FIRST)} || ' W/' || {_pick('o_custkey + 2', _FIRST)} || ' A'
            WHEN 3 THEN {_pick('o_custkey', _LAST)} || ' FAMILY TRUST' WHEN 4 THEN {_pick('o_custkey', _LAST)} || ' ' || {_pick('o_custkey', _FIRST)} || ' LE'
            WHEN 5 THEN {_pick('o_custkey', _COMPANY)} || ' ' || {_pick('o_custkey', _FORM)} WHEN 6 THEN 'PENDING' WHEN 7 THEN '' WHEN 8 THEN 'TOWN OF ' || {_pick('o_custkey', _STREET)}
            WHEN 9 THEN {_pick('o_custkey', _LAST)} || ' ' || {_pick('o_custkey', _FIRST)} || ' E JR' WHEN 10 THEN 'THE ' || {_pick('o_custkey', _LAST)} || ' LIVING TRUST'
            WHEN 11 THEN {_pick('o_custkey', _LAST)} || ', ' || {_pick('o_custkey', _FIRST)} || ' and ' || {_pick('o_custkey + 5', _FIRST)}
            ELSE {_pick('o_custkey', _LAST)} || ' ' || {_pick('o_custkey', _FIRST)} END AS owner,
          CASE o_orderkey % 19 WHEN 2 THEN 'C/O JOHN DOE' WHEN 3 THEN 'ATTN: TAX DEPT' WHEN 5 THEN 'WELLS MARY M' WHEN 7 THEN 'n/a' ELSE '' END AS line2,
          CASE o_orderkey % 31
            WHEN 1 THEN 'P.O. Box ' || CAST(o_custkey % 97 AS STRING) WHEN 2 THEN 'PO BOX DRAWER ' || CAST(o_custkey % 9 AS STRING) WHEN 3 THEN 'RURAL ROUTE ' || CAST(o_custkey % 5 AS STRING) || ', BOX ' || CAST(o_custkey % 50 AS STRING)
            WHEN 4 THEN 'HCR 2 Box 10A' WHEN 5 THEN 'PSC 1234 BOX ' || CAST(o_custkey % 20 AS STRING) WHEN 6 THEN 'VACANT' WHEN 7 THEN 'mail returned' WHEN 8 THEN 'N/A'
            WHEN 9 THEN 'RR 1 BOX 50 PO BOX 7' WHEN 10 THEN 'POBOX' || CAST(o_custkey % 12 AS STRING) WHEN 11 THEN 'MAILBOX ' || CAST(o_custkey % 9 AS STRING)
            WHEN 12 THEN {_number('o_custkey')} || ' ' || {_pick('o_custkey', _WAY)} || substr({_pick('o_custkey', _STREET)}, 2) || ' ' || {_pick('o_custkey', _LONG)}
            WHEN 13 THEN {_pick('o_custkey', _STREET)} || ' ' || {_pick('o_custkey', _LONG)}
            WHEN 14 THEN {_number('o_custkey')} || ' ' || {_pick('o_custkey', _STREET)} || ' ' || {_pick('o_custkey', _LONG)} || ' ' || n_name || ' AZ 85201-1234'
            ELSE {_number('o_custkey + o_orderkey % 3')} || ' ' || upper({_pick('o_custkey', _WAY)}) || {_pick('o_custkey', _STREET)} || ' ' || {_pick('o_custkey', _LONG)}
              || CASE c_custkey % 8 WHEN 1 THEN ' APARTMENT ' || CAST(c_custkey % 30 AS STRING) WHEN 5 THEN ' STE 200' WHEN 6 THEN ' #7B' ELSE '' END END AS addr,
          n_name || ' BEACH' AS city, {_pick('o_custkey', _STATE)} AS state, {_zip('n_nationkey', 'o_custkey')} || CASE o_orderkey % 4 WHEN 1 THEN '-0725' WHEN 2 THEN '0725' ELSE '' END AS zip,
          n_name || ' ' || substr({_pick('o_custkey', _STATE)}, 1, 2) || ' 8520' || CAST(o_orderkey % 10 AS STRING) || CASE o_orderkey % 3 WHEN 1 THEN '-1234' ELSE '' END AS csz,
          CAST(o_orderkey AS STRING) AS pid
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
}
#: All feeds as they come, in one form.
VIEWS["mail_rows"] = f"""
    SELECT 'Consumer' AS data_source, _ord, trim(first) || ' ' || trim(last) AS full_name, '' AS second_line, trim(addr1 || ' ' || CASE WHEN addr2 = 'nan' THEN '' ELSE addr2 END) AS street, city, state, zip FROM ({VIEWS['mail_consumer']}) c
    UNION ALL SELECT 'Business', 1000000000 + _ord, CASE WHEN company = '' THEN dba ELSE company END, trim(contact), addr, city, state, zip FROM ({VIEWS['mail_business']}) b
    UNION ALL SELECT CASE WHEN _ord % 13 = 6 THEN 'Consumer, Parcel' ELSE 'Parcel' END, 2000000000 + _ord, owner, line2, addr, city, state, zip FROM ({VIEWS['mail_parcel']}) p"""

TABLES = ("customer", "nation", "orders", "supplier")
#: The tables that rows are made of, and what they are dealt by.
DEALT = {"customer": "c_custkey", "orders": "o_orderkey", "supplier": "s_suppkey"}


def sql_of(name: str) -> str:
    """The view's query over tables of their own names."""
    return VIEWS[name].format(**{t: t for t in TABLES})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view's rows. Its tables are dealt over all cores where they come in few parts, before anything is worked out."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in VIEWS[name]}
    return spark.sql(VIEWS[name], **{t: spread(df, DEALT[t]) if t in DEALT else df for t, df in used.items()})
