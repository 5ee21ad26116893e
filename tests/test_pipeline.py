"""Whole lists: the sample files' golden result, merging, matching, checks, files."""

import zipfile

import plain_merge
import pytest
from pyspark.sql import functions as F

from addrloom.functions import grammar as G
from addrloom.functions import rules as R
from addrloom.functions.similar import merged_name
from addrloom.operators.components import connected_components
from addrloom.operators.matching import address_clusters, canonical_names, exact_key, match_columns, similar_pairs
from addrloom.plans import validate as V
from addrloom.plans.consolidate import consolidate, in_order, union_feeds
from addrloom.plans.report import elapsed, read_validation_report, run_to_folder, validation_report
from addrloom.sources import feeds
from addrloom.sources.files import empty_feed, read_feed, row_count

CONSUMER = """First Name,Last Name,Street Address 1,Street Address 2,City,State,Zip
John,Smith,123 Oak Street,,Phoenix,AZ,85001
Mary,Johnson,456 Elm Avenue,Apt 2B,Mesa,AZ,85201
"""
BUSINESS = """Address Line 1,Address Line 2,Name Line 1,Name Line 2,City,State,Zip
Acme Hardware LLC,100 Industrial Pkwy,Tom Wilson,Store Manager,Mesa,AZ,85201
"""
PARCEL = """OWNER_NAME_FULL,MAIL_ADDRESS,MAIL_CITY,MAIL_STATE,MAIL_ZIP
SMITH JOHN,123 OAK ST,PHOENIX,AZ,85001
JOHNSON MARY,456 ELM AVE APT 2B,MESA,AZ,85201-1234
RODRIGUEZ FAMILY TRUST,PO BOX 500,FLORENCE,AZ,85132
,9 NOWHERE RD,MESA,AZ,85201
"""


def rows_of(spark, *rows):
    """Rows of (source, name, second line, street[, city, state, zip]) as a combined list."""
    full = [(i, *r, *("Mesa", "AZ", "85201")[len(r) - 4 :]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(full, "_ord long, data_source string, full_name string, second_line string, street string, city string, state string, zip string")
    return df.select(*[(F.col(c) if c in df.columns else F.lit("")).alias(c) for c in [*R.FIELDS, *R.LINEAGE]], "_ord")


def result(spark, *rows, **kw):
    return in_order(consolidate(rows_of(spark, *rows), **kw)).collect()


def test_files_to_result(spark, tmp_path):
    for name, content in (("c", CONSUMER), ("b", BUSINESS), ("p", PARCEL)):
        (tmp_path / f"{name}.csv").write_text(content)
    run = run_to_folder(spark, str(tmp_path / "out"), consumer=str(tmp_path / "c.csv"), business=str(tmp_path / "b.csv"), parcel=str(tmp_path / "p.csv"))
    got = [(r.data_source, r.full_name, r.second_line, r.street, r.zip) for r in in_order(run.consolidated).collect()]
    assert got == [
        ("Consumer, Parcel", "John Smith", "", "123 Oak St.", "85001"),
        ("Consumer, Parcel", "Mary Johnson", "", "456 Elm Ave. Apt 2B", "85201"),
        ("Business", "Acme Hardware LLC", "Tom Wilson, Store Manager", "100 Industrial Pkwy.", "85201"),
        ("Parcel", "Rodriguez Family Trust", "", "PO BOX 500", "85132"),
    ]
    first = in_order(run.consolidated).first()
    assert first.owner1_original == "John Smith | SMITH JOHN" and first.p1_first == "" and run.status == "PASS" and run.counts == {"consumer": 2, "business": 1, "parcel": 3}
    text = (tmp_path / "out/consolidated.csv").read_bytes()
    assert text.startswith(b"\xef\xbb\xbfData_Source,") and b"Title\\Department (2nd line)" in text
    assert "Suppressed records: 2" in (tmp_path / "out/stats.txt").read_text()
    again = read_validation_report((tmp_path / "out/validation_report.txt").read_text())
    assert again == {"status": "PASS", "errors": 0, "warnings": 0, "details": []} and read_validation_report(None)["status"] == "UNKNOWN"
    assert read_feed(spark, str(tmp_path / "out/consolidated.csv")).columns[0] == "Data_Source" and elapsed(75) == "1:15"
    with pytest.raises(FileNotFoundError):
        run_to_folder(spark, str(tmp_path))


def test_groups_merge(spark):
    six = [("Parcel", f"{n} Smith", "", "1 Oak St.") for n in ("Ann", "Bob", "Carl", "Dora", "Eve", "Fay")]
    got = result(spark, *six, ("Consumer", "Acme LLC", "", "1 Oak Street"), ("Parcel", "X", "", "VACANT"), ("Parcel", "Y", "", "VACANT"))
    assert [r.full_name for r in got] == ["Acme LLC", "Ann, Bob, Carl, Dora, & Eve Smith", "X", "Y"]
    assert "Household capped at 5 (had 6)" in got[1].review_reason and got[2].review_reason == "Undeliverable/returned address"
    suites = (("A", "Jo Lee", "", "9 Oak St. Ste. 100"), ("B", "Al Kim", "", "9 Oak St. Ste. 200"))
    assert len({r.cluster for r in result(spark, *suites)}) == 1 and len({r.cluster for r in result(spark, *suites, unit_mode="strict")}) == 2
    both = result(spark, ("Consumer", "Jennifer Davis", "", "3 Elm St."), ("Parcel", "Jennifer & Michael Davis", "", "3 Elm St."))
    assert both[0].full_name == "Jennifer & Michael Davis" and both[0].review_reason == "Cross-source household merge" and both[0].data_source == "Consumer, Parcel"
    apart = result(spark, ("Consumer", "Ann Lee", "", "3 Elm St."), ("Parcel", "Bo Kim", "", "3 Elm St."))
    assert [r.full_name for r in apart] == ["Ann Lee", "Bo Kim"]
    assert merged_name(["Butterfield Trail Investments", "Buttefield Trail Investments"], False) == ("Butterfield Trail Investments", 0)
    assert consolidate(rows_of(spark, ("a", "b", "", "c")).limit(0)).count() == 0


def test_similar_addresses(spark):
    got = result(
        spark, ("A", "Jo Lee", "x and y", "123 Butterfield Trail"), ("B", "Jo Lee", "", "123 Buterfield Trail"), ("C", "Jo Lee", "z", "123 Butterfeld Trail"), ("A", "Jo Lee", "", "124 Butterfield Trail"),
        ("A", "Bo Po", "", "PO BOX 9"), ("A", "Bo Po", "", "PO BOX 2190"), ("A", "Cy Fu", "", "77 Elm Ste 5"), ("A", "Cy Fu", "", "77 Elm Ste 6"), ("A", "PENDING", "", "123 Butterfield Trail", "Mesa", "AZ", "85202"),
    )
    assert [(r.cluster, r.review_reason) for r in got if r.cluster == 0] == [(0, "Fuzzy address match")]
    assert len(got) == 7 and got[-1].phase == 2


def plain_similar(a, b):
    """All pairs, from the columns that the engine compares by."""
    if a.block != b.block or a.po != b.po or (a.second and b.second and a.second != b.second):
        return False
    if a.po:
        return a.box == b.box
    if a.unit != b.unit or not a.base or not b.base or (a.house and b.house and a.house != b.house):
        return False
    return a.base == b.base or G.ratio(a.base, b.base) >= R.ADDRESS_RATIO


def test_pairs_agree_with_all_pairs(spark):
    import random

    rng = random.Random(3)
    streets = [f"{rng.choice(['12', '13', ''])} {rng.choice(['Butterfield', 'Buterfield', 'Butterfeld', 'Oak', 'Oaks'])} {rng.choice(['Trail', 'Trl', 'St'])} {rng.choice(['', '', 'Apt 2', '#3'])}".strip() for _ in range(90)] + [f"PO Box {rng.randrange(4)}" for _ in range(10)]
    rows = match_columns(rows_of(spark, *[("s", "n", rng.choice(["", "", "a", "b"]), s) for s in streets]))
    got = {(r.a, r.b) for r in similar_pairs(rows).collect()}
    all_ = sorted(rows.collect(), key=lambda r: r._ord)
    want = {(a._ord, b._ord) for i, a in enumerate(all_) for b in all_[i + 1 :] if plain_similar(a, b)}
    assert got == want
    assert address_clusters(rows).where("cluster > _ord").count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (95, 100)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_company_names(spark):
    names = ["Butterfield Trail Investments", "Buttefield Trail Investments", "Acme LLC", "Butterfield Trail Investments DO NOT MAIL"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "_ord long, name string")
    got = {r.name: r.canonical for r in canonical_names(df).collect()}
    assert got[names[0]] == got[names[1]] == "Butterfield Trail Investments" and got["Acme LLC"] == "Acme LLC"


def test_checks(spark):
    rows = rows_of(
        spark, ("Parcel", "John Smith", "", "PO Box 5"), ("Parcel", "Jane Doe", "", "PO Box 5"), ("Consumer", "Jane Doe", "", "PO Box 5"), ("Business", "Smith Trust Trust", "", "1 Elm", "", "ZZ", "123"),
        ("Consumer", "A", "", "2 Elm", "Mesa", "ON", "M5V 3A8"), ("Parcel", "John", "q", "PO Box 6"), ("Parcel", "John & Jane Smith", "", "PO Box 6"),
    ).withColumn("phase", F.lit(0)).withColumn("cluster", F.col("_ord")).withColumn("sub", F.lit(0)).withColumn("needs_review", F.lit("")).withColumn("review_reason", F.lit("old"))
    found = V.issues(rows)
    assert V.status(found) == "FAIL" and found[0] == "ERROR: Duplicate PO Box with distinct names at PO BOX 5|MESA|AZ|85201: ['John Smith', 'Jane Doe']"
    assert "WARNING: Duplicate address key 'PO BOX 5|MESA|AZ|85201' at rows [0, 1, 2]" in found and sum("PO BOX 6" in x for x in found) == 1
    assert "WARNING: 1 record(s) have unrecognized state code (sample: ['ZZ'])" in found and "WARNING: 1 record(s) have empty city" in found
    flagged = {r._ord: r.review_reason for r in V.flag_rows(rows).collect()}
    assert flagged[0] == "old; Duplicate address key (PO BOX 5|MESA|AZ|85201)" and flagged[3] == "old; Name formatting issue (Trust Trust)" and flagged[4] == "old"
    assert {r.source: r.records for r in V.source_breakdown(rows).collect()} == {"Consumer": 2, "Business": 1, "Parcel": 4, "Multi-source": 0}
    assert "Errors: 1" in validation_report(found)


def test_feeds_bind_by_alias(spark):
    df = spark.createDataFrame([(" smith john ", "1 Oak St", "MESA AZ 85201-1234", "C/O BOB", "77"), ("<Null>", "2 OAK ST", "", "WELLS MARY M", "78")], "`owner name` string, ` Mailing Address ` string, CSZ string, `Name Line 2` string, APN string")
    got = feeds.parcel(df).orderBy("_ord").collect()
    assert (got[0].city, got[0].state, got[0].zip, got[0].second_line, got[0].titledept_original) == ("Mesa", "AZ", "85201", "C/O BOB", "C/O BOB")
    assert (got[1].full_name, got[1].second_line) == ("Parcel 78 & Mary M. Wells", "")
    none = feeds.consumer(spark.createDataFrame([("Al", "Lee")], "First string, Last string")).first()
    assert none.full_name == "Al Lee" and none.street == ""
    assert feeds.business(spark.createDataFrame([("", "Joe's", "")], "Company string, DBA string, Contact string")).first().full_name == "Joe's"
    assert feeds.looks_like_streets(spark.createDataFrame([(f"{i} Oak",) for i in range(5)], "Company string"))
    twice = feeds.parcel(spark.createDataFrame([("A B", "1 Oak", "x"), ("A B", "1 OAK", "y")], "OWNER string, Address string, extra string"))
    assert twice.count() == 1
    with pytest.raises(ValueError):
        union_feeds(spark.createDataFrame([("x",)], "city string").withColumn("_ord", F.lit(0)))
    assert union_feeds(empty_feed(spark), None).count() == 0 and row_count(None) == 0


@pytest.mark.parametrize("data", ["Name,City\nJosé,Zoë\n".encode(), b"\xef\xbb\xbf" + "Name,City\nJosé,Zoë\n".encode(), "Name,City\nJosé,Zoë\n".encode("cp1252")])
def test_encodings(spark, tmp_path, data):
    (tmp_path / "a.csv").write_bytes(data)
    got = read_feed(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["Name", "City", "_ord"] and tuple(got.first())[:2] == ("José", "Zoë")


def test_workbooks(spark, tmp_path):
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Notes" r:id="a"/><sheet name="OWNERS" r:id="b"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="p"><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>Owner</t></si><si><r><t>SMITH</t></r><r><t> JOHN</t></r></si></sst>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>Zip</t></is></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2"><v>85201</v></c></row></sheetData></worksheet>')
    got = read_feed(spark, str(tmp_path / "a.xlsx"))
    assert got.columns == ["Owner", "Unnamed: 1", "Zip", "_ord"] and tuple(got.first()) == ("SMITH JOHN", "", "85201", 0)
    with pytest.raises(ValueError):
        read_feed(spark, "a.txt")


def test_exact_keys(spark):
    rows = rows_of(spark, ("a", "n", "", "RR 1 BOX 50 PO BOX 7"), ("a", "n", "C/O A and B", "1 Oak"), ("a", "n", "c/o a & b", "1 OAK"), ("a", "n", "", "unknown"), ("a", "n", "", ""))
    keys = [r.k for r in rows.select(exact_key().alias("k"), "_ord").orderBy("_ord").collect()]
    assert keys[0].startswith("None|MESA") and keys[1] == keys[2] and keys[3:] == ["NO_STREET::3", "NO_STREET::4"]


def test_volumes_agree_with_the_plain_merge(spark, tmp_path):
    from addrloom.plans import catalog

    for name, first, end, *cols in (
        ("nation", 0, 2, "id AS n_nationkey", "concat('N', id) AS n_name"), ("customer", 1, 61, "id AS c_custkey", "id % 2 AS c_nationkey"),
        ("supplier", 1, 21, "id AS s_suppkey", "id % 2 AS s_nationkey"), ("orders", 1, 240, "id AS o_orderkey", "1 + id * 7 % 60 AS o_custkey"),
    ):
        spark.range(first, end).selectExpr(*cols).write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = catalog.combined(spark, str(tmp_path))
    groups = {}
    for r in sorted((r.asDict() for r in rows.withColumn("k", exact_key()).collect()), key=lambda r: r["_ord"]):
        groups.setdefault(r["k"], []).append(r)
    lone = {g[0]["_ord"]: g for g in groups.values() if len(g) == 1}
    apart = {o for o, g in lone.items() if g[0]["k"].startswith("NO_STREET::") or G.NULL_NAME.match(g[0]["full_name"].strip())}
    cols = sorted((r for r in match_columns(rows).collect() if r._ord in lone and r._ord not in apart), key=lambda r: r._ord)
    top = {o: o for o in lone}
    for i, a in enumerate(cols):
        for b in cols[i + 1 :]:
            if top[a._ord] != top[b._ord] and plain_similar(a, b):
                low, high = sorted((top[a._ord], top[b._ord]))
                top = {o: low if x == high else x for o, x in top.items()}
    merged = [g for g in groups.values() if len(g) > 1] + [[lone[o][0] for o in sorted(lone) if top[o] == x] for x in set(top.values())]
    want, total = sum(len(plain_merge.subgroups(g)) for g in merged), sum(map(len, groups.values()))
    assert len(merged) < len(groups) and want > len(merged)  # addresses that are only similar, and groups of several rows
    got = catalog.QUERIES["consolidation_volumes"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [(total, want, total - want, pytest.approx((total - want) / total), pytest.approx((total - want) * 0.65))]


def test_every_word_of_a_company_is_held_against_the_acronym_rule(spark, tmp_path):
    from addrloom.plans import catalog

    spark.sql("SELECT 0L AS n_nationkey, 'N' AS n_name").write.parquet(str(tmp_path / "nation.parquet"))
    spark.range(1, 40).selectExpr("id AS s_suppkey", "0L AS s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    got = {(r._ord, r.place): r.acronym for r in catalog.QUERIES["acronym_words"](spark, str(tmp_path)).collect()}
    names = {r._ord: r.company for r in catalog.view(spark, str(tmp_path), "mail_business").collect()}
    want = {(o, i): G.is_acronym(w) for o, name in names.items() for i, w in enumerate(name.split(" "), 1)}
    assert got == want and any(a for (_, i), a in got.items() if i > 1)


def test_notes_about_feeds(spark, monkeypatch):
    from addrloom.functions import household as H
    from addrloom.plans.report import feed_notes

    streets = spark.createDataFrame([(i, f"{i} Oak St") for i in range(1, 9)], "_ord long, Company string")
    assert "right feed" in feed_notes("business", streets)[0]
    assert feed_notes("business", streets.select("_ord", F.lit("Acme").alias("Company"))) == []
    owners = spark.createDataFrame([(1, "SMITH JOHN")], "_ord long, OWNER string")
    assert feed_notes("parcel", owners) == [] and feed_notes("consumer", owners) == []
    monkeypatch.setattr(feeds, "parse_owner", lambda c: F.struct(c.alias("full"), F.lit("ValueError: odd").alias("error")))
    assert feed_notes("parcel", owners) == ["parcel: 1 owner(s) could not be read and stay as they are", "parcel: 'SMITH JOHN': ValueError: odd"]
    assert H.parse_owner is not feeds.parse_owner


def test_rows_are_numbered_in_order(spark):
    rows = spark.range(1000).select(F.lit(0).alias("phase"), ((F.col("id") * 7919) % 1000).alias("cluster"), F.lit(0).alias("sub")).repartition(7)
    got = V.with_row_numbers(rows).collect()
    assert sorted(r.row for r in got) == list(range(1000)) and all(r.row == r.cluster for r in got)
    assert V.with_row_numbers(rows.limit(0)).count() == 0


def test_too_many_feeds_and_old_workbooks_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        union_feeds(*[empty_feed(spark)] * 8)
    with pytest.raises(ValueError):
        read_feed(spark, str(tmp_path / "a.xls"))


def test_report_is_written_and_read_back_without_passing_the_driver(spark, monkeypatch):
    """lines grow with the list, so they are a table of text; only status and counts come back."""
    from addrloom.plans import catalog
    from addrloom.plans.report import read_report, write_report

    def refuse(*a):
        raise AssertionError("all lines at once")

    rows = catalog._as_result(catalog._rows(spark, "/root/testdata/sf0.001"))
    found = V.issues(rows)
    want = read_validation_report(validation_report(found))
    path = write_report(V.issue_lines(rows))
    assert [r.value for r in spark.read.text(path).collect()] == validation_report(found).splitlines()
    assert tuple(read_report(spark, path).first()) == (want["status"], want["errors"], want["warnings"])
    monkeypatch.setattr(V, "issues", refuse)
    assert tuple(catalog.QUERIES["report_read_back"](spark, "/root/testdata/sf0.001").first()) == (want["status"], want["errors"], want["warnings"])


def test_keys_are_worked_out_once_and_rows_without_a_box_stay_out_of_the_join(spark):
    """one scan for keys; a left join on a null box would put all such rows into one task."""
    from addrloom.plans import catalog

    rows = catalog._as_list(spark, "/root/testdata/sf0.001").withColumn("phase", F.lit(0)).withColumn("cluster", F.col("_ord")).withColumn("sub", F.lit(0))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(V.duplicate_keys(rows)).count("Union") == 1
    flagged = V.flag_rows(rows.withColumn("needs_review", F.lit("")).withColumn("review_reason", F.lit("")))
    assert "isnotnull(_box" in plan(flagged) and "isnull(_box" in plan(flagged)


def test_placing_writes_and_shuffles_only_what_rows_are_placed_by(spark, monkeypatch):
    """lineage and split names stay where they are until the last join."""
    from addrloom.plans import catalog, consolidate

    seen, write = [], consolidate.write_table
    monkeypatch.setattr(consolidate, "write_table", lambda df, name: seen.append(set(df.columns)) or write(df, name))
    rows = catalog._as_list(spark, "/root/testdata/sf0.001")
    assert consolidate.place_rows(rows).count() == rows.count()
    assert seen and not any(cols & {"owner1_original", "p1_first", "data_source"} for cols in seen)


def test_texts_of_a_batch_are_worked_out_once(monkeypatch):
    import pyarrow as pa

    from addrloom.functions import household as H

    asked = []
    parse = G.parse_owner
    monkeypatch.setattr(G, "parse_owner", lambda x: asked.append(x) or parse(x))
    got = H._parse_owner.func(pa.array(["SMITH JOHN", None, "LEE ANN", "SMITH JOHN", ""])).to_pylist()
    assert [r["full"] for r in got] == ["John Smith", "", "Ann Lee", "John Smith", ""] and len(asked) == 4
    assert H._surnames.func(pa.array(["Ann Lee", None, "Ann Lee"])).to_pylist() == [["LEE"], [], ["LEE"]]
    assert H._combine.func(pa.array([["Ann Lee", "Bo Lee"], None, ["Ann Lee", "Bo Lee"]])).to_pylist() == ["Ann & Bo Lee", "", "Ann & Bo Lee"]
    assert H._parse_owner.func(pa.array([], pa.string())).to_pylist() == []


def test_columns_of_the_parcel_feed_are_planned_once(spark):
    """The filter for rows that can be mailed would else be moved below, and names and streets be worked out twice."""
    df = spark.createDataFrame([("SMITH JOHN", "1 Oak St", "LEE ANN"), ("", "2 Oak St", "")], "OWNER string, Address string, `Name Line 2` string")
    feed = feeds.parcel(df)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [_individuals") == plan.count("ArrowEvalPython [_combine") == 1
    assert [r.full_name for r in feed.collect()] == ["John Smith & Ann Lee"]


def test_feeds_of_their_own_sources_are_not_searched_for_copies_again(spark):
    rows = [("Al", "Lee", "1 Oak St"), ("Al", "Lee", "1 Oak St"), (None, "Kim", None)]
    consumer = feeds.consumer(spark.createDataFrame(rows, "First string, Last string, Address string"))
    business = feeds.business(spark.createDataFrame([("Al Lee", "1 Oak St"), ("Al Lee", "1 Oak St")], "Company string, `Street Address` string"))
    one, two = (union_feeds(consumer, business, own_sources=x) for x in (True, False))
    assert sorted(map(tuple, one.collect())) == sorted(tuple(r) for r in two.select(one.columns).collect()) and one.count() == 3
    assert [x._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") for x in (one, two)] == [2, 3]


def test_first_records_of_all_groups_agree_with_sql(spark, tmp_path):
    """groups of one row, and those whose persons come from several sources, were left out."""
    import duckdb

    from addrloom.plans import catalog

    for name, first, end, *cols in (
        ("nation", 0, 2, "id AS n_nationkey", "concat('N', id) AS n_name"), ("customer", 1, 121, "id AS c_custkey", "id % 2 AS c_nationkey"),
        ("supplier", 1, 21, "id AS s_suppkey", "id % 2 AS s_nationkey"), ("orders", 1, 600, "id AS o_orderkey", "1 + id * 7 % 120 AS o_custkey"),
    ):
        spark.range(first, end).selectExpr(*cols).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("nation", "customer", "supplier", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = sorted(map(tuple, catalog.QUERIES["first_record"](spark, str(tmp_path)).collect()))
    assert got == sorted(con.execute(catalog.SQL["first_record"]).fetchall())
    rows = catalog._rows(spark, str(tmp_path)).withColumn("key", exact_key())
    assert len({r[0] for r in got}) == rows.select("key").distinct().count() and any(r[1] > 1 for r in got)


def test_surnames_in_sql_agree_with_the_grammar():
    import random

    import duckdb

    from addrloom.plans import catalog

    rng = random.Random(1)
    some = ["JOHN", "MARY", "Ann", "LEE", "SMITH", "de", "LA", "CRUZ", "J", "A.", "JR", "Jr.", "II", "O'NEIL", "&", "and", ",", "/", "AND"]
    names = [G.squeeze(" ".join(rng.choice(some) for _ in range(rng.randrange(1, 8)))) for _ in range(2000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE told AS SELECT i AS cluster, i AS _ord, n AS raw FROM (SELECT unnest(?) AS n, unnest(range(?)) AS i)", [names, len(names)])
    found = {}
    for row, family in con.execute(f"WITH {catalog._families()} SELECT _ord, family FROM fams").fetchall():
        found.setdefault(row, set()).add(family)
    want = {i: f for i, n in enumerate(names) if (f := G.family_names(n))}
    assert len(want) > 1000 and found == want
