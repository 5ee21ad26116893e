"""Single functions: cases of the address, name and code rules, each on columns and, where there is one, in plain Python."""

import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from addrloom.functions import address as A
from addrloom.functions import grammar as G
from addrloom.functions import household as H
from addrloom.functions import names as N
from addrloom.functions import text as T

ADDRESS = {
    "normalize_zip": (T.normalize_zip, {"85337-0725": "85337", "853370725": "85337", "  01234 ": "01234", "m5v3a8": "M5V 3A8", "M5V 3A8": "M5V 3A8", "1234": "1234", "ab  c": "AB C", "": ""}),
    "normalize_state": (T.normalize_state, {"  AZ  ": "AZ", "zz": "", "on": "ON", "ae": "AE", "PR": "PR", "": ""}),
    "title": (T.title_column, {"  o'NEIL  12b-c ": "O'Neil 12B-C", "SAN JOSÉ": "San José"}),
    "po_box": (A.extract_po_box, {"POBOX 1497": "PO BOX 1497", "1701 E. Pima St. PO Box 571": "PO BOX 571", "MAILBOX 100": None, "LOCK BOX 5": None, "PO BOX DRAWER 9": "PO BOX DRAWER 9", "P.O. Box Z": "PO BOX Z", "RR 1 BOX 50": None, "PSC 1 BOX 2": None, "Post Office Box 42": None}),
    "rural": (A.extract_rural_route, {"Rural Route 1, Box 50": "RR 1 BOX 50", "R.R. 2 Box 10A": "RR 2 BOX 10A", "HCR 2 Box 10": "HC 2 BOX 10", "Highway Contract 2 Box 10": "HC 2 BOX 10", "123 Main St": None}),
    "military": (A.extract_military_box, {"Unit 12345 Box 67": "UNIT 12345 BOX 67", "CMR 401 Box 123": "CMR 401 BOX 123", "Unit 5": None}),
    "unit": (A.extract_unit, {"9 Oak Ste 100": "STE 100", "9 Oak Suite 100": "STE 100", "9 Oak Apt 5B": "APT 5B", "9 Oak #200": "# 200", "123 FLORENCE ST": "FL ORENCE", "9 Oak Ste. 200": None, "9 Oak": None}),
    "unit_strict": (lambda c: A.extract_unit(c, "strict"), {"123 FLORENCE ST": None, "9 Oak Ste. 200": "STE 200", "9 Oak Apt 5B": "APT 5B", "9 Oak # 7": "# 7"}),
    "remove_unit": (A.remove_unit, {"123 Main St, Suite 5": "123 Main St", "500 N FLORIDA": "500 N", "9 PILOT 5": "9 PI", "": ""}),
    "matching": (A.normalize_for_matching, {"123 North Main Street": "123 N MAIN ST", "123 N. Main St.": "123 N MAIN ST", "9 Oak Avenue Apt 3": "9 OAK AVE", "RR 1 BOX 50 PO BOX 7": "RR 1 BOX 50", "5 Elm, 85201-1234": "5 ELM,"}),
    "display": (A.format_street, {
        "123 OAK STREET": "123 Oak St.", "1 N 32ND AVE": "1 N. 32nd Ave.", "12 ST ROUTE 87": "12 State Route 87", "123 NULLA RD": "123A Rd.", "5 Elm - NULL": "5 Elm", "N/A": "", "--": "", "": "",
        "77 west park - building a": "77 W. Park - Bldg. A", "c/o bob 5 elm": "C/O Bob 5 Elm", "E Street Rd": "E. St. Rd.", "456 ELM AVE APT 2B": "456 Elm Ave. Apt 2B", "p.o. box 9": "PO BOX 9"}),
    "class": (N.classify, {"TRAVEL BUREAU LLC": "entity", "COUNTRY CLUB": "person", "ABC, LLC.": "entity", "SMITH FAMILY TRUST": "trust", "CITY OF MESA": "government", "N/A": "person", "ACME DEPARTMENT STORE": "government"}),
    "company": (N.format_company, {"ABC INVESTMENTS L L C": "ABC Investments LLC", "WESTPARK OZ VENTURES LLC": "Westpark Oz Ventures LLC", "THE HOUSE OF TEA": "The House OF Tea", "MCKAY AND SONS CO": "McKay and Sons CO", "MCKAY LTD PMT # 12": "McKay LTD", "SAM WINS LLC": "SAM Wins LLC", "NED BOB BOX CO": "NED BOB Box CO", "": ""}),
    "government": (N.format_government, {"DEPT ARIZONA TRANSPORTATION": "Arizona Transportation Dept", "CITY OF MESA": "City of Mesa", "": ""}),
    "key": (N.comparison_key, {"Smith, John Jr.": "JOHN SMITH", "JOHN & MARY SMITH": "JOHN MARY SMITH", "Acme, Inc.": "ACME INC", "": ""}),
    "word": (N.title_word, {"o'neil": "O'Neil", "MCDONALD": "McDonald", "MACARTHUR": "MacArthur", "MACEY": "Macey", "rolon-meza": "Rolon-Meza", "j": "J", "j.": "J.", "": ""}),
}


@pytest.mark.parametrize("name", ADDRESS)
def test_columns(spark, name):
    fn, cases = ADDRESS[name]
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", fn(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in rows} == cases


def test_address_key(spark):
    rows = [("9 Oak St. Ste. 100", "Mesa", "AZ", "85201"), ("9 Oak Street Ste 200", " mesa", "az ", "85201-9999"), ("", "Mesa", "AZ", ""), ("PO Box 9 Apt 3", "M", "AZ", "1")]
    df = spark.createDataFrame(rows, "a string, c string, s string, z string")
    cols = [F.col(x) for x in "acsz"]
    keys = [r[0] for r in df.select(A.address_key(*cols)).collect()]
    assert keys[0] == "9 OAK ST|MESA|AZ|85201" and keys[1] == "9 OAK ST|MESA|AZ|85201|UNIT:STE 200"  # a period hides the unit
    assert keys[2].startswith("|MESA|AZ||HASH:") and len(keys[2]) == len("|MESA|AZ||HASH:") + 8 and keys[3] == "PO BOX 9|M|AZ|1"
    assert [r[0] for r in df.limit(1).select(A.address_key(*cols, "strict")).collect()] == ["9 OAK ST|MESA|AZ|85201|UNIT:STE 100"]


OWNERS = {
    "SMITH JOHN W/MARGARET A": "John W. & Margaret A. Smith", "HARRIS RONALD/TONYA SUE": "Ronald & Tonya Sue Harris", "ALLISON ROY LEE III/KAREN ANNE": "Roy Lee & Karen Anne Allison III",
    "GRIJALVA CYNTHIA ELENA/DOMINGUEZ JAVIER NOE MORALES": "Cynthia Elena Grijalva & Javier Noe Morales Dominguez", "SMITH FAMILY TRUST": "Smith Family Trust", "THE SMITH TRUST": "Smith Trust",
    "GETZWILLER JOE B/THERESA D TRUST": "Joe B. & Theresa D. Getzwiller Trust", "SMITH JOHN & MARY FAMILY TRUST": "John & Mary Smith Family Trust", "GURTLER RICHARD W SURVIVOR'S TRUST": "Richard W. Gurtler Survivor's Trust",
    "MONTEVERDE ROD CO-TRS": "Rod Monteverde Co-Trustee", "BG FAMILY IRREV TRUST": "BG Family Irrev Trust", "DE LA CRUZ RAMON": "Ramon de la Cruz", "DEL BOSQUE JOSE MARIA": "Jose Maria del Bosque", "Esther J Fields": "Esther J. Fields",
    "Ramon de la Cruz": "Ramon de la Cruz", "JONES JANE LE": "Jane Jones Life Estate", "Robert Lee": "Robert Lee", "LE": "Life Estate", "GARCIA LOPEZ MARIA ELENA": "Lopez Maria Elena Garcia", "SMITH JOHN JR": "John Smith Jr.",
    "SMITH JOHN & DOE JANE": "John Smith & Jane Doe", "": "", "CHEN": "Chen",
}


def test_owners(spark):
    rows = spark.createDataFrame([(k,) for k in OWNERS], "x string").select("x", H.parse_owner(F.col("x")).alias("o")).collect()
    assert {r.x: r.o.full for r in rows} == OWNERS and not any(r.o.error for r in rows)
    split = {r.x: r.o for r in rows}["SMITH JOHN W/MARGARET A"]
    assert (split.first, split.middle, split.last, split.first2, split.middle2, split.last2) == ("John", "W.", "Smith", "Margaret", "A.", "Smith")


def test_persons_and_households():
    assert G.person_from_last_first("ROLON MEZA MARTHA E") == "Martha E. Rolon Meza"
    assert G.person_from_last_first("ALVAREZ MARTHA E ROLON MEZA") == "Martha E. Alvarez Rolon Meza"
    assert G.person_from_last_first("SMITH, JOHN Q") == "John Q. Smith" and G.person_from_last_first("SMITH JR") == "Smith"
    assert G.individuals("SMITH JOHN/JANE") == ["John Smith", "Jane Smith"] and G.individuals("John Smith AND Mary") == ["John Smith", "Mary Smith"]
    assert G.individuals("C/O JOHN SMITH") and G.individuals("") == [] and G.individuals("/") == []
    assert G.combine(["Juan Manuel", "Ofelia Ortega", "Juan Manuel Ortega"]) == "Ofelia & Juan Manuel Ortega"
    assert G.combine("A B|C D|E Vejar|F G|H Vejar".split("|")) == "A B, C D, F G, E & H Vejar"
    assert G.combine(["John Smith", "Mary Smith", "Bob Smith"]) == "John, Mary, & Bob Smith" and G.combine(["Esther Fields", "Esther J. Fields"]) == "Esther J. Fields" and G.combine([]) == ""
    assert G.same_person("Aron Jimenez", "Aaron Jimenez") and not G.same_person("Al Smith", "AJ Smith") and not G.same_person("John Smith", "Jane Smith")
    assert G.richer("A Smith", "A B. Smith") == "A B. Smith"
    assert G.ratio("TIDE", "DIET") == 0.25 and G.ratio("DIET", "TIDE") == 0.5


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=string.ascii_letters + "  ,.&/'\\-#0123456789é", max_size=40))
def test_no_text_breaks_the_grammar(text):
    for form in (G.parse_owner, G.individuals, G.segment, G.company, G.government, G.trust, G.comparison_key, G.person_from_last_first):
        form(text)
        form(text.upper())
    names = G.individuals(text)
    assert len(set(names)) == len(names)


def test_the_grammar_s_companies_are_those_of_columns(spark):
    names = ["SAM WINS LLC", "THE HOUSE OF TEA", "BOZ VEN OZ CO", "BG LYNN MGR INC", "SKY & SON LTD", "A B C"]
    rows = spark.createDataFrame([(n,) for n in names], "x string").select("x", N.format_company(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in rows} == {n: G.company(n) for n in names}


def test_errors_stay_with_their_row(spark, monkeypatch):
    monkeypatch.setattr(G, "parse_owner", lambda raw: 1 / 0)
    got = H._owners(["SMITH JOHN"]).to_pylist()[0]
    assert got["full"] == "SMITH JOHN" and got["error"].startswith("ZeroDivisionError")


def test_names_are_padded_once_and_pairs_are_not_remembered(spark):
    """What queries at size pay for: a kind pads its name once (twice with marks), gram rows leave their grams behind, workers keep no ratios."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from addrloom.functions import grammar, household, names
    from addrloom.operators.grams import near_candidates

    rows = spark.createDataFrame([(1, "A  TRUST"), (2, "ACME,CO;"), (3, "CITY OF MESA"), (4, "MESA  TR"), (5, "A.TRUST")], "id long, text string")
    kinds = rows.select("id", names.classify(F.col("text")).alias("kind"))
    assert kinds._jdf.queryExecution().analyzed().toString().count("upper(") == 2
    assert [r.kind for r in kinds.orderBy("id").collect()] == ["trust", "entity", "government", "trust", "person"]
    assert "array_intersect" not in near_candidates(rows, 0.85)._jdf.queryExecution().analyzed().toString()
    grammar.ratio.cache_clear()
    assert household._ratio.func(pa.array(["AB"]), pa.array(["AC"]), pa.array([0.0])).to_pylist() == [0.5]
    assert grammar.ratio.cache_info().currsize == 0
