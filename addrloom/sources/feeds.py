"""The three kinds of feed in one form: columns found by alias, names and addresses for print, raw values kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.functions import rules as R
from addrloom.functions.address import format_street
from addrloom.functions.household import combine_household, individuals, parse_owner
from addrloom.functions.names import format_company
from addrloom.functions.text import city_state_zip, is_routing_line, normalize_state, normalize_zip, null_like_parcel, raw_copy, settled, squeeze, strip, title, title_column

# The headers under which each field may come, the first that is there wins.
_STREET = ["Street Address 1", "Street Address", "STREET_ADDRESS", "Mailing Address", "MAILING_ADDRESS", "Mailing Street Address", "Address", "Street"]
_LINE2 = ["Name Line 2", "NAME_LINE_2", "Care Of", "CARE_OF", "C/O", "Attention", "ATTN", "In Care Of"]
_PLAIN = {"city": ["City"], "state": ["State", "ST"], "zip": ["Zip", "Zip5", "Zip Code", "ZIP_CODE"]}
CONSUMER = _PLAIN | {
    "name": ["Full Name", "FULL_NAME", "Name", "Household Name", "HOUSEHOLD_NAME", "Owner"],
    "first": ["First Name", "FIRST_NAME", "FirstName", "First"],
    "last": ["Last Name", "LAST_NAME", "LastName", "Last"],
    "address": _STREET,
    "address2": ["Street Address 2", "STREET_ADDRESS_2", "Mailing Address 2", "MAILING_ADDRESS_2", "Address 2", "Address Line 2"],
    "line2": _LINE2,
}
BUSINESS = _PLAIN | {
    "company": ["Address Line 1", "Company", "Business Name", "BUSINESS_NAME", "Company Name", "COMPANY_NAME", "Firm", "Legal Name"],
    "dba": ["DBA", "Doing Business As", "DBA_NAME"],
    "contact": ["Name Line 1", "Contact Name", "CONTACT_NAME", "Contact", "Attention"],
    "title": ["Name Line 2", "Title", "Job Title", "Position", "Department"],
    "address": ["Address Line 2", *_STREET[1:]],
}
PARCEL = {
    "owner": ["OWNER_NAME_FULL", "Owner Name *", "Owner Name", "OWNER_NAME", "OWNER", "OWNER1", "Name Line 1", "NAME_LINE_1"],
    "address": ["MAIL_ADDRESS", "Mailing Address1", "Mailing Address", "MAILING_ADDRESS", "Street Address 1", "Street Address", "STREET_ADDRESS", "Address", "Street"],
    "address2": [
        "MAIL_ADDRESS2", "Mailing Address2", "OwnerAddr2", "Owner Address 2", "Street Address 2", "STREET_ADDRESS_2", "Address2", "Address Line 2", "Addr2",
    ],
    "city": ["MAIL_CITY", "Mailing Address City", "Mailing City", "MAILING_CITY", "City"],
    "state": ["MAIL_STATE", "Mailing Address State", "Mailing State", "MAILING_STATE", "State"],
    "zip": ["MAIL_ZIP", "Mailing Address Zip Code", "Mailing Zip", "MAILING_ZIP", "Zip", "Zip Code"],
    "csz": ["Mailing City/State/ZIP", "MAILING_CITY_STATE_ZIP", "City/State/ZIP", "CSZ", "CityStateZip"],
    "line2": _LINE2,
    "parcel": ["PARCEL_ID", "Parcel ID", "APN *", "APN", "PIN", "Parcel Number", "PARCEL_NUMBER", "ParcelID"],
}


def find_columns(df: DataFrame, aliases: dict[str, list[str]]) -> dict[str, str]:
    """Field to header, for the fields that ``df`` has; case and outer spaces don't matter, a later header hides an equal one."""
    known = {c.strip().lower(): c for c in df.columns}
    found = {field: next((known[a.lower()] for a in names if a.lower() in known), None) for field, names in aliases.items()}
    return {field: c for field, c in found.items() if c is not None}


def _bind(df: DataFrame, aliases: dict[str, list[str]]) -> tuple[DataFrame, set[str]]:
    """``df`` with each field a column of that name, blank where the feed has none, and the fields that it has."""
    has = find_columns(df, aliases)
    cols = [(F.coalesce(F.col(f"`{has[f]}`").cast("string"), F.lit("")) if f in has else F.lit("")).alias(f) for f in aliases]
    return df.select(*cols, F.col("_ord") if "_ord" in df.columns else F.monotonically_increasing_id().alias("_ord")), set(has)


def _present(c: Column) -> Column:
    s = strip(c)
    return F.when(F.lower(s).isin("nan", "none"), "").otherwise(s)


def _glue(a: Column, b: Column, sep: str) -> Column:
    return F.when((a != "") & (b != ""), F.concat(a, F.lit(sep), b)).otherwise(F.concat(a, b))


def _common(has: set[str]) -> dict[str, Column]:
    return {
        "city": title_column(F.col("city")), "state": normalize_state(F.col("state")), "zip": normalize_zip(F.col("zip")),
        "city_original": raw_copy(F.col("city")), "state_original": raw_copy(F.col("state")), "zip_original": raw_copy(F.col("zip")),
    }


def _finish(df: DataFrame, source: str, fields: dict[str, Column]) -> DataFrame:
    cols = {"data_source": F.lit(source)} | fields
    return keep_first(df.select(*[cols.get(c, F.lit("")).alias(c) for c in [*R.FIELDS, *R.LINEAGE]], "_ord"))


def keep_first(df: DataFrame) -> DataFrame:
    """Of rows that agree in all fields the first one, whatever their lineage. Copies fold before the shuffle."""
    rest = [c for c in df.columns if c not in R.FIELDS and c != "_ord"]
    first = df.groupBy(*R.FIELDS).agg(F.min(F.struct("_ord", *rest)).alias("_f"))
    return first.select(*R.FIELDS, *[F.col(f"_f.{c}").alias(c) for c in rest], F.col("_f._ord").alias("_ord"))


def consumer(df: DataFrame) -> DataFrame:
    d, has = _bind(df, CONSUMER)
    both = strip(F.concat(strip(F.col("first")), F.lit(" "), strip(F.col("last")))) if {"first", "last"} <= has else F.lit("")
    raw = F.col("name") if "name" in has else both
    line2 = _present(F.col("address2"))
    fields = _common(has) | {
        "full_name": F.when(strip(raw) == "", "").otherwise(F.array_join(individuals(raw), " & ")),
        "second_line": strip(F.col("line2")),
        "street": format_street(_glue(strip(F.col("address")), line2, " ")) if "address" in has else F.lit(""),
        "p1_first": title(_present(F.col("first"))), "p1_last": title(_present(F.col("last"))),
        "owner1_original": raw_copy(raw), "titledept_original": raw_copy(F.col("line2")),
        "address1_original": _glue(raw_copy(F.col("address")), raw_copy(F.col("address2")), " ") if "address" in has else F.lit(""),
    }
    return _finish(d, "Consumer", fields)


def company_or_dba(company: Column, dba: Column) -> Column:
    """The legal name, else the trade name."""
    return F.coalesce(F.nullif(strip(company), F.lit("")), strip(dba))


def title_and_department(contact: Column, title_: Column) -> Column:
    return F.concat_ws(", ", F.nullif(squeeze(contact), F.lit("")), F.nullif(squeeze(title_), F.lit("")))


def business(df: DataFrame) -> DataFrame:
    d, has = _bind(df, BUSINESS)
    fields = _common(has) | {
        "full_name": format_company(company_or_dba(F.col("company"), F.col("dba"))),
        "second_line": title_and_department(F.col("contact"), F.col("title")),
        "street": format_street(F.col("address")),
        "owner1_original": company_or_dba(raw_copy(F.col("company")), raw_copy(F.col("dba"))),
        "titledept_original": F.concat_ws(", ", F.nullif(raw_copy(F.col("contact")), F.lit("")), F.nullif(raw_copy(F.col("title")), F.lit(""))),
        "address1_original": raw_copy(F.col("address")),
    }
    return _finish(d, "Business", fields)


def looks_like_streets(df: DataFrame, rows: int = 20) -> bool:
    """Whether the first values of the company column look like street addresses: likely the wrong feed."""
    d, has = _bind(df, BUSINESS)
    if "company" not in has:
        return False
    values = [r[0] for r in d.orderBy("_ord").limit(rows).select("company").where(strip(F.col("company")) != "").select(F.col("company").rlike(r"^\s*\d+\s+\S")).collect()]
    return bool(values) and sum(values) >= max(3, len(values) // 2)


def mailable(full_name: Column, street: Column) -> Column:
    """Whether there is someone and somewhere to send to."""
    return (strip(full_name) != "") & ~null_like_parcel(street)


def parcel(df: DataFrame) -> DataFrame:
    """Owners of parcels. Rows without a name or an address can't be mailed and are left out."""
    d, has = _bind(df, PARCEL)
    if "csz" in has and not {"city", "state", "zip"} <= has:
        for f in ("city", "state", "zip"):
            if f not in has:
                d = d.withColumn(f, city_state_zip(F.col("csz"))[f])
    null = null_like_parcel
    owner, pid, line2 = strip(F.col("owner")), strip(F.col("parcel")), strip(F.col("line2"))
    d = d.withColumn("_owner", F.when(null(owner), "").otherwise(owner)).withColumn("_line2", F.when(null(line2), "").otherwise(line2))
    d = d.withColumn("_other", F.when(is_routing_line(F.col("_line2")), "").otherwise(F.col("_line2")))
    d = d.withColumn("_a", parse_owner(F.col("_owner"))).withColumn("_b", parse_owner(F.col("_other")))
    lone = F.when((F.col("_owner") == "") & ~null(pid), F.concat(F.lit("Parcel "), pid)).otherwise(F.col("_a.full"))
    d = d.withColumn("_one", lone).withColumn("_two", F.col("_b.full"))
    both = (F.col("_one") != "") & (F.col("_two") != "")
    d = d.withColumn("_names", F.when(both, F.concat(individuals(F.col("_one")), individuals(F.col("_two")))).otherwise(F.array().cast("array<string>")))
    second_only = (F.col("_one") == "") & (F.col("_two") != "")

    def part(n: str) -> Column:
        return F.when(second_only, F.col(f"_b.{n}")).otherwise(F.col(f"_a.{n}"))

    line = _glue(strip(F.col("address")), _present(F.col("address2")), " - ")
    bare = strip(F.regexp_replace(line, R.CITY_STATE_ZIP, ""))
    fields = _common(has) | {
        "full_name": F.when(both, combine_household(F.col("_names"))).when(second_only, F.col("_two")).otherwise(F.col("_one")),
        "second_line": F.when(F.col("_two") != "", "").otherwise(F.col("_line2")),
        "street": settled(format_street(bare)),
        "p1_first": part("first"), "p1_middle": part("middle"), "p1_last": part("last"),
        "p2_first": part("first2"), "p2_middle": part("middle2"), "p2_last": part("last2"),
        "owner1_original": raw_copy(F.col("owner")), "titledept_original": raw_copy(F.col("line2")),
        "address1_original": _glue(raw_copy(F.col("address")), raw_copy(F.col("address2")), " - ") if "address" in has else F.lit(""),
    }
    out = d.select(*[({"data_source": F.lit("Parcel")} | fields).get(c, F.lit("")).alias(c) for c in [*R.FIELDS, *R.LINEAGE]], "_ord")
    return keep_first(out.where(mailable(F.col("full_name"), F.col("street"))))


def parse_errors(df: DataFrame) -> DataFrame:
    """Owners that the grammar couldn't read, with the error; the rows themselves stay in the feed."""
    d, _ = _bind(df, PARCEL)
    read = d.select("owner", parse_owner(F.col("owner")).alias("o"))
    return read.where("o.error <> ''").select("owner", F.col("o.error").alias("error"))
