"""Names as columns: classification, title case, companies, governments, comparison keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .text import joined, let, null_like, squeeze, strip, words


def _any_word(padded: Column, some: list[str]) -> Column:
    return padded.rlike(" (?:" + "|".join(x.replace("/", "\\/") for x in some) + ") ")


def _padded(c: Column) -> Column:
    # Single spaces at the ends and two between words, so that neighbouring words can both be found.
    return F.concat(F.lit(" "), squeeze(F.upper(c)), F.lit(" "))


def _trust(padded: Column) -> Column:
    return _any_word(padded, R.TRUST_WORDS)


def is_trust(c: Column) -> Column:
    return _trust(_padded(c))


def _government(padded: Column) -> Column:
    return reduce(Column.__or__, [padded.contains(p) for p in R.GOVERNMENT_PHRASES]) | _any_word(padded, R.GOVERNMENT_WORDS)


def is_government(c: Column) -> Column:
    return let(_padded(c), _government)


def _company(c: Column, padded: Column) -> Column:
    marked = c.contains(".") | c.contains(",") | c.contains(";")
    return _any_word(F.when(marked, _padded(F.regexp_replace(c, r"[.,;]+", " "))).otherwise(padded), R.COMPANY_WORDS)


def is_company(c: Column) -> Column:
    return let(c, lambda s: _company(s, _padded(s)))


def classify(c: Column) -> Column:
    """``trust``, ``entity``, ``government`` or ``person``, the first that fits; blanks are persons."""

    def kind(x: Column) -> Column:
        s, up = x["said"], x["padded"]
        return F.when((s == "") | null_like(s), "person").when(_trust(up), "trust").when(_company(s, up), "entity").when(_government(up), "government").otherwise("person")

    return let(F.struct(c.alias("said"), _padded(c).alias("padded")), kind)


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def title_word(w: Column, deep: bool = True) -> Column:
    """One word of a name: O'Brien, McKay, MacDonald, Smith-Jones, J."""
    up = F.upper(w)
    plain = F.when(w.contains("-"), joined(F.transform(F.split(w, "-"), lambda p: title_word(p, False)), "-")).otherwise(capitalized(w)) if deep else capitalized(w)
    return (
        F.when(F.length(w) <= 1, up)
        .when((F.length(w) == 2) & w.endswith("."), up)
        .when(up.startswith("O'") & (F.length(w) > 2), F.concat(F.lit("O'"), capitalized(w.substr(F.lit(3), F.length(w)))))
        .when(up.startswith("MC") & (F.length(w) > 2), F.concat(F.lit("Mc"), capitalized(w.substr(F.lit(3), F.length(w)))))
        .when(up.startswith("MAC") & (F.length(w) > 5), F.concat(F.lit("Mac"), capitalized(w.substr(F.lit(4), F.length(w)))))
        .otherwise(plain)
    )


def strip_transactions(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, R.TRANSACTION_TAIL, ""))


def join_spaced_forms(c: Column) -> Column:
    """``L L C`` and the like become one word; the longest form first."""
    for form in R.SPACED_FORMS:
        c = F.regexp_replace(c, r"(?i)\b" + r"\s+".join(form) + r"\b", form)
    return c


def without_life_estate(c: Column) -> Column:
    """The name without a trailing life-estate mark, and whether there was one."""
    cut = strip(F.rtrim(strip(F.regexp_replace(c, R.LIFE_ESTATE, "")), F.lit(",")))
    had = cut != strip(F.rtrim(strip(c), F.lit(",")))
    return F.struct(F.when(had, cut).otherwise(c).alias("name"), had.alias("life_estate"))


def is_acronym(w: Column, short_words: Sequence[str] = R.SHORT_WORDS) -> Column:
    """Up to three letters, none of them a vowel or together none of the ``short_words``."""
    up = F.upper(w)
    return w.rlike(r"^\p{L}{1,3}$") & (~up.rlike("[AEIOU]") | ~up.isin(list(short_words)))


def format_company(c: Column, short_words: Sequence[str] = R.SHORT_WORDS) -> Column:
    """A company's name: legal forms and acronyms in capitals, small words small inside, the rest as names."""
    return let(words(join_spaced_forms(strip_transactions(c))), lambda tokens: _shown_company(tokens, short_words))


def _shown_company(tokens: Column, short_words: Sequence[str]) -> Column:
    def shown(w: Column, i: Column) -> Column:
        bare = F.btrim(w, F.lit(",."))
        plain = F.replace(F.upper(bare), F.lit("."), F.lit(""))
        inner = (i > 0) & (i < F.size(tokens) - 1)
        return (
            F.when(plain.isin(sorted(R.COMPANY_CAPITALS)), plain)
            .when(plain.isin(sorted(set(R.COMPANY_WORDS) - R.COMPANY_CAPITALS)), capitalized(plain))
            .when(is_acronym(bare, short_words), F.upper(bare))
            .when(inner & plain.isin(sorted(R.SMALL_WORDS)), F.lower(plain))
            .otherwise(title_word(bare))
        )

    return strip(joined(F.transform(tokens, shown)))


def format_government(c: Column) -> Column:
    up = squeeze(F.upper(c))
    dept = F.regexp_extract(up, r"^DEPT\.?\s+(.+)$", 1)
    tokens = words(c)
    out = joined(F.transform(tokens, lambda w: F.when(F.upper(w).isin(sorted(R.SMALL_WORDS)), F.lower(w)).otherwise(title_word(w))))
    first = F.concat(F.upper(F.substring(out, 1, 1)), out.substr(F.lit(2), F.length(out)))
    return F.when(dept != "", F.concat(joined(F.transform(words(dept), lambda w: title_word(w))), F.lit(" Dept"))).otherwise(first)


def strip_suffixes(tokens: Column) -> Column:
    """Tokens without the personal suffixes at their end."""
    keep = F.aggregate(
        F.reverse(tokens), F.struct(F.array().cast("array<string>").alias("kept"), F.lit(True).alias("open")),
        lambda acc, t: F.when(acc["open"] & F.rtrim(F.upper(t), F.lit(".")).isin(sorted(R.SUFFIXES)), acc).otherwise(
            F.struct(F.concat(F.array(t), acc["kept"]).alias("kept"), F.lit(False).alias("open"))
        ),
    )
    return keep["kept"]


def comparison_key(c: Column) -> Column:
    """Organisations keep their word order; of persons the words are sorted, without joining words and suffixes."""
    return let(squeeze(F.upper(c)), _key_of)


def _key_of(up: Column) -> Column:
    bare = F.regexp_replace(up, R.NAME_MARKS, "")
    tokens = strip_suffixes(F.filter(words(bare), lambda t: ~t.isin("AND", "&")))
    person = F.when(F.exists(tokens, lambda t: t.isin(sorted(R.ENTITY_SIGNALS))), joined(tokens)).otherwise(joined(F.array_sort(tokens)))
    return F.when(is_trust(up) | is_government(up) | is_company(up), squeeze(bare)).otherwise(person)


def person_tokens(c: Column) -> Column:
    return F.filter(F.transform(words(c), lambda t: F.btrim(F.upper(t), F.lit("."))), lambda t: t != "")


def without_noise(c: Column) -> Column:
    return strip(F.regexp_replace(c, R.NAME_NOISE, ""))


def display_order(c: Column) -> Column:
    """For choosing among spellings of a name: most words, then longest, noise aside."""
    bare = without_noise(c)
    return F.struct(F.size(words(bare)).alias("words"), F.length(bare).alias("length"))


