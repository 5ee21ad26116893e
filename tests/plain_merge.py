"""Merging by plain loops over the rows of one address, to hold the engine against."""

import re

from addrloom.functions import rules as R
from addrloom.functions.grammar import NULL_NAME, classify, combine, company, entities_match, family_names, individuals, once, richer, same_person


def subgroups(rows: list[dict]) -> list[list[dict]]:
    """The rows of one address that become one row of output each: organisations, then persons. Persons of several
    sources stay together only where a surname, or the lack of one, joins them."""
    if len(rows) < 2:
        return [rows]
    kinds = [classify(r["full_name"].strip()) for r in rows]
    persons = [r for r, k in zip(rows, kinds, strict=True) if k == "person"]
    others = [r for r, k in zip(rows, kinds, strict=True) if k != "person"]
    out = [others] if others else []
    if len({r["data_source"].strip() for r in persons}) > 1:
        clusters: list[tuple[list[int], set[str], bool]] = []  # positions, surnames, whether one has none
        for i, names in enumerate(family_names(r["full_name"].strip()) for r in persons):
            joined = [c for c in clusters if not names or c[2] or c[1] & names]
            rest = [c for c in clusters if not any(c is j for j in joined)]
            one = (sorted([i, *[x for c in joined for x in c[0]]]), names.union(*[c[1] for c in joined]), not names or any(c[2] for c in joined))
            clusters = [*rest, one]
        out += [[persons[i] for i in c[0]] for c in sorted(clusters, key=lambda c: c[0][0])]
    elif persons:
        out.append(persons)
    return out


def merged_companies(names: list[str]) -> str:
    kept: list[str] = []
    for name in names:
        if name.strip().upper() in {k.strip().upper() for k in kept}:
            continue
        like = next((k for k in kept if entities_match(name, k)), None)
        if like is None:
            kept.append(name)
        elif len(name) > len(like):
            kept.remove(like)
            kept.append(name)
    return ", ".join(map(company, kept))


def merged_persons(names: list[str]) -> tuple[str, int]:
    """The household's name and how many persons it had before the cap."""
    people: list[str] = []
    for person in (p for n in names for p in individuals(n)):
        at = next((i for i, known in enumerate(people) if same_person(person, known)), None)
        if at is None:
            people.append(person)
        else:
            people[at] = richer(person, people[at])
    return combine(people[: R.HOUSEHOLD_CAP]), len(people)


def merge_rows(rows: list[dict]) -> dict:
    """One row for all: names merged, sources and second lines united, the first one's address, lineage kept.

    The split names are blank, for they would say less than the merged name. ``household``: how many persons.
    """
    if len(rows) == 1:
        return rows[0] | {"household": 0}
    names = [n for r in rows if (n := r["full_name"].strip()) and not NULL_NAME.match(n)]
    names = [p.strip() for n in names for p in re.split(r"\s*[/\\]\s*", n) if p.strip()]
    if any(classify(r["full_name"].strip()) != "person" for r in rows):
        name, people = merged_companies(names), 0
    else:
        name, people = merged_persons(names)
    union = {f: ", ".join(sorted({r[f].strip() for r in rows} - {""})) for f in ("data_source", "second_line")}
    lineage = {f: " | ".join(once(r[f].strip() for r in rows)) for f in R.LINEAGE}
    split = dict.fromkeys(R.FIELDS[7:], "")
    return rows[0] | {"full_name": name, "household": people} | union | lineage | split
