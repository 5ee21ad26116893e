"""Indexes for merging the names of one address, so that a name isn't held against every name before it.

Names are taken one after another, and each joins the first earlier one that it may belong to; what that is depends on the order
and is kept. Only the search for it is made short: of all texts those that share enough pairs of letters for the ratio, of all
persons those whose given name, surname and initial allow it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from heapq import heappop, heappush
from math import ceil

from . import rules as R
from .grammar import NULL_NAME, Known, combine, company, comparison_key, individuals, known, ratio, richer


def grams_of(text: str, size: int) -> frozenset[tuple[str, int]]:
    """The grams of a text; a repeated one is told from the others by its place among them."""
    seen: Counter = Counter()
    out = []
    for i in range(len(text) - size + 1):
        gram = text[i : i + size]
        out.append((gram, seen[gram]))
        seen[gram] += 1
    return frozenset(out)


#: Texts up to which lengths alone are compared: most groups have no more, and grams would cost more than the ratios that they spare.
FEW = 8


class Likes:
    """Texts by number. :meth:`like` gives those that may reach the ratio ``least`` with a text, none left out.

    The ratio is 2M/S for S letters in both and M in matching runs. There are at most S - 2M + 1 runs, so at least
    t = M - (q - 1)(S - 2M + 1) grams of q letters are shared. Of a text's k grams only the k - t + 1 that are rarest among the
    texts of a length are looked up, for one of them is shared; what is found has to share t, and letters enough for the ratio.
    """

    def __init__(self, least: float):
        self.least = least
        self.texts: list[str] = []
        self.grams: list[dict[int, frozenset[tuple[str, int]]]] = []
        self.lengths: dict[int, tuple[list[int], dict[tuple[str, int], list[int]]]] = {}

    def add(self, text: str) -> int:
        self.texts.append(text)
        if len(self.texts) > FEW:
            while len(self.grams) < len(self.texts):
                self._file(len(self.grams))
        return len(self.texts) - 1

    def _file(self, number: int) -> None:
        text = self.texts[number]
        self.grams.append({q: grams_of(text, q) for q in (1, 2, 3)})
        every, filed = self.lengths.setdefault(len(text), ([], {}))
        every.append(number)
        for gram in self.grams[-1][2] | self.grams[-1][3]:
            filed.setdefault(gram, []).append(number)

    def needed(self, letters: int, q: int) -> int:
        """How many grams two texts of so many letters share if they are alike."""
        m = ceil(self.least * letters / 2 - 1e-9)
        return m - (q - 1) * (letters - 2 * m + 1)

    def like(self, text: str, since: int = 0) -> list[int]:
        """The numbers, from ``since`` on, in order."""
        size = len(text)
        if not self.grams:
            return [n for n in range(since, len(self.texts)) if 2 * min(size, len(self.texts[n])) >= (self.least - 1e-9) * (size + len(self.texts[n]))]
        found: set[int] = set()
        grams = {q: grams_of(text, q) for q in (1, 2, 3)}
        for length, (every, filed) in self.lengths.items():
            if 2 * min(size, length) < (self.least - 1e-9) * (size + length):
                continue
            q = 3 if self.needed(size + length, 3) > 1 else 2
            t, m = self.needed(size + length, q), self.needed(size + length, 1)
            if t < 1:
                found.update(every[bisect_left(every, since) :])
                continue
            lists = sorted((filed.get(g, ()) for g in grams[q]), key=len)[: max(0, len(grams[q]) - t + 1)]
            some = {n for numbers in lists for n in (numbers[bisect_left(numbers, since) :] if since else numbers)}
            found.update(n for n in some if len(grams[q] & self.grams[n][q]) >= t and len(grams[1] & self.grams[n][1]) >= m)
        return sorted(found)


class People:
    """Persons in order. One joins the first that it may be, and the name that says more of the two stays in that place."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.now: list[Known] = []
        self.givens = Likes(R.FIRST_NAME_RATIO)
        self.numbers: dict[str, int] = {}
        self.near: dict[str, tuple[int, list[str]]] = {}
        self.filed: dict[tuple, list[int]] = {}

    @staticmethod
    def _keys(k: Known) -> list[tuple]:
        if not k.words:
            return []
        if len(k.words) == 1:
            return [(k.given, "any"), (k.given, "one")]
        return [(k.given, "any"), *[(k.given, f, i) for f in (k.family, None) for i in (k.initial, None)]]

    def _alike(self, given: str) -> list[str]:
        """The given names so far that one with this given name may have."""
        done, found = self.near.get(given, (0, []))
        if done < len(self.givens.texts):
            for n in self.givens.like(given, done):
                other = self.givens.texts[n]
                if other == given or (min(len(other), len(given)) > 2 and ratio(given, other, R.FIRST_NAME_RATIO) >= R.FIRST_NAME_RATIO):
                    found.append(other)
            self.near[given] = (len(self.givens.texts), found)
        return found

    def _first(self, key: tuple) -> int | None:
        heap = self.filed.get(key)
        while heap and key not in self._keys(self.now[heap[0]]):
            heappop(heap)  # it says more by now, and is filed elsewhere too
        return heap[0] if heap else None

    def find(self, person: Known) -> int | None:
        if not person.words:
            return None
        if len(person.words) == 1:
            kinds: list[tuple] = [("any",)]
        else:
            families = [None] if not person.family else [person.family, ""]
            initials = [None] if not person.initial else [person.initial, ""]
            kinds = [("one",), *[(f, i) for f in families for i in initials]]
        found = (self._first((g, *kind)) for g in self._alike(person.given) for kind in kinds)
        return min((i for i in found if i is not None), default=None)

    def _put(self, at: int, name: str) -> None:
        self.names[at], self.now[at] = name, known(name)
        k = self.now[at]
        if k.words and k.given not in self.numbers:
            self.numbers[k.given] = self.givens.add(k.given)
        for key in self._keys(k):
            heappush(self.filed.setdefault(key, []), at)

    def add(self, name: str) -> None:
        at = self.find(known(name))
        if at is None:
            self.names.append("")
            self.now.append(known(""))
            self._put(len(self.names) - 1, name)
        elif (best := richer(name, self.names[at])) != self.names[at]:
            self._put(at, best)


def merged_people(names: list[str]) -> list[str]:
    """The persons that the names, taken in order, come down to."""
    people = People()
    for name in names:
        people.add(name)
    return people.names


def merged_companies(names: list[str]) -> list[str]:
    """The companies that the names, taken in order, come down to: of alike ones the longest, in the place of the last change."""
    likes, kept, upper = Likes(R.ENTITY_RATIO), {}, set()
    for name in names:
        shown = name.strip().upper()
        if shown in upper:
            continue
        key = comparison_key(name)
        alike = (n for n in likes.like(key) if n in kept and ratio(key, likes.texts[n], R.ENTITY_RATIO) >= R.ENTITY_RATIO) if key else ()
        like = next(iter(alike), None)
        if like is not None:
            if len(name) <= len(kept[like]):
                continue
            upper.discard(kept.pop(like).strip().upper())
        number = likes.add(key)
        kept[number] = name
        upper.add(shown)
    return list(kept.values())


def merged_name(names: list[str], persons: bool) -> tuple[str, int]:
    """The name of one group's rows, in their order, and how many persons it had before the cap. Names may hold several by slashes."""
    told = [n for name in names if (n := name.strip()) and not NULL_NAME.match(n)]
    each = [p.strip() for n in told for p in re.split(r"\s*[/\\]\s*", n) if p.strip()]
    if not persons:
        return ", ".join(map(company, merged_companies(each))), 0
    people = merged_people([p for n in each for p in individuals(n)])
    return combine(people[: R.HOUSEHOLD_CAP]), len(people)
