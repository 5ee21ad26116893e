"""Periodic runs against a search of every stretch and period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from addrloom.llm import queries, runs

OTHERS = [("runs", 7), ("collapsed", "x"), ("start", 1), ("h", 2), ("a.b", 3)]


def plain_runs(words, least=6, times=4):
    """Of every period the maximal stretches; of equal stretches the smallest period."""
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                found.setdefault((i, j + p), p)
            i = max(j, i) + 1
    return sorted([[s, e - s, p] for (s, e), p in found.items()], key=lambda r: (r[0], r[2]))


def plain_collapse(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(rng):
    """Words with runs in runs, broken ones, and few different words."""
    out = []
    for _ in range(rng.randrange(1, 8)):
        unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        part = unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit))]
        if rng.random() < 0.3:
            part = part * rng.randrange(1, 5)
        if part and rng.random() < 0.4:
            part[rng.randrange(len(part))] = "z"
        out += part + [rng.choice("abcdxyz") for _ in range(rng.randrange(4))]
    return out


@pytest.mark.parametrize("least,times", [(6, 4), (1, 2), (5, 3)])
def test_runs_agree_with_a_search_of_everything(least, times):
    rng = random.Random(least)
    for _ in range(400):
        words = made(rng)
        codes = runs.codes_of([w.encode() for w in words])
        assert runs.runs_of(codes, least, times).tolist() == plain_runs(words, least, times), words


@pytest.mark.parametrize("words", [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 7, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"], ["a"] * 30 + ["b"] * 30, list("abcd") * 3, list("abcd") * 4])
def test_short_texts(words):
    assert runs.runs_of(runs.codes_of([w.encode() for w in words])).tolist() == plain_runs(words)


def test_hashes_that_claim_too_much_are_noticed(monkeypatch):
    """With a prime this small the first claims are wrong; the words decide, and another base is taken."""
    monkeypatch.setattr(runs, "_PRIME", 8191)
    rng = random.Random(5)
    for _ in range(30):
        words = [rng.choice("ab") for _ in range(300)]
        real, runs.random.Random = runs.random.Random, lambda seed: type("R", (), {"randrange": lambda self, a, b, r=rng: r.randrange(2, 8190)})()
        try:
            got = runs.runs_of(runs.codes_of([w.encode() for w in words])).tolist()
        finally:
            runs.random.Random = real
        assert got == plain_runs(words)


def test_blocks_of_pairs_change_nothing(monkeypatch):
    words = made(random.Random(9)) * 6
    codes = runs.codes_of([w.encode() for w in words])
    whole = runs.runs_of(codes).tolist()
    monkeypatch.setattr(runs, "PAIRS", 7)
    assert runs.runs_of(codes).tolist() == whole == plain_runs(words)


def test_long_texts():
    """A run of 100,000 words, and 120,000 words without one."""
    unit = [f"w{i}" for i in range(997)]
    words = ["x"] + unit * 100 + ["y"]
    assert runs.runs_of(runs.codes_of([w.encode() for w in words])).tolist() == [[1, 99700, 997]]
    rng = random.Random(3)
    plain = [str(rng.randrange(50)) for _ in range(120_000)]
    assert runs.runs_of(runs.codes_of([w.encode() for w in plain]), 12).tolist() == plain_runs_of_small_period(plain, 12)


def plain_runs_of_small_period(words, least):
    codes, out = np.array([int(w) for w in words]), []
    for p in range(1, 60):  # longer periods don't come four times by chance
        differ = np.flatnonzero(np.append(np.insert(codes[:-p] != codes[p:], 0, True), True))
        for a, b in zip(differ[:-1], differ[1:]):
            if b - a - 1 + p >= max(least, 4 * p) and b - a > 1:
                out.append([int(a), int(b - a - 1 + p), p])
    return sorted(out)


def test_documents(spark):
    texts = [None, "", " \t ", "one two", "go " * 50, "a b c\n" * 9 + "end", "Ä ö\x0bÄ ö Ä ö Ä ö", "word x " * 8, "a b c\n" * 9 + "end"]
    rows = [(i if i < 8 else None, t, *[v for _, v in OTHERS]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string, start int, h int, `a.b` int")
    got = runs.find_runs(df).collect()
    assert len(got) == len(rows)
    for (_, text, *_rest), r in zip(rows, got):
        words = [w.decode() for w in (text or "").encode().split()]
        found = plain_runs(words)
        assert [list(x) for x in r.runs] == found and r.collapsed == plain_collapse(words, found)
        assert r["a.b"] == 3 and r.start == 1 and r.h == 2
    assert runs.find_runs(df.limit(0)).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(made(rng)) if i % 9 else rng.choice([None, "", "x", "go " * 40])) for i in range(300)] + [(7, "a b " * 9), (None, "c d " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect())))
    want = []
    for i, text in rows:
        words, h = (text or "").split(), zlib.crc32(b"" if i is None else str(i).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        found = plain_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=[None] * 3)
        said = "".join("%d,%d,%d\n" % tuple(r) for r in found)
        want.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(plain_collapse(words, found).encode()).hexdigest()))
    assert got == sorted(map(str, want))
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(300))
