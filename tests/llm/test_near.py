"""SimHash near-deduplication against brute force."""

import random

import numpy as np
import pytest
import xxhash

from addrloom.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if len(words) >= 3 else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "Two words", "Three Word Text", "a b c d\x0be f É È", "x y z " * 3000])
def test_fingerprints(text):
    assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


def components(values, distance=2):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    groups = {}
    for i in range(len(values)):
        groups.setdefault(find(i), set()).add(values[i])
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_lose_no_component(spark, seed):
    rng = random.Random(seed)
    values = {rng.getrandbits(64) for _ in range(80)} | {0, (1 << 64) - 1}
    hub = rng.getrandbits(64)  # a block with far more members than are compared pair by pair
    values |= {hub ^ (1 << a) ^ (1 << b) for a in range(14) for b in range(a)} | {hub ^ (1 << b) for b in range(64)}
    for v in list(values)[:40]:
        for _ in range(4):
            v ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))  # chains
            values.add(v)
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.near_links(df).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    assert len(links) < len(values) ** 2 / 4
    parts = simhash.connected_components(simhash.near_links(df)).collect()
    found = {}
    for r in parts:
        found.setdefault(r.component, set()).add(r.node % 2**64)
    assert {frozenset(g) for g in found.values()} == {g for g in components(values) if len(g) > 1}


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base), (7, base.upper()), (9, base + " more"), (2, "something else entirely here"), (4, None), (3, " "), (None, base), (11, "z" * 100_000), (2, "something else entirely here")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fingerprint int")
    got = simhash.near_copies(df).collect()
    assert len(got) == len(rows)
    values = {i: plain_fingerprint(t) for i, t in rows}
    assert all(r.fingerprint == f"{values[r.doc_id]:016x}" for r in got)
    by = {r.doc_id: r.component_id for r in got}
    assert by[5] == by[7] == by[None] == 5 and by[4] == by[3] == 3 and by[2] == 2
    near = (values[5] ^ values[9]).bit_count() <= 2
    assert (by[9] == 5) == near
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns and {3, 5, 2, None} <= {r.doc_id for r in kept.collect()}
    assert simhash.near_copies(df.limit(0)).count() == 0
