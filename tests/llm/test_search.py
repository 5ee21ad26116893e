"""Treap search against scores of every document."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from addrloom.llm import queries, search


def plain_terms(text):
    out = [""]
    for c in text or "":
        if ord(c) > 127 or c.isalnum():
            out[-1] += c.lower() if c.isascii() else c
        else:
            out.append("")
    return [t for t in out if t]


def plain_ranked(docs, items, k=10):
    """``(item id, rank, document id, score)`` by a loop over everything."""
    bags = [(i, plain_terms(t)) for i, t in docs]
    bags = [(i, len(ts), Counter(ts)) for i, ts in bags if ts]
    n_docs, n_terms = len(bags), sum(b[1] for b in bags)
    df, out = Counter(t for b in bags for t in b[2]), []
    for item, text in items:
        scored = []
        for i, n, bag in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in plain_terms(text) if bag[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_terms():
    text = "A-Z0 ÄB c_dİ \x7fE^f`g\x00h 日本 3.14\n"
    assert [t.decode() for t in search.terms_of(text.encode())] == plain_terms(text)
    assert search.terms_of(None) == search.terms_of(b"") == []


@pytest.mark.parametrize("seed", range(6))
def test_treaps(monkeypatch, seed):
    """Few impacts (ties), impacts that rise and fall with the document, terms of every document and of none."""
    monkeypatch.setattr(search, "LEAF", [1, 3, 16][seed % 3])
    monkeypatch.setattr(search, "TOGETHER", [1, 5][seed % 2])
    rng = np.random.default_rng(seed)
    docs, terms = 120, 9
    value = np.where(rng.random((terms, docs)) < rng.random((terms, 1)), rng.integers(1, [3, 1000][seed % 2], (terms, docs)), 0)
    value[0], value[1], value[2], value[3] = np.arange(docs) + 1, docs - np.arange(docs), 5, 0
    term, doc = np.nonzero(value)
    treaps = search.Treaps(term, doc, value[term, doc], terms, docs)
    for t in range(terms):
        held = {i for i in range(len(term)) if term[i] == t}
        stack, seen = [(int(treaps.root[t]), -1, docs, 1 << 40)], set()
        while stack:
            node, lo, hi, most = stack.pop()
            if node >= 0:
                assert lo < treaps.doc[node] < hi and treaps.value[node] <= most
                seen.add(node)
                stack += [(int(treaps.left[node]), lo, int(treaps.doc[node]), int(treaps.value[node])), (int(treaps.right[node]), int(treaps.doc[node]), hi, int(treaps.value[node]))]
        assert seen == held
    for _ in range(20):
        some = rng.choice(terms, rng.integers(1, terms + 1), replace=False)
        weight = rng.integers(1, 50, len(some))
        score = (value[some] * weight[:, None]).sum(0)
        k = int(rng.integers(1, 30))
        want = [(int(d), int(score[d])) for d in np.lexsort((np.arange(docs), -score))[:k] if score[d] > 0]
        top, got = treaps.best(some, weight, k)
        assert list(zip(top.tolist(), got.tolist())) == want


def texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("shard,block", [(1 << 20, 256), (150, 3)])
def test_ranking(spark, monkeypatch, shard, block):
    """One shard and one block, or many of both; copies, ties, nulls, long texts, other columns."""
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "LEAF", 4)
    docs = list(enumerate(texts(120, 1))) + [(200 + i, "W1 w2, w3! ÄÖ") for i in range(30)] + [(300, None), (301, ""), (302, " .,- "), (303, "w5 " * 60_000), (None, "w1 w2 w3 solo")]
    items = list(enumerate(texts(12, 2))) + [(20, "w1 W1 w2 äö ÄÖ"), (21, None), (22, ""), (23, "nowhere"), (24, "w1 " * 500), (25, "solo")]
    d = spark.createDataFrame([(t, i, 1, 2, "x") for i, t in docs], "text string, doc_id long, score int, rank int, `a.b` string")
    q = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, term int")
    got = sorted((tuple(r) for r in search.ranked(d, q).collect()), key=str)
    assert got == plain_ranked(docs, items)
    assert {r[0] for r in got} == set(range(12)) | {20, 24, 25} and any(r[2] is None for r in got)
    assert search.ranked(d.limit(0), q).count() == search.ranked(d, q.limit(0)).count() == 0


def test_repeated_ids_and_other_types(spark):
    docs = spark.createDataFrame([("b", "x y"), ("b", "x y"), ("a", "x y"), ("c", "z"), ("a.b", "q")], "`my.id` string, `a.text` string")
    items = spark.createDataFrame([("i", "x"), ("i", "z")], "`item.id` string, t string")
    got = [tuple(r) for r in search.ranked(docs, items, 2, "my.id", "a.text", "item.id", "t").collect()]
    assert sorted((r[1], r[2]) for r in got) == [(1, "a"), (1, "c"), (2, "b")]


def test_query(spark, tmp_path):
    docs, items = list(enumerate(texts(300, 5))), list(enumerate(texts(9, 6)))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.QUERIES["op13_treap_search"](spark, str(tmp_path)).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == plain_ranked(docs, items)
