import random
from difflib import SequenceMatcher
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from addrloom.operators.grams import near_candidates


def _texts(seed):
    """Short and long texts, changed ones, repeats and runs of one letter."""
    draw = random.Random(seed)
    made = ["", "A", "AA", "AAA", "AAAA", "AB", "BA", "ABC", "ABCD", "ABCDE", "AAAAAAAAAAAAAAAA", "AAAAAAAAAAAAAAAAA", "AAAAAAAAAAAAAAAB"]
    for _ in range(60):
        text = "".join(draw.choice("ABCDE ") for _ in range(draw.choice([3, 5, 8, 13, 20, 34])))
        made.append(text)
        for _ in range(3):
            at, cut = draw.randrange(len(text)), draw.choice([0, 1, 2])
            made.append(text[:at] + draw.choice(["", "X", "AB"]) + text[at + cut :])
    return made


@pytest.mark.parametrize("least", [0.5, 0.85, 0.9, 1.0])
def test_no_similar_pair_is_lost_and_none_comes_twice(spark, least):
    texts = _texts(int(least * 100))
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = [tuple(sorted((r.x, r.y))) for r in near_candidates(rows, least).collect()]
    assert len(got) == len(set(got))
    want = {tuple(sorted((i, j))) for i, j in permutations(range(len(texts)), 2) if texts[i] and texts[j] and SequenceMatcher(None, texts[i], texts[j]).ratio() >= least}
    assert want and want <= set(got)
    assert len(got) < len(texts) * (len(texts) - 1) / 2


def test_keys_conditions_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "MAIN STREET", "k", True), (2, "MAIN STREETS", "k", False), (3, "MAIN STREET", "l", True), (4, "MAIN STREET", "k", False), (5, None, "k", True)], "id long, text string, k string, open boolean")
    met = [(F.col("open"), F.col("open")), (F.col("open"), ~F.col("open")), (~F.col("open"), F.col("open"))]
    got = {tuple(sorted((r.x, r.y))) for r in near_candidates(rows, 0.85, ["k"], met).collect()}
    assert got == {(1, 2), (1, 4)}
    assert near_candidates(rows.limit(0), 0.85, ["k"]).count() == 0
    with pytest.raises(ValueError):
        near_candidates(rows, 0.0)
