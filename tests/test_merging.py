"""Splitting and merging the rows of one address against plain loops; hot addresses and hot blocks."""

import random
import time

import plain_merge
import pytest
from pyspark.sql import functions as F

from addrloom.functions import grammar as G
from addrloom.functions import rules as R
from addrloom.functions import similar
from addrloom.operators import matching
from addrloom.operators.components import connected_components
from addrloom.operators.matching import address_clusters, match_columns, similar_links, similar_pairs
from addrloom.operators.merging import merge_clusters, split_clusters

COLUMNS = [*R.FIELDS, *R.LINEAGE]
GIVEN = ["John", "Jon", "Johnn", "Mary", "Marie", "Maria", "Al", "AJ", "Aaron", "Aron", "J", "Martha", "Marta", "Christopher", "Cristopher"]
FAMILY = ["Smith", "Smyth", "Lee", "Jones", "de la Cruz", "O'Neil"]
COMPANY = ["Acme Hardware", "Acme Hardwares", "Acme Hardware LLC", "ACME HARDWARE", "Butterfield Trail", "Buterfield Trail", "Smith Family Trust", "City of Mesa", "A", "AB", "", " "]


def person(rng):
    return " ".join(x for x in (rng.choice(GIVEN), rng.choice(["", "", "A.", "B.", "Lee"]), rng.choice([*FAMILY, ""])) if x)


def test_people_join_as_by_a_plain_loop():
    rng = random.Random(1)
    for _ in range(1500):
        names = [rng.choice([person(rng), "", person(rng)]) for _ in range(rng.randrange(1, 14))]
        plain = []
        for name in names:
            at = next((i for i, k in enumerate(plain) if G.same_person(name, k)), None)
            if at is None:
                plain.append(name)
            else:
                plain[at] = G.richer(name, plain[at])
        assert similar.merged_people(names) == plain, names


def test_names_merge_as_by_a_plain_loop():
    rng = random.Random(2)
    for _ in range(1500):
        names = [rng.choice(COMPANY) + rng.choice(["", " ", "s", " Inc", "/x"]) for _ in range(rng.randrange(1, 12))]
        each = [p.strip() for n in names if n.strip() and not G.NULL_NAME.match(n.strip()) for p in plain_merge.re.split(r"\s*[/\\]\s*", n.strip()) if p.strip()]
        assert similar.merged_name(names, False) == (plain_merge.merged_companies(each), 0), names
        names = [rng.choice([f"{person(rng)} & {person(rng)}", person(rng), f"{person(rng)}/{person(rng)}", "PENDING"]) for _ in range(rng.randrange(1, 9))]
        each = [p.strip() for n in names if not G.NULL_NAME.match(n) for p in plain_merge.re.split(r"\s*[/\\]\s*", n) if p.strip()]
        assert similar.merged_name(names, True) == plain_merge.merged_persons(each), names


@pytest.mark.parametrize("least", [0.5, 0.8, 0.9, 1.0])
def test_no_alike_text_is_left_out(least):
    rng = random.Random(int(least * 10))
    texts = ["", "a", "aa", "ab", "aaa", "aaaa"] + ["".join(rng.choice("abc ") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 30]))) for _ in range(150)]
    likes = similar.Likes(least)
    for i, text in enumerate(texts):
        want = [j for j in range(i) if G.ratio(text, texts[j]) >= least or G.ratio(texts[j], text) >= least]
        assert set(want) <= set(likes.like(text))
        assert [n for n in likes.like(text) if n >= i // 2] == likes.like(text, i // 2)
        likes.add(text)


def rows_of(spark, rows):
    """Rows of (cluster, source, name, second line, street) with lineage."""
    full = [(i, 0, c, *r, f"C{i % 3}", "AZ", "85201", name if i % 4 else "", "x" if i % 5 == 0 else " ", "f") for i, (c, *r) in enumerate(rows) for name in [r[1]]]
    df = spark.createDataFrame(full, "_ord long, phase int, cluster long, data_source string, full_name string, second_line string, street string, city string, state string, zip string, owner1_original string, city_original string, p1_first string")
    sizes = df.groupBy("cluster").agg(F.count("*").alias("n"))
    return df.select("_ord", "phase", "cluster", *[(F.col(c) if c in df.columns else F.lit("")).alias(c) for c in COLUMNS]).join(sizes, "cluster")


def plain_rows(rows):
    clusters = {}
    for r in sorted((r.asDict() for r in rows.collect()), key=lambda r: r["_ord"]):
        clusters.setdefault(r["cluster"], []).append(r)
    out = []
    for cluster, some in clusters.items():
        for sub, group in enumerate(plain_merge.subgroups(some)):
            merged = plain_merge.merge_rows(group)
            sources = len({r["data_source"].strip() for r in group} - {""}) if len(some) > 1 else 1
            out.append((cluster, sub, len(some), *[merged[c] for c in COLUMNS], merged["household"], sources))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clusters_merge_as_by_plain_loops(spark, seed):
    rng = random.Random(seed)
    rows = []
    for cluster in range(60):
        for _ in range(rng.choice([1, 2, 2, 3, 5, 9])):
            name = rng.choice([person(rng), person(rng), f"{person(rng)} & {person(rng)}", rng.choice(COMPANY), f"{rng.choice(GIVEN)} {rng.choice(FAMILY)}"])
            rows.append((cluster, rng.choice(["Parcel", "Consumer", "Business", " Parcel", "Consumer, Parcel", ""]), name, rng.choice(["", "", "c/o A", "Owner"]), f"{rng.randrange(9)} Oak St."))
    df = rows_of(spark, rows)
    got = sorted((r.cluster, r.sub, r.n, *[r[c] for c in COLUMNS], r.household, r.sources) for r in merge_clusters(df).collect())
    assert got == plain_rows(df)
    assert merge_clusters(df.limit(0)).count() == split_clusters(df.limit(0)).count() == 0


def syllables(rng, n):
    return "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiou") for _ in range(n)).title()


def test_ten_thousand_persons_at_one_address(spark):
    """All at one address and of two sources; surnames are shared by a few each, which makes thousands of parts, and a cluster whose
    persons are one part. Loops over all earlier persons would take minutes."""
    rng = random.Random(7)
    surnames = [syllables(rng, 3) for _ in range(4000)]
    rows = [(0, rng.choice(["Parcel", "Consumer"]), f"{syllables(rng, rng.randrange(2, 4))} {rng.choice(surnames)}", "", "1 Oak St.") for _ in range(10_000)]
    rows += [(1, "Parcel", f"{syllables(rng, rng.randrange(2, 4))} {rng.choice(surnames)}", "", "2 Oak St.") for _ in range(10_000)]
    df = rows_of(spark, rows)
    began = time.time()
    got = merge_clusters(df).collect()
    took = time.time() - began
    names = {}
    for r in rows[:10_000]:
        names.setdefault(r[2].split()[-1], []).append(r)
    assert sum(r.cluster == 0 for r in got) == len(names)
    one = [r for r in got if r.cluster == 1]
    assert len(one) == 1 and one[0].n == 10_000 and one[0].household > 9000
    assert took < 90, took  # about 20 s on an idle machine, most of it Spark's


def test_a_hot_block_of_open_addresses(spark):
    """20,000 rows of one block without a house number, a third of them copies of one address, and changed spellings. All pairs
    would be 72 million ratios."""
    rng = random.Random(4)
    streets = [f"{syllables(rng, 4)} {syllables(rng, 3)} {rng.choice(['Trail', 'Loop', 'Way'])}" for _ in range(6000)]
    some = streets + [s.replace("a", "e", 1) for s in streets[:6000]] + [rng.choice(streets) for _ in range(1300)] + [streets[0]] * 6700
    df = spark.createDataFrame([(i, s, "Mesa", "AZ", "85201", rng.choice(["", "", "c/o X"])) for i, s in enumerate(some)], "_ord long, street string, city string, state string, zip string, second_line string")
    rows = match_columns(df)
    began = time.time()
    links = similar_links(rows)
    n = links.count()
    took = time.time() - began
    assert n < 6 * len(some) and took < 120, (n, took)
    clusters = {r._ord: r.cluster for r in connected_components(links).select(F.col("node").alias("_ord"), F.col("component").alias("cluster")).collect()}
    base = {r._ord: (r.base, r.unit) for r in rows.collect()}
    near = [(i, 6000 + i) for i in range(6000)] + [tuple(sorted(rng.sample(range(20_000), 2))) for _ in range(3000)]
    near = [(a, b) for a, b in near if base[a][1] == base[b][1] and G.ratio(base[a][0], base[b][0]) >= R.ADDRESS_RATIO]
    assert len(near) > 4000 and all(clusters[a] == clusters[b] for a, b in near)
    assert len({clusters[i] for i, s in enumerate(some) if s == streets[0]}) == 1


def plain_similar(a, b):
    if a.block != b.block or a.po != b.po or (a.second and b.second and a.second != b.second):
        return False
    if a.po:
        return a.box == b.box
    if a.unit != b.unit or not a.base or not b.base or (a.house and b.house and a.house != b.house):
        return False
    return a.base == b.base or G.ratio(a.base, b.base) >= R.ADDRESS_RATIO


@pytest.mark.parametrize("most", [1, 32])
def test_pairs_and_clusters_agree_with_all_pairs(spark, monkeypatch, most):
    """Both ways of meeting, by grams and one by one."""
    monkeypatch.setattr(matching, "ALL_PAIRS", most)
    rng = random.Random(most)
    streets = [f"{rng.choice(['12', '13', ''])} {rng.choice(['Butterfield', 'Buterfield', 'Butterfeld', 'Oak', 'Oaks', 'Tide', 'Diet'])} {rng.choice(['Trail', 'Trl', 'St', ''])} {rng.choice(['', '', 'Apt 2', '#3'])}".strip() for _ in range(110)] + [f"PO Box {rng.randrange(4)}" for _ in range(12)] + ["", "Apt 4"]
    df = spark.createDataFrame([(i * 3, s, rng.choice(["Mesa", "Mesa", "Tempe"]), "AZ", "85201", rng.choice(["", "", "a", "b"])) for i, s in enumerate(streets)], "_ord long, street string, city string, state string, zip string, second_line string")
    rows = match_columns(df)
    all_ = sorted(rows.collect(), key=lambda r: r._ord)
    want = {(a._ord, b._ord) for i, a in enumerate(all_) for b in all_[i + 1 :] if plain_similar(a, b)}
    found = [(r.a, r.b) for r in similar_pairs(rows).collect()]
    assert set(found) == want and len(found) == len(want)
    pairs = connected_components(spark.createDataFrame(sorted(want), "a long, b long"))
    assert sorted(map(tuple, pairs.collect())) == sorted((r._ord, r.cluster) for r in address_clusters(rows).collect())
    assert similar_pairs(rows.limit(0)).count() == address_clusters(rows.limit(0)).count() == 0


def test_few_texts_are_held_against_each_other_without_grams():
    likes = similar.Likes(0.8)
    for i in range(similar.FEW):
        likes.add(f"text {i}")
    assert not likes.grams and likes.like("text 5") == list(range(similar.FEW))
    likes.add("other")
    assert len(likes.grams) == similar.FEW + 1 and 5 in likes.like("text 5")
