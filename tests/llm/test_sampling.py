"""The bound of the samples that models are fitted on, whatever repeats or is null; ids of any name."""

import pytest
from pyspark.sql import functions as F

from addrloom.llm import bytecnn, language, rules, toxicity
from addrloom.llm.sampling import hash_sample, labelled_sample


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, label int")


@pytest.mark.parametrize("rows,want", [
    ([(7, f"text {i}", i % 2) for i in range(2000)], 100), ([(None, f"text {i}", 1) for i in range(2000)], 100), ([(i % 50, f"text {i}", 1) for i in range(2000)], 100),
    ([(7, "same", 1)] * 2000, 1), ([(i, None, 1) for i in range(300)], 100), ([(i, "t", 1) for i in range(40)], 40), ([], 0),
])
def test_no_more_rows_than_asked_for_and_no_fewer(spark, rows, want):
    df = table(spark, rows)
    got = hash_sample(df, 100, ["id", "text"]).collect()
    assert len(got) == want and set(map(tuple, got)) <= set(rows)
    assert sorted(map(str, got)) == sorted(map(str, hash_sample(df.repartition(7), 100, ["id", "text"]).collect())) or want == 1
    by = hash_sample(df, {1: 30, 0: 20}, ["id", "text"], by="label").collect()
    for label, most in ((1, 30), (0, 20)):
        assert sum(r.label == label for r in by) == min(most, len({r for r in rows if r[2] == label}))
    assert hash_sample(df, 10, ["id", "text"], by="label").count() == sum(min(10, len({r for r in rows if r[2] == x})) for x in (0, 1))


def test_rows_of_one_labelled_id_are_bounded(spark):
    docs = spark.createDataFrame([(1, f"a {i}") for i in range(500)] + [(2, "b"), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, {1: 40, 0: 40}, "doc_id", F.col("text"), "toxic").collect()
    assert sum(r.label for r in got) == 40 and [r.id for r in got if not r.label] == [2]


def test_models_fit_with_ids_of_any_name_and_without_rows(spark):
    names = {"doc_id": "a.b", "text": "the.text"}
    rows = [(i // 2 if i % 7 else None, ("you awful pathetic clown " if i % 3 == 0 else "house river stone of the ") * 9 + str(i), "en" if i % 2 else "de", i % 3 != 0, int(i % 3 == 0), 1) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality boolean, toxic int, features int").withColumn("quality", F.col("quality").cast("int"))
    labels = docs.where("doc_id is not null").select("doc_id", "quality", "toxic")
    for d, some in ((docs, labels), (docs.limit(0), labels), (docs, labels.limit(0))):
        d, some = d.withColumnsRenamed(names), some.withColumnsRenamed(names)
        assert toxicity.fit(d, some, "a.b", "the.text").cuts.size
        assert bytecnn.fit(d, some, "a.b", "the.text").weights.size
        assert rules.fit(d, some, "a.b", "the.text") is not None
        assert set(language.fit(d, "a.b", "the.text").content) <= {"en", "de"}
    clash = docs.drop("features").withColumnRenamed("doc_id", "features")
    assert rules.measure(clash, "features").count() == 90 and rules.fit(clash, labels.withColumnRenamed("doc_id", "features"), "features") is not None
