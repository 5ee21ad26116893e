"""Clashing column names, ids of other types, repeated rows, hash collisions, added tokens: what the operators must bear."""

import random
import string

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from addrloom.llm import exact_dedup, mixing, packing, simhash

TOKENIZER = packing.public_tokenizer()
#: Names that the operators use inside or give to results, and some that older versions did.
CLASHING = ["row", "id", "t", "h", "s", "sha", "key", "n", "first", "kept", "edge", "last", "left", "before", "coarse", "fp", "component", "piece", "ids", "nth", "grp", "size", "_norm", "_h128", "_cut", "_key", "_copy", "copy", "taken", "a.b"]
ROWS = [(1, "Alpha beta gamma", "x"), (2, "ALPHA beta gamma", "x"), (3, None, None), (4, "", "y"), (5, "Alpha beta gamma", "y"), (6, "one " * 9000, "x"), (6, "one " * 9000, "x"), (None, "lone text", "z")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    for i, name in enumerate(CLASHING):
        df = df.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return df.cache()


def untouched(rows, names):
    return all(r[name] == f"{i}:{'-' if r['doc_id'] is None else r['doc_id']}" for r in rows for i, name in enumerate(CLASHING) if name in names)


def test_exact_copies_with_clashing_names(docs):
    got = exact_dedup.label_copies(docs)
    rows = got.collect()
    assert untouched(rows, set(docs.columns) - {"kept"}) and len(rows) == len(ROWS)
    by = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows}
    assert by == {1: (5, 3, False), 2: (5, 3, False), 5: (5, 3, True), 3: (4, 2, False), 4: (4, 2, True), 6: (6, 2, True), None: (None, 1, True)}
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "5", "6", "6", "None"]
    assert exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_texts_that_share_a_hash_are_told_apart(docs):
    weak = exact_dedup.label_copies(docs.select("doc_id", "text", "h"), hash_of=lambda t: F.octet_length(t).cast("string").cast("binary")).collect()
    strong = exact_dedup.label_copies(docs.select("doc_id", "text", "h")).collect()
    assert sorted(map(str, weak)) == sorted(map(str, strong))
    one = exact_dedup.label_copies(docs.select("doc_id", "text", "h"), hash_of=lambda t: F.lit(b"0"), keep="min").collect()
    assert {r.doc_id: r.keep_id for r in one} == {1: 1, 2: 1, 5: 1, 3: 3, 4: 3, 6: 6, None: None}


def test_near_copies_with_clashing_names_and_repeated_rows(spark, docs):
    kept = simhash.drop_near_copies(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns and untouched(rows, docs.columns)
    assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "6", "None"]  # 6 came twice, once stays
    same_id = spark.createDataFrame([("a", "one two three"), ("a", "quite another text here"), ("a", "one two three"), ("b", "one two three")], "doc_id string, text string")
    assert sorted(r.text for r in simhash.drop_near_copies(same_id).collect()) == ["one two three", "quite another text here"]
    assert {r.component_id for r in simhash.near_copies(same_id).collect()} == {"a"}


def test_mixture_with_clashing_names(docs):
    got = mixing.mix(docs)
    rows = got.collect()
    assert untouched(rows, set(docs.columns) - {"size", "taken"}) and len(rows) == len(ROWS)
    alone = mixing.mix_sizes(docs).collect()
    assert sorted(str((r.doc_id, r.source, r.size, r.taken, r.target)) for r in rows) == sorted(str((r.doc_id, r.source, r.size, r.taken, r.target)) for r in alone)
    copies = mixing.mixed_rows(docs)
    assert copies.columns == docs.columns and untouched(copies.collect(), docs.columns)
    assert copies.count() == sum(r.taken // r["size"] for r in alone if r["size"])
    assert mixing.mixed_rows(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["piece", "ids", "grp", "a.b"])
def test_packing_by_an_id_of_any_name(docs, name):
    got = packing.pack(docs.drop(name).withColumnRenamed("doc_id", name), TOKENIZER, id_col=name)
    assert got.columns == [name if name in ("grp", "a.b") else "id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    assert got.count() == 6 + 2 * 3


def test_ids_are_those_of_an_untouched_tokenizer(spark):
    fresh, words = Tokenizer.from_file(TOKENIZER), packing.Words(TOKENIZER, most=4000)
    added = [t.content for t in fresh.get_added_tokens_decoder().values()]
    assert added
    rng = random.Random(4)
    texts = [f"a{t}b" for t in added] + [f"x {t.upper()} y" for t in added] + [t[:-1] + " " + t[-1:] for t in added] + ["", " ", "ΑΣ ΣΑΣ", "KK Ω", "a\x1cb\x85c d"]
    alphabet = string.ascii_letters + string.digits + string.punctuation + " \n\t éßñÜ中あ́\U0001f600" + "".join(added)
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) + rng.choice(["", *added]) for _ in range(3000)]
    texts += [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    wrong = [t for t in texts if words.ids(t) != packing.array.array("I", fresh.encode(t, add_special_tokens=False).ids).tobytes()]
    assert not wrong, wrong[:3]
    assert len(words) + len(words.older) < 60


@pytest.mark.parametrize("nth", range(5))
def test_each_stage_bears_hard_rows(spark, docs, nth):
    """Nulls, empty and very long texts, ties, repeats, no rows, and columns of clashing names, each stage alone."""
    name, stage = corpus_pipeline.STAGES[nth]
    got = stage(spark, docs, "").collect()
    if nth < 4:
        assert stage(spark, docs, "").columns == docs.columns and untouched(got, docs.columns)
    else:
        assert sum(r.length for r in got if r.doc_id == 3) == 1
    assert stage(spark, docs.limit(0), "").count() == 0
