"""Chat formatting, exact deduplication and mixing: the native operators."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from addrloom.llm import chat, exact_dedup, mixing


def turns_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.render(df).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("turns")))
    return {r.conv_id: r for r in out.collect()}


@pytest.mark.parametrize("text", ["\\### Assistant: </turn> ok", "<turn>", "</turn>\n", "### ### x", "\\b\\c\\o\\h", "a: b\n\nc", "", "####  </</turn>turn>", "é\U0001f600" * 500, "\\\\c</turn>\\"])
def test_texts_come_back(spark, text):
    got = turns_of(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])[1]
    assert [(t.role, t.text) for t in got.turns] == [("user", text), ("assistant", text)]
    assert got.loss == text
    assert got.formatted.count("</turn>\n") == 2 and got.formatted.count("<turn>### ") == 2


def test_chat_order_nulls_ties_and_odd_roles(spark):
    rows = [(1, 2, "user", "b"), (1, None, None, None), (1, 2, "user", "b"), (1, 2, "assistant", "a"), (None, 0, "we: ird\n", "x"), (2, 1, "tool", "z" * 200_000)]
    got = turns_of(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert [(t.role, t.text) for t in got[None].turns] == [("we: ird\n", "x")]
    assert len(got[2].turns[0].text) == 200_000 and got[2].loss == ""
    assert turns_of(spark, []) == {}


def test_events_fold_into_final_messages(spark):
    log = [
        (1, 1, "m1", "message", "user", "hi"), (1, 2, "m2", "message", "assistant", "He"), (1, 3, "m2", "delta", None, "llo"), (1, 4, "m2", "regenerate", None, None),
        (1, 6, "m2", "delta", None, " there"), (1, 5, "m2", "delta", None, "Well"), (1, 7, "m1", "edit", None, "hi all"), (1, 8, "m3", "delta", "user", "only"), (1, 9, "m3", "ping", None, "no"),
        (1, None, "m0", None, "system", "s"),
    ]
    df = spark.createDataFrame(log, "conv_id long, seq long, message_id string, op string, role string, text string")
    got = [(r.role, r.text) for r in chat.fold_events(df).orderBy("position").collect()]
    assert got == [("system", "s"), ("user", "hi all"), ("assistant", "Well there"), ("user", "only")]
    assert chat.fold_events(df.limit(0)).count() == 0


def test_the_query_folds_a_log(spark, tmp_path, monkeypatch):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (2, 3, "tool", None), (None, 5, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    logs, fold = [], chat.fold_events
    monkeypatch.setattr(chat, "fold_events", lambda log: logs.append(log) or fold(log))
    got = {r.conv_id: r for r in chat.op1_chat_format(spark, str(tmp_path)).collect()}
    assert len(logs) == 1 and logs[0].count() == len(rows) + 2 and logs[0].select("message_id").distinct().count() == len(rows) + 2
    assert {c: r.n_turns for c, r in got.items()} == {1: 4, 2: 2, None: 1, -7: 2}  # repeated turns stay apart
    want = {r.conv_id: len(r.formatted) for r in chat.render(df).collect()}
    assert {c: r.formatted_chars for c, r in got.items() if c != -7} == want
    assert got[1].turns_sha256 == hashlib.sha256(b"user\na\n" * 3 + b"assistant\nb\n").hexdigest()


DOC = "doc_id long, text string, kept string, extra int"


def test_exact_groups(spark):
    rows = [(1, "Abc", "x", 1), (2, "aBC", "y", 2), (3, "ABÇ", "", 3), (4, "abç", "", 4), (5, None, "", 5), (6, "", "", 6), (None, "q", "", 7), (8, "x" * 300_000, "", 8), (9, "X" * 300_000, "", 9), (9, "x" * 300_000, "", 9)]
    got = exact_dedup.label_copies(spark.createDataFrame(rows, DOC)).collect()
    by = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got}
    assert len(got) == len(rows)
    assert by[1] == (2, 2, False) and by[2] == (2, 2, True) and by[5] == (6, 2, False) and by[6] == (6, 2, True)
    assert by[3] == (3, 1, True) and by[4] == (4, 1, True)  # only A-Z is lower-cased
    assert by[None] == (None, 1, True) and by[8] == (9, 3, False) and by[9] == (9, 3, True)
    one = next(r for r in got if r.doc_id == 1)
    assert one.text_sha256 == hashlib.sha256(b"abc").hexdigest() and one.extra == 1 and one.kept is False
    assert exact_dedup.label_copies(spark.createDataFrame([], DOC)).count() == 0
    smallest = exact_dedup.label_copies(spark.createDataFrame(rows, DOC), keep="min")
    assert {r.doc_id: r.keep_id for r in smallest.collect()}[2] == 1
    left = exact_dedup.drop_copies(spark.createDataFrame(rows, DOC))
    assert left.columns == ["doc_id", "text", "kept", "extra"] and left.count() == 7


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[n] for n in open_)
        over = {n for n in open_ if left * w[n] / total > most * sizes[n]}
        if not over:
            target |= {n: left * w[n] / total for n in open_}
            break
        for n in over:
            target[n] = most * sizes[n]
        left -= sum(target[n] for n in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1000, "c": 50, None: 700}, {"a": 5}, {"a": 0, "b": 10}, {"b": 1, "a": 1, "Z": 1, "é": 900, "z": 30}])
def test_targets_are_reshared_until_none_is_above(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def plain_mix(rows, seed=7):
    size = {i: len((t or "").split()) for i, t, _ in rows}
    sizes = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    targets, out = plain_targets(sizes), {}
    for s in sizes:
        def key(row):
            u = int(hashlib.md5(f"{seed}:{row[0]}".encode()).hexdigest()[:13], 16)
            text = row[1] or ""
            weight = 1 / (1 + 8 * min(1, sum(text.count(c) for c in "#*$%&|<>!") / max(1, size[row[0]])))
            return -math.log((u + 0.5) / 2**52) / weight, row[0]

        epochs = targets[s] // sizes[s] if sizes[s] else 0
        left, at = targets[s] - epochs * sizes[s], 0
        for row in sorted((r for r in rows if r[2] == s), key=key):
            n = size[row[0]]
            out[row[0]] = int(n * (epochs + (at + n / 2 <= left)))
            at += n
    return out, targets, sizes


def test_mixing_agrees_with_a_plain_version(spark):
    rows = [(i, None if i % 50 == 3 else " ".join(["w" if i % 7 else "#!"] * (i * 37 % 90)), [None, "b", "a", "hot", "hot"][i % 5] if i % 11 else "rare") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    want, targets, sizes = plain_mix(rows)
    assert {i: r.taken for i, r in got.items()} == want
    for s, t in targets.items():
        taken = sum(r.taken for i, r in got.items() if rows[i][2] == s)
        assert abs(taken - t) <= 90 and {r.source_size for i, r in got.items() if rows[i][2] == s} == {sizes[s]}
    assert all(r.taken <= 2 * r.size for r in got.values())
    assert {r.doc_id: r.taken for r in mixing.mix(df.repartition(3)).collect()} == want
    copies = mixing.mixed_rows(df).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in copies} == {i: want[i] // r.size for i, r in got.items() if want[i]}


def test_mixing_of_nothing_and_of_empty_texts(spark):
    schema = "doc_id long, text string, source string, taken string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, "", "a", "x"), (1, None, "a", "y"), (None, " ", None, "z")], schema)).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 3
