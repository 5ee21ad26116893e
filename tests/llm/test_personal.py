"""Personal data against plain patterns and a plain bootstrap; planted identifiers; hard texts."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from addrloom.llm import personal, queries

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
PARTING = set(map(chr, range(33))) | set("\"'(),;:!?<>[]{}|=*&$^`~\\ ") | set(map(chr, range(0x2018, 0x2020)))


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_holds(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_base(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in p.finditer(text or "") if plain_holds(k, m[0])]


def plain_mentions(text):
    """``(start, end)`` of phone-like, number-like and identifier-like words, from left to right."""
    text, out, i = text.translate({1: " ", 2: " "}), [], 0
    while i < len(text):
        if text[i] in PARTING or (i and text[i - 1] not in PARTING):
            i += 1
            continue
        end = i
        while end < len(text) and text[end] not in PARTING:
            end += 1
        m = PLAIN["phone"].match(text, i) or re.compile(r"[0-9](?:[ -]?[0-9]){12,}").match(text, i)
        if m:
            out.append((i, m.end()))
        elif any(c in "0123456789@_" for c in text[i:end]):
            out.append((i, end))
        else:
            i += 1
            continue
        i = out[-1][1]
    return out


def plain_graph(texts, rounds=3, support=3, sure=0.6):
    """Places of the instances, and their scores, by loops over all texts."""
    filled, totals, places = defaultdict(Counter), Counter(), defaultdict(list)
    for t, text in enumerate(texts):
        found = plain_mentions(text or "")
        marked, last = [], 0
        for s, e in found:
            marked += [(text[last:s], None), ("\x01", (s, e))]
            last = e
        marked.append(((text or "")[last:], None))
        words = [("\x02", None)] * 2
        for part, span in marked:
            if span:
                words.append(("\x01", span))
                continue
            for w in re.findall(r"[^\W\d_]+|\n", part.translate({1: " ", 2: " "})):
                words.append(("\x02" if w == "\n" else w.lower(), None))
        words += [("\x02", None)] * 2
        w = [x for x, _ in words]
        for i in range(2, len(w) - 2):
            around = [("a _", w[i - 1], ""), ("a b _", w[i - 2], w[i - 1]), ("a _ b", w[i - 1], w[i + 1]), ("_ a b", w[i + 1], w[i + 2])]
            totals.update(around)
            if words[i][1]:
                s, e = words[i][1]
                raw = text[s:e]
                s += len(raw) - len(raw.lstrip(".%/#-"))
                instance = raw.lstrip(".%/#-").rstrip(".%/#-+@_")
                if 4 <= len(instance) <= 64 and re.search("[0-9@_]", instance):
                    places[instance].append((t, s, s + len(instance)))
                    for c in around:
                        if any(x not in ("\x01", "\x02", "") for x in c[1:]):
                            filled[c][instance] += 1
    seeds = {i for i in places if any(p.fullmatch(i) and plain_holds(k, i) for k, p in PLAIN.items())}
    score = {i: float(i in seeds) for i in places}
    for _ in range(rounds):
        sums = defaultdict(Counter)
        for c, some in filled.items():
            good = {i for i in some if score[i] >= sure}
            if len(some) >= support and len(good) >= support:
                k, n = sum(some[i] * score[i] for i in good), sum(some.values())
                confidence = k / (k + totals[c] - n + 0.1 * (n - k) + 1)
                for i, times in some.items():
                    sums[i][c[0]] += times * confidence
        for i in places:
            g = max(sums[i].values(), default=0)
            score[i] = 1.0 if i in seeds else g / (g + 0.25 * (len(places[i]) - g) + 1e-12)
    return places, score, seeds


def plain_spans(texts):
    places, score, seeds = plain_graph(texts)
    out = [plain_base(t) for t in texts]
    base = [list(b) for b in out]
    for i, at in places.items():
        if i not in seeds and score[i] >= 0.6:
            for t, s, e in at:
                if not any(b[1] < e and b[2] > s for b in base[t]):
                    out[t].append(("id", s, e))
    return [b + sorted(o[len(b):]) for o, b in zip(out, base)]


def card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if luhn(body + d))


def planted(seed):
    """Prose, seeds in stated contexts, unseen identifiers in the same ones, and others that only those lead to."""
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice("the of and river stone house went with small that 12 page 2023 x1 a_b".split()) for _ in range(n))
    texts = [prose(rng.randrange(2, 60)) for _ in range(60)]
    for i in range(12):
        seen = [f"u{i}@mail.example.com", f"+1 ({300 + i}) 555-0{100 + i}", f"10.0.{i}.7", card(rng)][i % 4]
        texts.append(f"{prose(5)}. You can reach me under {seen}, {prose(4)}")
        texts.append(f"{prose(3)}\nContact: {seen}\n{prose(9)}")
    for i in range(6):
        texts.append(f"{prose(6)}! You can reach me under KX-{i}4{i}91. {prose(3)}")
        texts.append(f"{prose(6)}, badge number KX-{i}4{i}91 {prose(3)}")
    texts += [f"{prose(8)} badge number QQ7781/{i} {prose(2)}" for i in range(3)]
    texts += [f"{prose(4)} invoice total {5000 + i} {prose(4)}" for i in range(9)] + [f"Contact: {w}\n" for w in ("nobody", "x1")]
    return texts


ODD = [None, "", " \n\t", "a@b.c@d.ef g@h", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3", "4111 1111 1111 1111-4111", "+1+22 333 444 555 (6) +12", "ä\U0001f600 x@y.zz\x01\x02\x01 +49 30 1234567\x0112 é@e.de",
       "4111111111111111 04111111111111111 5500-0000-0000-0004", ".-%a@b.co.-", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "‘x@y.zz’ “+1 (222) 333-4444” z9 z9", "@ _ 0 a_ _1 @@"]


@pytest.fixture(scope="module")
def found(spark):
    """Spans of the planted texts and the odd ones, ids nulls and repeats among them."""
    texts = planted(1) + ODD + ODD[3:6]
    rows = [(None if i == 5 else i // 2, t, "k", 1, 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "`my.id` long, text string, kind string, spans int, h int")
    return rows, df, personal.find_personal(df, "my.id").collect()


def test_spans_agree_with_a_plain_bootstrap(found):
    rows, df, got = found
    want = plain_spans([r[1] for r in rows])
    said = lambda i, b, s: str((i, [tuple(x) for x in b], [tuple(x) for x in s]))
    assert sorted(said(r["my.id"], r.base, r.spans) for r in got) == sorted(said(r[0], plain_base(r[1]), w) for r, w in zip(rows, want))


def test_planted_identifiers_are_found_and_nothing_else(found):
    rows, df, got = found
    texts = planted(1)
    ids = {texts[i][s:e] for i, spans in enumerate(plain_spans(texts)) for k, s, e in spans if k == "id"}
    assert ids == {f"KX-{i}4{i}91" for i in range(6)} | {f"QQ7781/{i}" for i in range(3)}


def test_no_rows(spark, found):
    assert personal.find_personal(found[1].limit(0), "my.id").count() == 0


def test_running_sums(spark):
    for n in (1, 63, 64, 65, 5000):
        numbers = [(i * 7) % 11 for i in range(n)]
        got = spark.createDataFrame([(numbers,)], "x array<int>").select(personal.running(personal.F.col("x"))).first()[0]
        assert got == [sum(numbers[:i]) for i in range(n)] if n < 100 else got[-1] == sum(numbers[:-1]) and len(got) == n


def test_long_texts_take_linear_time(spark):
    """Runs that plain patterns would read again from every start, and thousands of spans in one text."""
    texts = ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" * 100_000, "z9 " * 30_000, " ".join(f"u{i}@x.org" for i in range(4000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r.base for r in personal.find_personal(df).collect()}
    assert time.time() - began < 120
    assert len(got[6]) == 4000 and tuple(got[6][-1]) == ("email", len(texts[6]) - 11, len(texts[6])) and not got[0] and not got[1]


def test_query(spark, tmp_path):
    texts = planted(2) + ODD
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op12_personal_data"](spark, str(tmp_path)).collect()}
    for i, spans in enumerate(plain_spans(texts)):
        said = [f"{k}:{s}:{e}" for k, s, e in spans]
        base = [x for x in said if x[:3] != "id:"]
        r = got[i]
        assert r.spans == ",".join(said) and r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in base) for k in PLAIN]


def test_plain_words_are_counted_in_all_texts_only_where_something_may_become_known(spark, monkeypatch):
    """Common words around seeds make nothing known, which a part of the texts shows; planted contexts still take the whole pass."""
    rng = random.Random(7)
    texts = [f"river {' '.join(['stone river'] * 40)} river u{i}@mail.example.com stone x{i} river {rng.randrange(99)}" for i in range(200)]
    passes, totals = [], personal._totals
    monkeypatch.setattr(personal, "_totals", lambda some, keys: passes.append(some.count()) or totals(some, keys))
    for some, whole in ((texts, False), (planted(3), True)):
        passes.clear()
        got = personal.find_personal(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")).collect()
        assert {r.doc_id: sorted(tuple(x) for x in r.spans) for r in got} == {i: sorted(w) for i, w in enumerate(plain_spans(some))}
        assert (len(some) in passes) == whole


def test_only_places_that_may_fill_a_context_become_rows(spark):
    """What few contexts can't be filled by stays in its text's row, however many words there are; counts are those of all places."""
    texts = [f"{'stone river ' * 500}{x}" for x in ("badge number K91", "Badge  number x, badge a", "number badge", "a_b badge, number\nbadge")]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    keys = spark.createDataFrame([("a b _", "badge", "number"), ("a _ b", "\x01", "number"), ("a _", "badge", "")], "kind string, a string, b string")
    keys = keys.withColumn("key", personal.F.xxhash64("kind", "a", "b"))
    assert personal._likely(df, keys).agg(personal.F.sum(personal.F.size("likely"))).first()[0] < 60
    got = {r.kind: r.total for r in keys.join(personal._totals(df, keys), "key").collect()}
    assert got == {"a b _": 3, "a _ b": 1, "a _": 4}
