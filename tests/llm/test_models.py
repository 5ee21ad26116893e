"""Language, rules, the byte network and toxicity: small fits, edge cases, and counts against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from addrloom.llm import bytecnn, language, rules, toxicity

RNG = random.Random(4)
WORDS = {"en": "the of and with from house river stone that which", "de": "der die und nicht mit haus fluss stein dass welche", "xx": "zaq wsx cde rfv bgt nhy mju"}


def prose(lang, n, rng=RNG):
    return " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "", "s", "er"]) for _ in range(n))


def test_language(spark):
    rows = [(i, prose(lang, 60), lang, "s") for lang in ("en", "de", "xx") for i in range(100 * len(lang), 100 * len(lang) + 40)]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, lang string, score string")
    model = language.fit(docs)
    tests = [(1, prose("en", 40), "en"), (2, prose("de", 4000), "de"), (3, None, "und"), (4, " 12 !?", "und"), (5, "", "und"), (6, prose("xx", 6), "xx"), (6, prose("xx", 6), "xx")]
    got = language.identify(spark.createDataFrame([(i, t, 1) for i, t, _ in tests], "doc_id long, text string, lang_pred int"), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got] == [(i, w) for i, _, w in tests]
    assert all(0 <= r.score <= 1 for r in got) and [r.lang_rejected for r in got] == [w == "und" for _, _, w in tests]
    empty = language.fit(docs.limit(0))
    assert language.identify(docs.limit(2), empty).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language.identify(docs.limit(0), model).count() == 0


def plain_statistics(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if any(c not in " \t\x0b\x0c\r" for c in x)]
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)]


def test_rule_statistics():
    rng = random.Random(8)
    texts = ["", " \n\t", "a", "é b c\x85d", "x " * 9, "x " * 8, "q w\n\nq w\n q w\nq w", "a b c d e f g h i a b c d e f g h", "#*$ %&|<> é"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + "\n" * rng.randrange(3) for _ in range(200)]
    for t in texts:
        assert rules.statistics(t.encode())[0] == plain_statistics(t), repr(t)


def test_forest(spark):
    good = [(i, " ".join(RNG.choice(WORDS["en"].split()) + str(RNG.randrange(99)) for _ in range(80)), 1) for i in range(300)]
    bad = [(1000 + i, " ".join(f"w{RNG.randrange(999)}###" for _ in range(80)), 0) for i in range(60)]
    # Trees grow on rows as they come, so what is odd has to be rare among all rows, whatever part of them is labelled.
    plain = [(2000 + i, " ".join(RNG.choice(WORDS["en"].split()) + str(RNG.randrange(99)) for _ in range(80)), None) for i in range(1500)]
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in good + bad + plain], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id long, quality int")
    forest = rules.fit(docs, labels)
    got = {r.doc_id: r.kept for r in rules.judge(docs, forest).collect()}
    assert np.mean([got[i] for i, _, _ in good]) > 0.97 and np.mean([got[i] for i, _, _ in bad]) < 0.1
    odd = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "same word " * 500)], "doc_id long, text string")
    assert [(r.n_words, r.base_failed, r.kept) for r in rules.judge(odd, forest).collect()] == [(0, True, False)] * 3 + [(1000, True, False)]
    none = rules.fit(docs, labels.limit(0))
    assert rules.judge(docs.limit(5), none).where("kept").count() == 5
    assert rules.judge(docs.limit(0), forest).count() == 0


def test_forest_thresholds_count_all_labelled_rows(spark):
    """Every labelled row counts, however many there are: good ones that look odd hold the threshold back, wherever they lie."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(15_000, 8)), rng.normal(5, 0.3, (40, 8))])
    rows = [(i if i < 15_000 else i + 5000, False, v) for i, v in enumerate(x.tolist())]
    seen = spark.createDataFrame(rows, "doc_id long, base_failed boolean, features array<double>")
    labels = [(i, int(i < 20_000)) for i, _, _ in rows]
    model = rules.fit_measured(seen, spark.createDataFrame(labels, "doc_id long, quality int"), trees=20)
    kept = model.passes(model.scores(x))
    assert kept[:15_000].mean() >= 1 - 0.004 and kept[15_000:].mean() < 0.1
    by_query = {r.doc_id: r.kept for r in rules.judge_measured(seen, model).collect()}
    assert [by_query[r[0]] for r in rows] == kept.tolist()
    first = model.scores(x)[:, 0]
    assert model.thresholds[0] == pytest.approx(rules.calibrate(first, np.arange(len(x)) < 15_000, 0.003), abs=1 / rules.GRID)


def test_chunks_cover_the_text():
    for n in (0, 1, 31, 32, 33, 255, 256, 257, 480, 481, 100_000):
        text = bytes(i % 255 + 1 for i in range(n))
        chunks = bytecnn.chunks_of(text)
        seen = b"".join([bytes(c[: bytecnn.STRIDE]) for c in chunks[:-1]] + [bytes(c) for c in chunks[-1:]]).rstrip(b"\0")
        assert seen == text and (n == 0) == (len(chunks) == 0)


def test_network(spark):
    good = [(i, prose("en", 50), 1) for i in range(150)]
    bad = [(500 + i, prose("en", 50).replace(" ", "*** "), 0) for i in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    net = bytecnn.fit(docs, spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id long, quality int"))
    fresh = [(1, prose("en", 50)), (2, prose("en", 50).replace(" ", "*** ")), (3, None), (3, ""), (4, prose("en", 30_000))]
    got = [r.score for r in bytecnn.score(spark.createDataFrame(fresh, "doc_id long, text string"), net).collect()]
    assert got[0] > 0.7 > 0.3 > got[1] and got[2] == got[3] and got[4] > 0.5 and all(0 <= s <= 1 for s in got)
    one = net.score([t.encode() for _, t in fresh if t], net.tables(), block=3)
    assert one == pytest.approx([got[0], got[1], got[4]], abs=1e-5)  # however the chunks are gathered
    assert bytecnn.score(docs.limit(0), net).count() == 0


def test_network_reads_the_end_of_a_text():
    net = bytecnn.train([b"plain words here " * 40, b"#$#$#$#$" * 90] * 30, np.array([1.0, 0.0] * 30))
    head = b"plain words here " * 40
    a, b = net.score([head, head + b"#$#$#$#$" * 300], net.tables())
    assert b < a


def test_toxicity(spark):
    def text(n):
        words = prose("en", 60).split()
        for _ in range(n):
            words[RNG.randrange(len(words))] = RNG.choice(["vileone", "viletwo", "vilethree"])
        return " ".join(f"{w}{RNG.randrange(50)}" if not w.startswith("vile") else w for w in words)

    rows = [(i, text(0), 0) for i in range(300)] + [(1000 + i, text(1 + i % 9), 1) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, grade string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int"))
    assert (np.diff(model.cuts) > 0).all()
    fresh = [(1, text(0)), (2, text(1)), (3, text(30)), (4, None), (4, ""), (5, prose("en", 20_000) + " VILEONE, viletwo!")]
    got = toxicity.grade(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()
    assert [r.toxic for r in got] == [False, True, True, False, False, True]
    assert got[0].severity < got[1].severity < got[2].severity <= 3 and got[3].severity == got[4].severity
    p = model.chances(fresh[2][1])
    assert (np.diff(p) <= 0).all() and got[2].severity == pytest.approx(p.sum())
    nothing = toxicity.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert not toxicity.grade(docs.limit(3), nothing).where("toxic").count() and toxicity.grade(docs.limit(0), model).count() == 0


def test_toxic_words_that_clean_documents_never_have():
    rng = random.Random(5)

    def text(n, *more):
        return " ".join([f"{rng.choice(WORDS['en'].split())}{rng.randrange(40)}" for _ in range(n)] + list(more))

    for n, m in ((450, 3500), (1000, 3000)):  # as at sf0.1, and a full sample
        docs = [Counter(toxicity.words_of(text(8, *["vileone"] * (i % 2), *["vilerare"] * (i < 8)))) for i in range(n)] + [Counter(toxicity.words_of(text(8))) for _ in range(m)]
        found = toxicity._telling(docs, np.arange(n + m) < n, 5, 4.0, 1000)
        assert found[0] == b"vileone" and b"vilerare" in found and len(found) < 6
    # Twelve documents of a rare language: a fresh one with two of its words is toxic, one with none isn't.
    rare = ["malauno", "malados", "malatres"]
    texts = [text(30, *rng.sample(["vileone", "viletwo", "vilethree", "vilefour"], 1 + i % 3)) for i in range(200)] + [text(30, *rng.sample(rare, 2), *rare[:1]) for _ in range(12)] + [text(30) for _ in range(1500)]
    model = toxicity.train(texts, np.arange(len(texts)) < 212)
    assert model.chances(text(30, "malauno", "malados"))[0] > 0.5 and model.chances(text(30, "viletwo"))[0] > 0.5 and model.chances(text(30))[0] < 0.1


def test_training_text_comes_from_all_parts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic: seen.append(texts))
    monkeypatch.setattr(bytecnn, "train", lambda texts, good: seen.append([t.decode() for t in texts]))
    long = " ".join(f"w{i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, long), (2, "short é"), (3, None), (4, "x" * 12_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, 1) for i in range(1, 5)], "doc_id long, toxic int, quality int")
    toxicity.fit(docs, labels)
    bytecnn.fit(docs, labels)
    whole, parted = seen
    assert whole == [long, "short é", "", "x" * 12_000]  # op2 learns from whole texts
    assert parted[1:] == whole[1:] and 11_900 < len(parted[0]) <= 12_000
    parts = parted[0].split("\n")
    assert len(parts) == 8 and parts[0].startswith("w0 w1 ") and parts[-1].endswith(" w19999") and all(p in long for p in parts)


def test_network_agrees_with_plain_loops():
    rng = np.random.default_rng(2)
    k, size = 3, 4
    net = bytecnn.Network(rng.normal(0, 1, (256, size)), rng.normal(0, 1, (bytecnn.WIDTH, size, k)), rng.normal(0, 1, k), rng.normal(0, 1, 2 * k + 1))
    net.embedding[0] = 0

    def plain(text):
        mean, top, n = [0.0] * k, [0.0] * k, 0
        for start in range(0, max(len(text) - bytecnn.OVERLAP, 1), bytecnn.STRIDE) if text else []:
            chunk = text[start : start + bytecnn.CHUNK].ljust(bytecnn.CHUNK, b"\0")
            n += 1
            for f in range(k):
                best = max(
                    sum(net.embedding[chunk[at + j], e] * net.filters[j, e, f] for j in range(bytecnn.WIDTH) for e in range(size))
                    for at in range(0, bytecnn.CHUNK - bytecnn.WIDTH + 1, bytecnn.STEP)
                )
                best = max(0.0, best + net.bias[f])
                mean[f] += best
                top[f] = max(top[f], best)
        z = sum(m / max(1, n) * w for m, w in zip(mean, net.weights[:k], strict=True)) + sum(t * w for t, w in zip(top, net.weights[k : 2 * k], strict=True)) + net.weights[-1]
        return 1 / (1 + np.exp(-min(30, max(-30, z))))

    texts = [b"", b"short", bytes(rng.integers(1, 256, 256, dtype=np.uint8)), bytes(rng.integers(1, 256, 700, dtype=np.uint8))]
    assert net.score(texts, net.tables()) == pytest.approx([plain(t) for t in texts], abs=1e-4)


def test_forest_scores_agree_with_plain_paths():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (300, 3)), rng.normal(9, 1, (5, 3))])
    forest = rules.grow(x, trees=20, sample=64)

    def path(t, row):
        at = 0
        while forest.feature[t, at] >= 0:
            at = forest.child[t, at] + (row[forest.feature[t, at]] > forest.value[t, at])
        return forest.depth[t, at]

    got = forest.score(x)
    assert got == pytest.approx([2 ** -(np.mean([path(t, r) for t in range(20)]) / forest.norm) for r in x])
    assert got[300:].min() > np.quantile(got[:300], 0.9)
    assert rules.calibrate(np.array([0.1, 0.2, 0.3, 0.9]), np.array([True, True, True, False]), 0.0) == pytest.approx(0.3)
    assert rules.calibrate(got, np.ones(len(got), bool), 0.1) == 2.0


def test_language_agrees_with_plain_compression():
    import zstandard

    words = {lang: (" ".join(w.split() * 9)).encode() for lang, w in WORDS.items()}
    model = language.Dictionaries({lang: b" ".join([w] * 3) + b" " for lang, w in words.items()})
    params = zstandard.ZstdCompressionParameters.from_level(3, strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=17, hash_log=16, chain_log=16, search_log=5, write_content_size=0)

    def size(lang, data):
        d = zstandard.ZstdCompressionDict(model.content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        return len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(data))

    encoders = model.encoders()
    for text in [prose("en", 5), prose("de", 900), prose("xx", 90), "of", "The Of!"]:
        plain = language._plain(text)
        sizes = {}
        for lang in WORDS:
            sizes[lang] = sum(size(lang, language._FILL + plain[i : i + language.CHUNK]) - size(lang, language._FILL) for i in range(0, len(plain), language.CHUNK))
        first, second = sorted((n, lang) for lang, n in sizes.items())[:2]
        assert model.classify(encoders, text) == (first[1], min(1.0, max(0.0, 1 - first[0] / max(1, second[0]))))


def test_toxic_chances_agree_with_a_plain_sum():
    model = toxicity.Ordinal({b"vile": 0, b"vile-": 1, b"calm": 2, b"violet-": 3}, np.array([2.0, 0.5, -1.0, 4.0]), np.array([1.0, 2.5, 4.0]))
    for text in ["", "vile", "Vile vile vilest violets, calm calm", "violet violetta vilevile " * 30]:
        n = Counter(f for w in toxicity.words_of(text) for f in toxicity.features_of(w))
        z = sum(w * (1 + np.log(n[f])) for f, w in zip(model.index, model.weights, strict=True) if n[f])
        assert model.chances(text) == pytest.approx(1 / (1 + np.exp(-(z - model.cuts))))


def test_no_document_is_graded_by_words_that_it_taught():
    docs = [Counter({b"own%d" % i: 9}) for i in range(40)] + [Counter({b"plain": 1}) for _ in range(400)]
    toxic = np.arange(440) < 40
    fold = np.arange(440) % 2
    for d in docs[:40:2]:
        d[b"shared"] = 5
    grades = toxicity.severity_grades(docs, toxic, fold, 5, 3.0, 100)
    assert (grades[~toxic] == 0).all() and (grades[toxic] == 1).all()  # what one fold alone has marks nothing in that fold
