"""Packing, WARC archives in ZIP files, and the pipeline."""

import array
import io
import random
import zipfile
import zlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from addrloom.llm import packing, warc
from addrloom.llm.exact_dedup import drop_copies
from addrloom.llm.language import Dictionaries, learned

TOKENIZER = packing.public_tokenizer()


def test_ids_are_the_tokenizer_s():
    words, fresh = packing.Words(TOKENIZER, most=2000), Tokenizer.from_file(TOKENIZER)
    texts = ["", " ", "Hello, World... don't 'S x²½ ①", "naïve CAFÉ́ é ÉÉ.", "ΟΔΟΣ Σ", "a\x1cb\x1f c", "İstanbul ﬁ ß", "日本語 テスト。", "%%%. a_b-c/d 3.14 <|endoftext|>", "z" * 5000, " x y\x85"]
    for t in texts * 2:
        assert words.ids(t) == array.array("I", fresh.encode(t, add_special_tokens=False).ids).tobytes(), t
    assert words.held <= 1000 and len(words.older) + len(words) < 10
    words.forget()
    assert not words and not words.older


@pytest.mark.parametrize("seed", range(6))
def test_packing_lengths(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(30, 60)]) for _ in range(300)]
    bins = packing.pack_lengths(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= len(packing.best_fit(sizes, 100)) and len(bins) <= -(-sum(sizes) // 100) * 1.2


def test_local_search_empties_a_bin():
    sizes = [6, 4, 5, 5, 3, 3, 4]  # 30 of 3 * 10
    start = [[0, 4], [1, 2], [3, 5], [6]]
    assert len(packing.local_search(start, sizes, 10)) == 3
    assert packing.local_search([], [], 10) == [] and packing.best_fit([]) == []


def test_local_search_ends_only_when_no_pair_improves():
    rng = random.Random(1)
    sizes = [rng.randint(1300, 1500) for _ in range(900)]  # best fit leaves slack in nearly every bin
    first = packing.best_fit(sizes)
    bins = packing.local_search([list(b) for b in first], sizes)
    assert sorted(i for b in bins for i in b) == list(range(900)) and len(bins) < len(first) - 5
    open_ = [x for b in bins if (x := packing._Bin(b, sizes)).fill < packing.CAPACITY]
    assert all(x.fill <= packing.CAPACITY for x in open_) and len(bins) > -(-sum(sizes) // packing.CAPACITY)
    assert not any(packing._improve(a, b, packing.CAPACITY) for a in open_ for b in open_ if a is not b and a.fill >= b.fill)


def test_packed_documents(spark):
    rows = [(1, "one two three"), (2, None), (2, None), (None, "x"), (3, "word " * 9000), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack(docs, TOKENIZER, bins_each=1).collect()
    words = packing.Words(TOKENIZER)
    want = sorted((str(i), words.ids(t or "") + array.array("I", [1]).tobytes()) for i, t in rows)
    whole = {}
    for r in sorted(got, key=lambda r: r.piece):
        assert r.start == r.piece * packing.CAPACITY and r.length == len(r.ids) // 4
        whole.setdefault(r.doc_id, {}).setdefault(r.piece, []).append(bytes(r.ids))
    assert b"".join(p[0] for p in whole[3].values()) == dict(want)["3"] and len(whole[3]) == 3
    assert whole[2] == {0: [b"\x01\0\0\0"] * 2} and len(got) == 8
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    digest = {(r.doc_id, r.piece): r.ids_crc32 for r in packing.packed_digest(docs).collect()}
    assert digest[(1, 0)] == zlib.crc32(dict(want)["1"])
    assert packing.packed_digest(docs.limit(0)).count() == 0


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getbuffer())

    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


def zipped(members, comment=b"", **kw):
    out = Bytes()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = comment
        for name, content in members.items():
            z.writestr(name, content, **kw)
    return out


def test_zip_directories(monkeypatch):
    members = {f"m{i}": bytes([i]) * (i * 100) for i in range(9)}
    plain = warc.ZipReader(zipped(members, comment=b"about PK\x05\x06 and more than that, twenty-two bytes"))
    assert {n: plain.read(n) for n in plain.members} == members and plain.read("m3", 10, 5) == b"\3" * 5
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    large = zipped(members)
    assert b"PK\x06\x06" in large.getvalue() and b"PK\x06\x07" in large.getvalue()
    assert {n: m for n in members if (m := warc.ZipReader(large).read(n)) is not None} == members
    with pytest.raises(ValueError):
        warc.ZipReader(Bytes(b"no archive"))
    with pytest.raises(ValueError):
        plain.read("m3", 299, 5)
    with pytest.raises(ValueError):
        warc.ZipReader(zipped({"a": b"x" * 99}, compress_type=zipfile.ZIP_DEFLATED)).read("a")


def test_archives(spark, tmp_path):
    rows = [(3, "http://a/1", "same"), (1, "http://a/2?q=ü x", "same"), (2, None, None), (5, "u", ""), (6, "u", "<p>é\r\n\r\nWARC/1.1</p>" * 3000), (7, "u", "one"), (7, "u", "one"), (None, "n", "same")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, payload int")
    made = warc.write_archives(pages, str(tmp_path / "w"), most_bytes=300)
    got = warc.read_archives(made).collect()
    assert made.count() > 1 and sum(r.records for r in made.collect()) == len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].record_type == "response" and (by[3].record_type, by[3].refers_to, by[None].refers_to) == ("revisit", 1, 1)
    assert by[2].record_type == "response" and by[5].refers_to == 2 and by[7].record_type == "response"
    for i, url, html in rows:
        payload = (html or "").encode()
        assert (by[i].payload_bytes, by[i].payload_digest, by[i].url) == (len(payload), warc.digest(payload), url)
        assert by[i].payload is None if by[i].record_type == "revisit" else bytes(by[i].payload) == payload
    longer = warc.with_record_types(spark.createDataFrame([(1, b"ab"), (2, b"ab"), (3, b"abcd"), (4, b"abcd")], "page_id long, payload binary"), least_bytes=3)
    assert {r.page_id: r.refers_to for r in longer.collect()} == {1: None, 2: None, 3: None, 4: 3}
    assert warc.read_archives(warc.write_archives(pages.limit(0), str(tmp_path / "e"))).count() == 0


def test_pipeline_agrees_with_a_plain_version(spark, tmp_path):
    from test_native import plain_mix
    from test_near import components, plain_fingerprint

    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150)
    extra = spark.createDataFrame([(10_001, None, "en", None, 0), (10_002, "123", "en", "src1", 3)], source.schema)
    source.unionByName(extra).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(corpus_pipeline.STAGES) == 5

    encoders = learned(docs).encoders()
    rows = [r for r in docs.collect() if (x := Dictionaries.classify(encoders, r.text))[0] != "und" and x[1] >= 0.01]
    last = {}
    for r in rows:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        last[key] = max(last.get(key, -1), r.doc_id)
    rows = [r for r in rows if r.doc_id in set(last.values())]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    keep = {min(i for i, p in prints.items() if p in group) for group in components(sorted(set(prints.values())))}
    taken, _, _ = plain_mix([(r.doc_id, r.text, r.source) for r in rows if r.doc_id in keep])
    words = packing.Words(TOKENIZER)
    want = {}
    for r in rows:
        if taken.get(r.doc_id):
            n = len(words.ids(r.text)) // 4 + 1
            for k in range(-(-n // 4096)):
                want[(r.doc_id, k, min(4096, n - k * 4096))] = taken[r.doc_id] // len(r.text.split())
    found = {}
    for r in got:
        found[(r.doc_id, r.piece, r.length)] = found.get((r.doc_id, r.piece, r.length), 0) + 1
    assert found == want
    assert drop_copies(docs).columns == docs.columns


def test_words_of_a_large_vocabulary_are_worked_out_once():
    """60,000 different words fit into what is kept, so a second reading works out none again."""
    from addrloom.llm import packing

    words, asked = packing.Words(packing.public_tokenizer()), []
    merges = words.merges
    words.merges = lambda spelt: asked.append(spelt) or merges(spelt)
    letters = "abcdefghijklmnop"
    text = " ".join("x" + "".join(letters[i >> 4 * j & 15] for j in range(4)) for i in range(60_000))
    first = words.ids(text)
    n = len(asked)
    assert words.ids(text) == first and len(asked) == n == 60_000


def test_different_words_of_many_texts_are_worked_out_once():
    """However little is kept, words that texts of one chunk share are asked for once, marks after them or not; odd texts and words among them."""
    fresh, words, asked = Tokenizer.from_file(TOKENIZER), packing.Words(TOKENIZER, most=2000), []
    merges = words.merges
    words.merges = lambda spelt: asked.append(spelt) or merges(spelt)
    letters = "abcdefghijklmnop"
    many = ["x" + "".join(letters[i >> 4 * j & 15] for j in range(3)) for i in range(3000)]
    texts = [" ".join(many), "", " \n", " ".join(f"{w}.," for w in reversed(many)), "a\x1cb\x1f c", "%%%. a_b-c/d 3.14 <|endoftext|>", "ΟΔΟΣ Σ\x85é 日本語 テスト。", " ".join(many)]
    assert words.ids_of(texts) == [array.array("I", fresh.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert sum(a in many for a in asked) == len(many)
    assert words.ids_of([]) == [] and words.ids_of(["", " "]) == [b"", b""]


def test_chunks_hold_every_row_in_order():
    import pyarrow as pa

    rows = [(i, None if i % 7 == 0 else "ab" * (i % 50)) for i in range(1500)]
    batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows[a:b]], pa.int64()), pa.array([t for _, t in rows[a:b]], pa.string())], ["id", "text"]) for a, b in ((0, 1000), (1000, 1000), (1000, 1500))]
    for most in (1, 100, 5000, 1 << 30):
        got = list(packing._chunks(iter(batches), most))
        assert [x for key, texts in got for x in zip(key.to_pylist(), texts, strict=True)] == [(i, t or "") for i, t in rows]
        assert all(sum(map(len, texts[:-1])) < most for _, texts in got)
    assert not list(packing._chunks(iter([]), 100))
