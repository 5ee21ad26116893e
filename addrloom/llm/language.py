"""Language identification by compression with per-language zstandard raw-content dictionaries.

A text is lower-cased, its runs of non-letters among ASCII become single spaces, and it is encoded whole, in
chunks, once with each language's dictionary. The language whose dictionary gives the fewest bytes wins; the
margin to the next one, as a share, is the score, and narrow margins are rejected. A dictionary holds text of
its language, an equal share of every sampled document, and, nearest to what is encoded (short offsets cost
fewest bits), the words that are commoner there than elsewhere. Every chunk is encoded after fixed random letters,
whose size is taken off again: without them zstandard stores short texts raw, whatever the dictionary.
"""

from __future__ import annotations

import random
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import remainder, small_batches, table, without
from .sampling import all_parts, hash_sample

_LETTERS = bytes.maketrans(bytes(range(128)), bytes(c if chr(c).isalpha() else 32 for c in range(128)))
_FILL = bytes(random.Random(1).choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(96))
CHUNK = 1024


def _plain(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text) if text.isascii() else (unicodedata.category(c)[0] == "L" for c in text))


@dataclass
class Dictionaries:
    """What is learned: one dictionary a language."""

    content: dict[str, bytes]

    def encoders(self) -> list[tuple[str, Callable[[bytes], bytes], int]]:
        """Of each language its name, the encoder, and what the filler alone takes."""
        params = zstandard.ZstdCompressionParameters.from_level(3, strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=17, hash_log=16, chain_log=16, search_log=5, write_content_size=0)
        found = []
        for lang in sorted(self.content):
            words = zstandard.ZstdCompressionDict(self.content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=params)
            compress = zstandard.ZstdCompressor(dict_data=words, compression_params=params).compress
            found.append((lang, compress, len(compress(_FILL))))
        return found

    @staticmethod
    def classify(encoders: list[tuple[str, Callable[[bytes], bytes], int]], text: str | None) -> tuple[str, float]:
        """The language and the margin as a share of the next one's size; ``und`` and 0 without a letter."""
        if not encoders or not has_letter(text):
            return "und", 0.0
        plain = _plain(text)
        chunks = [_FILL + plain[i : i + CHUNK] for i in range(0, len(plain), CHUNK)]
        sizes = sorted((sum(map(len, map(compress, chunks))) - base * len(chunks), lang) for lang, compress, base in encoders)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], min(1.0, max(0.0, 1 - sizes[0][0] / max(1, sizes[1][0])))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_each: int = 600, chars_each: int = 3000, dict_bytes: int = 49152) -> Dictionaries:
    """Learn a dictionary for every non-null language of ``labelled``.

    The sample is bounded: at most ``docs_each`` different texts a language, drawn by a hash of id and text,
    of each up to ``chars_each`` characters, from all parts of a longer text. Of these every document gives an equal
    share of the ``dict_bytes`` of running text, and words count that three documents hold and that are commoner here than
    in any other language, all of them. Rows with null or empty text teach nothing; ids may be null or repeat. No
    rows, no language.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), text.alias("text")).where("lang is not null and length(text) > 0")
    sample = hash_sample(rows, docs_each, ["id", "text"], by="lang")
    got = sample.select("lang", all_parts(F.col("text"), chars_each).alias("text")).distinct().collect()
    texts: dict[str, list[str]] = {}
    for row in sorted(got):
        texts.setdefault(row.lang, []).append(row.text)
    held = {lang: Counter(w for t in some for w in set(_plain(t).split())) for lang, some in texts.items()}
    content = {}
    for lang, some in texts.items():
        random.Random(0).shuffle(some)
        share = dict_bytes // len(some)
        lead = {}
        for w, n in held[lang].items():
            ahead = n / len(some) - max((held[o][w] / len(texts[o]) for o in texts if o != lang), default=0.0)
            if n >= 3 and ahead > 0:
                lead[w] = ahead
        content[lang] = b" ".join([*(_spread(_plain(t), share) for t in some), *sorted(lead, key=lambda w: (lead[w], w))]) + b" "
    return Dictionaries(content)


def _spread(text: bytes, size: int, parts: int = 4) -> bytes:
    """A text of up to ``size`` bytes as it is, of a longer one that many, in equal parts from its start to its end."""
    if len(text) <= size:
        return text
    each = max(1, size // parts)
    spare = len(text) - each
    return b" ".join(text[spare * i // (parts - 1) :][:each] for i in range(parts))


def identify(docs: DataFrame, model: Dictionaries, text_col: str = "text", margin: float = 0.01) -> DataFrame:
    """Every row with ``lang_pred``, ``score`` and ``lang_rejected`` added.

    Null texts and texts without a letter are ``und``, score 0, rejected; so is everything if the model has
    no language. With one language the score is 1. Ties go to the smaller language code and are rejected. Texts of any
    length are encoded whole; repeated rows stay, alike; no rows, no result. Input columns named like a result are
    replaced; all others pass through, whatever their names.
    """
    docs = without(docs, "lang_pred", "score", "lang_rejected")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = model.encoders()
        for batch in batches:
            found = [Dictionaries.classify(encoders, t) for t in batch.column(0).field(at).cast(pa.string()).to_pylist()]
            langs, scores = [x[0] for x in found], [x[1] for x in found]
            rejected = [lang == "und" or s < margin for lang, s in found]
            extra = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *extra], ["row", "lang_pred", "score", "lang_rejected"])

    # The row is one column, so that no name of the input can meet one of ours.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    results = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_rejected", T.BooleanType())]
    out = small_batches(rows).mapInArrow(run, T.StructType([*rows.schema.fields, *results]))
    return out.select("row.*", "lang_pred", "score", "lang_rejected")


def learned(docs: DataFrame) -> Dictionaries:
    """Fit on the rows of ``documents`` that are not held out."""
    return fit(docs.where(remainder("doc_id", 3) != 1))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all ``documents``, learned from the rows that aren't held out; null text and no letter: ``und``. See :func:`identify`."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learned(docs))
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "lang_rejected")
