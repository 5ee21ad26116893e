"""Toxicity by cumulative-link ordinal regression over sparse word features.

One weight vector is shared by all severity thresholds, which are ordered by construction: the chance that
the grade exceeds k is the logistic of ``w . x - t_k`` with ``t_0 < t_1 < ...``. The expected severity is the
sum of these chances. Features are words and the beginnings of words, so that a rare form leans on its stem.

Labels say toxic or not; how severe is graded here: a toxic document's grade follows how many telltale features it
holds, chosen from other documents than itself (two folds, each graded by the other's).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table
from .sampling import labelled_sample

_WORDS = bytes.maketrans(bytes(range(128)), bytes(c if chr(c).isalnum() else 32 for c in range(128)))
GRADES = 4


#: Beginnings of words that are features, in bytes.
STEMS = (4, 5, 6, 7)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_WORDS).split()


def features_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings where it goes on."""
    return [word, *(word[:k] + b"-" for k in STEMS if len(word) > k)]


def counts_of(text: str, known: dict[bytes, list[bytes]] | None = None) -> Counter:
    """How often a text has each feature. ``known`` keeps the features of some words, so that texts share them."""
    known = {} if known is None else known
    if len(known) > 50_000:
        known.clear()
    out: Counter = Counter()
    for word, n in Counter(words_of(text)).items():
        if word not in known:
            known[word] = features_of(word)
        for f in known[word]:
            out[f] += n
    return out


@dataclass
class Ordinal:
    """``index``: a feature's position; ``weights``: one for each; ``cuts``: the ordered thresholds."""

    index: dict[bytes, int]
    weights: np.ndarray
    cuts: np.ndarray

    def __post_init__(self) -> None:
        self.seen: dict[bytes, tuple[int, ...]] = {}

    def _hits(self, word: bytes) -> tuple[int, ...]:
        got = self.seen.get(word)
        if got is None:
            if len(self.seen) >= 50_000:
                self.seen.clear()
            got = self.seen[word] = tuple(self.index[f] for f in features_of(word) if f in self.index)
        return got

    def chances(self, text: str) -> np.ndarray:
        """P(grade > k) for each threshold, from the whole text."""
        hits: Counter = Counter()
        for word, n in Counter(words_of(text)).items():
            for i in self._hits(word):
                hits[i] += n
        z = sum(self.weights[i] * (1 + np.log(n)) for i, n in hits.items())
        return 1 / (1 + np.exp(-np.clip(z - self.cuts, -30, 30)))


def _telling(docs: list[Counter], toxic: np.ndarray, least: int, z: float, most: int) -> list[bytes]:
    """The features whose share of the documents differs between the classes beyond chance, the clearest first.

    The measure is the signed root of the log-likelihood ratio of the two shares. It needs no smoothing, so a word that
    one class never has is judged like any other, and the documents that it takes don't grow with the sample.
    """
    inside, outside = Counter(), Counter()
    for words, t in zip(docs, toxic, strict=True):
        (inside if t else outside).update(words.keys())
    n, m = max(1, toxic.sum()), max(1, (~toxic).sum())
    found = sorted(w for w in set(inside) | set(outside) if inside[w] + outside[w] >= least)
    a, b = np.array([inside[w] for w in found], float), np.array([outside[w] for w in found], float)
    both = (a + b) / (n + m)

    def gain(k: np.ndarray, of: int) -> np.ndarray:
        """Twice the log likelihood of k documents of so many at their own share, less that at the share of both classes."""
        return 2 * sum(x * np.log(np.where(x > 0, x / np.maximum(of * s, 1e-12), 1.0)) for x, s in ((k, both), (of - k, 1 - both)))

    clear = np.sign(a / n - b / m) * np.sqrt(np.maximum(gain(a, n) + gain(b, m), 0))
    order = sorted(np.flatnonzero(np.abs(clear) > z).tolist(), key=lambda i: (-abs(clear[i]), found[i]))
    return [found[i] for i in order[:most]]


def without_near_copies(texts: list[str]) -> list[int]:
    """Positions of texts that share none of four minima over hashed word five-grams with an earlier one.

    Copies of one toxic document would else make all its words look like marks of toxicity.
    """
    seen, kept = set(), []
    mix = np.random.default_rng(9).integers(1, 1 << 62, 4, dtype=np.int64).astype(np.uint64) | np.uint64(1)
    for i, text in enumerate(texts):
        words = words_of(text)
        grams = np.array([crc32(b" ".join(words[j : j + 5])) for j in range(max(1, len(words) - 4))], np.uint64)
        least = {(k, int((grams * m).min())) for k, m in enumerate(mix)}
        if not least & seen:
            kept.append(i)
        seen |= least
    return kept


def _marks(docs: list[Counter], toxic: np.ndarray, found: list[bytes]) -> set[bytes]:
    """Those of the features that are found in toxic documents four times out of five or more."""
    inside, every = Counter(), Counter()
    for d, t in zip(docs, toxic, strict=True):
        every.update(d.keys())
        if t:
            inside.update(d.keys())
    return {w for w in found if inside[w] * 5 > every[w] * 4}


def severity_grades(docs: list[Counter], toxic: np.ndarray, fold: np.ndarray, least: int, z: float, most: int) -> np.ndarray:
    """0 for documents that aren't toxic; the toxic ones of each fold get 1 up to ``GRADES - 1`` in equal parts by
    how many of their features the other fold's documents mark as toxic."""
    grade = np.zeros(len(docs), int)
    for here in (fold == 0, fold == 1):
        others = [docs[i] for i in np.flatnonzero(~here)]
        marks = _marks(others, toxic[~here], _telling(others, toxic[~here], least, z, most))
        mine = np.flatnonzero(here & toxic)
        held = np.array([sum(n for w, n in docs[i].items() if w in marks) for i in mine])
        if len(mine):
            edges = np.quantile(held, np.arange(1, GRADES - 1) / (GRADES - 1))
            grade[mine] = 1 + (held[:, None] > edges).sum(1)
    return grade


def train(texts: list[str], toxic: np.ndarray, least: int = 5, z: float = 4.0, most: int = 2000, steps: int = 700, decay: float = 3e-4) -> Ordinal:
    """Fit by full-batch Adam on the likelihood of the grades. Without toxic examples every chance is small.

    ``most`` bounds the model, ``least`` and ``z`` (standard deviations from chance) say which features count.
    """
    single = without_near_copies(texts)
    texts, toxic = [texts[i] for i in single], toxic[single]
    known: dict[bytes, list[bytes]] = {}
    # Features of fewer documents than count are never chosen, and they are most of all: they are not kept.
    held: Counter = Counter()
    for t in texts:
        held.update(counts_of(t, known).keys())
    docs = [Counter({f: n for f, n in counts_of(t, known).items() if held[f] >= least}) for t in texts]
    del held
    found = _telling(docs, toxic, least, z, most)
    index = {w: i for i, w in enumerate(found)}
    marks = _marks(docs, toxic, found)
    grade = severity_grades(docs, toxic, np.array([crc32(t.encode("utf-8", "replace")) % 2 for t in texts], int), least, z, most)
    x = np.zeros((len(docs), len(found)), np.float32)
    for i, d in enumerate(docs):
        for w, n in d.items():
            if w in index:
                x[i, index[w]] = 1 + np.log(n)
    # Marks share a weight that isn't decayed, in a column of its own: a rare mark leans on the others, not on zero.
    mark = np.array([w in marks for w in found], bool)
    x = np.concatenate([x, x[:, mark].sum(1, keepdims=True)], 1)
    decays = np.array([decay] * len(found) + [0.0])
    w = np.zeros(len(found) + 1)
    gaps = np.array([2.0] + [0.0] * (GRADES - 2))  # the first cut, then logs of what the next ones add
    m, v = np.zeros(len(w) + len(gaps)), np.zeros(len(w) + len(gaps))
    for step in range(1, steps + 1 if len(docs) else 1):
        cuts = gaps[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps[1:]))])
        p = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - cuts, -30, 30)))
        # P(grade = k) is the difference of neighbouring chances; so is the gradient of its logarithm.
        full = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], 1)
        rows = np.arange(len(p))
        high, low = full[rows, grade], full[rows, grade + 1]
        chance = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / chance, -low * (1 - low) / chance
        dz = np.zeros_like(p)
        has = grade > 0
        dz[rows[has], grade[has] - 1] += d_high[has]
        has = grade < GRADES - 1
        dz[rows[has], grade[has]] += d_low[has]
        dz /= -len(p)
        g_cuts = -dz.sum(0)
        g = np.concatenate([x.T @ dz.sum(1) + decays * w, [g_cuts.sum()], np.exp(gaps[1:]) * np.cumsum(g_cuts[::-1])[::-1][1:]])
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w -= move[: len(w)]
        gaps -= move[len(w) :]
    return Ordinal(index, w[:-1] + mark * w[-1], gaps[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps[1:]))]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", toxic_rows: int = 1500, other_rows: int = 4500) -> Ordinal:
    """Train on a bounded sample of labelled rows, at most these many toxic and other ones, of which whole texts are read.

    See :func:`labelled_sample`. Null text is empty. No labels or no documents: a model by which nothing is toxic.
    """
    found = labelled_sample(docs, labels, {1: toxic_rows, 0: other_rows}, id_col, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), toxic_col)
    got = sorted(found.select("id", "text", "label").collect(), key=lambda r: (r[0], r[1]))
    return train([r[1] for r in got], np.array([r[2] == 1 for r in got], bool))


def grade(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, severity, toxic_score, grade, toxic)`` of every row, from its whole text.

    severity: the expected grade, from 0 to 3; toxic_score: the chance of any grade over 0; grade: how many
    thresholds are exceeded with a chance over one half; toxic: grade over 0. Null text is empty; an empty
    text has the chances of a text without telling features. Texts of any length are read whole. Repeated rows stay and
    ties are graded alike; other columns are not read, and an id column named like a result is called ``id``. No
    rows, no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array([model.chances(t or "") for t in batch.column(1).to_pylist()], float).reshape(-1, len(model.cuts))
            grades = (p > 0.5).sum(1)
            cols = [pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(grades.astype(np.int32)), pa.array(grades > 0)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["id", "severity", "toxic_score", "grade", "toxic"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = small_batches(rows).mapInArrow(run, f"id {kind}, severity double, toxic_score double, grade int, toxic boolean")
    return out if id_col in out.columns else out.withColumnRenamed("id", id_col)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of all ``documents``, learned from ``labels``; null text is empty. See :func:`grade`."""
    docs = table(spark, sf_dir, "documents")
    return grade(docs, fit(docs, table(spark, sf_dir, "labels")))
