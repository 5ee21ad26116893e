"""Quality rules: an isolation forest over rule statistics.

Random splits isolate unusual documents in few steps; the path lengths over all trees give an anomaly score.
There are two forests, of a text's form (how words, capitals and marks are made) and of its bulk and repetition (how
many words, which share of lines and words is repeated): in one forest, long and repetitive good documents hide
what is odd about form. Trees grow on small random sub-samples of all rows, whatever their labels, which is the method. Each
forest's threshold is calibrated on all labelled rows, the second one's on what the first lets pass; a document goes that is over either.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrloom.shared import write_table

from .common import small_batches, table
from .sampling import hash_sample

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: How many of the features, which come in this order, each forest sees.
FOREST_FEATURES = (5, 3)
_MIX = np.random.default_rng(5).integers(1, 1 << 62, WINDOW, dtype=np.int64).view(np.uint64) | np.uint64(1)
_UPPER = bytes(range(65, 91))


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of eight words that the text holds twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        windows += each[j : j + n] * _MIX[j]
    order = np.sort(windows)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(windows, twice)).tolist()
    seen = Counter(tuple(words[i : i + WINDOW]) for i in at)  # the words themselves decide
    covered = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if seen[tuple(words[i : i + WINDOW])] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1 if i + WINDOW <= len(words) else 0
    return int((np.cumsum(covered[:-1]) > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """``[n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words]`` and what the forest sees."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = sum(map(joined.count, (bytes([c]) for c in SYMBOLS)))
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    dup = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    d, size = max(1, n), max(1, len(joined))
    upper = len(joined) - len(joined.translate(None, _UPPER))
    seen = [
        chars / d,
        min(3.0, symbols / d),
        upper / size,
        min(3.0, (joined.count(b"!") + joined.count(b"?")) / d),
        # distinct words against what a text of this length has at most
        np.log1p(len(set(words))) / np.log1p(d),
        np.log1p(n),
        dup / max(1, len(lines)),
        repeats / d,
    ]
    return [n, chars, symbols, dup, repeats], seen


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 20 or 100 * n_repeat_words > 30 * n_words


@dataclass
class Forest:
    """Trees as arrays: the split's feature (-1: a leaf), its value, the left child (the right one is next), the leaf's depth."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores from 0 to 1: 2 to the minus mean path length over the usual one."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(64):
            f = self.feature[trees, at]
            inner = f >= 0
            if not inner.any():
                break
            right = x[rows, np.maximum(f, 0)] > self.value[trees, at]
            at = np.where(inner, self.child[trees, at] + right, at)
        return np.exp2(-self.depth[trees, at].mean(1) / self.norm)


def _usual(n: int) -> float:
    """The mean path length of a search in a random binary tree over n values."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(rows: np.ndarray, trees: int = 100, sample: int = 128, seed: int = 3) -> Forest:
    """An isolation forest over random sub-samples of ``rows``. They are small, so that no kind of junk is dense in one."""
    rng = np.random.default_rng(seed)
    many = min(len(rows), sample)
    limit = int(np.ceil(np.log2(max(2, sample)))) + 2
    size = 2 ** (limit + 1) + 1
    feature = np.full((trees, size), -1)
    value, child, depth = np.zeros((trees, size)), np.zeros((trees, size), np.int64), np.zeros((trees, size))
    for t in range(trees):
        todo, used = [(0, rows[rng.choice(len(rows), many, replace=False)], 0)] if many else [], 1
        while todo:
            node, some, d = todo.pop()
            low, high = some.min(0), some.max(0)
            spread = np.flatnonzero(high > low)
            if d >= limit or len(some) < 2 or not len(spread):
                depth[t, node] = d + _usual(len(some))
                continue
            f = int(rng.choice(spread))
            v = rng.uniform(low[f], high[f])
            feature[t, node], value[t, node], child[t, node] = f, v, used
            right = some[:, f] > v
            if right.all() or not right.any():  # rounding
                right = some[:, f] > low[f]
                value[t, node] = low[f]
            todo += [(used, some[~right], d + 1), (used + 1, some[right], d + 1)]
            used += 2
    return Forest(feature, value, child, depth, max(1e-9, _usual(many)))


def calibrate(scores: np.ndarray, good: np.ndarray, lose: float) -> float:
    """The threshold above which a document goes: it finds as many bad ones as it can and at most ``lose`` of the good.

    2, over which nothing is, where no threshold finds a larger share of the bad than it loses of the good.
    """
    values, at = np.unique(scores, return_inverse=True)
    return _threshold(values, *[np.bincount(at[kind], minlength=len(values)) for kind in (good, ~good)], lose)


def _threshold(values: np.ndarray, fine: np.ndarray, poor: np.ndarray, lose: float) -> float:
    """:func:`calibrate` over rising values, given how many good and bad documents have each."""
    if not fine.sum() or not poor.sum():
        return 2.0
    lost, found = (1 - np.cumsum(n) / n.sum() for n in (fine, poor))
    gain = np.where(lost <= lose + 1e-12, found - lost, 0.0)
    best = int(gain.argmax())
    return float(values[best]) if gain[best] > 0 else 2.0


@dataclass
class Judge:
    """Forests with their thresholds."""

    forests: list[Forest]
    thresholds: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """``(row, forest)``: anomaly scores."""
        ends = np.cumsum(FOREST_FEATURES)
        return np.stack([f.score(x[:, e - k : e]) for f, e, k in zip(self.forests, ends, FOREST_FEATURES, strict=True)], 1)

    def passes(self, scores: np.ndarray) -> np.ndarray:
        return (scores <= np.array(self.thresholds)).all(1)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", judge: Judge | None = None) -> DataFrame:
    """The statistics of every row's whole text (null: no words), and with a judge its verdict.

    ``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, features)``, with a judge, instead
    of the features, ``anomaly`` (the larger of both forests' scores) and ``kept``. Null and empty texts have no words and fail
    the base rules; texts of any length are read whole; rows that repeat stay apart and ties are judged alike. Other
    columns are not read; an id column named like a result is called ``id``. No rows, no result.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            counts = np.array([g[0] for g in got], np.int64).reshape(-1, 5)
            x = np.array([g[1] for g in got], float).reshape(-1, sum(FOREST_FEATURES))
            failed = np.array([base_failed(c[0], c[4]) for c in counts], bool)
            cols = [batch.column(0), *[pa.array(counts[:, i]) for i in range(5)], pa.array(failed, pa.bool_())]
            if judge is None:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(x.tolist(), pa.list_(pa.float64()))], ["id", *names, "base_failed", "features"])
            else:
                scores = judge.scores(x)
                kept = ~failed & judge.passes(scores)
                yield pa.RecordBatch.from_arrays([*cols, pa.array(scores.max(1)), pa.array(kept, pa.bool_())], ["id", *names, "base_failed", "anomaly", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    more = "features array<double>" if judge is None else "anomaly double, kept boolean"
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = small_batches(rows).mapInArrow(run, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, {more}")
    return out if id_col in out.columns else out.withColumnRenamed("id", id_col)


def _scored(seen: DataFrame, model: Judge) -> DataFrame:
    """:func:`measure`'s rows with ``scores``, one of each forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), float).reshape(-1, sum(FOREST_FEATURES))
            yield batch.append_column("scores", pa.array(model.scores(x).tolist(), pa.list_(pa.float64())))

    return small_batches(seen).mapInArrow(run, T.StructType([*seen.schema.fields, T.StructField("scores", T.ArrayType(T.DoubleType()))]))


#: Thresholds lie on a grid of so many steps from 0 to 1. It is a power of two, so that scores are placed exactly.
GRID = 1 << 16


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", lose: float = 0.004) -> Judge:
    """Grow the forests on rows of ``docs`` as they come, and set their thresholds from all labelled rows (quality 1: good). See :func:`fit_measured`."""
    return fit_measured(write_table(measure(docs, id_col, text_col), "rule-statistics"), labels, id_col, quality_col, lose)


def fit_measured(seen: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", lose: float = 0.004, trees: int = 100, sample: int = 128) -> Judge:
    """:func:`fit` over what :func:`measure` makes of all documents, a written table, for it is read three times.

    A tree sees ``sample`` rows of all, as many as trees take are drawn by a hash of id and statistics. Thresholds count every labelled row: scores
    are written, and the rows of each step of ``GRID`` counted in Spark, so that only these counts come here. Rows that fail the base rules are
    left out. Rows that agree in id and statistics count once, null ids have no label but may be drawn for the forests, an id labelled twice
    has its larger label. Without labels of both kinds, or without documents, nothing is anomalous.
    """
    fine = seen.where("not base_failed").select(F.col(f"`{id_col if id_col in seen.columns else 'id'}`").alias("_id"), "features")
    drawn = hash_sample(fine, trees * sample, ["_id", "features"], seed=23).select("features").collect()
    rows = np.array(sorted(r[0] for r in drawn), float).reshape(-1, sum(FOREST_FEATURES))
    ends = np.cumsum(FOREST_FEATURES)
    model = Judge([grow(rows[:, e - k : e], trees, sample, 3 + i) for i, (e, k) in enumerate(zip(ends, FOREST_FEATURES, strict=True))], [2.0] * len(ends))
    told = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{quality_col}`").alias("label")).where("label in (0, 1) and _id is not null").groupBy("_id").agg(F.max("label").alias("label"))
    left = write_table(_scored(fine.join(told, "_id").dropDuplicates(["_id", "features"]), model).select("scores", "label"), "rule-scores")
    for i, share in enumerate((0.75, 0.25)):
        step = F.ceil(F.col("scores")[i] * GRID).alias("step")
        counts = np.array([tuple(r) for r in left.groupBy(step).agg(F.sum("label"), F.sum(1 - F.col("label"))).collect()], np.int64).reshape(-1, 3)
        counts = counts[counts[:, 0].argsort()]
        model.thresholds[i] = _threshold(counts[:, 0] / GRID, counts[:, 1], counts[:, 2], lose * share)
        left = left.where(F.col("scores")[i] <= F.lit(model.thresholds[i]))
    return model


def judge(docs: DataFrame, model: Judge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`measure` with the verdict of ``model``."""
    return measure(docs, id_col, text_col, model)


def judge_measured(seen: DataFrame, model: Judge) -> DataFrame:
    """:func:`judge` over what :func:`measure` has made of the texts, which are not read again."""
    passes = F.lit(True)
    for i, t in enumerate(model.thresholds):
        passes &= F.col("scores")[i] <= F.lit(t)
    out = _scored(seen, model).withColumn("anomaly", F.array_max("scores")).withColumn("kept", ~F.col("base_failed") & passes)
    return out.drop("features", "scores")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of all ``documents``; null text has no words and fails. Texts are read once. See :func:`measure`."""
    seen = write_table(measure(table(spark, sf_dir, "documents")), "rule-statistics")
    return judge_measured(seen, fit_measured(seen, table(spark, sf_dir, "labels")))
