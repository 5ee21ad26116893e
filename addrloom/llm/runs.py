"""Runs of words that repeat with a period, found on a harmonic grid with prefix hashes.

A run of period p that repeats ``times`` times holds a stretch of ``(times - 1) * p`` words that each equal the word p
further on, so one multiple of ``(times - 1) * p`` lies in that stretch. All pairs of a period and such a grid point, about
``n ln n / (times - 1)``, are NumPy arrays; where the two words are equal, how far they stay so on either side is found by a
binary search over prefix hashes, for all pairs at once. A hash can only claim too much, so the words of each run that is
left are compared once; should any differ, the text is done again with another base. Runs of the same stretch are one, of
the smallest period. Texts are dealt out by Spark as they are read: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table, without

_PRIME = (1 << 31) - 1
#: Pairs looked at together, unless one period alone has more.
PAIRS = 1 << 19


def codes_of(words: list[bytes]) -> np.ndarray:
    """A number for each word; equal words and they alone have equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter(map(known.setdefault, words, count(1)), np.int64, len(words))


class _Prefixes:
    """Hashes of the beginnings of a sequence, so that any two stretches can be held against each other."""

    def __init__(self, codes: np.ndarray, base: int):
        n = len(codes)
        self.power = np.ones(n + 1, np.int64)
        done = 1
        while done <= n:  # doubled until all powers are there
            step = self.power[done - 1] * base % _PRIME
            part = self.power[: min(done, n + 1 - done)]
            self.power[done : done + len(part)] = part * step % _PRIME
            done *= 2
        self.sum = np.zeros(n + 1, np.int64)
        np.cumsum(codes % _PRIME * self.power[:n] % _PRIME, out=self.sum[1:])
        self.sum %= _PRIME

    def equal(self, a: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        left = (self.sum[a + length] - self.sum[a]) % _PRIME * self.power[shift] % _PRIME
        return left == (self.sum[a + shift + length] - self.sum[a + shift]) % _PRIME

    def holds(self, a: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        """:meth:`equal`, and false where the stretch or the later one leaves the sequence."""
        inside = (a >= 0) & (a + shift + length < len(self.sum))
        out = np.zeros(len(a), bool)
        out[inside] = self.equal(a[inside], shift[inside], length[inside])
        return out

    def reach(self, at: np.ndarray, shift: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``at`` on (``back``: before it) equal those ``shift`` later, ``most`` at most."""
        found = np.zeros(len(at), np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            tried = found + step
            some = np.flatnonzero(tried <= most)
            length = tried[some]
            start = at[some] - length if back else at[some]
            good = some[self.equal(start, shift[some], length)]
            found[good] += step
            step >>= 1
        return found


def _grid(n: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(period, point)`` of all pairs, in blocks."""
    periods = np.arange(1, n // times + 1)
    counts = -(-(n - periods) // ((times - 1) * periods))
    ends = np.cumsum(counts)
    i = 0
    while i < len(periods):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - counts[i] + PAIRS, "right")))
        of, many = periods[i:j], counts[i:j]
        period = np.repeat(of, many)
        nth = np.arange(len(period)) - np.repeat(np.cumsum(many) - many, many)
        yield period, nth * period * (times - 1)
        i = j


def _claimed(codes: np.ndarray, least: int, times: int, base: int) -> np.ndarray:
    n, found = len(codes), []
    prefixes = _Prefixes(codes, base)
    for period, point in _grid(n, times):
        same = codes[point] == codes[point + period]
        period, point = period[same], point[same]
        # The stretch has (times - 1) * period equal words, so one half of them lies ahead of the point or behind it.
        half = (times - 1) * period // 2
        far = np.flatnonzero(prefixes.holds(point, period, (times - 1) * period - half) | prefixes.holds(point - half, period, half))
        if not len(far):
            continue
        period, point = period[far], point[far]
        ahead = prefixes.reach(point, period, n - period - point, back=False)
        behind = prefixes.reach(point, period, point, back=True)
        start, end = point - behind, point + period + ahead
        long = end - start >= np.maximum(least, times * period)
        found.append(np.unique(np.stack([start, end, period], 1)[long], axis=0))
    if not found:
        return np.zeros((0, 3), np.int64)
    all_runs = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    first = np.ones(len(all_runs), bool)
    first[1:] = (all_runs[1:, :2] != all_runs[:-1, :2]).any(1)
    return all_runs[first]


def runs_of(codes: np.ndarray, least: int = 6, times: int = 4, seed: int = 1) -> np.ndarray:
    """``(start, length, period)`` of every run, by start, then period.

    A run is a stretch of smallest period q, of at least ``max(least, times * q)`` words, that no neighbouring word extends.
    """
    if times < 2:
        raise ValueError("a run repeats twice at least")
    if len(codes) < max(least, times):
        return np.zeros((0, 3), np.int64)
    rng = random.Random(seed)
    while True:
        claimed = _claimed(codes, least, times, rng.randrange(1 << 20, _PRIME - 1))
        if all(np.array_equal(codes[s : e - p], codes[s + p : e]) for s, e, p in claimed.tolist()):
            break
    out = np.stack([claimed[:, 0], claimed[:, 1] - claimed[:, 0], claimed[:, 2]], 1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """Of ``n`` words, which lie in a run after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:n]) > 0


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    gone = repeats(len(words), runs).tolist()
    return b" ".join(w for w, g in zip(words, gone, strict=True) if not g)


_RUN = T.StructType([T.StructField(x, T.LongType(), False) for x in ("start", "length", "period")])
_RUNS = T.StructType([T.StructField("runs", T.ArrayType(_RUN, False), False), T.StructField("collapsed", T.BinaryType(), False)])


def _label(least: int, times: int):
    kind = pa.struct([pa.field("runs", pa.list_(pa.struct([pa.field(x, pa.int64()) for x in ("start", "length", "period")]))), pa.field("collapsed", pa.binary())])

    def label(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            words = (text.as_py() or b"").split()  # of bytes: exactly the six ASCII white-space characters
            runs = runs_of(codes_of(words), least, times)
            out.append({"runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()], "collapsed": _collapsed(words, runs)})
        return pa.array(out, kind)

    return F.arrow_udf(_RUNS)(label)


def find_runs(docs: DataFrame, text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``docs`` with ``runs``, an array of ``(start, length, period)`` in words, and ``collapsed``, the text without repeats.

    Words are runs of anything but ASCII white space. Every run keeps its first period; a word that any run repeats goes, and
    the words that stay are joined by one space. A null or empty text, or one without a run, has an empty array; null gives
    an empty ``collapsed``. Texts of any length are read whole: time grows as n log² n in the words, memory with n.
    Rows that repeat are each answered alike, ids aren't read. An input column called ``runs`` or ``collapsed`` is
    replaced, any other name may occur. No rows, no result. No shuffle, no job of its own.
    """
    docs = small_batches(without(docs, "runs", "collapsed"))
    found = docs.withColumn("runs", _label(least, times)(F.col(f"`{text_col}`").cast("string").cast("binary")))
    return found.withColumns({"runs": F.col("runs.runs"), "collapsed": F.col("runs.collapsed").cast("string")})


def made_periodic(codes: np.ndarray, h: int) -> np.ndarray:
    """Which word stands at each place, once those from a place on repeat with a period, place and period taken from ``h``."""
    n = len(codes)
    at = np.arange(n)
    if h % 10 or not n:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, h in zip(batch.column("text"), batch.column("h").to_pylist(), strict=True):
            words = (text.as_py() or b"").split()
            codes = codes_of(words)
            if h % 10 == 0 and words:
                at = made_periodic(codes, h)
                words, codes = [words[i] for i in at.tolist()], codes[at]
            runs = runs_of(codes)
            rows = runs.tolist()
            start, length, period = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
            said = "".join(f"{s},{n},{p}\n" for s, n, p in rows).encode()
            out.append((len(rows), start, length, period, 1000 * length // period if rows else None, hashlib.sha256(said).hexdigest(), hashlib.sha256(_collapsed(words, runs)).hexdigest()))
        columns = list(zip(*out, strict=True)) or [()] * 7
        arrays = [pa.array(c, pa.int64() if i < 5 else pa.string()) for i, c in enumerate(columns)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all ``documents``, as digests; one text of ten is made periodic first, by the crc32 of its id.

    A null text has no word, a null id counts as empty. See :func:`find_runs`.
    """
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = small_batches(docs.select("doc_id", h.alias("h"), F.col("text").cast("string").cast("binary").alias("text")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_digests, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
