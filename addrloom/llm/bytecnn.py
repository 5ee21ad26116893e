"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over overlapping chunks that cover the whole document, each chunk
keeps every filter's largest response, and the chunks' mean and maximum are combined into one probability.
Embedding and filters are multiplied out once, so that scoring adds up rows of one table for each offset.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remainder, small_batches, table
from .sampling import all_parts, labelled_sample

CHUNK, OVERLAP, WIDTH, STEP = 256, 32, 8, 2
STRIDE = CHUNK - OVERLAP


def chunks_of(text: bytes) -> np.ndarray:
    """The overlapping chunks of a text as rows of bytes, the last one padded with zero bytes; none if it is empty."""
    n = -(-max(len(text) - OVERLAP, 1) // STRIDE) if text else 0
    padded = np.zeros(max(0, (n - 1) * STRIDE + CHUNK) if n else 0, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STRIDE] if n else np.zeros((0, CHUNK), np.uint8)


def respond(tables: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Filter responses ``(chunk, position, filter)``; tables: ``(offset, byte, filter)``."""
    at = np.arange(0, CHUNK - WIDTH + 1, STEP)
    out = tables[0][chunks[:, at]]
    for j in range(1, WIDTH):
        out += tables[j][chunks[:, at + j]]
    return out


@dataclass
class Network:
    embedding: np.ndarray  # (byte, dimension)
    filters: np.ndarray  # (offset, dimension, filter)
    bias: np.ndarray  # (filter)
    weights: np.ndarray  # (2 * filter + 1): of the mean, of the maximum, and the constant

    def tables(self) -> np.ndarray:
        return np.einsum("bd,jdf->jbf", self.embedding, self.filters).astype(np.float32)

    def score(self, texts: list[bytes], tables: np.ndarray, block: int = 256) -> np.ndarray:
        """One probability a text, from all of it; an empty one gets that of the constant alone."""
        k = len(self.bias)
        total, top, n = np.zeros((len(texts), k)), np.zeros((len(texts), k)), np.zeros(len(texts))
        waiting, owner, held = [], [], 0

        def flush() -> None:
            if waiting:
                chunks, of = np.concatenate(waiting), np.concatenate(owner)
                pooled = np.maximum(respond(tables, chunks).max(1) + self.bias, 0)
                np.add.at(total, of, pooled)
                np.maximum.at(top, of, pooled)
                waiting.clear()
                owner.clear()

        for i, text in enumerate(texts):
            chunks = chunks_of(text)
            n[i] = len(chunks)
            for a in range(0, len(chunks), block):
                part = chunks[a : a + block]
                waiting.append(part)
                owner.append(np.full(len(part), i))
                held += len(part)
                if held >= block:
                    flush()
                    held = 0
        flush()
        logit = (total / np.maximum(n, 1)[:, None]) @ self.weights[:k] + top @ self.weights[k : 2 * k] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _first_embedding(rng: np.random.Generator, size: int) -> np.ndarray:
    """What kind a byte is, and something at random."""
    b = np.arange(256)
    kinds = [(b >= 97) & (b <= 122), (b >= 65) & (b <= 90), (b >= 48) & (b <= 57), b <= 32, np.isin(b, list(b".,;:")), np.isin(b, list(b"!?")), np.isin(b, list(b"#*$%&|<>")), b >= 128]
    e = rng.normal(0, 0.3, (256, size))
    for i, kind in enumerate(kinds[:size]):
        e[:, i] += kind
    e[0] = 0
    return e


def train(texts: list[bytes], good: np.ndarray, filters: int = 16, size: int = 12, epochs: int = 6, batch: int = 48, most_chunks: int = 12, rate: float = 0.01, seed: int = 1) -> Network:
    """Fit by Adam on the log loss. Of a longer text each epoch sees another run of ``most_chunks`` chunks."""
    rng = np.random.default_rng(seed)
    net = Network(_first_embedding(rng, size), rng.normal(0, 0.15, (WIDTH, size, filters)), np.zeros(filters), np.concatenate([rng.normal(0, 0.2, 2 * filters), [0.5]]))
    if not len(texts):
        return net
    params = [net.embedding, net.filters, net.bias, net.weights]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    at = np.arange(0, CHUNK - WIDTH + 1, STEP)
    every = [chunks_of(t) for t in texts]
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            parts = []
            for i in some:
                c = every[i]
                s = rng.integers(0, len(c) - most_chunks + 1) if len(c) > most_chunks else 0
                parts.append(c[s : s + most_chunks])
            n = np.array([len(p) for p in parts])
            keep = n > 0
            chunks, of = np.concatenate(parts), np.repeat(np.arange(len(some)), n)
            k = filters
            mean, top = np.zeros((len(some), k)), np.zeros((len(some), k))
            out = respond(net.tables(), chunks)
            where = out.argmax(1)
            raw = np.take_along_axis(out, where[:, None], 1)[:, 0] + net.bias
            pooled = np.maximum(raw, 0)
            np.add.at(mean, of, pooled)
            mean /= np.maximum(n, 1)[:, None]
            np.maximum.at(top, of, pooled)
            w = net.weights
            p = 1 / (1 + np.exp(-np.clip(mean @ w[:k] + top @ w[k : 2 * k] + w[-1], -30, 30)))
            d = (p - good[some]) / len(some) * keep
            g_w = np.concatenate([d @ mean, d @ top, [d.sum()]]) + 1e-4 * w
            d_pool = d[of, None] * (w[:k] / np.maximum(n, 1)[of, None] + w[k : 2 * k] * (pooled >= top[of]))
            d_pool *= raw > 0
            g_table = np.zeros(WIDTH * 256 * k)
            spot = at[where]
            for j in range(WIDTH):
                byte = chunks[np.arange(len(chunks))[:, None], spot + j].astype(np.int64)
                g_table += np.bincount(((j * 256 + byte) * k + np.arange(k)).ravel(), d_pool.ravel(), len(g_table))
            g_table = g_table.reshape(WIDTH, 256, k)
            grads = [np.einsum("jbf,jdf->bd", g_table, net.filters), np.einsum("bd,jbf->jdf", net.embedding, g_table), d_pool.sum(0), g_w]
            grads[0][0] = 0
            step += 1
            lr = rate * (1 - 0.8 * (epoch / epochs))
            for x, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", good_rows: int = 2400, bad_rows: int = 1500, chars_each: int = 12000) -> Network:
    """Train on a bounded sample of labelled rows: at most these many rows of quality 1 and 0, of each up to ``chars_each``
    characters, from all parts of a longer text. See :func:`labelled_sample`. Null text is empty; no rows, no training."""
    text = all_parts(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), chars_each)
    found = labelled_sample(docs, labels, {1: good_rows, 0: bad_rows}, id_col, text, quality_col)
    got = sorted(found.select("id", "text", "label").collect(), key=lambda r: (r[0], r[1]))
    return train([r[1].encode("utf-8", "replace") for r in got], np.array([r[2] for r in got], float))


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row, from its whole text, however long.

    Null text counts as empty, and an empty text gets the chance of the constant alone; rows that repeat stay and ties
    are scored alike. Other columns are not read, and an id column named ``score`` is called ``id``. No rows, no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables()
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.score(texts, tables))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = small_batches(rows).mapInArrow(run, f"id {kind}, score double")
    return out if id_col in out.columns else out.withColumnRenamed("id", id_col)


def op3_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all ``documents``, learned from labelled rows that aren't held out; null text is empty. See :func:`score`."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = fit(docs, labels.where(remainder("doc_id", 5) != 0))
    return score(docs, net).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
