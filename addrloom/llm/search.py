"""Ranked lexical search with inverted treaps.

Each term's postings are a treap: searched by document, a heap by impact, so the root of any stretch of documents bounds
what the term can add there. A query walks the treaps of its terms at once: a stretch of documents whose roots' weighted
sum can't enter the best k is left out with all below it; any other is split at the root that weighs most, whose document
is scored on the way down, and stretches of a few documents are scored as a whole.

Spark deals documents into shards of a bounded number of postings and queries into blocks of a bounded number of items.
Each block meets each shard in one task, which builds the treaps of the block's terms over the shard; the best k of every
shard are merged by a window. Counts over the corpus (documents of a term, words in all) are aggregates before that. A
term that every document has is spread over all shards like the documents are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrloom.shared import write_table

from .common import UPPER, broadcast_if_small, small_batches, table

#: Letters and digits of ASCII and all beyond it; A-Z as a-z, all else a space.
_TERMS = bytes((c | 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Postings of a shard and items of a block, about (dealt by a hash).
SHARD, BLOCK = 1_000_000, 256
#: Documents of a stretch that is scored as a whole; stretches looked at together.
LEAF, TOGETHER = 256, 64


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERMS).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each document: one without a term, with the number of its terms, if it has any, and one for each term."""
    names = ["doc", "id", "term", "tf", "n"]

    def rows(batch, at, terms, tfs, ns):
        where = pa.array(at, pa.int64())
        kept = [batch.column("doc").take(where), batch.column("id").take(where)]
        return pa.RecordBatch.from_arrays([*kept, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.int64()), pa.array(ns, pa.int64())], names)

    for batch in batches:
        at, terms, tfs, ns = [], [], [], []
        for i, text in enumerate(batch.column("text")):
            found = terms_of(text.as_py())
            if not found:
                continue
            counts = Counter(found)
            terms.append(None)
            terms.extend(counts)
            tfs.append(0)
            tfs.extend(counts.values())
            at.extend([i] * (len(counts) + 1))
            ns.extend([len(found)] * (len(counts) + 1))
            if len(terms) > 100_000:
                yield rows(batch, at, terms, tfs, ns)
                at, terms, tfs, ns = [], [], [], []
        yield rows(batch, at, terms, tfs, ns)


def _counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, id, term, tf, n)``; doc tells rows apart."""
    rows = df.select(F.monotonically_increasing_id().alias("doc"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return small_batches(rows).mapInArrow(_counted, f"doc long, id {kind}, term string, tf long, n long")


class Treaps:
    """The postings of several terms over documents 0 to ``docs - 1``; ``term`` and ``doc`` are sorted, pairs unique."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray, terms: int, docs: int):
        self.docs = docs
        self.key = term * docs + doc
        # Node -1, the last one of each array, stands for none.
        self.doc, self.value = np.append(doc, -1), np.append(value, 0)
        first = np.searchsorted(term, np.arange(terms + 1)).tolist()
        # Equal impacts are ordered by a hash of the document, or many copies of one would make a list of the treap.
        heap = (value << 32 | (doc * 2654435761 & 0xFFFFFFFF)).tolist()
        n = len(heap)
        left, right, self.root = [-1] * (n + 1), [-1] * (n + 1), np.full(terms, -1, np.int64)
        for t in range(terms):
            spine: list[int] = []
            for i in range(first[t], first[t + 1]):
                below, mine = -1, heap[i]
                while spine and heap[spine[-1]] < mine:
                    below = spine.pop()
                left[i] = below
                if spine:
                    right[spine[-1]] = i
                spine.append(i)
            if spine:
                self.root[t] = spine[0]
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)

    def _split(self, node: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each stretch the roots before and after its document ``at``, and the nodes of that document.

        A node's subtree may reach beyond its stretch: what lies outside is passed by.
        """
        low, high, here = np.full_like(node, -1), np.full_like(node, -1), node
        lo, hi, at = lo[:, None], hi[:, None], at[:, None]
        while True:
            doc = self.doc[here]
            less, more = (here >= 0) & (doc < at), doc > at
            low = np.where((low < 0) & less & (doc >= lo), here, low)
            high = np.where((high < 0) & more & (doc <= hi), here, high)
            if not (less.any() or more.any()):
                break
            here = np.where(less, self.right[here], np.where(more, self.left[here], here))
        low, high = np.where(low < 0, self.left[here], low), np.where(high < 0, self.right[here], high)
        while (out := (low >= 0) & (self.doc[low] < lo)).any():
            low = np.where(out, self.right[low], low)
        while (out := self.doc[high] > hi).any():
            high = np.where(out, self.left[high], high)
        return low, high, here

    def _whole(self, term: np.ndarray, weight: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of whole stretches."""
        base = term[None, :] * self.docs
        first, last = np.searchsorted(self.key, base + lo[:, None]), np.searchsorted(self.key, base + hi[:, None], "right")
        size = hi - lo + 1
        place = np.cumsum(size) - size
        many = (last - first).ravel()
        at = np.repeat(first.ravel(), many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        stretch = np.repeat(np.repeat(np.arange(len(lo)), len(term)), many)
        score = np.bincount(place[stretch] + self.doc[at] - lo[stretch], self.value[at] * np.repeat(np.tile(weight, len(lo)), many), size.sum())
        return np.arange(size.sum()) - np.repeat(place - lo, size), score.astype(np.int64)  # sums are far below 2 ** 53

    def best(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k documents of highest score above 0, and the scores; of equal ones the smallest documents.

        ``weight``: what a term's impact counts times, integers of 1 at least.
        """
        some = self.root[term] >= 0
        term, weight = term[some], weight[some]
        top, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(term):
            return top, score
        lo, hi, node = np.array([0]), np.array([self.docs - 1]), self.root[term][None, :]
        bound = (self.value[node] * weight).sum(1)
        while len(lo):
            if len(top) == k:
                keep = (bound > score[-1]) | (bound == score[-1]) & (lo < top[-1])
                lo, hi, node, bound = lo[keep], hi[keep], node[keep], bound[keep]
            now = np.zeros(len(lo), bool)
            now[np.argpartition(-bound, TOGETHER - 1)[:TOGETHER] if len(lo) > TOGETHER else slice(None)] = True
            small = now & (hi - lo < LEAF)
            large = now & ~small
            docs, scores = [top], [score]
            if small.any():
                d, s = self._whole(term, weight, lo[small], hi[small])
                docs.append(d)
                scores.append(s)
            added = []
            if large.any():
                some = node[large]
                at = self.doc[some[np.arange(len(some)), (self.value[some] * weight).argmax(1)]]
                low, high, here = self._split(some, lo[large], hi[large], at)
                docs.append(at)
                scores.append((self.value[here] * weight).sum(1))
                added = [(lo[large], at - 1, low), (at + 1, hi[large], high)]
            d, s = np.concatenate(docs), np.concatenate(scores)
            good = np.flatnonzero(s > 0 if len(top) < k else s >= max(1, score[-1]))
            good = good[np.lexsort((d[good], -s[good]))[:k]]
            top, score = d[good], s[good]
            lo, hi, node, bound = lo[~now], hi[~now], node[~now], bound[~now]
            for a, b, roots in added:
                total = (self.value[roots] * weight).sum(1)
                some = total > 0
                lo, hi, node, bound = np.append(lo, a[some]), np.append(hi, b[some]), np.concatenate([node, roots[some]]), np.append(bound, total[some])
        return top, score


def _searched(k: int):
    def search(postings: pa.Table, items: pa.Table) -> pa.Table:
        n = postings.num_rows
        if not n or not items.num_rows:
            return pa.table({"item": pa.array([], pa.int64()), "item_id": items["item_id"].slice(0, 0), "doc": pa.array([], pa.int64()), "id": postings["id"].slice(0, 0), "score": pa.array([], pa.int64())})
        doc = postings["doc"].to_numpy()
        _, where, nth = np.unique(doc, return_index=True, return_inverse=True)
        each = postings.select(["id", "doc"]).take(pa.array(where))
        order = pc.sort_indices(each, [("id", "ascending"), ("doc", "ascending")]).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        known, term = np.unique(postings["tid"].to_numpy(), return_inverse=True)
        doc = place[nth]
        sort = np.lexsort((doc, term))
        treaps = Treaps(term[sort], doc[sort], postings["value"].to_numpy()[sort], len(known), len(order))
        tid, weight, item = (items[c].to_numpy() for c in ("tid", "weight", "item"))
        at = np.searchsorted(known, tid)
        there = known[np.minimum(at, len(known) - 1)] == tid
        found = []
        numbers, first, nth = np.unique(item, return_index=True, return_inverse=True)
        by = np.argsort(nth, kind="stable")
        ends = np.cumsum(np.bincount(nth))
        for i, part in enumerate(np.split(by, ends[:-1])):
            mine = part[there[part]]
            top, score = treaps.best(at[mine], weight[mine], k)
            found.append((np.full(len(top), i), order[top], score))
        i, d, s = (np.concatenate(x) for x in zip(*found, strict=True))
        each = each.take(pa.array(d))
        return pa.table({"item": numbers[i], "item_id": items["item_id"].take(pa.array(first[i])), "doc": each["doc"], "id": each["id"], "score": s})

    return search


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item id, rank, document id, score)``: of each row of ``items`` the ``k`` rows of ``docs`` with the highest scores above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased, of the whole text; null
    and texts without a term match nothing, but only texts with a term count as documents. N: documents with a term, L: their
    terms, repeats included, n: one document's, df: documents that hold a term, tf: how often one does. A term weighs
    ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, its impact is ``(1000000000 * tf) div (1000 * tf + 8 * m)`` with
    ``m = 25 + (75 * n * N) div L``, and a score sums weight times impact over the item's terms, repeats included. Equal scores are ranked by ascending id, nulls last; rows that repeat an id each have a rank of their own, in any
    order among themselves if scores are equal too. So do items that repeat an id. Other columns are not read, so any names may occur.
    Ids are of any type that has an order. No documents or no items, no result. Jobs run here: the items' terms and the
    postings of these terms are written to the shared folder, documents and terms are counted.
    """
    spark = docs.sparkSession
    asked = write_table(_counts(items, item_col, item_text_col).where("term is not null").select(F.col("doc").alias("item"), F.col("id").alias("item_id"), "term", F.col("tf").alias("times")), "items")
    blocks = -(-asked.agg(F.countDistinct("item")).first()[0] // BLOCK) or 1
    terms = write_table(asked.select("term").distinct().withColumn("tid", F.monotonically_increasing_id()), "query-terms")
    rows = _counts(docs, id_col, text_col).join(broadcast_if_small(terms, 128), "term", "left")
    postings = write_table(rows.where("term is null or tid is not null").drop("term"), "postings")
    n, words = postings.where("tid is null").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequent = write_table(postings.where("tid is not null").groupBy("tid").agg(F.count("*").alias("df")), "frequencies")
    shards = -(-(frequent.agg(F.sum("df")).first()[0] or 0) // SHARD) or 1

    weight = F.floor(1000 * F.log((2 * F.lit(float(n)) + 2) / (2 * F.col("df").cast("double") + 1))).cast("long")
    weighed = asked.join(terms, "term").join(frequent.select("tid", weight.alias("w")).where("w > 0"), "tid")
    weighed = weighed.select(F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"), "item", "item_id", "tid", (F.col("w") * F.col("times")).alias("weight"))
    sought = weighed.select(F.col("block").alias("of"), "tid").distinct()
    value = F.expr(f"(1000000000 * tf) div (1000 * tf + 8 * (25 + (75 * n * {n}L) div {max(words, 1)}L))")
    dealt = postings.where("tid is not null").join(broadcast_if_small(sought, 64), "tid")
    dealt = dealt.select(F.col("of").alias("block"), F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int").alias("shard"), "tid", "doc", "id", value.alias("value"))
    everywhere = weighed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    kinds = dict(everywhere.dtypes) | dict(dealt.dtypes)
    found = dealt.groupBy("block", "shard").cogroup(everywhere.groupBy("block", "shard")).applyInArrow(_searched(k), f"item long, item_id {kinds['item_id']}, doc long, id {kinds['id']}, score long")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "doc")
    out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def op13_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each ``benchmark`` item; see :func:`ranked`."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), t AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL
), p AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM p, t GROUP BY term, n_docs),
s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term), t GROUP BY ALL
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
