"""Best-fit packing of token sequences, improved by swap-based local search.

Texts become token ids; what is longer than a sequence is cut. The pieces are dealt by a hash to groups of a
bounded number of tokens, and each group is packed in one task: best fit by falling length first, then local
search among the underfull bins. It moves one document, exchanges one for one, or two for one, always so that
the sum of squared fills grows; the emptiest bins drain until they are gone. A group can waste one bin at
most on top of what its own bins waste, which is one in ``BINS_EACH``.
"""

from __future__ import annotations

import array
import string
import struct
import unicodedata
from bisect import bisect_right, insort
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

CAPACITY = 4096
BINS_EACH = 1536
#: Bytes of text to a token, at the least that is usual; it only scales the number of groups.
BYTES_A_TOKEN = 2.5
#: Characters of text whose words are told apart at a time: of each different word the ids are worked out once in as many.
TEXT_EACH = 8 << 20


_ID = attrgetter("id")
_NUMBERS = [struct.Struct(f"<{n}I").pack for n in range(40)]


def _byte_letters() -> dict[int, str]:
    """The letters in which byte-level vocabularies spell bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """The ids of white-space separated words under a tokenizer that drops white space, worked out when first asked for.

    The normalizer and splitter of ``word_bpe_49k.json`` never look across white space, so a text's ids are those of its
    words in turn. Nor does the splitter join letters with anything else: a word of letters goes straight to the
    vocabulary's merges, and marks after one are a piece of their own. Everything else takes the tokenizer's whole way,
    as do texts that hold the name of an added token, which is that token, and texts with separators that Python takes
    for white space and the tokenizer doesn't (U+001C to U+001F). Memory is bounded: past ``most`` bytes the older half
    goes, and those asked for again come back; a longer word than ``longest`` is never kept.
    """

    def __init__(self, path: str, most: int = 40 << 20, longest: int = 200):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.model._resize_cache(0)  # words are remembered here
        self.merges = self.tokenizer.model.tokenize
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.most, self.longest, self.held, self.older = most, longest, 0, {}

    def __missing__(self, word: str) -> bytes:
        got = self.older.get(word)
        if got is None:
            if word.isalpha():
                got = self.of_letters(word)
            else:
                head = word.rstrip(string.punctuation)
                got = self[head] + self[word[len(head) :]] if head.isalpha() else self.whole(word)
        if len(word) <= self.longest:
            self.held += 220 + len(word) + len(got)  # with what Python adds to a string, its bytes and their place
            if self.held > self.most // 2:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[word] = got
        return got

    def forget(self) -> None:
        self.clear()
        self.older, self.held = {}, 0

    def of_letters(self, word: str) -> bytes:
        found = self.merges(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))
        return _NUMBERS[len(found)](*map(_ID, found)) if len(found) < len(_NUMBERS) else array.array("I", map(_ID, found)).tobytes()

    def whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def plain(self, text: str) -> str | None:
        """The text in small letters, null where it takes the tokenizer's whole way."""
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return None
        plain = (text if text.isascii() else unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")).lower()  # no final sigma here
        return None if any(t in plain for t in self.added) else plain

    def ids(self, text: str) -> bytes:
        """A text's ids as little-endian unsigned 32-bit numbers."""
        plain = self.plain(text)
        return self.whole(text) if plain is None else b"".join(map(self.__getitem__, plain.split()))

    def each(self, words: pa.Array) -> list[bytes]:
        """The ids of different words; of letters that only marks after them tell apart, the merges are asked once."""
        heads = pc.utf8_rtrim(words, string.punctuation).dictionary_encode()
        names = heads.dictionary.to_pylist()
        found = [self.of_letters(h) if h.isalpha() else None for h in names]
        out = []
        for word, at in zip(words.to_pylist(), heads.indices.to_pylist(), strict=True):
            got, n = found[at], len(names[at])
            out.append(self[word] if got is None else got if len(word) == n else got + self[word[n:]])
        return out

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """What :meth:`ids` gives for each text, with every different word of them all worked out once."""
        plain = [self.plain(t) for t in texts]
        # ASCII white space alone is left to split at.
        split = pc.ascii_split_whitespace(pa.array([p if p is None or p.isascii() else " ".join(p.split()) for p in plain], pa.large_string()).fill_null(""))
        coded = split.values.dictionary_encode()
        known = self.each(coded.dictionary)
        n = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, first = np.frombuffer(b"".join(known), "<u4"), np.cumsum(n) - n
        codes = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(n[codes])])
        cuts = ends[split.offsets.to_numpy()].tolist()
        places = np.repeat(first[codes] - ends[:-1], n[codes])
        places += np.arange(len(places))
        ids = flat[places]
        return [self.whole(t) if p is None else ids[a:b].tobytes() for t, p, a, b in zip(texts, plain, cuts, cuts[1:], strict=False)]


_held: dict[str, Words] = {}


def words_for(path: str) -> Words:
    """A worker keeps its tokenizer from one task to the next; the words that it met go when a task ends."""
    if path not in _held:
        _held[path] = Words(path)
    return _held[path]


PIECE = ["piece", "start", "length", "ids", "nth"]


def _named(df: DataFrame, id_col: str) -> DataFrame:
    """The column ``id`` under its own name, unless a result has that name."""
    return df if id_col in df.columns else df.withColumnRenamed("id", id_col)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of rows of about ``most`` characters, one text at least."""
    keys, texts, size = [], [], 0
    for whole in batches:
        for a in range(0, whole.num_rows, 256):
            batch, begin = whole.slice(a, 256), 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                texts.append(text or "")
                size += len(texts[-1])
                if size >= most:
                    yield pa.concat_arrays([*keys, batch.column(0).slice(begin, i + 1 - begin)]), texts
                    keys, texts, size, begin = [], [], 0, i + 1
            keys.append(batch.column(0).slice(begin))
    if texts:
        yield pa.concat_arrays(keys), texts


def _pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, nth, end = words_for(tokenizer), 0, array.array("I", [end_id]).tobytes()
        for key, texts in _chunks(batches, TEXT_EACH):
            row, piece, ids = [], [], []
            for i, got in enumerate(words.ids_of(texts)):
                got += end
                for k in range(0, len(got), 4 * capacity):
                    row.append(i)
                    piece.append(k // (4 * capacity))
                    ids.append(got[k : k + 4 * capacity])
            n = np.array(piece, np.int64)
            cols = [
                key.take(pa.array(row, pa.int64())), pa.array(n.astype(np.int32)), pa.array(n * capacity),
                pa.array(np.array([len(x) // 4 for x in ids], np.int64)), pa.array(ids, pa.binary()), pa.array(np.arange(nth, nth + len(n))),
            ]
            nth += len(n)
            made = pa.RecordBatch.from_arrays(cols, ["id", *PIECE])
            yield from (made.slice(a, 512) for a in range(0, made.num_rows, 512))
        words.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return small_batches(rows).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary, nth long")


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """``(id, piece, start, length, ids, nth)``: each document's ids and ``end_id``, cut where longer than ``capacity``.

    ids: little-endian unsigned 32-bit numbers. nth: the piece's number within its partition. Null text is
    empty and gives ``end_id`` alone. An id column named like a result is called ``id``.
    """
    return _named(_pieces(docs, tokenizer, id_col, text_col, end_id, capacity), id_col)


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of positions in ``lengths``: longest first, each into the fullest bin that still takes it."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0  # bit r: some bin has room r
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        fits = free >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free ^= 1 << r
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        room[r - size].append(b)
        free |= 1 << (r - size)
    return bins


class _Bin:
    """A bin's pieces by length, for the local search."""

    def __init__(self, items: list[int], lengths: list[int]):
        self.items = sorted((lengths[i], i) for i in items)
        self.fill = sum(n for n, _ in self.items)

    def take(self, item: tuple[int, int]) -> None:
        self.items.remove(item)
        self.fill -= item[0]

    def put(self, item: tuple[int, int]) -> None:
        insort(self.items, item)
        self.fill += item[0]


def _largest_up_to(items: list[tuple[int, int]], most: int) -> tuple[int, int] | None:
    at = bisect_right(items, (most, 1 << 62))
    return items[at - 1] if at else None


def _improve(a: _Bin, b: _Bin, capacity: int) -> bool:
    """One exchange that fills ``a``, the fuller bin, from ``b``; the sum of squares grows. False if there is none."""
    free = capacity - a.fill
    best: tuple[int, list, list] = (0, [], [])
    item = _largest_up_to(b.items, free)
    if item:
        best = (item[0], [item], [])
    for out in a.items:  # one for one
        item = _largest_up_to(b.items, out[0] + free)
        if item and item[0] - out[0] > best[0]:
            best = (item[0] - out[0], [item], [out])
    if best[0] < free:
        for out in a.items:  # two for one
            low, high, most = 0, len(b.items) - 1, out[0] + free
            while low < high:
                two = b.items[low][0] + b.items[high][0]
                if two > most:
                    high -= 1
                    continue
                if two - out[0] > best[0]:
                    best = (two - out[0], [b.items[low], b.items[high]], [out])
                low += 1
        for item in b.items:  # one for two
            low, high, least = 0, len(a.items) - 1, item[0] - free
            while low < high:
                two = a.items[low][0] + a.items[high][0]
                if two < least:
                    low += 1
                    continue
                if item[0] - two > best[0]:
                    best = (item[0] - two, [item], [a.items[low], a.items[high]])
                high -= 1
    if not best[0]:
        return False
    for x in best[1]:
        b.take(x)
        a.put(x)
    for x in best[2]:
        a.take(x)
        b.put(x)
    return True


def local_search(bins: list[list[int]], lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Drain the emptiest bins into the free room of the others, while fewer bins could hold everything.

    Each step exchanges between two underfull bins, from the emptier one to the fuller, so that the sum of squared
    fills grows, hence it ends: when no exchange between any two bins fills one further. A bin is settled once none
    of the settled ones can exchange with it; those that do exchange are looked at again, the fullest first.
    """
    fewest = -(-sum(lengths) // capacity)
    full, waiting, settled = [], [], []
    for n, b in enumerate(bins):
        x = _Bin(b, lengths)
        if x.fill < capacity:
            waiting.append((-x.fill, n, x))
        else:
            full.append(x)
    heapify(waiting)
    nth = len(bins)
    while waiting and len(full) + len(waiting) + len(settled) > fewest:
        one, moved = heappop(waiting)[2], []
        for other in settled:
            more = True
            while more:
                low, high = (one, other) if one.fill <= other.fill else (other, one)
                more = high.fill < capacity and (_improve(high, low, capacity) or (low.fill == high.fill and _improve(low, high, capacity)))
                if more and other not in moved:
                    moved.append(other)
                more = more and bool(one.items and other.items)
            if not one.items or one.fill == capacity:
                break
        if not moved:
            settled.append(one)
            continue
        settled = [x for x in settled if x not in moved]
        for x in (one, *moved):
            if x.fill == capacity:
                full.append(x)
            elif x.items:
                heappush(waiting, (-x.fill, nth, x))
                nth += 1
    return [[i for _, i in x.items] for x in (*full, *settled, *(x for _, _, x in waiting))]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def _pack_group(part: pa.Table, capacity: int) -> pa.Table:
    lengths = part.column("length").to_pylist()
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    first = part.column("grp")[0].as_py() << 32 if lengths else 0
    # Rows arrive in the order in which the shuffle delivers them; the packing is the same in any.
    order = np.lexsort((part.column("nth").to_numpy(), part.column("piece").to_numpy(), np.array(lengths, np.int64))).tolist()
    for b, items in enumerate(pack_lengths([lengths[i] for i in order], capacity)):
        at = 0
        for k in items:
            i = order[k]
            sequence[i], offset[i] = first + b, at
            at += lengths[i]
    return part.select(["id", "piece", "start", "length", "ids"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY, bins_each: int = BINS_EACH) -> DataFrame:
    """``(id, piece, start, length, ids, sequence_id, offset)``: where each piece of each document lies.

    Null and empty texts are ``end_id`` alone; texts of any length are cut into pieces, none is dropped. Repeated
    rows are packed as often as they come, pieces of equal length go by piece and place; a null id is carried along;
    no rows, no sequences. Other columns are not read; an id column named like a result is called ``id``. Groups
    are dealt by id, piece and place in the partition, so no id gathers in one task; the number of groups, and of
    the tasks that they are dealt to, follows the bytes of text, which a job adds up here.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    groups = max(1, round(size / BYTES_A_TOKEN / capacity / bins_each))
    dealt = _pieces(docs, tokenizer, id_col, text_col, end_id, capacity).withColumn("grp", F.pmod(F.xxhash64("id", "piece", "nth"), F.lit(groups)))

    def run(part: pa.Table) -> pa.Table:
        return _pack_group(part, capacity)

    kind = docs.schema[id_col].dataType.simpleString()
    out = dealt.repartition(2 * groups, "grp").groupBy("grp").applyInArrow(run, f"id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")
    return _named(out, id_col)


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed_digest(docs: DataFrame) -> DataFrame:
    out = pack(docs.select("doc_id", "text"), public_tokenizer())
    return out.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of all ``documents`` lies, with a checksum of its ids; null text is the end token alone. See :func:`pack`."""
    return packed_digest(table(spark, sf_dir, "documents"))
