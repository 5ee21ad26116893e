"""Personal data: fixed patterns, and identifiers that bootstrapped contexts give away (native).

Emails, addresses of the internet protocol, card and phone numbers are found by patterns, and they are the seeds. What stands
around them induces lexical patterns: the word before, the two before, the words on either side, the two after. Patterns
and what fills them form a graph, ``(pattern, instance, times)``. In each round a pattern's confidence is the weight of known
instances among all that fills it anywhere in the corpus, plain words included; an instance's score is what the confidence of
its contexts says, and instances that score high are known in the next round. Whatever looks like an identifier (it has a
digit, ``@`` or ``_``) and scores high in the end is found wherever it stands.

Only what looks like an identifier goes into the graph. How often plain words fill a pattern is counted in a second pass over
all texts: each place's contexts are first looked up in a bitmap of bounded size, which is broadcast, inside the text's row, and
only the few that pass become rows, to be joined and summed. A frequent pattern or instance is a sum, no list of its rows is ever gathered. Most contexts are of common words
and can make nothing known: plain words of a part of the texts bound from above what confidences and scores may be, and all texts
are read again only for the contexts of what may then still become known, which changes no result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.shared import write_table

from .common import BROADCAST_BYTES, broadcast_if_small, table, text_of

_LOCAL = "[A-Za-z0-9._%+-]"
#: A match starts where its first run does or where the last match ended, so every run is read once. The results are those of
#: the plain patterns: what follows a possessive run can't begin with a character of it.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
_IP = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
#: What parts words: ASCII white space and most ASCII punctuation, no-break spaces, quotes. No sign that identifiers hold.
_PARTING = r"""\x00-\x20"'(),;:!?<>\[\]{}|=*&$^`~\\ ‘-‟"""
#: A phone number, a spaced number of 13 digits or more, or a word with a digit, @ or _.
MENTION = rf"(?<![^{_PARTING}])(?:\+[0-9][\x20().0-9-]+[0-9]|[0-9](?:[\x20-]?[0-9]){{12,}}+|[^{_PARTING}0-9@_]*+[0-9@_][^{_PARTING}]*+)"
#: What every mention holds.
_MARKS = "[0-9@_]"
_HERE, _EDGE = "\x01", "\x02"
#: What a text must hold for a kind to occur in it.
_SIGNS_OF = {"email": "@", "phone": "+"}
_PARTS_OF = {"ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12}"}
_SIGNS = ".%/#-"
#: Characters of an identifier that only its contexts give away.
LENGTHS = (4, 64)
#: The bitmap of contexts has this many words of 64 bits at most: 1 MB.
_WORDS = 1 << 17


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column, levels: int = 3) -> Column:
    """Of each number of an array the sum of those before it, in blocks of 64 so that long arrays don't cost their square."""

    def few(some: Column) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("a"), F.lit(0).alias("s"))
        return F.aggregate(some, start, lambda acc, x: F.struct(F.concat(acc["a"], F.array(acc["s"])).alias("a"), (acc["s"] + x).alias("s")), lambda acc: acc["a"])

    if levels == 1:
        return few(lengths)

    def blocks(all_: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / 64).cast("int")), lambda b: F.slice(all_, b * 64 + 1, 64))
        return let(parts, lambda p: let(running(F.transform(p, lambda x: F.aggregate(x, F.lit(0), lambda a, y: a + y)), levels - 1), lambda offsets: F.flatten(F.transform(p, lambda x, i: F.transform(few(x), lambda v: v + offsets[i])))))

    return let(lengths, lambda all_: F.when(F.size(all_) <= 64, few(all_)).otherwise(blocks(all_)))


def _parted(text: Column, pattern: str) -> Column:
    """A text without ``_HERE`` cut at the leftmost non-overlapping matches, which are every second part: one pass of the pattern."""
    return F.split(F.regexp_replace(text, pattern, f"{_HERE}$0{_HERE}"), _HERE)


def _placed(parts: Column) -> Column:
    """``(start, m)`` of the matches among the parts of a text, starts in code points."""
    starts = let(running(F.transform(parts, lambda p: F.length(p))), lambda r: F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.struct(r[i].alias("start"), p.alias("m")))))
    return F.filter(starts, lambda x: x.isNotNull())


def matches(text: Column, pattern: str) -> Column:
    """``(start, m)`` of the leftmost non-overlapping matches in a text without ``_HERE``, starts in code points."""
    return let(_parted(text, pattern), lambda parts: F.when(F.size(parts) > 1, _placed(parts)).otherwise(F.array().cast("array<struct<start:int,m:string>>")))


def _luhn(digits: Column) -> Column:
    def worth(i: Column, d: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return let(digits, lambda d: F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + worth(i, d)) % 10 == 0)


def holds(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern is one: the parts, digits and check sum that it needs."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(_IP)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)


def known(text: Column) -> Column:
    """Whether a text as a whole is an email, an address, a card or a phone number."""
    each = [text.rlike(rf"^(?:{p.replace(chr(92) + 'G|', '')})$") & holds(k, text) for k, p in PATTERNS.items()]
    return each[0] | each[1] | each[2] | each[3]


def _spans(text: Column, kind: str) -> Column:
    may = text.contains(_SIGNS_OF[kind]) if kind in _SIGNS_OF else text.rlike(_PARTS_OF[kind])
    none = F.array().cast("array<struct<start:int,m:string>>")
    found = F.when(may, F.filter(matches(text, PATTERNS[kind]), lambda x: holds(kind, x["m"]))).otherwise(none)
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("end")))


def _plain(text: Column) -> Column:
    """The text, as long as it was, with nothing that could be taken for our own marks, lines' ends marked."""
    for sign, plain in ((_HERE, " "), (_EDGE, " "), ("\n", _EDGE)):
        text = F.replace(text, F.lit(sign), F.lit(plain))
    return text


def _at_mentions(text: Column) -> Column:
    """A plain text cut at its mentions. One without a sign that all mentions hold stays whole: the pattern costs ten times all else."""
    return F.when(text.rlike(_MARKS), _parted(text, MENTION)).otherwise(F.array(text))


def _words(parts: Column) -> Column:
    """Words of letters in small ones, marks for mentions and for line ends, two ends before and after; of a text cut at its mentions."""
    marked = F.replace(F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, _HERE).otherwise(p)), " "), F.lit(_EDGE), F.lit(f" {_EDGE} "))
    words = F.filter(F.split(F.lower(marked), rf"[^\p{{L}}\p{{M}}{_HERE}{_EDGE}]+", -1), lambda w: w != "")
    ends = F.array(F.lit(_EDGE), F.lit(_EDGE))
    return F.concat(ends, words, ends)


def _contexts(words: Column, i: Column) -> list[tuple[str, Column, Column]]:
    """Kinds of context and their two words, of place ``i`` (from 0)."""
    none = F.lit("")
    return [("a _", words[i - 1], none), ("a b _", words[i - 2], words[i - 1]), ("a _ b", words[i - 1], words[i + 1]), ("_ a b", words[i + 1], words[i + 2])]


def _key(kind: str, a: Column, b: Column) -> Column:
    return F.xxhash64(F.lit(kind), a, b)


def _lexical(a: Column, b: Column) -> Column:
    return ~a.isin(_HERE, _EDGE, "") | ~b.isin(_HERE, _EDGE, "")


def _mentions(text: Column) -> Column:
    """What looks like an identifier, where it stands, and its contexts."""

    def of(found: Column, words: Column) -> Column:
        places = F.filter(F.transform(words, lambda w, i: F.when(w == _HERE, i)), lambda i: i.isNotNull())

        def one(x: Column, i: Column) -> Column:
            left = F.ltrim(x["m"], F.lit(_SIGNS))
            start = x["start"] + F.length(x["m"]) - F.length(left)
            instance = F.rtrim(left, F.lit(_SIGNS + "+@_"))
            around = F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("a"), b.alias("b")) for k, a, b in _contexts(words, i)]), lambda c: _lexical(c["a"], c["b"]))
            return F.struct(start.alias("start"), (start + F.length(instance)).alias("end"), instance.alias("instance"), around.alias("contexts"))

        return let(places, lambda at: F.transform(found, lambda x, i: one(x, at[i])))

    every = let(_parted(text, MENTION), lambda parts: F.when(F.size(parts) > 1, let(_placed(parts), lambda found: let(_words(parts), lambda w: of(found, w)))))
    return F.filter(F.when(text.rlike(_MARKS), every), lambda x: F.length(x["instance"]).between(*LENGTHS) & x["instance"].rlike(_MARKS))


@dataclass
class Graph:
    """What bootstrapping ends with: ``patterns`` (kind, a, b, support, confidence) and ``instances`` (instance, known, score)."""

    patterns: DataFrame
    instances: DataFrame


def _bitmap(hashes: DataFrame) -> tuple[DataFrame, int]:
    """One row with an array of 64-bit words in which the bits of ``hash`` are set, 16 bits a hash and 1 MB at most; how many words."""
    words = min(_WORDS, 1 << max(6, (hashes.count() // 4).bit_length()))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("hash").bitwiseAND(63).cast("int"))
    some = hashes.groupBy(F.shiftright("hash", 6).bitwiseAND(words - 1).cast("int").alias("word")).agg(F.bit_or(one).alias("bits"))
    every = some.sparkSession.range(words).select(F.col("id").cast("int").alias("word")).join(some, "word", "left")
    listed = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(listed, lambda x: x["bits"]).alias("bits")), words


def _set(bits: Column, words: int, hash_: Column) -> Column:
    return F.getbit(F.get(bits, F.shiftright(hash_, 6).bitwiseAND(words - 1).cast("int")), hash_.bitwiseAND(63).cast("int")) == 1


def _likely(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``(likely)``: of each text the contexts of its places, as hashes, that may be among ``keys``, null or empty where there are none.

    keys: ``key, a, b``. Places are held against bitmaps where they are, so what few keys can't fill never becomes a row: each word
    once, whether it is the longer one of a key, and only the contexts around such words. A written table: ``explode``
    and filters would else work out each array once more.
    """
    long_ = [F.when(F.col(w).isin(_HERE, _EDGE), 0).otherwise(F.length(w)) for w in "ab"]
    in_words, n_words = _bitmap(keys.select(F.xxhash64(F.when(long_[0] >= long_[1], F.col("a")).otherwise(F.col("b"))).alias("hash")).distinct())
    in_keys, n_keys = _bitmap(keys.select(F.col("key").alias("hash")))

    def every(words: Column) -> Column:
        near = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda p: _set(F.col("words"), n_words, F.xxhash64(words[p])))
        places = F.array_distinct(F.flatten(F.transform(near, lambda p: F.array(p - 2, p - 1, p + 1, p + 2))))
        places = F.filter(places, lambda i: i.between(2, F.size(words) - 3))
        return F.flatten(F.transform(places, lambda i: F.filter(F.array(*[_key(*c) for c in _contexts(words, i)]), lambda k: _set(F.col("keys"), n_keys, k))))

    both = texts.select(_plain(F.col("text")).alias("text")).crossJoin(F.broadcast(in_words.withColumnRenamed("bits", "words").crossJoin(in_keys.withColumnRenamed("bits", "keys"))))
    return write_table(both.select(let(_words(_at_mentions(F.col("text"))), every).alias("likely")), "likely")


def _totals(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``(key, total)``: how many places of all texts have each context; keys: ``key, a, b``."""
    keys = keys.dropDuplicates(["key"])
    likely = _likely(texts, keys).select(F.explode("likely").alias("key"))
    return likely.join(broadcast_if_small(keys.select("key"), 32), "key", "left_semi").groupBy("key").agg(F.count("*").alias("total"))


def bootstrap(mentions: DataFrame, texts: DataFrame, support: int = 3, sure: float = 0.6, rounds: int = 3, unknown: float = 0.1, other: float = 0.25, every_pattern: bool = True) -> Graph:
    """Score the graph of ``mentions`` (instance, contexts) over ``texts`` (text) for a number of rounds.

    A pattern needs ``support`` different known instances. Its confidence is ``k / (k + p + unknown * u + 1)``: k the weight of
    known instances that fill it, by their scores and how often they do, u the rest of what looks like an identifier, p all other
    words. An instance scores ``g / (g + other * (n - g))``: n how often it stands anywhere, g the sum of its contexts'
    confidences, of the kind of context that gives most. It is known from ``sure`` on, and for good if it is a seed. All sums
    cover all texts. Tables are written to the shared folder: the edges, the totals, and the scores of each round.

    every_pattern: rate all patterns. Otherwise only those that an instance fills which may become known, and scores of others are not to be
    used; what scores ``sure`` in the end is the same. Scores grow with confidences and these fall with totals, so totals of
    a sixteenth of the texts give bounds from above.
    """
    counts = mentions.groupBy("instance").agg(F.count("*").alias("n"))
    scores = write_table(counts.withColumn("known", known(F.col("instance"))).withColumn("score", F.col("known").cast("double")), "instances")
    c = F.col("c")
    edges = mentions.select("instance", F.explode("contexts").alias("c")).groupBy("c", "instance").agg(F.count("*").alias("n"))
    edges = edges.select(_key(c["kind"], c["a"], c["b"]).alias("key"), c["kind"].alias("kind"), c["a"].alias("a"), c["b"].alias("b"), "instance", "n")
    edges = write_table(edges, "contexts")
    wide = write_table(edges.groupBy("key", "kind", "a", "b").agg(F.count("*").alias("different"), F.sum("n").alias("filled")).where(F.col("different") >= support), "context-keys")
    edges = write_table(edges.select("key", "instance", "n").join(wide.select("key"), "key", "left_semi"), "edges")

    def patterns(scores: DataFrame, edges: DataFrame, totals: DataFrame) -> DataFrame:
        s = F.col("score")
        filled = edges.join(scores.where("score > 0").select("instance", "score"), "instance").groupBy("key").agg(
            F.sum(F.when(s >= sure, F.col("n") * s).otherwise(0.0)).alias("k"), F.count(F.when(s >= sure, 1)).alias("support"))
        plain = F.greatest(F.col("total") - F.col("filled"), F.lit(0))
        rated = filled.where(F.col("support") >= support).join(totals, "key")
        return rated.withColumn("confidence", F.col("k") / (F.col("k") + plain + unknown * (F.col("filled") - F.col("k")) + 1))

    def spread(scores: DataFrame, edges: DataFrame, totals: DataFrame) -> DataFrame:
        for _ in range(rounds):
            good = patterns(scores, edges, totals).select("key", "kind", "confidence")
            by_kind = edges.join(good, "key").groupBy("instance", "kind").agg(F.sum(F.col("n") * F.col("confidence")).alias("g"))
            told = by_kind.groupBy("instance").agg(F.max("g").alias("g"))
            g = F.coalesce(F.col("g"), F.lit(0.0))
            scores = write_table(scores.select("instance", "n", "known").join(told, "instance", "left").select("instance", "n", "known", F.when(F.col("known"), 1.0).otherwise(g / (g + other * (F.col("n") - g) + F.lit(1e-12))).alias("score")), "scores")
        return scores

    if not every_pattern:
        least = _totals(texts.where(F.pmod(F.xxhash64("text"), F.lit(16)) == 0), wide.select("key", "a", "b"))
        least = write_table(wide.join(least, "key", "left").withColumn("total", F.coalesce("total", F.lit(0))), "context-bounds")
        may = spread(scores, edges, least).where(~F.col("known") & (F.col("score") >= sure - 1e-9)).select("instance")
        needed = write_table(edges.join(may, "instance", "left_semi").select("key").distinct(), "needed")
        if not needed.head(1):
            return Graph(least.limit(0).select("kind", "a", "b", F.lit(0).cast("long").alias("support"), F.lit(0.0).alias("confidence")), scores.select("instance", "known", "score"))
        wide, edges = wide.join(needed, "key", "left_semi"), write_table(edges.join(needed, "key", "left_semi"), "edges")
    wide = write_table(wide.join(_totals(texts, wide.select("key", "a", "b")), "key"), "context-totals")
    scores = spread(scores, edges, wide)
    return Graph(patterns(scores, edges, wide).select("kind", "a", "b", "support", "confidence"), scores.select("instance", "known", "score"))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = 0.6, **how: float) -> DataFrame:
    """``(id, base, spans)`` of every row: arrays of ``(kind, start, end)`` in code points, end exclusive.

    base: matches of :data:`PATTERNS` that hold (kinds email, ip, card, phone, each by start; kinds may overlap). spans: these, and
    of kind ``id`` what :func:`bootstrap` finds and no base span overlaps. An identifier has 4 to 64 characters.

    Null text is empty; both arrays are empty where nothing is found. Texts of any length are read whole, in time linear in their
    length. What is found depends on the text alone: repeated rows and ids get the same. Ids may be null and of any type,
    other columns aren't read, so any names may occur. No rows, no result. Jobs run here, see :func:`bootstrap`; they write what
    is found by row, without texts.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text"))
    base = let(F.replace("text", F.lit(_HERE), F.lit(_EDGE)), lambda text: F.concat(*[_spans(text, k) for k in PATTERNS]))
    found = write_table(rows.select("id", F.unhex(F.md5("text")).alias("h"), base.alias("base"), _mentions(_plain(F.col("text"))).alias("mentions")), "personal")
    mentions = found.select("h", F.explode("mentions").alias("x")).select("h", "x.*")
    graph = bootstrap(mentions.select("instance", "contexts"), rows.select("text"), sure=sure, every_pattern=False, **how)
    new = write_table(graph.instances.where(~F.col("known") & (F.col("score") >= sure)).select("instance"), "identifiers")
    at = mentions.select("h", "start", "end", "instance").join(broadcast_if_small(new, 384), "instance", "left_semi")
    more = at.groupBy("h").agg(F.array_sort(F.collect_set(F.struct(F.lit("id").alias("kind"), "start", "end"))).alias("more"))
    more = write_table(more, "found")
    spans = more.agg(F.coalesce(F.sum(F.size("more") + 4), F.lit(0))).first()[0]
    b, none = F.col("base"), F.array().cast(found.schema["base"].dataType)
    added = F.filter(F.coalesce(F.col("more"), none), lambda x: ~F.exists(b, lambda y: (y["start"] < x["end"]) & (y["end"] > x["start"])))
    labelled = found.drop("mentions").join(F.broadcast(more) if 40 * spans <= BROADCAST_BYTES else more, "h", "left")
    return labelled.select(F.col("id").alias(id_col), "base", F.concat(b, added).alias("spans"))


def _said(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``; see :func:`find_personal`."""
    found = find_personal(table(spark, sf_dir, "documents"))
    of = F.transform("base", lambda x: x["kind"])
    each = [(F.size("base") - F.size(F.array_remove(of, k))).cast("long").alias(f"n_{k}") for k in PATTERNS]
    return found.select("doc_id", *each, F.sha2(_said(F.col("base")), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"))
