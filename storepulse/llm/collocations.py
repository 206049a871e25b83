"""Phrase collocations from a prefix-free parse.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks,
and the pieces into words at blanks. Counts are by language and over all documents.

* Parse: a window of ``LONGEST - 1`` words triggers if its CRC-32 is divisible by
  ``TRIGGER``. A piece is cut where windows trigger, and each part but the last runs on
  to the end of the window that begins the next one, so neighbours overlap in
  just that window and no part is a proper prefix of another that ends by a trigger.
  Equal text is cut alike wherever it stands.
* Dictionary: distinct parts with their frequency in the parse. Tasks add up pieces and parts
  before the shuffle, so a line on a third of all rows is a row a task.
* Counting: the n-grams inside each distinct part, weighted by its frequency. A part
  counts the n-grams that begin before its overlap (``own`` places); those that begin in
  the overlap are the next part's, so each occurrence counts once.
* Words and pairs are counted first. Triples are counted only where both of their pairs are
  frequent enough (a triple is no more frequent than its pairs); tasks know
  these pairs by a bit filter whose size grows with their number up to
  ``2**MAX_FILTER_BITS``; false positives are counted and then dropped by their count.
* Candidates are scored at every cut from the counts of both parts in exact
  decimals, and ranked by language: first within salts, then their best.

Nulls: null text is empty, null lang is ``und`` (together with that lang itself).
Repeated rows count each time. Ties of rank go by count, then phrase in the order of UTF-8
bytes, so every rank is defined. A text of any length is held once by its task,
and its parts by ``FLUSH``. Extra columns are ignored; an empty table has no phrases.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storepulse.llm.common import staged
from storepulse.llm.shingles import mix

#: Production parameters.
LEAST = 10
TOP = 2000
COVERED_PERCENT = 50
#: One window in so many ends a part.
TRIGGER = 16
LONGEST = 3
MIN_FILTER_BITS, MAX_FILTER_BITS = 16, 28
#: Distinct pieces or parts that a task adds up before it passes them on, and bytes of them.
FLUSH, FLUSH_BYTES = 200_000, 32 << 20
#: Words of parts that are counted at a time.
WORDS = 1 << 20
_ROWS = 1 << 16

_MARKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = bytes(0x0A if b in _MARKS else 0x20 if b == 0x09 else b for b in range(256))

PART = "lang string, part string, own int, n long"
GRAM = "lang string, gram string, n long"


# ---- parse ---------------------------------------------------------------------


def pieces(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_BREAK).split(b"\n")


def parts(words: list[bytes], trigger: int = TRIGGER) -> Iterator[tuple[list[bytes], int]]:
    """(words, own places) of the parts of one piece."""
    start, last = 0, len(words) - (LONGEST - 1)
    for i in range(1, last + 1):
        code = 0
        for w in words[i : i + LONGEST - 1]:
            code = zlib.crc32(w, zlib.crc32(b" ", code))
        if code % trigger == 0:
            yield words[start : i + LONGEST - 1], i - start
            start = i
    yield words[start:], len(words) - start


def _parsed(trigger: int):
    def flush(seen: dict[tuple[str, bytes], int]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, bytes, int], int] = {}
        for (lang, piece), n in seen.items():
            words = [w for w in piece.split(b" ") if w]
            if words:
                for part, own in parts(words, trigger):
                    key = lang, b" ".join(part), own
                    found[key] = found.get(key, 0) + n
        keys = list(found)
        for i in range(0, len(keys), _ROWS):
            some = keys[i : i + _ROWS]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in some], pa.string()),
                    pa.array([k[1] for k in some], pa.binary()).cast(pa.string()),
                    pa.array([k[2] for k in some], pa.int32()),
                    pa.array([found[k] for k in some], pa.int64()),
                ],
                names=["lang", "part", "own", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, bytes], int] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang = lang.as_py()
                for piece in pieces(text.as_py()):
                    if piece:
                        key = lang, piece
                        n = seen.get(key, 0)
                        seen[key] = n + 1
                        size += 0 if n else len(piece)
                if len(seen) > FLUSH or size > FLUSH_BYTES:
                    yield from flush(seen)
                    seen, size = {}, 0
        yield from flush(seen)

    return run


def dictionary(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """(lang, part, own, n): the distinct parts of all texts and how often the parse has them."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text is not null")
    return texts.mapInArrow(_parsed(trigger), PART).groupBy("lang", "part", "own").agg(F.sum("n").alias("n"))


# ---- counts --------------------------------------------------------------------


class _Words:
    """The words of some parts as numbers, with their places."""

    def __init__(self, rows: pa.Table):
        lists = pc.split_pattern(rows.column("part").combine_chunks(), " ")
        length = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.list_flatten(lists).dictionary_encode()
        self.words, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        lang = rows.column("lang").combine_chunks().dictionary_encode()
        self.langs = lang.dictionary
        row = np.repeat(np.arange(len(length)), length)
        place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        self.lang = lang.indices.to_numpy().astype(np.int64)[row]
        self.left = length[row] - place  # words from here to the end of the part
        self.counts = place < rows.column("own").to_numpy()[row]
        self.weight = rows.column("n").to_numpy()[row]

    def of(self, code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct codes, their total weight), where ``code`` has those of the places ``at``."""
        order = np.argsort(code, kind="stable")
        ranked = code[order]
        if not len(ranked):
            return ranked, ranked
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        return ranked[first], np.add.reduceat(self.weight[at][order], first)

    def single(self) -> np.ndarray:
        return self.lang * len(self.words) + self.word

    def pair(self) -> np.ndarray:
        """A code for the word here and the next one; only where ``left`` is two or more."""
        return self.single() * len(self.words) + np.append(self.word[1:], 0)

    def grams(self, codes: np.ndarray, k: int) -> tuple[pa.Array, pa.Array]:
        """(languages, phrases) of codes of one or two words."""
        v = len(self.words)
        words = []
        for _ in range(k):
            words.append(self.words.take(pa.array(codes % v)))
            codes = codes // v
        return self.langs.take(pa.array(codes)), pc.binary_join_element_wise(*reversed(words), " ")


def _rows(lang: pa.Array, gram: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([lang, gram, pa.array(n)], names=["lang", "gram", "n"])
    for i in range(0, len(n), _ROWS):
        yield whole.slice(i, _ROWS)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[_Words]:
    waiting, words = [], 0
    for batch in batches:
        waiting.append(batch)
        words += int(pc.sum(pc.count_substring(batch.column(1), " ")).as_py() or 0) + batch.num_rows
        if words >= WORDS:
            yield _Words(pa.Table.from_batches(waiting))
            waiting, words = [], 0
    if words:
        yield _Words(pa.Table.from_batches(waiting))


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and pairs of the parts."""
    for t in _tables(batches):
        for k, code in ((1, t.single()), (2, t.pair())):
            at = np.flatnonzero(t.counts & (t.left >= k))
            codes, n = t.of(code[at], at)
            yield from _rows(*t.grams(codes, k), n)


def _codes(texts: pa.Array) -> np.ndarray:
    """A hash of each text that every task computes alike."""
    return mix(np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts.to_pylist()], np.uint64))


def _slots(lang: np.ndarray, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The filter's slots of pairs, from the hashes of their languages and words."""
    return (mix(mix(lang + first) + second) >> np.uint64(64 - bits)).astype(np.int64)


def _triples(frequent, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for t in _tables(batches):
            word, lang = _codes(t.words)[t.word], _codes(t.langs)[t.lang]
            slots = _slots(lang[:-1], word[:-1], word[1:], bits)
            passed = np.append((known[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1, False)
            at = np.flatnonzero(t.counts & (t.left >= 3) & passed & np.append(passed[1:], False))
            codes, which = np.unique(t.pair()[at], return_inverse=True)
            v = len(t.words)
            found, n = t.of(which * v + t.word[at + 2], at)
            lang, two = t.grams(codes[found // v], 2)
            yield from _rows(lang, pc.binary_join_element_wise(two, t.words.take(pa.array(found % v)), " "), n)

    return run


def _marks(bits: int):
    """Words of the filter (place, mask) that pairs set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            word = _codes(pc.list_flatten(pc.split_pattern(batch.column(1), " "))).reshape(-1, 2)
            slots = np.unique(_slots(_codes(batch.column(0)), word[:, 0], word[:, 1], bits))
            first = np.flatnonzero(np.concatenate(([True], slots[1:] >> 6 != slots[:-1] >> 6)))
            masks = np.bitwise_or.reduceat(np.uint64(1) << (slots & 63).astype(np.uint64), first)
            yield pa.RecordBatch.from_arrays([pa.array(slots[first] >> 6), pa.array(masks.view(np.int64))], names=["word", "mask"])

    return run


def _filter(pairs: DataFrame) -> tuple[np.ndarray, int]:
    """(bits, their binary logarithm): the filter of these pairs, at most 2**MAX_FILTER_BITS bits."""
    bits = min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, (16 * pairs.count()).bit_length()))
    marks = pairs.select("lang", "gram").mapInArrow(_marks(bits), "word long, mask long")
    words = marks.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()  # 2**bits / 64 rows at most
    found = np.zeros((1 << bits) // 64, np.int64)
    found[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return found.view(np.uint8), bits


def counts(docs: DataFrame, least: int = LEAST, trigger: int = TRIGGER) -> tuple[DataFrame, DataFrame]:
    """((lang, gram, k, n) of all grams of 1 to 3 words with ``least`` occurrences, (lang, n) of all words)."""
    spark = docs.sparkSession
    parsed = staged(dictionary(docs, trigger), "phrase-parts")

    def total(grams: DataFrame) -> DataFrame:
        found = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        return found.select("lang", "gram", F.size(F.split("gram", " ")).alias("k"), "n")

    words = parsed.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    short = staged(total(parsed.mapInArrow(_short, GRAM)), "phrase-short")
    known, bits = _filter(short.filter("k = 2"))
    shared = spark.sparkContext.broadcast(known)
    triples = staged(total(parsed.mapInArrow(_triples(shared, bits), GRAM)), "phrase-triples")
    shared.destroy()
    return short.unionByName(triples), words


# ---- scores --------------------------------------------------------------------


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(grams: DataFrame, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, phrase, a, cut, l, r, score) of the candidates that no longer candidate covers, at their lowest cut."""
    phrases = grams.filter("k >= 2").select("lang", F.col("gram").alias("phrase"), "k", F.col("n").alias("a"))
    word = F.split("phrase", " ")
    inner = F.explode(F.array(_joined(word, 1, 2), _joined(word, 2, 2)))
    longer = phrases.filter("k = 3").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    left = phrases.filter("k = 2").join(longer, ["lang", "phrase"], "left")
    left = left.filter(F.col("longest").isNull() | (100 * F.col("longest") < covered_percent * F.col("a"))).drop("longest")
    cuts = left.unionByName(phrases.filter("k = 3")).select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _joined(word, 1, F.col("cut")).alias("head"), _joined(word, F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    heads = grams.filter("k < 3").select("lang", F.col("gram").alias("head"), F.col("n").alias("l"))
    rests = grams.filter("k < 3").select("lang", F.col("gram").alias("rest"), F.col("n").alias("r"))
    whole = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    a, l, r = (F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r"))
    whole = whole.withColumns({"up": F.lit(1_000_000).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)"), "down": (l * r).cast("decimal(37,0)")})
    lowest = F.min(F.struct(F.expr("up div down").alias("score"), F.col("cut").cast("long").alias("cut"), "l", "r")).alias("m")
    return whole.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "m.cut", "m.l", "m.r", "m.score")


def ranked(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language, with ``rank``."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.withColumn("rank", F.col("rank").cast("long")).drop("salt")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered_percent: int = COVERED_PERCENT, trigger: int = TRIGGER) -> DataFrame:
    """(lang, rank, phrase, a, cut, l, r, n, score): each language's best phrases of 2 to 3 words."""
    grams, words = counts(docs, least, trigger)
    best = ranked(scored(grams, covered_percent), top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "cut", "l", "r", "n", "score")
