"""Language identification with interpolated Kneser-Ney character models.

Text is read as letters (with their marks), lower-cased, with one space for
whatever stands between them. A model of order four is learned for each
language from all training documents: tasks count 4-grams, Spark adds the counts
up, and the lower orders follow from the distinct 4-grams, as Kneser-Ney's
continuation counts ask. Every order has one absolute discount from its counts
of ones and twos.

For scoring, the probabilities of all languages stand in matrices beside one sorted
array of gram hashes for each order. Spark folds the grams to hashes of at most ``HASH_BITS`` bits,
fewer where the model would have over ``MAX_CELLS`` cells, and only the folded table is fetched, so the
driver and the broadcast are bounded whatever the corpus; grams with the same hash add up.

A document's language has the lowest cross-entropy (nats a character over
the whole text). Calibration uses training documents that the counts left out: the
score is the share of right answers among calibration documents with as much
evidence (total log-likelihood ratio of the best two languages), made monotone;
a document is rejected if its cross-entropy exceeds what all but ``REJECT`` of the
calibration documents of its length class or a longer one stay under, by more than ``MARGIN``.

Roles by ``crc32(doc_id as text) mod 4``: 2 is held out, 3 calibrates, 0 and
1 are counted. lang, source and doc_id are no inputs of a prediction.

Null text and text without a letter: ``und``, score 0, rejected. A null
doc_id has no remainder: it is predicted, not learned from. Repeated rows count as
often as they stand there. With no training document everything is ``und``.
Equal cross-entropies fall to the first language in code-point order.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storepulse.llm.common import set_aside, staged
from storepulse.llm.shingles import mix

#: Production parameters.
ORDER = 4  # four characters of 16 bits make one 64-bit gram
HASH_BITS = 24
#: Distinct hashes x languages that the driver fetches at most; fewer hash bits beyond, not below the least.
MAX_CELLS = 1 << 24
MIN_BITS = 16
REJECT = 0.001
MARGIN = 1.0
UNKNOWN = "und"

BLOCK = 1 << 20
_SPACE = 32
_ALPHABET = 65536
_U = np.uint64
_EVIDENCE_BINS, _ENTROPY_BINS, _LENGTHS = 128, 400, 32
_ENTROPY_STEP = 0.05


# ---- text to grams ----------------------------------------------------------


def _kind(ch: str) -> tuple[int, bool]:
    """(16-bit code in the model's alphabet, whether it is a letter)."""
    category = unicodedata.category(ch)
    if category[0] not in "LM":
        return _SPACE, False
    code = ord(ch.lower()[0])
    return (code if code < _ALPHABET else 0xE000 + code % 6400), category[0] == "L"


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        kinds = [_kind(chr(c)) for c in range(_ALPHABET)]
        _TABLES["code"] = np.array([k[0] for k in kinds], np.uint16)
        _TABLES["letter"] = np.array([k[1] for k in kinds], bool)
    return _TABLES["code"], _TABLES["letter"]


def _codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    code, letter = _tables()
    far = raw >= _ALPHABET
    if not far.any():
        return code[raw], letter[raw]
    near = np.where(far, _SPACE, raw)
    codes, letters = code[near], letter[near]
    for c in np.unique(raw[far]):
        k = _kind(chr(c))
        codes[raw == c], letters[raw == c] = k
    return codes, letters


def _grams(codes: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """64-bit 4-grams that end at each place, oldest character in the top bits; spaces stand before the start."""
    out = codes.astype(_U)
    for k in range(1, ORDER):
        older = np.full(len(codes), _SPACE, _U)
        older[k:] = codes[:-k] if len(codes) > k else older[k:]
        older[offset < k] = _SPACE
        out |= older << _U(16 * k)
    return out


def gram_blocks(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, grams, bounds, letters): text ``first + i`` has ``grams[bounds[i]:bounds[i + 1]]`` and that many letters.

    A text of more than a block comes in several parts with the same number,
    each going on from the characters before it.
    """
    row = 0
    while row < len(texts):
        if len(texts[row] or "") > BLOCK:
            yield from _long_grams(row, texts[row])
            row += 1
            continue
        end, size = row, 0
        while end < len(texts) and size + len(texts[end] or "") <= BLOCK:
            size += len(texts[end] or "")
            end += 1
        part = [t or "" for t in texts[row:end]]
        codes, letters = _codes(" " + " ".join(part) + " ")
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
        keep[0] = False
        edges = np.cumsum([1, *(len(t) + 1 for t in part)])
        kept = np.concatenate(([0], np.cumsum(keep)))[edges]
        lettered = np.concatenate(([0], np.cumsum(letters)))[edges]
        codes = codes[keep]
        offset = np.arange(len(codes)) - np.repeat(kept[:-1], np.diff(kept))
        yield row, _grams(codes, offset), kept, np.diff(lettered)
        row = end


def _long_grams(row: int, text: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    tail = np.full(1, _SPACE, np.uint16)
    at = 0
    for start in range(0, len(text) + 1, BLOCK):
        piece = text[start : start + BLOCK] + (" " if start + BLOCK > len(text) else "")
        codes, letters = _codes(piece)
        codes = np.concatenate((tail, codes))
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
        codes = codes[keep]
        new = len(codes) - len(tail)
        grams = _grams(codes, np.arange(len(codes)) + (at - len(tail) if at else -1))[len(tail) :]
        yield row, grams, np.array([0, new]), np.array([int(letters.sum())])
        at += new
        tail = codes[-ORDER:]


# ---- learning ------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, gram, n), added up within the task."""
    waiting: dict[str, list] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([g for g, _ in waiting[lang]])
        counts = np.concatenate([c for _, c in waiting[lang]])
        keys, where = np.unique(grams, return_inverse=True)
        return keys, np.bincount(where, weights=counts).astype(np.int64)

    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            parts = waiting.setdefault(lang, [])
            for _, grams, _, _ in gram_blocks(texts):
                parts.append(np.unique(grams, return_counts=True))
                if sum(len(g) for g, _ in parts) > 1 << 22:
                    parts[:] = [merged(lang)]
    for lang in waiting:
        keys, counts = merged(lang)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)],
            names=["lang", "gram", "n"],
        )


def _shifted(gram: str) -> Column:
    """The context of a gram: all but its newest character."""
    return F.shiftrightunsigned(F.col(gram), 16)


def kneser_ney(counts: DataFrame) -> DataFrame:
    """4-gram counts by language -> (lang, size, kind, gram, value).

    kind ``a`` has the discounted share of a gram of ``size`` characters,
    kind ``b`` the weight that a context (``gram``, of ``size - 1``) gives
    to the shorter history.
    """
    tables, grams = [], counts
    one_context = Window.partitionBy("lang", "context")
    for size in range(ORDER, 0, -1):
        ones_twos = grams.groupBy("lang").agg(
            F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")
        )
        known = {r["lang"]: r["n1"] / max(r["n1"] + 2 * r["n2"], 1) for r in ones_twos.collect()}  # one row a language
        discounts = [F.lit(x) for lang, ratio in known.items() for x in (lang, min(max(ratio, 0.1), 0.95))]
        discount = F.element_at(F.create_map(*discounts), F.col("lang")) if known else F.lit(0.0)
        # A context has as many grams as the alphabet has characters, at most.
        in_context = grams.withColumn("context", _shifted("gram")).select(
            "lang", "gram", "n", "context", discount.alias("d"), F.sum("n").over(one_context).alias("total"),
            F.count(F.lit(1)).over(one_context).alias("kinds"), F.min("gram").over(one_context).alias("first"),
        )
        share = F.struct(F.lit("a").alias("kind"), F.col("gram"), ((F.col("n") - F.col("d")) / F.col("total")).alias("value"))
        weight = F.struct(
            F.lit("b").alias("kind"), F.col("context").alias("gram"), (F.col("d") * F.col("kinds") / F.col("total")).alias("value")
        )
        both = F.when(F.col("gram") == F.col("first"), F.array(share, weight)).otherwise(F.array(share))
        tables.append(in_context.select("lang", F.lit(size).alias("size"), F.inline(both)))
        mask = (1 << (16 * (size - 1))) - 1
        grams = grams.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        grams = staged(grams, "langid-grams") if size > 1 else grams
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


@dataclass
class Model:
    """Sorted hashes and, for each, the values of all languages, by gram size."""

    langs: list[str]
    bits: int
    shares: dict[int, tuple[np.ndarray, np.ndarray]]
    weights: dict[int, tuple[np.ndarray, np.ndarray]]

    def _rows(self, table: tuple[np.ndarray, np.ndarray], grams: np.ndarray, missing: float) -> np.ndarray:
        keys, values = table
        out = np.full((len(grams), len(self.langs)), missing)
        if len(keys):
            wanted = fold(grams, self.bits)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = keys[at] == wanted
            out[found] = values[at[found]]
        return out

    def probability(self, grams: np.ndarray) -> np.ndarray:
        """Probability, in each language, of the newest character of each gram after the older ones."""
        p = np.full((len(grams), len(self.langs)), 1.0 / _ALPHABET)
        for size in range(1, ORDER + 1):
            gram = grams & _U((1 << (16 * size)) - 1)
            p = self._rows(self.shares[size], gram, 0.0) + self._rows(self.weights[size], gram >> _U(16), 1.0) * p
        return p

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(characters read, letters, summed negative log-probability in each language) of each text."""
        read, lettered = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        cost = np.zeros((len(texts), len(self.langs)))
        for row, grams, bounds, letters in gram_blocks(texts):
            lengths, rows = np.diff(bounds), slice(row, row + len(letters))
            read[rows] += lengths
            lettered[rows] += letters
            full = np.flatnonzero(lengths)
            if not len(full) or not self.langs:
                continue
            distinct = np.unique(grams)
            nats = -np.log(self.probability(distinct))
            at = places(distinct, grams)
            for j in range(len(self.langs)):
                cost[row + full, j] += np.add.reduceat(nats[:, j][at], bounds[:-1][full])
        return read, lettered, cost


def fold(grams: np.ndarray, bits: int) -> np.ndarray:
    return mix(grams + _U(1)) >> _U(64 - bits)


def places(distinct: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Place of each gram in the sorted ``distinct``: by a small hash table, by search where two share a slot."""
    def slot(x: np.ndarray) -> np.ndarray:
        return ((x * _U(0x9E3779B97F4A7C15)) >> _U(43)).astype(np.int64)

    table = np.zeros(1 << 21, np.int32)
    table[slot(distinct)] = np.arange(len(distinct), dtype=np.int32)
    at = table[slot(grams)]
    wrong = np.flatnonzero(distinct[at] != grams)
    at[wrong] = np.searchsorted(distinct, grams[wrong])
    return at


def _fold_grams(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            j, size, kind, gram, value = batch.columns
            hashes = fold(gram.to_numpy(zero_copy_only=False).astype(np.int64).view(_U), bits)
            share = pa.array(np.asarray(kind.to_numpy(zero_copy_only=False) == "a", bool))
            hashes = pa.array(np.ascontiguousarray(hashes).astype(_U).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [j.cast(pa.int32()), size.cast(pa.int32()), share, hashes, value],
                names=["j", "size", "share", "hash", "value"],
            )

    return run


def build_model(table: DataFrame, langs: list[str], bits: int = HASH_BITS) -> Model:
    """Fetch the probability table, folded in Spark to as many hash bits (``bits`` at most) as keep it under ``MAX_CELLS``.

    Values that fall on one hash add up as whole numbers, so the model is the same in any order of the rows.
    """
    lang_no = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1 if langs else F.lit(0)
    table = staged(table.select(lang_no.alias("j"), "size", "kind", "gram", "value"), "langid-table")
    while True:
        folded = table.mapInArrow(_fold_grams(bits), "j int, size int, share boolean, hash long, value double")
        keys = folded.select("size", "share", "hash").distinct().count()
        if bits <= MIN_BITS or keys * max(1, len(langs)) <= MAX_CELLS:
            break
        bits -= max(1, math.ceil(math.log2(keys * max(1, len(langs)) / MAX_CELLS)))
        bits = max(bits, MIN_BITS)
    together = F.least(F.lit(1.0), F.sum(F.round(F.col("value") * 2.0**40).cast("long")) / 2.0**40)
    value = F.when(F.count(F.lit(1)) == 1, F.max("value")).otherwise(together)
    rows = folded.groupBy("j", "size", "share", "hash").agg(value.alias("value")).toArrow()
    column = {c: rows.column(c).to_numpy() for c in ("j", "size", "value")}
    is_share = np.asarray(rows.column("share").to_numpy(zero_copy_only=False), bool)
    hashes = rows.column("hash").to_numpy().astype(np.int64).view(_U)
    made: list[dict] = []
    for kind, missing in ((is_share, 0.0), (~is_share, 1.0)):
        by_size = {}
        for size in range(1, ORDER + 1):
            own = np.flatnonzero(kind & (column["size"] == size))
            keys, at = np.unique(hashes[own], return_inverse=True)
            values = np.full((len(keys), max(1, len(langs))), missing)
            values[at, column["j"][own]] = column["value"][own]
            by_size[size] = (keys, values[:, : len(langs)])
        made.append(by_size)
    return Model(langs, bits, made[0], made[1])


# ---- calibration and prediction ---------------------------------------------------


def _judged(read: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language, evidence in nats against the next one, cross-entropy a character)."""
    best = cost.argmin(axis=1)
    ordered = np.sort(cost, axis=1)
    evidence = ordered[:, 1] - ordered[:, 0] if cost.shape[1] > 1 else read.astype(np.float64)
    return best, evidence, ordered[:, 0] / np.maximum(read, 1)


def _evidence_bin(evidence: np.ndarray) -> np.ndarray:
    return np.minimum(8 * np.log2(1 + evidence), _EVIDENCE_BINS - 1).astype(np.int64)


def _length_class(read: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(read, 1)), _LENGTHS - 1).astype(np.int64)


def _calibrate(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros((_EVIDENCE_BINS, 2), np.int64)
        spread = np.zeros((_LENGTHS, _ENTROPY_BINS), np.int64)
        own = Model(*model.value)
        number = {x: j for j, x in enumerate(own.langs)}
        for batch in batches:
            read, letters, cost = own.entropies(batch.column(1).to_pylist())
            truth = np.array([number.get(x, -1) for x in batch.column(0).to_pylist()])
            some = letters > 0
            best, evidence, entropy = _judged(read[some], cost[some])
            ok = best == truth[some]
            np.add.at(right, (_evidence_bin(evidence), ok.astype(np.int64)), 1)
            bins = np.minimum(entropy[ok] / _ENTROPY_STEP, _ENTROPY_BINS - 1).astype(np.int64)
            np.add.at(spread, (_length_class(read[some][ok]), bins), 1)
        for what, table in (("right", right), ("spread", spread)):
            a, b = np.nonzero(table)
            yield pa.RecordBatch.from_pydict({"what": [what] * len(a), "a": a, "b": b, "n": table[a, b]})

    return run


def _tables_of(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """(score for each evidence bin, highest accepted cross-entropy for each length class)."""
    right = np.zeros((_EVIDENCE_BINS, 2))
    spread = np.zeros((_LENGTHS, _ENTROPY_BINS))
    for r in rows:
        (right if r["what"] == "right" else spread)[r["a"], r["b"]] += r["n"]
    # At least as sure as with less evidence; a bin without documents adds nothing.
    score = np.maximum.accumulate((right[:, 1] + 0.5) / (right.sum(axis=1) + 1))
    limit = np.full(_LENGTHS, np.inf)
    at_least = np.cumsum(spread[::-1], axis=0)[::-1]  # documents of this length class or a longer one
    for k in range(_LENGTHS):
        total = at_least[k].sum()
        if total:
            under = np.searchsorted(np.cumsum(at_least[k]), (1 - REJECT) * total)
            limit[k] = (under + 1) * _ENTROPY_STEP + MARGIN
        elif k:
            limit[k] = limit[k - 1]  # longer than any calibration document
    return score, np.maximum.accumulate(limit[::-1])[::-1]


_RESULT = ("lang_pred", "score", "cross_entropy", "rejected", "held_out")


def _predict(model, score: np.ndarray, limit: np.ndarray, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*model.value)
        langs = own.langs
        for batch in batches:
            read, letters, cost = own.entropies(batch.column(text).to_pylist())
            found = (letters > 0) & bool(langs)
            if langs:
                best, evidence, entropy = _judged(read, cost)
                named = [langs[b] if ok else UNKNOWN for b, ok in zip(best, found, strict=True)]
                sure = np.where(found, score[_evidence_bin(evidence)], 0.0)
                rejected = ~found | (entropy > limit[_length_class(read)])
            else:
                named, sure, entropy, rejected = [UNKNOWN] * len(read), np.zeros(len(read)), np.zeros(len(read)), ~found
            new = [
                pa.array(named, pa.string()),
                pa.array(sure, pa.float64()),
                pa.array(entropy, pa.float64(), mask=~found),
                pa.array(rejected, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *_RESULT[:4]])

    return run


def role(doc_id: str = "doc_id") -> Column:
    """``crc32(doc_id as text) mod 4``; null for a null doc_id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def identify(docs: DataFrame, hash_bits: int = HASH_BITS) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy, rejected and held_out; same-named input columns are replaced."""
    spark = docs.sparkSession
    rows = docs.drop(*[c for c in docs.columns if c.lower() in _RESULT])
    labelled = docs.filter("lang is not null").select("lang", "text", role().alias("role"))
    counted = labelled.filter("role in (0, 1)").select("lang", "text")
    counts = counted.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = staged(counts, "langid-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    learned = build_model(kneser_ney(counts), langs, hash_bits)
    model = spark.sparkContext.broadcast((learned.langs, learned.bits, learned.shares, learned.weights))
    seen = labelled.filter("role = 3").select("lang", "text").mapInArrow(_calibrate(model), "what string, a long, b long, n long")
    bins = seen.groupBy("what", "a", "b").agg(F.sum("n").alias("n")) if langs else seen.limit(0)
    score, limit = _tables_of(bins.collect())  # at most the bins of two histograms
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema += ", lang_pred string, score double, cross_entropy double, rejected boolean"
    return rows.mapInArrow(_predict(model, score, limit, "text"), schema).withColumn(
        "held_out", F.coalesce(role() == 2, F.lit(False))
    )


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they were, whose language is not rejected."""
    rows, columns = set_aside(docs, _RESULT)
    return identify(rows).filter(~F.col("rejected")).select(*columns)
