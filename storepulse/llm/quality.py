"""Quality classifier from weak labels.

1. Eight heuristic labellers look at every whole text and vote good, bad or abstain.
2. The votes of all documents are counted by pattern (at most ``4**8`` patterns), and
   expectation-maximisation estimates from the counts how often each labeller
   gives each vote on good and on bad documents, and the share of good ones; no
   labelled row is needed. Each pattern gets the posterior probability of good.
3. The posteriors label a seeded sample of about ``SAMPLE`` documents, on which a
   logistic regression over hashed features is trained: word shapes,
   pairs of shapes, words, repetition and length classes.
4. Every document gets the scorer's probability; ``keep`` from ``KEEP`` on.

Null and word-less texts have only abstentions, score 0 and are not kept. Repeated rows
count and score as often as they stand there. An empty table gives no rows.
Extra columns pass through; result columns replace those of the same name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.common import seeded_hash, staged

#: Production parameters.
SAMPLE = 8000
FEATURE_BITS = 14
KEEP = 0.3
SEED = 1
ROUNDS = 60
EPOCHS = 6

#: A vote; nothing to say; too little text to look at, which is no evidence.
_GOOD, _BAD, _NONE, _BLIND = "g", "b", "-", "."
_RESULT = ("votes", "posterior", "score", "keep")
_SYMBOLS = re.compile(r"([!#$%&*=~^_+<>-])\1+")


def _vote(looks: bool, good: bool, bad: bool) -> str:
    return _BLIND if not looks else _BAD if bad else _GOOD if good else _NONE


LABELLERS = ("prose pairs", "repetition", "variety", "symbols", "bars", "capitals", "letters", "sentences")


_EDGES = ".,;:?!\"'()¿¡"


def _look(word: str) -> tuple[bool, int, int, int]:
    """(plain, letters, capitals, length) of a word."""
    core = word.strip(_EDGES)
    alpha = core.isalpha()
    plain = alpha and not (len(word) > 2 and word.endswith(("!!", "??", ",,")))
    letters = len(core) if alpha else sum(map(str.isalpha, word))
    return plain, letters, 0 if word.islower() else sum(map(str.isupper, word)), len(word)


_RUN = re.compile(r"(.)\1+")


class _Kinds(dict):
    """Translation of characters: x for letters, X for capitals, 9 for digits, the rest as they are."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        kind = self[code] = "X" if ch.isupper() else "x" if ch.isalpha() else "9" if ch.isdigit() else ch
        return kind


_KINDS = _Kinds()


def shapes_of(text: str) -> list[str]:
    """Letters, capitals, digits and signs of each word; a repeated one stands twice."""
    return _RUN.sub(r"\1\1", text.translate(_KINDS)).split()


def _crcs(text: str) -> Iterator[int]:
    """CRC-32 of each lower-cased run without ASCII white space."""
    return map(zlib.crc32, text.lower().encode("utf-8", "surrogatepass").split())


_PLAIN, _LETTERS, _CAPITALS, _LENGTH, _SHAPE, _CRC = range(6)


class Words(dict):
    """Numbers of words, and in ``known[number]`` what a look at the word found; starts again when it has grown large.

    Without ``scored``, shapes and checksums, which only the features need, stay 0.
    """

    def __init__(self, scored: bool):
        super().__init__()
        self.scored, self.known, self.new = scored, np.zeros((1024, 6), np.int64), []
        self.shapes, self.pair_slots = {"": 0}, {}

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self) > 200_000 or len(self.pair_slots) > 200_000:
            self.clear()
            self.shapes, self.pair_slots = {"": 0}, {}
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            if len(self) > len(self.known):
                self.known = np.concatenate((self.known, np.zeros((len(self), 6), np.int64)))
            rows = self.known[len(self) - len(self.new) : len(self)]
            rows[:, :_SHAPE] = list(map(_look, self.new))
            if self.scored:
                text = " ".join(self.new)
                rows[:, _SHAPE] = [self.shapes.setdefault(x, len(self.shapes)) for x in shapes_of(text)]
                rows[:, _CRC] = list(_crcs(text))
            self.new.clear()
        return numbers

    def pair_slot(self, pair: int, bits: int) -> int:
        slot = self.pair_slots.get(pair)
        if slot is None:
            names = list(self.shapes)
            slot = self.pair_slots[pair] = _slot(f"s:{names[pair >> 32]}:{names[pair & 0xFFFFFFFF]}", bits)
        return slot


def votes(text: str | None, numbers: np.ndarray, known: np.ndarray) -> str:
    """One character for each of ``LABELLERS``. Those that look for one fault abstain where they don't find it."""
    n = len(numbers)
    if not n:
        return _BLIND * len(LABELLERS)
    plain, same = known[:, _PLAIN] > 0, numbers[1:] == numbers[:-1]
    again = int(np.count_nonzero(same))
    pairs = int(np.count_nonzero(plain[1:] & plain[:-1] & ~same))
    in_block = np.sort(numbers | np.arange(n) // 50 << 32)
    variety = int(1 + np.count_nonzero(in_block[1:] != in_block[:-1])) / n
    _, letters, capitals, lengths, *_ = known.sum(axis=0).tolist()
    ends = sum(map(text.count, (". ", ".\n", "! ", "? ")))
    return "".join((
        _vote(n > 4, pairs > 0.85 * (n - 1), n >= 12 and pairs < 0.6 * (n - 1)),
        _vote(n > 4, False, again > 0.15 * n),
        _vote(n >= 12, variety > 0.7, variety < 0.45),
        _vote(n > 4, False, len(_SYMBOLS.findall(text)) > 0.15 * n),
        _vote(n > 4, False, text.count("|") > 0.05 * n),
        _vote(n > 4, False, capitals > 0.6 * max(1, letters)),
        _vote(n >= 30, False, letters < 0.75 * lengths),
        _vote(n >= 40, 0.02 * n < ends < 0.4 * n, ends < 0.004 * n),
    ))


# ---- expectation-maximisation ----------------------------------------------------


def estimate(patterns: dict[str, int], rounds: int = ROUNDS) -> tuple[np.ndarray, float, dict[str, float]]:
    """(chance of each vote: class (bad, good) x labeller x (good, bad, abstain), share of good, posterior by pattern).

    Starts from the majority of votes (good where nothing speaks against it)
    and adds one document of each kind to every count, so that no chance is
    zero. Where a labeller has too little text it is left out.
    """
    names = sorted(patterns)
    if not names:
        return np.zeros((2, 0, 3)), 0.5, {}
    weight = np.array([patterns[p] for p in names], float)
    onehot = np.array([[[ch == v for v in (_GOOD, _BAD, _NONE)] for ch in p] for p in names], float)
    balance = 0.5 + onehot[:, :, 0].sum(axis=1) - onehot[:, :, 1].sum(axis=1)
    posterior = 1 / (1 + np.exp(-2 * balance))
    for _ in range(rounds):
        chances = np.stack([np.einsum("p,plv->lv", weight * share, onehot) + 1 for share in (1 - posterior, posterior)])
        chances /= chances.sum(axis=2, keepdims=True)
        good = (weight @ posterior + 1) / (weight.sum() + 2)
        log = np.einsum("plv,clv->pc", onehot, np.log(chances)) + np.log([1 - good, good])
        posterior = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
    return chances, float(good), dict(zip(names, posterior.tolist(), strict=True))


# ---- hashed linear scorer -------------------------------------------------------------

_SPACES = " \t\n\r\x0b\x0c"


def _slot(feature: str, bits: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (1 << bits) - 1


def features(text: str, seen: Words, numbers: np.ndarray, known: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): each kind of feature has length one, so that long texts weigh no more."""
    n = len(numbers)
    shapes = known[:, _SHAPE]
    before = np.concatenate(([0], shapes[:-1]))
    kinds, first, counts = np.unique(before << 32 | shapes, return_index=True, return_counts=True)
    order = np.argsort(first)
    pairs: dict[int, int] = {}
    for pair, count in zip(kinds[order].tolist(), counts[order].tolist(), strict=True):
        slot = seen.pair_slot(pair, bits)
        pairs[slot] = pairs.get(slot, 0) + count
    same = int(np.count_nonzero(numbers[1:] == numbers[:-1])) / n
    if len(text) - int(known[:, _LENGTH].sum()) == sum(map(text.count, _SPACES)):
        own = known[:, _CRC]
    else:  # words of this feature end at ASCII white space only
        own = np.fromiter(_crcs(text), np.int64)
    parts = [
        np.unique(own & (1 << bits) - 1, return_counts=True),
        (np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))),
        (np.array([_slot(f"r:{int(same * 10)}", bits)]), np.ones(1)),
        (np.array([_slot(f"v:{int(10 * len(np.unique(numbers)) / n)}:{min(n, 1000).bit_length()}", bits)]), np.ones(1)),
    ]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] / max(1e-9, np.sqrt(float(p[1] @ p[1]))) for p in parts])


class Reader:
    """Votes and, if ``scored``, features of texts; remembers words and, bounded too, pairs of shapes."""

    def __init__(self, bits: int, scored: bool = True):
        self.bits, self.seen = bits, Words(scored)

    def votes(self, text: str | None) -> str:
        numbers = self.seen.numbers((text or "").split())
        return votes(text, numbers, self.seen.known[numbers])

    def __call__(self, text: str | None) -> tuple[str, np.ndarray, np.ndarray]:
        numbers = self.seen.numbers((text or "").split())
        known = self.seen.known[numbers]
        if not len(numbers):
            return votes(text, numbers, known), np.zeros(0, np.int64), np.zeros(0)
        return votes(text, numbers, known), *features(text, self.seen, numbers, known, self.bits)


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], bits: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (and, last, the bias) of a logistic regression on soft labels, by AdaGrad; both classes weigh the same."""
    weights, squares = np.zeros((1 << bits) + 1), np.full((1 << bits) + 1, 1e-6)
    good = sum(y for _, _, y in rows)
    scale = [len(rows) / (2 * max(1.0, x)) for x in (len(rows) - good, good)]
    order = np.random.default_rng(SEED)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            slots, values, y = rows[i]
            p = 1 / (1 + np.exp(-np.clip(weights[slots] @ values + weights[-1], -30, 30)))
            step = (p - y) * (y * scale[1] + (1 - y) * scale[0])
            for at, g in ((slots, step * values + 1e-6 * weights[slots]), (np.array([-1]), np.array([step]))):
                squares[at] += g * g
                weights[at] -= 0.1 * g / np.sqrt(squares[at])
    return weights


# ---- Spark ---------------------------------------------------------------------------


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = Reader(FEATURE_BITS, scored=False)
    for batch in batches:
        made = pa.array([read.votes(t) for t in batch.column(0).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([made], names=["votes"])


def _feature_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(bits)
        for batch in batches:
            made = [read(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.list_(pa.int64())),
                    pa.array([m[2] for m in made], pa.list_(pa.float64())),
                ],
                names=["votes", "slots", "values"],
            )

    return run


def _score_rows(weights, posteriors, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, w = Reader(bits), weights.value
        for batch in batches:
            patterns, scores = [], []
            for text in batch.column("text").to_pylist():
                pattern, slots, values = read(text)
                patterns.append(pattern)
                scores.append(float(1 / (1 + np.exp(-np.clip(w[slots] @ values + w[-1], -30, 30)))) if len(slots) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(patterns, pa.string()),
                    pa.array([posteriors.value[p] for p in patterns], pa.float64()), pa.array(scores, pa.float64()),
                ],
                names=[*batch.schema.names, "votes", "posterior", "score"],
            )

    return run


def classify(docs: DataFrame, sample: int = SAMPLE, bits: int = FEATURE_BITS, keep: float = KEEP) -> DataFrame:
    """``docs`` with votes, posterior, score and keep."""
    spark = docs.sparkSession
    rows = docs.drop(*[c for c in docs.columns if c.lower() in _RESULT])
    hashed = docs.select("text", seeded_hash(SEED, "doc_id").alias("h"))
    voted = staged(docs.select("text").mapInArrow(_vote_rows, "votes string"), "quality-votes")
    counted = voted.groupBy("votes").count().collect()  # at most 4**8 patterns
    _, _, posteriors = estimate({r["votes"]: r["count"] for r in counted})
    total = sum(r["count"] for r in counted)
    # About ``sample`` rows, chosen by hash; taken by it, so their number is bounded.
    share = min(1.0, sample / max(1, total))
    chosen = hashed.filter(F.col("h") < int(share * (1 << 60))).mapInArrow(
        _feature_rows(bits), "votes string, slots array<long>, values array<double>"
    )
    taken = []
    for batch in chosen.limit(2 * sample).toArrow().to_batches():  # the limit only holds if ids repeat
        votes_of, slots, values = batch.columns
        bounds = slots.offsets.to_numpy()
        flat = slots.values.to_numpy(), values.values.to_numpy()
        for i, p in enumerate(votes_of.to_pylist()):
            if bounds[i] < bounds[i + 1]:
                taken.append((flat[0][bounds[i] : bounds[i + 1]], flat[1][bounds[i] : bounds[i + 1]], posteriors[p]))
    weights = spark.sparkContext.broadcast(train(taken, bits))
    shared = spark.sparkContext.broadcast(posteriors)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    scored = rows.mapInArrow(_score_rows(weights, shared, bits), f"{schema}, votes string, posterior double, score double")
    return scored.withColumn("keep", F.col("score") >= keep)
