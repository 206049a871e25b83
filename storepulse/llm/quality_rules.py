"""Quality rules kept as a bitmask ledger.

* ``ledger`` reads every text once. It stores what was measured and, in one
  long, a bit for each rule that the text fails (``RULES``, all of them exact integer
  comparisons of measurements).
* A policy (``POLICIES``) is a version with two masks: a row goes if it fails any
  rule of ``must``, or more than ``spare`` of ``may``. ``apply_policy`` needs the
  ledger alone, so a new version reads no text again.
* ``ablations`` counts the rows of each distinct bit pattern, at most
  ``2 ** len(RULES)`` of them, and answers from those counts what every rule
  does in every policy: how many rows fail it, go because of it alone, and
  would stay without it.

Words are runs without ASCII white space. A window is repeated if its eight
words stand at another place of the same text too, in the same letter case;
windows are compared as 64-bit hashes of their words within one text. Null text has
no words, so it fails the rule on few words. Documents are never compared with each other:
ties and repeated rows need no rule, and a row of the input is a row of the
ledger. Input columns other than the text stay, and results replace those of
the same name. An empty table gives an empty ledger and no ablation rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in a window whose repetition is measured.
WINDOW = 8

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_letters", "n_capitals", "n_shouts", "n_plain_words",
)

_SPACE = b" \t\n\x0b\x0c\r"
_TAIL = bytes(range(0x80, 0xC0))
_NOT_LETTER = bytes(b for b in range(0x80) if not chr(b).isalpha())
_DIGITS_AND_MARKS = _NOT_LETTER.translate(None, _SPACE)


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements, an integer comparison, so that it is exact everywhere."""

    name: str
    fails: str


#: The place of a rule is its bit, so rules are only ever appended.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("symbols", "2 * n_symbols > n_words"),
    Rule("repeated_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("capitals", "n_letters >= 40 and 100 * n_capitals > 70 * n_letters"),
    Rule("shouts", "n_words >= 20 and 100 * n_shouts > 60 * n_words"),
    Rule("wordless", "100 * n_plain_words < 50 * n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Failing any rule of ``must``, or more than ``spare`` rules of ``may``, drops a row."""

    version: str
    must: frozenset[str]
    may: frozenset[str] = frozenset()
    spare: int = 0

    def mask(self, names: frozenset[str]) -> int:
        return sum(BIT[n] for n in names)


BASE = frozenset({"few_words", "repeated_windows"})
POLICIES = (
    Policy("1-base", BASE),
    Policy("2-text", BASE | {"short_words", "long_words", "symbols", "wordless"}),
    Policy("3-all", BASE | {"short_words", "long_words", "symbols", "wordless"}, frozenset({"repeated_lines", "capitals", "shouts"}), 1),
)
CURRENT = POLICIES[-1]


# ---- measurements -----------------------------------------------------------


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window found twice or more, its first place included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[k : k + n]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    edge[at] += 1
    edge[at + window] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # bytes are split at ASCII white space only
    points = data.translate(None, _TAIL)  # one byte for each code point
    lines = [line for line in data.split(b"\n") if line.strip(_SPACE)]
    letters = points.translate(None, _NOT_LETTER)
    return (
        len(words),
        len(points.translate(None, _SPACE)),
        len(data) - len(data.translate(None, b"#*$%&|<>")),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(letters),
        sum(map(letters.count, (b"%c" % c for c in range(0x41, 0x5B)))),
        data.count(b"!") + data.count(b"?"),
        len([w for w in words if w.translate(None, _DIGITS_AND_MARKS)]),
    )


def _measured(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t.as_py()) for t in batch.column(at)], np.int64).reshape(-1, len(MEASURES))
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(found[:, i]) for i in range(len(MEASURES)))],
                names=[*(n for i, n in enumerate(batch.schema.names) if i != at), *MEASURES],
            )

    return run


# ---- ledger, policies, ablations ---------------------------------------------


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with the measurements and the failure bits ``fails``."""
    docs = docs.select(*[c for c in docs.columns if c.lower() not in {*MEASURES, "fails"}])
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{m} long" for m in MEASURES)])
    return docs.mapInArrow(_measured(docs.columns.index("text")), schema).withColumn("fails", failure_bits())


def dropped(fails: Column, policy: Policy, without: Column | None = None) -> Column:
    """Whether the policy drops a row of these bits, the rules in ``without`` switched off."""
    if without is not None:
        fails = fails.bitwiseAND(F.bitwise_not(without))
    must = fails.bitwiseAND(F.lit(policy.mask(policy.must)).cast("long")) != 0
    may = F.bit_count(fails.bitwiseAND(F.lit(policy.mask(policy.may)).cast("long"))) > policy.spare
    return must | (may if policy.may else F.lit(False))


def apply_policy(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with ``policy`` (its version) and ``kept``."""
    return rows.withColumns({"policy": F.lit(policy.version), "kept": ~dropped(F.col("fails"), policy)})


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """(policy, rule, n_rows, n_failing, n_kept, n_alone, n_kept_without) for every rule of every policy.

    n_alone: rows that go, and would stay if this rule were switched off.
    """
    patterns = rows.groupBy("fails").agg(F.count(F.lit(1)).alias("n"))  # at most 2 ** len(RULES) rows
    each = []
    for policy in policies:
        names = [r.name for r in RULES if r.name in policy.must | policy.may]
        rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("long").alias("bit")) for n in names]))
        out, out_without = dropped(F.col("fails"), policy), dropped(F.col("fails"), policy, F.col("r.bit"))

        def total(which: Column) -> Column:
            return F.sum(F.when(which, F.col("n")).otherwise(F.lit(0)))

        each.append(
            patterns.withColumn("r", rule).groupBy(F.lit(policy.version).alias("policy"), F.col("r.rule").alias("rule")).agg(
                F.sum("n").alias("n_rows"),
                total(F.col("fails").bitwiseAND(F.col("r.bit")) != 0).alias("n_failing"),
                total(~out).alias("n_kept"),
                total(out & ~out_without).alias("n_alone"),
                total(~out_without).alias("n_kept_without"),
            )
        )
    found = each[0]
    for more in each[1:]:
        found = found.unionByName(more)
    return found


def base_failed() -> Column:
    """Whether a row of the ledger fails a rule of the base policy."""
    return dropped(F.col("fails"), POLICIES[0])
