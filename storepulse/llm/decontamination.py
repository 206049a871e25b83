"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts are normalised to words, cut into windows (``WINDOW``
consecutive words; a shorter item is one window) and put into one automaton.
Every document is normalised the same way, byte for byte, so a place in the normalised
text is the same place in the original, and scanned once.

The automaton is built from the broadcast items, once in each worker process. Its size is
checked first: items are dealt to as many automata as keep each under
``MAX_WORDS`` words, and the frame is written out between the scans. With the usual
benchmark that is one automaton and one scan.

Nulls: null text has no words, no hits and is not contaminated. A null
item_id takes part under the empty name. Repeated items count once. Documents
are never compared with each other, so repeated rows and ties need no rule. An
empty benchmark hits nothing. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.common import free_name, set_aside, staged

#: Production parameters.
WINDOW = 10
#: Benchmark words in one automaton: each costs about 3 kB of a Python worker's memory (measured: 294 MB for 100,000).
MAX_WORDS = 100_000

_RESULT = {"n_words", "n_hit", "n_items", "items", "spans", "contaminated"}
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: After lower-casing: bytes of words stay, all others become a space.
_TO_WORDS = bytes(b if b in _KEPT else 0x20 for b in range(256))


def _clean(text: str) -> bytes:
    """Lower-cased bytes of the text with a space at each byte outside words; as long as its UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_TO_WORDS)


def item_windows(text: str | None, window: int = WINDOW) -> set[str]:
    words = _clean(text or "").decode("latin-1").split(" ")
    words = [w for w in words if w]
    if not words:
        return set()
    return {" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def build_automaton(items: list[tuple[str, str]], window: int = WINDOW) -> ahocorasick.Automaton:
    """Automaton over `` w1 w2 ... `` (spaces at both ends); a value is (length in bytes, words, item names)."""
    owners: dict[str, set[str]] = {}
    for name, text in items:
        for w in item_windows(text, window):
            owners.setdefault(w, set()).add(name)
    automaton = ahocorasick.Automaton()
    for w, names in owners.items():
        automaton.add_word(f" {w} ", (w.count(" ") + 1, tuple(sorted(names))))
    if owners:
        automaton.make_automaton()
    return automaton


def scan(text: str, automaton: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(number of words, hit runs as [first word, last word] in order without overlap, names of items)."""
    words = _clean(text).split()
    if not words or not len(automaton):
        return len(words), [], set()
    line = " " + b" ".join(words).decode("latin-1") + " "
    runs: list[tuple[int, int]] = []
    names: set[str] = set()
    seen, at = 0, 0  # words that end before position ``at``
    for end, (n, owners) in automaton.iter(line):
        seen += line.count(" ", at, end)
        at = end
        names.update(owners)
        runs.append((seen - n, seen - 1))
    return len(words), _union(runs), names


def _union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point spans [start, end) in the original text of runs of words."""
    if not runs:
        return []
    clean = _clean(text)
    bounds, at = [], 0
    for w in clean.split():
        at = clean.index(w, at)
        bounds.append((at, at + len(w)))
        at += len(w)
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) == len(text):
        return [(bounds[a][0], bounds[b][1]) for a, b in runs]
    starts = [i for i, byte in enumerate(raw) if byte & 0xC0 != 0x80]
    return [(bisect.bisect_left(starts, bounds[a][0]), bisect.bisect_left(starts, bounds[b][1])) for a, b in runs]


_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scanner(items, window: int, names: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = getattr(items, "automaton", None)  # a worker process builds it once and keeps it with the broadcast
        if automaton is None:
            automaton = items.automaton = build_automaton(items.value, window)
        for batch in batches:
            n, hits, owners, spans = [], [], [], []
            before = zip(batch.column(names["runs"]).to_pylist(), batch.column(names["items"]).to_pylist(), strict=True)
            for text, (old_runs, old_names) in zip(batch.column("text"), before, strict=True):
                text = text.as_py()
                count, runs, found = scan(text, automaton) if text is not None else (0, [], set())
                if old_runs:
                    runs = _union(runs + [(r["first"], r["last"]) for r in old_runs])
                n.append(count)
                hits.append([{"first": a, "last": b} for a, b in runs])
                owners.append(sorted(found.union(old_names or ())))
                spans.append([{"start": a, "end": b} for a, b in original_spans(text or "", runs)])
            new = {
                names["n"]: pa.array(n, pa.int64()),
                names["runs"]: pa.array(hits, _RUNS),
                names["items"]: pa.array(owners, pa.list_(pa.string())),
                names["spans"]: pa.array(spans, _SPANS),
            }
            yield pa.RecordBatch.from_arrays(
                [new.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)], names=batch.schema.names
            )

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items (names), spans (code points of the original) and contaminated."""
    spark = docs.sparkSession
    rows = docs.drop(*[c for c in docs.columns if c.lower() in _RESULT])
    # Letters of an item bound its words: at least one character and one separator each.
    item = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").filter("text is not null")
    size = item.select(F.octet_length("text").alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0] // 2
    parts = max(1, -(-size // max_words))
    item = item.distinct().withColumn("part", F.pmod(F.xxhash64("name", "text"), F.lit(parts)))
    names = {k: free_name(rows, f"_{k}") for k in ("n", "runs", "items", "spans")}
    out = rows.withColumns({
        names["n"]: F.lit(0).cast("long"),
        names["runs"]: F.array().cast("array<struct<first:bigint,last:bigint>>"),
        names["items"]: F.array().cast("array<string>"),
        names["spans"]: F.array().cast("array<struct<start:bigint,end:bigint>>"),
    })
    schema = out.schema
    for part in range(parts):
        if part:
            out = staged(out, "leaks")
        some = [(r["name"], r["text"]) for r in item.filter(F.col("part") == part).collect()]
        out = out.mapInArrow(_scanner(spark.sparkContext.broadcast(some), window, names), schema)
    runs, found = F.col(names["runs"]), F.col(names["items"])
    n_hit = F.aggregate(runs, F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"] + 1)
    return (
        out.withColumn("n_words", F.col(names["n"]))
        .withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size(found).cast("long"))
        .withColumn("items", found)
        .withColumn("spans", F.col(names["spans"]))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop(*names.values())
    )


def items_digest(items: str = "items"):
    """SHA-256 of the item names, sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", F.sort_array(items)), 256)



def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they were, in which no benchmark window occurs."""
    rows, columns = set_aside(docs, _RESULT)
    return find_leaks(rows, benchmark).filter(~F.col("contaminated")).select(*columns)
