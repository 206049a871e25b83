"""Splittable reading of one large JSON document: an array of records, or an envelope around one.

A response of many gigabytes is one JSON document, often on one line, and
``multiLine`` reading gives it to one task. Here its bytes are split:

* The file is read as text that ends "lines" at ``}``, which Spark splits by byte ranges like
  any text. A piece is what stands between two closing braces.
* Whether a piece lies inside a string, and how deep, depends on all before
  it, but the dependence composes: a block (byte range) maps the state at its start to that at its end.
  A first pass sums each block up for both cases, starting inside a string and
  outside of it: how the case ends, how much deeper, and the lowest depth between.
* The blocks of a file, one small row each, are chained in order, which gives
  every block its starting state.
* A second pass knows that state, so each block finds its own records: a record ends with
  a brace that comes back to the depth of the array. What a block holds before its first
  end and behind its last one is part of a record that other blocks share;
  those parts (two a block at most) are put together by a shuffle.

A record is never larger in memory than itself, and blocks run in parallel
whatever the number of files. Text behind the end of the array is ignored. A file that is
not such a document, an envelope without its list, and a file that ends within the
array are errors: the fetch failed.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_OPEN_OR_CLOSE = re.compile(r"[\[\]{}]")
_BLOCK = "file string, block long"
_SUMMARY = f"{_BLOCK}, string0 boolean, depth0 long, low0 long, string1 boolean, depth1 long, low1 long"
_FOUND = f"{_BLOCK}, kind int, ended boolean, text string"
#: Kinds of text found: a whole record, the part before a block's first end, the part behind its last.
_WHOLE, _HEAD, _TAIL = 0, 1, 2


def _start(result: str | None) -> tuple[re.Pattern, int]:
    """(what the document begins with, depth of the array)."""
    if result is None:
        return re.compile(r"\ufeff?\s*\["), 1
    return re.compile(rf'\ufeff?\s*\{{\s*"data"\s*:\s*\{{\s*"{re.escape(result)}"\s*:\s*\['), 3


def _spans(text: str, inside: bool) -> Iterator[str]:
    """The stretches of a piece outside of strings, given whether it begins inside one."""
    for part in (_ESCAPED.sub("", text) if "\\" in text else text).split('"'):
        if not inside:
            yield part
        inside = not inside


def _walk(text: str, inside: bool) -> tuple[bool, int, int]:
    """(inside a string at the end, depth gained, lowest depth on the way) of a piece and its closing brace."""
    quotes = (_ESCAPED.sub("", text) if "\\" in text else text).count('"')
    depth = low = 0
    for span in _spans(text, inside):
        for mark in _OPEN_OR_CLOSE.findall(span):
            depth += 1 if mark in "[{" else -1
            low = min(low, depth)
    inside ^= quotes % 2 == 1
    if not inside:
        depth -= 1
        low = min(low, depth)
    return inside, depth, low


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, tuple, Iterator[str]]]:
    """(file, block, its further columns, its pieces), blocks one after another as the task reads them."""
    rows = (tuple(c.as_py() for c in row) for batch in batches for row in zip(*batch.columns, strict=True))
    row = next(rows, None)
    while row is not None:
        key, more = row[:2], row[3:]

        def pieces() -> Iterator[str]:
            nonlocal row
            while row is not None and row[:2] == key:
                text = row[2]
                row = next(rows, None)
                yield text

        yield *key, more, pieces()
        while row is not None and row[:2] == key:  # what the caller left
            row = next(rows, None)


def _bare(file: str, block: int, pieces: Iterator[str], start: re.Pattern) -> Iterator[str]:
    """Pieces without the beginning of the document, which the first block must have."""
    if block == 0:
        held = ""
        for piece in pieces:  # an envelope's beginning has no closing brace, so it is within the first piece
            held = piece
            break
        found = start.match(held)
        if not found:
            raise ValueError(f"{file}: no list of records where one should begin; the fetch failed")
        yield held[found.end() :]
    yield from pieces


def _summed(start: re.Pattern):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for file, block, _, pieces in _blocks(batches):
            ends = [(False, 0, 0), (True, 0, 0)]
            for piece in _bare(file, block, pieces, start):
                for i, (inside, depth, low) in enumerate(ends):
                    inside, more, least = _walk(piece, inside)
                    ends[i] = inside, depth + more, min(low, depth + least)
            found.append((file, block, *ends[0], *ends[1]))
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(_names(_SUMMARY), r, strict=True)) for r in found])

    return run


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _found(start: re.Pattern):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*waiting, strict=True))
            types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_names(_FOUND))

        for file, block, (inside, depth, closed), pieces in _blocks(batches):
            if inside is None:
                raise ValueError(f"{file}: block {block} was not there in the first pass; the file changed")
            if closed:
                continue
            kind, part = _HEAD, []
            for piece in _bare(file, block, pieces, start):
                inside, more, least = _walk(piece, inside)
                if depth + least < 0:  # the array ends here
                    waiting.append((file, block, kind, True, None))
                    part = None
                    break
                depth += more
                part.append(piece)
                if depth == 0 and not inside:
                    text = "}".join(part) + "}"
                    waiting.append((file, block, _HEAD if kind == _HEAD else _WHOLE, True, text))
                    kind, part = _TAIL, []
                    size += len(text)
                    if size > 1 << 22:
                        yield flush()
                        waiting, size = [], 0
            if part is not None:
                waiting.append((file, block, kind, False, "}".join([*part, ""])))
                size += len(waiting[-1][-1])
        if waiting:
            yield flush()

    return run


def _text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, value): the pieces of the files, with the byte range that each was read from."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def block_states(pieces: DataFrame, result: str | None = None) -> DataFrame:
    """(file, block, inside, depth, closed): the state at the start of each block, depths counted from the array's."""
    start, _ = _start(result)
    sums = pieces.mapInArrow(_summed(start), _SUMMARY)
    row = F.struct("block", "string0", "depth0", "low0", "string1", "depth1", "low1")
    blocks = sums.groupBy("file").agg(F.sort_array(F.collect_list(row)).alias("blocks"))  # one small row a block
    state = "struct<inside:boolean,depth:bigint,closed:boolean>"

    def after(states: Column, b: Column) -> Column:
        s = F.element_at(states, -1)
        inside = s["inside"]
        depth = s["depth"] + F.when(inside, b["depth1"]).otherwise(b["depth0"])
        low = s["depth"] + F.when(inside, b["low1"]).otherwise(b["low0"])
        now = F.struct(
            F.when(inside, b["string1"]).otherwise(b["string0"]).alias("inside"), depth.alias("depth"), (s["closed"] | (low < 0)).alias("closed")
        )
        return F.concat(states, F.array(now.cast(state)))

    first = F.array(F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("closed")).cast(state))
    chained = F.aggregate("blocks", first, after)
    return blocks.select("file", F.inline(F.arrays_zip(F.col("blocks.block").alias("block"), F.slice(chained, 1, F.size("blocks")).alias("s")))).select(
        "file", "block", "s.inside", "s.depth", "s.closed"
    )


def record_texts(spark: SparkSession, path: str | list[str], result: str | None = None) -> DataFrame:
    """(value): the text of every record of the documents at ``path``, split by byte ranges.

    ``result`` names the list in ``{"data": {result: [...]}}``; without it the document is the array.
    """
    start, _ = _start(result)
    pieces = _text(spark, path)
    states = block_states(pieces, result)
    # A row a block, some hundred bytes for each maxPartitionBytes of input, so its size is bounded by the files'.
    known = pieces.join(F.broadcast(states), ["file", "block"], "left")
    found = known.select("file", "block", "value", "inside", "depth", "closed").mapInArrow(_found(start), _FOUND)
    whole = F.col("kind") == _WHOLE
    # Null but for records: a parser further up may be evaluated before this filter.
    return found.filter(whole).select(F.when(whole, F.col("text")).alias("value")).unionByName(_joined(found))


def _joined(found: DataFrame) -> DataFrame:
    """Records from the parts that neighbouring blocks have of them."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = found.filter(F.col("kind") != _WHOLE)
    parts = parts.withColumn("record", F.coalesce(F.sum(F.col("ended").cast("long")).over(before), F.lit(0)))
    whole = parts.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "kind", "text"))).alias("parts"),
        F.max("ended").alias("ended"),
        F.max(F.col("ended") & F.col("text").isNull()).alias("last"),
    )
    cut_off = F.raise_error(F.concat(F.col("file"), F.lit(": ends within its list of records"))).cast("boolean")
    kept = whole.filter(F.when(F.col("ended"), ~F.col("last")).otherwise(cut_off))
    return kept.select(F.when(F.col("ended") & ~F.col("last"), F.array_join(F.col("parts.text"), "")).alias("value"))


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType, result: str | None = None) -> DataFrame:
    """Records of the documents at ``path`` under ``schema``; text that is no record is an error."""
    text = F.regexp_replace("value", r"^[\s,]+", "")
    parsed = record_texts(spark, path, result).select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")
