"""N-gram Jaccard join with token-combination prefixes.

A document's set is its distinct word shingles (hashed to 64 bits); documents
link when the Jaccard similarity of their sets is at least ``PERCENT`` / 100.
``WIDTH`` and ``PERCENT`` are op10's; callers may pass others.

* Documents with equal sets are one node. Two different sets of fewer than nine
  shingles cannot reach 0.9 (of fewer than four 0.8), so only larger ones go further.
* A sketch of counts over all shingles of the corpus (``2**SKETCH_BITS``
  counters, whatever the size) gives every shingle a level, the binary
  logarithm of its counter. Shingles are ordered by level and hash, rare ones
  first. Any fixed order gives the same links; this one makes them cheap to find.
* A node indexes signatures of a prefix of its ordered shingles. Shingles of the rare
  class are signatures by themselves. The two frequent classes are cut into
  subclasses by hash, and every combination of two (very frequent: three)
  prefix shingles of one subclass is a signature. The prefix is extended until the
  shingles beyond the first one (two) of each subclass number ``n - ceil(0.9 n) + 1``:
  a partner lacks at most ``n - ceil(0.9 n)`` shingles, so in some subclass
  it shares enough of the prefix for a signature. The number of
  subclasses depends on the band (power of two) of the larger set, so a
  node near the end of its band indexes for the next one too. It grows with the shingles
  that a partner may lack, so that a subclass, and its combinations, stay few.
* Signatures are made for one text of each distinct set and written once. Postings (signature, node, size,
  place) travel packed, some eight bytes each, by parts of the signatures; all that share a signature meet
  in its part, and what stands alone, nearly all of them, ends there.
* Nodes that share a signature are candidates, unless their sizes, the place of
  the shared shingle in the order, or the Hamming distance of their parity
  bitmaps (a lower bound of the sets' difference) show that they cannot link.
  The rest is verified on the whole sets.
* Groups of near copies are not expanded into pairs: a signature of more than ``FEW``
  members first offers them only the one whose shared shingle stands first (an
  unedited original has no shingles of its own before it), their pivot. Then components
  are joined. Signatures of up to ``SMALL`` members that still lie in
  different components offer the pairs across them. The members of larger
  ones are compared by their differences from the pivot (``_across_large``), so
  that a template with very many fillings offers only those that agree further.

Null and word-less texts have an empty set and link with nothing, not even
with each other. Repeated rows are equal sets; a doc_id that stands on
several rows names each of them. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storepulse.llm.common import set_aside, staged
from storepulse.llm.components import components
from storepulse.llm.shingles import mix, shingle_blocks

#: Production parameters.
PERCENT = 90
WIDTH = 3
SKETCH_BITS = 22
#: A shingle is of the rare class up to this many times the mean counter (or this many in all).
RARE = 8
#: The very frequent class begins at this many times the end of the rare class.
VERY = 64
#: Subclasses of a frequent class in a band: one for so many shingles that a partner of its smallest set may lack.
PER_SUBCLASS = 2
#: Signatures of up to this many members offer all their pairs at once.
FEW = 8
#: Signatures of up to this many members offer all pairs of members that still lie in different components.
SMALL = 32
#: Postings that a task packs at a time, and about as many as meet in one part.
CHUNK = 1 << 20
PER_PART = 1 << 18
#: Statistics of tasks that are combined at a time.
FAN_IN = 16

_U = np.uint64
_MAX_COUNT = 65535
#: Words of the short bitmap that postings carry.
_SHORT = 4


def _needed(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any partner."""
    return -(-percent * n // 100)


def least_set(percent: int) -> int:
    """Smallest size from which two different sets can link: ``s / (s + 1)`` reaches the threshold."""
    return -(-percent // (100 - percent))


# ---- statistics -----------------------------------------------------------


def _count_shingles(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        waiting, n = [], 0

        def add() -> None:
            slots, n_of = np.unique(np.concatenate(waiting), return_counts=True)
            counts[slots] += n_of.astype(np.uint32)

        for batch in batches:
            for _, hashes, starts, ends in shingle_blocks(batch.column(0), width):
                edge = np.zeros(len(hashes) + 1, np.int32)
                np.add.at(edge, starts, 1)
                np.add.at(edge, ends, -1)
                waiting.append((hashes[np.cumsum(edge[:-1]) > 0] >> _U(64 - bits)).astype(np.uint32))
                n += len(waiting[-1])
                if n > 1 << 20:
                    add()
                    waiting, n = [], 0
        if waiting:
            add()
        yield pa.RecordBatch.from_pydict({"counts": [_packed(counts)]})

    return run


def _packed(counts: np.ndarray) -> bytes:
    """Counters, saturating at 16 bits, compressed."""
    return pa.compress(np.minimum(counts, _MAX_COUNT).astype(np.uint16).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 2 << bits, codec="zstd", asbytes=True), np.uint16)


def _combined_rows(parts: DataFrame, combine: Callable[[bytes, bytes], bytes]) -> bytes | None:
    """The one-column rows of ``parts``, one from each task, combined as a tree; tasks hold two rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column(0):
                total = row.as_py() if total is None else combine(total, row.as_py())
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.binary())], names=[name])

    name, n = parts.columns[0], parts.rdd.getNumPartitions()
    while n > 1:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInArrow(run, f"{name} binary")
    rows = parts.collect()  # one at most
    return bytes(rows[0][0]) if rows else None


def shingle_levels(docs: DataFrame, width: int, bits: int) -> np.ndarray:
    """Level (bit length of the saturating count) of each of the ``2**bits`` counters."""
    parts = docs.select("text").mapInArrow(_count_shingles(width, bits), "counts binary")
    total = _combined_rows(parts, lambda a, b: _packed(np.add(_unpacked(a, bits), _unpacked(b, bits), dtype=np.uint32)))
    if total is None:
        return np.zeros(1 << bits, np.uint8)
    level_of = np.array([c.bit_length() for c in range(_MAX_COUNT + 1)], np.uint8)
    return level_of[_unpacked(total, bits)]


def class_limits(levels: np.ndarray, rare: int = RARE, very: int = VERY) -> tuple[int, int]:
    """(first level of the frequent class, first level of the very frequent class)."""
    mean = float(np.bincount(levels, minlength=32) @ 2.0 ** np.arange(32)) / len(levels)
    first = int(np.ceil(np.log2(max(1.0, mean) * rare))) + 1
    return first, first + int(np.log2(very))


# ---- signatures -------------------------------------------------------------


def _band(n: int) -> int:
    return n.bit_length()


def _combined(order: np.ndarray, level: np.ndarray, n: int, band: int, limits: tuple[int, int], percent: int):
    """Signatures and places of one band: rare shingles alone, combinations within subclasses of frequent ones."""
    need = n - _needed(n, percent) + 1
    size = 1 << (band - 1)
    # The bound, below 74 percent, keeps the first ones of all subclasses fewer than the least overlap of the band's smallest set.
    subclasses = max(1, min(size * (100 - percent) // (100 * PER_SUBCLASS), size * percent**2 // 40_000))
    slack = 3 * subclasses  # shared shingles that may stand earlier without forming a combination
    groups: dict[tuple[int, int], list[tuple[int, int]]] = {}
    sigs, places, covered = [], [], 0
    for place, (token, lv) in enumerate(zip(order.tolist(), level.tolist(), strict=True)):
        if covered == need:
            break
        k = 1 + (lv >= limits[0]) + (lv >= limits[1])
        if k == 1:
            sigs.append(token)
            places.append(place)
            covered += 1
            continue
        group = groups.setdefault((k, token % subclasses), [])
        covered += len(group) >= k - 1
        group.append((token, place))
    for (k, _), group in groups.items():
        for chosen in combinations(group, k):
            mixed = np.full(1, band * 8 + k, _U)
            for token, _ in chosen:
                mixed = mix(mixed + np.full(1, token, _U))
            sigs.append(int(mixed[0]))
            places.append(max(0, chosen[0][1] - slack))
    return sigs, places


def signatures(tokens: np.ndarray, levels: np.ndarray, limits: tuple[int, int], percent: int):
    """(signatures, places) of a set given as its distinct shingle hashes."""
    n = len(tokens)
    if n < least_set(percent):
        return np.zeros(0, _U), np.zeros(0, np.int32)
    bits = len(levels).bit_length() - 1
    level = levels[(tokens >> _U(64 - bits)).astype(np.int64)]
    by = np.argsort((level.astype(_U) << _U(58)) | (tokens >> _U(6)), kind="stable")
    need = n - _needed(n, percent) + 1
    if level[by[need - 1]] < limits[0]:  # rare shingles suffice
        return tokens[by[:need]], np.arange(need, dtype=np.int32)
    order, level = tokens[by], level[by]
    found: dict[int, int] = {}
    for band in sorted({_band(n), _band(n * 100 // percent)}):
        for sig, place in zip(*_combined(order, level, n, band, limits, percent), strict=True):
            found[sig] = min(place, found.get(sig, place))
    return np.array(list(found), _U), np.array(list(found.values()), np.int32)


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Bitmap, each bit the parity of the number of shingles that fall on it.

    At least 256 bits, and one for every two shingles, doubled until then; a bitmap of
    half the length is the exclusive or of the halves.
    """
    bits = 256
    while 2 * bits < len(tokens):
        bits *= 2
    odd = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _folded(bitmap: np.ndarray) -> np.ndarray:
    """The bitmap of 256 bits, by exclusive or."""
    return np.bitwise_xor.reduce(bitmap.reshape(-1, _SHORT), axis=0)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))] if len(hashes) else hashes


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


_DESCRIBED = "doc_id long, text_hash long, digest binary, n int"
_SIGNED = "doc_id long, digest binary, n int, bitmap array<long>, low array<long>, sigs array<long>, places array<int>"


def _lists(parts: list[np.ndarray], kind: np.dtype, arrow: pa.DataType) -> pa.Array:
    bounds = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate([p.view(kind) if p.dtype.itemsize == np.dtype(kind).itemsize else p.astype(kind) for p in parts])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, arrow))


def _described(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, starts, ends in shingle_blocks(batch.column(2), width):
                sets = [_distinct(hashes[a:b]) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)),
                        batch.column(1).slice(row, len(sets)),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                    ],
                    names=["doc_id", "text_hash", "digest", "n"],
                )

    return run


def _signed(levels, width: int, limits: tuple[int, int], percent: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = _let_through(wanted.value, batch)
            for row, hashes, starts, ends in shingle_blocks(texts, width):
                sets = [_distinct(hashes[a:b]) for a, b in zip(starts, ends, strict=True)]
                large = np.array([len(s) >= least_set(percent) for s in sets], bool)
                sets = [s for s, keep in zip(sets, large, strict=True) if keep]
                if not sets:
                    continue
                made = [signatures(s, levels.value, limits, percent) for s in sets]
                bitmaps = [_parity(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, len(large)).filter(pa.array(large)),
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        _lists(bitmaps, np.int64, pa.int64()),
                        _lists([_folded(b) for b in bitmaps], np.int64, pa.int64()),
                        _lists([m[0] for m in made], np.int64, pa.int64()),
                        _lists([m[1] for m in made], np.int32, pa.int32()),
                    ],
                    names=["doc_id", "digest", "n", "bitmap", "low", "sigs", "places"],
                )

    return run


def _sets(width: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, texts = _let_through(wanted.value, batch)
            for _, hashes, starts, ends in shingle_blocks(texts, width):
                sets = [_distinct(hashes[a:b]) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        _lists(sets, np.int64, pa.int64()),
                    ],
                    names=["digest", "tokens"],
                )

    return run


# ---- meetings ----------------------------------------------------------------

#: Columns of packed postings: what is left of the signature, node, size of its set, place.
_POSTING = (np.uint32, np.int64, np.int32, np.int32)


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns by planes of equal bytes, compressed; the signatures, in ascending order, as steps."""
    steps = np.diff(columns[0], prepend=np.zeros(1, np.uint32))
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in (steps, *columns[1:])]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int) -> list[np.ndarray]:
    widths = [np.dtype(kind).itemsize for kind in _POSTING]
    flat = np.frombuffer(pa.decompress(packed, n * sum(widths), codec="zstd", asbytes=True), np.uint8).reshape(-1, n)
    planes = np.split(flat, np.cumsum(widths)[:-1])
    columns = [np.ascontiguousarray(p.T).view(kind).ravel() for p, kind in zip(planes, _POSTING, strict=True)]
    return [np.cumsum(columns[0], dtype=np.uint32), *columns[1:]]


def _dealt(parts: int):
    """(node, n, sigs, places) rows as packed postings, by part of the signatures.

    Within its part a signature is known by 32 bits; others that they make equal only meet for nothing.
    """

    def packed(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        sig, node, n, place = (np.concatenate(c) for c in zip(*held, strict=True))
        part, left = sig % _U(parts), (sig // _U(parts)).astype(np.uint32)
        by = np.argsort(part << _U(32) | left)
        columns = [left[by], node[by], n[by], place[by]]
        found, starts = np.unique(part[by], return_index=True)
        ends = [*starts[1:], len(by)]
        rows = [_pack([c[a:b] for c in columns]) for a, b in zip(starts, ends, strict=True)]
        sizes = np.subtract(ends, starts).astype(np.int32)
        return pa.RecordBatch.from_pydict({"part": found.astype(np.int32), "size": sizes, "packed": rows})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            node, n, sigs, places = batch.columns
            each = np.diff(sigs.offsets.to_numpy())
            flat = sigs.flatten().to_numpy().view(_U)
            held.append([flat, np.repeat(node.to_numpy(), each), np.repeat(n.to_numpy(), each), places.flatten().to_numpy()])
            total += len(flat)
            if total > CHUNK:
                yield packed(held)
                held, total = [], 0
        if total:
            yield packed(held)

    return run


_MET = "sig long, k int, node long, n int, place int, other long"


def _met(percent: int, few: int):
    """The postings of one part: pairs in reach of signatures of up to ``few`` members, all postings of larger ones."""

    def run(table: pa.Table) -> pa.Table:
        rows = [_unpack(p.as_py(), n.as_py()) for p, n in zip(table.column("packed"), table.column("size"), strict=True)]
        sig, node, n, place = (np.concatenate(c) for c in zip(*rows, strict=True))
        by = np.argsort(sig, kind="stable")
        sig, node, n, place = sig[by], node[by], n[by].astype(np.int64), place[by].astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        k = np.diff(starts, append=len(sig))
        low, high = [], []
        for size in range(2, few + 1):
            first = starts[k == size]
            for i, j in combinations(range(size), 2):
                x, y = first + i, first + j
                least, most = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
                room = np.minimum(n[x] - place[x], n[y] - place[y])
                ok = (least * 100 >= most * percent) & (room >= -(-(least + most) * percent // (100 + percent)))
                a, b = node[x][ok], node[y][ok]
                low.append(np.minimum(a, b))
                high.append(np.maximum(a, b))
        low, high = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (low, high))
        pairs = np.unique(np.stack([low, high], axis=1)[low < high], axis=0)
        many = np.repeat(k > few, k)
        part = table.column("part")[0].as_py()
        null = lambda length, kind: pa.nulls(length, kind)
        p, m = len(pairs), int(many.sum())
        columns = [
            (null(p, pa.int64()), pa.array((sig[many].astype(np.int64) | part << 32))),
            (null(p, pa.int32()), pa.array(np.repeat(k, k)[many].astype(np.int32))),
            (pa.array(pairs[:, 0]), pa.array(node[many])),
            (null(p, pa.int32()), pa.array(n[many].astype(np.int32))),
            (null(p, pa.int32()), pa.array(place[many].astype(np.int32))),
            (pa.array(pairs[:, 1]), null(m, pa.int64())),
        ]
        return pa.table([pa.concat_arrays(c) for c in columns], names=["sig", "k", "node", "n", "place", "other"])

    return run


def _meetings(signed: DataFrame, shingles: int, percent: int) -> DataFrame:
    """Who shares a signature: (node, other) pairs, and (sig, k, node, n, place) where more than ``FEW`` do.

    Nearly all signatures stand in one set only, so postings travel packed and once, and what meets is seen where they arrive.
    """
    parts = shingles * (100 - percent) // 100 // PER_PART + 1
    dealt = signed.select("node", "n", "sigs", "places").mapInArrow(_dealt(parts), "part int, size int, packed binary")
    return dealt.groupBy("part").applyInArrow(_met(percent, FEW), _MET)


# ---- candidates and links ----------------------------------------------------


def _overlap(n1: Column, n2: Column, percent: int) -> Column:
    """Least overlap with which sets of these sizes link."""
    return F.ceil((n1 + n2) * percent / F.lit(100 + percent))


def _in_reach(a: str, b: str, percent: int) -> Column:
    """Whether the sizes of two postings, the places of their shared shingle and their short bitmaps leave room for a link."""
    n1, n2 = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = _overlap(n1, n2, percent)
    room = F.least(n1 - F.col(f"{a}.place"), n2 - F.col(f"{b}.place"))
    apart = sum(F.bit_count(F.col(f"{a}.low")[i].bitwiseXOR(F.col(f"{b}.low")[i])) for i in range(_SHORT))
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (room >= need) & (apart <= n1 + n2 - 2 * need)


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) node pairs those whose bitmaps leave room for a link."""
    first = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ma"))
    second = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("mb"))
    length = F.least(F.size("ma"), F.size("mb"))

    def folded(name: str) -> Column:
        halves = F.transform(F.slice(name, 1, length), lambda v, i: v.bitwiseXOR(F.element_at(name, i + length + 1)))
        return F.when(F.size(name) == length, F.col(name)).otherwise(halves)

    bits = F.zip_with(folded("ma"), folded("mb"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    most = F.col("na") + F.col("nb") - 2 * _overlap(F.col("na"), F.col("nb"), percent)
    return pairs.join(first, "a").join(second, "b").filter(apart <= most).select("a", "b")


#: Bits of the filter by which tasks know the documents whose sets are wanted; more false positives beyond its room.
FILTER_BITS = 25


def _filter_slots(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(_U) + _U(1)) >> _U(64 - FILTER_BITS)).astype(np.int64)


def _let_through(bits: np.ndarray, batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    """(doc_id, text) of the rows whose doc_id the filter lets through."""
    slots = _filter_slots(batch.column(0).fill_null(0).to_numpy())
    hit = pa.array(((bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1).astype(bool))
    return batch.column(0).filter(hit), batch.column(1).filter(hit)


def _wanted(ids: DataFrame) -> np.ndarray:
    """Bit array of the hashes of all ``doc_id``, the same size however many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_filter_slots(batch.column(0).fill_null(0).to_numpy())] = True
        yield pa.RecordBatch.from_pydict({"bits": [pa.compress(np.packbits(bits).tobytes(), codec="zstd", asbytes=True)]})

    def raw(packed: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(packed, (1 << FILTER_BITS) // 8, codec="zstd", asbytes=True), np.uint8)

    def either(a: bytes, b: bytes) -> bytes:
        return pa.compress((raw(a) | raw(b)).tobytes(), codec="zstd", asbytes=True)

    total = _combined_rows(ids.mapInArrow(run, "bits binary"), either)
    return np.zeros((1 << FILTER_BITS) // 8, np.uint8) if total is None else raw(total)


def _tokens(involved: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, tokens) of the distinct nodes ``involved``.

    The texts are read again, where they lie: tasks take the sets of the
    documents that the filter lets through, and only those are shuffled.
    """
    known = staged(nodes.select("node", "digest", "doc_id").join(involved, "node"), "join-known")
    wanted = docs.sparkSession.sparkContext.broadcast(_wanted(known.select("doc_id")))
    sets = docs.select("doc_id", "text").mapInArrow(_sets(width, wanted), "digest binary, tokens array<long>")
    known = known.select("node", "digest")
    sets = staged(known.join(sets, "digest").dropDuplicates(["node"]).select("node", "tokens"), "join-sets")
    wanted.destroy()
    return sets


def _ends(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.col(a).alias("node")).unionByName(pairs.select(F.col(b).alias("node"))).distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of (a, b) node pairs those whose whole sets link, as (u, v)."""
    sets = _tokens(_ends(pairs, "a", "b"), nodes, docs, width)
    first = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    second = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.join(first, "a").join(second, "b")
        .withColumn("both", both)
        .filter(F.col("both") * 100 >= (F.size("ta") + F.size("tb") - F.col("both")) * percent)
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def _across_large(spokes: DataFrame, label: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) candidates of different components among the members of each pivot, given as (node, pivot).

    Members x and y whose sets differ in at most H shingles have differences Dx and Dy from the
    pivot that differ in at most H as well. They share a shingle there: were they disjoint, |Dx| + |Dy|
    would be H at most, so one of them would link with the pivot, and sizes leave no room for the other one
    not to. With the shingles of the differences in one order, the smaller difference shares one of
    its first ``H / 2 + 1`` with the first ``H + 1`` of the larger. The order is by frequency among the pivot's members, so
    what all of them have, or lack, stands last and offers no pairs.
    """
    member = F.col("node") == F.col("own")
    placed = spokes.join(label, member, "left").select("node", "pivot", F.coalesce("label", "node").alias("l"))
    home = (F.col("l") == F.coalesce("label", "pivot")).alias("home")
    placed = placed.join(label, F.col("pivot") == F.col("own"), "left").select("node", "pivot", "l", home)
    split = placed.filter("not home").select("pivot").distinct()
    placed = staged(placed.join(split, "pivot").select("node", "pivot", "l", "home"), "join-members")

    sets = _tokens(_ends(placed, "node", "pivot"), nodes, docs, width)
    own = sets.select("node", "tokens")
    centre = sets.select(F.col("node").alias("pivot"), F.col("tokens").alias("centre"))
    apart = F.concat(F.array_except("tokens", "centre"), F.array_except("centre", "tokens"))
    differing = placed.join(own, "node").join(centre, "pivot").select("pivot", "node", "l", "home", F.size("tokens").alias("n"), apart.alias("d"))
    single = staged(differing.select("pivot", "node", F.explode("d").alias("token")), "join-differences")
    shared = single.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    listed = single.join(shared, ["pivot", "token"]).groupBy("pivot", "node").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("df", "token"))), lambda s: s["token"]).alias("common")
    )
    sizes = differing.select("pivot", "node", "l", "home", "n", F.size("d").alias("d"))
    # Shingles that no other member's difference has stand first and offer nothing; places count them.
    lists = staged(sizes.join(listed, ["pivot", "node"]), "join-lists")
    most = F.floor((F.col("n") + F.floor(F.col("n") * 100 / percent)) * (100 - percent) / F.lit(100 + percent)).cast("int")
    alone = F.col("d") - F.size("common")

    def first(length: Column, name: str) -> DataFrame:
        taken = F.slice("common", 1, F.greatest(F.lit(0), length - alone))
        at = lists.select("pivot", "home", F.struct("node", "l", "n", "d", alone.alias("alone")).alias(name), F.posexplode(taken).alias("i", "token"))
        return at.select("pivot", "token", "home", F.col(name).withField("place", F.col(f"{name}.alone") + F.col("i")).alias(name))

    x, y = F.col("x"), F.col("y")
    need = _overlap(x["n"], y["n"], percent)
    differ = x["n"] + y["n"] - 2 * need
    room = 2 * F.least(x["d"] - x["place"], y["d"] - y["place"]) >= x["d"] + y["d"] - differ
    reach = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent
    order = F.struct(x["d"], x["node"]) < F.struct(y["d"], y["node"])
    shorter, longer = first(F.floor(most / 2).cast("int") + 1, "x"), first(most + 1, "y")
    # Members of the pivot's own component, most of a group of near copies, meet only those of other ones.
    met = shorter.filter("not home").drop("home").join(longer.drop("home"), ["pivot", "token"]).unionByName(
        shorter.filter("home").drop("home").join(longer.filter("not home").drop("home"), ["pivot", "token"])
    )
    met = met.filter((x["l"] != y["l"]) & order & reach & room)
    return met.select(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")).distinct()


def _links(met: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between nodes, enough of them to connect every component; ``met`` as of ``_meetings``."""
    each = met.filter("sig is null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    many = met.filter("sig is not null").join(nodes.select("node", "low"), "node")
    many = staged(many.select("sig", "k", F.struct("place", "node", "n", "low").alias("x")), "join-many")

    pair = [F.col("x.node").alias("a"), F.col("y.node").alias("b")]
    ordered = [F.least(*pair).alias("a"), F.greatest(*pair).alias("b")]
    pivots = many.groupBy("sig").agg(F.min("x").alias("y"))
    spokes = many.join(pivots, "sig").filter(F.col("x.node") != F.col("y.node"))
    star = spokes.filter(_in_reach("x", "y", percent))
    offered = each.unionByName(star.select(*ordered)).distinct()
    tried = staged(_close(offered, nodes, percent), "join-tried")
    found = staged(_verified(tried, nodes, docs, width, percent), "join-links")

    label = staged(components(found).withColumnRenamed("node", "own"), "join-labels")
    small = many.filter(F.col("k") <= SMALL).select("sig", "x")
    placed = small.join(label, F.col("x.node") == F.col("own"), "left").select("sig", "x", F.coalesce("label", "x.node").alias("label"))
    split = placed.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("sig")
    rest = placed.join(split, "sig").select("sig", "x", F.col("label").alias("lx"))
    across = (
        rest.join(rest.withColumnsRenamed({"x": "y", "lx": "ly"}), "sig")
        .filter((F.col("x.node") < F.col("y.node")) & (F.col("lx") != F.col("ly")) & _in_reach("x", "y", percent))
        .select(*pair)
    )
    large = spokes.filter(F.col("k") > SMALL).select(F.col("x.node").alias("node"), F.col("y.node").alias("pivot")).distinct()
    across = across.unionByName(_across_large(large, label, nodes, docs, width, percent)).distinct()
    across = across.join(tried, ["a", "b"], "left_anti")
    across = staged(_close(across, nodes, percent), "join-across")
    return found.unionByName(_verified(across, nodes, docs, width, percent))


def ngram_join(
    docs: DataFrame,
    percent: int = PERCENT,
    width: int = WIDTH,
    sketch_bits: int = SKETCH_BITS,
    rare: int = RARE,
    very: int = VERY,
) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, set_group) for every row.

    component_id is the smallest doc_id that links reach; set_group names the
    component by the least digest of its sets (null for an empty set).
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    levels = shingle_levels(docs, width, sketch_bits)
    limits = class_limits(levels, rare, very)
    indexed = staged(docs.mapInArrow(_described(width), _DESCRIBED), "join-indexed")
    first = indexed.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n"))
    first = staged(first, "join-first")

    # Signatures are made and written once for each set of enough shingles, of the text that names it, and of the few others the filter lets through.
    large = first.filter(F.col("n") >= least_set(percent))
    shingles = large.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    shared_levels = spark.sparkContext.broadcast(levels)  # 2**sketch_bits bytes
    wanted = spark.sparkContext.broadcast(_wanted(large.select(F.col("first_id").alias("doc_id"))))
    signed = docs.select("doc_id", "text").mapInArrow(_signed(shared_levels, width, limits, percent, wanted), _SIGNED)
    signed = staged(signed.withColumn("node", F.monotonically_increasing_id()), "join-signed")
    for shared in (shared_levels, wanted):
        shared.destroy()
    nodes = staged(signed.drop("sigs", "places").dropDuplicates(["digest"]), "join-nodes")
    met = staged(_meetings(signed, shingles, percent), "join-met")
    label = components(_links(met, nodes, docs, width, percent))

    named = label.join(nodes.select("node", F.col("digest").alias("d")), "node")
    named = named.join(first, F.col("d") == F.col("digest")).select("d", "label", "first_id")
    whole = named.groupBy("label").agg(F.min("first_id").alias("lowest"), F.min("d").alias("least"))
    joined = named.join(whole, "label").select(F.col("d").alias("digest"), "lowest", "least")
    classes = first.join(joined, "digest", "left").select(
        "digest",
        F.coalesce("lowest", "first_id").alias("component_id"),
        F.coalesce("least", "digest").alias("set_group"),
    )
    return (
        indexed.select("doc_id", "text_hash", "digest", F.col("n").cast("long").alias("n_shingles"))
        .join(classes, "digest", "left")
        .select("doc_id", "text_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "set_group")
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component (shingles of ``width`` words), that of the smallest doc_id.

    Documents without words have no set and link with nothing, so each stays;
    rows that repeat doc_id and text are one document.
    """
    rows = ngram_join(docs, percent, width)
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    kept = rows.filter("set_group is not null").groupBy("set_group").agg(F.min(first).alias("k")).select("k.doc_id", "k.text_hash")
    lone = rows.filter("set_group is null").select("doc_id", "text_hash").distinct()
    keys = kept.unionByName(lone)
    docs, columns = set_aside(docs, {"_id", "_unnamed", "_hash"})

    def keyed(df: DataFrame, text_hash: Column) -> DataFrame:
        """Three columns without nulls, so that the join and the distinct rows share one shuffle."""
        return df.withColumns({"_id": F.coalesce("doc_id", F.lit(0)), "_unnamed": F.col("doc_id").isNull(), "_hash": text_hash})

    key = ["_id", "_unnamed", "_hash"]
    wanted = keyed(keys, F.col("text_hash")).select(*key)
    return keyed(docs, F.xxhash64("text")).join(wanted, key, "left_semi").dropDuplicates(key).select(*columns)
