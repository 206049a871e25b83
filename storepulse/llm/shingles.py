"""Hashed word shingles of whole texts, a block of Arrow rows at a time.

Words are runs without ASCII white space, A-Z lower-cased. A word's hash is a
polynomial over its bytes modulo 2**64, from one running sum over the block;
a shingle's hash mixes those of its words. Texts of any length are read in blocks of
about ``BLOCK`` bytes, cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _lowered_values() -> np.ndarray:
    byte = np.arange(256)
    byte[0x41:0x5B] += 0x20
    return mix((byte + 1).astype(_U) * _U(0x9E3779B97F4A7C15))


_VALUES = _lowered_values()
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_POWERS = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, BLOCK + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, _U)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def _word_hashes(block: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, hashes) of the words in the block; no word spans a break."""
    word = ~_SPACE[block]
    cut = np.zeros(len(block) + 1, bool)
    cut[breaks] = True
    cut[0] = cut[-1] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(block) + 1)
    run = np.zeros(len(block) + 1, _U)
    np.cumsum(_VALUES[block] * up[: len(block)], out=run[1:])
    return starts, mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(_U))


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text of more than a block."""
    found, at = [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):  # back to the last white space, or on to the next block
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + BLOCK, len(data))
        found.append(_word_hashes(data[at:end], np.zeros(0, np.int64))[1])
        at = end
    return np.concatenate(found)


def word_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, bounds): the words of row ``first + i`` are ``hashes[bounds[i]:bounds[i + 1]]``."""
    n = len(texts)
    if not n:
        return
    if texts.null_count:  # a null may hold bytes
        texts = texts.fill_null("")
    wide = texts.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        block = data[offsets[row] : offsets[end]]
        if len(block) > BLOCK:
            hashes = _long_text(block)
            yield row, hashes, np.array([0, len(hashes)])
        else:
            edges = offsets[row : end + 1] - offsets[row]
            starts, hashes = _word_hashes(block, edges) if len(block) else (np.zeros(0, np.int64), np.zeros(0, _U))
            yield row, hashes, np.searchsorted(starts, edges)
        row = end


def shingle_blocks(texts: pa.Array, width: int = 3) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, hashes at every word, starts, ends): the shingles of row ``first + i`` are ``hashes[starts[i]:ends[i]]``.

    A text of fewer words than ``width`` has its whole sequence as one shingle.
    """
    for row, words, bounds in word_blocks(texts):
        starts, ends = bounds[:-1], bounds[1:]
        whole = np.zeros(len(words), _U)
        n = len(words) - width + 1
        if n > 0:
            total = np.zeros(n, _U)
            for k in range(width):
                total = mix(total + words[k : k + n] + _U(k + 1))
            whole[:n] = total
        short = (ends - starts < width) & (ends > starts)
        for i in np.flatnonzero(short):
            total = np.full(1, width * 1000 + ends[i] - starts[i], _U)
            for k in range(starts[i], ends[i]):
                total = mix(total + words[k : k + 1])
            whole[starts[i]] = total[0]
        yield row, whole, starts, np.where(short, starts + 1, np.maximum(starts, ends - width + 1))
