"""Array kernels over blocks of texts: words, lines and their hashes.

A block is a run of whole texts laid end to end as UTF-8 bytes, as Arrow holds
them. Everything here works on one block with a fixed number of array passes, so
its cost and memory follow the bytes of the block, whatever the texts look like.

Hashes join two polynomials over the bytes modulo the prime 2**31 - 1, at bases drawn
at random, and the length, passed through a final mixer. (Modulo a power of two, texts made
of two letters in a certain order have equal sums at every base.) Users that need
certainty across a whole corpus compare the texts behind equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
PRIME = U64((1 << 31) - 1)
# Bases of two independent hashes, each of two polynomials.
_BASES = ((1_482_907_553, 621_304_877), (1_873_264_019, 307_918_661))
_RUN = 1 << 23  # so many byte values times powers add up below 2**63
_STEP = U64(0xA0761D6478BD642F)
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection whose output bits all depend on all input bits."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


BYTE_VALUES = np.arange(1, 257, dtype=U64)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]


def _reduced(x: np.ndarray) -> np.ndarray:
    """Remainders modulo ``PRIME`` of numbers below 2**63."""
    x = (x & PRIME) + (x >> U64(31))
    x = (x & PRIME) + (x >> U64(31))
    x -= PRIME * (x >= PRIME)
    return x


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint32)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = _reduced(out[:more].astype(U64) * U64(pow(base, done, int(PRIME))))
        done += more
    return out


def powers(base: int, n: int) -> np.ndarray:
    """Powers of a base modulo ``PRIME``, for at least ``n`` places."""
    return _powers(base, 1 << max(BLOCK_BYTES.bit_length(), (n + 1).bit_length()))


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size \
        else np.zeros(0, dtype=np.uint8)
    return data, offsets


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs (first row, end row, bytes, offsets from 0) of whole texts.

    A run has at most ``size`` bytes, or one longer text.
    """
    data, offsets = text_arrays(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def prefix_hash(data: np.ndarray, values: np.ndarray = BYTE_VALUES, lane: int = 0) -> tuple[int, np.ndarray]:
    """Running polynomial sums; ``span_hash`` reads any span off them. ``lane`` 1 is independent of 0."""
    out = np.zeros((2, len(data) + 1), dtype=U64)
    for sums, base in zip(out, _BASES[lane]):
        power = powers(base, len(data))
        for at in range(0, len(data), _RUN):
            part = data[at:at + _RUN]
            run = sums[at + 1:at + 1 + len(part)]
            np.cumsum(values[part] * power[at:at + len(part)], out=run)
            run += sums[at] % PRIME
    return lane, out


def span_hash(sums: tuple[int, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from ``start`` to ``end`` (exclusive) of the block."""
    lane, (first, second) = sums
    joined = (end - start).astype(U64) * _GOLDEN
    for run, base, shift in ((first, _BASES[lane][0], 31), (second, _BASES[lane][1], 0)):
        inverse = powers(pow(base, -1, int(PRIME)), run.shape[0])
        span = _reduced(run[end]) + (PRIME - _reduced(run[start]))
        joined += _reduced(span * inverse[start]) << U64(shift)
    return mix(joined)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words ``[^\\x20\\x09-\\x0D]+``."""
    inside = ~SPACES[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, side="right") - 1


def word_counts(text: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(text, minlength=texts).astype(np.int64)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (without the newline) and text numbers of the lines split on ``\\n``.

    Every text has one line more than it has newlines, empty texts included.
    """
    breaks = np.flatnonzero(data == 0x0A)
    text = np.searchsorted(offsets, breaks, side="right") - 1
    count = np.bincount(text, minlength=len(offsets) - 1) + 1
    owner = np.repeat(np.arange(len(offsets) - 1), count)
    head = np.cumsum(count) - count
    start = np.empty(len(owner), dtype=np.int64)
    end = np.empty(len(owner), dtype=np.int64)
    inner = np.ones(len(owner), dtype=bool)
    inner[head] = False
    start[head], start[inner] = offsets[:-1], breaks + 1
    inner[:] = True
    inner[head + count - 1] = False
    end[head + count - 1], end[inner] = offsets[1:], breaks
    return start, end, owner


def grams(word_hash: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows and the place of the first word of each."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    place = np.flatnonzero(text[:n] == text[k - 1:])
    total = word_hash[place].copy()
    for j in range(1, k):
        total *= _STEP
        total += word_hash[place + j]
    return mix(total), place


def tagged(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between the texts of a block, for sorting all texts at once."""
    return mix(values ^ ((text.astype(U64) + U64(1)) * _STEP))


def repeated(keys: np.ndarray) -> np.ndarray:
    """For each key whether an equal one exists elsewhere in the array."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    flag = np.zeros(len(keys), dtype=bool)
    flag[1:] = same
    flag[:-1] |= same
    out = np.empty(len(keys), dtype=bool)
    out[order] = flag
    return out


def covered(place: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a window of ``length`` that starts at a given place."""
    change = np.zeros(size + 1, dtype=np.int32)
    np.add.at(change, place, 1)
    np.add.at(change, np.minimum(place + length, size), -1)
    return np.cumsum(change[:-1]) > 0


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = -(-len(values) // width) * width
    room = np.full(padded, np.iinfo(values.dtype).max, dtype=values.dtype)
    room[:len(values)] = values
    grid = room.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
