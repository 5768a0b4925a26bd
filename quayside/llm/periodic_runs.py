"""Periodic runs of words, found on enhanced suffix arrays.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of a text with
smallest period q (words q apart are equal) and at least ``max(least, exponent * q)`` words
that neither neighbour extends with that period.

1. *Fragments.* Every word of a run occurs at least ``exponent`` times in it. Words
   that occur less often in their text cut it into fragments, and so on within fragments
   until nothing changes. All runs lie within what is left, which is little of plain prose.
2. *Arrays.* All fragments of a block share one suffix array, made by doubling; its ranks
   of all lengths 2^k are kept, for common prefixes and for reaching to the left.
3. *Branching tandems.* Every position k of the array with common prefix d = LCP[k] joins
   two sides of one LCP interval. The suffixes i of the smaller side are tested:
   where ISA[i + d] or ISA[i - d] lies in the other side, a square of period d ends
   where its period does. Sides are two searches in a table of range minima, so no tree
   is made, and smaller sides add up to n log n suffixes.
4. *Runs.* Squares are rotated to the left by powers of two as far as the period reaches;
   squares with one extent are one run, whose period is the smallest.

Words are compared as they are, not by hashes. Texts stay where they are: no shuffle.

Defined results: null and empty texts have no words and no runs; rows are judged one by
one, so null, equal and repeated ids need no rule; of equally strong runs the first,
then the one of the smaller period, counts. An empty table gives no rows. Extra columns
are not read. The memory of a task follows a block of texts, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.llm import kernel as K
from quayside.llm.tables import documents, ship_package

LEAST, EXPONENT = 6, 4
_AT_ONCE = 1 << 19  # suffixes that are tested at a time
_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_FOUND = f"doc_id bigint, n_words bigint, runs array<{_RUN}>, strongest {_RUN}, text string"


def fragments(word: np.ndarray, text: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that can lie in a run, and the number of the fragment of each."""
    place = np.arange(len(word))
    part = text.astype(np.int64)
    width = int(word.max(initial=0)) + 1
    while len(place):
        _, kind, count = np.unique(part * width + word[place], return_inverse=True, return_counts=True)
        often = count[kind] >= exponent
        place, old = place[often], part[often]
        if not len(place):
            break
        cut = np.ones(len(place), dtype=bool)
        cut[1:] = (place[1:] != place[:-1] + 1) | (old[1:] != old[:-1])
        part = np.cumsum(cut) - 1
        size = np.bincount(part)
        long = size[part] >= least
        place, part = place[long], part[long]
        if often.all() and long.all():
            break
    return place, part


def _ranks(word: np.ndarray, part: np.ndarray) -> list[np.ndarray]:
    """Ranks of the substrings of 1, 2, 4, ... words, ended by their fragment; the last are all different.

    Equal ranks at two places mean that many equal words, since at the end of a fragment
    one of two different places always ends first. Each array has one more entry that
    equals none.
    """
    n = len(word)
    end = np.searchsorted(part, part, side="right")

    def ranked(key: np.ndarray) -> tuple[np.ndarray, int]:
        kinds, rank = np.unique(key, return_inverse=True)
        out = np.empty(n + 1, dtype=np.int32)
        out[:n], out[n] = rank, -1
        return out, len(kinds)

    first, kinds = ranked(part.astype(np.int64) * (int(word.max(initial=0)) + 1) + word)
    out, size, here = [first], 1, np.arange(n)
    while kinds < n:
        ahead = here + size
        inside = ahead < end
        second = np.zeros(n, dtype=np.int64)
        second[inside] = out[-1][ahead[inside]] + 1
        rank, kinds = ranked(out[-1][:n].astype(np.int64) * (n + 1) + second)
        out.append(rank)
        size *= 2
    return out


def _common(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``i`` and ``j`` share."""
    size = np.zeros(len(i), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        size += (ranks[k][i + size] == ranks[k][j + size]).astype(np.int64) << k
    return size


def _sides(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places ``at`` of the array: where the left side begins and where the right side ends.

    ``lcp`` has -1 at both ends. Left of a place all common prefixes are at least as
    long, right of it they are longer.
    """
    least = [lcp]
    while (1 << len(least)) < len(lcp):
        half = 1 << (len(least) - 1)
        last = least[-1]
        least.append(np.minimum(last[:len(last) - half], last[half:]))
    value = lcp[at]
    left, right = at.copy(), at + 1
    for k in range(len(least) - 1, -1, -1):
        size, low = 1 << k, least[k]
        start = left - size
        left = np.where((start >= 0) & (low[np.maximum(start, 0)] >= value), start, left)
        fits = right < len(low)
        right = np.where(fits & (low[np.where(fits, right, 0)] > value), right + size, right)
    return left - 1, right


def _squares(ranks: list[np.ndarray], order: np.ndarray, lcp: np.ndarray, at: np.ndarray
             ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the branching tandems of the LCP intervals at ``at``."""
    place_of = ranks[-1]
    n = len(order)
    left, right = _sides(lcp, at)
    depth = lcp[at].astype(np.int64)
    smaller_left = at - left <= right - at
    begin, end = np.where(smaller_left, left, at), np.where(smaller_left, at, right)
    other_begin, other_end = np.where(smaller_left, at, left), np.where(smaller_left, right, at)
    total = np.cumsum(end - begin)
    first = 0
    while first < len(at):
        done = total[first - 1] if first else 0
        last = max(int(np.searchsorted(total, done + _AT_ONCE, side="right")), first + 1)
        size = (end - begin)[first:last]
        which = np.repeat(np.arange(first, last), size)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        suffix = order[begin[which] + inner]
        for step in (depth[which], -depth[which]):
            mate = suffix + step
            inside = (mate >= 0) & (mate < n)
            where = place_of[np.where(inside, mate, n)]
            hit = inside & (where >= other_begin[which]) & (where < other_end[which])
            yield np.minimum(suffix, mate)[hit], depth[which[hit]]
        first = last


def _rotated(ranks: list[np.ndarray], part: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Where the stretch with that period around each square begins."""
    start = np.searchsorted(part, part[place])
    at = place.copy()
    for k in range(len(ranks) - 1, -1, -1):
        to = at - (1 << k)
        safe = np.maximum(to, 0)
        at = np.where((to >= start) & (ranks[k][safe] == ranks[k][safe + period]), to, at)
    return at


def find_runs(word: np.ndarray, text: np.ndarray, least: int = LEAST, exponent: int = EXPONENT
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of the runs of a block, by start, then period.

    ``word`` numbers the words of the texts end to end; ``text`` ascends.
    """
    nothing = np.zeros(0, dtype=np.int64)
    place, part = fragments(word, text, least, exponent)
    n = len(place)
    if not n:
        return nothing, nothing, nothing
    ranks = _ranks(word[place], part)
    order = np.empty(n, dtype=np.int64)
    order[ranks[-1][:n]] = np.arange(n)
    lcp = np.full(n + 1, -1, dtype=np.int64)
    lcp[1:n] = _common(ranks, order[:-1], order[1:])
    size = np.bincount(part)[part[order]]
    at = np.flatnonzero((lcp[:n] >= 1) & (lcp[:n] * exponent <= size))
    found = list(_squares(ranks, order, lcp, at)) if len(at) else []
    square = np.concatenate([nothing, *(f[0] for f in found)])
    period = np.concatenate([nothing, *(f[1] for f in found)])
    start, end = _rotated(ranks, part, square, period), square + 2 * period
    long = end - start >= np.maximum(least, exponent * period)
    start, end, period = start[long], end[long], period[long]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = place[start[first]], place[end[first] - 1] + 1, period[first]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None


def _batch(ids, counts, runs, texts) -> pa.RecordBatch:
    kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    named = lambda r: dict(zip(("start", "length", "period"), r)) if r else None
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(counts, pa.int64()), pa.array([[named(r) for r in rs] for rs in runs], pa.list_(kind)),
         pa.array([named(_strongest(rs)) for rs in runs], kind), pa.array(texts, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "strongest", "text"])


def _judge(least: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column("text")):
                raw = data.tobytes()
                words = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                numbers: dict[bytes, int] = {}
                word = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), dtype=np.int64)
                counts = np.array([len(ws) for ws in words], dtype=np.int64)
                base = np.cumsum(counts) - counts
                owner = np.repeat(np.arange(len(words)), counts)
                found: list[list[tuple[int, int, int]]] = [[] for _ in words]
                dropped = np.zeros(len(word) + 1, dtype=np.int64)
                start, stop, period = find_runs(word, owner, least, exponent)
                np.add.at(dropped, start + period, 1)
                np.add.at(dropped, stop, -1)
                for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist()):
                    found[owner[s]].append((s - int(base[owner[s]]), e - s, q))
                gone = np.cumsum(dropped[:-1]) > 0
                texts = []
                for t, ws in enumerate(words):
                    if found[t]:
                        kept = np.flatnonzero(~gone[base[t]:base[t] + counts[t]])
                        ws = [ws[i] for i in kept.tolist()]
                    texts.append(b" ".join(ws))
                yield _batch(batch.column("doc_id").slice(first, end - first), counts, found, texts)
    return run


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """Rows (doc_id, n_words, runs, strongest, text), one for each row of ``df``.

    ``runs`` holds (start, length, period) by start, then period; ``strongest`` has the
    largest length / period. In ``text`` every run is reduced to its first period, with
    one space between words.
    """
    if exponent < 2 or least < 2:
        raise ValueError("a run has at least two words and two periods")
    ship_package(df.sparkSession)
    return documents(df, id_col, text_col).mapInArrow(_judge(least, exponent), _FOUND)
