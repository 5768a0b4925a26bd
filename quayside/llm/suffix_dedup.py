"""Suffix-array deduplication by column-wise construction over many passages.

A byte goes when a string of ``WIDTH`` bytes over it also starts anywhere else in the
collection, the same text included. Matches never cross texts, and strings are judged
on the input.

1. *Passages.* Of the ``GRAM``-byte substrings of a window the one with the smallest
   hash is its anchor. A run of windows with one anchor is a passage, of ``WIDTH``
   bytes and some dozens more. Equal windows have equal anchors, so only passages whose
   anchor occurs at two places can hold repeats; the others are done with. Exact copies
   are settled by their digest, and one of them stays in to meet other texts.
2. *Construction.* The distinct passages of an anchor meet in one shard. All passages of
   a shard are inserted together from their last symbol backwards, one symbol of each
   per round: the place of a new suffix follows from its symbol and the rank of the rest
   (the last-to-first step of a Burrows-Wheeler transform), and the common prefix with
   its neighbours is one more than the smallest common prefix between their rests. A
   symbol is ``STEP`` bytes, and a passage takes part once for each of the ``STEP``
   offsets, so a window is a whole number of symbols and rounds are few.
3. *Judgement.* A window is repeated when the common prefix with either neighbour
   covers it, or when its whole passage occurs twice.

Passages are short, so a construction has a fixed number of rounds, each a sequential
pass over the ranks and common prefixes of its shard. Shards hold about
``SHARD_PASSAGES`` passages, so these stay in arrays; no external files are needed.
An anchor with more than ``HOT_PASSAGES`` distinct passages is not gathered in one
shard: its windows are counted one by one (by 128 bits of hash), an exact way for any
number of them.

Defined results: null text is empty; every row is a document of its own, so repeated
rows are copies; texts shorter than ``WIDTH`` bytes keep all. Extra columns are not
read. Tasks hold a block of texts, one text at least, or a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import kernel as K
from quayside.llm.phrases import NO_ID, _only
from quayside.llm.tables import arrow_schema, cut_lineage, documents

WIDTH, GRAM, STEP = 200, 50, 8
SYMBOLS = WIDTH // STEP
SHARD_PASSAGES = 4000
HOT_PASSAGES = 20_000
U64 = K.U64
_ODD = U64(0x9E3779B97F4A7C15)  # any large odd number
_SPOTS = "doc_id bigint, t bigint, anchor bigint, at int, n int"
_PREPARED = "doc_id bigint, t bigint, n_bytes bigint, whole binary, copies boolean, text string, at array<int>, n array<int>, anchors array<bigint>"
_PASSAGES = "doc_id bigint, t bigint, anchor bigint, content bigint, at int, n int"
_BYTES = "anchor bigint, content bigint, kinds bigint, bytes binary"
_RUNS = "anchor bigint, content bigint, start array<int>, stop array<int>"
_KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 binary"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on, from halves that may overlap.

    It only chooses anchors: bytes with equal hashes are more to compare, never a repeat.
    """
    if len(data) < GRAM:
        return np.zeros(0, dtype=U64)
    out, size = data.astype(U64), 1
    while size < 8:
        out = (out[:-size] << U64(8 * size)) | out[size:]
        size *= 2
    out = K.mix(out)
    while size < GRAM:
        shift = min(size, GRAM - size)
        out = K.mix(out[:-shift] * _ODD + out[shift:])
        size += shift
    return out


def passages(data: np.ndarray, offsets: np.ndarray):
    """Anchor, first window (place in the block), number of windows and text of each passage.

    A passage ends where its anchor's first place leaves the window, so equal windows of
    one text are never in the same passage.
    """
    gram = gram_hashes(data)
    least = K.sliding_minimum(gram, WIDTH - GRAM + 1)
    leaves = gram[:len(least)] == least
    place = np.arange(len(least))
    text = np.searchsorted(offsets, place, side="right") - 1
    whole = place + WIDTH <= offsets[text + 1]
    least, place, text, leaves = least[whole], place[whole], text[whole], leaves[whole]
    head = np.ones(len(least), dtype=bool)
    head[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | leaves[:-1]
    at = np.flatnonzero(head)
    return least[at], place[at], np.diff(np.append(at, len(least))), text[at]


def _spot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_SPOTS)
    for batch in batches:
        ids, t = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, end_row, data, offsets in K.blocks(batch.column(2)):
            anchor, place, n, text = passages(data, offsets)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[row:end_row][text]), pa.array(t[row:end_row][text]), pa.array(anchor.view(np.int64)),
                pa.array((place - offsets[text]).astype(np.int32)), pa.array(n.astype(np.int32))], schema=schema)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lengths and digests of all texts; texts go on only where something may be removed."""
    schema = arrow_schema(_PREPARED)
    for batch in batches:
        lengths, digests = [], []
        for text in batch.column("text"):
            raw = text.as_py().encode()
            lengths.append(len(raw))
            digests.append(hashlib.sha256(raw).digest())
        at = batch.column("at")
        going = np.asarray(at.is_valid())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("t"), pa.array(lengths, pa.int64()), pa.array(digests, pa.binary()),
            batch.column("copies").fill_null(False), _only(batch.column("text").cast(pa.string()), going),
            at.cast(pa.list_(pa.int32())), batch.column("n").cast(pa.list_(pa.int32())),
            batch.column("anchors").cast(pa.list_(pa.int64()))], schema=schema)


def _cut(batch: pa.RecordBatch):
    """Blocks of texts with their noted passages: (first row, bytes, start, windows, text, content hash)."""
    for row, end_row, data, offsets in K.blocks(batch.column("text")):
        at = batch.column("at").slice(row, end_row - row)
        n = batch.column("n").slice(row, end_row - row).flatten().to_numpy().astype(np.int64)
        text = np.repeat(np.arange(end_row - row), np.diff(at.offsets.to_numpy()))
        start = offsets[text] + at.flatten().to_numpy()
        content = K.span_hash(K.prefix_hash(data), start, start + n + WIDTH - 1)
        yield row, data, offsets, start, n, text, content


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_PASSAGES)
    for batch in batches:
        ids, t = batch.column("doc_id").to_numpy(), batch.column("t").to_numpy()
        anchors = batch.column("anchors")
        for row, data, offsets, start, n, text, content in _cut(batch):
            own = anchors.slice(row, len(offsets) - 1).flatten()
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[row:][text]), pa.array(t[row:][text]), own, pa.array(content.view(np.int64)),
                pa.array((start - offsets[text]).astype(np.int32)), pa.array(n.astype(np.int32))], schema=schema)


def _byte_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the chosen passages of each text."""
    schema = arrow_schema(_BYTES)
    for batch in batches:
        for text, chosen in zip(batch.column("text"), batch.column("chosen")):
            raw, chosen = text.as_py().encode(), chosen.values
            at, n = (chosen.field(c).to_pylist() for c in ("at", "n"))
            spans = [raw[a:a + k + WIDTH - 1] for a, k in zip(at, n)]
            yield pa.RecordBatch.from_arrays(
                [*(chosen.field(c) for c in ("anchor", "content", "kinds")), pa.array(spans, pa.binary())],
                schema=schema)


def _range_minimum(values: np.ndarray):
    """A function for the minimum over places ``a`` to ``b`` (inclusive), for arrays of both."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), dtype=values.dtype)
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(table[k][a[own]], table[k][b[own] - (1 << int(k)) + 1])
        return out
    return least


def _grams(data: np.ndarray, room: int) -> np.ndarray:
    """The ``STEP`` bytes from each place on as one number."""
    raw = np.zeros(room, dtype=U64)
    for k in range(STEP):
        raw = (raw << U64(8)) | data[k:room + k].astype(U64)
    return raw


def recurring_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of the passages that can hold a repeated window.

    Every ``STEP`` bytes of a repeated window occur twice in the shard, so windows lie within runs
    of places with such bytes; elsewhere nothing needs to be inserted.
    """
    room = len(data) - STEP + 1
    if room <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    _, kind, count = np.unique(_grams(data, room), return_inverse=True, return_counts=True)
    often = np.concatenate([[False], count[kind] > 1, [False]])
    last = offsets[1:, None] - np.arange(STEP - 1)  # places whose bytes reach past their passage
    often[np.clip(last, 0, room + 1)] = False
    edge = np.diff(often.astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + STEP - 1
    wide = end - start >= WIDTH
    return start[wide], end[wide]


def repeated_windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte of a shard whether the window that starts there starts at a second place too.

    The passages lie end to end with the given offsets. The suffixes of the pieces that
    can hold repeated windows are inserted column by column, see above.
    """
    out = np.zeros(len(data), dtype=bool)
    start, end = recurring_pieces(data, offsets)
    if len(start):
        size = end - start
        edges = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(start - edges[:-1], size) + np.arange(edges[-1])
        out[place] = _repeated(data[place], edges)
    return out


def _repeated(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    size = len(data)
    out = np.zeros(size, dtype=bool)
    room = size - STEP + 1
    _, symbol = np.unique(_grams(data, room), return_inverse=True)
    symbol = symbol.astype(np.int64) * (size + 2)

    # One chain of symbols for each passage and offset: its last suffix and its length.
    lengths = np.diff(offsets)
    count = ((lengths[:, None] - np.arange(STEP)) // STEP).ravel()
    last = (offsets[:-1, None] + np.arange(STEP)).ravel() + (count - 1) * STEP
    last, count = last[count >= SYMBOLS], count[count >= SYMBOLS]

    rank = np.zeros(size + STEP, dtype=np.int64)  # 1 + rank of a suffix; 0 for the empty rest
    order = np.zeros(0, dtype=np.int64)
    common = np.zeros(0, dtype=np.uint8)
    final = np.zeros(size + STEP, dtype=bool)
    final[last] = True

    def rest(suffix: np.ndarray) -> np.ndarray:
        return np.where(final[suffix], 0, rank[suffix + STEP])

    for turn in range(int(count.max(initial=0))):
        new = last[count > turn] - turn * STEP
        key = symbol[new] + rest(new)
        turned = np.argsort(key, kind="stable")
        new, key = new[turned], key[turned]
        place = np.searchsorted(symbol[order] + rest(order), key)
        target = place + np.arange(len(new))
        merged = np.empty(len(order) + len(new), dtype=np.int64)
        wide = np.zeros(len(merged), dtype=np.uint8)
        old = np.ones(len(merged), dtype=bool)
        old[target] = False
        merged[target], merged[old], wide[old] = new, order, common

        # Common prefixes change at the new suffixes and right behind them.
        at = np.union1d(target, target[target + 1 < len(merged)] + 1)
        at = at[at > 0]
        a, b = merged[at - 1], merged[at]
        value = (symbol[a] == symbol[b]).astype(np.uint8)
        ra, rb = rest(a), rest(b)
        deep = np.flatnonzero((value > 0) & (ra > 0) & (rb > 0))
        if len(deep):
            value[deep] += _range_minimum(common)(ra[deep], rb[deep] - 1)
        wide[at] = np.minimum(value, SYMBOLS)
        order, common = merged, wide
        rank[order] = np.arange(1, len(order) + 1)

    same = common >= SYMBOLS
    out[order[same]] = True
    out[order[:-1][same[1:]]] = True
    return out


def _runs(flags: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Runs of set flags of each passage as lists of starts and stops, counted from its start."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(offsets, start, side="right") - 1
    lists = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))]).astype(np.int32)
    make = lambda x: pa.ListArray.from_arrays(lists, pa.array((x - offsets[owner]).astype(np.int32)))
    return make(start), make(stop)


def _shard(table: pa.Table) -> pa.Table:
    """Runs of repeated windows of the passages of a shard."""
    table = table.combine_chunks()
    pieces = table.column("bytes").to_pylist()
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    flags = repeated_windows(data, offsets)
    # A window of WIDTH bytes ends in its passage, so no run reaches into the next one.
    start, stop = _runs(flags, offsets)
    return pa.table([table.column("anchor"), table.column("content"), start, stop], schema=arrow_schema(_RUNS))


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("anchor bigint, content bigint, at int, a bigint, b bigint")
    for batch in batches:
        for row, end_row, data, offsets in K.blocks(batch.column("bytes").cast(pa.large_binary()).view(pa.large_string())):
            sums, more = K.prefix_hash(data), K.prefix_hash(data, lane=1)
            place = np.arange(len(data))
            owner = np.searchsorted(offsets, place, side="right") - 1
            place = place[place + WIDTH <= offsets[owner + 1]]
            owner = owner[place]
            both = [K.span_hash(x, place, place + WIDTH).view(np.int64) for x in (sums, more)]
            head = [batch.column(c).slice(row, end_row - row).take(pa.array(owner)) for c in ("anchor", "content")]
            yield pa.RecordBatch.from_arrays(
                [*head, pa.array((place - offsets[owner]).astype(np.int32)), *map(pa.array, both)], schema=schema)


def _counted(hot: DataFrame) -> DataFrame:
    """The runs of the passages of hot anchors, window by window."""
    rows = hot.mapInArrow(_window_hashes, "anchor bigint, content bigint, at int, a bigint, b bigint")
    twice = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("a", "b")
    return rows.join(twice, ["a", "b"], "left_semi").groupBy("anchor", "content").agg(
        F.collect_list("at").alias("start")).select(
        "anchor", "content", "start", F.transform("start", lambda x: x + 1).alias("stop"))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the bytes under the repeated windows of each text."""
    schema = arrow_schema(_KEPT)
    for batch in batches:
        lists = [batch.column(c) for c in ("start", "stop")]
        rows = []
        for i, text in enumerate(batch.column("text")):
            raw = np.frombuffer(text.as_py().encode(), dtype=np.uint8)
            change = np.zeros(len(raw) + 1, dtype=np.int32)
            if lists[0][i].is_valid:
                start, stop = (x[i].values.to_numpy() for x in lists)
                np.add.at(change, start, 1)
                np.add.at(change, stop + WIDTH - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            rows.append((len(raw), int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).digest()))
        n, removed, spans, digest = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(spans, pa.int64()), pa.array(digest, pa.binary())], schema=schema)


def remove_repeated_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shard_passages: int = SHARD_PASSAGES, hot_passages: int = HOT_PASSAGES,
) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one for each row of ``docs``."""
    texts = documents(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    key = ["doc_id", "t"]
    digests = texts.where(F.octet_length("text") >= WIDTH).select(*key, F.md5("text").alias("digest"))
    classes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("k"), F.min("doc_id").alias("least"))
    # Of equal texts the one with the smallest id stays in; all of them go as a whole.
    copies = digests.join(classes.where("k > 1"), "digest").groupBy(*key).agg(
        F.lit(True).alias("copies"), F.min(F.col("doc_id") == F.col("least")).alias("stays"))

    found = texts.mapInArrow(_spot_rows, _SPOTS)
    place = F.xxhash64("t", "at")  # the same for all copies
    recurring = cut_lineage(found.groupBy("anchor").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
                            .where("lo <> hi").select("anchor"))
    spots = found.join(recurring, "anchor", "left_semi").distinct().groupBy(*key).agg(
        F.collect_list(F.struct("at", "n", "anchor")).alias("spots"))
    noted = spots.join(copies, key, "full").where("spots is not null or copies")
    noted = cut_lineage(noted.select(*key, "copies", F.when(F.coalesce("stays", F.lit(True)), F.col("spots")).alias("s"))
                        .select(*key, "copies", "s.at", "s.n", F.col("s.anchor").alias("anchors")))
    prepared = cut_lineage(texts.join(noted, key, "left").mapInArrow(_prepare, _PREPARED))
    going = prepared.where("text is not null")

    rows = cut_lineage(going.mapInArrow(_passage_rows, _PASSAGES))
    kinds = cut_lineage(rows.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("k"), F.min(F.struct(*key, "at", "n")).alias("one")))
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    chosen = kinds.join(several, "anchor").groupBy("one.doc_id", "one.t").agg(
        F.collect_list(F.struct("one.at", "one.n", "anchor", "content", "kinds")).alias("chosen"))
    parts = cut_lineage(going.select(*key, "text").join(chosen, key)
                        .select("text", "chosen").mapInArrow(_byte_rows, _BYTES))
    shards = max(1, -(-parts.count() // shard_passages))
    built = parts.where(F.col("kinds") <= hot_passages).withColumn(
        "shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInArrow(_shard, _RUNS)
    counted = _counted(parts.where(F.col("kinds") > hot_passages).select("anchor", "content", "bytes"))
    # A passage that occurs twice is repeated from its first window to its last.
    twice = rows.join(kinds.where("k > 1"), ["anchor", "content"]).select(
        *key, F.array("at").alias("start"), F.array(F.col("at") + F.col("n")).alias("stop"))
    runs = built.union(counted).where(F.size("start") > 0)
    met = rows.join(runs, ["anchor", "content"]).select(
        *key, F.transform("start", lambda x: x + F.col("at")).alias("start"),
        F.transform("stop", lambda x: x + F.col("at")).alias("stop"))
    marks = met.union(twice).groupBy(*key).agg(
        F.flatten(F.collect_list("start")).alias("start"), F.flatten(F.collect_list("stop")).alias("stop"))
    cut = going.where("not copies").join(marks, key, "left") \
        .select("doc_id", "text", "start", "stop").mapInArrow(_strip, _KEPT)
    plain = prepared.where("text is null or copies").select(
        "doc_id", "n_bytes", F.when(F.col("copies"), F.col("n_bytes")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(F.col("copies"), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("n_spans"),
        F.when(F.col("copies"), F.unhex(F.sha2(F.lit("").cast("binary"), 256))).otherwise(F.col("whole"))
        .alias("kept_sha256"))
    return cut.union(plain).select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.lower(F.hex("kept_sha256")).alias("kept_sha256"))
