"""Substring deduplication with repeated-phrase automata.

A window is ``WINDOW`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one text. A word goes
when a window over it also starts in a document with a smaller id. Windows are judged
on the input.

1. *Anchors.* Of the five-word shingles of a window the one with the smallest hash is
   its anchor, so equal windows have equal anchors, and neighbouring windows mostly
   share one: a text has an anchor for five or six windows. Anchors that occur in one
   text only (whatever its number of copies) are done with.
2. *Confirmation.* The windows around the remaining anchors are hashed; those of two
   or more documents, with the smallest document of each, are the repeated phrases.
   Exact copies of a document are settled by their digest and stand aside.
3. *Automata.* Documents with phrases from smaller documents are dealt out by their
   id. Each block of them compiles an Aho-Corasick automaton of its phrases, over
   words rather than characters, and the whole texts are streamed through it to find
   every occurrence. An automaton holds the phrases of its block only, so its size
   follows the block and every text is streamed once, however many phrases there are.

Nothing is grouped by phrase or anchor in one task: minima are combined map-side and
joined back. Texts are shuffled once, and those with candidates a second time.

Defined results: null text has no words; rows without an id lose nothing and take
nothing from others; rows with equal ids do not shorten each other; fewer than
``WINDOW`` words keep all. Extra columns are not read. The memory of a task follows a
block of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import kernel as K
from quayside.llm.tables import arrow_schema, cut_lineage, discard, documents, free_shuffles

WINDOW, ANCHOR = 13, 5
NO_ID = -(1 << 63)
# Words with an automaton of their own: far fewer than there are code points, and few
# enough for its root, whose children are searched one after the other.
RUN_WORDS = 1 << 13
_ANCHORS = "doc_id bigint, t bigint, anchor bigint, spot bigint"
_PREPARED = "doc_id bigint, t bigint, n_words bigint, whole binary, copy boolean, text string, spots array<bigint>"
_FOUND = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 binary"
_HASHED = "doc_id bigint, t bigint, w bigint"


def _words(data: np.ndarray, offsets: np.ndarray):
    start, end, text = K.words(data, offsets)
    return start, end, text, K.span_hash(K.prefix_hash(data), start, end)


def anchors(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows for each run of windows with one anchor."""
    shingle, place = K.grams(hashes, text, ANCHOR)
    width = WINDOW - ANCHOR + 1
    least = K.sliding_minimum(shingle, width)
    first = place[:len(least)]
    whole = place[width - 1:width - 1 + len(least)] - first == width - 1
    whole &= text[first] == text[place[width - 1:width - 1 + len(least)]]
    least, first = least[whole], first[whole]
    head = np.ones(len(least), dtype=bool)
    head[1:] = (least[1:] != least[:-1]) | (first[1:] != first[:-1] + 1) | (text[first[1:]] != text[first[:-1]])
    at = np.flatnonzero(head)
    return least[at], first[at], np.diff(np.append(at, len(least)))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_ANCHORS)
    for batch in batches:
        ids, t = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, end_row, data, offsets in K.blocks(batch.column(2)):
            _, _, text, hashes = _words(data, offsets)
            value, first, n = anchors(hashes, text)
            counts = K.word_counts(text, end_row - row)
            heads = np.cumsum(counts) - counts
            owner = text[first]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[row:end_row][owner]), pa.array(t[row:end_row][owner]), pa.array(value.view(np.int64)),
                pa.array((first - heads[owner]) << 32 | n)], schema=schema)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and the digest of all words; texts go on only where something may be removed."""
    schema = arrow_schema(_PREPARED)
    for batch in batches:
        counts, digests = [], []
        for text in batch.column("text"):
            words = (text.as_py() or "").encode().split()
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).digest())
        copy, spots = batch.column("copy").fill_null(False), batch.column("spots")
        going = np.asarray(spots.is_valid()) & ~np.asarray(copy)
        text = batch.column("text").cast(pa.string())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("t"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
            copy, _only(text, going), _only(spots.cast(pa.list_(pa.int64())), going)], schema=schema)


def _only(column: pa.Array, flags: np.ndarray) -> pa.Array:
    import pyarrow.compute as pc

    return pc.if_else(pa.array(flags), column, pa.scalar(None, column.type))


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of the windows around the remaining anchors, once for each text."""
    schema = arrow_schema(_HASHED)
    for batch in batches:
        ids, t = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, end_row, data, offsets in K.blocks(batch.column(2)):
            _, _, text, hashes = _words(data, offsets)
            window, place = K.grams(hashes, text, WINDOW)
            counts = K.word_counts(text, end_row - row)
            heads = np.cumsum(counts) - counts
            spots = batch.column(3).slice(row, end_row - row)
            owner = np.repeat(np.arange(end_row - row), np.diff(spots.offsets.to_numpy()))
            spots = spots.flatten().to_numpy()
            # An id on several rows has the spots of all of them; those past the text's end go.
            past = (heads + counts)[owner]
            first = np.minimum(heads[owner] + (spots >> 32), past)
            change = np.zeros(len(text) + 1, dtype=np.int32)
            np.add.at(change, first, 1)
            np.add.at(change, np.minimum(first + (spots & 0xFFFFFFFF), past), -1)
            wanted = (np.cumsum(change[:-1]) > 0)[place]
            window, owner = window[wanted], text[place[wanted]]
            _, once = np.unique(K.tagged(window, owner), return_index=True)
            once.sort()
            window, owner = window[once], owner[once]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[row:end_row][owner]), pa.array(t[row:end_row][owner]),
                pa.array(window.view(np.int64))], schema=schema)


def _symbols(numbers: np.ndarray) -> str:
    """One character for each word number, clear of the surrogates."""
    points = np.where(numbers < 0xD800, numbers, numbers + 0x800).astype("<u4")
    return points.tobytes().decode("utf-32-le")


def located(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray,
            phrases: np.ndarray, smallest: np.ndarray) -> np.ndarray:
    """Which words of a block lie in an occurrence of a phrase whose smallest document comes before theirs.

    ``phrases`` are window hashes, with the smallest document of each. The automaton
    holds their positions, because it hands out 32 bits of a number only. A block
    is searched in runs of words that overlap by all but one word of a window.
    """
    import ahocorasick

    _, _, text, hashes = _words(data, offsets)
    gone = np.zeros(len(text) + 1, dtype=np.int32)
    keys, at = np.unique(phrases.view(K.U64), return_index=True)
    values, ends = smallest[at], []
    for run in range(0, len(text) if len(keys) else 0, RUN_WORDS):
        past = min(run + RUN_WORDS + WINDOW - 1, len(text))
        window, place = K.grams(hashes[run:past], text[run:past], WINDOW)
        known, sample = np.unique(window, return_index=True)
        spot = np.minimum(np.searchsorted(keys, known), len(keys) - 1)
        hit = np.flatnonzero(keys[spot] == known)
        if not len(hit):
            continue
        first = values[spot[hit]].tolist()
        _, numbers = np.unique(hashes[run:past], return_inverse=True)
        line = _symbols(numbers)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, head in enumerate(place[sample[hit]].tolist()):
            automaton.add_word(line[head:head + WINDOW], number)
        automaton.make_automaton()
        heads = np.flatnonzero(np.diff(text[run:past], prepend=-1))
        docs = ids[text[run + heads]].tolist()
        for doc, head, tail in zip(docs, heads.tolist(), [*heads[1:].tolist(), past - run]):
            ends += [run + head + end for end, number in automaton.iter(line[head:tail]) if first[number] < doc]
    ends = np.array(ends, dtype=np.int64)
    np.add.at(gone, ends - WINDOW + 1, 1)
    np.add.at(gone, ends + 1, -1)
    return np.cumsum(gone[:-1]) > 0


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_FOUND)
    for batch in batches:
        ids, lists = batch.column(0).to_numpy(), batch.column(2)
        for row, end_row, data, offsets in K.blocks(batch.column(1)):
            pairs = lists.slice(row, end_row - row).flatten()
            gone = located(data, offsets, ids[row:end_row],
                           pairs.field("w").to_numpy(), pairs.field("first").to_numpy())
            start, end, text = K.words(data, offsets)
            counts = K.word_counts(text, end_row - row)
            removed = np.bincount(text[gone], minlength=end_row - row)
            raw, digests, head = data.tobytes(), [], 0
            for count in counts.tolist():
                keep = np.flatnonzero(~gone[head:head + count]) + head
                digests.append(hashlib.sha256(b" ".join(
                    [raw[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist())])).digest())
                head += count
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, end_row - row), pa.array(counts), pa.array(removed.astype(np.int64)),
                pa.array(digests, pa.binary())], schema=schema)


def remove_repeated_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), one for each row of ``docs``."""
    texts = documents(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    named = texts.where(F.col("doc_id") != NO_ID)

    # Copies: the same text under a smaller id.
    digests = named.select("doc_id", "t", F.md5("text").alias("digest"))
    least = digests.groupBy("digest").agg(F.min("doc_id").alias("least"))
    copies = digests.join(least, "digest").where("doc_id > least").select("doc_id", "t").distinct() \
        .select("doc_id", "t", F.lit(True).alias("copy"))

    found = named.mapInArrow(_anchor_rows, _ANCHORS)
    recurring = cut_lineage(found.groupBy("anchor").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
                            .where("lo <> hi").select("anchor"))
    free_shuffles(docs.sparkSession)
    spots = found.join(recurring, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_list("spot").alias("spots"))
    notes = cut_lineage(named.select("doc_id", "t").join(spots, "doc_id").dropDuplicates(["doc_id", "t"])
                        .join(copies, ["doc_id", "t"], "full"))
    discard(recurring)
    free_shuffles(docs.sparkSession)
    prepared = cut_lineage(texts.join(notes, ["doc_id", "t"], "left").mapInArrow(_prepare, _PREPARED))
    discard(notes)
    free_shuffles(docs.sparkSession)

    going = prepared.where("text is not null")
    windows = cut_lineage(going.select("doc_id", "t", "text", "spots").mapInArrow(_window_rows, _HASHED))
    first = cut_lineage(windows.groupBy("w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                        .where("first < last").select("w", "first"))
    free_shuffles(docs.sparkSession)
    phrases = cut_lineage(windows.join(first, "w").where("first < doc_id").groupBy("doc_id", "t").agg(
        F.collect_list(F.struct("w", "first")).alias("phrases")))
    discard(windows, first)
    free_shuffles(docs.sparkSession)
    cut = going.select("doc_id", "t", "text").join(phrases, ["doc_id", "t"], "left") \
        .select("doc_id", "text", "phrases").mapInArrow(_remove, _FOUND)

    # Whole or untouched: copies lose all their words, if there are enough for a window.
    settled = prepared.where("text is null").withColumn("all", F.col("copy") & (F.col("n_words") >= WINDOW))
    plain = settled.select(
        "doc_id", "n_words", F.when(F.col("all"), F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(F.col("all"), F.unhex(F.sha2(F.lit("").cast("binary"), 256))).otherwise(F.col("whole"))
        .alias("kept_sha256"))
    return cut.union(plain).select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_words", "n_removed",
        F.lower(F.hex("kept_sha256")).alias("kept_sha256"))
