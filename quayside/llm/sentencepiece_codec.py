"""SentencePiece encoding and decoding with a table of distinct chunks.

A model whose pieces hold the whitespace marker only at their front cannot merge
across the place between an ordinary character and a marker. Every text is cut
there into marked words, each distinct one of a block of texts (found by Arrow's
dictionary encoding, which compares the bytes) is segmented once by the library, and the
ids are joined back by position with array lookups. The pieces of the model are checked
before use.

The table belongs to a block of ``TABLE_BYTES`` of texts. A table for the whole
corpus would take a shuffle of all (block, word) pairs and of their ids back to the
texts, more than the input itself, and save less than the shuffle costs.

Ids travel as little-endian unsigned 32-bit integers in a binary column. Decoding
is the library's own.

``encode_and_decode`` does both in one pass, so that a core holds one model and one table.

Defined results: null text is empty and has only the ids asked for at its ends;
null ids decode to the empty text; repeated rows give repeated rows and rows without an
id keep none; an empty table gives no rows; extra columns, whatever their names, are
not read. Memory follows a block, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import kernel as K
from quayside.llm.tables import arrow_schema, documents

MARK = "▁"
TABLE_BYTES = 2 << 20
_TEXTS = 256  # that are decoded at a time
_ENCODED = "doc_id bigint, ids binary"
_DECODED = "doc_id bigint, ids binary, text string"


def load(model_path: str):
    """The processor of a model that this method can serve; others raise ValueError."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    crossing = [p for p in map(model.id_to_piece, range(model.vocab_size())) if MARK in p.lstrip(MARK)]
    if crossing or model.normalize(" a  ﬁ") != f"{MARK * 2}a{MARK * 2}ﬁ":
        raise ValueError("the model merges across whitespace markers or rewrites texts")
    return model


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks, without the marker in front, and their text numbers.

    The first chunk of a text has the marker that the library puts in front of it, so
    nothing is taken off it; no other chunk but a lone last marker can end up empty.
    """
    mark = data == 0x20
    long = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        long[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    inside = mark | long
    inside[1:] |= long[:-1]
    inside[2:] |= long[:-2]
    head = mark | long
    head[1:] &= ~inside[:-1]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    head[offsets[filled]] = True
    start = np.flatnonzero(head)
    end = np.append(start[1:], len(data)) if len(start) else start
    text = np.searchsorted(offsets, start, side="right") - 1
    first = start == offsets[text]
    skip = np.where(first, 0, np.where(long[start], 3, 1))
    return start + skip, end, text


def _table(data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct chunks of a block, which of them each chunk is, and the text of each chunk."""
    start, end, text = chunks(data, offsets)
    change = np.zeros(len(data) + 1, dtype=np.int8)
    filled = end > start
    change[start[filled]] += 1  # chunks are disjoint, so no place begins or ends two of them
    change[end[filled]] -= 1
    bodies = data[np.cumsum(change[:-1], dtype=np.int8) > 0]
    edges = np.concatenate([[0], np.cumsum(end - start)])
    found = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(bodies)]).dictionary_encode()
    words = [x.decode() for x in found.dictionary.to_pylist()]
    return words, found.indices.to_numpy(zero_copy_only=False), text


def encoded_blocks(column: pa.Array, model) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs (first row, end row, ids of all texts, edges of the texts in them)."""
    blank = model.piece_to_id(MARK)
    for first, end, data, offsets in K.blocks(column, TABLE_BYTES):
        words, place, text = _table(data, offsets)
        pieces = [p if p else [blank] for p in model.encode(words, num_threads=1)]  # none: a lone marker
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        flat = np.fromiter(chain.from_iterable(pieces), dtype=np.uint32, count=int(size.sum()))
        del words, pieces
        at = np.cumsum(size) - size
        long = size[place]
        done = np.cumsum(long)
        ids = flat[np.repeat(at[place] - (done - long), long) + np.arange(int(long.sum()))]
        counts = np.bincount(text, weights=long, minlength=end - first).astype(np.int64)
        yield first, end, ids, np.concatenate([[0], np.cumsum(counts)])


def _ends(model, add_bos: bool, add_eos: bool) -> tuple[bytes, bytes]:
    raw = lambda i: int(i).to_bytes(4, "little")
    return raw(model.bos_id()) if add_bos else b"", raw(model.eos_id()) if add_eos else b""


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           add_bos: bool = True, add_eos: bool = True) -> DataFrame:
    """Rows (doc_id, ids), exactly the ids of the library for each whole text."""
    schema = arrow_schema(_ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        head, tail = _ends(model, add_bos, add_eos)
        for batch in batches:
            for first, end, ids, edges in encoded_blocks(batch.column(1), model):
                raw = [head + ids[x:y].tobytes() + tail for x, y in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(raw, pa.binary())], schema=schema)

    return documents(docs, id_col, text_col).mapInArrow(run, _ENCODED)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Rows (doc_id, ids, text) for rows (doc_id, ids)."""
    schema = arrow_schema(_DECODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                ids = [np.frombuffer(v.as_buffer() if v.is_valid else b"", dtype="<u4").tolist()
                       for v in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(model.decode(ids, num_threads=1), pa.string())], schema=schema)

    return encoded.select(F.col("doc_id"), F.col("ids")).mapInArrow(run, _DECODED)


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                      add_bos: bool = True, add_eos: bool = True) -> DataFrame:
    """Rows (doc_id, ids, text): what ``decode`` makes of ``encode``, in one pass over the texts."""
    schema = arrow_schema(_DECODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        head, tail = _ends(model, add_bos, add_eos)
        for batch in batches:
            for first, end, ids, edges in encoded_blocks(batch.column(1), model):
                for at in range(0, end - first, _TEXTS):
                    spans = edges[at:at + _TEXTS + 1].tolist()
                    raw = [head + ids[x:y].tobytes() + tail for x, y in zip(spans, spans[1:])]
                    lists = [np.frombuffer(x, dtype="<u4").tolist() for x in raw]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first + at, len(raw)), pa.array(raw, pa.binary()),
                         pa.array(model.decode(lists, num_threads=1), pa.string())], schema=schema)

    return documents(docs, id_col, text_col).mapInArrow(run, _DECODED)
