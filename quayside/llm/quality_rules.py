"""Quality rules, line first.

Every line of a text is judged on its own: its punctuation, the marks of a
navigation bar, and phrases of site boilerplate. Lines that fail are removed.
A text is then rejected when it lost too much, or when the basic measures of the
whole text (too few words, too many repeated three-word windows) fail.

A line fails when it is, in this order of names:

* ``boilerplate``: it contains one of ``BOILERPLATE`` (any letter case of A-Z);
* ``navigation``: separators (``|`` and ``>``) make up at least a quarter of its words;
* ``symbols``: more than 30 symbols of ``[#*$%&|<>]`` for each 100 words, and at least three;
* ``shouting``: five letters of A-Z or more, and more of them than of a-z;
* ``unfinished``: fewer than three words and no closing mark at its end.

Lines without a word carry no text and are neither failed nor counted.

Words are ``[^\\x20\\x09-\\x0D]+``; lines are split on ``\\n``. Equal lines and equal
windows are found by 64-bit hashes within a text.

Defined results: null text is empty, has no word and is not kept; repeated rows
are judged alike; extra columns are carried by ``clean_documents`` and not read
by ``quality_measures``. The memory of a task follows a block of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import kernel as K
from quayside.llm.tables import arrow_schema

MIN_WORDS = 50
MAX_REPEATED = 50  # hundredths of the words
MAX_LOST = 50  # hundredths of the word characters in failed lines
SEPARATOR_SHARE = 25
SYMBOL_SHARE = 30
BOILERPLATE = (
    "all rights reserved", "terms of use", "privacy policy", "cookie policy", "accept cookies",
    "enable javascript", "lorem ipsum", "click here", "subscribe to our newsletter", "skip to content",
    "sign in", "log in to",
)
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CLOSING = np.zeros(256, dtype=bool)
CLOSING[list(b".!?:;\"')]")] = True
_MEASURES = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
             "n_repeat_words bigint, n_lines bigint, n_failed_lines bigint, lost_chars bigint")


def _per(owner: np.ndarray, texts: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weight, minlength=texts).astype(np.int64)


def _between(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[end] - sums[start]


def _found(data: np.ndarray, phrases: tuple[str, ...]) -> np.ndarray:
    """Places at which one of the phrases starts, whatever the case of A-Z."""
    lower = data.tobytes().lower()
    places = []
    for phrase in phrases:
        key, at = phrase.encode(), -1
        while (at := lower.find(key, at + 1)) >= 0:
            places.append(at)
    return np.array(sorted(places), dtype=np.int64)


class Judged:
    """Measures of the lines and texts of one block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        texts = len(offsets) - 1
        start, end, text = K.words(data, offsets)
        sums = K.prefix_hash(data)
        in_word = ~K.SPACES[data] & ((data & 0xC0) != 0x80)
        self.words = K.word_counts(text, texts)
        self.word_chars = _between(in_word, offsets[:-1], offsets[1:])
        self.symbols = _between(SYMBOLS[data], offsets[:-1], offsets[1:])

        window, place = K.grams(K.span_hash(sums, start, end), text, 3)
        again = K.repeated(K.tagged(window, text[place]))
        self.repeat_words = _per(text[K.covered(place[again], 3, len(text))], texts)

        a, b, owner = K.lines(data, offsets)
        first_word, past_word = np.searchsorted(start, a), np.searchsorted(start, b)
        line_words = past_word - first_word
        full = line_words > 0
        self.start, self.end, self.owner, self.full = a, b, owner, full
        self.lines = _per(owner[full], texts)
        keys = K.tagged(K.span_hash(sums, a[full], b[full]), owner[full])
        order = np.argsort(keys, kind="stable")
        later = np.zeros(len(keys), dtype=bool)
        later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
        self.dup_lines = _per(owner[full][later], texts)

        chars = _between(in_word, a, b)
        symbols = _between(SYMBOLS[data], a, b)
        alone = np.isin(data[start], list(b"|>")) & (end - start == 1)
        separators = _between(alone, first_word, past_word)
        upper = _between((data >= 65) & (data <= 90), a, b)
        small = _between((data >= 97) & (data <= 122), a, b)
        last = np.zeros(len(a), dtype=np.uint8)
        last[full] = data[end[past_word[full] - 1] - 1]
        phrases = _found(data, BOILERPLATE)
        boiler = np.searchsorted(phrases, b) > np.searchsorted(phrases, a)
        self.failed = full & (
            boiler | (100 * separators >= SEPARATOR_SHARE * np.maximum(line_words, 1))
            | ((symbols >= 3) & (100 * symbols > SYMBOL_SHARE * line_words))
            | ((upper >= 5) & (upper > small)) | ((line_words < 3) & ~CLOSING[last]))
        self.failed_lines = _per(owner[self.failed], texts)
        self.lost_chars = _per(owner[self.failed], texts, chars[self.failed])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_MEASURES)
    for batch in batches:
        for first, end, data, offsets in K.blocks(batch.column(1)):
            x = Judged(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, end - first)] + [pa.array(v) for v in (
                    x.words, x.word_chars, x.symbols, x.dup_lines, x.repeat_words, x.lines,
                    x.failed_lines, x.lost_chars)], schema=schema)


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, failed lines and both verdicts for each row of ``docs``."""
    found = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                        F.col(f"`{text_col}`").alias("text")).mapInArrow(_measure, _MEASURES)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST * F.col("word_chars")))


def clean_documents(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """The rows that are kept, without their failed lines; the columns of ``docs``.

    A count of characters is brought up to date where the table has one.
    """
    schema = docs.schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    at = schema.names.index(text_col)
    count_at = schema.names.index(n_chars_col) if n_chars_col in schema.names else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in K.blocks(batch.column(at)):
                x = Judged(data, offsets)
                keep = (x.words >= MIN_WORDS) & (100 * x.repeat_words <= MAX_REPEATED * x.words) \
                    & (100 * x.lost_chars <= MAX_LOST * x.word_chars)
                part = batch.slice(first, end - first)
                texts = part.column(at).to_pylist()
                bad = np.flatnonzero(x.failed)
                for row in np.unique(x.owner[bad]):
                    if keep[row]:
                        texts[row] = _without(texts[row], x.failed[x.owner == row])
                columns = list(part.columns)
                columns[at] = pa.array(texts, columns[at].type)
                if count_at is not None:
                    columns[count_at] = pa.array([None if t is None else len(t) for t in texts]) \
                        .cast(columns[count_at].type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))

    return docs.mapInArrow(clean, kinds)


def _without(text: str, failed: np.ndarray) -> str:
    return "\n".join(line for line, bad in zip(text.split("\n"), failed) if not bad)
