"""How filters interact: what each removes in every order of applying them.

Every row gets a mask of the filters it fails; counts of masks then answer all orders at
once. Filters A to D look at one text: too few words, too few distinct words, too many
capitals, markup characters. E fails a row whose text occurs under a smaller id
anywhere in the table, and is settled by compressed tries over whole texts:

1. *In the input's partitions* texts enter a trie as they are read. Its terminals hold the
   smallest id of each text, which settles all other rows of that text there; only rows
   with the smallest id go on with their text. However often a text is
   repeated, it leaves a partition's block of ``BLOCK_BYTES`` once.
2. *Ranges.* Rows are dealt out by the first ``PREFIXES[0]`` characters of their text.
   A prefix with more text than a range should hold, which is ``RANGE_BYTES`` at most, is
   replaced by the next longer ones, and so on up to the whole text, so texts with a common
   opening spread over ranges as well.
3. *In each range* all texts enter one trie. Its traversal compares the ids behind a
   terminal with the smallest one.
4. *Masks* are joined with the labels by id, without texts, and counted for each part.

Texts are compared as they are, not by hashes. On its way a text is written once and
shuffled once.

Defined results: null text is empty, null parts are the empty string; a row without an
id fails E never and makes no other fail it; rows with equal ids don't make each other fail it;
of several label rows of one id any may say good or toxic. An empty table gives no rows.
Extra columns are not read. The memory of a task follows a block or a range, which
holds one copy of a text, and the ids behind it, from each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import arrow_schema, cut_lineage, ship_package

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80  # hundredths of the words
MAX_CAPITALS = 10  # hundredths of the characters
MARKUP = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
COPY = 1 << FILTERS.index("E")
BLOCK_BYTES = 8 << 20
RANGE_BYTES, LEAST_RANGE = 16 << 20, 16 << 10
PREFIXES = (8, 64, 512, 4096)
_ROWS = "doc_id bigint, part string, mask int, copies bigint, text string"
_MASKS = "doc_id bigint, part string, mask int, copies bigint"


class Trie:
    """A compressed trie over byte strings; terminals hold the rows of their string.

    A node is a list: its children by their first byte, each an edge of label and node,
    then the smallest id and the rows (id, part, mask) with their number, if a string
    ends there.
    """

    def __init__(self) -> None:
        self.root: list = [{}, None, None]

    def add(self, text: bytes, doc_id: int, part: str, mask: int, copies: int = 1) -> bool:
        """Adds a row; whether the text is a new one."""
        node, at, size = self.root, 0, len(text)
        while at < size:
            edge = node[0].get(text[at])
            if edge is None:
                leaf = [{}, None, None]
                node[0][text[at]] = [text[at:], leaf]
                node = leaf
                break
            label = edge[0]
            if not text.startswith(label, at):
                cut = _shared(label, text, at)
                edge[:] = [label[:cut], [{label[cut]: [label[cut:], edge[1]]}, None, None]]
            at += len(edge[0])
            node = edge[1]
        new = node[2] is None
        if new:
            node[1], node[2] = doc_id, {}
        elif doc_id < node[1]:
            node[1] = doc_id
        row = (doc_id, part, mask)
        node[2][row] = node[2].get(row, 0) + copies
        return new

    def strings(self) -> Iterator[tuple[bytes, int, dict]]:
        """Every string with its smallest id and its rows, in no order."""
        stack = [(self.root, b"")]
        while stack:
            node, text = stack.pop()
            if node[2] is not None:
                yield text, node[1], node[2]
            stack += [(child, text + label) for label, child in node[0].values()]

    def terminals(self) -> Iterator[tuple[int, dict]]:
        """The smallest id and the rows of every string."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2] is not None:
                yield node[1], node[2]
            stack += [child for _, child in node[0].values()]


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many leading bytes of ``label`` stand at ``at`` in ``text``, which are not all."""
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def text_mask(raw: bytes, characters: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
            | (100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MAX_CAPITALS * characters) << 2
            | (len(raw.translate(None, MARKUP)) < len(raw)) << 3)


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settles the copies within each block; rows that go on keep their text."""
    schema = arrow_schema(_ROWS)

    def left(trie: Trie) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for text, least, rows in trie.strings():
            for (doc_id, part, mask), copies in rows.items():
                open_ = doc_id == least
                out.append((doc_id, part, mask if open_ else mask | COPY, copies, text if open_ else None))
                size += len(text) if open_ else 0
            if size > BLOCK_BYTES >> 2:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)

    trie, held = Trie(), 0
    for batch in batches:
        texts = batch.column("text")
        free: list[tuple] = []
        for doc_id, part, raw, size in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(),
                                           texts.cast(pa.binary()).to_pylist(), pc.utf8_length(texts).to_pylist()):
            mask = text_mask(raw, size)
            if doc_id is None:
                free.append((None, part, mask, 1, None))
                continue
            held += 64 + (len(raw) if trie.add(raw, doc_id, part, mask) else 0)
            if held > BLOCK_BYTES:
                yield from left(trie)
                trie, held = Trie(), 0
        if free:
            yield _batch(free, schema)
    yield from left(trie)


def _in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settles the copies of a range, whose rows are all of its texts."""
    schema = arrow_schema(_MASKS)
    trie = Trie()
    for batch in batches:
        for doc_id, part, mask, copies, raw in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "part", "mask", "copies")),
                batch.column("text").cast(pa.binary()).to_pylist()):
            trie.add(raw, doc_id, part, mask, copies)
    out: list[tuple] = []
    for least, rows in trie.terminals():
        out += [(doc_id, part, mask | COPY if doc_id > least else mask, copies)
                for (doc_id, part, mask), copies in rows.items()]
        if len(out) > 10_000:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary()).cast(pa.string()) if f.name == "text" else pa.array(c, f.type)
         for c, f in zip(columns, schema)], schema=schema)


def by_prefix(rows: DataFrame, limit: int = RANGE_BYTES, lengths: tuple[int, ...] = PREFIXES) -> DataFrame:
    """``rows`` (with ``text``) dealt out so that equal texts meet; prefixes adapt to what they hold.

    A range should hold ``limit`` bytes, or an even share of them where that is less. The
    prefixes of one length that are replaced are thus fewer than the ranges; Spark knows the
    size of the written list when it chooses a join.
    """
    cells = [F.substring("text", 1, n) for n in lengths] + [F.col("text")]
    key, total, open_ = cells[0], None, rows.select("text")
    dealt, parts = rows, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for n, (cell, longer) in enumerate(zip(cells, cells[1:])):
        counted = open_.groupBy(cell.alias("cell")).agg(F.sum(F.octet_length("text") + 64).alias("bytes"))
        if total is None:
            counted = cut_lineage(counted)
            total = counted.agg(F.sum("bytes")).first()[0] or 0
            parts = max(parts, -(-total // limit))
            share = max(min(LEAST_RANGE, limit), total // parts)
        heavy = cut_lineage(counted.where(F.col("bytes") > share).select("cell"))
        if heavy.isEmpty():
            break
        open_ = open_.join(heavy, cell == F.col("cell"), "left_semi")
        mark = heavy.select(F.col("cell").alias(f"_cell{n}"))
        dealt = dealt.join(mark, cell == F.col(f"_cell{n}"), "left")
        key = F.when(F.col(f"_cell{n}").isNotNull(), longer).otherwise(key)
    return dealt.select(*rows.columns, key.alias("_key")).repartitionByRange(parts, "_key").select(*rows.columns)


def failure_masks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Rows (doc_id, part, mask, copies): bit n of ``mask`` is set where ``FILTERS[n]`` fails.

    Rows that agree in id, part and text may come as one, with their number in ``copies``.
    """
    ship_package(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    judged = cut_lineage(docs.mapInArrow(_in_blocks, _ROWS))
    open_ = by_prefix(judged.where("text is not null"))
    return open_.mapInArrow(_in_ranges, _MASKS).union(judged.where("text is null").drop("text"))


def _steps(counts: DataFrame) -> DataFrame:
    """Every row with every order and step, the step's bit and the bits of the steps before it."""
    orders = F.split(F.lit(" ".join("".join(o) for o in permutations(FILTERS))), " ")
    bit = lambda letter: f"shiftleft(1, ascii({letter}) - {ord(FILTERS[0])})"
    return counts.select("*", F.explode(orders).alias("filter_order")) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")) \
        .select("*", F.expr(bit("substring(filter_order, step, 1)")).alias("bit"),
                F.expr("aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (b, x) -> b + "
                       + bit("x") + ")").alias("before"))


def interactions(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    said = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("quality") == 1).alias("good"),
                         (F.col("toxic") == 1).alias("toxic")).where("doc_id is not null and (good or toxic)") \
        .groupBy("doc_id").agg(F.coalesce(F.max("good"), F.lit(False)).alias("good"),
                               F.coalesce(F.max("toxic"), F.lit(False)).alias("toxic"))
    known = masks.join(said, "doc_id", "left")
    count = lambda flag: F.sum(F.when(F.col(flag), F.col("copies")).otherwise(0))
    counts = cut_lineage(known.groupBy("part", "mask").agg(
        F.sum("copies").alias("n"), count("good").alias("good"), count("toxic").alias("toxic")))
    rows = _steps(counts)  # 600 for each of at most 32 masks of a part, whatever the number of documents
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, reached = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) == 0
    total = lambda test, what="n": F.sum(F.when(test, F.col(what)).otherwise(0)).cast("bigint")
    orders = F.lit(120)
    share = F.when(fails, F.col("n") * (orders / F.greatest(F.bit_count(mask), F.lit(1))).cast("bigint")).otherwise(0)
    return rows.groupBy("part", "filter_order", "step").agg(
        total(mask.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(fails & reached).alias("removed"), total(fails & ~reached).alias("redundant"),
        total(mask == bit).alias("unique_fails"), total(fails & reached, "good").alias("good_lost"),
        total(fails & reached, "toxic").alias("toxic_lost"), F.sum(share).cast("bigint").alias("shapley"))
