"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel distance.

A text contains an item if some stretch of it is within the item's error budget
(``RATE`` of its length, in edits). Cut into budget + 1 pieces, at least one
piece of the item must then occur unchanged. An automaton over all pieces finds
the exact hits in one pass over each text; each hit fixes a window in which the
whole item must lie, and Myers' algorithm (one big integer per bit vector)
finds the least distance of the item to any stretch of that window.

Texts and items are compared in normal form: UTF-8 bytes, ASCII and Latin-1
letters in lower case, everything else in ASCII but letters and digits as one
space, a space at both ends. Distances and offsets count bytes of that form.

Items are the stated query set. They go to the executors in blocks of at most
``BLOCK_BYTES``; more blocks mean more passes over the texts, each written
before the next block is read, so neither the driver nor a worker holds more
than one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from newsevents.llm.bpe import spread
from newsevents.llm.common import arrow_map, batches, slices, text_buffer, written

#: Error budget as a share of an item's length, and the bytes of items in a block.
RATE, BLOCK_BYTES = 0.08, 1 << 20

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def normalise(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal form of each text and its offsets."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    # Each text between two spaces, so that runs of spaces never join two texts.
    at = offsets[:-1] - offsets[0] + 2 * np.arange(n)
    wide = np.full(int(size.sum()) + 2 * n, 0x20, np.uint8)
    folded = _FOLD.take(buf[offsets[0]:offsets[-1]])
    # Latin-1 capitals in UTF-8: 0xC3 0x80-0x9E without the multiplication sign.
    high = np.flatnonzero(folded[:-1] == 0xC3) + 1
    high = high[(folded[high] >= 0x80) & (folded[high] <= 0x9E) & (folded[high] != 0x97)]
    folded[high] += 0x20
    wide[spread(at + 1, size)] = folded
    keep = np.ones(len(wide), bool)
    keep[1:] = (wide[1:] != 0x20) | (wide[:-1] != 0x20)
    keep[at] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    starts = before[at]
    off = np.append(starts, before[-1])
    return wide[keep], off


def myers(pattern: bytes, text: bytes, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a stretch of ``text``, and where the first such stretch ends.

    ``anchored``: the stretch starts where ``text`` does.
    """
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    eq_of: dict[int, int] = {}
    for i, c in enumerate(pattern):
        eq_of[c] = eq_of.get(c, 0) | 1 << i
    pv, mv, score = full, 0, m
    best, end, carry = m, 0, int(anchored)
    get = eq_of.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 | carry
        mh <<= 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
        if score < best:
            best, end = score, j + 1
    return best, end


class Block:
    """Items and the automaton of their pieces."""

    def __init__(self, items: list[tuple[object, bytes]], rate: float):
        self.items = [(key, p, int(rate * len(p))) for key, p in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, p, budget) in enumerate(self.items):
            cuts = [len(p) * k // (budget + 1) for k in range(budget + 2)]
            for a, z in zip(cuts, cuts[1:]):
                where.setdefault(p[a:z].decode("latin-1"), []).append((i, a))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in where.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def find(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best stretch for each item that ``text`` contains."""
        spots: dict[int, set[int]] = {}
        for last, (size, owners) in self.automaton.iter(text.decode("latin-1")):
            for i, a in owners:
                spots.setdefault(i, set()).add(last + 1 - size - a)
        found = []
        for i, starts in spots.items():
            _, p, budget = self.items[i]
            best = None
            for low, high in _windows(sorted(starts), budget):
                a = max(0, low - budget)
                window = text[a:high + len(p) + budget]
                d, end = myers(p, window)
                if d <= budget and (best is None or d < best[0]):
                    _, back = myers(p[::-1], window[:end][::-1], anchored=True)
                    best = d, a + end - back, a + end
            if best:
                found.append((i, *best))
        return sorted(found)


def _windows(starts: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """First and last of the starts that lie within twice the budget of each other, so that hits of one stretch are verified once."""
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > 2 * budget:
            yield low, high
            low = s
        high = s
    yield low, high


def blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """Items in normal form, in blocks; items without letters or digits are left out."""
    block, size = [], 0
    for key, text in items.select(id_col, text_col).where(F.col(text_col).isNotNull()).orderBy(id_col, text_col).toLocalIterator():
        raw = np.frombuffer(text.encode(), np.uint8)
        p = normalise(raw, np.array([0, len(raw)]))[0].tobytes()
        if not p.strip():
            continue
        if block and size + len(p) > block_bytes:
            yield block
            block, size = [], 0
        block.append((key, p))
        size += len(p)
    if block:
        yield block


def _texts(col: pa.Array) -> Iterator[tuple[int, bytes]]:
    """Row and normal form of each text."""
    buf, off = text_buffer(col)
    for i, j in slices(off):
        data, own = normalise(buf, off[i:j + 1])
        raw, cuts = data.tobytes(), own.tolist()
        for r in range(j - i):
            yield i + r, raw[cuts[r]:cuts[r + 1]]


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES,
                 id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, distance int, start int, end int`` for each text and item it contains.

    The best stretch is given: least distance, then first end. Null and empty
    texts contain nothing; null and empty items, and those without a letter or
    digit, are in no text. Short items (budget 0) must occur as whole words.
    Repeated rows are reported as often as they come; null ids stay null. Texts
    of any length are searched whole.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_id]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, start int, end int"
    key_type = to_arrow_type(items.schema[item_id].dataType)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def search(block):
        shared = spark.sparkContext.broadcast(block)  # at most block_bytes (or one item)

        def run(it):
            index = Block(shared.value, rate)
            for b in batches(it):
                rows = [(r, *hit) for r, text in _texts(b.column(1)) for hit in index.find(text)]
                if rows:
                    row, item, *rest = zip(*rows)
                    keys = pa.array([index.items[i][0] for i in item], key_type)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), keys, *[pa.array(x, pa.int32()) for x in rest]],
                                                     ["doc_id", "item_id", "distance", "start", "end"])

        return arrow_map(plain, run, schema)

    out, queue = None, blocks(items, item_id, item_text, block_bytes)
    block = next(queue, None)
    while block is not None:
        after = next(queue, None)
        part = search(block)
        if out is not None or after is not None:
            part = written(part, "contaminated")
        out = part if out is None else out.unionByName(part)
        block = after
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES, text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item; one pass a block, nothing is shuffled.

    All columns are kept, whatever they are called; null and empty texts stay.
    """
    spark = docs.sparkSession
    names = [f"_k{i}" for i in range(len(docs.columns))]
    out = docs.toDF(*names)
    text = names[docs.columns.index(text_col)]
    for block in blocks(items, item_id, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def run(it, shared=shared):
            index = Block(shared.value, rate)
            for b in batches(it):
                keep = np.ones(b.num_rows, bool)
                for r, raw in _texts(b.column(b.schema.get_field_index(text))):
                    keep[r] = not index.find(raw)
                yield b.filter(pa.array(keep))

        out = arrow_map(out, run, ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields)))
    return out.toDF(*docs.columns)
