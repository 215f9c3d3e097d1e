"""Ranked lexical search, reversed: the items are indexed, the documents are the stream.

The items (a stated query set) are few and the documents many. So the inverted
index is built over the items' terms (term -> items and how often) and broadcast;
each task streams its documents' term counts through it and keeps, for each item, a
heap of the ``k`` best documents so far. What leaves a task is at most ``k`` rows an
item, whatever it read; the heaps are merged by two bounded windows, first in ``MERGE`` groups of
tasks, then over all.

A term's weight needs the corpus: one pass before counts the documents, their terms
and, for the items' terms only, the documents that hold each. Its rows are the items'
terms once a task, summed by Spark.

Items go out in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of text (or one item); each
block is two passes over the texts, and its result is written before the next one is
read, so the driver and a worker hold the index of one block.

Terms are the runs of letters and digits of ASCII and of all characters beyond it;
only A-Z are lower-cased. As every byte of a character beyond ASCII is 128 or
more, the terms of a text are those of its UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from newsevents.llm.bpe import spread
from newsevents.llm.common import arrow_map, batches, written

#: Documents returned for an item; items and bytes of a block; scores held at once; groups of tasks in the first merge.
TOP, BLOCK_ITEMS, BLOCK_BYTES, CELLS, MERGE = 10, 4096, 1 << 20, 1 << 20, 64

_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in their order, in UTF-8; null has none."""
    return text.encode().translate(_TERM).split() if text else []


def blocks(items: DataFrame, id_col: str, text_col: str, block_items: int, block_bytes: int) -> Iterator[list[tuple[object, Counter]]]:
    """Items and their term counts, in blocks; items without a term are left out."""
    block, size = [], 0
    for key, text in items.select(id_col, text_col).where(F.col(text_col).isNotNull()).orderBy(id_col, text_col).toLocalIterator():
        found = terms(text)
        own = sum(map(len, found))
        if block and found and (len(block) >= block_items or size + own > block_bytes):
            yield block
            block, size = [], 0
        if found:
            block.append((key, Counter(found)))
            size += own
    if block:
        yield block


class Index:
    """Postings of the terms of weight above 0: for each, the items that hold it and how often."""

    def __init__(self, block: list[tuple[object, Counter]], weight: dict[bytes, int]):
        owners: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, counts) in enumerate(block):
            for t, n in counts.items():
                if weight.get(t, 0) > 0:
                    owners.setdefault(t, []).append((i, n))
        self.keys = [key for key, _ in block]
        self.place = {t: j for j, t in enumerate(owners)}
        self.weight = np.array([weight[t] for t in owners], np.int64)
        self.size = np.array([len(o) for o in owners.values()], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.item = np.array([i for o in owners.values() for i, _ in o], np.int64)
        self.times = np.array([n for o in owners.values() for _, n in o], np.int64)

    def scores(self, found: list[list[bytes]], n_docs: int, n_terms: int) -> np.ndarray:
        """Scores of documents (rows, each a list of terms) for the items (columns)."""
        out = np.zeros(len(found) * len(self.keys), np.int64)
        for r, own in enumerate(found):
            counts = Counter(map(self.place.get, own))
            counts.pop(None, None)
            if not counts:
                continue
            at, tf = np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))
            m = 25 + 75 * len(own) * n_docs // n_terms
            value = self.weight[at] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            post = spread(self.first[at], self.size[at])
            np.add.at(out, r * len(self.keys) + self.item[post], self.times[post] * np.repeat(value, self.size[at]))
        return out.reshape(len(found), len(self.keys))


class Entry:
    """A document in a heap; the least entry is the worst: the lowest score, then the greatest id, null greatest of all."""

    __slots__ = ("score", "doc")

    def __init__(self, score: int, doc: object):
        self.score, self.doc = score, doc

    def __lt__(self, other: Entry) -> bool:
        if self.score != other.score:
            return self.score < other.score
        return other.doc is not None and (self.doc is None or self.doc > other.doc)


class Heaps:
    """The ``k`` best documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.of = k, [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, np.int64)  # a lower score can't enter

    def offer(self, docs: list, scores: np.ndarray) -> None:
        rows, items = np.nonzero(scores >= self.floor)
        for r, i, s in zip(rows.tolist(), items.tolist(), scores[rows, items].tolist()):
            heap, e = self.of[i], Entry(s, docs[r])
            if len(heap) < self.k:
                heapq.heappush(heap, e)
            elif heap[0] < e:
                heapq.heapreplace(heap, e)
            if len(heap) == self.k:
                self.floor[i] = heap[0].score


def _corpus(plain: DataFrame, words: list[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, terms of all documents, and for each of ``words`` the documents that hold it."""
    shared = plain.sparkSession.sparkContext.broadcast({t: j for j, t in enumerate(words)})  # the terms of a block

    def run(it):
        place = shared.value
        df, n_docs, n_terms = np.zeros(len(place) + 1, np.int64), 0, 0
        for b in batches(it):
            for text in b.column(1):
                own = terms(text.as_py())
                n_docs += bool(own)
                n_terms += len(own)
                seen = set(map(place.get, own))
                seen.discard(None)
                if seen:
                    df[list(seen)] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, [-1, -2])), pa.array(np.append(df[held], [n_docs, n_terms]))], ["word", "n"])

    counted = arrow_map(plain, run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {r.word: r.n for r in counted.toLocalIterator()}
    return n.get(-1, 0), n.get(-2, 0), {words[j]: df for j, df in n.items() if j >= 0}


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES,
           id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank int, doc_id, score long``: the ``k`` best documents of each item, score above 0.

    Equal scores go by ascending id, a null id after all others. A row of ``items`` is an item, also one
    of a repeated or null id; an item that is null, or without a term, finds nothing, and so does a document. Repeated documents
    are ranked each. Whole texts are searched; other columns are not read.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_id]
    key_type, doc_type = to_arrow_type(items.schema[item_id].dataType), to_arrow_type(docs.schema[id_col].dataType)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    final = f"item_id {kinds[1]}, rank int, doc_id {kinds[0]}, score long"

    def best(block):
        n_docs, n_terms, df = _corpus(plain, sorted({t for _, counts in block for t in counts}))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        shared = spark.sparkContext.broadcast((block, weight))  # of one block

        def run(it):
            index = Index(*shared.value)
            heaps, step = Heaps(len(index.keys), k), max(1, CELLS // len(index.keys))
            for b in batches(it):
                for i in range(0, b.num_rows, step):
                    part = b.slice(i, step)
                    found = [terms(t.as_py()) for t in part.column(1)]
                    heaps.offer(part.column(0).to_pylist(), index.scores(found, n_docs, n_terms))
            rows = [(i, index.keys[i], e.doc, e.score) for i, heap in enumerate(heaps.of) for e in heap]
            item, key, doc, score = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array([TaskContext.get().partitionId() % MERGE] * len(rows), pa.int32()),
                 pa.array(key, key_type), pa.array(doc, doc_type), pa.array(score, pa.int64())], ["item", "part", "item_id", "doc_id", "score"])

        out = arrow_map(plain, run, f"item int, part int, item_id {kinds[1]}, doc_id {kinds[0]}, score long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for groups in (["item", "part"], ["item"]):
            out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("rank") <= k)
        return out.select("item_id", "rank", "doc_id", "score")

    out, queue = None, blocks(items, item_id, item_text, block_items, block_bytes)
    block = next(queue, None)
    while block is not None:
        after = next(queue, None)
        part = best(block)
        if out is not None or after is not None:
            part = written(part, "search")
        out = part if out is None else out.unionByName(part)
        block = after
    return spark.createDataFrame([], final) if out is None else out
