"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 32 bytes sets the borders of chunks where its
top bits are zero, so borders move with the content: an insertion changes the
chunks around it and no others. Chunks are compared by digest; of equal chunks
the first by (document, place) stays. Neighbouring repeated chunks are joined
into spans, and spans of ``MIN_SPAN`` bytes (an average chunk) and more are
reported.

One exchange of all chunks, by half a digest, finds those that some other chunk
may equal: a task sends one row of each half digest it holds to the shared key and spreads
the rest, as they are known to be repeated. What is left (a fifth, say) is written,
and only that meets again: the first of equal chunks by a partial aggregate, its copies by a
join that Spark splits when a key is hot.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsevents.llm.common import arrow_map, batches, slices, text_buffer, written

#: Bits of the hash that must be zero (a border every 2 ** BITS bytes), shortest and longest chunk, shortest span reported.
BITS, MIN_CHUNK, MAX_CHUNK, MIN_SPAN = 4, 16, 512, 32
WINDOW, LENGTH_BITS = 32, 10
#: Chunks that a task holds before it sends them.
LOCAL_CHUNKS = 1 << 19

_GEAR = np.random.default_rng(8).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def gear(buf: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: the sum of the last 32 bytes' random numbers, each shifted by its distance."""
    h = _GEAR.take(buf)
    for step in (1, 2, 4, 8, 16):  # windows of 2, 4, ... bytes from two halves
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def borders(buf: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Chunk borders of each text, from 0 to its length (one border if it is empty)."""
    hit = np.flatnonzero(gear(buf) >> np.uint32(32 - BITS) == 0) + 1
    row = np.searchsorted(offsets, hit, side="left") - 1
    inside = hit - offsets[row] >= WINDOW  # the hash has seen this text's bytes only
    hit, row = hit[inside] - offsets[row[inside]], row[inside]
    first = np.searchsorted(row, np.arange(len(offsets)))
    hits, out = hit.tolist(), []
    for r, size in enumerate(np.diff(offsets).tolist()):
        cuts, last = [0], 0
        for h in [*hits[first[r]:first[r + 1]], size]:
            while h - last > MAX_CHUNK:
                last += MAX_CHUNK
                cuts.append(last)
            if h - last >= MIN_CHUNK or (h == size and h > last):
                cuts.append(h)
                last = h
        out.append(cuts)
    return out


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, version, place`` of every chunk, the halves ``d1, d2`` of its digest, and where it is sent.

    ``version`` tells rows with one id and different texts apart; ``place`` packs start and length. ``salt``
    is 0 for the first chunk of a digest that a task holds, ``twin`` marks digests that it holds twice.
    """
    kind = dict(docs.dtypes)[id_col]

    def send(held):
        ids, version = (pa.concat_arrays([h[k] for h in held]) for k in (0, 1))
        place, d1, d2 = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
        order = np.argsort(d1, kind="stable")
        d1 = d1[order]
        same = d1[1:] == d1[:-1]
        follows = np.concatenate([[False], same])
        at = pa.array(order)
        yield pa.RecordBatch.from_arrays(
            [pa.array(d1), pa.array(np.where(follows, 1 + order % 251, 0).astype(np.int16)), ids.take(at), version.take(at),
             pa.array(place[order]), pa.array(d2[order]), pa.array(follows | np.concatenate([same, [False]]))],
            ["d1", "salt", "doc_id", "version", "place", "d2", "twin"])

    def run(it):
        held, n = [], 0
        for b in batches(it):
            buf, off = text_buffer(b.column(2))
            for i, j in slices(off):
                part, own = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                if not len(part):
                    continue
                raw = part.tobytes()
                cuts = borders(part, own)
                row = np.repeat(np.arange(i, j), [len(c) - 1 for c in cuts])
                start = np.array([x for c in cuts for x in c[:-1]], np.int64)
                end = np.array([x for c in cuts for x in c[1:]], np.int64)
                base = own[row - i]
                digest = b"".join([hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip((base + start).tolist(), (base + end).tolist())])
                halves = np.frombuffer(digest, "<i8").reshape(-1, 2)
                at = pa.array(row)
                held.append((b.column(0).take(at), b.column(1).take(at), start << LENGTH_BITS | end - start, halves[:, 0], halves[:, 1]))
                n += len(row)
                if n >= LOCAL_CHUNKS:
                    yield from send(held)
                    held, n = [], 0
        if n:
            yield from send(held)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    return arrow_map(rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), run,
                     f"d1 long, salt short, doc_id {kind}, version long, place long, d2 long, twin boolean")


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``d1, d2, doc_id, version, start, end`` of the chunks that may occur twice: all that do, and what shares half a digest."""
    sent = chunks(docs, id_col, text_col).withColumn("seen", F.count("*").over(Window.partitionBy("d1", "salt")))
    start = F.shiftright("place", LENGTH_BITS).cast("int")
    return sent.where("twin or seen > 1").select("d1", "d2", "doc_id", "version", start.alias("start"),
                                                 (start + F.col("place").bitwiseAND((1 << LENGTH_BITS) - 1).cast("int")).alias("end"))


def repeated_spans(docs: DataFrame, min_span: int = MIN_SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, end, n_chunks, first_doc_id`` of the spans made of chunks that occur earlier.

    Earlier: in a smaller id, or in the same document at an earlier place.
    Offsets count UTF-8 bytes, ends exclusive; ``first_doc_id`` is the smallest
    id in which one of the span's chunks first occurs. Rows with a null id or
    text take no part, empty texts have no chunks. A row that comes twice is one
    document: its copy is not earlier than itself. Rows with one id and
    different texts are compared as documents of their own.
    """
    place = F.struct("doc_id", "version", "start")
    found = written(repeated_chunks(docs, id_col, text_col), "chunks")
    # Written, so that the join below has both sides by an exchange of its own, which Spark splits where a digest is hot.
    first = written(found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                    .where("first <> last").select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), "first"), "first-chunks")
    again = (found.join(first, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")))
             .where(place != F.col("first"))
             .select("doc_id", "version", "start", "end", F.col("first.doc_id").alias("first_doc_id")))
    by_doc = Window.partitionBy("doc_id", "version").orderBy("start")
    begins = F.coalesce((F.col("start") > F.lag("end").over(by_doc)).cast("int"), F.lit(1))
    runs = again.dropDuplicates(["doc_id", "version", "start"]).withColumn("_new", begins).withColumn("_run", F.sum("_new").over(by_doc))
    return (runs.groupBy("doc_id", "version", "_run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_chunks"), F.min("first_doc_id").alias("first_doc_id"))
            .where(F.col("end") - F.col("start") >= min_span).drop("version", "_run"))
