"""Token files: ids of each text as Parquet list columns, in id order, with an index of the files.

A set of token files is a folder with two tables:

* ``tokens``: a row for each document, ascending by its id over all files and in
  each. ``ids`` is a list column in dictionary encoding (an id takes as many bits
  as the row group's ids need); ``doc_id``, ``n_tokens`` and ``start`` (the ids
  before the document in its file) are delta-encoded. Row groups hold
  ``ROW_GROUP_BYTES``, pages ``PAGE_ROWS`` rows at most, and each file carries page
  indexes, so a filter on ``doc_id`` or ``start`` reads the pages it needs, and a
  query of counts reads no ids.
* ``index``: a row for each file: its part number, rows, ids, the ids of all files
  before it, and its least and greatest document id. It grows with the files, not the
  documents.

The documents are range-partitioned by id before they are encoded, so each text is
shuffled once and its ids never; Spark's own writer commits the files, and a
task that is lost is simply run again.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsevents.llm.bpe import Encoder, spread, vocabulary
from newsevents.llm.common import arrow_map, batches, slices, text_buffer

#: Bytes of text for a file, bytes of a row group, rows and bytes of a page.
FILE_BYTES, ROW_GROUP_BYTES, PAGE_ROWS, PAGE_BYTES = 128 << 20, 32 << 20, 1000, 256 << 10
#: The index is broadcast up to this many files (about 40 bytes each), else joined by a shuffle.
BROADCAST_FILES = 500_000

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}

class LibraryEncoder(Encoder):
    """Ids by the tokenizers library, asked once for each distinct token of its byte-level split.

    Such a tokenizer encodes each token of the split by itself, so the ids of a
    token are kept (``Encoder``: a bounded cache, verified by decoding). A definition of
    another kind encodes each whole text.
    """

    cached = 500_000

    def __init__(self, definition: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(definition)
        self.tokenizer.encode_special_tokens = True
        rule = json.loads(definition)
        split = rule.get("pre_tokenizer") or {}
        self.by_token = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
                         and rule.get("normalizer") is None and rule["model"]["type"] == "BPE")
        if self.by_token:
            byte = {c: b for b, c in zip([b for b in range(256) if b in _SHOWN] + [b for b in range(256) if b not in _SHOWN],
                                         [chr(b) for b in range(256) if b in _SHOWN] + [chr(256 + i) for i in range(256 - len(_SHOWN))])}
            self.vocabulary = vocabulary({bytes(byte[c] for c in t): i for t, i in rule["model"]["vocab"].items() if all(c in byte for c in t)})
            self._clear()

    def _alone(self, token: bytes) -> list[int]:
        return self.tokenizer.encode(token.decode(), add_special_tokens=False).ids

    def _merged(self, buf, keys, starts, size):
        # A token that is a space and a sign or letter ends the one before it, so such tokens are encoded side by side as one
        # text; the bytes that each id stands for say where one token ends.
        second = buf[np.minimum(starts + 1, len(buf) - 1)]
        side = (size > 1) & (buf[starts] == 0x20) & _SIGN.take(second)
        data = buf[spread(starts[side], size[side])].tobytes().decode()
        ids = np.array(self._batch([data])[0], np.int32)
        ends = np.cumsum(self.vocabulary[1][ids + 1] - self.vocabulary[1][ids])
        last = np.searchsorted(ends, np.cumsum(size[side])) + 1
        count = np.diff(last, prepend=0)
        own = self._batch([buf[s:s + n].tobytes().decode() for s, n in zip(starts[~side].tolist(), size[~side].tolist())])
        return (np.concatenate([keys[side], keys[~side]]), np.concatenate([ids, np.fromiter(chain.from_iterable(own), np.int32)]),
                np.concatenate([count, np.array([len(x) for x in own], np.int64)]))

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def rows(self, col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts of a column and how many each has, in slices of bounded bytes; null is empty."""
        buf, off = text_buffer(col)
        for i, j in slices(off):
            if self.by_token:
                ids, count, _ = self.encode(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            else:
                own = self._batch([t or "" for t in col.slice(i, j - i).to_pylist()])
                ids, count = np.fromiter(chain.from_iterable(own), np.int32), np.array([len(x) for x in own], np.int64)
            yield ids, count


#: Bytes that begin a character which is surely no white space: ASCII signs, letters and digits, and most of what is beyond.
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = _SIGN[0xC3:0xE0] = _SIGN[0xE4:] = True

# The bytes that the byte-level alphabet shows as themselves; the others follow from code point 256 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}


@lru_cache(1)
def _encoder(definition: bytes) -> LibraryEncoder:
    """The encoder of a definition, kept by the worker."""
    return LibraryEncoder(definition)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 file_bytes: int = FILE_BYTES, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Encode every whole text, with ``end_id`` after each, and write the token files to ``path``.

    Null and empty texts are the end id alone. Null ids come first; rows of one id
    follow each other in an order of their texts, and repeated rows are all kept. Other
    columns are not read. An empty table makes token files without rows. ``docs`` should be a table
    that is read, not computed, for its rows must come alike if a task is run again.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())  # a vocabulary: a few MB
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(spark.sparkContext.defaultParallelism, -(-size // file_bytes))
    # Rows of one id, or repeated rows, may be many: the text's hash and a number tell them apart.
    keys = ["doc_id", "_hash", "_row"]
    ordered = (plain.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
               .repartitionByRange(files, *keys).sortWithinPartitions(*keys).select("doc_id", "text"))

    def run(it):
        coder, start = _encoder(shared.value), 0
        for b in batches(it):
            at = 0
            for ids, count in coder.rows(b.column(1)):
                off = np.concatenate([[0], np.cumsum(count + 1)])
                whole = np.full(off[-1], end_id, np.int32)
                whole[spread(off[:-1], count)] = ids
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(count)), pa.array(start + off[:-1]), pa.array(np.diff(off)),
                     pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(whole))],
                    ["doc_id", "start", "n_tokens", "ids"])
                start += int(off[-1])
                at += len(count)

    kind = dict(docs.dtypes)[id_col]
    (arrow_map(ordered, run, f"doc_id {kind}, start long, n_tokens long, ids array<int>")
     .write.mode("overwrite").options(**LAYOUT).option("parquet.block.size", str(row_group_bytes)).parquet(f"{path}/tokens"))
    _write_index(spark, path)


def _part() -> Column:
    """The part number in the name of a row's file."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")


def _write_index(spark: SparkSession, path: str) -> None:
    tokens = spark.read.parquet(f"{path}/tokens")
    each = (tokens.select("doc_id", "n_tokens", _part().alias("part"), F.col("_metadata.file_path").alias("file")).groupBy("part", "file")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
                 F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count_if(F.col("doc_id").isNull()).alias("n_null")))
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a file
    each.withColumn("first", F.coalesce(before, F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``part, file, n_docs, n_tokens, low, high, n_null, first``: a row for each file."""
    return spark.read.parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: ``start`` counts the ids of all documents before this one.

    Columns that are not selected are not read. ``files`` reads only those.
    """
    tokens = spark.read.parquet(f"{path}/tokens") if files is None else spark.read.schema(spark.read.parquet(f"{path}/tokens").schema).parquet(*files)
    index = read_index(spark, path).select("part", "first")
    if index.count() <= BROADCAST_FILES:
        index = F.broadcast(index)
    return (tokens.withColumn("part", _part()).join(index, "part")
            .select("doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids"))


def select_documents(spark: SparkSession, path: str, low, high) -> DataFrame:
    """The rows whose id is from ``low`` to ``high``: files by the index, row groups and pages by their own."""
    files = [r.file for r in read_index(spark, path).where((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high))).select("file").toLocalIterator()]
    rows = read_tokens(spark, path, files) if files else read_tokens(spark, path).limit(0)
    return rows.where(F.col("doc_id").between(low, high))


def select_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``doc_id, start, ids``: the ids at places ``start`` to ``stop`` (exclusive) of the whole sequence, by document.

    A file whose ids lie outside is not opened, a page outside not read.
    """
    hit = [(r.file, r.first) for r in read_index(spark, path).where((F.col("first") < stop) & (F.col("first") + F.col("n_tokens") > start))
           .orderBy("part").select("file", "first").toLocalIterator()]
    whole = spark.read.parquet(f"{path}/tokens").schema
    rows = read_tokens(spark, path).limit(0).drop("n_tokens")
    if not hit:
        return rows
    tokens = spark.read.schema(whole).parquet(*[f for f, _ in hit])
    # The places in a file of the window's first and last documents bound the pages that are read; only end files are cut.
    first, last = hit[0], hit[-1]
    name = F.col("_metadata.file_path")
    inside = (((name != F.lit(first[0])) | (F.col("start") + F.col("n_tokens") > start - first[1]))
              & ((name != F.lit(last[0])) | (F.col("start") < stop - last[1])))
    base = read_index(spark, path).select("part", F.col("first").alias("_first"))
    own = F.col("_first") + F.col("start")
    skip = F.greatest(F.lit(0), F.lit(start) - own)
    return (tokens.where(inside).withColumn("part", _part()).join(base, "part")
            .select("doc_id", (own + skip).alias("start"),
                    F.slice("ids", (skip + 1).cast("int"), F.least(F.col("n_tokens"), F.lit(stop) - own).cast("int") - skip.cast("int")).alias("ids")))


def checksums(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) in place of ``ids``."""
    kind = dict(tokens.dtypes)["doc_id"]

    def run(it):
        import zlib

        for b in batches(it):
            ids = b.column(3)
            off = ids.offsets.to_numpy()
            data = ids.values.to_numpy().astype("<u4").tobytes()
            crc = [zlib.crc32(data[4 * a:4 * z]) for a, z in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow_map(tokens.select("doc_id", "start", "n_tokens", "ids"), run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
