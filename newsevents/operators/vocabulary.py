"""Terms as numbers: a written vocabulary, and documents as arrays of ids (M2).

``build_vocabulary`` makes the table ``(term, id, n, stem)`` once: the terms are counted by a
partial aggregate (a term in every document costs a row a task), ranked by their number without
gathering them, and each distinct one is stemmed once on the cluster, whatever the number of documents.

``encode`` turns a document's terms into ids in the same order. The ids follow the frequency, so
the ``hot`` lowest ids are the most frequent terms - most of all text: they are broadcast (``HOT_TERMS`` words, a few MB)
and replaced where the document is. Only the rare terms that are left, a row for each distinct one
of a document, go through a shuffle to meet the rest of the vocabulary, so no hot word is ever a join key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsevents.functions.stem import stem_terms
from newsevents.operators.entities import global_rank
from newsevents.session import cut_lineage, ship_package

HOT_TERMS = 50_000


def build_vocabulary(analyzed: DataFrame, terms: str = "terms") -> DataFrame:
    """``term, id, n, stem`` of all terms, written: id 0 is the most frequent (ties by name), ``n`` its occurrences."""
    counts = (analyzed.select(F.explode(terms).alias("entity")).where(F.col("entity").isNotNull())
              .groupBy("entity").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("term")))
    ranked = global_rank(counts).select(F.col("entity").alias("term"), (F.col("rank") - 1).alias("id"), "n")
    stems = stem_terms(F.array("term"))
    return cut_lineage(ranked.withColumn("stem", F.element_at(stems, 1)), "vocabulary")


def encode(analyzed: DataFrame, vocabulary: DataFrame, terms: str = "terms", out: str = "ids", hot: int = HOT_TERMS) -> DataFrame:
    """``analyzed`` with ``out array<long>`` in place of ``terms``: the id of each term, null where the vocabulary has none.

    A null array stays null, an empty one empty; rows are kept as they come, repeated or not.
    """
    spark = analyzed.sparkSession
    ship_package(spark)
    words = {r.term: r.id for r in vocabulary.where(F.col("id") < hot).select("term", "id").toLocalIterator()}   # at most ``hot``
    shared = spark.sparkContext.broadcast(words)
    names = [c for c in analyzed.columns if c != terms]
    plain = analyzed.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)], F.col(terms).alias("_terms"))

    def run(it):
        known = shared.value
        for b in it:
            lists, flat, off, mask = _lists(b)
            words = flat.dictionary_encode()
            # Of a batch only the distinct words become Python strings.
            names_ids = np.array([known.get(t, -1) for t in words.dictionary.to_pylist()] + [-1], np.int64)
            word = words.indices.fill_null(len(names_ids) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = names_ids[word]
            ids, rare, ends = _numbered(ids, (ids < 0) & (word < len(names_ids) - 1), word, off)
            coded = pa.ListArray.from_arrays(off, pa.array(ids.astype(np.int32)), mask=mask)
            # The terms themselves go no further.
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], coded, pa.ListArray.from_arrays(ends, words.dictionary.take(pa.array(rare)))], [*b.schema.names[:-1], "_ids", "_rare"])

    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in plain.schema.fields[:-1])
    # Written: a row's number must not change between its two uses.
    coded = cut_lineage(plain.mapInArrow(run, f"{fields}_ids array<int>, _rare array<string>").withColumn("_r", F.monotonically_increasing_id()), "coded")
    found = _found(coded, vocabulary.where(F.col("id") >= hot).select(F.col("term").alias("_key"), F.col("id").alias("_v")))
    filled = F.transform("_ids", lambda i: F.when(i >= 0, i.cast("long")).otherwise(F.get(F.col("_tail"), -2 - i)))
    return found.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)], filled.alias(out))


def _lists(b: pa.RecordBatch) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """The last column's lists, their values, offsets from 0 and which lists are null."""
    lists = b.column(b.num_columns - 1)
    size = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
    off = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    return lists, lists.flatten(), off, pa.array(~lists.is_valid().to_numpy(zero_copy_only=False))


def _numbered(ids: np.ndarray, rare: np.ndarray, word: np.ndarray, off: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``ids`` with ``-2 - place`` for a rare word (its place among the distinct rare words of its document), those words, and their offsets."""
    ends = off.to_numpy()
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[rare]
    key, inverse = np.unique(row << 32 | word[rare], return_inverse=True)      # words are numbered within the batch
    first = np.searchsorted(key, np.arange(len(ends)) << 32)
    ids = ids.copy()
    ids[rare] = -2 - (inverse - first[row])
    return ids, key & 0xFFFFFFFF, pa.array(first.astype(np.int32))


def _found(coded: DataFrame, words: DataFrame) -> DataFrame:
    """``coded`` with ``_tail``, the values of its ``_rare`` words in their order: read by place, whatever a document's length."""
    tail = (coded.select("_r", F.posexplode("_rare").alias("_at", "_key")).join(words, "_key", "left")
            .groupBy("_r").agg(F.array_sort(F.collect_list(F.struct("_at", "_v"))).alias("_tail")))
    return coded.join(tail.select("_r", F.col("_tail._v").alias("_tail")), "_r", "left")


def decode(encoded: DataFrame, vocabulary: DataFrame, ids: str = "ids", out: str = "terms", value: str = "term", hot: int = HOT_TERMS) -> DataFrame:
    """``encoded`` with ``out`` in place of ``ids``: the ``value`` (``term`` or ``stem``) of each id, null where there is none."""
    spark = encoded.sparkSession
    ship_package(spark)
    top = vocabulary.where(F.col("id") < hot).orderBy("id").select(value).toLocalIterator()
    shared = spark.sparkContext.broadcast([r[0] for r in top])
    names = [c for c in encoded.columns if c != ids]
    plain = encoded.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)], F.col(ids).alias("_ids"))

    def run(it):
        for b in it:
            lists, flat, off, mask = _lists(b)
            ids = flat.fill_null(-1).to_numpy(zero_copy_only=False)
            distinct, word = np.unique(ids, return_inverse=True)
            at, rare, ends = _numbered(ids, ids >= hot, word, off)
            # Hot ids and places of rare words, 4 bytes each; the words are put in where both have met.
            at = pa.ListArray.from_arrays(off, pa.array(at.astype(np.int32)), mask=mask)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], at, pa.ListArray.from_arrays(ends, pa.array(distinct[rare], pa.int64()))], [*b.schema.names[:-1], "_at_rare", "_rare"])

    def fill(it):
        words = pa.array(shared.value, pa.string())
        for b in it:
            tail = b.column(b.num_columns - 2)
            size = pa.compute.fill_null(pa.compute.list_value_length(tail), 0).to_numpy()
            _, flat, off, mask = _lists(b)
            at = flat.to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), np.diff(off.to_numpy()))
            rest = len(words) + (np.cumsum(size) - size)[row] - 2 - at
            place = pa.array(np.where(at >= 0, at, rest), mask=(at == -1) | (at >= len(words)))
            text = pa.concat_arrays([words, tail.flatten()]).take(place)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.ListArray.from_arrays(off, text, mask=mask)], [*b.schema.names[:-2], "_text"])

    own = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in plain.schema.fields[:-1])
    coded = cut_lineage(plain.mapInArrow(run, f"{own}_at_rare array<int>, _rare array<long>").withColumn("_r", F.monotonically_increasing_id()), "decoded")
    found = _found(coded, vocabulary.where(F.col("id") >= hot).select(F.col("id").alias("_key"), F.col(value).alias("_v")))
    text = found.select(*plain.columns[:-1], "_tail", "_at_rare").mapInArrow(fill, f"{own}_text array<string>")
    return text.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)], F.col("_text").alias(out))
