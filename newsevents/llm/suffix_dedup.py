"""Exact removal of repeated byte strings, by a distributed merge sort of sampled suffixes.

Every string of ``LENGTH`` bytes has one anchor: the place in it where the hash
of the next ``GRAM`` bytes is least (the leftmost such). Equal strings have equal
anchors, so only suffixes at anchors need sorting, about one in forty. The
strings of one anchor are neighbours: their starts form a range before it.

1. Anchors whose gram no other anchor has cannot be in a repeated string. One
   shuffle of (gram hash, place) finds the others; a task sends one row of each
   gram it holds to the shared key and spreads the rest, as they are known to
   be repeated.
2. The suffixes left are cut from their texts, sorted per task, and sent as
   front-coded runs (common prefix with the one before, rest) to the range that
   their first bytes fall in. Of equal contexts in a run only the first is
   sent; all strings of the others are repeated.
3. A loser tree merges the runs of a range. Each run's head keeps its common
   prefix with the last winner: heads with different prefixes are ordered by
   that number alone, equal ones are compared from there on, so no byte known
   to be common is read again. The merge yields the sorted suffixes with their
   common prefixes.
4. Two anchors share a string that starts ``o`` bytes before them if their
   suffixes share ``LENGTH - o`` bytes and the ``o`` bytes on the left are
   equal. The sorted order gives the first as groups of neighbours, a hash of
   the left bytes the second; all members of such a group but the earliest are
   repeated.
5. The ranges of each document are united and cut out of its text.

The suffixes of one gram are never split over ranges. A gram with more than ``HOT_ANCHORS`` anchors is left out of the
sort: each string around its anchors is sent as its digest, the earliest of each is a partial
aggregate, and the others are repeated. So a task never holds more than that many suffixes of one gram, and
the borders, quantiles of a sample of the anchors left, keep the ranges alike.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsevents.llm.bpe import spread
from newsevents.llm.common import arrow_map, batches, slices, text_buffer, written

LENGTH, GRAM = 100, 24
SPAN = LENGTH - GRAM + 1  # grams in a string
#: Rows of anchors, and of suffixes, that a task holds before it sends them.
LOCAL_ANCHORS, LOCAL_SUFFIXES = 1 << 20, 1 << 17
#: Anchors sampled for the borders of the ranges (they steer balance only), and ranges per shuffle partition.
SAMPLE_ANCHORS, RANGES_PER_PARTITION = 20_000, 3
#: Anchors of one gram that are merged in one task; the strings of a gram with more are compared by digest.
HOT_ANCHORS = 200_000

_BYTE = np.random.default_rng(10).integers(1, 1 << 63, 256).astype(np.uint64)
_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` (24) bytes from each place on."""
    h = _BYTE.take(buf)
    for k, m in zip((1, 2, 4), _M):
        h = h[:-k] * m + h[k:]
    eight = h
    h = eight[:-8] * _M[3] + eight[8:]
    h = h[:len(eight) - 16] * _M[4] + eight[16:]
    h ^= h >> np.uint64(32)
    h *= _M[0]
    h ^= h >> np.uint64(29)
    return h


def anchors(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place, least and greatest distance of its strings' starts, gram hash) of each anchor; places count from the text's start."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(buf) < LENGTH:
        return none
    h = gram_hashes(buf)
    bits = max(1, int(len(h)).bit_length())
    low = np.uint64((1 << bits) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= SPAN:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    m = np.minimum(m[:len(m) - (SPAN - width)], m[SPAN - width:])
    at = (m & low).astype(np.int64)  # the anchor of the string that starts at each place
    text = np.searchsorted(offsets, np.arange(len(at)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(at)) + LENGTH <= offsets[text + 1])
    if not len(inside):
        return none
    at, text = at[inside], text[inside]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    x = at[first]
    return text[first], x - offsets[text[first]], x - inside[last], x - inside[first], h[x].view(np.int64)


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """``key, row, place`` of the anchors whose gram (hashed to ``key``) some other anchor has; ``place`` packs the place and both distances."""
    def send(held):
        rows = pa.concat_arrays([r for r, _, _ in held])
        place, key = np.concatenate([p for _, p, _ in held]), np.concatenate([k for _, _, k in held])
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        follows = np.concatenate([[False], same])
        twin = follows | np.concatenate([same, [False]])
        salt = np.where(follows, 1 + order % 251, 0).astype(np.int16)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(salt), rows.take(pa.array(order)), pa.array(place[order]), pa.array(twin)],
                                         ["key", "salt", "row", "place", "twin"])

    def run(it):
        held, n = [], 0
        for b in batches(it):
            buf, off = text_buffer(b.column(1))
            for i, j in slices(off):
                text, x, near, far, key = anchors(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                if len(x):
                    held.append((b.column(0).take(pa.array(text + i)), x << 16 | near << 8 | far, key))
                    n += len(x)
            if n >= LOCAL_ANCHORS:
                yield from send(held)
                held, n = [], 0
        if n:
            yield from send(held)

    sent = arrow_map(docs.select("row", "text"), run, "key long, salt short, row long, place long, twin boolean")
    return (sent.withColumn("seen", F.count("*").over(Window.partitionBy("key", "salt")))
            .where("twin or seen > 1").select("key", "row", "place"))


class Run:
    """Front-coded suffixes in order, and their records."""

    #: (name, type) of the arrays of a run; ``tails`` and ``lefts`` hold bytes, the rest one number a suffix.
    FIELDS = (("lcp", np.uint8), ("size", np.uint8), ("left", np.uint8), ("near", np.uint8), ("far", np.uint8),
              ("doc", np.int64), ("row", np.int64), ("x", np.int64), ("tails", np.uint8), ("lefts", np.uint8))
    SCHEMA = ", ".join(f"{name} binary" for name, _ in FIELDS)


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix; the first ``start`` bytes are known to be common."""
    n = min(len(a), len(b))
    i = start
    while i < n and a[i:i + 8] == b[i:i + 8]:
        i += 8
    while i < n and a[i] == b[i]:
        i += 1
    return min(i, n)


def merge_runs(runs: list[tuple[np.ndarray, list[bytes]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge front-coded runs (common prefixes, tails); (run, index in the run, common prefix with the one before) in order.

    A loser tree whose nodes hold the loser's common prefix with the winner that
    passed: a greater one is the smaller suffix, without a look at the bytes.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[bytes | None] = [None] * k
    prefix = [0] * k  # of each head with the last winner
    index = [0] * k
    lcps = [r[0].tolist() for r in runs]
    tails = [r[1] for r in runs]
    for r in range(len(runs)):
        heads[r] = tails[r][0] if tails[r] else None
    loser = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs whose prefixes are with the same suffix; sets the loser's prefix with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        pa_, pb = prefix[a], prefix[b]
        if pa_ != pb:
            return (a, b) if pa_ > pb else (b, a)
        c = common_prefix(x, y, pa_)
        if c == len(x) or (c < len(y) and x[c] < y[c]):
            prefix[b] = c
            return a, b
        prefix[a] = c
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        w, lose = play(build(2 * node), build(2 * node + 1))
        loser[node] = lose
        return w

    out_run, out_index, out_lcp = [], [], []
    w = build(1)
    while heads[w] is not None:
        i = index[w]
        out_run.append(w)
        out_index.append(i)
        out_lcp.append(prefix[w])
        last = heads[w]
        i += 1
        index[w] = i
        if i < len(tails[w]):
            c = lcps[w][i]
            heads[w] = last[:c] + tails[w][i]
            prefix[w] = c
        else:
            heads[w] = None
        node = (w + k) // 2
        while node >= 1:
            a, b = play(w, loser[node])
            w, loser[node] = a, b
            node //= 2
    return out_run, out_index, out_lcp


def earlier(lcp: np.ndarray, left: np.ndarray, lefts: np.ndarray, near: np.ndarray, far: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which strings of the sorted suffixes occur earlier: (suffix, least distance, greatest distance) of each range.

    ``lcp`` with the one before, ``lefts`` the bytes on the left (``left`` each,
    nearest first), strings start ``near`` to ``far`` before the suffix, and
    ``order`` ranks the suffixes' places in the corpus (equal for one place).
    """
    n = len(lcp)
    at = np.cumsum(left.astype(np.int64)) - left
    hashes = np.zeros(n, np.uint64)
    opened = np.full(n, -1, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, int]] = []
    for o in range(int(far.max()) + 2 if n else 0):
        if o:
            has = np.flatnonzero(left >= o)
            hashes[has] = (hashes[has] + lefts[at[has] + o - 1] + np.uint64(1)) * _M[1]
            hashes[has] ^= hashes[has] >> np.uint64(31)
        own = np.flatnonzero((near <= o) & (o <= far))
        flagged = np.zeros(n, bool)
        if len(own):
            right = np.cumsum(lcp < LENGTH - o)[own].astype(np.uint64)
            key = hashes[own] ^ (right * _M[0])
            by = np.lexsort((order[own], key))
            k, rank = key[by], order[own][by]
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            lowest = rank[np.flatnonzero(first)][np.cumsum(first) - 1]
            flagged[own[by[rank > lowest]]] = True
        begin = np.flatnonzero(flagged & (opened < 0))
        stop = np.flatnonzero(~flagged & (opened >= 0))
        if len(stop):
            found.append((stop, opened[stop].copy(), o - 1))
        opened[begin] = o
        opened[stop] = -1
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return (np.concatenate([s for s, _, _ in found]), np.concatenate([b for _, b, _ in found]),
            np.concatenate([np.full(len(s), e) for s, _, e in found]))


def _borders(docs: DataFrame, found: DataFrame, parts: int) -> list[bytes]:
    """Borders of the ranges: quantiles of the grams of at most ``SAMPLE_ANCHORS`` anchors (``row, place``) of texts of any length.

    No two suffixes with one gram fall in different ranges.
    """
    some = found.select(F.col("row").alias("_row"), "place").orderBy(F.xxhash64("row", "place")).limit(SAMPLE_ANCHORS)
    start = (F.shiftright("place", 16) + 1).cast("int")
    grams = docs.join(F.broadcast(some), F.col("row") == F.col("_row")).select(F.substring(F.encode("text", "UTF-8"), start, F.lit(GRAM)).alias("gram"))
    grams = sorted({bytes(r.gram) for r in grams.limit(2 * SAMPLE_ANCHORS).collect()})
    return sorted({grams[len(grams) * k // parts] for k in range(1, parts)}) if grams else []


def hot_ranges(texts: DataFrame) -> DataFrame:
    """``doc_id, row, start, end`` of the strings around the places of ``doc_id, row, text, places`` that occur earlier among them."""
    def run(it):
        for b in batches(it):
            ids, rows, texts_, places = (b.column(i) for i in range(4))
            out = [[], [], [], []]
            for i, (row, text, ps) in enumerate(zip(rows.to_pylist(), texts_.to_pylist(), places.to_pylist())):
                raw = text.encode()
                starts = sorted({s for p in ps for s in range((p >> 16) - (p & 255), (p >> 16) - (p >> 8 & 255) + 1)})
                for col, values in zip(out, ([i] * len(starts), [row] * len(starts), starts,
                                             [hashlib.blake2b(raw[s:s + LENGTH], digest_size=16).digest() for s in starts])):
                    col += values
            halves = np.frombuffer(b"".join(out[3]), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                              *[pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)]], ["doc_id", "row", "start", "h1", "h2"])

    strings = written(arrow_map(texts, run, "doc_id long, row long, start long, h1 long, h2 long").distinct(), "hot-strings")
    place = F.struct("doc_id", "row", "start")
    # Written, so that Spark can split the join below where a string is hot.
    first = written(strings.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2"))
                    .agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last"), "first-strings")
    again = strings.join(first, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).where(place != F.col("first")).select("doc_id", "row", "start")
    # Starts side by side make one range.
    by_row = Window.partitionBy("doc_id", "row").orderBy("start")
    runs = again.withColumn("run", F.col("start") - F.row_number().over(by_row))
    return runs.groupBy("doc_id", "row", "run").agg(F.min("start").alias("start"), (F.max("start") + LENGTH).alias("end")).drop("run")


def suffix_runs(texts: DataFrame, borders: list[bytes]) -> DataFrame:
    """Sorted front-coded runs, ``part`` and one row a run and range, of ``doc_id, row, text, places``.

    Rows with part -1 hold the suffixes whose context an earlier one of the run has.
    """
    def pack(part, records):
        """One row: records are (suffix, left bytes nearest first, doc, row, x, near, far), sorted."""
        lcp, tails, last = [], [], b""
        for rec in records:
            c = common_prefix(last, rec[0])
            lcp.append(c)
            tails.append(rec[0][c:])
            last = rec[0]
        cols = {"lcp": lcp, "size": [len(t) for t in tails], "left": [len(r[1]) for r in records], "near": [r[5] for r in records],
                "far": [r[6] for r in records], "doc": [r[2] for r in records], "row": [r[3] for r in records], "x": [r[4] for r in records]}
        blobs = [np.array(cols[n], t).tobytes() for n, t in Run.FIELDS[:-2]] + [b"".join(tails), b"".join(r[1] for r in records)]
        return [part, *blobs]

    def send(records):
        from bisect import bisect_right
        records.sort(key=lambda r: (r[0], r[1], r[2], r[3], r[4]))
        keep, again = [], []
        for rec in records:
            same = bool(keep) and rec[0] == keep[-1][0] and rec[1] == keep[-1][1]
            (again if same and rec[2:5] != keep[-1][2:5] else keep).append(rec)
        rows = [pack(-1, again)] if again else []
        start = 0
        while start < len(keep):
            part = bisect_right(borders, keep[start][0][:GRAM])
            low, high = start + 1, len(keep)
            while low < high:  # first record of another range
                mid = (low + high) // 2
                if bisect_right(borders, keep[mid][0][:GRAM]) == part:
                    low = mid + 1
                else:
                    high = mid
            rows.append(pack(part, keep[start:low]))
            start = low
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                         ["part", *[n for n, _ in Run.FIELDS]])

    def run(it):
        records = []
        for b in batches(it):
            docs, rows, texts_, places = (b.column(i).to_pylist() for i in range(4))
            for doc, row, text, ps in zip(docs, rows, texts_, places):
                raw = text.encode()
                for p in ps:
                    x, near, far = p >> 16, p >> 8 & 255, p & 255
                    records.append((raw[x:x - near + LENGTH], raw[x - far:x][::-1], doc, row, x, near, far))
                if len(records) >= LOCAL_SUFFIXES:
                    yield from send(records)
                    records = []
        if records:
            yield from send(records)

    return arrow_map(texts, run, f"part int, {Run.SCHEMA}")


_OUT = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _merge_part(key, table):
    """Ranges of repeated bytes from the runs of one range (or, for part -1, of the repeated contexts)."""
    runs = []
    for r in table.to_pylist():
        own = {n: np.frombuffer(r[n], t) for n, t in Run.FIELDS}
        runs.append(own)
    if key[0].as_py() < 0:
        cat = {n: np.concatenate([r[n] for r in runs]) for n in ("doc", "row", "x", "near", "far")}
        start, end = cat["x"] - cat["far"], cat["x"] - cat["near"] + LENGTH
        return pa.table([pa.array(cat["doc"]), pa.array(cat["row"]), pa.array(start), pa.array(end)], schema=_OUT)
    coded = []
    for r in runs:
        raw, cut = r["tails"].tobytes(), np.concatenate([[0], np.cumsum(r["size"], dtype=np.int64)]).tolist()
        coded.append((r["lcp"], [raw[a:z] for a, z in zip(cut, cut[1:])]))
    run, index, lcp = merge_runs(coded)
    base = np.cumsum([0] + [len(r["lcp"]) for r in runs])
    pick = base[np.array(run)] + np.array(index)
    cat = {n: np.concatenate([r[n] for r in runs]) for n, _ in Run.FIELDS if n not in ("tails", "lefts", "lcp", "size")}
    left_at = np.cumsum(cat["left"], dtype=np.int64) - cat["left"]
    lefts = np.concatenate([r["lefts"] for r in runs])
    left = cat["left"][pick]
    lefts = lefts[spread(left_at[pick], left.astype(np.int64))]
    doc, row, x, near, far = (cat[n][pick] for n in ("doc", "row", "x", "near", "far"))
    by = np.lexsort((x, row, doc))
    step = np.ones(len(by), np.int64)
    step[1:] = (doc[by][1:] != doc[by][:-1]) | (row[by][1:] != row[by][:-1]) | (x[by][1:] != x[by][:-1])
    order = np.empty(len(by), np.int64)
    order[by] = np.cumsum(step)
    s, low, high = earlier(np.array(lcp), left.astype(np.int64), lefts, near.astype(np.int64), far.astype(np.int64), order)
    return pa.table([pa.array(doc[s]), pa.array(row[s]), pa.array(x[s] - high), pa.array(x[s] - low + LENGTH)], schema=_OUT)


def repeated_ranges(docs: DataFrame, hot_anchors: int = HOT_ANCHORS) -> DataFrame:
    """``doc_id, row, start, end`` (bytes) covered by strings that occur earlier; ranges may overlap. ``docs``: ``doc_id long, row, text``."""
    spark = docs.sparkSession
    found = written(repeated_anchors(docs), "anchors")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION

    def texts(places: DataFrame) -> DataFrame:
        return (docs.join(places.groupBy("row").agg(F.collect_list("place").alias("places")), "row")
                .select("doc_id", "row", "text", "places"))

    hot = found.groupBy("key").count().where(F.col("count") > hot_anchors).select("key")
    hot = written(hot, "hot-grams")
    some_hot = hot.limit(1).count() > 0
    cold = written(found.join(hot, "key", "left_anti"), "anchors") if some_hot else found
    runs = suffix_runs(texts(cold), _borders(docs, cold, parts))
    # Contexts that a run has seen are only unpacked: they go anywhere.
    key = F.when(F.col("part") < 0, -1 - F.pmod(F.xxhash64("x"), F.lit(parts))).otherwise(F.col("part")).cast("int")
    out = runs.withColumn("part", key).groupBy("part").applyInArrow(_merge_part, "doc_id long, row long, start long, end long")
    return out.unionByName(hot_ranges(texts(found.join(hot, "key", "left_semi")))) if some_hot else out


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_anchors: int = HOT_ANCHORS) -> DataFrame:
    """``doc_id, n_bytes long, n_removed long, n_spans long, kept binary`` of each row.

    Removed is each byte covered by a string of ``LENGTH`` bytes that also
    starts earlier: in a smaller id, or in the same text further left. One row
    per input row. Null and empty texts have no bytes; rows with a null id lose
    nothing and make nothing repeated. A row that comes twice is one document;
    rows with one id and different texts are ordered by a hash of the text. Ids
    must be whole numbers. Texts of any length are handled whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    usable = rows.where("doc_id is not null and text is not null")
    ranges = written(repeated_ranges(usable, hot_anchors), "repeated-ranges")
    by_row = ranges.groupBy(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).agg(
        F.collect_set(F.struct("start", "end")).alias("cut"))
    joined = rows.join(by_row, (F.col("row") == F.col("_row")) & (F.col("doc_id") == F.col("_doc")), "left").select(
        "doc_id", "text", F.col("cut.start").alias("start"), F.col("cut.end").alias("end"))

    def run(it):
        for b in batches(it):
            buf, off = text_buffer(b.column(1))
            size = np.diff(off)
            removed, spans, kept = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), []
            for i, (s, e) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                own = buf[off[i]:off[i + 1]]
                if s:
                    cover = np.zeros(len(own) + 1, np.int64)
                    np.add.at(cover, s, 1)
                    np.subtract.at(cover, e, 1)
                    gone = np.cumsum(cover)[:-1] > 0
                    removed[i] = gone.sum()
                    spans[i] = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(gone[0])
                    own = own[~gone]
                kept.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return arrow_map(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
