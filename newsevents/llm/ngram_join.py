"""N-gram Jaccard join: documents whose sets of five-word shingles are alike, by rare-first prefix filtering.

Shingles are 64-bit hashes. A global order puts rare ones first: a sketch of
``SKETCH`` counters (fixed size, filled from all documents) says how frequent a
shingle's counter is, its hash breaks ties. Any fixed order gives right results;
the counts only make prefixes rare. Two sets of sizes a and b that link have at
least ``need(a, b)`` shingles in common, so their prefixes (a quarter of each
set) share one.

Equal sets are one *node*, named by its smallest id. Prefix shingles that two
nodes share are found with one shuffle; a task sends one row of each shingle it
holds to the shared key and spreads the others, so that a shingle held by a
third of all nodes lands in no single task.

A prefix shingle that is in no other prefix can still lie behind a partner's
prefix, but only behind one that ends earlier in the global order. So of two
nodes the one whose prefix ends first has its unshared prefix shingles taken out
of what may be common, the other one has not. Candidates pass length,
index-prefix and positional filters on these counts, distinct pairs a suffix
filter (counts of the sets' hashes by range bound the overlap), and are then
verified once on the whole sets.

Groups are not expanded into all their pairs. First each node is compared with
the smallest node of each of its shingles, then in the same way the components
found so far, then, exactly, all remaining candidates between two components.
Inside a component no further pair can change the result. So components are
those of all links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsevents.llm.bpe import token_keys
from newsevents.llm.common import arrow_map, batches, discard, slices, text_buffer, written
from newsevents.llm.words import word_spans

#: Words in a shingle; link if 100 * common >= PERCENT * union.
WIDTH, PERCENT = 5, 75
#: Counters of the sketch, ranges of the suffix filter, bits of the filter on ids, rows a task compares before it sends them.
SKETCH, RANGES, ID_BITS, LOCAL_ROWS = 1 << 18, 32, 1 << 23, 1 << 20

_WORD = np.ones(256, bool)
_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; a text of one to four words has one shingle."""
    low, starts, ends = word_spans(buf, offsets, _WORD)
    n = len(offsets) - 1
    if not len(starts):
        return [np.zeros(0, np.int64)] * n
    keys = token_keys(low, starts, ends).view(np.uint64)
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    total = np.zeros(max(len(keys) - WIDTH + 1, 0), np.uint64)
    for k in range(WIDTH):
        total += keys[k:k + len(total)] * _ODD[k]
    total = _mix(total + np.uint64(WIDTH))
    out = []
    for r in range(n):
        a, c = int(first[r]), int(count[r])
        if c >= WIDTH:
            out.append(np.unique(total[a:a + c - WIDTH + 1]))
        elif c:
            out.append(_mix(np.array([(keys[a:a + c] * _ODD[:c]).sum() + np.uint64(c)], np.uint64)))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))).view(np.int64)


def sets_of(col: pa.Array):
    """The shingle sets of a text column, a slice at a time."""
    buf, off = text_buffer(col)
    for i, j in slices(off):
        yield i, shingles(buf[off[i]:off[j]], off[i:j + 1] - off[i])


def sketch(docs: DataFrame) -> np.ndarray:
    """Document frequencies by counter: at most ``SKETCH`` rows come to the driver, whatever the input."""
    def run(it):
        counts = np.zeros(SKETCH, np.int64)
        for b in batches(it):
            for _, sets in sets_of(b.column(0)):
                counts += np.bincount(np.concatenate(sets) & (SKETCH - 1), minlength=SKETCH)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["slot", "n"])

    rows = arrow_map(docs.select("text"), run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    out = np.zeros(SKETCH, np.int64)
    out[table["slot"].to_numpy()] = table["n"].to_numpy()
    return out


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """``doc_id, n, d1, d2, prefix, en, eg, ranges`` of each row: set size, digest, rarest shingles in order, place of the last of them in the global order, counts by range."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # SKETCH counters

    def run(it):
        freq = shared.value
        for b in batches(it):
            n, digest, prefix, ends, ranges = [], [], [], [], []
            for _, sets in sets_of(b.column(1)):
                for s in sets:
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    count = freq[s & (SKETCH - 1)]
                    order = np.lexsort((s, count))[:len(s) // 4 + 1]
                    prefix.append(s[order].tobytes())
                    ends.append((int(count[order[-1]]), int(s[order[-1]])) if len(s) else (0, 0))
                    ranges.append(np.bincount(s & (RANGES - 1), minlength=RANGES).astype(np.int32))
            halves = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
            flat = pa.array(np.concatenate(ranges))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, RANGES, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), *[pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)],
                 pa.array(prefix, pa.binary()), *[pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], lists],
                ["doc_id", "n", "d1", "d2", "prefix", "en", "eg", "ranges"])

    return arrow_map(docs, run, f"doc_id {kind}, n long, d1 long, d2 long, prefix binary, en long, eg long, ranges array<int>")


def shared_grams(nodes: DataFrame) -> DataFrame:
    """``gram, doc, n, pos`` of every prefix shingle that two nodes or more hold."""
    kind = dict(nodes.dtypes)["doc"]

    def send(held):
        doc = pa.concat_arrays([d for d, _, _ in held])
        sizes = np.concatenate([n for _, n, _ in held])
        raw = [p for _, _, ps in held for p in ps]
        count = np.array([len(p) // 8 for p in raw])
        gram = np.frombuffer(b"".join(raw), "<i8")
        row = np.repeat(np.arange(len(count)), count)
        pos = np.arange(len(gram)) - np.repeat(np.cumsum(count) - count, count)
        order = np.argsort(gram, kind="stable")
        g = gram[order]
        same = g[1:] == g[:-1]
        follows = np.concatenate([[False], same])
        twin = follows | np.concatenate([same, [False]])
        row, pos = row[order], pos[order]
        # The first row of a shingle goes to its key, the others are spread: they are known to be shared.
        salt = np.where(follows, 1 + row % 251, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(g), pa.array(salt.astype(np.int16)), doc.take(pa.array(row)), pa.array(sizes[row].astype(np.int32)),
             pa.array(pos.astype(np.int32)), pa.array(twin)], ["gram", "salt", "doc", "n", "pos", "twin"])

    def run(it):
        held, rows = [], 0
        for b in batches(it):
            held.append((b.column(0), b.column(1).to_numpy(), b.column(2).to_pylist()))
            rows += sum(len(p) for p in held[-1][2]) // 8
            if rows >= LOCAL_ROWS:
                yield from send(held)
                held, rows = [], 0
        if rows:
            yield from send(held)

    sent = arrow_map(nodes.select("doc", "n", "prefix"), run, f"gram long, salt short, doc {kind}, n int, pos int, twin boolean")
    seen = F.count("*").over(Window.partitionBy("gram", "salt"))
    return sent.withColumn("seen", seen).where("twin or seen > 1").select("gram", "doc", "n", "pos")


def need(a: Column, b: Column) -> Column:
    """Least overlap of two sets that link."""
    return F.ceil(PERCENT * (a + b) / F.lit(100 + PERCENT))


def refined(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``gram, doc, n, rank, far, near, last``: the members without what cannot link.

    ``last`` is the end of the node's prefix in the global order. ``far`` counts
    the node's shingles after this one, ``near`` those of them that another
    prefix holds or that are behind the prefix: no others can be common with a
    partner whose prefix ends no earlier. ``rank`` counts the shared ones before
    this one; both prefixes reach that far, so no others can be common there. The
    node of a pair whose prefix ends first must find PERCENT of its set in
    ``near``, so a row goes that cannot if no row that can ends earlier. (A
    document with several texts keeps its places.)
    """
    ends = nodes.groupBy("doc").agg((F.count("*") > 1).alias("many"), F.max(F.struct("en", "eg")).alias("last"))
    by_doc = Window.partitionBy("doc").orderBy("pos")
    seen = (members.withColumn("rank", F.row_number().over(by_doc) - 1)
            .withColumn("shared", F.count("*").over(Window.partitionBy("doc"))).join(ends, "doc"))
    far = F.col("n") - F.col("pos") - 1
    near = F.when(F.col("many"), far).otherwise(F.col("n") - F.floor(F.col("n") / 4) - 1 + F.col("shared") - F.col("rank") - 1)
    rank = F.when(F.col("many"), F.col("pos")).otherwise(F.col("rank"))
    left = (seen.select("gram", "doc", F.col("n").cast("long").alias("n"), rank.cast("long").alias("rank"),
                        far.cast("long").alias("far"), near.cast("long").alias("near"), "last")
            .withColumn("opens", F.col("near") + 1 >= F.ceil(PERCENT * F.col("n") / F.lit(100))))
    low = (left.groupBy("gram").agg(F.min(F.when(F.col("opens"), F.col("last"))).alias("low"))
           .where("low is not null"))
    return left.join(low, "gram").where("opens or last >= low").drop("opens", "low")


def may_link(a: str, b: str, only_first: bool = False) -> Column:
    """Length, index-prefix and positional filter on two members of one shingle (struct columns of ``refined``).

    ``only_first``: the shingle must be able to be the first one that the two
    have in common. That finds every pair that links, but at one shingle only.
    """
    na, nb, pa_, pb = (F.col(f"{x}.{y}") for y in ("n", "rank") for x in (a, b))
    small = F.least(na, nb)
    length = 100 * small >= PERCENT * F.greatest(na, nb)
    rest_a = F.when(F.col(f"{a}.last") <= F.col(f"{b}.last"), F.col(f"{a}.near")).otherwise(F.col(f"{a}.far"))
    rest_b = F.when(F.col(f"{b}.last") <= F.col(f"{a}.last"), F.col(f"{b}.near")).otherwise(F.col(f"{b}.far"))
    if only_first:
        return length & (1 + F.least(rest_a, rest_b) >= need(na, nb))
    # The smaller set is found by what may be missing from an equally large partner.
    def first(n, rest):
        return rest + 1 >= F.ceil(2 * PERCENT * n / F.lit(100 + PERCENT))
    index = F.when(na < nb, first(na, rest_a)).when(nb < na, first(nb, rest_b)).otherwise(first(na, rest_a) & first(nb, rest_b))
    place = F.least(pa_, pb) + 1 + F.least(rest_a, rest_b) >= need(na, nb)
    return length & index & place


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc, set`` of the documents wanted, and of few others.

    A filter of ``ID_BITS`` bits on their ids goes to the tasks; it only saves
    work, as the joins that follow name the documents they need.
    """
    kind = dict(docs.dtypes)["doc_id"]
    bit = F.pmod(F.xxhash64("doc"), F.lit(ID_BITS))
    words = (wanted.select(F.shiftright(bit, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, int(pmod(xxhash64(doc), {ID_BITS}) % 64))").alias("bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())  # at most ID_BITS / 64 rows
    table = np.zeros(ID_BITS // 64, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def run(it):
        bits = shared.value
        for b in batches(it):
            slot = b.column(2).to_numpy()
            keep = (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            if not keep.any():
                continue
            b = b.filter(pa.array(keep.astype(bool)))
            sets = [s for _, part in sets_of(b.column(1)) for s in part]
            off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(sets)))], ["doc", "set"])

    rows = docs.where("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(ID_BITS)).alias("slot"))
    return arrow_map(rows, run, f"doc {kind}, set array<long>")


def links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The distinct pairs ``a, b`` of ``pairs`` that link: suffix filter, then the whole sets.

    Only the sets of documents in pairs that the filter leaves are made.
    """
    a = nodes.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("ranges").alias("ra"))
    b = nodes.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("ranges").alias("rb"))
    bound = F.aggregate(F.zip_with("ra", "rb", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x)
    close = written(pairs.distinct().join(a, "a").join(b, "b").where(bound >= need(F.col("na"), F.col("nb"))).select("a", "b"), "close-pairs")
    sets = written(_sets(docs, close.select(F.explode(F.array("a", "b")).alias("doc")).distinct()), "shingle-sets")
    sa = sets.select(F.col("doc").alias("a"), F.col("set").alias("sa"))
    sb = sets.select(F.col("doc").alias("b"), F.col("set").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    found = written(close.join(sb, "b").join(sa, "a")
                    .where(100 * common >= PERCENT * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "links")
    discard(close, sets)
    return found


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node ``u`` hangs on one ``v``, and no such ``v`` hangs on another."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("low"), F.lit(0).alias("top")),
                                          F.struct(F.col("v").alias("x"), F.lit(0).alias("low"), F.lit(1).alias("top")))).alias("e")).select("e.*")
    nodes = ends.groupBy("x").agg(F.sum("low").alias("low"), F.max("top").alias("top"))
    most, both = nodes.agg(F.max("low"), F.max(F.least(F.col("low"), F.col("top").cast("long")))).first()
    return (most or 0) <= 1 and not both


def components(edges: DataFrame) -> DataFrame:
    """``doc, comp``: the smallest id that each node of ``a, b`` reaches (large-star and small-star rounds).

    Each round hooks neighbours to the smallest one known; the tables between
    rounds are written, nothing comes to the driver but two counts.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_star_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "x")
        large = both.join(low, F.col("u") == F.col("x")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: below each node, everything hangs on its smallest neighbour.
        small_low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        small = (large.join(small_low, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_low.select(F.col("x").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct())
        after = written(small, "edges")
        discard(now)
        now = after
    return now.groupBy(F.col("u").alias("doc")).agg(F.min("v").alias("comp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles long, component_id`` of each row: the smallest id that links lead to.

    One row per input row. Null and empty texts, and those of white space only,
    have no shingles and are linked with nothing; so are rows with a null id,
    which get a null component. Rows that share an id belong to one component
    if their texts do. Texts of any length are read whole.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(prefixes(docs, sketch(docs)), "prefixes")
    nodes = (rows.where("n > 0 and doc_id is not null").groupBy("d1", "d2")
             .agg(F.min(F.struct("doc_id", "n", "prefix", "en", "eg", "ranges")).alias("s"))
             .select("d1", "d2", F.col("s.doc_id").alias("doc"), "s.n", "s.prefix", "s.en", "s.eg", "s.ranges"))
    shared = written(shared_grams(nodes), "shared-grams")
    slim = written(nodes.select("d1", "d2", "doc", "n", "en", "eg", "ranges"), "nodes")
    members = written(refined(shared, slim), "members")
    flat = written(rows.select("doc_id", "n", "d1", "d2"), "documents")
    discard(rows, shared)
    member = F.struct("doc", "n", "rank", "far", "near", "last")

    def ids(candidates: DataFrame) -> DataFrame:
        return candidates.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))

    def grouped(edges: DataFrame) -> DataFrame:
        """The members with their component."""
        comp = written(components(edges), "components")
        return members.join(comp, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))

    # Each node with the smallest node of each of its shingles.
    lead = members.groupBy("gram").agg(F.min(member).alias("x"))
    star = members.select("gram", member.alias("y")).join(lead, "gram").where("x.doc <> y.doc").where(may_link("x", "y"))
    edges = links(docs, slim, ids(star))

    # The components found, as single members of their shingles, in the same way.
    groups = grouped(edges).groupBy("gram", "comp").agg(F.min(member).alias("y"))
    lead = groups.groupBy("gram").agg(F.min(F.struct("comp", "y")).alias("first"), F.max("comp").alias("top")).where("first.comp < top")
    star = groups.join(lead.select("gram", F.col("first.comp").alias("c"), F.col("first.y").alias("x")), "gram").where("comp <> c").where(may_link("x", "y"))
    edges = edges.unionByName(links(docs, slim, ids(star)))

    # All candidates that are left between two components.
    placed = grouped(edges)
    is_open = placed.groupBy("gram").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("gram")
    left = written(placed.join(is_open, "gram", "left_semi"), "open-grams")
    one = left.select("gram", member.alias("x"), F.col("comp").alias("cx"))
    two = left.select("gram", member.alias("y"), F.col("comp").alias("cy"))
    pairs = one.join(two, "gram").where("cx <> cy and x.doc < y.doc").where(may_link("x", "y", only_first=True))
    final = written(components(edges.unionByName(links(docs, slim, ids(pairs)))), "components")
    discard(members, left)

    named = slim.select("d1", "d2", "doc").join(final, "doc", "left").select("d1", "d2", F.coalesce("comp", "doc").alias("component"))
    return (flat.join(named, ["d1", "d2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id")).alias("component_id")))
