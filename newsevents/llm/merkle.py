"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs by descent.

A row's leaf is the digest of its fields; the leaves of a source, in id order, are
folded 16 at a time until one digest is left, the source's subroot, and the subroots, in
source order, fold to the root. The manifest is a folder of tables:

* ``leaves``: ``p, r, doc_id, leaf`` - the place of the row's source, its rank there;
* ``sources``: ``p, source, n, height, subroot``;
* ``nodes``: ``digest -> children``, one record for each digest, in folders by
  ``tree`` (``source`` or ``top``) and ``height`` above the leaves;
* ``root``: one row.

``prove`` answers leaf requests by descent. The requests' ranks, divided by powers of
16, say which digests are on a path; from the root down, each of them is looked up
by its digest, the child that the rank's digit selects is followed and the children not
selected are collected as a segment ``(before, after)``. Requests under one node
share its record and its path, so a level holds a row for each node on a path, not for
each request. The segments, reversed, lead from the leaf to the root: they are the proof.

Everything is DataFrame expressions. Ranks come from a range partitioning by (source, id) and the row
counts of its parts, so a source with a third of all rows is spread like any other; a fold
groups 16 rows at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsevents.llm.common import written
from newsevents.session import shared_dir

#: Children of a node, and its binary digits.
FAN, FAN_BITS = 16, 4
#: The counts of a range partitioning's parts are broadcast up to this many rows (about 40 bytes each).
BROADCAST_ROWS = 500_000


def _value(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*fields: Column | str) -> Column:
    """Digest of a row's fields: each is its byte count, a colon and its text, or ``-`` if null."""
    return F.sha2(F.concat(*[_value(F.col(f) if isinstance(f, str) else f) for f in fields]), 256)


def ranked(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """``df`` with the place of each row in its group from 0, nulls first; rows equal in ``order`` in any order.

    No group is gathered: rows are range-partitioned and sorted, written (places
    in a part must not change), and counted by part and group.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order, "_salt"]
    # Repeated rows may be many: a number spreads them over parts.
    cut = written(df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .drop("_salt").withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # Several rows a part only where groups begin in it: parts + groups rows in all.
    heads = cut.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = written(heads.select(F.col("_part").alias("_hp"), *[F.col(g).alias(f"_h_{g}") for g in group],
                                 (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "heads")
    if heads.count() <= BROADCAST_ROWS:
        heads = F.broadcast(heads)
    on = F.col("_part") == F.col("_hp")
    for g in group:
        on &= F.col(g).eqNullSafe(F.col(f"_h_{g}"))
    return cut.join(heads, on).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(out))


@dataclass
class Manifest:
    """Tables of a manifest in ``path``; ``heights`` of the tallest source tree and of the tree of subroots."""

    spark: SparkSession
    path: str
    height: int
    top: int

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def nodes(self, tree: str, height: int) -> DataFrame:
        """``digest, children`` of one level: each digest once, whatever stands above it."""
        return self.table(f"nodes/{tree}-{height}").groupBy("digest").agg(F.first("children").alias("children"))

    def root(self) -> str | None:
        r = self.table("root").first()
        return r.root if r else None


def _fold(level: DataFrame) -> DataFrame:
    """Runs of ``FAN`` digests (``p, i, digest``) as their nodes: ``p, i, digest, children``."""
    runs = (level.groupBy("p", F.shiftright("i", FAN_BITS).alias("i"))
            .agg(F.array_sort(F.collect_list(F.struct("i", "digest"))).alias("run")))
    return runs.select("p", "i", F.col("run.digest").alias("children")).withColumn("digest", F.sha2(F.array_join("children", ""), 256))


def build(rows: DataFrame, path: str | None = None, source: str = "source", key: str = "doc_id", leaf: str = "leaf") -> Manifest:
    """Write the manifest of ``rows`` (``source, doc_id, leaf``; see ``leaf_digest``).

    A null source is a source (the first), a null id an id (the first of its source). Rows of one
    source and id follow each other by leaf; repeated rows are leaves of their own. A
    table without rows has no leaf, no node and no root. Other columns are not read.
    """
    spark = rows.sparkSession
    path = path or shared_dir(spark, "manifest")

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    plain = rows.select(F.col(source).alias("source"), F.col(key).alias("doc_id"), F.col(leaf).alias("leaf"))
    places = ranked(plain, ["source"], ["doc_id", "leaf"], "r")
    sizes = ranked(places.groupBy("source").agg(F.count(F.lit(1)).alias("n")), [], ["source"], "p")
    sizes = put(sizes, "sizes")
    leaves = put(places.join(sizes.select(F.col("source").alias("_s"), "p"), F.col("source").eqNullSafe(F.col("_s")))
                 .select("p", "r", "doc_id", "leaf"), "leaves")

    def fold_up(level: DataFrame, tree: str, n: DataFrame, top: DataFrame) -> tuple[int, DataFrame]:
        """Levels until every ``p`` of ``n`` (``p, n``) has one digest: how many, and ``p, digest``."""
        height = 0
        tall = n.agg(F.max("n")).first()[0] or 0
        done = top.where(F.col("n") == 1)
        tops = level.join(done.select("p"), "p", "left_semi").select("p", "digest", F.lit(0).alias("height"))
        while tall > 1:
            height += 1
            rest = top.where(F.col("n") > 1).select("p", F.shiftright(F.col("n") + (FAN - 1), FAN_BITS).alias("n"))
            level = put(_fold(level.join(top.where(F.col("n") > 1).select("p"), "p", "left_semi")), f"nodes/{tree}-{height}").select("p", "i", "digest")
            top, tall = rest, -(-tall // FAN)
            tops = tops.unionByName(level.join(top.where(F.col("n") == 1).select("p"), "p", "left_semi").select("p", "digest", F.lit(height).alias("height")))
        return height, tops

    own = sizes.select("p", "n")
    height, tops = fold_up(leaves.select("p", F.col("r").alias("i"), F.col("leaf").alias("digest")), "source", own, own)
    sources = put(sizes.join(tops, "p").select("p", "source", "n", "height", F.col("digest").alias("subroot")), "sources")
    whole = sources.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit(0).cast("long").alias("p"), "n")
    top, root = fold_up(sources.select(F.lit(0).cast("long").alias("p"), F.col("p").alias("i"), F.col("subroot").alias("digest")), "top", whole, whole)
    put(root.select(F.col("digest").alias("root")), "root")
    return Manifest(spark, path, height, top)


def _segment(children: str, digit: Column) -> Column:
    """The children beside the one at ``digit`` (from 0), as text before and after it."""
    c = F.col(children)
    return F.struct(F.array_join(F.slice(c, F.lit(1), digit), "").alias("before"),
                    F.array_join(F.slice(c, digit + 2, F.lit(FAN)), "").alias("after"))


def _step(wanted: DataFrame, above: DataFrame, records: DataFrame) -> DataFrame:
    """One level down: ``wanted`` (``p, i`` and more) with what ``above`` (``p, i, digest, path`` and more, a level up) has of its path."""
    rest = [c for c in above.columns if c not in ("p", "i", "digest", "path")]
    found = above.join(records, "digest").select(F.col("p").alias("_p"), F.col("i").alias("_i"), "children", "path", *rest)
    digit = F.col("i").bitwiseAND(FAN - 1).cast("int")
    on = (F.col("p") == F.col("_p")) & (F.shiftright("i", FAN_BITS) == F.col("_i"))
    return wanted.join(found, on).select(*wanted.columns, *rest, F.element_at("children", digit + 1).alias("digest"),
                                         F.array_append("path", _segment("children", digit)).alias("path"))


_PATH = "array<struct<before:string,after:string>>"


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (``p, r`` and more) with ``subroot``, ``digest`` (the leaf in the manifest) and ``proof``.

    ``proof`` lists segments ``(before, after)`` from the leaf's run up to the root's;
    a lone row has none. A request for a place that does not exist has no row.
    """
    sources = manifest.table("sources")
    paths = written(requests.select("p", F.shiftright("r", FAN_BITS).alias("i")).distinct(), "paths")  # nodes above the leaves asked for
    asked = paths.select("p").distinct()

    # From the root to the subroots asked for.
    zero = F.lit(0).cast("long")
    state = manifest.table("root").select(zero.alias("p"), zero.alias("i"), F.col("root").alias("digest"), F.array().cast(_PATH).alias("path"))
    for h in range(manifest.top, 0, -1):
        on_path = asked.select(zero.alias("p"), F.shiftright("p", FAN_BITS * (h - 1)).alias("i")).distinct()
        state = _step(on_path, state, manifest.nodes("top", h))
    own = state.select(F.col("i").alias("p"), zero.alias("i"), F.col("digest").alias("subroot"), "digest", "path").join(sources.select("p", "height"), "p")

    # From each subroot to the runs of leaves; a source joins at the height of its tree.
    def start(h: int) -> DataFrame:
        return own.where(F.col("height") == h).drop("height")

    state = None
    for h in range(manifest.height, 0, -1):
        state = start(h) if state is None else state.select(start(h).columns).unionByName(start(h))
        if h > 1:
            on_path = paths.select("p", F.shiftright("i", FAN_BITS * (h - 2)).alias("i")).distinct()
            state = _step(on_path, state, manifest.nodes("source", h))

    # The leaves themselves; a source of one row has its leaf for a subroot.
    columns = [c for c in requests.columns if c not in ("p", "r")]
    wanted = requests.select("p", F.col("r").alias("i"), *[F.col(c).alias(f"_c{j}") for j, c in enumerate(columns)])
    found = wanted.join(start(0), ["p", "i"])
    if state is not None:
        found = found.unionByName(_step(wanted, state, manifest.nodes("source", 1)))
    return found.select("p", F.col("i").alias("r"), *[F.col(f"_c{j}").alias(c) for j, c in enumerate(columns)],
                        "subroot", "digest", F.reverse("path").alias("proof"))


def proof_digest(proof: str = "proof") -> Column:
    """Digest of the siblings, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: str, proof: str = "proof") -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, F.col(leaf), lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))
