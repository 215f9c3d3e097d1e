"""Feed lines built from the driver's tables.

The test data holds no feed files, so these builders write the two feed
formats from ``lineitem``/``orders``/... with Spark. Parsing those lines with
our readers and comparing against SQL over the same tables tests the parsers
for real. Numbers are written with a fixed format (``%.2f``) so that a SQL
oracle can rebuild the very same text.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsevents.session import list_files, publish_once, shared_root, shuffles_cleaned
from newsevents.schema import EVENT_WIDTH
from newsevents.sources.tables import table

def _empty() -> Column:
    return F.lit("")


def _s(c: Column) -> Column:
    return F.coalesce(c.cast("string"), _empty())


def _num2(c: Column) -> Column:
    """Two decimals, as ``printf('%.2f')`` writes them (a decimal cast is far
    cheaper than ``format_string``; the inputs have at most two decimals)."""
    return c.cast("decimal(18,2)").cast("string")


def _page_urls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Pages and their count, the count as a scalar subquery inside the plan."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    n = table(spark, sf_dir, "pages", "page_id").agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    return pages, n


def event_line_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with the 58 feed fields as strings ``f0..f57``."""
    # Not spread first: the join by order deals the lines out anyway, before their fields are made.
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    supp = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    part = table(spark, sf_dir, "part", "p_partkey", "p_size")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    cn = F.broadcast(nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name")))
    sn = F.broadcast(nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name")))
    pages, n_pages = _page_urls(spark, sf_dir)

    # What hangs on an order is joined to the orders, what hangs on a line to the lines while they are narrow:
    # no line is shuffled with a customer's or a page's text but in the last join. Nations (broadcast) come after it.
    by_order = (orders.join(cust, F.col("o_custkey") == cust.c_custkey)
                .withColumn("_page", F.pmod(F.col("o_orderkey"), n_pages))
                .join(pages, F.col("_page") == pages.page_id, "left"))
    by_line = (li.join(part, F.col("l_partkey") == part.p_partkey)
               .join(supp, F.col("l_suppkey") == supp.s_suppkey))
    j = (by_line.join(by_order, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(cn, F.col("c_nationkey") == cn.cn_key).join(sn, F.col("s_nationkey") == sn.sn_key))

    ln = F.col("l_linenumber")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    f = [_empty()] * EVENT_WIDTH
    f[0] = _s(F.col("l_orderkey") * 8 + ln)
    f[1], f[2] = day, F.substring(day, 1, 6)
    f[3] = F.substring(day, 1, 4)
    f[4] = F.concat(f[3], F.lit(".5"))
    f[5], f[6] = F.concat(F.lit("C"), _s(F.col("c_custkey"))), _s(F.col("c_name"))
    f[7], f[8] = _s(F.col("cn_name")), _s(F.col("c_mktsegment"))
    f[15], f[16] = F.concat(F.lit("S"), _s(F.col("s_suppkey"))), _s(F.col("s_name"))
    f[17] = _s(F.col("sn_name"))
    f[25] = F.when(F.col("l_returnflag") == "R", F.lit("1")).otherwise(F.lit("0"))
    f[26] = f[27] = f[28] = F.concat(F.lit("0"), _s(ln))
    f[29], f[30], f[31], f[32] = _s(ln), _num2(F.col("l_quantity")), _s(F.col("p_size")), _s(ln)
    f[33] = F.when(ln == 7, F.lit("x")).otherwise(_s(ln))
    f[34] = _num2(F.col("l_discount"))
    for start, typ, name, key in ((35, "1", "cn_name", "c_nationkey"), (42, "1", "sn_name", "s_nationkey")):
        f[start:start + 7] = [F.lit(typ), _s(F.col(name)), _s(F.col(name)), _empty(),
                              _s(F.col(key)), _s(-F.col(key)), _empty()]
    open_line = F.col("l_linestatus") != "F"
    geo = [F.lit("4"), _s(F.col("cn_name")), _s(F.col("cn_name")), _empty(),
           _s(F.col("c_nationkey")), _s(-F.col("c_nationkey")), _empty()]
    f[49:56] = [F.when(open_line, g).otherwise(_empty()) for g in geo]
    f[56] = day
    f[57] = F.when(ln % 2 == 1, _s(F.col("url"))).otherwise(_empty())
    return j.select(*[c.alias(f"f{i}") for i, c in enumerate(f)])


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-feed lines (column ``value``), one per lineitem row."""
    cols = event_line_columns(spark, sf_dir)
    return cols.select(F.concat_ws("\t", *[F.col(f"f{i}") for i in range(EVENT_WIDTH)]).alias("value"))


GRAPH_HEADER = "\t".join(["DATE", "NUMARTS", "COUNTS", "THEMES", "LOCATIONS", "PERSONS",
                          "ORGANIZATIONS", "TONE", "CAMEOEVENTIDS", "SOURCES", "SOURCEURLS"])


def _location(key: Column, name: Column) -> Column:
    return F.concat_ws("#", F.lit("1"), name, name, _empty(), key.cast("string"),
                       (-key).cast("string"), _empty())


def graph_lines(spark: SparkSession, sf_dir: str, header: bool = True) -> DataFrame:
    """Knowledge-graph lines (column ``value``): one per order, plus a header line."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    supp = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    part = table(spark, sf_dir, "part", "p_partkey", "p_type")
    nation = F.broadcast(table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    pages, n_pages = _page_urls(spark, sf_dir)

    # Per order: bounded by the order's line count. The lines move to their order as rows; collected first, they would move as arrays.
    per_order = (li.join(part, li.l_partkey == part.p_partkey)
                 .join(supp, li.l_suppkey == supp.s_suppkey)
                 .select("l_orderkey", "l_linenumber", "p_type", "s_name", "s_nationkey").repartition("l_orderkey")
                 .join(nation, F.col("s_nationkey") == nation.n_nationkey)
                 .groupBy("l_orderkey")
                 .agg(F.count(F.lit(1)).alias("n_lines"),
                      F.array_sort(F.collect_set("p_type")).alias("themes"),
                      F.array_sort(F.collect_set("s_name")).alias("orgs"),
                      F.array_sort(F.collect_set(F.struct("s_nationkey", "n_name"))).alias("snat"),
                      F.array_sort(F.collect_list(F.col("l_orderkey") * 8 + F.col("l_linenumber"))).alias("ids")))
    u1 = pages.select(F.col("page_id").alias("u1_id"), F.col("url").alias("url1"))
    u2 = pages.select(F.col("page_id").alias("u2_id"), F.col("url").alias("url2"))
    j = (orders.join(cust, F.col("o_custkey") == cust.c_custkey)
         .withColumn("_p1", F.pmod(F.col("o_orderkey"), n_pages))
         .withColumn("_p2", F.pmod(F.col("o_orderkey") + 1, n_pages))
         .join(u1, F.col("_p1") == u1.u1_id, "left")
         .join(u2, F.col("_p2") == u2.u2_id, "left")
         .join(per_order, F.col("o_orderkey") == per_order.l_orderkey, "left")     # last: the arrays are not moved again
         .join(nation, F.col("c_nationkey") == nation.n_nationkey))
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0))
    themes = F.coalesce(F.col("themes"), F.array().cast("array<string>"))
    locs = F.concat(F.array(_location(F.col("c_nationkey"), F.col("n_name"))),
                    F.transform(F.coalesce(F.col("snat"), F.array().cast("array<struct<s_nationkey:int,n_name:string>>")),
                                lambda s: _location(s["s_nationkey"], s["n_name"])))
    ids = F.coalesce(F.col("ids"), F.array().cast("array<bigint>"))
    fields = [
        F.date_format("o_orderdate", "yyyyMMdd"),
        n_lines.cast("string"),
        F.concat(F.lit("ORDER#"), n_lines.cast("string"), F.lit("#"), F.col("n_name"), F.lit(";")),
        F.when(F.size(themes) > 0, F.concat(F.array_join(themes, ";"), F.lit(";"))).otherwise(_empty()),
        F.array_join(locs, ";"),
        _s(F.col("c_name")),
        F.array_join(F.coalesce(F.col("orgs"), F.array().cast("array<string>")), ";"),
        F.concat(_num2(F.col("o_totalprice")), F.lit(",1.5,x,3,4,5,6")),
        F.array_join(F.concat(F.transform(ids, lambda x: x.cast("string")), F.array(F.lit("x"))), ","),
        _s(F.col("o_orderpriority")),
        F.concat_ws("<UDIV>", _s(F.col("url1")), _s(F.col("url2"))),
    ]
    lines = j.select(F.concat_ws("\t", *fields).alias("value"))
    if header:
        lines = lines.unionByName(spark.range(1).select(F.lit(GRAPH_HEADER).alias("value")))
    return lines


#: Lines of a feed file: a gzipped file is read by one task.
FILE_LINES = 100_000


def write_lines(lines: DataFrame, path: str) -> None:
    """Feed lines as gzipped text files of at most ``FILE_LINES``, as daily files come."""
    with shuffles_cleaned(lines.sparkSession):
        lines.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(path)


# Bump when the line layout changes: published feeds are keyed by it.
FEED_VERSION = "1"
_FEED_TABLES = {"events": ["lineitem", "orders", "customer", "supplier", "part", "nation", "pages"],
                "graph": ["lineitem", "orders", "customer", "supplier", "part", "nation", "pages"]}


def _stamp(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    """Key of the tables as they are now: every file's path, length and time, on any file system."""
    parts = [FEED_VERSION, sf_dir.rstrip("/")]
    for t in tables:
        parts += map(str, list_files(spark, f"{sf_dir.rstrip('/')}/{t}.parquet"))
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:16]


def feed_files(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of the ``events`` or ``graph`` feed files for these tables.

    The feeds are written once per set of tables into the shared folder (as
    the daily files would sit in storage) and then read by the production
    readers, ``read_events`` / ``read_graph``.
    """
    build = {"events": event_lines, "graph": graph_lines}[kind]
    path = f"{shared_root(spark).rstrip('/')}/feeds/{kind}-{_stamp(spark, sf_dir, _FEED_TABLES[kind])}"
    return publish_once(spark, path, lambda tmp: write_lines(build(spark, sf_dir), tmp))
