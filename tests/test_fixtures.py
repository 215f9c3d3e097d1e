import glob
import gzip
from datetime import date
from decimal import Decimal

from newsevents.sources import fixtures


def small_tables(spark, root):
    """Two orders with lines, one without, keys that are missing or come twice."""
    def put(name, schema, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    put("nation", "n_nationkey int, n_name string", [(0, "A"), (1, "B")])
    put("customer", "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(1, "c one", 0, "m"), (2, None, 1, "m"), (None, "x", 0, "m")])
    put("supplier", "s_suppkey long, s_name string, s_nationkey int", [(1, "s one", 1), (2, "s two", 0), (2, "s two", 0)])
    put("part", "p_partkey long, p_size int, p_type string", [(1, 5, "t1"), (2, None, "t2")])
    put("pages", "page_id long, url string", [(0, "u0"), (1, "u1"), (2, "u2")])
    put("orders", "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice decimal(9,2), o_orderpriority string",
        [(k, c, date(1995, 1, k), Decimal(10), "p") for k, c in ((1, 1), (2, 2), (3, 1), (4, 9), (5, None))])
    put("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity decimal(9,2), l_discount decimal(9,2), l_returnflag string, l_linestatus string",
        [(o, p, s, n, Decimal(n), Decimal(0), "N", "O") for o, p, s, n in ((1, 1, 1, 1), (1, 2, 2, 2), (2, 1, 2, 1), (2, 9, 1, 3), (4, 1, 1, 1), (None, 1, 1, 1))])


def test_feed_files_are_gzipped_and_bounded(spark, tmp_path, monkeypatch):
    small_tables(spark, tmp_path)
    monkeypatch.setattr(fixtures, "FILE_LINES", 2)
    for kind, want in (("events", 5), ("graph", 4)):     # supplier 2 comes twice; customers 9 and null are none
        files = glob.glob(fixtures.feed_files(spark, str(tmp_path), kind).removeprefix("file:") + "/part-*")
        lines = [gzip.open(f, "rt").read().splitlines() for f in files]
        assert all(f.endswith(".gz") for f in files) and max(map(len, lines)) <= 2 and sum(map(len, lines)) == want
        fields = sorted(x.split("\t") for part in lines for x in part)
        if kind == "events":
            assert [(f[0], f[6], f[16], f[31], f[57]) for f in fields] == [
                ("10", "c one", "s two", "", "")] * 2 + [("17", "", "s two", "5", "u2")] * 2 + [("9", "c one", "s one", "5", "u1")]
        else:
            assert [(f[1], f[3], f[6], f[8], f[10]) for f in fields[:3]] == [
                ("3", "t1;t2;", "s one;s two", "9,10,10,x", "u1<UDIV>u2"), ("2", "t1;", "s two", "17,17,x", "u2<UDIV>u0"), ("0", "", "", "x", "u0<UDIV>u1")]


def test_lines_are_dealt_out_once_and_without_nations(spark, tmp_path):
    """Nothing is spread before the joins, and a nation's name is looked up after the last shuffle."""
    small_tables(spark, tmp_path)
    for build, deal in ((fixtures.event_lines, "Join Inner, (l_orderkey#"), (fixtures.graph_lines, "RepartitionByExpression [l_orderkey#")):
        plan = build(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString().splitlines()
        nations = [i for i, x in enumerate(plan) if "strategy=broadcast" in x]
        dealt = [i for i, x in enumerate(plan) if deal in x]
        assert len(nations) == 2 and len(dealt) == 1 and max(nations) < dealt[0]
        assert not any("Repartition " in x for x in plan)


def test_shuffles_of_a_written_feed_are_cleaned(spark, tmp_path, monkeypatch):
    from newsevents import session
    from newsevents.sources import fixtures
    seen = []
    class Lines:
        sparkSession = spark
        write = property(lambda self: self)
        def mode(self, x): return self
        def option(self, *x): return self
        def text(self, path): seen.append(spark.conf.get(session.CLEAN_UP))
    fixtures.write_lines(Lines(), str(tmp_path / "x"))
    assert seen == ["true"] and spark.conf.get(session.CLEAN_UP, "false") == "false"
