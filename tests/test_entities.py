import random

from newsevents.operators.entities import entity_counts, entity_top_n, global_rank
from newsevents.operators.records import parse_graph


def graph(spark, rows):
    lines = ["\t".join(["20140909", "1", "", ";".join(t), "", ";".join(p), ";".join(o), "", "", "", ""])
             for t, p, o in rows]
    return parse_graph(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_counts_repeat_inside_record_counts_again(spark):  # Q27, A2, U1
    g = graph(spark, [(["T", "T"], ["anna"], ["acme"]), (["T"], ["bob", "anna"], [])])
    got = {(r.kind, r.entity): r.n for r in entity_counts(g).collect()}
    assert got == {("theme", "T"): 3, ("person", "anna"): 2, ("person", "bob"): 1, ("organization", "acme"): 1}


def test_ties_ordered_by_name(spark):  # T1
    g = graph(spark, [([], ["zed", "amy"], []), ([], ["zed", "amy"], []), ([], ["bob"], [])])
    top = [(r.rank, r.entity, r.n) for r in entity_top_n(entity_counts(g), 2).orderBy("rank").collect()]
    assert top == [(1, "amy", 2), (2, "zed", 2)]


def test_global_rank_equals_window_rank(spark):  # T2 without N
    rnd = random.Random(5)
    rows = [("theme" if i % 3 else "person", f"e{rnd.randint(0, 300)}", rnd.randint(1, 20)) for i in range(2000)]
    counts = spark.createDataFrame(rows, "kind string, entity string, n bigint").dropDuplicates(["kind", "entity"])
    want = sorted(tuple(r) for r in entity_top_n(counts, 10_000).collect())
    got = sorted(tuple(r) for r in global_rank(counts, partitions=7).collect())
    assert got == want
