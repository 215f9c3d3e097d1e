
from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from newsevents.operators.entities import entity_counts
from newsevents.operators.records import parse_graph
from newsevents.operators.trend import moving_average, moving_average_explode

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

series_points = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 120), st.integers(-50, 50)),
    min_size=1, max_size=60, unique_by=lambda p: (p[0], p[1]))


@FEW
@given(points=series_points, n=st.integers(1, 40), bucket=st.integers(40, 90))
def test_window_forms_agree_with_brute_force(spark, points, n, bucket):
    start = date(2000, 1, 1)
    rows = [(k, start + timedelta(days=d), float(v)) for k, d, v in points]
    df = spark.createDataFrame(rows, "k string, day date, value double")
    want = {}
    for k, d, _ in rows:
        frame = [v for k2, d2, v in rows if k2 == k and d - timedelta(days=n - 1) <= d2 <= d]
        want[(k, d)] = sum(frame) / len(frame)
    got = {(r.k, r.day): r.moving_avg for r in moving_average(df, n, keys=["k"], bucket_days=bucket).collect()}
    exp = {(r.k, r.day): r.moving_avg for r in moving_average_explode(df, n, keys=["k"]).collect()}
    assert got.keys() == want.keys() == exp.keys()
    assert all(abs(got[x] - want[x]) < 1e-9 and abs(exp[x] - want[x]) < 1e-9 for x in want)


names = st.text(alphabet="abcxyz", min_size=1, max_size=3)


@FEW
@given(records=st.lists(st.tuples(st.lists(names, max_size=4), st.lists(names, max_size=3),
                                  st.lists(names, max_size=3)), min_size=1, max_size=25),
       parts=st.integers(1, 5))
def test_entity_counts_sum_to_list_sizes_under_any_partitioning(spark, records, parts):
    lines = ["\t".join(["20140909", "1", "", ";".join(t), "", ";".join(p), ";".join(o), "", "", "", ""])
             for t, p, o in records]
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(parts)
    counts = entity_counts(parse_graph(df))
    total = sum(len(t) + len(p) + len(o) for t, p, o in records)
    assert (counts.groupBy().sum("n").first()[0] or 0) == total
    again = entity_counts(parse_graph(df.repartition(parts + 2)))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, again.collect()))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet="ab1é'’. -,x", max_size=40), min_size=1, max_size=30))
def test_tokenizer_equals_token_pattern(spark, texts):
    import regex

    from newsevents.functions.text import TOKEN, tokens
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: r.t for r in df.select("i", tokens(df.text).alias("t")).collect()}
    want = {i: regex.findall(TOKEN, t) for i, t in enumerate(texts)}
    assert got == want


def test_pathological_token_run_does_not_overflow(spark):
    from pyspark.sql import functions as F

    from newsevents.functions.text import tokens
    df = spark.createDataFrame([("a." * 100000 + "end",)], "text string")
    assert df.select(F.size(tokens(df.text))).first()[0] == 1
