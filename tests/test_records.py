import os
from datetime import date

from pyspark.sql import functions as F

from conftest import event_line
from newsevents.operators.records import null_empty_structs, parse_events, parse_graph, with_row_key
from newsevents.sinks.writers import write_event_json
from newsevents.sources.feeds import read_events, read_graph


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_actors_and_geos_do_not_alias(spark):  # Q1
    line = event_line(c0="1", c1="20140909", c7="FR", c17="UK", c37="FR", c44="UK", c51="US")
    r = parse_events(lines_df(spark, [line])).first()
    assert (r.actor1.country_code, r.actor2.country_code) == ("FR", "UK")
    assert (r.actor1_geo.country_code, r.actor2_geo.country_code, r.event_geo.country_code) == ("FR", "UK", "US")


def test_missing_trailing_columns_do_not_inherit(spark):  # Q2
    first = event_line(c0="1", c1="20140909", c57="http://a")
    second = "\t".join(["2", "20140909"] + [""] * 10)          # short line
    rows = {r.cameo: r for r in parse_events(lines_df(spark, [first, second])).collect()}
    assert rows[1].source_url == "http://a"
    assert rows[2].source_url is None


def test_bad_values_become_null(spark):  # Q5, X2, X3, X5
    lines = [event_line(c0="1", c1="20141301", c2="1.7", c30="abc"),
             event_line(c0="2", c1="20140909x", c30="NaN"),
             event_line(c0="3", c1="20140909", c2="201409", c30="-2.5", c25="1", c33="x")]
    rows = {r.cameo: r for r in parse_events(lines_df(spark, lines)).collect()}
    assert rows[1].day is None and rows[1].month is None and rows[1].goldstein is None
    assert rows[2].day is None and rows[2].goldstein is None
    assert rows[3].day == date(2014, 9, 9) and rows[3].month == 201409
    assert rows[3].goldstein == -2.5 and rows[3].is_root is True and rows[3].num_articles is None


def test_blank_short_and_long_lines(spark):  # Q12
    long_line = event_line(c0="5", c57="u") + "\textra1\textra2"
    rows = parse_events(lines_df(spark, ["", "7", long_line])).collect()
    assert sorted(r.cameo for r in rows) == [5, 7]
    r5 = [r for r in rows if r.cameo == 5][0]
    assert r5.source_url == "u"


def test_big_id_kept(spark):
    r = parse_events(lines_df(spark, [event_line(c0="3000000000")])).first()
    assert r.cameo == 3000000000


def test_null_empty_structs(spark):  # P4
    line = event_line(c0="1", c37="FR")
    r = null_empty_structs(parse_events(lines_df(spark, [line]))).first()
    assert r.actor1_geo is not None and r.actor1_geo.country_code == "FR"
    assert r.event_geo is None and r.actor1 is None


def test_csv_file_scan_matches_in_memory_parse(spark, tmpdir_path):  # S1
    lines = [event_line(c0=str(i), c1="20140909", c30=str(i / 2), c37="FR", c44="UK",
                        c57="" if i % 2 else f"http://p/{i}") for i in range(20)]
    lines.append("")
    path = os.path.join(tmpdir_path, "events")
    lines_df(spark, lines).coalesce(1).write.text(path)
    a = sorted(tuple(r) for r in null_empty_structs(read_events(spark, path)).collect())
    b = sorted(tuple(r) for r in null_empty_structs(parse_events(lines_df(spark, lines))).collect())
    assert a == b and len(a) == 20


def test_filter_reaches_csv_scan(spark, tmpdir_path):  # section 4: pushdown
    path = os.path.join(tmpdir_path, "events")
    lines_df(spark, [event_line(c0="1", c37="FR", c44="UK")]).write.text(path)
    ev = read_events(spark, path)
    q = ev.where((F.col("actor1_geo.country_code") == "FR") & (F.col("actor2_geo.country_code") == "UK"))
    plan = q.select("day")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [EqualTo(_c37,FR), EqualTo(_c44,UK)]" in plan.replace("IsNotNull(_c37), IsNotNull(_c44), ", "")


GRAPH_HEADER = "DATE\tNUMARTS\tCOUNTS\tTHEMES\tLOCATIONS\tPERSONS\tORGANIZATIONS\tTONE\tCAMEOEVENTIDS\tSOURCES\tSOURCEURLS"


def test_graph_parse(spark):  # P2a-d, Q8, Q9, Q10, F6
    full = "\t".join(["20140909", "3", "A#1;B#2;", "T1;T2;", "1#Paris#FR##48.8#2.3#-1;4#Lyon#FR#B9#45.7#4.8#x",
                      "anna;;bob;", "org1", "1.5,2,x,4,5,6,7", "10,11,x", "bbc.co.uk", "http://a<UDIV>http://b"])
    empty = "\t".join(["20140910", "1", "", "", "", "", "", "", "", "", ""])
    rows = parse_graph(lines_df(spark, [GRAPH_HEADER, full, empty])).orderBy("date").collect()
    assert len(rows) == 2
    r, e = rows
    assert r.persons == ["anna", "bob"] and r.themes == ["T1", "T2"] and r.counts == ["A#1", "B#2"]
    assert [loc.name for loc in r.locations] == ["Paris", "Lyon"] and r.locations[0].latitude == 48.8
    assert r.locations[1].adm == "B9" and r.locations[1].feature == "x"
    assert r.tones.average_tone == 1.5 and r.tones.negative_score is None and r.tones.group_density == 6.0
    assert r.cameos == [10, 11] and r.urls == ["http://a", "http://b"]
    assert e.locations == [] and e.persons == [] and e.cameos == []
    tidy = null_empty_structs(parse_graph(lines_df(spark, [empty]))).first()
    assert tidy.tones is None


def test_graph_file_scan_row_key(spark, tmpdir_path):  # S2, S8
    path = os.path.join(tmpdir_path, "gkg")
    line = "\t".join(["20140909", "1", "", "T", "", "p", "o", "1,2,3,4,5,6", "1", "s", "u"])
    lines_df(spark, [GRAPH_HEADER, line]).coalesce(1).write.text(path)
    rows = read_graph(spark, path).collect()
    assert len(rows) == 1 and len(rows[0].row_id) == 32
    again = read_graph(spark, path).first().row_id
    assert again == rows[0].row_id


def test_row_key_is_md5_of_source_and_line(spark):
    import hashlib
    r = with_row_key(lines_df(spark, ["abc"]), "feed").first()
    assert r.row_id == hashlib.md5(b"feed-abc").hexdigest()


def test_event_json_leaves_out_nulls(spark, tmpdir_path):  # K5, X15
    path = os.path.join(tmpdir_path, "json")
    write_event_json(parse_events(lines_df(spark, [event_line(c0="1", c37="FR")])), path)
    js = spark.read.parquet(path).first().json
    assert '"actor1_geo":{"country_code":"FR"}' in js and "event_geo" not in js and "actor2" not in js


def test_json_records_given_or_inferred_schema(spark):  # S5, P5, X16
    from newsevents.sources.feeds import json_records
    df = spark.createDataFrame([(1, '{"k": 69, "tag": "x"}'), (2, '{"k": 3}'), (3, "not json")],
                               "id long, props string")
    got = {r.id: r.k for r in json_records(df, "props", "k int").select("id", "props.k").collect()}
    assert got == {1: 69, 2: 3, 3: None}
    inferred = json_records(df, "props", sample='{"k": 1, "tag": "y"}')
    assert {r.id: r.tag for r in inferred.select("id", "props.tag").collect()} == {1: "x", 2: None, 3: None}


def test_gzipped_feed_is_decoded(spark, tmpdir_path):  # Q26
    import gzip
    path = os.path.join(tmpdir_path, "gz")
    os.makedirs(path)
    lines = [event_line(c0=str(i), c1="20140909", c30="2", c37="FR", c44="UK") for i in range(5)]
    with gzip.open(os.path.join(path, "20140909.export.CSV.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")
    rows = read_events(spark, path).collect()
    assert len(rows) == 5 and {r.actor1_geo.country_code for r in rows} == {"FR"}


def test_unique_row_keys(spark, tmp_path):  # S8
    import hashlib

    from pyspark.sql import functions as F

    from newsevents.operators.records import with_row_key, with_unique_row_key
    lines = [f"line {i % 50}" for i in range(400)] + ["hot line"] * 300 + ["only once"]
    for name, part in (("a", lines), ("b", lines[:100])):
        (tmp_path / name).write_text("\n".join(part) + "\n")
    path = [str(tmp_path / "a"), str(tmp_path / "b")]

    def keys(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            read = spark.read.text(path)
            return sorted((r.value, r.row_id) for r in with_unique_row_key(read, F.col("_metadata.file_path")).collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    whole = keys("1m")
    assert whole == keys("500b") and len(whole) == len(lines) + 100 == len({k for _, k in whole})
    plain = {(r.value, r.row_id) for r in with_row_key(spark.read.text(path), F.col("_metadata.file_path")).collect()}
    assert plain <= set(whole)
    first = next(k for v, k in plain if v == "only once")
    where = spark.read.text(str(tmp_path / "a")).select("_metadata.file_path").first()[0]
    assert first == hashlib.md5(f"{where}-only once".encode()).hexdigest()
    assert with_unique_row_key(spark.createDataFrame([], "value string"), "x").count() == 0


def test_null_text_of_articles_is_written_empty(spark, tmp_path):  # X10
    from newsevents.sinks.writers import write_articles
    write_articles(spark.createDataFrame([(1, None, None), (2, "t", "c")], "cameo long, title string, content string"), str(tmp_path / "x"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "x")).collect()) == [(1, "", ""), (2, "t", "c")]


def test_copies_of_a_line_are_counted_not_moved(spark, monkeypatch):  # S8
    import hashlib

    from pyspark.sql import functions as F

    from newsevents.operators import records
    monkeypatch.setattr(records, "RUN", 7)
    lines = spark.createDataFrame([("hot",)] * 40 + [("two",)] * 2 + [(None,)] * 2 + [("one",)], "value string").repartition(3)
    keyed = records.with_unique_row_key(lines, "s")
    def key(text, i):
        first = hashlib.md5(text.encode()).hexdigest()
        return hashlib.md5(f"{first}-{i}".encode()).hexdigest() if i else first
    want = [("hot", key("s-hot", i)) for i in range(40)] + [("two", key("s-two", i)) for i in range(2)] + [(None, key("s", i)) for i in range(2)] + [("one", key("s-one", 0))]
    assert sorted(((r.value, r.row_id) for r in keyed.collect()), key=str) == sorted(want, key=str)
    assert "Join" not in keyed._jdf.queryExecution().optimizedPlan().toString()      # a line's text meets no table of repeats
    more = lines.withColumn("x", F.when(F.col("value") == "hot", F.spark_partition_id()))
    got = records.with_unique_row_key(more, "s")
    assert got.columns == ["value", "x", "row_id"] and sorted(((r.value, r.row_id) for r in got.collect()), key=str) == sorted(want, key=str)
