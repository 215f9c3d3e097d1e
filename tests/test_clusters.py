import random

from newsevents.operators.clusters import assign_clusters, cluster_cost, daily_cluster_sizes, mean_centers


def test_every_point_gets_its_nearest_center(spark):  # M7, M6
    rnd = random.Random(11)
    pts = [(i, [rnd.uniform(-5, 5) for _ in range(4)], i % 3) for i in range(60)]
    df = spark.createDataFrame(pts, "vec_id long, embedding array<double>, label int")
    centers = {r.cluster: r.center for r in mean_centers(df, "label", "embedding").collect()}
    for lab in range(3):
        mean = [sum(p[1][j] for p in pts if p[2] == lab) / 20 for j in range(4)]
        assert all(abs(a - b) < 1e-9 for a, b in zip(mean, centers[lab]))
    got = assign_clusters(df, mean_centers(df, "label", "embedding"), "embedding")
    total = 0.0
    for r in got.collect():
        d = {c: sum((a - b) ** 2 for a, b in zip(r.embedding, v)) for c, v in centers.items()}
        best = min(d, key=lambda c: (d[c], c))
        assert r.cluster == best and abs(r.distance2 - d[best]) < 1e-9
        total += d[best]
    assert abs(cluster_cost(got).first().cost - total) < 1e-6


def test_daily_cluster_sizes(spark):  # C2
    from datetime import date
    points = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "cameo long, cluster int")
    events = spark.createDataFrame([(1, date(2014, 9, 9)), (2, date(2014, 9, 9)), (3, date(2014, 9, 10))],
                                   "cameo long, day date")
    got = sorted(tuple(r) for r in daily_cluster_sizes(points, events).collect())
    assert got == [(date(2014, 9, 9), 0, 2), (date(2014, 9, 10), 1, 1)]


def test_null_and_short_vectors_get_no_cluster(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [9.0, 9.0], 1), (3, None, 0), (4, [1.0], 0)], "id long, v array<double>, label int")
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9.0, 9.0])], "cluster int, center array<double>")
    got = assign_clusters(df, centers, "v")
    assert sorted((r.id, r.cluster, r.distance2) for r in got.collect()) == [(1, 0, 0.0), (2, 1, 0.0), (3, None, None), (4, None, None)]
    assert tuple(cluster_cost(got).first()) == (0.0, 2)


def test_ties_and_many_blocks(spark, monkeypatch):
    from newsevents.operators import clusters
    monkeypatch.setattr(clusters, "BLOCK_CELLS", 4)      # two centers a block
    centers = spark.createDataFrame([(c, [float(c % 5), 0.0]) for c in range(9)], "cluster int, center array<double>")
    df = spark.createDataFrame([(i, [float(i % 5), 0.0]) for i in range(20)], "id long, v array<double>")
    assert all(r.cluster == r.id % 5 for r in assign_clusters(df, centers, "v").collect())


def test_more_than_a_million_center_cells(spark):
    centers = spark.range(2).selectExpr("cast(id as int) cluster", "transform(sequence(1, 600000), x -> double(id)) center")
    df = spark.range(2).selectExpr("id", "transform(sequence(1, 600000), x -> double(id)) v")
    assert all(r.cluster == r.id for r in assign_clusters(df, centers, "v").select("id", "cluster").collect())
