import os
import uuid

import pytest

from newsevents.operators.entities import entity_top_n
from newsevents.session import delete_scratch, publish_once, shared_dir, shared_root


def test_publish_once_writes_a_single_time(spark):
    calls = []

    def write(tmp):
        calls.append(tmp)
        spark.range(3).write.parquet(tmp)

    path = os.path.join(shared_root(spark), "published-test")
    first = publish_once(spark, path, write)
    assert publish_once(spark, path, write) == first
    assert len(calls) == 1 and spark.read.parquet(first).count() == 3


def test_publish_once_passes_over_incomplete_versions(spark):
    path = os.path.join(shared_root(spark), f"published-{uuid.uuid4().hex}")
    spark.range(1).write.parquet(path + "/v-000000000000")        # a writer that crashed before its _SUCCESS
    os.remove(path + "/v-000000000000/_SUCCESS")
    got = publish_once(spark, path, lambda tmp: spark.range(5).write.parquet(tmp))
    assert spark.read.parquet(got).count() == 5


def test_publish_once_with_two_writers(spark):
    path = os.path.join(shared_root(spark), f"published-{uuid.uuid4().hex}")

    def slow(tmp):      # the other writer finishes while this one is at work
        publish_once(spark, path, lambda t: spark.range(5).write.parquet(t))
        spark.range(5).write.parquet(tmp)

    got = publish_once(spark, path, slow)
    assert spark.read.parquet(got).count() == 5 and publish_once(spark, path, slow) == got


def test_rewritten_folder_has_another_stamp_and_schema(spark):
    from newsevents.sources.fixtures import _stamp
    from newsevents.sources.tables import table
    sf = os.path.join(shared_root(spark), f"tables-{uuid.uuid4().hex}")
    spark.range(3).write.parquet(sf + "/nation.parquet")
    before = _stamp(spark, sf, ["nation"])
    assert before == _stamp(spark, sf, ["nation"]) and table(spark, sf, "nation").columns == ["id"]
    spark.range(3).selectExpr("id as other").write.mode("overwrite").parquet(sf + "/nation.parquet")
    assert _stamp(spark, sf, ["nation"]) != before and table(spark, sf, "nation").columns == ["other"]


def test_shared_folder_must_be_set_off_a_local_master():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_scratch_is_deleted(spark):
    made = [shared_dir(spark, "scratch-test")]
    spark.range(2).write.parquet(made[0])
    path, keep = made[0], spark.sparkContext._newsevents_scratch
    spark.sparkContext._newsevents_scratch = made
    delete_scratch(spark)
    spark.sparkContext._newsevents_scratch = keep
    assert not os.path.exists(path)


@pytest.mark.parametrize("n", [5, 999, 1000, 5000])
def test_top_n_never_gathers_a_kind(spark, n):
    rows = [(k, f"{k}{i}", i % 977) for k in ("theme", "person") for i in range(1500)]
    counts = spark.createDataFrame(rows, "kind string, entity string, n bigint")
    top = entity_top_n(counts, n)
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    whole = [x for x in plan.splitlines() if "Window " in x and "kind" in x and "row_number" in x]
    physical = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in physical if n < 1000 else not whole
    want = sorted((k, r, e, c) for k in ("theme", "person")
                  for r, (c, e) in enumerate(sorted(((c, e) for kk, e, c in rows if kk == k), key=lambda x: (-x[0], x[1])), 1) if r <= n)
    assert sorted(tuple(r) for r in top.collect()) == want


def test_top_n_plan_limits_before_the_shuffle(spark):
    counts = spark.createDataFrame([("theme", f"t{i}", i) for i in range(100)], "kind string, entity string, n bigint")
    top = entity_top_n(counts, 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [r.entity for r in top.orderBy("rank").collect()] == ["t99", "t98", "t97", "t96", "t95"]


def test_spread_follows_its_argument(spark):
    from newsevents.operators.dataflow import spread
    many = spark.range(100).repartition(8)
    assert spread(many) is many
    assert spread(many, 4).rdd.getNumPartitions() == 4 and spread(spark.range(100).coalesce(1), 4).rdd.getNumPartitions() == 4
