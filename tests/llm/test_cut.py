"""Checkpointed rows come in as many partitions as their bytes ask for, with the same results."""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from chunkloom.llm import common
from chunkloom.llm.components import components


@contextmanager
def dealt(spark, partitions):
    """Shuffles make so many partitions, however few their rows are."""
    conf = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_few_rows_come_in_few_partitions(spark, monkeypatch):
    rows = spark.range(1000).repartition(32, "id").withColumn("text", F.repeat(F.lit("x"), 100)).withColumn("tokens", F.array("id", "id"))
    few = common.cut(rows)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(few.collect()) == sorted(rows.collect())
    assert common.cut(rows, as_dealt=True).rdd.getNumPartitions() == 32
    assert common.cut(spark.range(0).repartition(32, "id")).isEmpty()
    monkeypatch.setattr(common, "PART_BYTES", 10_000)  # 140 bytes a row
    assert common.cut(rows).rdd.getNumPartitions() == 14
    monkeypatch.setattr(common, "PART_BYTES", 1_000)
    assert common.cut(rows).rdd.getNumPartitions() == 32


def test_components_take_few_tasks(spark):
    chain = spark.createDataFrame([(k + 1, k) for k in range(20)] + [(101, 100)], "a long, b long")
    group, sc = uuid.uuid4().hex, spark.sparkContext
    with dealt(spark, 24):
        sc.setJobGroup(group, "components")
        try:
            found = {r.node: r.component for r in components(chain).collect()}
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
    assert found == {**dict.fromkeys(range(21), 0), 100: 100, 101: 100}
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))
    assert tasks < 1_500  # 1,178; as many partitions as were dealt, and two questions for stars, took 2,296
