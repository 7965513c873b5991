import pytest
from pyspark.sql import functions as F

from modeforge import inflate
from modeforge.operators.generate import copies_for, replicate


@pytest.mark.parametrize("target, rows, copies", [(10, 3, 4), (9, 3, 3), (1, 3, 1), (0, 3, 1)])
def test_copies(target, rows, copies):
    assert copies_for(target, rows) == copies


def test_empty_input():
    with pytest.raises(ValueError):
        copies_for(10, 0)


@pytest.mark.parametrize("copies, partitions", [(1, None), (7, None), (7, 3), (1000, 16)])
def test_every_row_once_per_copy(spark, copies, partitions):
    df = replicate(spark.range(5), copies, partitions, rows=5)
    counts = df.groupBy("id").agg(
        F.count("copy").alias("n"), F.count_distinct("copy").alias("d"), F.max("copy").alias("m")
    )
    assert {tuple(r)[1:] for r in counts.collect()} == {(copies, copies, copies - 1)}


def test_one_row_spreads_over_the_partitions(spark):
    df = replicate(spark.range(1), 10_000, 8, rows=1)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * min(sizes)


def test_size_jitter_and_repeatability(spark, events):
    n = events.count()
    std = events.agg(F.stddev_samp("value")).first()[0]
    out = inflate(events, "value", 3 * n - 1, key="event_id", keep_key=True).checkpoint()
    assert out.count() == 3 * n
    moved = out.alias("o").join(events.alias("e"), "event_id").selectExpr(
        "o.value - e.value AS d", "copy"
    )
    assert moved.agg(F.max(F.abs("d"))).first()[0] <= 0.05 * std + 1e-9
    assert abs(moved.agg(F.avg("d")).first()[0]) < 0.005 * std
    per_copy = [r[1] for r in moved.groupBy("copy").agg(F.sum("d")).collect()]
    assert len(set(per_copy)) == 3
    again = inflate(events.repartition(6), "value", 3 * n - 1, key="event_id", keep_key=True)
    same = out.join(again.withColumnRenamed("value", "other"), ["event_id", "copy"])
    assert same.agg(F.max(F.abs(F.col("value") - F.col("other")))).first()[0] < 1e-9
    assert inflate(events, "value", 10).count() == n
