import pytest
from pyspark.sql import functions as F

from modeforge import MetricsLog, MixtureConfig, ModeEncoder, TableEncoder, TableSpec, encode_job, fit_mixture, generation_job
from modeforge.operators.generate import inflate
from modeforge.operators.metrics import measurement
from modeforge.operators import lookup, profile
from modeforge.sources import files, read_csv, read_parquet, read_sample, write_checked
from modeforge.sources.files import keep_fraction, take_sample
from modeforge.sources.scratch import scratch_path
from modeforge.streaming.encode import decode_table_stream, encode_stream, encode_table_stream, read_files_as_stream


def test_csv_types(spark, events):
    path = scratch_path(spark, "csv")
    events.write.option("header", True).csv(path)
    assert dict(read_csv(spark, path).dtypes)["value"] == "double"
    given = read_csv(spark, path, "event_id bigint, event_type string, value double")
    assert given.exceptAll(events).isEmpty() and given.count() == events.count()


def test_write_is_checked(spark, events):
    report = write_checked(events, scratch_path(spark, "out"))
    assert report.complete and report.rows == events.count() and report.rows_per_second > 0
    with pytest.raises(ValueError):
        write_checked(events, report.path, mode="append")


def test_samples(spark, small, events):
    path = f"{small}/events.parquet"
    a = read_sample(spark, path, 0.3, "event_id")
    assert a.exceptAll(read_sample(spark, path, 0.3, "event_id")).isEmpty()
    assert 0.2 < a.count() / events.count() < 0.4
    assert keep_fraction(events, 1.0, "event_id").count() == events.count()
    assert take_sample(events, 10, "event_id").count() == 10
    assert take_sample(events, 10**6, "event_id").count() == events.count()
    assert read_parquet(spark, path, partitions=3).rdd.getNumPartitions() == 3


def test_bucket_key(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1500, -999.5, 0, 999.9, 1000, -2000)], "x double")
    got = {r["bucket"]: r["rows"] for r in profile.bucket_counts(df, "x").collect()}
    assert got == {-1: 1, 0: 3, 1: 1, -2: 1}


def test_generation_job(spark, events):
    source = scratch_path(spark, "in")
    events.write.option("header", True).csv(source)
    result = generation_job(spark, source, scratch_path(spark, "out"), target=2500, column="value")
    n = events.count()
    assert result.written.rows == n * -(-2500 // n) and result.written.complete
    assert result.statistics.first()["count"] == result.written.rows


@pytest.mark.parametrize("lossless", [True, False])
def test_encode_job(spark, events, lossless):
    log = MetricsLog()
    result = encode_job(
        spark, events, scratch_path(spark, "out"), "value", key="event_id", lossless=lossless,
        config=MixtureConfig(max_iter=10), log=log,
    )
    assert result.written.complete
    assert result.validation.distribution_valid
    if lossless:
        assert result.validation.accuracy == 1.0 and result.validation.round_trip.damaged == 0
    assert result.validation.round_trip.rows == events.count()
    row = log.summary(spark).first()
    assert row["processing_time"] > 0 and row["throughput"] > 0


def test_metrics_log(spark):
    log = MetricsLog()
    assert log.summary(spark).first().asDict() == {
        "processing_time": 0.0, "accuracy": 0.0, "throughput": 0.0,
    }
    for accuracy in (1.0, 0.5):
        log.add(measurement(100, 2.0, accuracy))
    assert log.summary(spark).first().asDict() == {
        "processing_time": 2.0, "accuracy": 0.75, "throughput": 50.0,
    }
    assert log.table(spark).count() == 2


@pytest.mark.parametrize("lossless", [True, False])
def test_jobs_take_values_that_are_not_finite(spark, lossless):
    rows = [(i, float(i % 50)) for i in range(500)]
    rows += [(500, float("nan")), (501, float("inf")), (502, -float("inf")), (503, None)]
    df = spark.createDataFrame(rows, "id long, x double")
    result = encode_job(
        spark, df, scratch_path(spark, "out"), "x", key="id", lossless=lossless,
        config=MixtureConfig(max_iter=5),
    )
    trip = result.validation.round_trip
    assert trip.rows == 504 and trip.not_finite == 3 and trip.finite[0] == 500
    if lossless:
        assert trip.damaged == 0 and result.validation.accuracy == 1.0
    made = inflate(df, "x", 1000, key="id", keep_key=True)
    assert made.where("isnan(x)").count() == 2 and made.where("x = double('Infinity')").count() == 2


def test_stream_equals_batch(spark, events):
    folder = scratch_path(spark, "files")
    events.repartition(4).write.parquet(folder)
    encoder = ModeEncoder(
        "value", fit_mixture(events, "value", MixtureConfig(max_iter=3, n_components=4))
    )
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")

    def run():
        stream = read_files_as_stream(spark, folder, events.schema)
        encode_stream(stream, encoder, out, state, "event_id").awaitTermination()
        return spark.read.parquet(out)

    assert run().exceptAll(encoder.encode(events, "event_id")).isEmpty()
    assert run().count() == events.count()
    late = events.selectExpr("event_id + 1000000 AS event_id", "event_type", "value")
    late.write.mode("append").parquet(folder)
    assert run().count() == 2 * events.count()


def test_contents_are_checked(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else i * 0.5, {"a": i} if i % 2 else None, [i, None], "x" if i % 3 else None) for i in range(200)]
    schema = "k bigint, v double, m map<string, int>, a array<bigint>, s string"
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "out")
    report = write_checked(df.repartition(4), path, contents=True)
    assert report.complete and report.checksum is not None and report.checksum == files.contents_of(spark, path)[1]
    # One other value, a value moved to another column, a row less, and nothing changed.
    for k, changed in enumerate([
        df.withColumn("v", F.expr("CASE WHEN k = 7 THEN v + 1e-9 ELSE v END")),
        df.withColumn("s", F.expr("CASE WHEN k = 3 THEN 'x' ELSE s END")),
        df.withColumn("v", F.expr("CASE WHEN k = 9 THEN NULL ELSE v END")),
        df.where("k <> 11"),
        df.orderBy(F.desc("k")),
    ]):
        other = str(tmp_path / f"changed-{k}")
        changed.write.parquet(other)
        assert (files.contents_of(spark, other)[1] == report.checksum) == (k == 4)
    assert write_checked(df.limit(0), str(tmp_path / "none"), contents=True).complete
    assert not files.WriteReport("x", 3, 3, 1.0, 5, 6).complete


def test_parts_dealt_anew_grow_in_number(spark, tmp_path):
    """Not in length: the checksum of a table in another order took seven parts of any table."""
    path = str(tmp_path / "many")
    spark.range(1000).selectExpr("id AS `a key`", "id % 7 AS v").repartition(12).write.parquet(path)
    held = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in held:
            spark.conf.set(name, "1k")
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= 12
        dealt = files.dealt_anew(df, "a key")
        assert dealt.rdd.getNumPartitions() == files.PARTS_FOR_ONE * df.rdd.getNumPartitions()
        assert dealt.agg(files.checksum(df)).first() == df.agg(files.checksum(df)).first()
        largest = dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert largest < 1000 / 7 / 2
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    assert files.dealt_anew(df.coalesce(1), ["a key"]).rdd.getNumPartitions() == files.FEWEST_PARTS


def test_jobs_check_contents(spark, events):
    result = encode_job(
        spark, events, scratch_path(spark, "out"), "value", key="event_id", lossless=True, contents=True,
        config=MixtureConfig(max_iter=3),
    )
    assert result.written.complete and result.written.checksum == result.written.checksum_read_back is not None
    assert result.validation.round_trip.inexact == 0


def test_table_stream_equals_batch(spark, small, monkeypatch):
    """With dictionaries that are broadcast, and with ones that are joined by shuffle."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    spec = TableSpec(
        categorical=["l_shipdate", "l_returnflag", "l_suppkey"], indexed=["l_shipdate"], sparse=["l_suppkey"],
        columns=["l_quantity", "l_shipdate", "l_suppkey", "l_returnflag"],
    )
    encoder = TableEncoder(spec, MixtureConfig(max_iter=3, n_components=3)).fit(lines)
    key = ["l_orderkey", "l_linenumber"]
    batch = encoder.transform(lines, key, keep=key, lossless=True)
    for budget in (lookup.BROADCAST_BYTES, 0):
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", budget)
        monkeypatch.setattr(lookup, "HOT", 5)
        stream = read_files_as_stream(spark, small, lines.schema, "lineitem.parquet")
        coded, back = scratch_path(spark, "coded"), scratch_path(spark, "back")
        encode_table_stream(stream, encoder, coded, scratch_path(spark, "state"), key, keep=key, lossless=True).awaitTermination()
        written = read_parquet(spark, coded)
        assert written.exceptAll(batch).isEmpty() and batch.exceptAll(written).isEmpty()
        again = read_files_as_stream(spark, coded, written.schema)
        decode_table_stream(again, encoder, back, scratch_path(spark, "state"), keep=key).awaitTermination()
        expected = lines.select(*key, *spec.columns)
        assert read_parquet(spark, back).exceptAll(expected).isEmpty() and read_parquet(spark, back).count() == lines.count()


def test_stream_hashes_large_dictionaries(spark, tmp_path, monkeypatch):
    """Rows of a stream pass the parts of a large dictionary, which the planner would broadcast in several copies."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "HOT", 1)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(60).selectExpr("id", "concat('c', id % 20) AS c").write.parquet(folder)
    df = spark.read.parquet(folder)
    encoder = TableEncoder(TableSpec(categorical=["c"], columns=["c"], indexed=["c"])).fit(df)
    stream = read_files_as_stream(spark, folder, df.schema)
    run = encode_table_stream(stream, encoder, out, scratch_path(spark, "state"), keep=["id"])
    run.awaitTermination()
    plan = run._jsq.explainInternal(False).split("Initial Plan")[-1]
    assert plan.count("ShuffledHashJoin") == 1 and "SortMergeJoin" not in plan
    assert spark.read.parquet(out).exceptAll(encoder.transform(df, keep=["id"])).isEmpty()
