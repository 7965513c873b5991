"""One named query per operator, over whole tables.

Every query takes a session and the folder of the tables.  Results are rounded
so that they can be compared across engines; draws use the portable hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeforge.config import MISSING_MARKER, MixtureConfig, TableSpec
from modeforge.functions.text import number
from modeforge.functions.uniform import key_columns
from modeforge.operators import generate, profile, score, validate
from modeforge.operators.codec import ModeEncoder
from modeforge.operators.fit import fit_mixture, fit_mixtures
from modeforge.operators.ks import KsResult, ks_columns, ks_two_sample
from modeforge.operators.metrics import average_metrics
from modeforge.operators.model import Mixture, parameters
from modeforge.operators.table import (
    CATEGORICAL,
    CONTINUOUS,
    MIXED,
    ColumnCode,
    TableEncoder,
    modal_norms,
)
from modeforge.plans import samples
from modeforge.plans.jobs import encode_job, generation_job
from modeforge.sources import files
from modeforge.sources.scratch import scratch_path
from modeforge.streaming.encode import (
    decode_table_stream,
    encode_stream,
    encode_table_stream,
    read_files_as_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MIXED_POINTS = (0.01, MISSING_MARKER)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return files.read_parquet(spark, f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a number of digits; negative zero becomes zero."""
    doubles = {f.name for f in df.schema.fields if f.dataType.simpleString() == "double"}
    return df.select(
        *(
            (F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if c in doubles else F.col(c)
            for c in df.columns
        )
    )


def flattened(df: DataFrame, array: str, width: int, prefix: str = "mode") -> DataFrame:
    """An array column as ``width`` plain columns."""
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, *(F.col(array)[i].alias(f"{prefix}_{i}") for i in range(width)))


def event_encoder() -> ModeEncoder:
    return ModeEncoder("value", samples.EVENT_VALUE)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "value")


# ------------------------------------------------------- sources and sinks


@query
def csv_scan(spark, folder):
    path = scratch_path(spark, "csv")
    source = table(spark, folder, "events").select("event_id", "event_type", "value")
    source.write.option("header", True).csv(path)
    return files.read_csv(spark, path, "event_id bigint, event_type string, value double")


@query
def csv_scan_inferred(spark, folder):
    path = scratch_path(spark, "csv")
    source = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    source.write.option("header", True).csv(path)
    return files.read_csv(spark, path).selectExpr(
        "CAST(c_custkey AS BIGINT) AS c_custkey", "c_mktsegment", "c_acctbal"
    )


@query
def parquet_scan(spark, folder):
    df = files.read_parquet(spark, f"{folder}/orders.parquet", partitions=8)
    return df.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query
def sampled_scan(spark, folder):
    df = files.read_sample(spark, f"{folder}/orders.parquet", 0.1, "o_orderkey", portable=True)
    return df.select("o_orderkey", "o_totalprice")


@query
def parquet_sink(spark, folder):
    path = scratch_path(spark, "sink")
    files.write_parquet(table(spark, folder, "lineitem").select(*LINE_KEY, "l_extendedprice"), path)
    return files.read_parquet(spark, path)


@query
def checked_write(spark, folder):
    report = files.write_checked(table(spark, folder, "lineitem"), scratch_path(spark, "checked"))
    return spark.createDataFrame(
        [(report.rows, report.rows_read_back, report.complete)],
        "rows bigint, rows_read_back bigint, complete boolean",
    )


@query
def checked_write_contents(spark, folder):
    """A write whose contents are compared, and the same folder against a table with one changed value."""
    df = table(spark, folder, "lineitem")
    path = scratch_path(spark, "checked-contents")
    report = files.write_checked(df, path, contents=True)
    first = df.agg(F.min(F.struct(*LINE_KEY))).first()[0]
    same_row = F.expr(" AND ".join(f"{c} = {v}" for c, v in zip(LINE_KEY, first)))
    changed = df.withColumn("l_tax", F.when(same_row, F.col("l_tax") + 1e-9).otherwise(F.col("l_tax")))
    rows, found = files.contents_of(spark, path)
    other = changed.agg(files.checksum(changed)).first()[0]
    shuffled = files.dealt_anew(df, LINE_KEY).agg(files.checksum(df)).first()[0]
    return spark.createDataFrame(
        [(report.rows, rows, report.complete, report.checksum == found, int(shuffled) == found, int(other) == found)],
        "rows bigint, rows_read_back bigint, complete boolean, same boolean, same_in_other_order boolean, same_when_changed boolean",
    )


# ------------------------------------- projections, filters, partitioning


@query
def column_projection(spark, folder):
    return table(spark, folder, "lineitem").select("l_extendedprice")


@query
def computed_projection(spark, folder):
    df = table(spark, folder, "lineitem")
    stddev = profile.mean_stddev(df, "l_extendedprice").first()["stddev"]
    value = generate.jittered(
        "l_extendedprice", stddev, key=key_columns(LINE_KEY), portable=True
    )
    return rounded(df.selectExpr(*LINE_KEY, f"{value} AS l_extendedprice"), 4)


@query
def modal_filter(spark, folder):
    df = table(spark, folder, "lineitem").withColumn("modal", F.col("l_discount").isin(0.0, 0.1))
    return rounded(
        df.groupBy("modal").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("l_discount").alias("low"),
            F.max("l_discount").alias("high"),
        )
    )


@query
def round_robin_partitions(spark, folder):
    df = files.read_parquet(spark, f"{folder}/lineitem.parquet", partitions=16)
    per_partition = df.groupBy(F.spark_partition_id().alias("part")).count()
    return per_partition.agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("count").alias("rows")
    )


@query
def held_histogram(spark, folder):
    """Counted and written while the rows are held; what is returned was computed once."""
    counts = table(spark, folder, "lineitem").groupBy("l_extendedprice").count().persist()
    path = scratch_path(spark, "histogram")
    try:
        cells = counts.count()
        files.write_parquet(counts, path)
    finally:
        counts.unpersist()
    return files.read_parquet(spark, path).withColumn("cells", F.lit(cells).cast("bigint"))


# ------------------------------------ limits, samples, sets and groupings


@query
def sample_of_exact_size(spark, folder):
    return files.take_sample(events(spark, folder), 1000, "event_id", portable=True)


@query
def row_capped_sample(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    rows = df.count()
    return files.keep_fraction(df, min(5000, rows) / rows, "o_orderkey", portable=True)


@query
def union_of_copies(spark, folder):
    return generate.replicate(events(spark, folder), 3)


@query
def distinct_categories(spark, folder):
    return profile.distinct_values(table(spark, folder, "orders"), "o_orderpriority")


@query
def bucketed_group_key(spark, folder):
    return profile.bucket_counts(table(spark, folder, "customer"), "c_acctbal")


# --------------------------------------------- aggregations and profiling


@query
def row_count(spark, folder):
    return profile.row_count(table(spark, folder, "lineitem"))


@query
def describe(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(profile.describe_columns(table(spark, folder, "lineitem"), columns), 4)


@query
def mean_and_stddev(spark, folder):
    return rounded(profile.mean_stddev(table(spark, folder, "lineitem"), "l_extendedprice"), 4)


@query
def column_min_max(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return profile.min_max(table(spark, folder, "lineitem"), columns)


@query
def ranked_categories(spark, folder):
    df = table(spark, folder, "orders")
    return profile.ranked_categories(df, ["o_orderstatus", "o_orderpriority"])


@query
def indexed_categories(spark, folder):
    return profile.indexed_categories(table(spark, folder, "lineitem"), "l_partkey")


@query
def column_moments(spark, folder):
    return rounded(profile.moments(table(spark, folder, "events"), "value"), 4)


@query
def sufficient_statistics(spark, folder):
    df = score.sufficient_statistics(events(spark, folder), "value", samples.EVENT_VALUE)
    return rounded(df, 3)


@query
def mode_frequency(spark, folder):
    coded = event_encoder().encode(
        events(spark, folder), "event_id", with_mode=True, portable=True
    )
    return profile.mode_frequency(coded, "mode")


@query
def averaged_metrics(spark, folder):
    df = table(spark, folder, "lineitem")
    full = average_metrics(df, ["l_quantity", "l_tax"])
    empty = average_metrics(df.where("l_quantity < 0"), ["l_quantity", "l_tax"])
    return rounded(full.withColumn("runs", F.lit("all")).unionAll(
        empty.withColumn("runs", F.lit("none"))))


# --------------------------------------------------------- mixture model


def _fitted(spark: SparkSession, fits: dict[str, Mixture], digits: int) -> DataFrame:
    df = parameters(spark, fits).select(
        "column", "k", "weight", "mean", "variance", "active", "frequency", "rank"
    )
    return rounded(df, digits)


@query
def mixture_fit_three_steps(spark, folder):
    cfg = MixtureConfig(max_iter=3)
    return _fitted(spark, {"value": fit_mixture(events(spark, folder), "value", cfg)}, 4)


@query
def mixture_fit(spark, folder):
    return _fitted(spark, {"value": fit_mixture(events(spark, folder), "value")}, 3)


@query
def mixture_fit_large(spark, folder):
    """A column with about as many values as rows, all iterations."""
    df = table(spark, folder, "lineitem").select("l_extendedprice")
    fits = _fitted(spark, {"price": fit_mixture(df, "l_extendedprice")}, 9)
    digits = {"weight": 6, "mean": 2, "variance": 0}
    return fits.drop("frequency").withColumns({c: F.round(c, d) for c, d in digits.items()})


@query
def active_components(spark, folder):
    df = score.active_components(
        events(spark, folder), "value", samples.EVENT_VALUE, MixtureConfig().eps
    )
    return rounded(df)


@query
def component_responsibilities(spark, folder):
    return rounded(score.responsibilities(events(spark, folder), "value", samples.EVENT_VALUE))


@query
def hard_assignment(spark, folder):
    return score.hard_assignment(events(spark, folder), "value", samples.EVENT_VALUE)


@query
def smoothed_probabilities(spark, folder):
    return rounded(
        score.smoothed_probabilities(events(spark, folder), "value", samples.EVENT_VALUE)
    )


@query
def mode_draw(spark, folder):
    coded = event_encoder().encode(
        events(spark, folder), "event_id", with_mode=True, portable=True
    )
    return coded.select("event_id", "mode")


@query
def mode_normalised_value(spark, folder):
    coded = event_encoder().encode(events(spark, folder), "event_id", portable=True)
    return rounded(coded.select("event_id", "normalized_value"))


@query
def mode_one_hot(spark, folder):
    coded = event_encoder().encode(events(spark, folder), "event_id", portable=True)
    return flattened(coded.select("event_id", "mode_encoding"), "mode_encoding", 3)


@query
def encode_column(spark, folder):
    coded = event_encoder().encode(events(spark, folder), "event_id", portable=True)
    return rounded(flattened(coded, "mode_encoding", 3))


@query
def decode_column(spark, folder):
    encoder = event_encoder()
    coded = encoder.encode(events(spark, folder), "event_id", portable=True)
    return rounded(
        encoder.decode(coded, "decoded", keep_input=True).select("event_id", "value", "decoded")
    )


@query
def encode_lossless(spark, folder):
    encoder = event_encoder()
    coded = encoder.encode(events(spark, folder), "event_id", lossless=True, portable=True)
    both = encoder.decode(coded, "decoded", keep_input=True)
    return rounded(both.select("event_id", "normalized_value", "overflow", "decoded"))


@query
def encode_lossless_wide_range(spark, folder):
    """Values from 0.01 to beyond 1e15 in one column, fitted and taken there and back to the last bit."""
    df = table(spark, folder, "events").selectExpr(
        "event_id", "CASE event_id % 3 WHEN 0 THEN value * 1e13D WHEN 1 THEN -value ELSE value / 10 END AS value"
    )
    encoder = ModeEncoder("value", fit_mixture(df, "value"))
    coded = encoder.encode(df, "event_id", lossless=True)
    return encoder.decode(coded, "decoded", keep_input=True).selectExpr(
        "event_id", "value", "decoded", "decoded = value AS same", "overflow IS NULL OR overflow = value AS raw_kept"
    )


@query
def encode_ranked(spark, folder):
    coded = event_encoder().encode(
        events(spark, folder), "event_id", ranked=True, with_mode=True, portable=True
    )
    return rounded(flattened(coded, "mode_encoding", 3, "ranked").drop("value"))


@query
def decode_ranked(spark, folder):
    encoder = event_encoder()
    coded = encoder.encode(events(spark, folder), "event_id", ranked=True, portable=True)
    both = encoder.decode(coded, "decoded", ranked=True, keep_input=True)
    return rounded(both.select("event_id", "decoded"))


# --------------------------------------------------------- table encoder


def mixed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event values with point masses at 0.01 and, for errors, at the marker."""
    value = f"CASE WHEN event_type = 'error' THEN {number(MISSING_MARKER)} ELSE value END"
    return table(spark, folder, "events").selectExpr("event_id", "event_type", f"{value} AS v")


def _minmax_spec() -> TableSpec:
    return TableSpec(
        categorical=["l_returnflag", "l_linestatus"],
        mixed={"l_discount": [0.0, 0.1]},
        columns=["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"],
        continuous="minmax",
    )


def _given_codes(df: DataFrame) -> TableEncoder:
    """Given mixtures and modal values, categories ranked from the table."""
    ranked = profile.ranked_categories(df, ["l_returnflag", "l_linestatus"])
    values: dict[str, list[str]] = {}
    for row in ranked.orderBy("column", "idx").collect():
        values.setdefault(row["column"], []).append(row["value"])
    cfg = MixtureConfig()
    points = (0.0,)
    price = samples.EXTENDED_PRICE
    codes = [
        ColumnCode("l_extendedprice", CONTINUOUS, "double", mixture=price, order=price.order),
        ColumnCode(
            "l_discount", MIXED, "double", mixture=samples.DISCOUNT, points=points,
            point_norms=modal_norms(points, samples.DISCOUNT_WHOLE, cfg, MISSING_MARKER),
            order=(2, 1, 0),
        ),
        *(
            ColumnCode(c, CATEGORICAL, "string", values=tuple(v), size=len(v))
            for c, v in sorted(values.items())
        ),
    ]
    return TableEncoder.from_codes(codes, config=cfg)


def _mixed_encoder() -> TableEncoder:
    """Given mixture for the event values without their point masses."""
    m = samples.EVENT_VALUE
    code = ColumnCode(
        "v", MIXED, "double", mixture=m, points=MIXED_POINTS,
        point_norms=modal_norms(MIXED_POINTS, m, MixtureConfig(), MISSING_MARKER),
        order=(3, 1, 2, 4, 0),
    )
    return TableEncoder.from_codes([code])


@query
def table_metadata(spark, folder):
    encoder = TableEncoder(_minmax_spec()).fit(table(spark, folder, "lineitem"))
    return encoder.metadata(spark).selectExpr(
        "column",
        "kind",
        "min",
        "max",
        "CAST(size AS BIGINT) AS size",
        "array_join(transform(modal_values, v -> CAST(v AS STRING)), ',') AS modal",
        "array_join(categories, ',') AS categories",
    )


@query
def table_layout(spark, folder):
    encoder = TableEncoder(_minmax_spec()).fit(table(spark, folder, "lineitem"))
    return encoder.layout(spark).selectExpr(
        "column", "CAST(start AS BIGINT) AS start", "CAST(width AS BIGINT) AS width", "activation"
    )


@query
def min_max_normalised(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    encoder = TableEncoder(TableSpec(columns=["o_totalprice"], continuous="minmax")).fit(df)
    coded = encoder.transform(df, keep=["o_orderkey"])
    return rounded(coded.withColumnRenamed("col_0", "scaled"))


@query
def category_sizes(spark, folder):
    df = table(spark, folder, "events")
    encoder = TableEncoder(
        TableSpec(categorical=["event_type"], columns=["event_type"])
    ).fit(df)
    return encoder.metadata(spark).selectExpr("column", "CAST(size AS BIGINT) AS size")


@query
def category_one_hot(spark, folder):
    df = table(spark, folder, "orders")
    spec = TableSpec(categorical=["o_orderpriority"], columns=["o_orderpriority"])
    return TableEncoder(spec).fit(df).transform(df, keep=["o_orderkey", "o_orderpriority"])


@query
def category_one_hot_wide(spark, folder):
    """As many one-hot columns as parts, beyond the widest block of columns as a sparse vector; the place of
    the 1 and the sum of each row."""
    df = table(spark, folder, "lineitem")
    encoder = TableEncoder(TableSpec(categorical=["l_suppkey"], columns=["l_suppkey"], wide="sparse")).fit(df)
    (code,) = encoder.codes
    if code.sparse:
        block = "sparse_l_suppkey.values"
        place = f"sparse_l_suppkey.indices[array_position({block}, 1.0D) - 1]"
    else:
        block = f"array({', '.join(f'col_{i}' for i in range(code.width))})"
        place = f"array_position({block}, 1.0D) - 1"
    return encoder.transform(df, keep=LINE_KEY).selectExpr(
        *LINE_KEY,
        f"CAST({code.size} AS BIGINT) AS width",
        f"CAST({place} AS BIGINT) AS place",
        f"aggregate({block}, 0.0D, (s, x) -> s + x) AS ones",
    )


@query
def category_codes_sparse(spark, folder):
    """Codes that neither start at 0 nor follow each other."""
    df = table(spark, folder, "customer").selectExpr("c_custkey", "3 * c_nationkey + 2 AS code")
    spec = TableSpec(
        categorical=["code"], columns=["code"], continuous="minmax", categories="codes"
    )
    encoder = TableEncoder(spec).fit(df)
    coded = encoder.transform(df, keep=["c_custkey"])
    keep = ["c_custkey", *(f"col_{i}" for i in (0, 2, 3, 5, 74))]
    return encoder.inverse_transform(coded, keep=keep).withColumn(
        "width", F.lit(encoder.output_dimensions).cast("bigint")
    )


@query
def category_indexed_large(spark, folder):
    """Order keys of the lines by their rank among all order keys and back, with text keys that make
    the dictionary longer than what is broadcast whole."""
    df = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "concat(repeat('order ', 800), o_orderkey) AS name"
    )
    spec = TableSpec(categorical=["name"], columns=["name"], indexed=["name"])
    encoder = TableEncoder(spec).fit(df)
    coded = encoder.transform(df, keep=["o_orderkey"])
    back = encoder.inverse_transform(coded, keep=["o_orderkey", "col_0"])
    return back.selectExpr("o_orderkey", "col_0", "substring_index(name, ' ', -1) AS name")


@query
def category_sparse(spark, folder):
    """As many categories as orders, as sparse one-hot vectors, and decoded again."""
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    spec = TableSpec(
        categorical=["o_orderkey", "o_orderstatus"], columns=["o_orderkey", "o_orderstatus"], sparse=["o_orderkey"]
    )
    encoder = TableEncoder(spec).fit(df)
    coded = encoder.transform(df)
    kept = ["sparse_o_orderkey", *(f"col_{i}" for i in range(encoder.output_dimensions))]
    return encoder.inverse_transform(coded, keep=kept).selectExpr(
        "o_orderkey", "o_orderstatus", "sparse_o_orderkey.size AS width", "sparse_o_orderkey.indices[0] AS place",
        "size(sparse_o_orderkey.values) AS entries", "sparse_o_orderkey.values[0] AS value", *kept[1:],
    )


@query
def category_one_hot_table(spark, folder):
    """A one-hot block of columns for more categories than are written into the plan, and its metadata."""
    df = table(spark, folder, "lineitem").selectExpr(*LINE_KEY, "CAST(l_shipdate AS DATE) AS day").selectExpr(
        *LINE_KEY, "concat(year(day), '-', month(day)) AS month"
    )
    encoder = TableEncoder(TableSpec(categorical=["month"], columns=["month"])).fit(df)
    width = encoder.output_dimensions
    block = f"array({', '.join(f'col_{i}' for i in range(width))})"
    listed = encoder.metadata(spark).selectExpr("posexplode(categories) AS (idx, category)")
    coded = encoder.transform(df, keep=LINE_KEY)
    kept = coded.selectExpr("*", f"array_position({block}, 1.0D) - 1 AS place", f"aggregate({block}, 0.0D, (s, x) -> s + x) AS ones")
    back = encoder.inverse_transform(kept, keep=[*LINE_KEY, "place", "ones"])
    return back.join(listed, F.col("place") == F.col("idx")).drop("idx").withColumn("width", F.lit(width).cast("bigint"))


@query
def category_codes_one_hot(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    spec = TableSpec(
        categorical=["c_nationkey"], columns=["c_nationkey"], continuous="minmax",
        categories="codes",
    )
    return TableEncoder(spec).fit(df).transform(df, keep=["c_custkey"])


@query
def category_indexed(spark, folder):
    df = table(spark, folder, "lineitem")
    spec = TableSpec(categorical=["l_partkey"], columns=["l_partkey"], indexed=["l_partkey"])
    encoder = TableEncoder(spec).fit(df)
    coded = encoder.transform(df, keep=["l_orderkey", "l_linenumber"])
    return encoder.inverse_transform(coded, keep=["l_orderkey", "l_linenumber", "col_0"])


@query
def category_decode(spark, folder):
    df = table(spark, folder, "customer")
    spec = TableSpec(
        categorical=["c_mktsegment", "c_nationkey"], columns=["c_mktsegment", "c_nationkey"]
    )
    encoder = TableEncoder(spec).fit(df)
    return encoder.inverse_transform(encoder.transform(df, keep=["c_custkey"]), ["c_custkey"])


@query
def mixed_fit(spark, folder):
    df = table(spark, folder, "lineitem")
    apart = "CASE WHEN l_discount IN (0.0D) THEN NULL ELSE l_discount END"
    fits = fit_mixtures(df, {"all": "l_discount", "apart": apart}, MixtureConfig(n_components=4))
    return _fitted(spark, fits, 5).drop("active", "frequency", "rank")


@query
def modal_normalised_values(spark, folder):
    """Where the modal values fall within the mixture over all discounts, with
    the rows that hold them."""
    points = (0.0, 0.05, 0.1, MISSING_MARKER)
    cfg = MixtureConfig(n_components=4)
    whole = fit_mixture(table(spark, folder, "lineitem"), "l_discount", cfg)
    norms = modal_norms(points, whole, cfg, MISSING_MARKER)
    counted = table(spark, folder, "lineitem").selectExpr(
        *(f"count_if(l_discount = {number(v)}) AS n{i}" for i, v in enumerate(points))
    )
    hits = ", ".join(
        f"{number(v)}, {number(n)}, n{i}" for i, (v, n) in enumerate(zip(points, norms))
    )
    return rounded(counted.selectExpr(f"stack({len(points)}, {hits}) AS (point, norm, rows)"), 5)


@query
def mixed_encode(spark, folder):
    df = mixed_events(spark, folder)
    return rounded(
        _mixed_encoder().transform(df, "event_id", keep=["event_id"], portable=True)
    )


@query
def mixed_decode(spark, folder):
    encoder = _mixed_encoder()
    coded = encoder.transform(
        mixed_events(spark, folder), "event_id", keep=["event_id"], portable=True
    )
    return rounded(encoder.inverse_transform(coded, keep=["event_id"]))


@query
def mixed_min_max(spark, folder):
    df = table(spark, folder, "lineitem")
    spec = TableSpec(
        mixed={"l_discount": [0.0, 0.1]}, columns=["l_discount"], continuous="minmax"
    )
    return rounded(TableEncoder(spec).fit(df).transform(df, keep=LINE_KEY))


@query
def table_encode(spark, folder):
    df = table(spark, folder, "lineitem")
    return rounded(_given_codes(df).transform(df, LINE_KEY, keep=LINE_KEY, portable=True))


@query
def table_decode(spark, folder):
    df = table(spark, folder, "lineitem")
    encoder = _given_codes(df)
    coded = encoder.transform(df, LINE_KEY, keep=LINE_KEY, portable=True)
    return rounded(encoder.inverse_transform(coded, keep=LINE_KEY), 4)


@query
def table_encode_min_max(spark, folder):
    df = table(spark, folder, "lineitem")
    return rounded(TableEncoder(_minmax_spec()).fit(df).transform(df, keep=LINE_KEY))


@query
def table_round_trip(spark, folder):
    """Fit everything from the table, encode without loss, decode, compare."""
    df = table(spark, folder, "lineitem")
    spec = TableSpec(
        categorical=["l_returnflag"], mixed={"l_discount": [0.0]},
        columns=["l_extendedprice", "l_discount", "l_returnflag"],
    )
    encoder = TableEncoder(spec).fit(df)
    coded = encoder.transform(df, LINE_KEY, keep=LINE_KEY, lossless=True)
    return rounded(encoder.inverse_transform(coded, keep=LINE_KEY))


@query
def table_fit_encode(spark, folder):
    """The fitted parameters of a table in mixture mode, with the order of the one-hot positions."""
    df = table(spark, folder, "lineitem")
    spec = TableSpec(mixed={"l_discount": [0.0]}, columns=["l_discount"])
    encoder = TableEncoder(spec, MixtureConfig(n_components=4)).fit(df)
    (code,) = encoder.codes
    places = {position: place for place, position in enumerate(code.order)}
    point = spark.createDataFrame(
        [(-1, None, None, code.point_norms[0], places[0])],
        "k int, mean double, variance double, norm double, place int",
    )
    m = code.mixture
    modes = [
        (k, m.means[k], m.variances[k], None, places[1 + i]) for i, k in enumerate(m.kept)
    ]
    return rounded(point.unionAll(spark.createDataFrame(modes, point.schema)), 5)


@query
def table_lossless_min_max(spark, folder):
    """Fit on the lines of little quantity, then a trip of all lines: most are out of range."""
    df = table(spark, folder, "lineitem").selectExpr(
        *LINE_KEY, "l_quantity", "CAST(l_extendedprice * 100 AS BIGINT) * 1000003 * 10007 AS big"
    )
    spec = TableSpec(columns=["l_quantity", "big"], continuous="minmax")
    encoder = TableEncoder(spec).fit(df.where("l_quantity <= 10"))
    coded = encoder.transform(df, keep=LINE_KEY, lossless=True)
    return rounded(encoder.inverse_transform(coded, keep=[*LINE_KEY, "overflow_l_quantity"]))


@query
def table_saved(spark, folder):
    """An encoder that was written and read again encodes as the fitted one."""
    df = table(spark, folder, "lineitem")
    path = scratch_path(spark, "table-encoder")
    TableEncoder(_minmax_spec()).fit(df).save(spark, path)
    return rounded(TableEncoder.load(spark, path).transform(df, keep=LINE_KEY))


# ----------------------------- generation, validation, metrics and jobs


@query
def generated_data(spark, folder):
    made = generate.inflate(
        events(spark, folder), "value", 25_000, key="event_id", keep_key=True, portable=True
    )
    return rounded(made)


def _decoded_events(spark: SparkSession, folder: str) -> DataFrame:
    encoder = event_encoder()
    coded = encoder.encode(events(spark, folder), "event_id", portable=True)
    return rounded(encoder.decode(coded, "decoded", keep_input=True)).select("value", "decoded")


def _tested(spark: SparkSession, ks: KsResult) -> DataFrame:
    row = (ks.statistic, ks.p_value, ks.p_value > validate.THRESHOLD, ks.n, ks.m)
    schema = "statistic double, p_value double, valid boolean, n bigint, m bigint"
    return rounded(spark.createDataFrame([row], schema))


@query
def distribution_test(spark, folder):
    return _tested(spark, ks_columns(_decoded_events(spark, folder), "value", "decoded"))


@query
def distribution_test_unequal(spark, folder):
    df = table(spark, folder, "events")
    ks = ks_two_sample(
        df.where("event_type = 'click'").select("value"),
        df.where("event_type <> 'click'").select("value"),
    )
    return _tested(spark, ks)


@query
def distribution_test_exact(spark, folder):
    """The exact p-value of samples of unequal size; beyond the size of exact tests the asymptotic one."""
    suppliers = table(spark, folder, "supplier").select("s_acctbal")
    customers = table(spark, folder, "customer").select("c_acctbal")
    return _tested(spark, ks_two_sample(suppliers, customers, method="auto"))


@query
def bounds_test(spark, folder):
    made = generate.inflate(
        events(spark, folder), "value", 20_000, key="event_id", portable=True
    )
    low, high = events(spark, folder).agg(F.min("value"), F.max("value")).first()
    return validate.bounds_check(made, "value", low, high)


@query
def moments_test(spark, folder):
    df = _decoded_events(spark, folder)
    check = validate.moments_check(df.select("value"), df.select("decoded"))
    gaps = check.differences
    return rounded(
        spark.createDataFrame(
            [(check.valid, *(gaps[m] for m in ("mean", "std", "skew", "kurtosis")))],
            "valid boolean, mean double, std double, skew double, kurtosis double",
        ),
        4,
    )


@query
def combined_accuracy(spark, folder):
    checks = validate.validate_columns(_decoded_events(spark, folder), "value", "decoded")
    return rounded(
        spark.createDataFrame(
            [
                (
                    checks.distribution_valid, checks.distribution.p_value, checks.bounds_valid,
                    checks.moments_valid, checks.accuracy,
                )
            ],
            "distribution_valid boolean, p_value double, bounds_valid boolean, "
            "moments_valid boolean, accuracy double",
        )
    )


@query
def round_trip_check(spark, folder):
    trip = validate.round_trip(_decoded_events(spark, folder), "value", "decoded", tolerance=1e-6)
    return rounded(
        spark.createDataFrame(
            [(trip.rows, trip.outside, trip.damaged, trip.max_error)],
            "rows bigint, outside bigint, damaged bigint, max_error double",
        ),
        4,
    )


@query
def round_trip_exact(spark, folder):
    """Rows that do not come back to the last bit, with and without the raw values that are kept."""
    encoder, df = event_encoder(), events(spark, folder)
    out = []
    for lossless in (False, True):
        coded = encoder.encode(df, "event_id", lossless=lossless, portable=True)
        both = encoder.decode(coded, "decoded", keep_input=True)
        kept = both.where("overflow IS NOT NULL").count() if lossless else 0
        trip = validate.round_trip(both, "value", "decoded")
        out.append((lossless, trip.rows, trip.inexact, kept))
    return spark.createDataFrame(out, "lossless boolean, rows bigint, inexact bigint, kept bigint")


def _events_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Event values, NaN for errors; of a hundred others one is infinite and one null."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "CASE WHEN event_type = 'error' THEN double('NaN') WHEN event_id % 100 = 7 "
        "THEN double('Infinity') WHEN event_id % 100 = 8 THEN NULL ELSE value END AS value",
    )


@query
def round_trip_not_finite(spark, folder):
    """Encode, write, decode and check a column with NaN, infinite and null values."""
    result = encode_job(
        spark, _events_with_gaps(spark, folder), scratch_path(spark, "gaps"), "value",
        key="event_id", lossless=True,
    )
    trip = result.validation.round_trip
    row = (trip.rows, trip.finite[0], trip.finite[1], trip.not_finite, trip.low, trip.high, trip.damaged)
    return rounded(
        spark.createDataFrame(
            [row],
            "rows bigint, finite_in bigint, finite_out bigint, not_finite bigint, low double, "
            "high double, damaged bigint",
        )
    )


@query
def generated_not_finite(spark, folder):
    made = generate.inflate(
        _events_with_gaps(spark, folder), "value", 25_000, key="event_id", keep_key=True,
        portable=True,
    )
    return rounded(
        made.selectExpr("event_id", "copy", "CASE WHEN isnan(value) OR abs(value) = double('Infinity') THEN NULL ELSE value END AS value",
                        "coalesce(isnan(value), false) AS nan")
    )


@query
def error_by_decile(spark, folder):
    df = validate.error_by_decile(_decoded_events(spark, folder), "value", "decoded")
    return rounded(df, 4)


@query
def generation_run(spark, folder):
    source = scratch_path(spark, "generation-in")
    events(spark, folder).write.option("header", True).csv(source)
    result = generation_job(
        spark, source, scratch_path(spark, "generation-out"), target=50_000, column="value",
        schema="event_id bigint, value double", key="event_id", portable=True,
    )
    written = result.written
    return rounded(
        result.statistics.withColumn("rows", F.lit(written.rows).cast("bigint")).withColumn(
            "complete", F.lit(written.complete)
        ),
        4,
    )


@query
def encode_run_values(spark, folder):
    """What the job has written, decoded by its own encoder."""
    path = scratch_path(spark, "encoded")
    result = encode_job(
        spark, events(spark, folder), path, "value", key="event_id", lossless=True
    )
    written = files.read_parquet(spark, path)
    both = result.encoder.decode(written, "decoded", keep_input=True)
    return rounded(
        both.selectExpr(
            "event_id", "value", "decoded", "size(array_remove(mode_encoding, 0.0D)) AS modes",
            "normalized_value BETWEEN -0.99 AND 0.99 AS inside",
        )
    )


@query
def encode_run_modes(spark, folder):
    """By mode, the rows and values that the job has written, with all it has fitted itself."""
    path = scratch_path(spark, "encoded")
    encode_job(spark, events(spark, folder), path, "value", key="event_id", lossless=True, portable=True)
    written = files.read_parquet(spark, path).selectExpr(
        "CAST(array_position(mode_encoding, 1.0D) - 1 AS INT) AS mode", "normalized_value", "value", "abs(normalized_value) = 0.99D AS edge"
    )
    by_mode = written.groupBy("mode").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("normalized_value").alias("mean"), F.stddev_samp("normalized_value").alias("spread"),
        F.count_if("edge").alias("clipped"), F.min("value").alias("low"), F.max("value").alias("high"),
    )
    return rounded(by_mode, 3)


@query
def encode_run(spark, folder):
    result = encode_job(
        spark, events(spark, folder), scratch_path(spark, "encoded"), "value", key="event_id",
        lossless=True,
    )
    trip = result.validation.round_trip
    return rounded(
        spark.createDataFrame(
            [
                (
                    result.written.rows, result.written.rows_read_back, trip.low, trip.high,
                    trip.outside, trip.damaged, result.validation.accuracy,
                    result.measurement.processing_time > 0 and result.measurement.throughput > 0,
                )
            ],
            "rows bigint, rows_read_back bigint, low double, high double, outside bigint, "
            "damaged bigint, accuracy double, measured boolean",
        )
    )


@query
def encode_file_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    stream = read_files_as_stream(spark, folder, schema, "events.parquet")
    out = scratch_path(spark, "stream-out")
    encode_stream(
        stream.select("event_id", "value"), event_encoder(), out,
        scratch_path(spark, "stream-state"), "event_id", portable=True,
    ).awaitTermination()
    return rounded(flattened(files.read_parquet(spark, out), "mode_encoding", 3))


@query
def table_file_stream(spark, folder):
    """A fitted table encoder on a stream of files, an indexed and a sparse column among them, and back on another stream."""
    lines = table(spark, folder, "lineitem")
    spec = TableSpec(
        categorical=["l_returnflag", "l_partkey", "l_suppkey"], indexed=["l_partkey"], sparse=["l_suppkey"],
        columns=["l_quantity", "l_partkey", "l_suppkey", "l_returnflag"], continuous="minmax",
    )
    state = scratch_path(spark, "table-encoder")
    TableEncoder(spec).fit(lines).save(spark, state)
    encoder = TableEncoder.load(spark, state)
    stream = read_files_as_stream(spark, folder, lines.schema, "lineitem.parquet")
    coded, back = scratch_path(spark, "table-coded"), scratch_path(spark, "table-decoded")
    encode_table_stream(
        stream, encoder, coded, scratch_path(spark, "table-state"), keep=["l_orderkey", "l_linenumber"]
    ).awaitTermination()
    written = files.read_parquet(spark, coded)
    kept = ["l_orderkey", "l_linenumber", *(f"col_{i}" for i in range(encoder.output_dimensions))]
    decode_table_stream(
        read_files_as_stream(spark, coded, written.schema), encoder, back, scratch_path(spark, "table-state"), keep=kept
    ).awaitTermination()
    return rounded(files.read_parquet(spark, back))
