"""Time the headline operations and print one line of JSON.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of cores, and
BENCH_MILLIONS the sizes, in millions of rows, of the inflated end-to-end jobs.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from modeforge import MixtureConfig, ModeEncoder, TableEncoder, TableSpec, encode_job  # noqa: E402
from modeforge.operators import generate, profile, score, validate  # noqa: E402
from modeforge.operators.fit import fit_mixture, fit_mixtures  # noqa: E402
from modeforge.operators.ks import ks_columns  # noqa: E402
from modeforge.session import local_session  # noqa: E402
from modeforge.sources import read_csv, read_parquet, write_checked  # noqa: E402

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
SPEC = TableSpec(
    categorical=["l_returnflag", "l_linestatus"],
    mixed={"l_discount": [0.0]},
    columns=["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"],
)


def sink(df) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores)
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    @contextlib.contextmanager
    def timed(name: str, count: int):
        started = time.monotonic()
        yield
        seconds[name] = round(time.monotonic() - started, 3)
        rows[name] = count

    events = read_parquet(spark, f"{folder}/events.parquet").select("event_id", "value")
    # The file holds one row group, so it is one task unless it is spread.
    lines = read_parquet(spark, f"{folder}/lineitem.parquet", partitions=cores)
    n_events, n_lines = events.count(), lines.count()

    # A first small fit starts the Python workers; it is not timed.
    fit_mixture(events, "value", MixtureConfig(max_iter=2))

    with timed("job_encode_column", n_events):
        encode_job(spark, events, f"{out}/job", "value", key="event_id", lossless=True)
    with timed("fit_column", n_events):
        mixture = fit_mixture(events, "value")
    with timed("fit_large_column", n_lines):
        price = fit_mixture(lines, "l_extendedprice")
    with timed("fit_three_columns", n_lines):
        fit_mixtures(lines, {c: c for c in ("l_quantity", "l_extendedprice", "l_discount")})
    encoder = ModeEncoder("l_extendedprice", price)
    with timed("encode", n_lines):
        sink(encoder.encode(lines, LINE_KEY, lossless=True))
    with timed("encode_write", n_lines):
        write_checked(encoder.encode(lines, LINE_KEY, lossless=True), f"{out}/encoded")
    written = read_parquet(spark, f"{out}/encoded").withColumnRenamed("l_extendedprice", "raw")
    with timed("decode", n_lines):
        sink(encoder.decode(written))
    decoded = encoder.decode(written, "decoded", keep_input=True).select("raw", "decoded")
    with timed("validate_round_trip", n_lines):
        validate.round_trip(decoded, "raw", "decoded")
    with timed("validate_distribution", n_lines):
        ks_columns(decoded, "raw", "decoded")
    with timed("sufficient_statistics", n_lines):
        score.sufficient_statistics(lines, "l_extendedprice", price).collect()
    table = TableEncoder(SPEC)
    with timed("table_fit", n_lines):
        table.fit(lines)
    with timed("table_encode", n_lines):
        table.transform(lines, LINE_KEY, keep=LINE_KEY, lossless=True).write.parquet(f"{out}/table")
    with timed("table_decode", n_lines):
        sink(table.inverse_transform(read_parquet(spark, f"{out}/table"), keep=LINE_KEY))
    made = 20 * n_events
    with timed("generate", made):
        write_checked(generate.inflate(events, "value", made, key="event_id"), f"{out}/made")
    # Every inflated value is another one, so the fit has as many values as rows.
    for millions in os.environ.get("BENCH_MILLIONS", "1").split():
        target = int(float(millions) * 1_000_000)
        big = generate.inflate(events, "value", target, key="event_id", keep_key=True)
        write_checked(big, f"{out}/big-{millions}")
        with timed(f"job_encode_{millions}m", target):
            encode_job(
                spark, f"{out}/big-{millions}", f"{out}/big-job-{millions}", "value",
                key=["event_id", "copy"], lossless=True,
            )
    with timed("describe", n_lines):
        profile.describe_columns(
            lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        ).collect()
    with timed("rank_categories", n_lines):
        profile.ranked_categories(lines, ["l_returnflag", "l_linestatus"]).collect()
    events.write.option("header", True).csv(f"{out}/csv")
    with timed("csv_scan", n_events):
        sink(read_csv(spark, f"{out}/csv", "event_id bigint, value double"))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_second_per_core": {
                    name: round(rows[name] / s / cores) if s else None
                    for name, s in seconds.items()
                },
                "cores": cores,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
