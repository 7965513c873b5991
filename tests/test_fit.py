import numpy as np
import pyarrow as pa
import pytest
from plain_fit import fit as plain_fit

from modeforge import MixtureConfig, fit_mixture, fit_mixtures
from modeforge.operators import compress, fit
from modeforge.operators.model import from_parameters, parameters
from modeforge.operators.sums import SCHEMA, added
from modeforge.sources.scratch import scratch_path


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("steps", [1, 3, 100])
def test_matches_plain_fit(events, steps):
    x = events.toPandas()["value"].to_numpy()
    m = fit_mixture(events, "value", MixtureConfig(max_iter=steps, n_components=5))
    (beta, nu, a, b, mean, c), bounds = plain_fit(x, 5, m.report.iterations)
    np.testing.assert_allclose(m.means, mean, rtol=1e-6)
    np.testing.assert_allclose(m.variances, c, rtol=1e-6)
    np.testing.assert_allclose(m.beta, beta, rtol=1e-6)
    np.testing.assert_allclose(m.b, b, rtol=1e-6)
    # Standardising the values moves the bound by a constant only.
    np.testing.assert_allclose(np.diff(m.report.bounds), np.diff(bounds), atol=1e-5)
    assert (np.diff(m.report.bounds) > -1e-8).all()
    assert m.report.rows == len(x)
    assert sum(m.frequency) == pytest.approx(len(x))


def test_finds_two_modes(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 500), rng.normal(100, 1, 500)])
    m = fit_mixture(column(spark, x), "x", MixtureConfig(max_iter=30, n_components=4))
    assert any(abs(v) < 2 for v in m.kept_means) and any(abs(v - 100) < 2 for v in m.kept_means)


def test_every_value_counts_whatever_their_number(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, 60_000), rng.normal(50, 5, 30_000)])
    m = fit_mixture(column(spark, x).repartition(3), "x", MixtureConfig(max_iter=3, n_components=4))
    (_, _, _, _, mean, c), _ = plain_fit(x, 4, 3)
    assert m.report.cells == len(np.unique(x))
    np.testing.assert_allclose(m.means, mean, rtol=1e-6)
    np.testing.assert_allclose(m.variances, c, rtol=1e-6)


def test_many_columns_in_one_go_equal_single_fits(events):
    cfg = MixtureConfig(max_iter=4, n_components=3)
    both = fit_mixtures(events, {"a": "value", "b": "sqrt(value)"}, cfg)
    alone = fit_mixture(events.selectExpr("sqrt(value) AS b"), "b", cfg)
    np.testing.assert_allclose(both["b"].means, alone.means, rtol=1e-9)
    np.testing.assert_allclose(
        both["a"].means, fit_mixture(events, "value", cfg).means, rtol=1e-9
    )


def test_partitioning_does_not_matter(events):
    cfg = MixtureConfig(max_iter=5, n_components=4)
    a = fit_mixture(events, "value", cfg)
    b = fit_mixture(events.repartition(11), "value", cfg)
    np.testing.assert_allclose(a.means, b.means, rtol=1e-9)


def test_restarts_keep_the_best_bound(events):
    one = fit_mixture(events, "value", MixtureConfig(max_iter=6, n_components=4))
    more = fit_mixture(events, "value", MixtureConfig(max_iter=6, n_components=4, n_init=3))
    assert more.report.lower_bound >= one.report.lower_bound


def test_hot_value_and_missing_values(spark):
    x = [5.0] * 400 + list(np.linspace(0, 100, 200)) + [None, float("nan"), float("inf")]
    m = fit_mixture(column(spark, x), "x", MixtureConfig(max_iter=20, n_components=4))
    assert m.report.rows == 600
    assert np.isfinite(m.means).all() and min(m.variances) > 0


@pytest.mark.parametrize("values", [[7.0] * 5, [3.5]])
def test_constant_and_single(spark, values):
    m = fit_mixture(column(spark, values), "x", MixtureConfig(max_iter=5))
    assert m.kept and min(m.variances) > 0
    assert any(abs(v - values[0]) < 1e-6 for v in m.kept_means)


def test_empty_is_an_error(spark):
    with pytest.raises(ValueError, match="no finite value"):
        fit_mixture(column(spark, [None]), "x")


def test_parameters_survive_a_round_trip(spark, events):
    m = fit_mixture(events, "value", MixtureConfig(max_iter=2, n_components=3))
    path = scratch_path(spark, "parameters")
    parameters(spark, {"value": m}).write.parquet(path)
    back = from_parameters(spark.read.parquet(path))["value"]
    assert back.means == m.means and back.active == m.active and back.order == m.order
    assert back.consts == m.consts


def test_sums_are_added_in_the_cluster(spark, events, monkeypatch):
    cfg = MixtureConfig(max_iter=4, n_components=4, n_init=2)
    columns = {"a": "value", "b": "sqrt(value)"}
    plain = fit_mixtures(events, columns, cfg)
    monkeypatch.setattr(fit, "_DIRECT", 0)
    monkeypatch.setattr(fit, "_FEW_CELLS", 100)
    again = fit_mixtures(events, columns, cfg)
    for name in columns:
        np.testing.assert_allclose(again[name].means, plain[name].means, rtol=1e-10)
        np.testing.assert_allclose(again[name].report.bounds, plain[name].report.bounds, rtol=1e-10)
    # However many tasks there are, one row of a chain arrives, the same every time.
    rows = [(k % 3, k // 3, [1.0, 0.1 * k]) for k in range(300)]
    partial = spark.createDataFrame(rows, SCHEMA)
    one, two = (sorted(added(partial.repartition(n), 3).collect()) for n in (2, 7))
    assert [r["chain"] for r in one] == [0, 1, 2] and one == two
    assert one[1]["sums"] == [100.0, pytest.approx(0.1 * sum(range(1, 300, 3)))]


def test_tasks_follow_the_slots(spark, monkeypatch):
    monkeypatch.setattr(fit, "_MANY_CELLS", 100)
    cells = spark.range(20_000).selectExpr("0 AS model", "CAST(id AS DOUBLE) AS z", "1.0D AS n")
    held = fit._hold(cells, 1)
    slots = spark.sparkContext.defaultParallelism
    assert held.tasks == fit._ROUNDS * slots and held.cells == [20_000]
    assert held.blocks.select("part").distinct().count() <= held.tasks


def test_many_columns_are_one_scan(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "wide")
    odd = "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') ELSE CAST(pmod(id * {0}, {0} + 3) AS DOUBLE) END"
    columns = [f"c{i}" for i in range(100)]
    spark.range(3000).selectExpr(*(f"{odd.format(i + 1)} AS {c}" for i, c in enumerate(columns))).write.parquet(path)
    df = spark.read.parquet(path)
    wanted = {c: c for c in columns}
    profiles, _ = compress.profile_numeric(df, wanted)
    counted = compress.compress(df, wanted, profiles)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    monkeypatch.setattr(compress, "_FEW_COLUMNS", 1000)
    plain = compress.compress(df, wanted, profiles)
    assert counted.exceptAll(plain).isEmpty() and plain.exceptAll(counted).isEmpty()


def test_value_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(compress, "TABLE", 200)
    rng = np.random.default_rng(1)
    data = [rng.integers(0, 30, 4000).astype(float), rng.random(4000)]
    batches = [pa.record_batch([d[lo : lo + 100] for d in data], ["a", "b"]) for lo in range(0, 4000, 100)]
    out = list(compress.value_tables(iter(batches)))
    assert max(b.num_rows for b in out) <= 400
    for model, d in enumerate(data):
        found = {}
        for b in out:
            for m, v, n in zip(*(c.to_pylist() for c in b.columns)):
                if m == model:
                    found[v] = found.get(v, 0) + n
        values, counts = np.unique(d, return_counts=True)
        assert found == dict(zip(values.tolist(), counts.tolist()))


@pytest.mark.parametrize("direct", [64, 0])
def test_k_means_start(spark, events, monkeypatch, direct):
    monkeypatch.setattr(fit, "_DIRECT", direct)
    monkeypatch.setattr(fit, "_FEW_CELLS", 500)
    k, runs = 5, 2
    cfg = MixtureConfig(max_iter=8, n_components=k, n_init=runs, start="kmeans")
    profiles, _ = compress.profile_numeric(events, {"value": "value"})
    held = fit._hold(compress.compress(events, {"value": "value"}, profiles), 1)
    chains = fit._initial_chains(held, [profiles["value"]], cfg)
    # The same steps over plain rows.
    x = np.sort(events.toPandas()["value"].to_numpy())
    z = (x - profiles["value"].mean) / profiles["value"].scale
    values, counts = np.unique(z, return_counts=True)
    place = (np.cumsum(counts) - counts / 2) / len(z)
    for run in range(runs):
        share = np.sort(np.random.default_rng([cfg.random_state, run]).random(k - 1))
        own = np.repeat(np.searchsorted(share, place, side="right"), counts)
        centres = np.zeros(k)
        for _ in range(fit._K_MEANS_STEPS):
            moved = np.sort([z[own == i].mean() if (own == i).any() else centres[i] for i in range(k)])
            still, centres = np.abs(moved - centres).max() < fit._K_MEANS_TOLERANCE, moved
            if still:
                break
            own = np.searchsorted((centres[1:] + centres[:-1]) / 2, z, side="right")
        n = np.bincount(own, minlength=k)
        np.testing.assert_allclose(chains[run].beta - 1, n, rtol=1e-9)
        means = np.array([z[own == i].mean() for i in range(k)])
        np.testing.assert_allclose(chains[run].mean, means * n / (n + 1), rtol=1e-7)


def test_k_means_start_is_no_worse(events):
    cfg = MixtureConfig(max_iter=40, n_components=6, n_init=3)
    bins = fit_mixture(events, "value", cfg)
    means = fit_mixture(events, "value", MixtureConfig(max_iter=40, n_components=6, n_init=3, start="kmeans"))
    assert means.report.lower_bound >= bins.report.lower_bound - 1e-6 * abs(bins.report.lower_bound)
    with pytest.raises(ValueError, match="start"):
        MixtureConfig(start="random")
