import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweek.operators import correlation, distribution
from tallyweek.operators.quantile import quantiles


def table(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def test_quartiles_of_four(spark):
    got = rows(quantiles(table(spark, [1, 2, 3, 10]), "x", [0.25, 0.5, 0.75]), "prob")
    assert got == [(0.25, 1.75), (0.5, 2.5), (0.75, 4.75)]


@pytest.mark.parametrize("limits", [{}, {"sort_rows": 20, "parts": 8}, {"sort_rows": 1, "parts": 2}])
def test_quantiles_match_brute_force(spark, limits):
    rng = np.random.default_rng(7)
    hot = np.concatenate([rng.lognormal(3, 2, 400), np.full(300, 5.0), -rng.lognormal(1, 3, 200), [0.0, 0.0, 1e300, -1e-300]])
    few = np.array([4.0, 4.0, -2.0])
    data = [("hot", float(v)) for v in hot] + [("few", float(v)) for v in few] + [(None, 9.0), ("hot", None), ("few", float("nan"))]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in quantiles(df, "x", probs, ["g"], **limits).collect()}
    for name, values in (("hot", hot), ("few", few), (None, np.array([9.0]))):
        for p in probs:
            assert got[name, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300)
    assert len(got) == 18
    alone = {r["prob"]: r["quantile"] for r in quantiles(df.where("g = 'hot'"), "x", probs, **limits).collect()}
    assert alone == {p: got["hot", p] for p in probs}


def test_quantiles_of_many_groups(spark):
    df = spark.range(900).selectExpr("id % 30 as g", "cast((id * 7919) % 1009 as double) as x")
    got = {(r["g"], r["prob"]): r["quantile"] for r in quantiles(df, "x", [0.5, 0.9], ["g"], sort_rows=4, parts=4).collect()}
    want = df.groupBy("g").agg(F.percentile("x", [0.5, 0.9]).alias("q")).collect()
    assert got == {(r["g"], p): pytest.approx(v) for r in want for p, v in zip((0.5, 0.9), r["q"])}


def test_quantiles_edges(spark):
    assert rows(quantiles(table(spark, []), "x", [0.5])) == []
    assert rows(quantiles(table(spark, [None, float("nan")]), "x", [0.5])) == []
    infinite = table(spark, [1, 2, float("inf"), float("-inf"), 3])
    assert rows(quantiles(infinite, "x", [0.0, 0.5, 1.0]), "prob") == [(0.0, float("-inf")), (0.5, 2.0), (1.0, float("inf"))]
    close = rows(quantiles(table(spark, range(1000)), "x", [0.5], approx=1000))
    assert close[0][1] == pytest.approx(499, abs=3)


def test_moments(spark):
    x = np.random.default_rng(1).exponential(size=2000)
    df, z = table(spark, x), (x - x.mean()) / x.std()
    assert distribution.skewness(df, "x").first()[0] == pytest.approx((z**3).mean())
    excess, pearson = distribution.kurtosis(df, "x").first()
    assert pearson == pytest.approx((z**4).mean()) and pearson == excess + 3


def test_histogram_edges(spark):
    got = rows(distribution.histogram(table(spark, [0, 9.99, 10, None]), "x", 5))
    assert [(b, n) for b, _, _, n in got] == [(1, 1), (2, 0), (3, 0), (4, 0), (5, 2)]
    assert got[1][1:3] == (2.0, 4.0)
    assert sum(r[3] for r in rows(distribution.histogram(table(spark, [3, 3]), "x", 4))) == 2
    assert rows(distribution.histogram(table(spark, []), "x", 4)) == []
    assert rows(distribution.histogram_by_width(table(spark, [-1, 0, 8.9, 9]), "x", 9)) == [(-1, -9.0, 1), (0, 0.0, 2), (1, 9.0, 1)]


def test_density_is_close_to_the_exact_sum(spark):
    x = np.random.default_rng(3).gamma(2.0, 10.0, 3000)
    got = distribution.density(table(spark, x), "x", upper=60.0).toPandas()
    kept = x[x <= 60]
    q1, q3 = np.quantile(kept, [0.25, 0.75])
    h = 0.9 * min(kept.std(ddof=1), (q3 - q1) / 1.34) * len(kept) ** -0.2
    grid = np.linspace(kept.min(), 60, 512)
    want = np.exp(-(((grid[:, None] - kept) / h) ** 2) / 2).sum(axis=1) / (len(kept) * h * np.sqrt(2 * np.pi))
    assert len(got) == 512
    np.testing.assert_allclose(got["x"], grid)
    np.testing.assert_allclose(got["density"], want, atol=2e-3 * want.max())
    assert distribution.density(table(spark, []), "x", 1.0).count() == 0


def test_density_with_a_narrow_peak_and_a_far_tail(spark):
    x = np.concatenate([np.random.default_rng(4).normal(0, 1e-4, 500), [1000.0]])
    got = distribution.density(table(spark, x), "x", upper=1000.0).toPandas()
    assert len(got) == 512 and got["density"].iloc[0] > 0 and got["density"].iloc[-1] > 0
    assert (got["density"].iloc[1:-1] == 0).all()


def test_box_stats(spark):
    df = spark.createDataFrame(
        [("a", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])] + [("b", 9, 5.0), ("b", 9, 5.0), (None, 1, 2.0)], "g string, e int, x double"
    )
    got = {r["g"]: tuple(r)[1:] for r in distribution.box_stats(df, ["g"], "x").collect()}
    assert got["a"] == (5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert got["b"] == (2, 5.0, 5.0, 5.0, 5.0, 5.0, 0)
    assert got[None][0] == 1
    near = {r["g"]: r["median"] for r in distribution.box_stats(df, ["g"], "x", approx=100).collect()}
    assert near["a"] == 3.0
    assert {r["g"]: r["n"] for r in distribution.box_stats(df, ["g"], "x", ["e"]).collect()}["b"] == 1


def test_scatter_and_bands(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("a", 1.4, 12.0), ("b", 4.0, 30.0), ("b", None, 1.0)], "g string, x double, y double")
    assert rows(distribution.binned_scatter(df, "x", "y", 1, 10, ["g"])) == [("a", 1, 1, 2, 11.0), ("b", 4, 3, 1, 30.0)]
    bands = [("low", None, 1.0), ("mid", 1.0, 2.0), ("high", 3.0, None)]
    assert rows(distribution.mean_by_band(df, "x", "y", bands)) == [
        (None, 1, 1.0, 1.0), ("high", 1, 30.0, 30.0), ("low", 1, 10.0, 10.0), ("mid", 1, 12.0, 12.0)
    ]


@pytest.mark.parametrize("partitions", [1, 3, 4])
def test_constant_column_has_no_correlation(spark, partitions):
    df = spark.range(100).selectExpr("id as x", "5 as c", "0.1D as d", "id * id as y").repartition(partitions)
    got = {(r["x"], r["y"]): r["r"] for r in correlation.correlation_matrix(df).collect()}
    assert len(got) == 16
    assert all(v is None for k, v in got.items() if "c" in k or "d" in k)
    assert got["x", "x"] == 1.0 and got["x", "y"] == got["y", "x"] == pytest.approx(np.corrcoef(np.arange(100), np.arange(100) ** 2)[0, 1])
    screen = {r["feature"]: (r["r"], r["keep"]) for r in correlation.screen_features(df, "y").collect()}
    assert screen["c"] == (None, False) and screen["x"][1]


@pytest.mark.parametrize("partitions", [1, 3])
def test_pairs_with_missing_values(spark, partitions):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (None, 3.0, 2.0), (4.0, 1.0, None), (5.0, 5.0, 1.0)], "a double, b double, c double"
    ).repartition(partitions)
    got = {(r["x"], r["y"]): r["r"] for r in correlation.correlation_matrix(df, upper=True).collect()}
    assert got["a", "b"] == pytest.approx(0.5)
    assert got["a", "c"] is None  # c does not vary where a is present
    assert got["b", "c"] == pytest.approx(np.corrcoef([2, 3, 5], [1, 2, 1])[0, 1])


def test_first_component_order(spark):
    x = np.random.default_rng(5).normal(size=(500, 3))
    data = [(float(a), float(a + 0.1 * b), float(c), 7.0) for a, b, c in x]
    df = spark.createDataFrame(data, "a double, b double, c double, k double")
    got = rows(correlation.first_component_order(df))
    values = np.array(data)[:, :3]
    vector = np.linalg.eigh(np.corrcoef(values.T))[1][:, -1]
    vector = vector if vector[np.abs(vector).argmax()] > 0 else -vector
    assert [r[1] for r in got] == [n for _, n in sorted(zip(vector, "abc"))]
    assert [r[2] for r in got] == pytest.approx(sorted(vector), abs=1e-9)


def test_correlation_beside_an_outlier_in_an_unshared_row(spark):
    rng = np.random.default_rng(5)
    x, noise = rng.uniform(0, 100, 300), rng.normal(0, 20, 300)
    data = [(float(a), float(a + e), 7.0 if i % 2 else None) for i, (a, e) in enumerate(zip(x, noise))] + [(1e9, None, 8.0)]
    df = spark.createDataFrame(data, "x double, y double, c double")
    got = {(r["x"], r["y"]): r["r"] for r in correlation.correlation_matrix(df, upper=True).collect()}
    assert got["x", "y"] == pytest.approx(np.corrcoef(x, x + noise)[0, 1]) and got["y", "c"] is None
    screen = {r["feature"]: r["keep"] for r in correlation.screen_features(df, "y").collect()}
    assert screen == {"x": True, "c": False}
