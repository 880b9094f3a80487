"""Recorded values of the derived tables, and what must hold of any result."""

import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from tallyweek.operators import correlation, distribution, models, summary
from tallyweek.operators.split import split, with_fold
from tallyweek.plans import queries


@pytest.fixture(scope="module")
def panel(spark):
    return queries.panel(spark, MEDIUM)


@pytest.mark.parametrize("folder, merged, train, fold", [(SMALL, 3611, 3987, 1058), (MEDIUM, 35548, 40057, 10507)])
def test_counts(spark, folder, merged, train, fold):
    sales = queries.sales(spark, folder)
    assert queries.panel(spark, folder).count() == merged
    assert split(sales, queries.WEIGHTS, queries.KEY)["train"].count() == train
    assert with_fold(sales, 5, queries.KEY).where("fold = 1").count() == fold


def test_panel_sums(panel):
    assert panel.where("is_holiday = 1").count() == 2564
    assert panel.where("year = 1998").count() == 5334
    assert tuple(panel.agg(F.min("year"), F.max("year")).first()) == (1995, 2001)
    names = ["weekly_sales", "temperature", "fuel_price", "cpi", "unemployment", "store_size"]
    want = [2012108335.44, 1952761.58, 124329.512, 6073958.07, 355695.34, 3962165000]
    assert list(panel.agg(*[F.sum(c) for c in names]).first()) == pytest.approx(want, rel=1e-8)


def test_distribution(panel):
    bins = {r["bin"]: r["n"] for r in distribution.histogram_by_width(panel, "weekly_sales", 9000).collect()}
    assert [bins[i] for i in range(4)] == [2657, 2925, 2985, 2957]
    assert sum(bins.values()) == 35548
    box = {r["store_type"]: (r["q1"], r["median"], r["q3"]) for r in distribution.box_stats(panel, ["store_type"], "store_size").collect()}
    assert box == {"A": (72000, 93000, 156000), "B": (79000, 121000, 163000), "C": (65000, 107000, 128000)}
    assert distribution.skewness(panel, "weekly_sales").first()[0] == pytest.approx(0.6298, abs=1e-4)
    assert distribution.kurtosis(panel, "weekly_sales").first()[1] == pytest.approx(3.923717, abs=1e-6)
    curve = distribution.density(panel, "weekly_sales", 200_000).toPandas()
    area = ((curve["density"][1:].to_numpy() + curve["density"][:-1].to_numpy()) / 2 * (curve["x"][1] - curve["x"][0])).sum()
    assert 0.95 < area < 1.001


def test_correlations(panel):
    r = {(x["x"], x["y"]): x["r"] for x in correlation.correlation_matrix(panel).collect()}
    for pair, want in {
        ("weekly_sales", "store_size"): 0.00682725, ("temperature", "fuel_price"): 0.00334943,
        ("weekly_sales", "cpi"): -0.00063244, ("fuel_price", "unemployment"): -0.0100488,
    }.items():
        assert r[pair] == r[pair[::-1]] == pytest.approx(want, abs=1e-7)
    assert all(r[a, a] == 1 for a, _ in r)


def test_bands_and_shares(panel):
    bands = {r["band"]: r["n"] for r in distribution.mean_by_band(panel, "fuel_price", "weekly_sales", queries.FUEL_BANDS).collect()}
    assert (bands["2.75-3.75"], bands["above 4.25"]) == (26640, 742)
    assert sum(r["pct"] for r in summary.share_by(panel, "store_type").collect()) == pytest.approx(100)


def test_models(spark, panel):
    rmse, r2 = queries.regression_metrics(spark, MEDIUM).first()
    assert (rmse, r2) == (pytest.approx(34889.9105, abs=1e-3), pytest.approx(0.00021, abs=1e-5))
    f = models.fit(panel, "weekly_sales ~ store_size")
    assert float(f.model.coefficients[0]) == pytest.approx(0.005269, abs=1e-6)
    assert f.model.intercept == pytest.approx(56015.2397, abs=1e-3)
    assert f.model.summary.r2 == pytest.approx(4.661e-05, abs=1e-8)
