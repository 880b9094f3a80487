"""The registered queries: one per operation, on tables derived from the given ones.

Models and cross-validations are run once and reported in several tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.functions import calendar, columns
from tallyweek.functions.sizing import saved, scratch_path
from tallyweek.operators import clean, correlation, crossval, distribution, metrics, models, quality, reshape, summary
from tallyweek.operators.join import attach_stats, inner_join
from tallyweek.operators.split import part_name, split, with_fold
from tallyweek.plans import panel as plans
from tallyweek.sources import catalog, files, preview, standin

Query = Callable[[SparkSession, str], DataFrame]

# Years, widths, bounds and bands the queries ask for.
MODEL_YEAR = 1998
YEARS = (1996, 1998)
KEY = ["store", "dept", "week_date"]
WEIGHTS = {"train": 0.75, "test": 0.25}
CLIP_UPPER = 200_000
BIN_WIDTH = 9_000
TEMPERATURE_BANDS = [("below 40", None, 40.0), ("40-80", 40.0, 80.0), ("above 80", 80.0, None)]
UNEMPLOYMENT_BANDS = [("8-10", 8.0, 10.0), ("above 11", 11.0, None)]
FUEL_BANDS = [("2.75-3.75", 2.75, 3.75), ("above 4.25", 4.25, None)]

# Sales are money: means and totals of them count whole cents.
mean_by, total_by, peak_by = (partial(f, money=True) for f in (summary.mean_by, summary.total_by, summary.peak_by))
binned_scatter, mean_by_band = (partial(f, money=True) for f in (distribution.binned_scatter, distribution.mean_by_band))

QUERIES: dict[str, Query] = {}
_KEPT: dict[tuple, object] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def once(fn):
    """Fit once for all queries on the same Spark application and folder; another folder empties the store."""

    @wraps(fn)
    def kept(spark: SparkSession, sf_dir: str):
        run = (spark.sparkContext.applicationId, sf_dir)
        for at in [at for at in _KEPT if at[1:] != run]:
            del _KEPT[at]
        if (fn.__name__, *run) not in _KEPT:
            _KEPT[fn.__name__, *run] = fn(spark, sf_dir)
        return _KEPT[fn.__name__, *run]

    return kept


# Tables stay lazy, so that each query's plan reads the columns it needs from the given ones.
stores, features, sales = standin.stores, standin.features, standin.sales


def panel(spark, sf_dir) -> DataFrame:
    return plans.build_panel(sales(spark, sf_dir), stores(spark, sf_dir), features(spark, sf_dir))


def good_sales(spark, sf_dir) -> DataFrame:
    return plans.clean_sales(sales(spark, sf_dir))


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


# Sources, sinks, catalog


@query
def src_csv_roundtrip(spark, sf_dir):
    """Features through a delimited file whose missing values read `NA`."""
    path = scratch_path(spark, "csv")
    files.write_delimited(features(spark, sf_dir), path)
    marks = ", ".join(f"markdown_{i} double" for i in range(1, 6))
    schema = (
        f"store int, week_date date, temperature double, fuel_price double, {marks}, "
        "cpi double, unemployment double, is_holiday boolean"
    )
    return files.read_delimited(spark, path, schema)


@query
def load_named_table(spark, sf_dir):
    """A table loaded under a name, and again over itself."""
    catalog.publish(stores(spark, sf_dir), "tw_sales")
    named = catalog.publish(sales(spark, sf_dir), "tw_sales", overwrite=True)
    return total_by(named, ["store"], "weekly_sales")


@query
def register_view(spark, sf_dir):
    """S3: the enriched panel under a name, asked through SQL."""
    catalog.publish(panel(spark, sf_dir), "tw_panel")
    return spark.sql(
        "SELECT store_type, year, count(*) AS n, "
        "CAST(sum(CAST(weekly_sales AS DECIMAL(18, 2))) AS DOUBLE) AS total_sales "
        "FROM tw_panel GROUP BY store_type, year"
    )


@query
def list_tables(spark, sf_dir):
    """The session's tables with their dimensions."""
    tables = {
        "tw_listed_sales": sales(spark, sf_dir),
        "tw_listed_stores": stores(spark, sf_dir),
        "tw_listed_features": features(spark, sf_dir),
    }
    named = {name: catalog.publish(df, name) for name, df in tables.items()}
    listed = catalog.list_tables(spark, "tw_listed_*").withColumnRenamed("name", "table_name")
    return listed.select("table_name", "is_temporary").join(preview.dims(named), "table_name")


@query
def parquet_roundtrip(spark, sf_dir):
    """The panel saved by year and read back, all rows and columns."""
    path = scratch_path(spark, "panel-by-year")
    files.save_table(panel(spark, sf_dir), path, ["year"])
    return files.load_table(spark, path)


@query
def drop_table(spark, sf_dir):
    """What is left of two named tables when one is dropped."""
    for name in ("tw_dropped_a", "tw_dropped_b"):
        catalog.publish(stores(spark, sf_dir), name)
    catalog.drop_table(spark, "tw_dropped_a")
    left = catalog.list_tables(spark, "tw_dropped_*").select(F.col("name").alias("table_name"))
    return left.join(preview.dims({"tw_dropped_b": spark.table("tw_dropped_b")}), "table_name")


@query
def glimpse(spark, sf_dir):
    """S8."""
    return preview.glimpse(sales(spark, sf_dir), 5, KEY)


@query
def table_dims(spark, sf_dir):
    """S9."""
    return preview.dims(
        {
            "sales": sales(spark, sf_dir),
            "clean_sales": good_sales(spark, sf_dir),
            "stores": stores(spark, sf_dir),
            "features": features(spark, sf_dir),
            "panel": panel(spark, sf_dir),
        }
    )


# Projections and scalar functions


@query
def select_cols(spark, sf_dir):
    """P1."""
    return panel(spark, sf_dir).select("weekly_sales", "store_size", "store_type")


@query
def drop_by_prefix(spark, sf_dir):
    """P2."""
    return columns.drop_columns(panel(spark, sf_dir), "cpi", "unemployment", prefix="markdown")


@query
def select_numeric(spark, sf_dir):
    """P3."""
    return columns.select_numeric(panel(spark, sf_dir))


@query
def enrich_calendar(spark, sf_dir):
    """P4, P15-P17."""
    merged = plans.enrich(inner_join(good_sales(spark, sf_dir), stores(spark, sf_dir), ["store"]))
    return merged.select(*KEY, "is_holiday", "type_numeric", "year", "month", "week_of_year")


@query
def fill_markdowns(spark, sf_dir):
    """P6, P14."""
    return plans.clean_features(features(spark, sf_dir))


@query
def cast_date(spark, sf_dir):
    """Dates that come as text."""
    as_text = sales(spark, sf_dir).withColumn("week_date", F.col("week_date").cast("string"))
    return columns.to_dates(as_text, "week_date").select(*KEY)


@query
def bool_to_int(spark, sf_dir):
    """P8."""
    return columns.bools_to_int(sales(spark, sf_dir), "is_holiday").select(*KEY, "is_holiday")


@query
def encode_type(spark, sf_dir):
    """P11."""
    code = columns.encode(F.col("store_type"), plans.TYPE_CODES)
    return stores(spark, sf_dir).withColumn("type_numeric", code)


@query
def na_to_null(spark, sf_dir):
    """Text `NA` to NULL in every text column."""
    return columns.text_na_to_null(features(spark, sf_dir))


@query
def week_block(spark, sf_dir):
    """Both week numbers."""
    d = F.col("week_date")
    return sales(spark, sf_dir).select(
        *KEY, calendar.week_block(d).alias("week_block"), calendar.iso_week(d).alias("iso_week")
    )


@query
def format_labels(spark, sf_dir):
    """P20: rounded and fixed-point labels."""
    means = mean_by(panel(spark, sf_dir), ["is_holiday"], "weekly_sales")
    return means.select(
        "is_holiday", F.round("avg_sales", 2).alias("rounded"), columns.fixed_text(F.col("avg_sales")).alias("label")
    )


@query
def composite_label(spark, sf_dir):
    """P21."""
    label = columns.joined_label(F.col("store_type"), F.col("year"))
    return summary.count_by(panel(spark, sf_dir).withColumn("label", label), "label")


@query
def category_order(spark, sf_dir):
    """The stores as an ordered category."""
    return summary.category_order(panel(spark, sf_dir), "store")


@query
def code_lookup(spark, sf_dir):
    """P23."""
    name = columns.lookup(F.col("is_holiday"), {0: "regular week", 1: "holiday week"})
    return panel(spark, sf_dir).select(*KEY, name.alias("week_kind"))


# Filters


@query
def filter_positive(spark, sf_dir):
    """F1."""
    return clean.keep_positive(sales(spark, sf_dir), "weekly_sales")


@query
def filter_not_null(spark, sf_dir):
    """F2."""
    typed = columns.text_na_to_null(features(spark, sf_dir), types={"markdown_1": "double"})
    return clean.keep_present(typed, "markdown_1").select("store", "week_date", "markdown_1")


@query
def filter_year_range(spark, sf_dir):
    """F3."""
    return clean.keep_years(panel(spark, sf_dir), "week_date", *YEARS).select(*KEY, "weekly_sales", "year")


@query
def filter_year(spark, sf_dir):
    """F4."""
    return clean.keep_years(panel(spark, sf_dir), "week_date", MODEL_YEAR).select(*KEY, "weekly_sales", "year")


@query
def clip_range(spark, sf_dir):
    """F5."""
    return clean.clip(panel(spark, sf_dir), "weekly_sales", CLIP_UPPER).select(*KEY, "weekly_sales")


# Joins


@query
def join_store(spark, sf_dir):
    """J1."""
    return inner_join(sales(spark, sf_dir), stores(spark, sf_dir), ["store"])


@query
def join_features(spark, sf_dir):
    """J2."""
    return inner_join(sales(spark, sf_dir), features(spark, sf_dir), ["store", "week_date", "is_holiday"])


@query
def star_merge(spark, sf_dir):
    """J3, from the given tables in one plan."""
    return plans.star_merge(
        plans.clean_sales(standin.sales(spark, sf_dir)),
        standin.stores(spark, sf_dir),
        plans.clean_features(standin.features(spark, sf_dir)),
    )


# Aggregations and distribution statistics


@query
def null_audit(spark, sf_dir):
    """A1: features, before missing markdowns are filled."""
    types = {f"markdown_{i}": "double" for i in range(1, 6)}
    return quality.missing_audit(columns.text_na_to_null(features(spark, sf_dir), types=types))


@query
def null_audit_sales(spark, sf_dir):
    """A1 on sales."""
    return quality.missing_audit(sales(spark, sf_dir))


@query
def describe_sales(spark, sf_dir):
    """A4 on sales."""
    return rounded(quality.describe(sales(spark, sf_dir)), 5, "mean", "stddev")


@query
def negative_audit(spark, sf_dir):
    """A2."""
    return rounded(quality.sign_audit(sales(spark, sf_dir), "weekly_sales"), 6, "pct_negative")


@query
def sales_summary(spark, sf_dir):
    """A3."""
    return rounded(summary.six_numbers(good_sales(spark, sf_dir), "weekly_sales", money=True), 4, "median_sales", "sd_sales")


@query
def describe_long(spark, sf_dir):
    """A4, R1, R2."""
    return rounded(quality.describe(plans.clean_features(features(spark, sf_dir))), 5, "mean", "stddev")


@query
def count_by_type(spark, sf_dir):
    """A5."""
    return summary.count_by(stores(spark, sf_dir), "store_type")


@query
def total_by_type(spark, sf_dir):
    """A6."""
    return total_by(panel(spark, sf_dir), ["store_type"], "weekly_sales")


@query
def avg_by_type(spark, sf_dir):
    """A7."""
    return mean_by(panel(spark, sf_dir), ["store_type"], "weekly_sales")


@query
def avg_by_dept(spark, sf_dir):
    """A8."""
    return mean_by(panel(spark, sf_dir), ["dept"], "weekly_sales", by_value=True)


@query
def avg_by_store(spark, sf_dir):
    """A9."""
    return mean_by(panel(spark, sf_dir), ["store"], "weekly_sales", by_value=True)


@query
def avg_by_month(spark, sf_dir):
    """A10."""
    some = clean.keep_years(panel(spark, sf_dir), "week_date", *YEARS)
    return mean_by(some, ["year", "month"], "weekly_sales")


@query
def avg_by_week(spark, sf_dir):
    """The week number also as text."""
    means = mean_by(panel(spark, sf_dir), ["year", "week_of_year"], "weekly_sales")
    return means.withColumn("week_label", F.col("week_of_year").cast("string"))


@query
def avg_by_holiday(spark, sf_dir):
    """A12."""
    return mean_by(panel(spark, sf_dir), ["is_holiday"], "weekly_sales", "mean_sales")


@query
def count_by_holiday(spark, sf_dir):
    """A13."""
    return summary.count_by(panel(spark, sf_dir), "is_holiday")


@query
def holiday_lift(spark, sf_dir):
    """A14."""
    return rounded(summary.holiday_lift(panel(spark, sf_dir), "is_holiday", "weekly_sales", money=True), 8, "pct_rows", "pct_sales", "lift")


@query
def peak_by_year_type(spark, sf_dir):
    """A15."""
    return peak_by(panel(spark, sf_dir), ["year", "store_type"], "weekly_sales")


@query
def skewness(spark, sf_dir):
    """A16."""
    return rounded(distribution.skewness(panel(spark, sf_dir), "weekly_sales"), 6, "skewness")


@query
def kurtosis(spark, sf_dir):
    """A17."""
    out = distribution.kurtosis(panel(spark, sf_dir), "weekly_sales")
    return rounded(out, 6, "excess_kurtosis", "pearson_kurtosis")


@query
def hist_bins(spark, sf_dir):
    """A18."""
    return rounded(distribution.histogram(panel(spark, sf_dir), "weekly_sales", 30), 5, "bin_start", "bin_end")


@query
def hist_width(spark, sf_dir):
    """A19."""
    return distribution.histogram_by_width(panel(spark, sf_dir), "weekly_sales", BIN_WIDTH)


@query
def density_curve(spark, sf_dir):
    """A20."""
    curve = distribution.density(panel(spark, sf_dir), "weekly_sales", CLIP_UPPER)
    return rounded(rounded(curve, 5, "x"), 12, "density")


@query
def boxplot_by_type(spark, sf_dir):
    """Store size by type, each store counting once per sales row."""
    return distribution.box_stats(panel(spark, sf_dir), ["store_type"], "store_size")


@query
def boxplot_by_type_entity(spark, sf_dir):
    """A21, each store counting once."""
    return distribution.box_stats(panel(spark, sf_dir), ["store_type"], "store_size", ["store"])


@query
def boxplot_sales_by_type(spark, sf_dir):
    """A21 on sales, which have outliers."""
    out = distribution.box_stats(panel(spark, sf_dir), ["store_type"], "weekly_sales")
    return rounded(out, 4, "q1", "median", "q3")


@query
def scatter_size(spark, sf_dir):
    """A22."""
    return binned_scatter(panel(spark, sf_dir), "store_size", "weekly_sales", 10_000, BIN_WIDTH, ["store_type"])


@query
def scatter_temperature(spark, sf_dir):
    """A23."""
    return binned_scatter(panel(spark, sf_dir), "temperature", "weekly_sales", 5, BIN_WIDTH, ["store_type"])


@query
def scatter_unemployment(spark, sf_dir):
    """A23."""
    return binned_scatter(panel(spark, sf_dir), "unemployment", "weekly_sales", 0.5, BIN_WIDTH, ["store_type"])


@query
def scatter_fuel(spark, sf_dir):
    """A23."""
    return binned_scatter(panel(spark, sf_dir), "fuel_price", "weekly_sales", 0.25, BIN_WIDTH, ["store_type"])


@query
def scatter_week(spark, sf_dir):
    """A24."""
    weeks = panel(spark, sf_dir).withColumn("week_block", calendar.week_block(F.col("week_date")))
    return binned_scatter(weeks, "week_block", "weekly_sales", 1, BIN_WIDTH, ["store_type"])


@query
def band_temperature(spark, sf_dir):
    """A25."""
    return mean_by_band(panel(spark, sf_dir), "temperature", "weekly_sales", TEMPERATURE_BANDS)


@query
def band_unemployment(spark, sf_dir):
    """A25."""
    return mean_by_band(panel(spark, sf_dir), "unemployment", "weekly_sales", UNEMPLOYMENT_BANDS, ["store_type"])


@query
def band_fuel(spark, sf_dir):
    """A25."""
    return mean_by_band(panel(spark, sf_dir), "fuel_price", "weekly_sales", FUEL_BANDS)


@query
def corr_matrix(spark, sf_dir):
    """A26."""
    return rounded(correlation.correlation_matrix(panel(spark, sf_dir)), 6, "r")


@query
def corr_upper(spark, sf_dir):
    """A27."""
    return rounded(correlation.correlation_matrix(panel(spark, sf_dir), upper=True), 6, "r")


@query
def corr_missing(spark, sf_dir):
    """A26 on features whose missing markdowns are left missing."""
    types = {f"markdown_{i}": "double" for i in range(1, 6)}
    typed = columns.text_na_to_null(features(spark, sf_dir), types=types)
    return rounded(correlation.correlation_matrix(typed, upper=True), 6, "r")


@query
def corr_fpc_order(spark, sf_dir):
    """A28."""
    return rounded(correlation.first_component_order(panel(spark, sf_dir)), 5, "loading")


@query
def feature_screen(spark, sf_dir):
    """A29."""
    return rounded(correlation.screen_features(panel(spark, sf_dir), "weekly_sales", threshold=0.02), 6, "r")


@query
def distinct_types(spark, sf_dir):
    """A30."""
    return quality.distinct_values(panel(spark, sf_dir), "store_type")


@query
def value_range(spark, sf_dir):
    """A31."""
    return quality.value_range(panel(spark, sf_dir), "weekly_sales")


# Shares, peaks, top-k


@query
def share_by_type(spark, sf_dir):
    """W1."""
    return rounded(summary.share_by(panel(spark, sf_dir), "store_type"), 8, "pct")


@query
def peak_week_per_year(spark, sf_dir):
    """W2."""
    means = mean_by(panel(spark, sf_dir), ["year", "week_of_year"], "weekly_sales")
    return summary.best_in_group(means, ["year"], "week_of_year", "avg_sales")


@query
def low_month_per_year(spark, sf_dir):
    """W3."""
    means = mean_by(panel(spark, sf_dir), ["year", "month"], "weekly_sales")
    return summary.best_in_group(means, ["year"], "month", "avg_sales", lowest=True)


@query
def order_by_mean(spark, sf_dir):
    """O3."""
    return summary.order_by_mean(panel(spark, sf_dir), "store", "weekly_sales", money=True)


@query
def top_depts(spark, sf_dir):
    """O4."""
    means = mean_by(panel(spark, sf_dir), ["dept"], "weekly_sales")
    return summary.top_k(means, "avg_sales", ["dept"])


@query
def top_stores(spark, sf_dir):
    """O4."""
    means = mean_by(panel(spark, sf_dir), ["store"], "weekly_sales")
    return summary.top_k(means, "avg_sales", ["store"])


# Unions and reshaping


@query
def union_folds(spark, sf_dir):
    """The training rows of fold 1 as the union of the other folds."""
    rows = with_fold(sales(spark, sf_dir), 5, KEY)
    train = reshape.stack_rows(*[rows.where(F.col("fold") == i) for i in range(2, 6)])
    return train.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), columns.money_sum(F.col("weekly_sales")).alias("total_sales")
    )


@query
def union_with_id(spark, sf_dir):
    """U2, P24."""
    rows = panel(spark, sf_dir)
    return reshape.stack_with_id(
        {
            "mean": mean_by(rows, ["store_type"], "weekly_sales"),
            "peak": peak_by(rows, ["store_type"], "weekly_sales"),
        }
    )


@query
def unpivot_metrics(spark, sf_dir):
    """R1."""
    peaks = peak_by(panel(spark, sf_dir), ["store_type"], "weekly_sales")
    return reshape.to_long(peaks, ["store_type"], ["peak_sales", "total_sales"])


@query
def pivot_stats(spark, sf_dir):
    """R2."""
    means = mean_by(panel(spark, sf_dir), ["store_type", "year"], "weekly_sales")
    return reshape.to_wide(means.withColumn("year", F.format_string("y%d", "year")), ["store_type"], "year", "avg_sales")


# Models


@query
def model_table(spark, sf_dir):
    """M1."""
    return plans.model_table(panel(spark, sf_dir), MODEL_YEAR)


@query
def split_counts(spark, sf_dir):
    """M2: the sizes of the split by row content, all sales."""
    parts = sales(spark, sf_dir).withColumn("part", part_name(WEIGHTS, KEY))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), columns.money_sum(F.col("weekly_sales")).alias("total_sales")
    )


@query
def kfold_counts(spark, sf_dir):
    """M16."""
    return with_fold(sales(spark, sf_dir), 5, KEY).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query
def regression_metrics(spark, sf_dir):
    """M10 on the predictor that gives each department its mean."""
    rows = panel(spark, sf_dir).select("dept", "weekly_sales")
    means = mean_by(rows, ["dept"], "weekly_sales", "prediction")
    out = metrics.regression_metrics(attach_stats(rows, means, ["dept"]), "weekly_sales")
    return rounded(rounded(out, 4, "rmse"), 8, "r_squared")


def model_parts(spark, sf_dir, keep_key: bool = False) -> dict[str, DataFrame]:
    """Train and test rows of the model table, split by the panel's key."""
    year = clean.keep_years(panel(spark, sf_dir), "week_date", MODEL_YEAR)
    drop = ["temperature", "fuel_price", "store_type", "cpi", "month", "unemployment"]
    drop += [] if keep_key else ["week_date"]
    return {name: plans.model_table(part, MODEL_YEAR, drop=drop) for name, part in split(year, WEIGHTS, KEY).items()}


@once
def _fitted(spark, sf_dir) -> dict[str, models.Fit]:
    return {}


def _kept_parts(spark, sf_dir, *names: str) -> dict[str, DataFrame]:
    """The named model parts with their key, computed once for a query that reads them several times."""
    year = clean.keep_years(panel(spark, sf_dir), "week_date", MODEL_YEAR).withColumn("part", part_name(WEIGHTS, KEY))
    drop = ["temperature", "fuel_price", "store_type", "cpi", "month", "unemployment"]
    table = saved(plans.model_table(year.where(F.col("part").isin(*names)), MODEL_YEAR, drop=drop), "model_rows")
    return {name: table.where(F.col("part") == name).drop("part") for name in names}


def _fits(spark, sf_dir, *kinds: str, train: DataFrame | None = None) -> dict[str, models.Fit]:
    """The asked models, fitted on the training rows unless they are already."""
    done = _fitted(spark, sf_dir)
    kinds = kinds or tuple(models.ESTIMATORS)
    if missing := [k for k in kinds if k not in done]:
        done |= models.fit_all(model_parts(spark, sf_dir)["train"] if train is None else train, "weekly_sales", missing)
    return {k: done[k] for k in kinds}


def _metrics(spark, sf_dir, kind) -> DataFrame:
    return models.compute_metrics(_fits(spark, sf_dir, kind)[kind], model_parts(spark, sf_dir)["test"])


@query
def ml_linear_metrics(spark, sf_dir):
    """M4."""
    return rounded(rounded(_metrics(spark, sf_dir, "linear"), 3, "rmse"), 7, "r_squared")


@query
def ml_linear_coefficients(spark, sf_dir):
    """M4: the fitted equation."""
    table = models.linear_summary(_fits(spark, sf_dir, "linear")["linear"], spark)
    return rounded(table.select("term", "coefficient"), 4, "coefficient")


@query
def ml_linear_one_feature(spark, sf_dir):
    """M4 with sales on store size alone."""
    f = models.fit(panel(spark, sf_dir), "weekly_sales", "linear", ["store_size"])
    terms = {"slope": float(f.model.coefficients[0]), "intercept": float(f.model.intercept)}
    out = models.compute_metrics(f, panel(spark, sf_dir)).select("r_squared")
    out = out.select(*[F.lit(v).alias(c) for c, v in terms.items()], "r_squared")
    return rounded(rounded(out, 8, "slope", "r_squared"), 3, "intercept")


@query
def ml_linear_formula(spark, sf_dir):
    """M3: the model as the formula `y ~ . - a`."""
    parts = model_parts(spark, sf_dir)
    f = models.fit(parts["train"], "weekly_sales ~ . - week_of_year")
    return rounded(rounded(models.compute_metrics(f, parts["test"]), 3, "rmse"), 7, "r_squared")


@query
def ml_linear_errors(spark, sf_dir):
    """M8: standard errors and t values."""
    table = models.linear_summary(_fits(spark, sf_dir, "linear")["linear"], spark).where("term != '(intercept)'")
    return rounded(rounded(table.select("term", "std_error", "t_value"), 4, "std_error"), 5, "t_value")


@query
def ml_linear_summary(spark, sf_dir):
    """M8."""
    return models.linear_summary(_fits(spark, sf_dir, "linear")["linear"], spark)


@query
def ml_forest_metrics(spark, sf_dir):
    """M5."""
    return _metrics(spark, sf_dir, "forest")


@query
def ml_gbt_metrics(spark, sf_dir):
    """M6."""
    return _metrics(spark, sf_dir, "gbt")


@query
def ml_tree_metrics(spark, sf_dir):
    """M7."""
    return _metrics(spark, sf_dir, "tree")


@query
def ml_model_overview(spark, sf_dir):
    """M8 for all four."""
    return models.model_overview(_fits(spark, sf_dir), spark)


@query
def compute_metrics(spark, sf_dir):
    """The linear model on both parts."""
    f = _fits(spark, sf_dir, "linear")["linear"]
    scored = {name: models.compute_metrics(f, part) for name, part in model_parts(spark, sf_dir).items()}
    return rounded(rounded(reshape.stack_with_id(scored, "part"), 3, "rmse"), 7, "r_squared")


@query
def model_comparison(spark, sf_dir):
    """M12."""
    return models.compare_models(_fits(spark, sf_dir), model_parts(spark, sf_dir)["test"])


@query
def model_comparison_long(spark, sf_dir):
    """M13."""
    return reshape.to_long(model_comparison(spark, sf_dir), ["model"], ["rmse", "r_squared"])


@query
def feature_importance(spark, sf_dir):
    """M14."""
    return models.feature_importance(_fits(spark, sf_dir, "forest")["forest"], spark)


@query
def importance_compare(spark, sf_dir):
    """M15."""
    return models.compare_importance(_fits(spark, sf_dir, "forest", "gbt", "tree"), spark)


# Cross-validation


def _cross_validate(spark, sf_dir, kind, select_on="train") -> crossval.CrossValidation:
    train = model_parts(spark, sf_dir, keep_key=True)["train"]
    return crossval.cross_validate(
        train,
        "weekly_sales",
        kind,
        columns.other_columns(train, "weekly_sales", "week_date"),
        k=5,
        grid=crossval.GRIDS.get(kind),
        key=KEY,
        select_on=select_on,
    )


@once
def _cv_linear(spark, sf_dir):
    return _cross_validate(spark, sf_dir, "linear")


def _trees(spark, sf_dir, *kinds: str, train: DataFrame | None = None) -> list[crossval.CrossValidation]:
    """The asked tree learners, those not run yet in one queue on one table of vectors."""
    done = _cv_done(spark, sf_dir)
    if missing := [k for k in kinds if k not in done]:
        train = _kept_parts(spark, sf_dir, "train")["train"] if train is None else train
        features = columns.other_columns(train, "weekly_sales", "week_date")
        done |= crossval.cross_validate_all(train, "weekly_sales", {k: k for k in missing}, features, k=5, grids=crossval.GRIDS, key=KEY)
    return [done[k] for k in kinds]


@once
def _cv_done(spark, sf_dir) -> dict[str, crossval.CrossValidation]:
    return {}


def _runs(spark, sf_dir, train: DataFrame | None = None):
    return _trees(spark, sf_dir, "forest", "gbt", "tree", train=train)


@query
def cv_evals(spark, sf_dir):
    """M17 without a grid: the linear model fold by fold."""
    out = _cv_linear(spark, sf_dir).evals.select("model", "fold", "rmse", "r_squared")
    return rounded(rounded(out, 3, "rmse"), 7, "r_squared")


@query
def cv_constructor(spark, sf_dir):
    """Cross-validation that is given the learner itself."""
    train = model_parts(spark, sf_dir, keep_key=True)["train"]
    features = columns.other_columns(train, "weekly_sales", "week_date")
    run = crossval.cross_validate(train, "weekly_sales", models.linear, features, k=5, key=KEY)
    return rounded(rounded(run.evals.select("fold", "rmse", "r_squared"), 3, "rmse"), 7, "r_squared")


@query
def cv_predictions(spark, sf_dir):
    """Held-out predictions of the linear model, every training row once."""
    held_out = _cv_linear(spark, sf_dir).predictions
    return rounded(held_out.select(*KEY, "fold", "prediction"), 2, "prediction")


@query
def cv_forest(spark, sf_dir):
    """M20."""
    return _trees(spark, sf_dir, "forest")[0].evals


@query
def cv_gbt(spark, sf_dir):
    """M20."""
    return _trees(spark, sf_dir, "gbt")[0].evals


@query
def cv_tree(spark, sf_dir):
    """M20."""
    return _trees(spark, sf_dir, "tree")[0].evals


@query
def cv_tree_inner(spark, sf_dir):
    """M17 with the grid point chosen on rows the candidates were not fitted on."""
    return _cross_validate(spark, sf_dir, "tree", select_on="inner").evals


@query
def cv_results(spark, sf_dir):
    """M21."""
    return crossval.cv_results(_runs(spark, sf_dir))


@query
def cv_long(spark, sf_dir):
    """M22, O2."""
    return crossval.cv_long(crossval.cv_results(_runs(spark, sf_dir)))


@query
def cv_importance(spark, sf_dir):
    """M23."""
    return crossval.cv_importance(_runs(spark, sf_dir), spark)


@query
def cv_vs_holdout(spark, sf_dir):
    """M24."""
    parts = _kept_parts(spark, sf_dir, "train", "test")
    runs = _runs(spark, sf_dir, parts["train"])
    fits = _fits(spark, sf_dir, *[run.model for run in runs], train=parts["train"].drop("week_date"))
    results = crossval.cv_results(runs)
    return crossval.cv_vs_holdout(models.compare_models(fits, parts["test"].drop("week_date")), results)
