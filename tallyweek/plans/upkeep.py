"""Queries on tables that are kept, refreshed and followed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweek.functions.sizing import scratch_path
from tallyweek.operators import clean
from tallyweek.plans.oracles import BASE
from tallyweek.plans.queries import Query, features, good_sales, panel
from tallyweek.sources import files
from tallyweek.streaming import running

QUERIES: dict[str, Query] = {}
REFRESHED = 1998


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def refresh_year(spark, sf_dir):
    """One year of a saved panel replaced by its rows above 50,000, the other years left as they are."""
    path, rows = scratch_path(spark, "panel-refreshed"), panel(spark, sf_dir)
    files.save_table(rows, path, ["year"])
    some = clean.keep_years(rows, "week_date", REFRESHED).where("weekly_sales > 50000")
    files.save_table(some, path, ["year"], replace="partitions")
    kept = files.load_table(spark, path)
    return kept.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.min("weekly_sales").alias("min_sales"))


@query
def csv_quarantine(spark, sf_dir):
    """Features as text with planted faults; good rows and bad lines by store."""
    path = scratch_path(spark, "faulty-csv")
    rows = features(spark, sf_dir)
    field = [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in ("store", "week_date", "temperature", "markdown_1")]
    line = F.when(F.col("store") % 7 == 0, F.concat_ws(",", *field[:2], F.lit("warm"), field[3]))  # no number
    line = line.when(F.col("store") % 11 == 0, F.concat_ws(",", *field[:3]))  # a field short
    line = line.when(F.col("store") % 13 == 0, F.concat_ws(",", *field, F.lit("more")))  # a field over
    rows.select(line.otherwise(F.concat_ws(",", *field)).alias("value")).write.text(path)
    good, bad = files.read_checked(spark, path, "store int, week_date date, temperature double, markdown_1 double", header=False)
    kept = files.quarantine(bad, scratch_path(spark, "bad-lines"))
    bad_rows = kept.select(F.split_part("line", F.lit(","), F.lit(1)).cast("int").alias("store"), F.lit(0).alias("is_good"), F.lit(None).cast("double").alias("x"))
    both = good.select("store", F.lit(1).alias("is_good"), F.col("markdown_1").alias("x")).union(bad_rows)
    return both.groupBy("store", "is_good").agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("n_markdown"))


@query
def follow_weeks(spark, sf_dir):
    """A11 on micro-batches: means by week from the sums that each batch of files has left."""
    path, state = scratch_path(spark, "arriving"), scratch_path(spark, "followed")
    rows = panel(spark, sf_dir).select("year", "week_of_year", "weekly_sales")
    files.save_table(rows.repartition(6), path)
    running.follow(running.file_source(spark, path, rows.schema, files_per_batch=2), ["year", "week_of_year"], "weekly_sales", state)
    return running.summaries(spark, state, ["year", "week_of_year"]).select("year", "week_of_year", "avg_sales")


@query
def follow_audit(spark, sf_dir):
    """A1-A3 on micro-batches, by department; files that arrive later are taken in by a second run."""
    path, state = scratch_path(spark, "arriving"), scratch_path(spark, "followed")
    rows = good_sales(spark, sf_dir).select("dept", "weekly_sales")
    early = F.xxhash64("weekly_sales") % 3 == 0
    for part in (early, ~early):
        rows.where(part).repartition(4).write.mode("append").parquet(path)
        running.follow(running.file_source(spark, path, rows.schema, files_per_batch=3), ["dept"], "weekly_sales", state)
    return running.summaries(spark, state, ["dept"]).select("dept", "n_rows", "n_missing", "n_negative", "low", "high", "total_sales", "avg_sales")


_TOTAL = "CAST(sum(CAST(weekly_sales AS DECIMAL(18,2))) AS DOUBLE)"
BODIES = {
    "refresh_year": f"SELECT year, count(*) AS n, min(weekly_sales) AS min_sales FROM panel WHERE year <> {REFRESHED} OR weekly_sales > 50000 GROUP BY year",
    "csv_quarantine": "SELECT store, CASE WHEN store % 7 = 0 OR store % 11 = 0 OR store % 13 = 0 THEN 0 ELSE 1 END AS is_good, count(*) AS n, "
    "count(CASE WHEN store % 7 = 0 OR store % 11 = 0 OR store % 13 = 0 THEN NULL ELSE nullif(markdown_1, 'NA') END) AS n_markdown FROM features GROUP BY store",
    "follow_weeks": f"SELECT year, week_of_year, {_TOTAL} / count(weekly_sales) AS avg_sales FROM panel GROUP BY year, week_of_year",
    "follow_audit": f"SELECT dept, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_negative, min(weekly_sales) AS low, max(weekly_sales) AS high, "
    f"{_TOTAL} AS total_sales, {_TOTAL} / count(weekly_sales) AS avg_sales FROM clean_sales GROUP BY dept",
}

ORACLES = {name: BASE + body for name, body in BODIES.items()}
