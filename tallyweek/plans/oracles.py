"""The same queries as SQL on the given tables, to check results against."""

from __future__ import annotations

from itertools import combinations

BASE = """
WITH lines AS (
  SELECT CAST(l_suppkey AS INTEGER) AS store, l_linenumber AS dept,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS week_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_returnflag AS flag,
         CAST(l_discount AS DECIMAL(18,2)) AS discount, CAST(l_tax AS DECIMAL(18,2)) AS tax,
         CAST(l_quantity AS DECIMAL(18,2)) AS quantity
  FROM lineitem),
sales AS (
  SELECT store, dept, week_date,
         CAST(sum(CASE WHEN flag = 'R' THEN -price ELSE price END) AS DOUBLE) AS weekly_sales,
         weekofyear(week_date) IN (6, 36, 47, 52) AS is_holiday
  FROM lines GROUP BY store, dept, week_date),
stores AS (
  SELECT CAST(s_suppkey AS INTEGER) AS store,
         CASE s_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS store_type,
         CAST(30000 + 7000 * s_nationkey AS INTEGER) AS store_size
  FROM supplier),
weekly AS (
  SELECT store, week_date, count(*) AS n,
         round(30 + 500 * (CAST(sum(discount) AS DOUBLE) / count(*)), 2) AS temperature,
         round(2.5 + 25 * (CAST(sum(tax) AS DOUBLE) / count(*)), 3) AS fuel_price,
         round(120 + 2 * (CAST(sum(quantity) AS DOUBLE) / count(*)), 4) AS cpi,
         round(4 + 1.5 * CAST(sum(dept) AS DOUBLE) / count(*), 3) AS unemployment
  FROM lines GROUP BY store, week_date),
features AS (
  SELECT store, week_date, temperature, fuel_price,
         CASE WHEN n % 3 = 0 THEN 'NA' ELSE CAST(n AS VARCHAR) END AS markdown_1,
         CASE WHEN (n + 1) % 3 = 0 THEN 'NA' ELSE CAST(n * 2 AS VARCHAR) END AS markdown_2,
         CASE WHEN (n + 2) % 3 = 0 THEN 'NA' ELSE CAST(n * 3 AS VARCHAR) END AS markdown_3,
         CASE WHEN (n + 3) % 3 = 0 THEN 'NA' ELSE CAST(n * 4 AS VARCHAR) END AS markdown_4,
         CASE WHEN (n + 4) % 3 = 0 THEN 'NA' ELSE CAST(n * 5 AS VARCHAR) END AS markdown_5,
         cpi, unemployment, weekofyear(week_date) IN (6, 36, 47, 52) AS is_holiday
  FROM weekly),
typed_features AS (
  SELECT * REPLACE (
    CAST(nullif(markdown_1, 'NA') AS DOUBLE) AS markdown_1, CAST(nullif(markdown_2, 'NA') AS DOUBLE) AS markdown_2,
    CAST(nullif(markdown_3, 'NA') AS DOUBLE) AS markdown_3, CAST(nullif(markdown_4, 'NA') AS DOUBLE) AS markdown_4,
    CAST(nullif(markdown_5, 'NA') AS DOUBLE) AS markdown_5)
  FROM features),
clean_features AS (
  SELECT * REPLACE (
    coalesce(markdown_1, 0) AS markdown_1, coalesce(markdown_2, 0) AS markdown_2, coalesce(markdown_3, 0) AS markdown_3,
    coalesce(markdown_4, 0) AS markdown_4, coalesce(markdown_5, 0) AS markdown_5)
  FROM typed_features),
clean_sales AS (SELECT * FROM sales WHERE weekly_sales > 0),
merged AS (SELECT * FROM clean_sales JOIN stores USING (store) JOIN clean_features USING (store, week_date, is_holiday)),
panel AS (
  SELECT * REPLACE (CAST(is_holiday AS INTEGER) AS is_holiday),
         CASE store_type WHEN 'A' THEN CAST(1 AS DOUBLE) WHEN 'B' THEN CAST(2 AS DOUBLE) WHEN 'C' THEN CAST(3 AS DOUBLE) END AS type_numeric,
         CAST(year(week_date) AS INTEGER) AS year, CAST(month(week_date) AS INTEGER) AS month,
         CAST(weekofyear(week_date) AS INTEGER) AS week_of_year
  FROM merged)
"""

BUCKET = "CAST(('0x' || substr(md5(concat_ws('|', store, dept, week_date)), 1, 8)) AS BIGINT)"
WEEK_BLOCK = "CAST(floor((dayofyear(week_date) - 1) / 7) + 1 AS INTEGER)"
TOTAL = "CAST(sum(CAST(weekly_sales AS DECIMAL(18,2))) AS DOUBLE)"
MEAN = f"{TOTAL} / count(weekly_sales)"
MARKS = [f"markdown_{i}" for i in range(1, 6)]
MODEL_COLUMNS = "store, is_holiday, dept, weekly_sales, store_size, type_numeric, year, week_of_year"
NUMERIC = [
    "store", "is_holiday", "dept", "weekly_sales", "store_size", "temperature", "fuel_price", *MARKS,
    "cpi", "unemployment", "type_numeric", "year", "month", "week_of_year",
]


def means(keys: str, name: str = "avg_sales") -> str:
    return f"SELECT {keys}, {MEAN} AS {name} FROM panel GROUP BY {keys}"


def box(value: str, rows: str = "panel", digits: int | None = None) -> str:
    q = {n: f"quantile_cont(CAST({value} AS DOUBLE), {p})" for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    shown = {n: n if digits is None else f"round({n}, {digits})" for n in q}
    return f"""
, quarters AS (SELECT store_type, {", ".join(f"{e} AS {n}" for n, e in q.items())} FROM {rows} GROUP BY store_type),
fenced AS (SELECT r.store_type, CAST(r.{value} AS DOUBLE) AS x, q1, median, q3,
           r.{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
           FROM {rows} r JOIN quarters USING (store_type))
SELECT store_type, count(*) AS n, {shown["q1"]} AS q1, {shown["median"]} AS median, {shown["q3"]} AS q3,
       min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high,
       count(*) FILTER (NOT inside) AS n_outliers
FROM fenced GROUP BY store_type, q1, median, q3"""


def scatter(x: str, width: str) -> str:
    return f"""
SELECT store_type, CAST(floor({x} / {width}) AS BIGINT) AS x_bin, CAST(floor(weekly_sales / 9000) AS BIGINT) AS y_bin,
       count(*) AS n, {MEAN} AS avg_sales FROM panel GROUP BY 1, 2, 3"""


def bands(x: str, cases: str, by: str = "") -> str:
    return f"""
SELECT {by} CASE {cases.format(x=x)} ELSE 'other' END AS band, count(*) AS n, {TOTAL} AS total_sales, {MEAN} AS avg_sales
FROM panel GROUP BY ALL"""


def correlations(pairs, rows: str) -> str:
    parts = [f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM {rows}" for a, b in pairs]
    return " UNION ALL ".join(parts)


FEATURES = ["store", "is_holiday", "dept", "store_size", "type_numeric", "week_of_year"]


def linear(train: str, rows: str = "year_rows", tag: str = "", xs: list[str] = FEATURES) -> str:
    """CTEs that fit sales on the model features over the rows where `train` holds.

    The features are made orthogonal one after the other, which turns the
    multiple regression into single ones. Gives `scored{tag}` with the
    prediction of every row, and the numbers of each step.
    """
    out = [f"s0{tag} AS (SELECT *, {train} AS fitted, CAST(weekly_sales AS DOUBLE) AS y FROM {rows})"]
    prev = f"s0{tag}"
    for k, x in enumerate(xs, start=1):
        slopes = [f"sum(({x} - m) * z{j}) FILTER (fitted) / sum(z{j} * z{j}) FILTER (fitted) AS b{k}_{j}" for j in range(1, k)]
        coef = f"c{k}{tag}"
        out.append(
            f"{coef} AS (SELECT any_value(m) AS m{k}{''.join(', ' + s for s in slopes)} "
            f"FROM {prev}, (SELECT avg({x}) FILTER (fitted) AS m FROM {prev}))"
        )
        rest = "".join(f" - b{k}_{j} * z{j}" for j in range(1, k))
        keep = "".join(f", b{k}_{j}" for j in range(1, k))
        out.append(f"s{k}{tag} AS (SELECT p.*, m{k}{keep}, {x} - m{k}{rest} AS z{k} FROM {prev} p, {coef})")
        prev = f"s{k}{tag}"
    betas = [f"sum(y * z{k}) FILTER (fitted) / sum(z{k} * z{k}) FILTER (fitted) AS g{k}" for k in range(1, len(xs) + 1)]
    out.append(f"beta{tag} AS (SELECT avg(y) FILTER (fitted) AS my, {', '.join(betas)} FROM {prev})")
    fit = " + ".join(["my", *[f"g{k} * z{k}" for k in range(1, len(xs) + 1)]])
    out.append(f"scored{tag} AS (SELECT *, {fit} AS prediction FROM {prev}, beta{tag})")
    return ", ".join(out)


def errors(rows: str, where: str) -> str:
    return (
        f"SELECT round(sqrt(avg((y - prediction) * (y - prediction))), 3) AS rmse, "
        f"round(1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)), 7) AS r_squared "
        f"FROM {rows} WHERE {where}"
    )


def standard_errors() -> str:
    """Errors and t values: each coefficient is a sum of the orthogonal steps' slopes, whose variances add up."""
    xs, parts = FEATURES, []
    for j in range(6, 0, -1):  # c{k}_{j}: how much of step j's slope is in coefficient k
        parts.append(f"CAST(1 AS DOUBLE) AS c{j}_{j}")
        for k in range(j - 1, 0, -1):
            parts.append(f"-({' + '.join(f'b{i}_{k} * c{i}_{j}' for i in range(k + 1, j + 1))}) AS c{k}_{j}")
    norms = ", ".join(f"sum(z{j} * z{j}) AS n{j}" for j in range(1, 7))
    sums = f"sums AS (SELECT {norms}, sum((y - prediction) * (y - prediction)) / (count(*) - 7) AS s2 FROM scored WHERE fitted)"
    shares = f"shares AS (SELECT *, {', '.join(parts)} FROM beta, c1, c2, c3, c4, c5, c6)"
    rows = [
        f"SELECT '{x}' AS term, {' + '.join(f'c{k}_{j} * g{j}' for j in range(k, 7))} AS b, "
        f"sqrt(s2 * ({' + '.join(f'c{k}_{j} * c{k}_{j} / n{j}' for j in range(k, 7))})) AS e FROM shares, sums"
        for k, x in enumerate(xs, start=1)
    ]
    rows.append("SELECT 'year', NULL, NULL")
    return f", {sums}, {shares} SELECT term, round(e, 4) AS std_error, round(b / e, 5) AS t_value FROM ({' UNION ALL '.join(rows)})"


def coefficients() -> str:
    """From the orthogonal steps back to the coefficients of the features, last one first."""
    xs = FEATURES
    steps, prev = [], "beta, c1, c2, c3, c4, c5, c6"
    for k in range(6, 0, -1):
        rest = "".join(f" - k{j} * b{j}_{k}" for j in range(k + 1, 7))
        steps.append(f"w{k} AS (SELECT *, g{k}{rest} AS k{k} FROM {prev})")
        prev = f"w{k}"
    total = "".join(f" - k{k} * m{k}" for k in range(1, 7))
    rows = [f"SELECT '{x}' AS term, k{k} AS coefficient FROM w1" for k, x in enumerate(xs, start=1)]
    rows.append(f"SELECT '(intercept)', my{total} FROM w1")
    rows.append("SELECT 'year', CAST(0 AS DOUBLE)")
    return f", {', '.join(steps)} SELECT term, round(coefficient, 4) AS coefficient FROM ({' UNION ALL '.join(rows)})"


YEAR_ROWS = f", year_rows AS (SELECT *, {BUCKET} AS h FROM panel WHERE year = 1998)"
SPLIT_FIT = f"{YEAR_ROWS}, {linear('h < 3221225472')}"
FOLD_ROWS = ", fold_rows AS (SELECT *, CAST(h % 5 + 1 AS INTEGER) AS fold FROM year_rows WHERE h < 3221225472)"
FOLD_FITS = YEAR_ROWS + FOLD_ROWS + "".join(f", {linear(f'fold <> {i}', 'fold_rows', f'_{i}')}" for i in range(1, 6))

_AUDIT = ["store", "week_date", "temperature", "fuel_price", *MARKS, "cpi", "unemployment", "is_holiday"]
_NUMBERS = ["store", "temperature", "fuel_price", *MARKS, "cpi", "unemployment"]


def _describe(rows: str, numbers: list[str]) -> str:
    none_text = "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
    parts = [
        f"SELECT '{c}' AS \"column\", count({e}) AS count, round(avg({e}), 5) AS mean, round(stddev_samp({e}), 5) AS stddev, "
        f"CAST(min({e}) AS DOUBLE) AS min, CAST(max({e}) AS DOUBLE) AS max, {none_text} FROM {rows}"
        for c, e in [(c, c) for c in numbers] + [("is_holiday", "CAST(is_holiday AS INTEGER)")]
    ]
    no = "CAST(NULL AS DOUBLE)"
    parts.append(
        f"SELECT 'week_date', count(week_date), {no}, {no}, {no}, {no}, CAST(min(week_date) AS VARCHAR), "
        f"CAST(max(week_date) AS VARCHAR) FROM {rows}"
    )
    return " UNION ALL ".join(parts)


def _glimpse() -> str:
    kinds = {"store": "int", "dept": "int", "week_date": "date", "weekly_sales": "double", "is_holiday": "boolean"}
    head = ", head AS (SELECT * FROM sales ORDER BY store, dept, week_date LIMIT 5)"
    parts = [
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, "
        f"string_agg(CAST({c} AS VARCHAR), ', ' ORDER BY store, dept, week_date) AS sample FROM head"
        for i, (c, t) in enumerate(kinds.items(), start=1)
    ]
    return head + " UNION ALL ".join(parts)


def _dims(tables: dict[str, tuple[str, int]], extra: str = "") -> str:
    parts = [
        f"SELECT '{name}' AS table_name, {extra} count(*) AS n_rows, {n} AS n_cols FROM {rows}"
        for name, (rows, n) in tables.items()
    ]
    return " UNION ALL ".join(parts)


_MOMENTS = """
, m AS (SELECT avg(weekly_sales) AS mu FROM panel),
d AS (SELECT avg(pow(weekly_sales - mu, 2)) AS m2, avg(pow(weekly_sales - mu, 3)) AS m3,
             avg(pow(weekly_sales - mu, 4)) AS m4 FROM panel, m)"""

_DENSITY = """
, kept AS (SELECT weekly_sales AS x FROM panel WHERE weekly_sales <= 200000),
s AS (SELECT count(*) AS n, min(x) AS low, 0.9::DOUBLE * least(stddev_samp(x),
        (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34::DOUBLE) * pow(count(*), -0.2::DOUBLE) AS h FROM kept),
b AS (SELECT floor((x - low) / (h / 8)) AS bin, count(*) AS w, avg(x) AS center FROM kept, s GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS point, low + i * ((200000 - low) / 511) AS x FROM range(512) r(i), s)
SELECT point, round(x, 5) AS x,
       round(sum(w * exp(-pow((x - center) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 12) AS density
FROM g, b, s GROUP BY point, x"""

_ALL_PAIRS = [(a, b) for a in NUMERIC for b in NUMERIC if a != b]
_DIAGONAL = " UNION ALL ".join(f"SELECT '{c}' AS x, '{c}' AS y, CAST(1 AS DOUBLE) AS r" for c in NUMERIC)
_MISSING = ["store", "temperature", "fuel_price", *MARKS, "cpi", "unemployment"]

BODIES: dict[str, str] = {
    "src_csv_roundtrip": "SELECT * FROM typed_features",
    "load_named_table": f"SELECT store, {TOTAL} AS total_sales FROM sales GROUP BY store",
    "register_view": f"SELECT store_type, year, count(*) AS n, {TOTAL} AS total_sales FROM panel GROUP BY store_type, year",
    "list_tables": _dims(
        {"tw_listed_sales": ("sales", 5), "tw_listed_stores": ("stores", 3), "tw_listed_features": ("features", 12)},
        "true AS is_temporary,",
    ),
    "parquet_roundtrip": "SELECT * FROM panel",
    "drop_table": _dims({"tw_dropped_b": ("stores", 3)}),
    "glimpse": _glimpse(),
    "table_dims": _dims(
        {"sales": ("sales", 5), "clean_sales": ("clean_sales", 5), "stores": ("stores", 3), "features": ("features", 12), "panel": ("panel", 20)}
    ),
    "select_cols": "SELECT weekly_sales, store_size, store_type FROM panel",
    "drop_by_prefix": f"SELECT * EXCLUDE (cpi, unemployment, {', '.join(MARKS)}) FROM panel",
    "select_numeric": f"SELECT {', '.join(NUMERIC)} FROM panel",
    "enrich_calendar": "SELECT store, dept, week_date, is_holiday, type_numeric, year, month, week_of_year FROM panel",
    "fill_markdowns": "SELECT * FROM clean_features",
    "cast_date": "SELECT store, dept, week_date FROM sales",
    "bool_to_int": "SELECT store, dept, week_date, CAST(is_holiday AS INTEGER) AS is_holiday FROM sales",
    "encode_type": "SELECT *, CASE store_type WHEN 'A' THEN CAST(1 AS DOUBLE) WHEN 'B' THEN CAST(2 AS DOUBLE) "
    "WHEN 'C' THEN CAST(3 AS DOUBLE) END AS type_numeric FROM stores",
    "na_to_null": "SELECT * REPLACE (" + ", ".join(f"nullif({m}, 'NA') AS {m}" for m in MARKS) + ") FROM features",
    "week_block": f"SELECT store, dept, week_date, {WEEK_BLOCK} AS week_block, CAST(weekofyear(week_date) AS INTEGER) AS iso_week FROM sales",
    "format_labels": f"SELECT is_holiday, round({MEAN}, 2) AS rounded, printf('%.2f', {MEAN}) AS label FROM panel GROUP BY is_holiday",
    "composite_label": "SELECT concat_ws('.', store_type, year) AS label, count(*) AS n FROM panel GROUP BY 1",
    "category_order": "SELECT store, dense_rank() OVER (ORDER BY store) AS sort_key FROM (SELECT DISTINCT store FROM panel)",
    "code_lookup": "SELECT store, dept, week_date, CASE is_holiday WHEN 0 THEN 'regular week' WHEN 1 THEN 'holiday week' END AS week_kind FROM panel",
    "filter_positive": "SELECT * FROM sales WHERE weekly_sales > 0",
    "filter_not_null": "SELECT store, week_date, markdown_1 FROM typed_features WHERE markdown_1 IS NOT NULL",
    "filter_year_range": "SELECT store, dept, week_date, weekly_sales, year FROM panel WHERE year IN (1996, 1997, 1998)",
    "filter_year": "SELECT store, dept, week_date, weekly_sales, year FROM panel WHERE year = 1998",
    "clip_range": "SELECT store, dept, week_date, weekly_sales FROM panel "
    "WHERE weekly_sales BETWEEN (SELECT min(weekly_sales) FROM panel) AND 200000",
    "join_store": "SELECT * FROM sales JOIN stores USING (store)",
    "join_features": "SELECT * FROM sales JOIN features USING (store, week_date, is_holiday)",
    "star_merge": "SELECT * FROM merged",
    "null_audit": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, CAST(0 AS BIGINT) AS n_nan FROM typed_features" for c in _AUDIT
    ),
    "null_audit_sales": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, CAST(0 AS BIGINT) AS n_nan FROM sales"
        for c in ("store", "dept", "week_date", "weekly_sales", "is_holiday")
    ),
    "describe_sales": _describe("sales", ["store", "dept", "weekly_sales"]),
    "negative_audit": "SELECT count(*) FILTER (weekly_sales < 0) AS n_negative, count(*) FILTER (weekly_sales = 0) AS n_zero, "
    "count(*) AS n_rows, round(count(*) FILTER (weekly_sales < 0) / count(*) * 100, 6) AS pct_negative FROM sales",
    "sales_summary": f"SELECT count(*) AS count_sales, min(weekly_sales) AS min_sales, {MEAN} AS mean_sales, "
    "round(quantile_cont(weekly_sales, 0.5), 4) AS median_sales, max(weekly_sales) AS max_sales, "
    "round(stddev_samp(weekly_sales), 4) AS sd_sales FROM clean_sales",
    "describe_long": _describe("clean_features", _NUMBERS),
    "count_by_type": "SELECT store_type, count(*) AS n FROM stores GROUP BY store_type",
    "total_by_type": f"SELECT store_type, {TOTAL} AS total_sales FROM panel GROUP BY store_type",
    "avg_by_type": means("store_type"),
    "avg_by_dept": means("dept"),
    "avg_by_store": means("store"),
    "avg_by_month": f"SELECT year, month, {MEAN} AS avg_sales FROM panel WHERE year BETWEEN 1996 AND 1998 GROUP BY year, month",
    "avg_by_week": f"SELECT year, week_of_year, {MEAN} AS avg_sales, CAST(week_of_year AS VARCHAR) AS week_label "
    "FROM panel GROUP BY year, week_of_year",
    "avg_by_holiday": means("is_holiday", "mean_sales"),
    "count_by_holiday": "SELECT is_holiday, count(*) AS n FROM panel GROUP BY is_holiday",
    "holiday_lift": f", t AS (SELECT is_holiday, count(*) AS n, {TOTAL} AS s FROM panel GROUP BY is_holiday), "
    "a AS (SELECT * FROM t WHERE is_holiday = 1), b AS (SELECT * FROM t WHERE is_holiday = 0) "
    "SELECT a.n AS n_holiday, a.n + b.n AS n_rows, round(a.n / (a.n + b.n) * 100, 8) AS pct_rows, "
    "round(a.s / (a.s + b.s) * 100, 8) AS pct_sales, a.s / a.n AS mean_holiday, b.s / b.n AS mean_other, "
    "round((a.s / a.n) / (b.s / b.n), 8) AS lift FROM a, b",
    "peak_by_year_type": f"SELECT year, store_type, max(weekly_sales) AS peak_sales, {TOTAL} AS total_sales FROM panel GROUP BY year, store_type",
    "skewness": f"{_MOMENTS} SELECT round(m3 / pow(m2, 1.5), 6) AS skewness FROM d",
    "kurtosis": f"{_MOMENTS} SELECT round(m4 / (m2 * m2) - 3, 6) AS excess_kurtosis, round(m4 / (m2 * m2), 6) AS pearson_kurtosis FROM d",
    "hist_bins": ", r AS (SELECT min(weekly_sales) AS low, (max(weekly_sales) - min(weekly_sales)) / 30 AS w FROM panel), "
    "c AS (SELECT CAST(least(floor((weekly_sales - low) / w), 29) + 1 AS INTEGER) AS bin, count(*) AS n FROM panel, r GROUP BY 1) "
    "SELECT CAST(i AS INTEGER) AS bin, round(low + (i - 1) * w, 5) AS bin_start, round(low + i * w, 5) AS bin_end, "
    "coalesce(n, 0) AS n FROM range(1, 31) g(i) CROSS JOIN r LEFT JOIN c ON c.bin = i",
    "hist_width": "SELECT CAST(floor(weekly_sales / 9000) AS BIGINT) AS bin, CAST(floor(weekly_sales / 9000) * 9000 AS DOUBLE) AS bin_start, "
    "count(*) AS n FROM panel GROUP BY 1, 2",
    "density_curve": _DENSITY,
    "boxplot_by_type": box("store_size"),
    "boxplot_by_type_entity": ", entity AS (SELECT DISTINCT store_type, store, store_size FROM panel)" + box("store_size", "entity"),
    "boxplot_sales_by_type": box("weekly_sales", digits=4),
    "scatter_size": scatter("store_size", "10000"),
    "scatter_temperature": scatter("temperature", "5"),
    "scatter_unemployment": scatter("unemployment", "0.5::DOUBLE"),
    "scatter_fuel": scatter("fuel_price", "0.25::DOUBLE"),
    "scatter_week": scatter(WEEK_BLOCK, "1"),
    "band_temperature": bands("temperature", "WHEN {x} <= 40 THEN 'below 40' WHEN {x} BETWEEN 40 AND 80 THEN '40-80' WHEN {x} > 80 THEN 'above 80'"),
    "band_unemployment": bands("unemployment", "WHEN {x} BETWEEN 8 AND 10 THEN '8-10' WHEN {x} > 11 THEN 'above 11'", "store_type,"),
    "band_fuel": bands("fuel_price", "WHEN {x} BETWEEN 2.75 AND 3.75 THEN '2.75-3.75' WHEN {x} > 4.25 THEN 'above 4.25'"),
    "corr_matrix": correlations(_ALL_PAIRS, "panel") + " UNION ALL " + _DIAGONAL,
    "corr_upper": correlations(combinations(NUMERIC, 2), "panel") + " UNION ALL " + _DIAGONAL,
    "corr_missing": correlations(combinations(_MISSING, 2), "typed_features")
    + "".join(f" UNION ALL SELECT '{c}', '{c}', CAST(1 AS DOUBLE)" for c in _MISSING),
    "feature_screen": ", f AS ("
    + correlations([(c, "weekly_sales") for c in NUMERIC if c != "weekly_sales"], "panel")
    + ") SELECT x AS feature, r, abs(r) >= 0.02 AS keep FROM f",
    "distinct_types": "SELECT DISTINCT store_type FROM panel",
    "value_range": "SELECT min(weekly_sales) AS min_value, max(weekly_sales) AS max_value FROM panel",
    "share_by_type": "SELECT store_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM panel) * 100, 8) AS pct FROM panel GROUP BY store_type",
    "peak_week_per_year": f", t AS ({means('year, week_of_year')}), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY avg_sales DESC, week_of_year) AS rn FROM t) "
    "SELECT year, week_of_year, avg_sales FROM k WHERE rn = 1",
    "low_month_per_year": f", t AS ({means('year, month')}), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY avg_sales, month) AS rn FROM t) "
    "SELECT year, month, avg_sales FROM k WHERE rn = 1",
    "order_by_mean": f", t AS ({means('store', 'mean_value')}) SELECT store, mean_value, row_number() OVER (ORDER BY mean_value, store) AS rank FROM t",
    "top_depts": means("dept") + " ORDER BY avg_sales DESC, dept LIMIT 5",
    "top_stores": means("store") + " ORDER BY avg_sales DESC, store LIMIT 5",
    "union_folds": f"SELECT CAST({BUCKET} % 5 + 1 AS INTEGER) AS fold, count(*) AS n, {TOTAL} AS total_sales FROM sales "
    f"WHERE {BUCKET} % 5 <> 0 GROUP BY 1",
    "union_with_id": f"SELECT store_type, {MEAN} AS avg_sales, CAST(NULL AS DOUBLE) AS peak_sales, CAST(NULL AS DOUBLE) AS total_sales, "
    "'mean' AS source FROM panel GROUP BY store_type "
    f"UNION ALL SELECT store_type, NULL, max(weekly_sales), {TOTAL}, 'peak' FROM panel GROUP BY store_type",
    "unpivot_metrics": "SELECT store_type, 'peak_sales' AS metric, max(weekly_sales) AS value FROM panel GROUP BY store_type "
    f"UNION ALL SELECT store_type, 'total_sales', {TOTAL} FROM panel GROUP BY store_type",
    "pivot_stats": f", t AS ({means('store_type, year')}) SELECT store_type, "
    + ", ".join(f"max(avg_sales) FILTER (year = {y}) AS y{y}" for y in range(1995, 2002))
    + " FROM t GROUP BY store_type",
    "model_table": f"SELECT {MODEL_COLUMNS} FROM panel WHERE year = 1998",
    "split_counts": f"SELECT CASE WHEN {BUCKET} < 3221225472 THEN 'train' ELSE 'test' END AS part, count(*) AS n, {TOTAL} AS total_sales FROM sales GROUP BY 1",
    "kfold_counts": f"SELECT CAST({BUCKET} % 5 + 1 AS INTEGER) AS fold, count(*) AS n FROM sales GROUP BY 1",
    "regression_metrics": f", m AS ({means('dept', 'prediction')}), "
    "e AS (SELECT weekly_sales AS y, prediction FROM panel JOIN m USING (dept)) "
    "SELECT round(sqrt(avg(pow(y - prediction, 2))), 4) AS rmse, "
    "round(1 - avg(pow(y - prediction, 2)) / var_pop(y), 8) AS r_squared FROM e",
    "ml_linear_one_feature": "SELECT round(regr_slope(weekly_sales, store_size), 8) AS slope, "
    "round(regr_intercept(weekly_sales, store_size), 3) AS intercept, round(regr_r2(weekly_sales, store_size), 8) AS r_squared FROM panel",
    "ml_linear_metrics": SPLIT_FIT + errors("scored", "NOT fitted"),
    "ml_linear_coefficients": SPLIT_FIT + coefficients(),
    "ml_linear_errors": SPLIT_FIT + standard_errors(),
    "ml_linear_formula": f"{YEAR_ROWS}, {linear('h < 3221225472', xs=FEATURES[:-1])}" + errors("scored", "NOT fitted"),
    "cv_constructor": FOLD_FITS
    + " UNION ALL ".join(f"SELECT {i} AS fold, * FROM ({errors(f'scored_{i}', 'NOT fitted')})" for i in range(1, 6)),
    "compute_metrics": SPLIT_FIT
    + f"SELECT *, 'train' AS part FROM ({errors('scored', 'fitted')}) UNION ALL SELECT *, 'test' FROM ({errors('scored', 'NOT fitted')})",
    "cv_evals": FOLD_FITS
    + " UNION ALL ".join(
        f"SELECT 'linear' AS model, {i} AS fold, * FROM ({errors(f'scored_{i}', 'NOT fitted')})" for i in range(1, 6)
    ),
    "cv_predictions": FOLD_FITS
    + " UNION ALL ".join(
        f"SELECT store, dept, week_date, fold, round(prediction, 2) AS prediction FROM scored_{i} WHERE NOT fitted"
        for i in range(1, 6)
    ),
}

ORACLES = {name: BASE + body for name, body in BODIES.items()}
