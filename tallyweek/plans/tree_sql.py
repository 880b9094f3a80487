"""Regression trees, boosting, grids and a first component as SQL, to check the learners against.

A split is the threshold with the largest fall of the squared error, among the midpoints between
neighbouring values of all training rows; the first feature and threshold win ties. That
is what a tree learner does whose features have no more values than it has bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from tallyweek.plans.oracles import BODIES as ORIGINALS
from tallyweek.plans.oracles import BASE, FOLD_ROWS, NUMERIC, YEAR_ROWS, errors, linear

SMALL = ["is_holiday", "dept", "store_size"]
INNER = "CAST(('0x' || substr(md5(concat_ws('|', '1', store, dept, week_date)), 1, 8)) AS BIGINT) % 5 = 0"


def tree(tag: str, rows: str, where: str, y: str = "CAST(weekly_sales AS DOUBLE)", depth: int = 2, xs: Sequence[str] = SMALL) -> str:
    """CTEs `{tag}_0`..: all rows with their node after each level; `{tag}_s{level}` the splits; `{tag}` the rows with a prediction for each depth, pred1..."""

    def values(source: str, keys: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {keys} {i} AS f, CAST({x} AS DOUBLE) AS v, count(*) AS n, sum(y) AS s FROM {source} WHERE fitted GROUP BY ALL" for i, x in enumerate(xs)
        )

    out = [
        f"{tag}_0 AS MATERIALIZED (SELECT * EXCLUDE (fitted, y), fitted, y, 1 AS node FROM (SELECT *, {where} AS fitted, {y} AS y FROM {rows}))",
        f"{tag}_t AS MATERIALIZED (SELECT f, v, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS thr FROM ({values(f'{tag}_0', '')}))",
    ]
    pick = "CASE b.f " + " ".join(f"WHEN {i} THEN CAST({x} AS DOUBLE)" for i, x in enumerate(xs)) + " END"
    for level in range(depth):
        here = f"{tag}_{level}"
        gain = "sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n"
        out += [
            f"{tag}_v{level} AS MATERIALIZED (SELECT node, f, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER p AS n, sum(s) OVER p AS s "
            f"FROM ({values(here, 'node,')}) WINDOW w AS (PARTITION BY node, f ORDER BY v), p AS (PARTITION BY node, f))",
            f"{tag}_s{level} AS MATERIALIZED (SELECT node, f, thr, n, {gain} AS gain FROM {tag}_v{level} JOIN {tag}_t USING (f, v) WHERE nl < n AND {gain} > 0 "
            f"QUALIFY row_number() OVER (PARTITION BY node ORDER BY {gain} DESC, f, thr) = 1)",
            f"{tag}_{level + 1} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN b.f IS NULL THEN r.node ELSE 2 * r.node + CAST({pick} > b.thr AS INTEGER) END AS node) "
            f"FROM {here} r LEFT JOIN {tag}_s{level} b USING (node))",
        ]
        out.append(f"{tag}_p{level + 1} AS MATERIALIZED (SELECT node, avg(y) AS pred{level + 1} FROM {tag}_{level + 1} WHERE fitted GROUP BY node)")
    # A row's prediction at each depth goes by the node it had there.
    joins = "".join(f" JOIN {tag}_p{d} ON {tag}_p{d}.node = {_node_at(d, depth)}" for d in range(1, depth + 1))
    preds = ", ".join(f"pred{d}" for d in range(1, depth + 1))
    out.append(f"{tag} AS MATERIALIZED (SELECT r.*, {preds}, pred{depth} AS prediction FROM {tag}_{depth} r{joins})")
    return ", ".join(out)


def _node_at(level: int, depth: int) -> str:
    """The node that a row had after `level` splits; one that is split no more keeps its number, which is then below 2 ** level * 2."""
    cases = " ".join(f"WHEN r.node < {2 ** (level + 1 + up)} THEN r.node // {2 ** up}" for up in range(depth - level + 1))
    return f"CASE {cases} END"


def boosted(tag: str, rows: str, where: str) -> str:
    """CTEs of two rounds: a tree, and a tenth of a tree on twice what is left."""
    first = tree(f"{tag}a", rows, where)
    left = f"(SELECT * EXCLUDE (fitted, node, y, pred1, pred2, prediction), prediction AS before FROM {tag}a)"
    second = tree(f"{tag}b", left, where, "2 * (CAST(weekly_sales AS DOUBLE) - before)")
    final = f"{tag} AS MATERIALIZED (SELECT * REPLACE (before + CAST(0.1 AS DOUBLE) * prediction AS prediction, CAST(weekly_sales AS DOUBLE) AS y) FROM {tag}b)"
    return f"{first}, {second}, {final}"


def importance(*tags: str, model: str) -> str:
    """Share of each feature in the gains of all splits."""
    splits = " UNION ALL ".join(f"SELECT f, gain FROM {t}_s{level}" for t in tags for level in (0, 1))
    names = ", ".join(f"({i}, '{x}')" for i, x in enumerate(SMALL))
    return (
        f"SELECT feature, '{model}' AS model, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM ({splits})), 8) AS importance "
        f"FROM (VALUES {names}) n(f, feature) LEFT JOIN ({splits}) USING (f) GROUP BY feature"
    )


def nodes(tag: str) -> str:
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(SMALL)) + " END"
    split = " UNION ALL ".join(f"SELECT node, {names} AS feature, thr AS threshold, CAST(NULL AS DOUBLE) AS prediction FROM {tag}_s{level}" for level in (0, 1))
    return f"{split} UNION ALL SELECT node, NULL, NULL, round(pred2, 4) FROM {tag}_p2"


HELD = "NOT fitted"
TRAIN = "h < 3221225472"
_TREE = f"{YEAR_ROWS}, {tree('t', 'year_rows', TRAIN)}"
_GBT = f"{YEAR_ROWS}, {boosted('g', 'year_rows', TRAIN)}"
_ALL = f"{_TREE}, {boosted('g', 'year_rows', TRAIN)}, {linear(TRAIN, xs=SMALL)}"
_MODELS = {"MLR": "scored", "Random Forest": "t", "Gradient Boosted Tree": "g", "Decision Tree": "t"}
_COMPARED = " UNION ALL ".join(f"SELECT '{m}' AS model, * FROM ({errors(t, HELD)})" for m, t in _MODELS.items())
_IMPORTANCES = " UNION ALL ".join(
    [importance("t", model="Random Forest"), importance("ga", "gb", model="Gradient Boosted Tree"), importance("t", model="Decision Tree")]
)


def _predictions(tag: str) -> str:
    return f"SELECT store, dept, week_date, round(prediction, 4) AS prediction FROM {tag} WHERE NOT fitted"


def _rmse(tag: str, depth: int, where: str) -> str:
    return f"SELECT {depth} AS max_depth, sqrt(avg((weekly_sales - pred{depth}) * (weekly_sales - pred{depth}))) AS e FROM {tag} WHERE {where}"


def grid(inner: bool) -> str:
    """CTE `evals`: of each fold the chosen depth, 1 or 2, with its scores on the fold and the RMSE it was chosen by."""
    parts = [YEAR_ROWS + FOLD_ROWS.replace("AS (SELECT *,", f"AS (SELECT *, {INNER} AS aside,")]
    rows = []
    for i in range(1, 6):
        parts.append(tree(f"f{i}", "fold_rows", f"fold <> {i}"))
        chosen_on, where = f"f{i}", "fitted"
        if inner:
            parts.append(tree(f"i{i}", "fold_rows", f"fold <> {i} AND NOT aside"))
            chosen_on, where = f"i{i}", f"fold <> {i} AND aside"
        scores = [f"SELECT {i} AS fold, * FROM ({_rmse(chosen_on, d, where)})" for d in (1, 2)]
        parts.append(f"c{i} AS (SELECT * FROM ({' UNION ALL '.join(scores)}) QUALIFY row_number() OVER (ORDER BY e, max_depth) = 1)")
        y, p = "CAST(weekly_sales AS DOUBLE)", "CASE c.max_depth WHEN 1 THEN pred1 ELSE pred2 END"
        rows.append(
            f"SELECT 'tree' AS model, {i} AS fold, any_value(c.max_depth) AS max_depth, any_value(c.e) AS select_rmse, sqrt(avg(pow({y} - {p}, 2))) AS rmse, "
            f"1 - sum(pow({y} - {p}, 2)) / (var_pop({y}) * count(*)) AS r_squared FROM f{i}, c{i} c WHERE NOT fitted"
        )
    parts.append(f"evals AS MATERIALIZED ({' UNION ALL '.join(rows)})")
    return ", ".join(parts)


_SHOWN = "SELECT model, fold, max_depth, round(select_rmse, 3) AS select_rmse, round(rmse, 3) AS rmse, round(r_squared, 7) AS r_squared FROM evals"

RIDGE = [0.0, 3000.0, 30000.0]


def _ridge() -> str:
    """The grid of a ridge regression on two features, by normal equations in units of standard deviations.

    The penalty is measured in standard deviations of the label; the point is chosen on the inner part.
    """
    a, b, y = "CAST(store_size AS DOUBLE)", "CAST(dept AS DOUBLE)", "CAST(weekly_sales AS DOUBLE)"
    parts = [YEAR_ROWS + FOLD_ROWS.replace("AS (SELECT *,", f"AS (SELECT *, {INNER} AS aside,")]
    lambdas = ", ".join(f"(CAST({x} AS DOUBLE))" for x in RIDGE)

    def fitted(tag: str, where: str) -> str:
        sums = (
            f"SELECT avg({a}) AS ma, avg({b}) AS mb, avg({y}) AS my, stddev_pop({a}) AS sa, stddev_pop({b}) AS sb, stddev_pop({y}) AS sy, "
            f"corr({a}, {b}) AS rab, corr({a}, {y}) AS ra, corr({b}, {y}) AS rb FROM fold_rows WHERE {where}"
        )
        d = "1 + l / sy"
        return (
            f"{tag} AS MATERIALIZED (SELECT l, ma, mb, my, (({d}) * ra - rab * rb) / (({d}) * ({d}) - rab * rab) * sy / sa AS ka, "
            f"(({d}) * rb - rab * ra) / (({d}) * ({d}) - rab * rab) * sy / sb AS kb FROM ({sums}), (VALUES {lambdas}) g(l))"
        )

    e = f"{y} - (my + ka * ({a} - ma) + kb * ({b} - mb))"
    rows = []
    for i in range(1, 6):
        parts += [
            fitted(f"o{i}", f"fold <> {i}"), fitted(f"n{i}", f"fold <> {i} AND NOT aside"),
            f"c{i} AS (SELECT l, sqrt(avg(pow({e}, 2))) AS chosen FROM fold_rows, n{i} WHERE fold <> {i} AND aside GROUP BY l "
            f"QUALIFY row_number() OVER (ORDER BY sqrt(avg(pow({e}, 2))), l) = 1)",
        ]
        rows.append(
            f"SELECT {i} AS fold, any_value(l) AS reg_param, round(any_value(chosen), 3) AS select_rmse, round(sqrt(avg(pow({e}, 2))), 3) AS rmse, "
            f"round(1 - sum(pow({e}, 2)) / (var_pop({y}) * count(*)), 7) AS r_squared FROM fold_rows, c{i} JOIN o{i} USING (l) WHERE fold = {i}"
        )
    return ", ".join(parts) + " " + " UNION ALL ".join(rows)


def _component() -> str:
    """The first principal component by 3,000 power steps on the matrix of correlations."""
    rows = ", ".join("[" + ", ".join("CAST(1 AS DOUBLE)" if a == b else f"corr({a}, {b})" for b in NUMERIC) + "]" for a in NUMERIC)
    start = ", ".join(f"CAST({1 + i / 10} AS DOUBLE)" for i in range(len(NUMERIC)))
    names = ", ".join(f"'{c}'" for c in NUMERIC)
    return f"""
, m AS MATERIALIZED (SELECT [{rows}] AS r FROM panel),
power AS (
  SELECT 0 AS k, [{start}] AS v
  UNION ALL
  SELECT k + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) FROM (
    SELECT k, list_transform(r, lambda a: list_dot_product(a, v)) AS w FROM power, m WHERE k < 3000)),
last AS (SELECT v, list_reduce(v, lambda a, b: CASE WHEN abs(b) > abs(a) THEN b ELSE a END) AS top FROM power WHERE k = 3000),
loads AS (SELECT unnest([{names}]) AS "column", unnest(v) * sign(top) AS loading FROM last)
SELECT CAST(row_number() OVER (ORDER BY round(loading, 9), "column") AS INTEGER) AS position, "column", round(loading, 5) AS loading FROM loads"""


def _bags() -> str:
    """How many rows get each weight in each of three trees: the hash against the cumulated chances."""
    parts = []
    for number in range(3):
        at = f"CAST(('0x' || substr(md5(concat_ws('|', '{1234 + number}', store, dept, week_date)), 1, 8)) AS BIGINT)"
        cases, chance, terms = [], "exp(CAST(-1 AS DOUBLE))", []
        for weight in range(12):
            terms.append(f"{chance} / CAST(factorial({weight}) AS DOUBLE)")
            cases.append(f"WHEN {at} < ({' + '.join(terms)}) * 4294967296 THEN {weight}")
        parts.append(f"SELECT {number} AS tree, CAST(CASE {' '.join(cases)} ELSE 12 END AS INTEGER) AS weight, count(*) AS n FROM year_rows WHERE {TRAIN} GROUP BY ALL")
    return YEAR_ROWS + " " + " UNION ALL ".join(parts)


BODIES = {
    "tree_predictions": f"{_TREE} {_predictions('t')}",
    "forest_predictions": f"{_TREE} {_predictions('t')}",
    "gbt_predictions": f"{_GBT} {_predictions('g')}",
    "tree_nodes": f"{_TREE} {nodes('t')}",
    "small_comparison": f"{_ALL} {_COMPARED}",
    "small_comparison_long": f"{_ALL}, compared AS ({_COMPARED}) SELECT model, 'rmse' AS metric, rmse AS value FROM compared UNION ALL SELECT model, 'r_squared', r_squared FROM compared",
    "small_importance": f"{_TREE} SELECT feature, importance FROM ({importance('t', model='x')})",
    "small_importance_compare": f"{_ALL}, i AS ({_IMPORTANCES}) SELECT feature, model, importance, round(avg(importance) OVER (PARTITION BY feature), 6) AS mean_importance FROM i",
    "grid_tree": f"{grid(False)} {_SHOWN}",
    "grid_tree_inner": f"{grid(True)} {_SHOWN}",
    "grid_long": f"{grid(True)}, v AS (SELECT 'Decision Tree' AS model, fold, rmse, r_squared FROM evals), "
    "l AS (SELECT model, fold, 'rmse' AS metric, rmse AS value FROM v UNION ALL SELECT model, fold, 'r_squared', r_squared FROM v) "
    "SELECT model, fold, metric, round(value, 6) AS value, concat_ws('.', model, fold) AS axis, printf('%.2f', round(value, 2) + 0) AS value_label FROM l",
    "grid_importance": f"{grid(False)}, i AS ("
    + " UNION ALL ".join(f"SELECT *, {i} AS fold FROM ({importance(f'f{i}', model='Decision Tree')})" for i in range(1, 6))
    + ") SELECT feature, model, fold, importance, round(avg(importance) OVER (PARTITION BY feature), 6) AS mean_importance FROM i",
    "grid_vs_holdout": f"{grid(True)}, {tree('t', 'year_rows', TRAIN)} SELECT 'Decision Tree' AS model, h.rmse AS holdout_rmse, h.r_squared AS holdout_r_squared, "
    "round(avg(e.rmse), 3) AS cv_rmse_mean, round(stddev_samp(e.rmse), 3) AS cv_rmse_sd, round(avg(e.r_squared), 7) AS cv_r_squared_mean "
    f"FROM evals e, ({errors('t', HELD)}) h GROUP BY h.rmse, h.r_squared",
    "grid_ridge": _ridge(),
    "saved_model_metrics": ORIGINALS["ml_linear_metrics"],
    "saved_grid": f"{grid(True)} {_SHOWN}",
    "cv_native": ORIGINALS["cv_constructor"],
    "corr_fpc_order": _component(),
    "forest_bags": _bags(),
}

ORACLES = {name: (BASE.replace("WITH lines", "WITH RECURSIVE lines") if "power AS" in body else BASE) + body for name, body in BODIES.items()}
