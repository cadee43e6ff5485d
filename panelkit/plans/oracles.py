"""The catalogue's queries as plain SQL over the same tables, for checking.

The SQL is written independently of the DataFrame code: brute-force joins,
closed forms for balanced panels, window functions without chunks.
"""

from __future__ import annotations

import json

from panelkit.models.search import GRIDS, QUICK_GRIDS, SPACES, draw, expand_grid
from panelkit.plans.catalog import TRAIN_MONTH, TRAIN_YEAR

ORACLES: dict[str, str] = {}

EVENTS = ("click", "error", "purchase", "signup", "view")

NATION_MONTH = """
nm AS (
  SELECT n_name AS entity, r_name AS region,
    CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS period,
    ln(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)) AS log_sales,
    ln(CAST(count(*) AS DOUBLE)) AS log_orders,
    CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) / count(*) AS urgent_share,
    CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) / count(*) AS open_share
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3)"""


def _ticket(status: str) -> str:
    total = f"sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = '{status}')"
    count = f"count(*) FILTER (WHERE o_orderstatus = '{status}')"
    return f"ln(CAST({total} AS DOUBLE) / nullif({count}, 0))"


CUSTOMER_YEAR = f"""
cy AS (
  SELECT o_custkey AS entity, CAST(year(o_orderdate) AS BIGINT) AS period,
    ln(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)) AS log_sales,
    CAST(count(*) AS DOUBLE) AS n_orders,
    CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) / count(*) AS urgent_share,
    {_ticket('F')} AS log_ticket_f, {_ticket('O')} AS log_ticket_o
  FROM orders GROUP BY 1, 2)"""

_SUMS = ", ".join(
    f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{e}') AS DOUBLE) AS {e}"
    for e in EVENTS
)
USER_DAY = f"""
ud AS (
  SELECT user_id AS entity,
    CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS period, {_SUMS}
  FROM events GROUP BY 1, 2)"""

SALES_WIDE = NATION_MONTH + """,
yearly AS (
  SELECT entity, CAST(floor((period - 1) / 12.0) AS BIGINT) AS year, avg(log_sales) AS v
  FROM nm GROUP BY 1, 2),
melted AS (
  SELECT e.entity, y.year AS period, v AS log_sales
  FROM (SELECT DISTINCT entity FROM yearly) e CROSS JOIN (SELECT DISTINCT year FROM yearly) y
  LEFT JOIN yearly USING (entity, year))"""

PREDICTIONS = NATION_MONTH + f""",
tr AS (SELECT * FROM nm WHERE period <= {TRAIN_MONTH}),
te AS (SELECT * FROM nm WHERE period > {TRAIN_MONTH}),
em AS (SELECT entity, avg(log_sales) AS p FROM tr GROUP BY 1),
rm AS (SELECT region, avg(log_sales) AS p FROM tr GROUP BY 1),
gm AS (SELECT avg(log_sales) AS p FROM tr),
wide AS (
  SELECT split, x.entity, x.region, period, log_sales AS y_true,
    em.p AS entity_mean, rm.p AS region_mean, gm.p AS global_mean
  FROM (SELECT 'train' AS split, * FROM tr UNION ALL SELECT 'test', * FROM te) x
  JOIN em ON em.entity = x.entity JOIN rm ON rm.region = x.region CROSS JOIN gm),
pred AS (
  SELECT split, entity, region, period, y_true, 'entity_mean' AS model, entity_mean AS y_pred FROM wide
  UNION ALL SELECT split, entity, region, period, y_true, 'region_mean', region_mean FROM wide
  UNION ALL SELECT split, entity, region, period, y_true, 'global_mean', global_mean FROM wide),
base AS (
  SELECT split, model, CAST(count(*) AS BIGINT) AS n,
    1 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*)) AS r2,
    sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
    avg((y_true - y_pred) * (y_true - y_pred)) AS mse,
    avg(abs(y_true - y_pred)) AS mae
  FROM pred GROUP BY 1, 2),
score AS (
  SELECT *, 1 - (1 - r2) * (n - 1) / (n - 4) AS adj_r2,
    (r2 / 3) / ((1 - r2) / (n - 4)) AS f_stat FROM base)"""

#: Rounds of alternating demeaning; the nation panel is close to balanced.
ROUNDS = 40


def _demeaned(source: str, out: str) -> str:
    """CTEs that sweep entity and period means out of y and x of ``source``."""
    steps, before = [], source
    for i in range(ROUNDS):
        for key in ("entity", "period"):
            name = f"{out}_{key[0]}{i}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT entity, period, "
                f"y - avg(y) OVER (PARTITION BY {key}) AS y, "
                f"x - avg(x) OVER (PARTITION BY {key}) AS x FROM {before})"
            )
            before = name
    return ",\n".join(steps) + f",\n{out} AS (SELECT * FROM {before})"


#: Two-way demeaning of sales and orders, and what follows from it.
WITHIN = NATION_MONTH + """,
ei AS (SELECT entity, avg(log_sales) AS yi, avg(log_orders) AS xi, count(*) AS ti FROM nm GROUP BY 1),
eg AS (SELECT count(*) AS n, count(DISTINCT entity) AS ne, count(DISTINCT period) AS nt FROM nm),
raw AS (SELECT entity, period, log_sales AS y, log_orders AS x FROM nm),
""" + _demeaned("raw", "tw") + """,
dd AS (
  SELECT entity, period, log_sales AS y0, log_orders AS x0, tw.y, tw.x,
    log_sales - yi AS yw, log_orders - xi AS xw
  FROM nm JOIN ei USING (entity) JOIN tw USING (entity, period)),
b AS (SELECT sum(x * y) / sum(x * x) AS beta, sum(x * x) AS sxx, max(n) AS n, max(ne) AS ne,
        max(nt) AS nt FROM dd CROSS JOIN eg),
res AS (SELECT entity, period, x0, y - beta * x AS e, x FROM dd CROSS JOIN b),
sc AS (SELECT entity, sum(x * e) AS s FROM res GROUP BY 1)"""

def r(expression: str, digits: int = 6) -> str:
    """Rounded double without negative zero."""
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0"


def rounded(*columns: str) -> str:
    return ", ".join(f"{r(c)} AS {c}" for c in columns)


def add(name: str, ctes: str, body: str) -> None:
    ORACLES[name] = f"WITH {ctes} {body}" if ctes else body


CY_COLUMNS = rounded("log_sales", "n_orders", "urgent_share", "log_ticket_f", "log_ticket_o")
NM_COLUMNS = rounded("log_sales", "log_orders", "urgent_share", "open_share")
UD_COLUMNS = rounded(*EVENTS)
BUILDERS = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"

# -- panels and scans

add("nation_month_panel", NATION_MONTH, f"SELECT entity, region, period, {NM_COLUMNS} FROM nm")
add("customer_year_panel", CUSTOMER_YEAR, f"SELECT entity, period, {CY_COLUMNS} FROM cy")
add("user_day_panel", USER_DAY, f"SELECT entity, period, {UD_COLUMNS} FROM ud")
add("profile", CUSTOMER_YEAR, """
SELECT count(*) AS n_rows, count(DISTINCT entity) AS n_entities, count(DISTINCT period) AS n_periods,
  min(period) AS first_period, max(period) AS last_period FROM cy""")
add("long_scan", "", f"""
SELECT event_id AS id, user_id AS entity, CAST(day(ts) AS BIGINT) AS period, {r('value')} AS purchase
FROM events WHERE event_type = 'purchase'""")
add("long_passthrough", CUSTOMER_YEAR, f"SELECT entity, period, {r('log_sales')} AS log_sales FROM cy")
add("wide_csv_scan", SALES_WIDE, f"SELECT entity, period, {r('log_sales')} AS log_sales FROM melted")
add("registry_scan", CUSTOMER_YEAR,
    f"SELECT entity, period, {rounded('log_sales', 'n_orders')} FROM cy")
add("split_sink", NATION_MONTH,
    f"SELECT entity, region, period, {NM_COLUMNS} FROM nm WHERE period > {TRAIN_MONTH}")

# -- projections, filters, reshape

add("drop_empty_columns", "", "SELECT user_id AS entity, "
    "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS period, "
    + ", ".join(
        f"CAST(nullif(count(*) FILTER (WHERE event_type = '{e}'), 0) AS BIGINT) AS {e}" for e in EVENTS
    ) + " FROM events GROUP BY 1, 2")
add("resolve_entity", NATION_MONTH, "SELECT entity, CAST(1 AS BIGINT) AS n_rows FROM nm GROUP BY 1")
add("wide_to_long", SALES_WIDE, f"SELECT entity, period, {r('log_sales')} AS log_sales FROM melted")
add("coerce_numeric", "", f"""
SELECT p_partkey, {r("TRY_CAST(replace(p_brand, 'Brand#', '') AS DOUBLE)")} AS brand_number,
  {r('TRY_CAST(p_type AS DOUBLE)')} AS type_number FROM part""")
add("drop_null_rows", CUSTOMER_YEAR,
    f"SELECT entity, period, {CY_COLUMNS} FROM cy WHERE log_ticket_f IS NOT NULL")
add("complete_cases", CUSTOMER_YEAR, f"""SELECT entity, period, {CY_COLUMNS} FROM cy
WHERE log_ticket_f IS NOT NULL AND log_ticket_o IS NOT NULL""")
add("recode_entities", NATION_MONTH, """
SELECT CASE entity WHEN 'NATION_0' THEN 'Nation Zero' WHEN 'NATION_1' THEN 'Nation One' ELSE entity END
  AS entity, count(*) AS n_rows FROM nm GROUP BY 1""")
add("whitelist_entities", CUSTOMER_YEAR,
    f"SELECT entity, period, {CY_COLUMNS} FROM cy WHERE entity IN ({BUILDERS})")
add("removed_entities", CUSTOMER_YEAR,
    f"SELECT entity, count(*) AS n_rows FROM cy WHERE entity NOT IN ({BUILDERS}) GROUP BY 1")
MISSING = CUSTOMER_YEAR + """,
miss AS (SELECT entity, count(*) AS n_rows,
  CAST(sum((log_ticket_f IS NULL)::INT + (log_ticket_o IS NULL)::INT) AS BIGINT) AS missing
  FROM cy GROUP BY 1)"""
add("missing_by_entity", MISSING, f"""
SELECT entity, n_rows, missing, {r('CAST(missing AS DOUBLE) / (n_rows * 4)')} AS share FROM miss""")
add("coverage_filter", MISSING, f"""SELECT entity, period, {CY_COLUMNS} FROM cy WHERE entity IN
(SELECT entity FROM miss WHERE CAST(missing AS DOUBLE) / (n_rows * 4) <= 0.30)""")
add("null_report", USER_DAY, " UNION ALL ".join(
    f"SELECT '{e}' AS \"column\", count(*) FILTER (WHERE {e} IS NULL) AS nulls FROM ud" for e in EVENTS))
add("iqr_filter", CUSTOMER_YEAR + """,
q AS (SELECT quantile_cont(log_sales, 0.25) AS a1, quantile_cont(log_sales, 0.75) AS a3,
  quantile_cont(log_ticket_f, 0.25) AS b1, quantile_cont(log_ticket_f, 0.75) AS b3 FROM cy)""",
    f"""SELECT entity, period, {CY_COLUMNS} FROM cy CROSS JOIN q
WHERE log_sales BETWEEN a1 - 1.5 * (a3 - a1) AND a3 + 1.5 * (a3 - a1)
  AND (log_ticket_f IS NULL OR log_ticket_f BETWEEN b1 - 1.5 * (b3 - b1) AND b3 + 1.5 * (b3 - b1))""")
add("duplicate_key_report", "", """
SELECT user_id AS entity, CAST(day(ts) AS BIGINT) AS period, count(*) AS rows FROM events
GROUP BY 1, 2 HAVING count(*) > 1""")


def _split(source: str, cut: str) -> str:
    return f"""
SELECT CASE WHEN period <= {cut} THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
  min(period) AS first_period, max(period) AS last_period, {r('avg(log_sales)')} AS mean_sales
FROM {source} GROUP BY 1"""


add("temporal_split_year", CUSTOMER_YEAR, _split("cy", str(TRAIN_YEAR)))
add("temporal_split_ratio", NATION_MONTH, _split(
    "nm", "(SELECT max(period) - CAST(floor((max(period) - min(period) + 1) * 0.2) AS BIGINT) FROM nm)"))
add("temporal_split_last", NATION_MONTH, _split("nm", "(SELECT max(period) - 12 FROM nm)"))
add("recombine_splits", CUSTOMER_YEAR, f"SELECT entity, period, {CY_COLUMNS} FROM cy")
add("region_lookup", NATION_MONTH, """
SELECT entity, period, CASE WHEN region IN ('ASIA', 'EUROPE', 'AMERICA') THEN region ELSE 'Other' END
  AS region FROM nm""")
add("period_slice", CUSTOMER_YEAR, f"SELECT entity, period, {CY_COLUMNS} FROM cy WHERE period = 1998")
add("entity_slice", NATION_MONTH,
    f"SELECT entity, region, period, {NM_COLUMNS} FROM nm WHERE entity = 'NATION_7'")
add("latest_slice", CUSTOMER_YEAR,
    f"SELECT entity, period, {CY_COLUMNS} FROM cy WHERE period = (SELECT max(period) FROM cy)")
add("level_bands", CUSTOMER_YEAR + """,
z AS (SELECT entity, period,
  (log_sales - avg(log_sales) OVER ()) / stddev_pop(log_sales) OVER () AS v FROM cy)""", """
SELECT entity, period, CASE WHEN v < -1 THEN 'low' WHEN v > 0.5 THEN 'high' ELSE 'moderate' END AS band
FROM z""")
add("zscore", NATION_MONTH, "SELECT entity, period, " + ", ".join(
    r(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()") + f" AS {c}"
    for c in ("log_orders", "urgent_share", "open_share")) + " FROM nm")
add("significance_labels", NATION_MONTH, """
SELECT entity, period, CASE WHEN urgent_share / 5 < 0.001 THEN '***' WHEN urgent_share / 5 < 0.01 THEN '**'
  WHEN urgent_share / 5 < 0.05 THEN '*' ELSE 'ns' END AS label FROM nm""")
add("scalar_functions", "", f"""
SELECT o_orderkey, replace(lower(o_orderpriority), ' ', '_') AS slug,
  CAST(CASE WHEN year(o_orderdate) BETWEEN 1900 AND 2100 THEN 1 ELSE 0 END AS BIGINT) AS is_year,
  {r('o_totalprice / nullif(o_orderkey % 2, 0)')} AS guarded,
  CASE WHEN o_orderkey % 10 > 0
    THEN {r("-ln(2) / ln(CASE WHEN o_orderkey % 10 > 0 THEN (o_orderkey % 10) / 10.0 END)")} END AS half_life,
  CASE WHEN o_orderkey % 12 >= 10 THEN 'EXPLOSIVE' WHEN o_orderkey % 12 > 7 THEN 'STRONG'
    WHEN o_orderkey % 12 > 4 THEN 'MODERATE' WHEN o_orderkey % 12 > 0 THEN 'WEAK' ELSE 'NONE' END
    AS persistence
FROM orders""")

# -- joins and set operations

_FRAMES = ",".join(f"""
f_{e} AS (SELECT user_id AS entity,
  CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS period,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS {e}
  FROM events WHERE event_type = '{e}' GROUP BY 1, 2)""" for e in EVENTS)
add("fold_outer_join", _FRAMES, f"SELECT entity, period, {UD_COLUMNS} FROM f_click "
    + " ".join(f"FULL JOIN f_{e} USING (entity, period)" for e in EVENTS[1:]))
add("distinct_periods", NATION_MONTH, "SELECT DISTINCT period FROM nm ORDER BY 1")
add("distinct_entities", CUSTOMER_YEAR, "SELECT DISTINCT entity FROM cy ORDER BY 1")
add("entity_difference", CUSTOMER_YEAR, """
SELECT entity FROM cy EXCEPT SELECT entity FROM cy WHERE period = (SELECT max(period) FROM cy)""")
add("recent_first", NATION_MONTH, f"""
SELECT period, {rounded('log_sales', 'open_share')} FROM nm WHERE entity = 'NATION_3'
ORDER BY period DESC""")

# -- windows and imputation

LAG = "lag(log_sales) OVER (PARTITION BY entity ORDER BY period)"
add("lag_by_entity", CUSTOMER_YEAR,
    f"SELECT entity, period, {r('log_sales')} AS log_sales, {r(LAG)} AS log_sales_lag1 FROM cy")
add("lag_gap_aware", CUSTOMER_YEAR, f"""
SELECT a.entity, a.period, {r('a.log_sales')} AS log_sales, {r('p.log_sales')} AS log_sales_lag1
FROM cy a LEFT JOIN cy p ON p.entity = a.entity AND p.period = a.period - 1""")
add("lag_without_bounds", USER_DAY, f"""
SELECT entity, period, {r('"view"')} AS "view",
  {r('lag("view", 2) OVER (PARTITION BY entity ORDER BY period)')} AS view_lag2 FROM ud""")
add("latest_delta", CUSTOMER_YEAR + f""",
l AS (SELECT entity, period, log_sales, coalesce({LAG}, log_sales) AS before,
  row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS k FROM cy)""", f"""
SELECT entity, period AS latest_period, {r('log_sales')} AS latest, {r('before')} AS previous,
  {r('log_sales - before')} AS delta, CASE WHEN log_sales > before THEN 'Improving'
  WHEN log_sales < before THEN 'Declining' ELSE 'Stable' END AS trend FROM l WHERE k = 1""")


def _impute(c: str, panel: str = "ud") -> tuple[str, str]:
    frames = {
        k: f"OVER (PARTITION BY entity ORDER BY period RANGE BETWEEN {k} PRECEDING AND {k} FOLLOWING)"
        for k in (1, 2, 4)
    }
    tries = [f"CASE WHEN count({c}) {w} >= 2 THEN quantile_cont({c}, 0.5) {w} END" for w in frames.values()]
    overall = f"(SELECT quantile_cont({c}, 0.5) FROM {panel})"
    value = f"coalesce({c}, {', '.join(tries)}, {overall})"
    counts = [f"WHEN count({c}) {w} >= 2 THEN {i}" for i, w in enumerate(frames.values(), start=1)]
    stage = f"CASE WHEN {c} IS NOT NULL THEN 0 {' '.join(counts)} ELSE 4 END"
    return value, stage


_IMPUTED = ", ".join(f"{r(_impute(e)[0])} AS {e}" for e in EVENTS)
add("impute_window_median", USER_DAY, f"SELECT entity, period, {_IMPUTED} FROM ud")
add("impute_without_bounds", USER_DAY, f"SELECT entity, period, {_IMPUTED} FROM ud")
add("impute_report", USER_DAY, " UNION ALL ".join(
    f"SELECT '{e}' AS \"column\", CAST(stage AS BIGINT) AS stage, count(*) AS cells "
    f"FROM (SELECT {_impute(e)[1]} AS stage FROM ud) GROUP BY stage" for e in EVENTS))


_PREPARED = ["n_orders", "urgent_share", "log_ticket_f", "log_ticket_o"]
add("prepared_panel", CUSTOMER_YEAR + f""",
al AS (SELECT * FROM cy WHERE entity IN ({BUILDERS})),
ok AS (SELECT * FROM al WHERE entity IN (SELECT entity FROM al GROUP BY 1
  HAVING CAST(sum((log_ticket_f IS NULL)::INT + (log_ticket_o IS NULL)::INT) AS DOUBLE) / (count(*) * 4) <= 0.30))""",
    f"""SELECT CAST(entity AS VARCHAR) AS entity, period, {r('log_sales')} AS log_sales,
  {', '.join(r(_impute(c, 'ok')[0]) + f' AS {c}' for c in _PREPARED)},
  CASE WHEN period <= 1999 THEN 'train' ELSE 'test' END AS split FROM ok""")
add("infer_features", NATION_MONTH, " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n_values FROM nm" for c in ("log_orders", "urgent_share", "open_share")))


def _window(reach: int) -> str:
    """Median around the current place of the values observed or filled so far."""
    near = (f"list_filter(range(1, n + 1), lambda j: abs(ps[j] - ps[i + 1]) <= {reach} "
            "AND f[j] IS NOT NULL)")
    values = f"list_transform({near}, lambda j: f[j])"
    return f"CASE WHEN len({near}) >= 2 THEN list_aggregate({values}, 'median') END"


# walks every series from its first to its last row, replacing one cell per step
add("impute_sequential", "RECURSIVE " + USER_DAY.strip() + """,
lo AS (""" + " UNION ALL ".join(
    f"SELECT entity, period, '{e}' AS kind, ln(1 + {e}) AS v FROM ud" for e in EVENTS) + """),
ar AS (SELECT entity, kind, list(period ORDER BY period) AS ps, list(v ORDER BY period) AS vs,
  count(*) AS n FROM lo GROUP BY 1, 2),
gm AS (SELECT kind, quantile_cont(v, 0.5) AS m FROM lo GROUP BY 1),
st AS (
  SELECT entity, kind, 0 AS i, vs AS f FROM ar
  UNION ALL
  SELECT st.entity, st.kind, i + 1, list_concat(list_concat(f[1:i],
    [coalesce(f[i + 1], """ + ", ".join(_window(k) for k in (1, 2, 4)) + """, m)]), f[i + 2:])
  FROM st JOIN ar USING (entity, kind) JOIN gm USING (kind) WHERE i < n),
un AS (SELECT st.entity, st.kind, unnest(ps) AS period, unnest(f) AS v
  FROM st JOIN ar USING (entity, kind) WHERE i = n)""",
    "SELECT entity, period, " + ", ".join(
        r("max(v) FILTER (WHERE kind = '" + e + "')") + f" AS {e}" for e in EVENTS)
    + " FROM un GROUP BY 1, 2")
add("forward_fill", USER_DAY, "SELECT entity, period, " + ", ".join(
    r(f"last_value({e} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY period "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)") + f" AS {e}" for e in EVENTS) + " FROM ud")
add("contiguous_folds", CUSTOMER_YEAR, """
SELECT entity, period, CAST(ntile(5) OVER (ORDER BY entity, period) - 1 AS BIGINT) AS fold FROM cy""")

# -- aggregates

BY_REGION = NATION_MONTH + """,
reg AS (SELECT region, period, avg(log_sales) AS mean, stddev_samp(log_sales) AS std, count(*) AS n
  FROM nm GROUP BY 1, 2)"""
BY_PERIOD = NATION_MONTH + """,
ev AS (SELECT period, sum(log_sales) AS total, count(log_sales) AS n, avg(log_sales) AS average
  FROM nm GROUP BY 1)"""
add("region_period_stats", BY_REGION, f"SELECT region, period, {rounded('mean', 'std')}, n FROM reg")
add("period_evolution", BY_PERIOD, f"SELECT period, {rounded('total')}, n, {rounded('average')} FROM ev")
add("evolution_summary", BY_PERIOD, f"""
SELECT min(period) AS first_period, max(period) AS last_period, {r('avg(average)')} AS overall_average,
  {r('min(average)')} AS lowest,
  (SELECT period FROM ev ORDER BY average, period LIMIT 1) AS lowest_period,
  {r('max(average)')} AS highest,
  (SELECT period FROM ev ORDER BY average DESC, period LIMIT 1) AS highest_period,
  {r('''(SELECT average FROM ev ORDER BY period DESC LIMIT 1)
      - (SELECT average FROM ev ORDER BY period LIMIT 1)''')} AS total_change,
  CAST(floor(avg(n)) AS BIGINT) AS average_count FROM ev""")
add("region_change", BY_REGION, f"""
SELECT region, min(period) AS first_period, max(period) AS last_period,
  {r('arg_max(mean, period) - arg_min(mean, period)')} AS change
FROM reg GROUP BY 1 HAVING count(*) >= 2""")
add("period_buckets", NATION_MONTH + """,
bk AS (SELECT CAST(floor((period - 23941) / 24.0) AS BIGINT) AS bucket, min(period) AS first_period,
  max(period) AS last_period, avg(log_sales) AS mean, stddev_samp(log_sales) AS std FROM nm GROUP BY 1),
ch AS (SELECT *, mean - lag(mean) OVER (ORDER BY bucket) AS d FROM bk)""", f"""
SELECT bucket, first_period, last_period, {rounded('mean', 'std')},
  CASE WHEN d > 0 THEN 'Improving' WHEN d < 0 THEN 'Declining' WHEN d = 0 THEN 'Stable' END AS trend FROM ch""")


def _describe(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})')} AS mean,
  {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS p25,
  {r(f'quantile_cont({c}, 0.5)')} AS p50, {r(f'quantile_cont({c}, 0.75)')} AS p75,
  {r(f'max({c})')} AS max FROM cy"""


add("describe", CUSTOMER_YEAR, " UNION ALL ".join(
    _describe(c) for c in ("log_sales", "n_orders", "urgent_share", "log_ticket_f", "log_ticket_o")))
add("target_summary", CUSTOMER_YEAR, f"""
SELECT {r('avg(log_sales)')} AS mean, {r('stddev_samp(log_sales)')} AS std,
  {r('min(log_sales)')} AS min, {r('max(log_sales)')} AS max FROM cy""")


def _correlation(a: str, b: str) -> str:
    both = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return (f"covar_samp({a}, {b}) {both} / "
            f"nullif(stddev_samp({a}) {both} * stddev_samp({b}) {both}, 0)")


add("corr_matrix", USER_DAY, " UNION ALL ".join(
    f"SELECT '{a}' AS f1, '{b}' AS f2, {r(_correlation(a, b))} AS r FROM ud"
    for a in EVENTS for b in EVENTS))
_NUMERIC = ("log_sales", "log_orders", "urgent_share", "open_share")
add("strong_pairs", NATION_MONTH, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS f1, '{b}' AS f2, {r(_correlation(a, b))} AS r FROM nm"
    for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1:]) + ") WHERE abs(r) > 0.7")
add("histogram", CUSTOMER_YEAR + """,
lim AS (SELECT min(log_sales) AS lo, max(log_sales) AS hi FROM cy),
cnt AS (SELECT least(CAST(floor((log_sales - lo) / (hi - lo) * 50) AS BIGINT), 49) AS bin, count(*) AS n
  FROM cy CROSS JOIN lim GROUP BY 1)""", f"""
SELECT CAST(g.bin AS BIGINT) AS bin, {r('lo + (hi - lo) * g.bin / 50')} AS bin_start,
  {r('lo + (hi - lo) * (g.bin + 1) / 50')} AS bin_end, coalesce(n, 0) AS n
FROM range(50) g(bin) CROSS JOIN lim LEFT JOIN cnt ON cnt.bin = g.bin""")
ERRORS = PREDICTIONS + """,
err AS (SELECT model, y_true - y_pred AS error FROM pred WHERE split = 'test')"""
add("histogram_density", ERRORS + """,
lim AS (SELECT model, min(error) AS lo, max(error) AS hi, count(*) AS total FROM err GROUP BY 1),
cnt AS (SELECT model, least(CAST(floor((error - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin, count(*) AS n
  FROM err JOIN lim USING (model) GROUP BY 1, 2)""", f"""
SELECT lim.model, CAST(g.bin AS BIGINT) AS bin, {r('lo + (hi - lo) * g.bin / 30')} AS bin_start,
  {r('lo + (hi - lo) * (g.bin + 1) / 30')} AS bin_end, coalesce(n, 0) AS n,
  {r('coalesce(n, 0) / (total * ((hi - lo) / 30))')} AS density
FROM range(30) g(bin) CROSS JOIN lim LEFT JOIN cnt ON cnt.bin = g.bin AND cnt.model = lim.model""")
BOX = CUSTOMER_YEAR + """,
q AS (SELECT period, quantile_cont(log_sales, 0.25) AS q1, quantile_cont(log_sales, 0.5) AS median,
  quantile_cont(log_sales, 0.75) AS q3 FROM cy GROUP BY 1),
fen AS (SELECT cy.period, log_sales AS v, q1, median, q3,
  log_sales BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM cy JOIN q USING (period))"""
add("box_summary", BOX, f"""
SELECT period, {r('max(q1)')} AS q1, {r('max(median)')} AS median, {r('max(q3)')} AS q3,
  {r('min(v) FILTER (WHERE inside)')} AS whisker_low, {r('max(v) FILTER (WHERE inside)')} AS whisker_high,
  {r('avg(v)')} AS mean, count(*) FILTER (WHERE NOT inside) AS n_outliers, count(*) AS n
FROM fen GROUP BY 1""")
add("box_outliers", BOX, f"SELECT period, {r('v')} AS log_sales FROM fen WHERE NOT inside")
add("kde", ERRORS + """,
st AS (SELECT model, count(*) AS n, min(error) AS lo, max(error) AS hi,
  pow(count(*), -0.2) * stddev_samp(error) AS h FROM err GROUP BY 1),
gr AS (SELECT st.*, g.i AS point, lo + (hi - lo) / 99 * g.i AS x FROM st CROSS JOIN range(100) g(i))""",
    f"""SELECT model, CAST(point AS BIGINT) AS point, {r('max(x)')} AS x,
  {r('sum(exp(-0.5 * pow((x - error) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi()))')} AS density
FROM gr JOIN err USING (model) GROUP BY 1, 2""")

# -- scores

TEST = "WHERE split = 'test'"
add("residuals", PREDICTIONS, f"""
SELECT entity, region, period, {rounded('y_true')}, model, {rounded('y_pred')},
  {r('y_true - y_pred')} AS error FROM pred {TEST}""")
add("errors_long", PREDICTIONS, f"SELECT model, {r('y_true - y_pred')} AS error FROM pred {TEST}")
add("regression_metrics", PREDICTIONS, f"""
SELECT model, {rounded('r2', 'adj_r2', 'f_stat', 'rmse', 'mae')}, n AS n_samples,
  CAST(3 AS BIGINT) AS n_features FROM score {TEST}""")
add("panel_metrics", PREDICTIONS, f"""
SELECT model, n AS n_test, {rounded('mse', 'rmse', 'mae', 'r2')} FROM score {TEST}""")
add("actual_vs_predicted", PREDICTIONS, f"""
SELECT model, period, {r('avg(y_true)')} AS actual, {r('avg(y_pred)')} AS predicted
FROM pred {TEST} GROUP BY 1, 2""")
add("metrics_by_region", PREDICTIONS, f"""
SELECT region, {r('''1 - sum((y_true - y_pred) * (y_true - y_pred))
    / (var_pop(y_true) * count(*))''')} AS r2,
  {r('avg(abs(y_true - y_pred))')} AS mae, count(*) AS n_samples
FROM pred {TEST} AND model = (SELECT model FROM score {TEST} ORDER BY r2 DESC, model LIMIT 1) GROUP BY 1""")
add("error_stats", ERRORS, f"""
SELECT model, {r('avg(error)')} AS mean_error, {r('stddev_samp(error)')} AS std_error,
  {r('min(error)')} AS min_error, {r('max(error)')} AS max_error,
  {r('quantile_cont(error, 0.5)')} AS median_error FROM err GROUP BY 1""")
add("axis_range", PREDICTIONS, f"""
SELECT model, {r('least(min(y_true), min(y_pred))')} AS low,
  {r('greatest(max(y_true), max(y_pred))')} AS high FROM pred {TEST} GROUP BY 1""")
add("leaderboard", PREDICTIONS, f"""
SELECT model, {rounded('r2', 'adj_r2', 'rmse', 'mae')}, n AS n_samples, CAST(3 AS BIGINT) AS n_features,
  CAST(row_number() OVER (ORDER BY r2 DESC, model) AS BIGINT) AS rank,
  repeat('*', CAST(greatest(4 - row_number() OVER (ORDER BY r2 DESC, model), 0) AS INT)) AS mark,
  CASE WHEN r2 >= 0.75 THEN 'excellent' WHEN r2 >= 0.65 THEN 'good' ELSE 'moderate' END AS tier
FROM score {TEST}""")
add("leaderboard_summary", PREDICTIONS, f"""
SELECT {r('avg(r2)')} AS mean_r2, {r('stddev_samp(r2)')} AS std_r2, {r('avg(adj_r2)')} AS mean_adj_r2,
  {r('avg(mae)')} AS mean_mae, (SELECT model FROM score {TEST} ORDER BY r2 DESC, model LIMIT 1) AS champion,
  count(*) AS n_models FROM score {TEST}""")
add("best_worst", PREDICTIONS, f"""
SELECT (SELECT model FROM score {TEST} ORDER BY r2 DESC, model LIMIT 1) AS best_model,
  {r('max(r2)')} AS best_r2, (SELECT model FROM score {TEST} ORDER BY r2, model LIMIT 1) AS worst_model,
  {r('min(r2)')} AS worst_r2, {r('min(rmse)')} AS min_rmse, {r('min(mae)')} AS min_mae FROM score {TEST}""")
add("radar_scores", PREDICTIONS, f"""
SELECT model, {rounded('r2')}, {r('1 - rmse')} AS rmse_inv, {r('1 - mae')} AS mae_inv FROM score {TEST}""")
add("train_vs_test", PREDICTIONS, f"""
SELECT a.model, {r('a.r2')} AS r2_train, {r('b.r2')} AS r2_test, {r('a.r2 - b.r2')} AS diff
FROM score a JOIN score b USING (model) WHERE a.split = 'train' AND b.split = 'test'""")
add("union_results", PREDICTIONS, f"""
SELECT model, {r('r2')} AS r2, {r('rmse')} AS rmse, 'train' AS source, CAST(NULL AS DOUBLE) AS mae
FROM score WHERE split = 'train'
UNION ALL SELECT model, {r('r2')}, CAST(NULL AS DOUBLE), 'test', {r('mae')} FROM score {TEST}""")
ORACLES["results_sink"] = ORACLES["union_results"]
add("leaderboard_sink", PREDICTIONS, f"""
SELECT model, {rounded('r2', 'rmse', 'mae')},
  CAST(row_number() OVER (ORDER BY r2 DESC, model) AS BIGINT) AS rank,
  repeat('*', CAST(greatest(4 - row_number() OVER (ORDER BY r2 DESC, model), 0) AS INT)) AS mark,
  CASE WHEN r2 >= 0.75 THEN 'excellent' WHEN r2 >= 0.65 THEN 'good' ELSE 'moderate' END AS tier,
  (SELECT count(*) FROM tr) AS train_samples, (SELECT count(*) FROM te) AS test_samples
FROM score {TEST}""")
ORACLES["checked_panel_scan"] = ORACLES["nation_month_panel"]
add("models_vs_benchmark", PREDICTIONS, f"""
SELECT model, {rounded('r2', 'rmse', 'mae')}, model = 'entity_mean' AS is_benchmark,
  r2 = max(r2) OVER () AS best_r2, rmse = min(rmse) OVER () AS best_rmse, mae = min(mae) OVER () AS best_mae
FROM score {TEST}""")

# -- regressors

CY_FEATURES = ("n_orders", "urgent_share", "log_ticket_f", "log_ticket_o")
IMPUTED = CUSTOMER_YEAR + f""",
ci AS MATERIALIZED (SELECT entity, period, log_sales, {", ".join(f"{_impute(c, 'cy')[0]} AS {c}" for c in CY_FEATURES)} FROM cy),
tr AS (SELECT * FROM ci WHERE period <= {TRAIN_YEAR}),
te AS (SELECT * FROM ci WHERE period > {TRAIN_YEAR})"""


def _knn(features: tuple[str, ...], k: int, metric: str, weighted: bool) -> tuple[str, str]:
    z = ", ".join(
        f"({c} - (SELECT avg({c}) FROM tr)) / (SELECT stddev_pop({c}) FROM tr) AS z{i}"
        for i, c in enumerate(features)
    )
    gaps = [f"(q.z{i} - p.z{i})" for i in range(len(features))]
    if metric == "manhattan":
        distance = " + ".join(f"abs{g}" for g in gaps)
    else:
        distance = f"sqrt({' + '.join(f'{g} * {g}' for g in gaps)})"
    average = "avg(y)"
    if weighted:
        average = ("coalesce(avg(y) FILTER (WHERE d = 0), "
                   "sum(y / nullif(d, 0)) / sum(1 / nullif(d, 0)))")
    ctes = IMPUTED + f""",
pt AS (SELECT entity, period, log_sales AS y, {z} FROM tr),
qu AS (SELECT entity, period, log_sales AS y_true, {z} FROM te),
nb AS (SELECT q.entity, q.period, q.y_true, p.y, round({distance}, 9) AS d,
  row_number() OVER (PARTITION BY q.entity, q.period
    ORDER BY round({distance}, 9), p.entity, p.period) AS k FROM qu q CROSS JOIN pt p)"""
    body = f"""SELECT entity, period, {r('max(y_true)')} AS y_true, {r(average)} AS y_pred
FROM nb WHERE k <= {k} GROUP BY 1, 2"""
    return ctes, body


add("knn_regress", *_knn(("urgent_share", "log_ticket_f", "log_ticket_o"), 5, "euclidean", True))
add("knn_uniform_manhattan", *_knn(("log_ticket_f", "log_ticket_o"), 7, "manhattan", False))
add("ols_simple", NATION_MONTH, f"""
SELECT 'log_orders' AS feature, {r('regr_slope(log_sales, log_orders) * stddev_pop(log_orders)')}
  AS coefficient FROM nm""")
add("elastic_net_simple", NATION_MONTH + """,
c AS (SELECT covar_pop(log_sales, log_orders) / stddev_pop(log_orders) AS rho FROM nm)""", f"""
SELECT 'log_orders' AS feature,
  {r('sign(rho) * greatest(abs(rho) - 0.05 * 0.3, 0) / (1 + 0.05 * 0.7)')} AS coefficient FROM c""")
FOLDS = NATION_MONTH + """,
f AS (SELECT *, CAST(ntile(5) OVER (ORDER BY entity, period) - 1 AS BIGINT) AS fold FROM nm),
k AS (SELECT DISTINCT fold FROM f),
co AS (SELECT k.fold, regr_slope(log_sales, log_orders) AS b, regr_intercept(log_sales, log_orders) AS a
  FROM k JOIN f ON f.fold <> k.fold GROUP BY 1),
ev AS (SELECT co.fold, f.fold = co.fold AS held, log_sales AS y, a + b * log_orders AS p FROM co CROSS JOIN f),
sd AS (SELECT fold, held, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM ev GROUP BY 1, 2),
fs AS (SELECT fold, max(r2) FILTER (WHERE NOT held) AS train_score, max(r2) FILTER (WHERE held) AS cv_score
  FROM sd GROUP BY 1)"""
add("cv_fold_scores", FOLDS,
    f"SELECT 'elastic_net' AS model, fold, {rounded('train_score', 'cv_score')} FROM fs")
add("cv_comparison", FOLDS, f"""
SELECT 'elastic_net' AS model, {r('avg(cv_score)')} AS cv_mean, {r('stddev_pop(cv_score)')} AS cv_std FROM fs""")
add("overfitting", FOLDS, f"""
SELECT 'elastic_net' AS model, {r('avg(train_score)')} AS train_score, {r('avg(cv_score)')} AS cv_score,
  {r('avg(train_score) - avg(cv_score)')} AS overfitting_gap,
  avg(train_score) - avg(cv_score) > 0.1 AS has_overfitting FROM fs""")



def _penalised(candidates: list[dict]) -> str:
    """Closed form of the one-feature elastic net per candidate and fold."""
    values = ", ".join(
        f"({i}, CAST({c['alpha']!r} AS DOUBLE), CAST({c['l1_ratio']!r} AS DOUBLE))"
        for i, c in enumerate(candidates)
    )
    return FOLDS + f""",
pc(candidate, alpha, ratio) AS (VALUES {values}),
mo AS (SELECT k.fold, avg(log_orders) AS mx, stddev_pop(log_orders) AS sx, avg(log_sales) AS my,
  covar_pop(log_sales, log_orders) / stddev_pop(log_orders) AS rho
  FROM k JOIN f ON f.fold <> k.fold GROUP BY 1),
cb AS (SELECT *, sign(rho) * greatest(abs(rho) - alpha * ratio, 0) / (1 + alpha * (1 - ratio)) AS b
  FROM pc CROSS JOIN mo),
pe AS (SELECT candidate, cb.fold, f.fold = cb.fold AS held, log_sales AS y,
  my + b * (log_orders - mx) / sx AS p FROM cb CROSS JOIN f),
ps AS (SELECT candidate, fold, held, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2
  FROM pe GROUP BY 1, 2, 3)"""


_MEANS = f"""{r('avg(r2) FILTER (WHERE NOT held)')} AS train_score,
  {r('avg(r2) FILTER (WHERE held)')} AS cv_score, {r('stddev_pop(r2) FILTER (WHERE held)')} AS cv_std"""
_GRID = expand_grid(GRIDS["elastic_net"])
_PARAMS = " ".join(f"WHEN {i} THEN '{json.dumps(c, sort_keys=True)}'" for i, c in enumerate(_GRID))
add("search_grid", _penalised(_GRID), f"""
SELECT 'elastic_net' AS model, CAST(candidate AS BIGINT) AS candidate,
  CASE candidate {_PARAMS} END AS params, {_MEANS} FROM ps GROUP BY candidate""")
_NEAR = expand_grid(GRIDS["knn"])
_NEAR_PARAMS = " ".join(f"WHEN {i} THEN '{json.dumps(c, sort_keys=True)}'" for i, c in enumerate(_NEAR))


def _neighbour_grid() -> tuple[str, str]:
    """Every row's nearest training rows per fold and metric, as one sorted list each."""
    features = ("log_orders", "urgent_share", "open_share")
    z = ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(features))
    lists = []
    for metric in ("euclidean", "manhattan"):
        gaps = [f"(q.z{i} - p.z{i})" for i in range(len(features))]
        d = " + ".join(f"abs{g}" for g in gaps) if metric == "manhattan" else f"sqrt({' + '.join(f'{g} * {g}' for g in gaps)})"
        lists.append(f"""SELECT '{metric}' AS metric, q.fold, q.held, q.entity, q.period, any_value(q.y) AS y_true,
  min(struct_pack(d := round({d}, 9), e := p.entity, t := p.period, y := p.y), 15) AS near
FROM zf q JOIN zf p ON p.fold = q.fold AND NOT p.held GROUP BY ALL""")
    averages = []
    for i, c in enumerate(_NEAR):
        few = f"list_slice(near, 1, {c['n_neighbors']})"
        mean = f"list_avg(list_transform({few}, lambda x: x.y))"
        if c["weights"] == "distance":
            same = f"list_avg(list_transform(list_filter({few}, lambda x: x.d = 0), lambda x: x.y))"
            far = f"list_filter({few}, lambda x: x.d > 0)"
            mean = f"coalesce({same}, list_sum(list_transform({far}, lambda x: x.y / x.d)) / list_sum(list_transform({far}, lambda x: 1 / x.d)))"
        averages.append(f"SELECT {i} AS candidate, fold, held, y_true AS y, {mean} AS p FROM nb WHERE metric = '{c['metric']}'")
    moments = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(features))
    return FOLDS + f""",
zm AS (SELECT k.fold, {moments} FROM k JOIN f ON f.fold <> k.fold GROUP BY 1),
zf AS MATERIALIZED (SELECT zm.fold, f.fold = zm.fold AS held, entity, period, log_sales AS y, {z} FROM zm CROSS JOIN f),
nb AS MATERIALIZED ({" UNION ALL ".join(lists)}),
pe AS ({" UNION ALL ".join(averages)}),
ps AS (SELECT candidate, fold, held, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM pe GROUP BY 1, 2, 3)""", f"""
SELECT 'knn' AS model, CAST(candidate AS BIGINT) AS candidate, CASE candidate {_NEAR_PARAMS} END AS params, {_MEANS}
FROM ps GROUP BY candidate"""


add("search_neighbours", *_neighbour_grid())
add("search_random", _penalised(draw(SPACES["elastic_net"], 100)), f"""
SELECT 'elastic_net' AS model, CAST(candidate AS BIGINT) AS candidate, {_MEANS} FROM ps GROUP BY candidate""")


def _descent(source: str, features: tuple[str, ...], penalties: str, rounds: int = 250) -> str:
    """CTEs of the elastic net with several features by cyclic descent on moments.

    ``source`` has a group g, the features and y; ``penalties`` has g and the two penalties l1, l2. The result co
    has a row for each group: means m<i>, deviations s<i>, coefficients b<i> on z-scores, my.
    """
    p = range(len(features))
    moments = [f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}, covar_pop({c}, y) / stddev_pop({c}) AS c{i}" for i, c in enumerate(features)]
    moments += [
        f"covar_pop({features[i]}, {features[j]}) / (stddev_pop({features[i]}) * stddev_pop({features[j]})) AS g{i}_{j}"
        for i in p for j in p if i < j
    ]
    steps = []
    for i in p:
        others = " - ".join(f"g{min(i, j)}_{max(i, j)} * {'n' if j < i else ''}b{j}" for j in p if j != i)
        steps.append(f"c{i} - {others} AS r{i}, sign(r{i}) * greatest(abs(r{i}) - l1, 0) / (1 + l2) AS nb{i}")
    return f"""
mo AS MATERIALIZED (SELECT *, {", ".join(f"CAST(0 AS DOUBLE) AS z{i}" for i in p)} FROM (
  SELECT g, avg(y) AS my, {", ".join(moments)} FROM {source} GROUP BY g) JOIN {penalties} USING (g)),
it AS (SELECT g, 0 AS step, {", ".join(f"z{i} AS b{i}" for i in p)} FROM mo
  UNION ALL SELECT g, step + 1, {", ".join(f"nb{i}" for i in p)} FROM (
    SELECT it.g, step, {", ".join(steps)} FROM it JOIN mo USING (g) WHERE step < {rounds})),
co AS MATERIALIZED (SELECT mo.*, {", ".join(f"b{i}" for i in p)} FROM it JOIN mo USING (g) WHERE step = {rounds})"""


def _line(features: tuple[str, ...]) -> str:
    return "my + " + " + ".join(f"b{i} * ({c} - m{i}) / s{i}" for i, c in enumerate(features))


def _customers(alpha: float, share: float) -> str:
    return "WITH RECURSIVE " + IMPUTED + f""",
so AS (SELECT 0 AS g, *, log_sales AS y FROM tr),
pn AS (SELECT 0 AS g, CAST({alpha * share!r} AS DOUBLE) AS l1, CAST({alpha * (1 - share)!r} AS DOUBLE) AS l2),
""" + _descent("so", CY_FEATURES, "pn")


ORACLES["elastic_net_coefficients"] = _customers(0.01, 0.5) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'b{i}')} AS coefficient FROM co" for i, c in enumerate(CY_FEATURES))
ORACLES["elastic_net"] = _customers(0.001, 0.5) + f"""
SELECT 'Elastic Net' AS model, entity, period, {r('log_sales')} AS y_true, {r(_line(CY_FEATURES))} AS y_pred FROM te CROSS JOIN co"""
_WHOLE = ", ".join(
    f"({i}, CAST({c['alpha']!r} AS DOUBLE), CAST({c['l1_ratio']!r} AS DOUBLE))" for i, c in enumerate(_GRID))
ORACLES["search_grid_features"] = "WITH RECURSIVE " + IMPUTED + f""",
f AS MATERIALIZED (SELECT *, log_sales AS y, CAST(ntile(5) OVER (ORDER BY entity, period) - 1 AS BIGINT) AS fold FROM tr),
k AS (SELECT DISTINCT fold FROM f),
pc(candidate, alpha, ratio) AS (VALUES {_WHOLE}),
so AS (SELECT k.fold AS g, f.* EXCLUDE (fold) FROM k JOIN f ON f.fold <> k.fold),
pn AS (SELECT fold * 100 + candidate AS g, fold, candidate, alpha * ratio AS l1, alpha * (1 - ratio) AS l2 FROM pc CROSS JOIN k),
sg AS (SELECT pn.g, so.* EXCLUDE (g) FROM so JOIN pn ON pn.fold = so.g),
""" + _descent("sg", CY_FEATURES, "pn") + f""",
pe AS (SELECT candidate, f.fold = co.fold AS held, co.fold, y, {_line(CY_FEATURES)} AS p FROM co CROSS JOIN f),
ps AS (SELECT candidate, fold, held, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM pe GROUP BY 1, 2, 3)
SELECT 'elastic_net' AS model, CAST(candidate AS BIGINT) AS candidate, CASE candidate {_PARAMS} END AS params, {_MEANS}
FROM ps GROUP BY candidate"""
NM_FEATURES = ("log_orders", "urgent_share", "open_share")
ORACLES["learning_curve"] = "WITH RECURSIVE " + NATION_MONTH + f""",
o AS MATERIALIZED (SELECT *, log_sales AS y, row_number() OVER w AS place, ntile(3) OVER w - 1 AS fold FROM nm
  WINDOW w AS (ORDER BY md5('42|' || entity || '|' || period), entity, period)),
fo AS (SELECT fold, (SELECT count(*) FROM o) - count(*) AS n FROM o GROUP BY 1),
sh AS (SELECT fold * 10 + i AS g, fold, share, greatest(1, CAST(floor(share * n) AS BIGINT)) AS size
  FROM fo CROSS JOIN (VALUES (0, CAST(0.2 AS DOUBLE)), (1, CAST(0.4 AS DOUBLE)), (2, CAST(0.6 AS DOUBLE)),
    (3, CAST(0.8 AS DOUBLE)), (4, CAST(1.0 AS DOUBLE))) v(i, share)),
ou AS (SELECT fo.fold AS outside, o.*, row_number() OVER (PARTITION BY fo.fold ORDER BY place) AS nth FROM fo JOIN o ON o.fold <> fo.fold),
so AS MATERIALIZED (SELECT sh.g, ou.* FROM ou JOIN sh ON sh.fold = ou.outside AND nth <= sh.size),
pn AS (SELECT g, CAST(0.0005 AS DOUBLE) AS l1, CAST(0.0005 AS DOUBLE) AS l2 FROM sh),
""" + _descent("so", NM_FEATURES, "pn") + f""",
sc AS (SELECT g, 1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)) AS train FROM (
  SELECT g, y, {_line(NM_FEATURES)} AS p FROM so JOIN co USING (g)) GROUP BY 1),
cv AS (SELECT g, 1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)) AS held FROM (
  SELECT sh.g, y, {_line(NM_FEATURES)} AS p FROM sh JOIN o USING (fold) JOIN co ON co.g = sh.g) GROUP BY 1)
SELECT 'elastic_net' AS model, share, min(size) AS train_size, {r('avg(train)')} AS train_mean, {r('stddev_pop(train)')} AS train_std,
  {r('avg(held)')} AS cv_mean, {r('stddev_pop(held)')} AS cv_std FROM sh JOIN sc USING (g) JOIN cv USING (g) GROUP BY share"""
add("shuffled_folds", CUSTOMER_YEAR, """
SELECT entity, period, CAST(ntile(5) OVER (ORDER BY md5('42|' || entity || '|' || period), entity, period) - 1 AS BIGINT) AS fold FROM cy""")
add("model_round_trip", NATION_MONTH + f""",
co AS (SELECT regr_slope(log_sales, log_orders) AS b, regr_intercept(log_sales, log_orders) AS a
  FROM nm WHERE period <= {TRAIN_MONTH})""", f"""
SELECT 'Elastic Net' AS model, entity, period, {r('log_sales')} AS y_true,
  {r('a + b * log_orders')} AS y_pred FROM nm CROSS JOIN co WHERE period > {TRAIN_MONTH}""")

# -- panel econometrics

SPARE = "(n - 1 - ne - nt + 1)"
add("fe_two_way", WITHIN, f"SELECT 'log_orders' AS term, {r('beta')} AS coefficient FROM b")
add("fe_cluster_se", WITHIN + f""",
v AS (SELECT beta, sqrt(n / CAST({SPARE} AS DOUBLE) * (SELECT sum(s * s) FROM sc)) / sxx AS se FROM b)""",
    f"SELECT 'log_orders' AS term, {r('se')} AS std_error, {r('beta / se')} AS t_stat FROM v")
add("fe_r2", WITHIN, f"""
SELECT 'Dynamic Panel (FE)' AS model,
  {r('(SELECT 1 - sum(pow(yw - beta * xw, 2)) / sum(yw * yw) FROM dd)')} AS r2_within,
  {r('(SELECT 1 - sum(pow(yi - beta * xi, 2)) / sum(yi * yi) FROM ei)')} AS r2_between,
  {r('(SELECT 1 - sum(pow(y0 - beta * x0, 2)) / sum(y0 * y0) FROM dd)')} AS r2_overall,
  n AS n_obs, ne AS n_entities, nt AS n_periods FROM b""")
ORACLES["panel_report_sink"] = ORACLES["fe_r2"]
add("fe_residuals", WITHIN, f"SELECT entity, period, {r('e')} AS e FROM res")
add("lagged_residual", WITHIN, f"""
SELECT entity, period, {r('e')} AS e,
  {r('lag(e) OVER (PARTITION BY entity ORDER BY period)')} AS e_lag FROM res""")
TRAINED = WITHIN.replace("FROM orders JOIN", "FROM (SELECT * FROM orders WHERE "
    f"year(o_orderdate) * 12 + month(o_orderdate) <= {TRAIN_MONTH}) JOIN") + NATION_MONTH.replace(
    "\nnm AS", ",\nfullnm AS")
add("fe_predict", TRAINED, f"""
SELECT entity, period, {r('beta * log_orders')} AS y_pred FROM fullnm CROSS JOIN b
WHERE period > {TRAIN_MONTH}""")
add("fe_predict_entity", TRAINED, f"""
SELECT entity, period, {r('beta * log_orders + yi - beta * xi')} AS y_pred
FROM fullnm JOIN ei USING (entity) CROSS JOIN b WHERE period > {TRAIN_MONTH}""")


def _dynamic(panel: str, name: str) -> str:
    """The target on its own lag with both effects swept out."""
    return panel + f""",
lg AS (SELECT entity, period, log_sales AS y, lag(log_sales) OVER (PARTITION BY entity ORDER BY period) AS x
  FROM {name}),
ok AS (SELECT * FROM lg WHERE x IS NOT NULL),
""" + _demeaned("ok", "dm") + """,
p AS (SELECT sum(x * y) / sum(x * x) AS rho, sum(x * x) AS sxx, count(*) AS n,
  count(DISTINCT entity) AS ne, count(DISTINCT period) AS nt FROM dm)"""


add("fe_many_periods", """
cd AS (SELECT o_custkey AS entity, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS period,
  ln(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)) AS y,
  avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS x FROM orders GROUP BY 1, 2),
""" + _demeaned("cd", "dm") + f""",
p AS (SELECT sum(x * y) / sum(x * x) AS beta, sum(x * x) AS sxx, count(*) AS n,
  count(DISTINCT entity) AS ne, count(DISTINCT period) AS nt FROM dm),
ds AS (SELECT entity, sum(x * (y - beta * x)) AS s FROM dm CROSS JOIN p GROUP BY 1),
v AS (SELECT beta, sqrt(n / CAST({SPARE} AS DOUBLE) * (SELECT sum(s * s) FROM ds)) / sxx AS se FROM p)""",
    f"""SELECT 'urgent_share' AS term, {r('beta')} AS coefficient, {r('se')} AS std_error,
  {r('beta / se')} AS t_stat FROM v""")
add("shock_persistence", _dynamic(NATION_MONTH, "nm"), f"""
SELECT {r('rho')} AS rho,
  {r('CASE WHEN rho > 0 AND rho < 1 THEN -ln(2) / ln(abs(rho)) END')} AS half_life,
  CASE WHEN rho >= 1 THEN 'EXPLOSIVE' WHEN rho > 0.7 THEN 'STRONG' WHEN rho > 0.4 THEN 'MODERATE'
    WHEN rho > 0 THEN 'WEAK' ELSE 'NONE' END AS interpretation FROM p""")
add("dynamic_panel_test", _dynamic(NATION_MONTH, "nm") + f""",
t AS (SELECT y, rho * x AS q FROM ok CROSS JOIN p WHERE period > {TRAIN_MONTH})""", f"""
SELECT 'Dynamic Panel (FE)' AS model, count(*) AS n_test, {r('avg(pow(y - q, 2))')} AS mse,
  {r('sqrt(avg(pow(y - q, 2)))')} AS rmse, {r('avg(abs(y - q))')} AS mae,
  {r('1 - sum(pow(y - q, 2)) / (var_pop(y) * count(*))')} AS r2 FROM t""")
add("dynamic_panel_unbalanced", _dynamic(CUSTOMER_YEAR, "cy") + f""",
ds AS (SELECT entity, sum(x * (y - rho * x)) AS s FROM dm CROSS JOIN p GROUP BY 1),
v AS (SELECT rho, sqrt(n / CAST({SPARE} AS DOUBLE) * (SELECT sum(s * s) FROM ds)) / sxx AS se FROM p)""",
    f"""SELECT 'log_sales_lag1' AS term, {r('rho')} AS coefficient, {r('se')} AS std_error,
  {r('rho / se')} AS t_stat FROM v""")
add("ar1_residual", WITHIN + """,
lr AS (SELECT e, lag(e) OVER (PARTITION BY entity ORDER BY period) AS l FROM res),
ok AS (SELECT * FROM lr WHERE l IS NOT NULL),
rh AS (SELECT sum(e * l) / sum(l * l) AS rho, sum(l * l) AS sll, count(*) AS n FROM ok)""", f"""
SELECT max(rh.n) AS n, {r('max(rho)')} AS rho,
  {r('sqrt(sum(pow(e - rho * l, 2)) / (max(rh.n) - 1) / max(sll))')} AS std_error
FROM ok CROSS JOIN rh""")
add("breusch_pagan", WITHIN + """,
bp AS (SELECT regr_r2(e * e, x0) AS r2, count(*) AS n FROM res)""", f"""
SELECT n, {r('n * r2')} AS lm_stat, {r('r2 / ((1 - r2) / (n - 2))')} AS f_stat FROM bp""")
RANDOM = WITHIN + """,
comp AS (
  SELECT (SELECT sum(yw * yw) - pow(sum(xw * yw), 2) / sum(xw * xw) FROM dd) / (n - 1 - ne + 1) AS s2e,
    (SELECT sum(yi * yi) - pow(sum(xi * yi), 2) / sum(xi * xi) FROM ei) / (ne - 1) AS s2b, * FROM b),
th AS (SELECT *, greatest(0, s2b - s2e * (SELECT sum(1.0 / ti) FROM ei) / ne) AS s2u FROM comp),
qd AS (SELECT y0 - theta * yi AS y, x0 - theta * xi AS x, s2e FROM (
  SELECT y0, x0, yi, xi, s2e, 1 - sqrt(s2e / (ti * s2u + s2e)) AS theta
  FROM (SELECT entity, y0, x0 FROM dd) JOIN ei USING (entity) CROSS JOIN th)),
re AS (SELECT sum(x * y) / sum(x * x) AS beta_re,
  (sum(y * y) - pow(sum(x * y), 2) / sum(x * x)) / (count(*) - 1) / sum(x * x) AS v_re, max(s2e) AS s2e
  FROM qd)"""
add("random_effects", RANDOM,
    f"SELECT 'log_orders' AS term, {r('beta_re')} AS coefficient, {r('s2e')} AS sigma2_e FROM re")
add("hausman", RANDOM, f"""
SELECT {r(f'pow(beta - beta_re, 2) / ((SELECT sum(e * e) FROM res) / {SPARE} / sxx - v_re)')} AS statistic,
  CAST(1 AS BIGINT) AS df FROM re CROSS JOIN b""")
