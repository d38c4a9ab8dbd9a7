"""The catalog's queries as plain SQL, for checking against another engine."""

from __future__ import annotations

from trendcast.plans.bindings import (
    HORIZON, PRIORITY_FLAGS, STATUS_FLAGS, STOP_WORDS, TRAIN_END, VAL_END, WINDOWS,
)

SQL: dict[str, str] = {}

FLAGS, TYPES = list(PRIORITY_FLAGS), list(STATUS_FLAGS)
ALL_FLAGS = {**{n: ("o_orderpriority", v) for n, v in PRIORITY_FLAGS.items()},
             **{n: ("o_orderstatus", v) for n, v in STATUS_FLAGS.items()}}


def _month(col: str) -> str:
    return f"CAST(year({col}) * 12 + month({col}) - 1 AS INTEGER)"


def _hour(col: str) -> str:
    return f"CAST((CAST({col} AS DATE) - DATE '1970-01-01') * 24 + hour({col}) AS INTEGER)"


_ONE_HOT = ", ".join(f"CAST({col} = '{v}' AS INTEGER) AS {n}" for n, (col, v) in ALL_FLAGS.items())
EV = f"ev AS (SELECT *, {_month('o_orderdate')} AS period, {_ONE_HOT} FROM orders)"
HR = f"hr AS (SELECT *, {_hour('ts')} AS period FROM events)"
LM = f"lm AS (SELECT *, {_month('l_shipdate')} AS period FROM lineitem)"
RAW = f"""raw AS (
  SELECT concat('k', CAST(o_orderkey // 2 AS VARCHAR)) AS order_id,
    CASE WHEN o_orderkey % 11 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS order_date,
    CASE WHEN o_orderkey % 17 = 0 THEN 'n/a'
         WHEN o_orderkey % 13 = 0 THEN concat(CAST(year(o_orderdate) AS VARCHAR), '.7')
         WHEN o_orderkey % 29 = 0 THEN '1969' WHEN o_orderkey % 31 = 0 THEN '2099'
         ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
    CASE o_orderkey % 7 WHEN 0 THEN '0.5' WHEN 1 THEN '2' WHEN 2 THEN '-1' WHEN 3 THEN 'NaN'
         WHEN 4 THEN '0.7' WHEN 5 THEN '1' END AS kw_rush,
    o_orderkey AS seq FROM orders)"""
_DATE = "CAST(try_strptime(order_date, '%d/%m/%Y') AS DATE)"
_YEAR_NUM = "try_cast(year AS DOUBLE)"
_YEAR_INT = f"CAST(trunc({_YEAR_NUM}) AS INTEGER)"
_FLAG = """CAST(round_even(greatest(0.0, least(1.0, coalesce(CASE WHEN isnan(try_cast(kw_rush AS DOUBLE)) THEN NULL
  ELSE try_cast(kw_rush AS DOUBLE) END, 0.0))), 0) AS INTEGER)"""

SQL["clean_events"] = f"""WITH {RAW}, first AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) = 1)
SELECT order_id, {_DATE} AS order_date, {_YEAR_INT} AS year, {_FLAG} AS kw_rush, seq
FROM first WHERE {_YEAR_INT} BETWEEN 1970 AND 2035"""
SQL["dedup_first"] = """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"""
SQL["dedup_rows"] = "SELECT DISTINCT lang, text FROM documents"
SQL["coerce_flags"] = f"WITH {RAW} SELECT seq, {_FLAG} AS kw_rush FROM raw"
SQL["parse_dates"] = f"WITH {RAW} SELECT seq, {_DATE} AS order_date, {_YEAR_NUM} AS year FROM raw"
SQL["valid_period_filter"] = f"WITH {RAW} SELECT seq, {_YEAR_INT} AS year FROM raw WHERE {_YEAR_INT} BETWEEN 1970 AND 2035"

_NULL_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
SQL["null_profile"] = "WITH t AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
    f"(count(*) - count({c})) / count(*) * 100 AS missing_pct FROM t" for c in _NULL_COLUMNS)
SQL["fill_missing"] = """SELECT d.doc_id, CASE WHEN toxic = 1 THEN source ELSE 'missing' END AS flagged_source,
  coalesce(CAST(quality AS DOUBLE), 0.0) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
SQL["parsed_parameters"] = """SELECT event_id, CAST(len(json_keys(props)) AS INTEGER) AS n_params,
  CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events"""

SQL["period_counts"] = f"WITH {HR} SELECT period, count(*) AS n FROM hr GROUP BY period"
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in FLAGS)
_TYPE_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in TYPES)
SQL["flag_trends"] = f"WITH {EV} SELECT period, {_SUMS} FROM ev GROUP BY period"
SQL["type_trends"] = f"WITH {EV} SELECT period, {_TYPE_SUMS} FROM ev GROUP BY period"
_SHARES = ", ".join(f"sum({c}) / count(*) AS {c}_share" for c in FLAGS)
_TYPE_TOTAL = " + ".join(f"sum({c})" for c in TYPES)
_TYPE_SHARES = ", ".join(f"sum({c}) / nullif({_TYPE_TOTAL}, 0) AS {c}_share" for c in TYPES)
SQL["flag_shares"] = f"WITH {EV} SELECT period, {_SHARES} FROM ev GROUP BY period"
SQL["type_shares"] = f"WITH {EV} SELECT period, {_TYPE_SHARES} FROM ev GROUP BY period"
SQL["measure_means"] = f"WITH {EV} SELECT period, round(avg(o_totalprice), 4) AS o_totalprice FROM ev GROUP BY period"
SQL["period_summary"] = f"""WITH {LM}, c AS (SELECT period, count(*) AS n FROM lm GROUP BY period)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, 11 AS n_columns, min(period) AS start_period, max(period) AS end_period,
  CAST(sum(n) AS BIGINT) AS total, avg(n) AS average_per_period, max(n) AS max_in_a_period, min(n) AS min_in_a_period FROM c"""
SQL["segment_trends"] = f"""WITH {HR} SELECT period, coalesce(event_type, 'missing') AS event_type, count(*) AS n
FROM hr GROUP BY ALL"""
SQL["segment_trends_topn"] = f"""WITH {LM}, top AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS s, count(*) AS n FROM lm GROUP BY ALL ORDER BY n DESC, s LIMIT 5)
SELECT period, CASE WHEN CAST(l_suppkey AS VARCHAR) IN (SELECT s FROM top) THEN CAST(l_suppkey AS VARCHAR)
  ELSE 'other' END AS l_suppkey, count(*) AS n FROM lm GROUP BY ALL"""
SQL["segment_shares"] = f"""WITH {LM}, c AS (SELECT period, l_returnflag, count(*) AS n FROM lm GROUP BY ALL)
SELECT period, l_returnflag, n, n / sum(n) OVER (PARTITION BY period) AS share FROM c"""
SQL["segment_wide"] = f"""WITH {LM} SELECT period, """ + ", ".join(
    f"count(*) FILTER (WHERE l_returnflag = '{v}') AS n_{v}" for v in "ANR") + " FROM lm GROUP BY period"
SQL["segment_long"] = f"WITH {EV} " + " UNION ALL ".join(
    f"SELECT period, '{c}_share' AS name, sum({c}) / count(*) AS value FROM ev GROUP BY period" for c in FLAGS)
SQL["period_spine"] = f"""WITH {HR}, b AS (SELECT min(period) AS lo, max(period) AS hi FROM hr),
c AS (SELECT event_type, period, count(*) AS n FROM hr GROUP BY ALL),
spine AS (SELECT event_type, CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS period
  FROM (SELECT DISTINCT event_type FROM hr), b)
SELECT s.event_type, s.period, coalesce(n, 0) AS n FROM spine s
LEFT JOIN c ON c.event_type = s.event_type AND c.period = s.period"""

_PAIR = ("SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(covar_samp({a}, {b}) / "
         "nullif(stddev_samp({a}) * stddev_samp({b}), 0), 6) AS r FROM ev")
SQL["flag_correlation"] = f"WITH {EV} " + " UNION ALL ".join(
    _PAIR.format(a=a, b=b) for a in [*FLAGS, *TYPES] for b in [*FLAGS, *TYPES])
_EVIDENCE_COLUMNS = [*[f"{c}_share" for c in (*FLAGS, *TYPES)], "o_totalprice"]
_PERIODS = f"""{EV}, p AS (SELECT period, count(*) AS n, {_SHARES}, {_TYPE_SHARES}, avg(o_totalprice) AS o_totalprice
  FROM ev GROUP BY period)"""


def _group(name: str) -> str:
    return "keyword_share" if name.startswith("kw_") else "patent_type_share" if name.startswith("is_") else "other"


_EVIDENCE = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, '{_group(c)}' AS feature_group, count(*) - count({c}) AS missing_count,
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(covar_samp({c}, n) / nullif(stddev_samp({c}) * stddev_samp(n), 0), 4) AS correlation_with_target,
  round(abs(covar_samp({c}, n) / nullif(stddev_samp({c}) * stddev_samp(n), 0)), 4) AS abs_correlation_with_target
FROM p""" for c in _EVIDENCE_COLUMNS)
SQL["feature_evidence"] = f"WITH {_PERIODS} {_EVIDENCE}"
SQL["top_evidence"] = f"""WITH {_PERIODS}, e AS ({_EVIDENCE}) SELECT * FROM e
ORDER BY abs_correlation_with_target DESC NULLS LAST, feature LIMIT 8"""


def _lags(source: str, keys: str = "", shares: list[str] = (), zero: bool = False) -> str:
    """CTEs g1, lagged over ``source`` (keys, period, n, shares)."""
    part = f"PARTITION BY {keys} " if keys else ""
    w = f"({part}ORDER BY period)"
    growth = "(n - lag(n) OVER w) / nullif(lag(n) OVER w, 0)"
    if zero:
        growth = f"coalesce({growth}, 0.0)"
    lagged = "".join(f", lag({s}) OVER w AS {s}_lag_1" for s in shares)
    return f"""g1 AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS trend, lag(n) OVER w AS lag_1,
  lag(n, 2) OVER w AS lag_2, {growth} AS growth_rate FROM {source} WINDOW w AS {w}),
lagged AS (SELECT *, lag(growth_rate) OVER w AS growth_rate_lag_1{lagged} FROM g1 WINDOW w AS {w})"""


_FLAG_SHARES = [f"{c}_share" for c in FLAGS]
_MODEL_BASE = f"{EV}, base AS (SELECT period, count(*) AS n, {_SUMS}, {_SHARES} FROM ev GROUP BY period)"
_MODEL = f"{_MODEL_BASE}, {_lags('base', shares=_FLAG_SHARES)}"
SQL["growth_rate"] = f"WITH {_MODEL} SELECT period, n, trend, lag_1, lag_2, growth_rate FROM lagged"
SQL["modelling_dataset"] = f"WITH {_MODEL} SELECT * FROM lagged"
SQL["modelling_dataset_by_segment"] = f"""WITH {EV},
base AS (SELECT o_orderstatus, period, count(*) AS n, {_SUMS}, {_SHARES} FROM ev GROUP BY o_orderstatus, period),
{_lags('base', 'o_orderstatus', _FLAG_SHARES)} SELECT * FROM lagged"""
SQL["segment_modelling_dataset"] = f"WITH dense AS ({SQL['period_spine']}), {_lags('dense', 'event_type', zero=True)} SELECT * FROM lagged"
_FEATURES = ["trend", "lag_1", "lag_2", "growth_rate_lag_1", *[f"{s}_lag_1" for s in _FLAG_SHARES]]
_KNOWN = " AND ".join(f"{f} IS NOT NULL" for f in _FEATURES)
SQL["model_rows"] = f"WITH {_MODEL} SELECT period, n, {', '.join(_FEATURES)} FROM lagged WHERE {_KNOWN}"


def _reason(f: str) -> tuple[bool, str]:
    if f == "trend":
        return True, "known ahead: the calendar trend is fixed"
    if f.startswith("lag_"):
        return True, "past only: lagged totals"
    if f.endswith("_lag_1"):
        return True, "past only: engineered feature of the previous period"
    return False, "unsafe: needs values of the period being predicted"


SQL["leakage_audit"] = f"WITH {_MODEL} " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {str(_reason(f)[0]).lower()} AS is_leakage_safe, '{_reason(f)[1]}' AS reason, "
    f"count({f}) AS n_known FROM lagged" for f in [*_FEATURES, "growth_rate"])
_SETS = {"trend_only": _FEATURES[:1], "trend_plus_lags": _FEATURES[:3], "trend_lags_growth": _FEATURES[:4],
         "full_feature_set": _FEATURES}
SQL["ablation_sets"] = f"WITH {_MODEL} " + " UNION ALL ".join(
    f"SELECT '{name}' AS feature_set, {len(fs)} AS n_features, count(*) AS n_rows FROM lagged WHERE "
    + " AND ".join(f"{f} IS NOT NULL" for f in fs) for name, fs in _SETS.items())

# --- series per nation ------------------------------------------------------------------------------
_NATION = f"""nv AS (SELECT c_nationkey AS nation, {_month('o_orderdate')} AS period
  FROM orders JOIN customer ON c_custkey = o_custkey),
nb AS (SELECT min(period) AS lo, max(period) AS hi FROM nv),
nc AS (SELECT nation, period, count(*) AS n FROM nv GROUP BY ALL),
ns AS (SELECT nation, CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS period FROM (SELECT DISTINCT nation FROM nv), nb),
nd AS (SELECT ns.nation, ns.period, coalesce(n, 0) AS n FROM ns
  LEFT JOIN nc ON nc.nation = ns.nation AND nc.period = ns.period)"""
_NLAG = f"{_NATION}, {_lags('nd', 'nation')}"
_NROWS = f"{_NLAG}, rows_ AS (SELECT nation, period, n, trend, lag_1, lag_2 FROM lagged WHERE lag_2 IS NOT NULL)"
_TAIL = """tail AS (SELECT nation, CAST(period AS INTEGER) AS last_period, trend AS last_trend,
  CAST(n AS DOUBLE) AS last_value, CAST(lag_1 AS DOUBLE) AS previous_value, growth_rate AS last_growth
  FROM lagged QUALIFY row_number() OVER (PARTITION BY nation ORDER BY period DESC) = 1)"""
SQL["last_values"] = f"WITH {_NLAG}, {_TAIL} SELECT * FROM tail"
SQL["chrono_split"] = f"""WITH {_NROWS} SELECT * FROM (SELECT nation, period, n,
  CASE WHEN period <= {TRAIN_END - 3} THEN 'train' WHEN period BETWEEN {TRAIN_END + 1} AND {VAL_END} THEN 'validation'
       WHEN period > {VAL_END} THEN 'test' END AS split FROM rows_) WHERE split IS NOT NULL"""
_WTABLE = "win(window_id, train_end, val_start, val_end) AS (VALUES " + ", ".join(
    f"({i}, {w.train_end}, {w.val_start}, {w.val_end})" for i, w in enumerate(WINDOWS, 1)) + ")"


def _sizes(rows: str, keys: str) -> str:
    head = f"{keys}, " if keys else ""
    return f"""sizes AS (SELECT {head}window_id, train_end, val_start, val_end,
  min(period) FILTER (WHERE period <= train_end) AS train_start,
  count(*) FILTER (WHERE period <= train_end) AS n_train,
  count(*) FILTER (WHERE period BETWEEN val_start AND val_end) AS n_validation
  FROM {rows} JOIN win ON period <= train_end OR period BETWEEN val_start AND val_end GROUP BY ALL
  HAVING n_train > 0 AND n_validation > 0)"""


SQL["rolling_windows"] = f"WITH {_NROWS}, {_WTABLE}, {_sizes('rows_', 'nation')} SELECT * FROM sizes"
SQL["trial_windows"] = f"""WITH {_MODEL}, r1 AS (SELECT period FROM lagged WHERE lag_1 IS NOT NULL),
{_WTABLE}, {_sizes('r1', '')}, lr(a) AS (VALUES ('0.01'), ('0.05'), ('0.1')), md(b) AS (VALUES ('2'), ('3'), ('4'))
SELECT window_id, n_train, n_validation, '{{"learning_rate": ' || a || ', "max_depth": ' || b || '}}' AS hyperparameters
FROM sizes, lr, md"""
_METRICS = """round(avg(abs(actual - predicted)), 4) AS "MAE",
  round(sqrt(avg((actual - predicted) * (actual - predicted))), 4) AS "RMSE",
  round(avg(abs((actual - predicted) / nullif(actual, 0))) * 100, 4) AS "MAPE\""""
_NAIVE_HELD = f"""held AS (SELECT nation, window_id, CAST(n AS DOUBLE) AS actual, greatest(CAST(lag_1 AS DOUBLE), 0.0) AS predicted
  FROM rows_ JOIN win ON period BETWEEN val_start AND val_end)"""


def _detailed(model: str) -> str:
    return f"""scores AS (SELECT nation, window_id, {_METRICS} FROM held GROUP BY ALL),
detailed AS (SELECT nation, '{model}' AS model, window_id, train_start, train_end, val_start, val_end, n_train,
  n_validation, '{{}}' AS hyperparameters, "MAE", "RMSE", "MAPE" FROM sizes JOIN scores USING (nation, window_id))"""


_NAIVE = f"{_NROWS}, {_WTABLE}, {_sizes('rows_', 'nation')}, {_NAIVE_HELD}, {_detailed('Naive Last Value')}"
SQL["naive_backtest"] = f"WITH {_NAIVE} SELECT * FROM detailed"
SQL["rolling_summary"] = f"""WITH {_NAIVE} SELECT nation, model, hyperparameters, round(avg("MAE"), 6) AS "average_MAE",
  round(avg("RMSE"), 6) AS "average_RMSE", round(avg("MAPE"), 6) AS "average_MAPE" FROM detailed GROUP BY ALL"""
SQL["best_window"] = f"""WITH {_NAIVE} SELECT nation, window_id, "RMSE" FROM detailed
ORDER BY "RMSE", "MAE", nation, window_id LIMIT 1"""
SQL["forecast_metrics"] = f"""WITH {_NROWS}, s AS (SELECT nation, CASE WHEN period <= {TRAIN_END} THEN 'train'
  WHEN period <= {VAL_END} THEN 'validation' ELSE 'test' END AS split, CAST(n AS DOUBLE) AS actual, lag_1 AS predicted FROM rows_)
SELECT nation, split, {_METRICS} FROM s GROUP BY ALL"""

_STEPS = "steps AS (SELECT CAST(unnest(generate_series(1, {h})) AS INTEGER) AS s)"
SQL["naive_future"] = f"""WITH RECURSIVE {_NLAG}, {_TAIL}, path AS (
  SELECT nation, last_period + 1 AS period, CAST(last_trend + 1 AS DOUBLE) AS trend, last_value AS lag_1,
    previous_value AS lag_2, (last_value - previous_value) / nullif(previous_value, 0) AS growth_rate,
    last_growth AS growth_rate_lag_1, last_value AS predicted, 1 AS s FROM tail
  UNION ALL SELECT nation, period + 1, trend + 1, predicted, lag_1, (predicted - lag_1) / nullif(lag_1, 0),
    growth_rate, predicted, s + 1 FROM path WHERE s < {HORIZON})
SELECT * EXCLUDE (s) FROM path"""
_TREND = """fit AS (SELECT nation, coalesce(regr_intercept(n, trend), avg(n)) AS a, coalesce(regr_slope(n, trend), 0) AS b
  FROM lagged GROUP BY nation)"""
SQL["trend_ols"] = f"""WITH {_NLAG}, {_TREND} SELECT nation, 'intercept' AS feature, round(a, 6) AS coefficient FROM fit
UNION ALL SELECT nation, 'trend', round(b, 6) FROM fit"""
SQL["trend_ols_future"] = f"""WITH {_NLAG}, {_TREND}, {_TAIL}, {_STEPS.format(h=HORIZON)}
SELECT nation, last_period + s AS period, round(greatest(a + b * (last_trend + s), 0.0), 4) AS predicted
FROM tail JOIN fit USING (nation), steps"""
SQL["ar1_future"] = f"""WITH RECURSIVE {_NLAG}, {_TAIL}, fit AS (SELECT nation,
  coalesce(regr_intercept(n, lag_1), avg(n)) AS a, coalesce(regr_slope(n, lag_1), 0) AS b
  FROM lagged WHERE lag_1 IS NOT NULL GROUP BY nation), path AS (
  SELECT nation, last_period + 1 AS period, a + b * last_value AS y, 1 AS s FROM tail JOIN fit USING (nation)
  UNION ALL SELECT p.nation, period + 1, a + b * y, s + 1 FROM path p JOIN fit ON fit.nation = p.nation WHERE s < {HORIZON})
SELECT nation, period, round(y, 4) AS predicted FROM path"""


# --- least squares in SQL ---------------------------------------------------------------------------
def _orthogonal_fit(source: str, keys: str, xs: list[str], prefix: str = "q") -> tuple[str, str]:
    """Least squares by successive residuals on rows with role = 'train'.

    Returns the CTEs (the last one, ``{prefix}coef``, has one row per group with
    means, residual coefficients b_jk and weights c_j) and the expression that
    predicts from columns named like the features.
    """
    using = f"USING ({keys})"
    p = len(xs)
    means = ", ".join(f"avg({x}) AS m{i}" for i, x in enumerate(xs))
    parts = [f"{prefix}m AS (SELECT {keys}, {means}, avg(y) AS my FROM {source} WHERE role = 'train' GROUP BY {keys})",
             f"{prefix}r0 AS (SELECT {keys}, y - my AS yr, "
             + ", ".join(f"{x} - m{i} AS z{i}" for i, x in enumerate(xs))
             + f" FROM {source} JOIN {prefix}m {using} WHERE role = 'train')"]
    for j in range(p):
        later = range(j + 1, p)
        stats = [f"sum(z{j} * yr) / sum(z{j} * z{j}) AS c{j}"]
        stats += [f"sum(z{j} * z{k}) / sum(z{j} * z{j}) AS b{j}_{k}" for k in later]
        parts.append(f"{prefix}s{j} AS (SELECT {keys}, {', '.join(stats)} FROM {prefix}r{j} GROUP BY {keys})")
        if j + 1 < p:
            cols = [f"yr - c{j} * z{j} AS yr"] + [f"z{k} - b{j}_{k} * z{j} AS z{k}" for k in later]
            parts.append(f"{prefix}r{j + 1} AS (SELECT {keys}, {', '.join(cols)} FROM {prefix}r{j} JOIN {prefix}s{j} {using})")
    joins = " ".join(f"JOIN {prefix}s{j} {using}" for j in range(p))
    parts.append(f"{prefix}coef AS (SELECT * FROM {prefix}m {joins})")
    terms: list[str] = []
    for k, x in enumerate(xs):
        terms.append("(" + f"{x} - m{k}" + "".join(f" - b{j}_{k} * {terms[j]}" for j in range(k)) + ")")
    return ", ".join(parts), "my" + "".join(f" + c{j} * {t}" for j, t in enumerate(terms))


def _slopes(p: int) -> list[str]:
    """Coefficients on the features themselves, by back substitution."""
    slopes = [""] * p
    for k in reversed(range(p)):
        slopes[k] = f"(c{k}" + "".join(f" - b{k}_{j} * {slopes[j]}" for j in range(k + 1, p)) + ")"
    return slopes


_X3 = ["trend", "lag_1", "lag_2"]
_Q3, _P3 = _orthogonal_fit("tagged", "nation, window_id", _X3)
SQL["linear_backtest"] = f"""WITH {_NROWS}, {_WTABLE}, {_sizes('rows_', 'nation')},
tagged AS (SELECT nation, window_id, period, CAST(n AS DOUBLE) AS y, {', '.join(f'CAST({x} AS DOUBLE) AS {x}' for x in _X3)},
  CASE WHEN period <= train_end THEN 'train' ELSE 'held' END AS role
  FROM rows_ JOIN win ON period <= train_end OR period BETWEEN val_start AND val_end),
{_Q3}, held AS (SELECT nation, window_id, y AS actual, greatest({_P3}, 0.0) AS predicted
  FROM tagged JOIN qcoef USING (nation, window_id) WHERE role = 'held'),
{_detailed('Linear Regression')} SELECT * FROM detailed"""
_QC, _ = _orthogonal_fit("tagged", "nation", _X3)
_S3 = _slopes(3)
SQL["linear_coefficients"] = f"""WITH {_NROWS}, tagged AS (SELECT nation, CAST(n AS DOUBLE) AS y,
  {', '.join(f'CAST({x} AS DOUBLE) AS {x}' for x in _X3)}, 'train' AS role FROM rows_ WHERE period <= {VAL_END}), {_QC}
SELECT nation, 'intercept' AS feature, round(my - {' - '.join(f'm{i} * {s}' for i, s in enumerate(_S3))}, 6) AS coefficient FROM qcoef
""" + " ".join(f"UNION ALL SELECT nation, '{x}', round({s}, 6) FROM qcoef" for x, s in zip(_X3, _S3))

# --- segmented forecasts ----------------------------------------------------------------------------
_X4 = ["trend", "lag_1", "lag_2", "growth_rate_lag_1"]
_CAST4 = ", ".join(f"CAST({x} AS DOUBLE) AS {x}" for x in _X4)


def _scheme(source: str, key: str, out: str) -> str:
    """CTEs giving held-out predictions ``{out}held`` and futures ``{out}future`` for naive and linear."""
    q, predict = _orthogonal_fit(f"{out}tagged", f"{key}, split", _X4, f"{out}q")
    at = {"trend": "({t})", "lag_1": "({y1})", "lag_2": "({y2})", "growth_rate_lag_1": "({g})"}

    def future(t: str, y1: str, y2: str, g: str) -> str:
        """Prediction at values given as SQL: only the final form of each feature is substituted."""
        values = {k: v.format(t=t, y1=y1, y2=y2, g=g) for k, v in at.items()}
        terms: list[str] = []
        for k, x in enumerate(_X4):
            terms.append("(" + f"{values[x]} - m{k}" + "".join(f" - b{j}_{k} * {terms[j]}" for j in range(k)) + ")")
        return "greatest(my" + "".join(f" + c{j} * {v}" for j, v in enumerate(terms)) + ", 0.0)"

    first = future("CAST(last_trend + 1 AS DOUBLE)", "last_value", "previous_value", "coalesce(last_growth, 0.0)")
    later = future("t + 1", "y", "y1", "coalesce(g, 0.0)")
    return f"""{out}lag AS (SELECT {key}, period, n, {_CAST4}, growth_rate FROM {source}),
{out}rows AS (SELECT * FROM {out}lag WHERE lag_2 IS NOT NULL AND growth_rate_lag_1 IS NOT NULL),
{out}tagged AS (
  SELECT {key}, 'validation' AS split, period, CAST(n AS DOUBLE) AS y, {', '.join(_X4)},
    CASE WHEN period <= {TRAIN_END} THEN 'train' ELSE 'held' END AS role FROM {out}rows WHERE period <= {VAL_END}
  UNION ALL SELECT {key}, 'test', period, CAST(n AS DOUBLE), {', '.join(_X4)},
    CASE WHEN period <= {VAL_END} THEN 'train' ELSE 'held' END FROM {out}rows
  UNION ALL SELECT {key}, 'future', period, CAST(n AS DOUBLE), {', '.join(_X4)}, 'train' FROM {out}rows),
{q},
{out}held AS (
  SELECT {key}, 'Linear Regression' AS model, split, period, y AS actual, greatest({predict}, 0.0) AS predicted
  FROM {out}tagged JOIN {out}qcoef USING ({key}, split) WHERE role = 'held'
  UNION ALL SELECT {key}, 'Naive Last Value', split, period, y, greatest(lag_1, 0.0) FROM {out}tagged WHERE role = 'held'),
{out}tail AS (SELECT {key}, period AS last_period, trend AS last_trend, CAST(n AS DOUBLE) AS last_value, lag_1 AS previous_value,
  growth_rate AS last_growth FROM {out}lag QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY period DESC) = 1),
{out}path AS (
  SELECT {key}, last_period + 1 AS period, CAST(last_trend + 1 AS DOUBLE) AS t, last_value AS y1,
    (last_value - previous_value) / nullif(previous_value, 0) AS g, {first} AS y, 1 AS s
  FROM {out}tail JOIN {out}qcoef USING ({key}) WHERE split = 'future'
  UNION ALL SELECT p.{key}, p.period + 1, t + 1, y, (y - y1) / nullif(y1, 0), {later}, s + 1
  FROM {out}path p JOIN {out}qcoef c ON p.{key} = c.{key} AND c.split = 'future' WHERE s < {HORIZON}),
{out}future AS (SELECT {key}, 'Linear Regression' AS model, period, y AS predicted FROM {out}path
  UNION ALL SELECT {key}, 'Naive Last Value', last_period + CAST(k AS INTEGER), last_value FROM {out}tail,
    (SELECT unnest(generate_series(1, {HORIZON})) AS k))"""


_NZERO = f"{_NATION}, {_lags('nd', 'nation', zero=True)}"
_SEG = f"{_NZERO}, {_scheme('lagged', 'nation', 's')}"
_TOTALS = "totals AS (SELECT period, CAST(count(*) AS DOUBLE) AS actual FROM nv GROUP BY period)"
_SUMMED = f"""{_TOTALS}, summed AS (SELECT 'by_nation' AS scheme, model, split, period, sum(predicted) AS predicted
  FROM sheld GROUP BY model, split, period),
preds AS (SELECT scheme, model, split, period, actual, predicted FROM summed LEFT JOIN totals USING (period))"""
_METRIC_ROWS = f"""mrows AS (SELECT scheme, CAST(NULL AS VARCHAR) AS cluster, model, split, {_METRICS},
    (SELECT CAST(count(DISTINCT nation) AS INTEGER) FROM nd) AS n_clusters FROM preds GROUP BY scheme, model, split
  UNION ALL SELECT 'by_nation', CAST(nation AS VARCHAR), model, split, {_METRICS}, NULL FROM sheld GROUP BY nation, model, split)"""
_FUTURE_ROWS = """frows AS (SELECT 'by_nation' AS scheme, model, CAST(nation AS VARCHAR) AS cluster, period,
    round(predicted, 4) AS predicted FROM sfuture
  UNION ALL SELECT 'by_nation', model, 'aggregated_total', period, round(sum(predicted), 4) FROM sfuture GROUP BY model, period)"""
SQL["segmented_predictions"] = f"""WITH RECURSIVE {_SEG}, {_SUMMED}
SELECT scheme, model, split, period, actual, round(predicted, 4) AS predicted FROM preds"""
SQL["segmented_metrics"] = f"WITH RECURSIVE {_SEG}, {_SUMMED}, {_METRIC_ROWS} SELECT * FROM mrows"
SQL["segmented_future"] = f"WITH RECURSIVE {_SEG}, {_FUTURE_ROWS} SELECT * FROM frows"
_BASE = f"""td AS (SELECT 0 AS one, period, n FROM (SELECT period, count(*) AS n FROM nv GROUP BY period)),
tg AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS trend, lag(n) OVER w AS lag_1, lag(n, 2) OVER w AS lag_2,
  coalesce((n - lag(n) OVER w) / nullif(lag(n) OVER w, 0), 0.0) AS growth_rate FROM td WINDOW w AS (ORDER BY period)),
tl AS (SELECT *, lag(growth_rate) OVER (ORDER BY period) AS growth_rate_lag_1 FROM tg),
{_scheme('tl', 'one', 'b')}"""
SQL["baseline_vs_segmented"] = f"""WITH RECURSIVE {_SEG}, {_BASE}, {_SUMMED}, {_METRIC_ROWS}
SELECT 'no_segmentation' AS scheme, model, split, {_METRICS}, 1 AS n_clusters FROM bheld
WHERE model = 'Linear Regression' GROUP BY model, split
UNION ALL SELECT scheme, model, split, "MAE", "RMSE", "MAPE", n_clusters FROM mrows
WHERE cluster IS NULL AND model = 'Linear Regression'"""
SQL["future_comparison"] = f"""WITH RECURSIVE {_SEG}, {_BASE}, {_FUTURE_ROWS}
SELECT 'no_segmentation' AS scheme, model, period, round(predicted, 4) AS predicted_total FROM bfuture
WHERE model = 'Linear Regression'
UNION ALL SELECT scheme, model, period, predicted AS predicted_total FROM frows
WHERE cluster = 'aggregated_total' AND model = 'Linear Regression'"""
SQL["total_future"] = f"""WITH RECURSIVE {_SEG}, {_BASE}
SELECT model, period, round(predicted, 4) AS predicted FROM bfuture"""

# --- text -------------------------------------------------------------------------------------------
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_TERMS = f"""words AS (SELECT doc_id, lang, list_filter(
  regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]{{2,}}'), lambda w: w NOT IN ({_STOP})) AS w FROM documents),
grams AS (SELECT doc_id, lang, unnest(w) AS term FROM words UNION ALL
  SELECT doc_id, lang, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
tf AS (SELECT doc_id, lang, term, count(*) AS tf FROM grams GROUP BY ALL),
vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM tf GROUP BY term HAVING df >= 3
  ORDER BY tf DESC, term LIMIT 1000)"""
_WEIGHTS = f"""{_TERMS}, raw AS (SELECT doc_id, lang, tf.term,
    tf.tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
  FROM tf JOIN vocab ON vocab.term = tf.term),
weights AS (SELECT doc_id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""
SQL["term_statistics"] = f"WITH {_TERMS} SELECT term, tf, df FROM vocab"
SQL["tfidf_weights"] = f"WITH {_WEIGHTS} SELECT doc_id, term, round(weight, 6) AS weight FROM weights"
SQL["top_terms"] = f"""WITH {_WEIGHTS}, sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
means AS (SELECT lang, term, round(sum(weight) / any_value(n), 9) AS weight FROM weights JOIN sizes USING (lang) GROUP BY ALL),
best AS (SELECT * FROM means WHERE weight > 0
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term DESC) <= 8)
SELECT lang, string_agg(term, ', ' ORDER BY weight DESC, term DESC) AS top_terms FROM best GROUP BY lang"""

# --- vectors ----------------------------------------------------------------------------------------
_VECTORS = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def _silhouette(distance: str) -> str:
    return f"""pairs AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS total, count(*) AS n
  FROM v a CROSS JOIN v b GROUP BY ALL),
ab AS (SELECT vec_id, max(n) FILTER (WHERE own = other) AS n_own,
  max(total / nullif(n - 1, 0)) FILTER (WHERE own = other) AS a, min(total / n) FILTER (WHERE own <> other) AS b
  FROM pairs GROUP BY vec_id)
SELECT round(avg(CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM ab"""


SQL["silhouette_labels"] = f"WITH {_VECTORS}, {_silhouette('list_distance(a.e, b.e)')}"
SQL["silhouette_squared"] = f"WITH {_VECTORS}, {_silhouette('list_distance(a.e, b.e) ** 2')}"
SQL["nearest_centroid"] = f"""WITH {_VECTORS}, cells AS (SELECT vec_id, label, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
means AS (SELECT label, i, avg(x) AS m FROM cells GROUP BY label, i),
centres AS (SELECT label AS c, list(m ORDER BY i) AS m FROM means GROUP BY label)
SELECT vec_id, label, c AS nearest, round(list_distance(e, m) ** 2, 6) AS squared_distance FROM v CROSS JOIN centres
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(e, m), c) = 1"""

_DOCS = """docs AS (SELECT d.doc_id, d.text, lang, source, quality, toxic, CAST(n_chars AS DOUBLE) AS len_chars,
  CAST(len(string_split(d.text, ' ')) AS DOUBLE) AS len_words,
  CAST(regexp_matches(d.text, '[0-9]') AS INTEGER) AS kw_number,
  CAST(regexp_matches(d.text, '[A-Z]{2}') AS INTEGER) AS kw_acronym,
  CAST(contains(d.text, '@') AS INTEGER) AS kw_address,
  CAST(lang = 'en' AS INTEGER) AS is_english, CAST(lang <> 'en' AS INTEGER) AS is_other_lang
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
_SCALED = ["len_chars", "len_words", "kw_number", "kw_acronym", "quality"]
SQL["scaled_features"] = f"""WITH {_DOCS}, f AS (SELECT doc_id, {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0) AS {c}' for c in _SCALED)} FROM docs)
SELECT doc_id, """ + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM f)) / coalesce(nullif((SELECT stddev_pop({c}) FROM f), 0), 1), 6) AS z_{c}"
    for c in _SCALED) + " FROM f"
SQL["segment_balance"] = """SELECT 'by_lang' AS scheme, lang AS cluster, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM documents), 4) AS share FROM documents GROUP BY lang"""
_BALANCES = " UNION ALL ".join(
    f"""SELECT 'by_{c}' AS scheme, {c} AS cluster, round(count(*) / (SELECT count(*) FROM documents), 4) AS share
FROM documents GROUP BY {c}""" for c in ("lang", "source"))
SQL["smallest_segment"] = f"""WITH b AS ({_BALANCES}) SELECT scheme, cluster, share FROM b
QUALIFY row_number() OVER (PARTITION BY scheme ORDER BY share, cluster) = 1"""


def _dominant(columns: list[str]) -> str:
    best = f"greatest({', '.join(f'avg({c})' for c in columns)})"
    return "CASE " + " ".join(f"WHEN avg({c}) = {best} THEN '{c}'" for c in columns) + " END"


SQL["segment_profile"] = f"""WITH {_DOCS} SELECT source AS cluster, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM docs), 4) AS share, round(avg(doc_id), 2) AS avg_period,
  round(avg(len_words), 2) AS avg_len_words, round(avg(len_chars), 2) AS avg_len_chars,
  {_dominant(['kw_number', 'kw_acronym', 'kw_address'])} AS dominant_flag,
  {_dominant(['is_english', 'is_other_lang'])} AS dominant_type FROM docs GROUP BY source"""
SQL["limitations"] = f"""WITH {EV}, {_VECTORS}, sil AS (WITH {_silhouette('list_distance(a.e, b.e) ** 2')}),
b AS ({_BALANCES}), small AS (SELECT * FROM b WHERE scheme = 'by_lang' ORDER BY share, cluster LIMIT 1)
SELECT 'sample_size' AS theme, count(DISTINCT period) || ' periods available' AS evidence FROM ev
UNION ALL SELECT 'recursive_forecasting', 'horizon of {HORIZON} periods'
UNION ALL SELECT 'given_labels_separation', printf('best silhouette %.4f', round(silhouette, 4)) FROM sil
UNION ALL SELECT 'cluster_imbalance', printf('%s: %s %.4f', scheme, cluster, share) FROM small"""

# --- models: what holds whatever the fit ------------------------------------------------------------
_TROWS = f"{_MODEL}, trows AS (SELECT period, n FROM lagged WHERE lag_2 IS NOT NULL)"
_BOUNDS = "window_id, train_start, train_end, val_start, val_end, n_train, n_validation, true AS scores_are_sane"
for _name, _label in (("forest_backtest", "Random Forest"), ("boosting_backtest", "Gradient Boosting")):
    SQL[_name] = f"WITH {_TROWS}, {_WTABLE}, {_sizes('trows', '')} SELECT '{_label}' AS model, {_BOUNDS} FROM sizes"
SQL["pooled_forest_backtest"] = f"""WITH {_NROWS}, {_WTABLE}, {_sizes('rows_', 'nation')}
SELECT nation, 'Random Forest' AS model, {_BOUNDS} FROM sizes"""
SQL["feature_importances"] = "SELECT unnest(['trend', 'lag_1', 'lag_2', 'growth_rate_lag_1']) AS feature, true AS not_negative, 1.0::DOUBLE AS total"
SQL["tree_future"] = f"""WITH {EV}, last AS (SELECT max(period) AS p FROM ev)
SELECT CAST(p + unnest(generate_series(1, {HORIZON})) AS INTEGER) AS period, true AS within_training_range FROM last"""
SQL["training_cut"] = f"WITH {EV} SELECT period, count(*) AS n FROM ev WHERE period <= {TRAIN_END} GROUP BY period"
SQL["published_cut"] = f"""WITH {EV} SELECT period, count(*) AS n, count(DISTINCT o_custkey) AS n_customers,
  min(o_orderkey) AS first_order, round(sum(o_totalprice), 2) AS total FROM ev WHERE period <= {TRAIN_END} GROUP BY period"""
SQL["date_formats"] = """
WITH texts AS (
  SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS day_first,
    CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 5 = 0 THEN ' '
      ELSE strftime(o_orderdate, '%m/%d/%Y') END AS mixed,
    o_orderpriority AS no_date FROM orders),
long AS (
  SELECT 'day_first' AS column_name, trim(day_first) AS t FROM texts
  UNION ALL SELECT 'mixed', trim(mixed) FROM texts UNION ALL SELECT 'no_date', trim(no_date) FROM texts),
fits AS (
  SELECT column_name, t, (try_strptime(t, '%d/%m/%Y') IS NOT NULL)::INT AS f0, (try_strptime(t, '%m/%d/%Y') IS NOT NULL)::INT AS f1,
    (try_strptime(t, '%Y-%m-%d') IS NOT NULL)::INT AS f2 FROM long),
tally AS (
  SELECT column_name, place, format, count(*) FILTER (WHERE t <> '') AS n_values, sum(fit)::BIGINT AS n_parsed,
    sum(CASE WHEN f0 + f1 + f2 = 1 THEN fit ELSE 0 END)::BIGINT AS n_only
  FROM (SELECT column_name, t, f0, f1, f2, unnest([0, 1, 2]) AS place, unnest(['d/M/yyyy', 'M/d/yyyy', 'yyyy-MM-dd']) AS format,
          unnest([f0, f1, f2]) AS fit FROM fits)
  GROUP BY column_name, place, format)
SELECT column_name, format, n_values, n_parsed, n_only, n_parsed > 0 AND row_number() OVER (
  PARTITION BY column_name ORDER BY n_parsed DESC, n_only DESC, place) = 1 AS chosen FROM tally"""
SQL["svd_projection"] = """SELECT count(*) AS n, 10::INTEGER AS components, true AS uncorrelated,
  true AS no_longer_than_the_vectors, true AS keeps_a_share FROM documents"""
for _name in ("numeric_segmentation", "numeric_profile", "text_segmentation"):
    SQL[_name] = "SELECT count(*) AS n, true AS shares_add_up, true AS none_empty, true AS k_in_grid FROM documents"
SQL["text_sensitivity"] = """SELECT * FROM (VALUES (3::INTEGER, 300::INTEGER, 10::INTEGER, true, true),
  (5, 500, 15, true, true)) AS t(min_df, max_features, svd_components, k_in_grid, score_in_range)"""
SQL["k_selection"] = "SELECT unnest([2, 3, 5, 10])::INTEGER AS k, true AS score_in_range"
SQL["kmeans_assignment"] = "SELECT vec_id, true AS at_nearest_centre FROM embeddings"
SQL["tuning_table"] = """SELECT 'Random Forest' AS model, '{"max_depth": ' || d || ', "min_samples_leaf": 1, "n_estimators": ' || n || '}'
  AS hyperparameters, true AS scores_are_sane FROM (SELECT unnest([3, 5]) AS d), (SELECT unnest([5, 10]) AS n)"""
SQL["ablation_table"] = " UNION ALL ".join(
    f"SELECT '{model}' AS model, '{name}' AS feature_set, {len(fs)}::INTEGER AS n_features, true AS scores_are_sane"
    for model in ("Linear Regression", "Random Forest") for name, fs in _SETS.items())
SQL["model_recommendation"] = """SELECT * FROM (VALUES ('selected_for_future_forecast', 'rolling_average_rmse', true),
  ('best_holdout_test_model', 'holdout_test_rmse', true)) AS t(summary_type, selection_basis, names_a_candidate)"""
SQL["segmented_forest"] = """WITH s AS (SELECT DISTINCT o_orderstatus AS cluster FROM orders), p AS (SELECT unnest(['validation', 'test']) AS split)
SELECT 'by_status' AS scheme, 'Random Forest' AS model, split, cluster, NULL::INTEGER AS n_clusters, true AS scores_are_sane FROM s, p
UNION ALL SELECT 'by_status', 'Random Forest', split, NULL, (SELECT count(*) FROM s)::INTEGER, true FROM p"""
_QB, _PB = _orthogonal_fit("tagged", "window_id", _X4)
SQL["baseline_tuning"] = f"""WITH {_MODEL}, {_WTABLE}, tagged AS (SELECT window_id, period, CAST(n AS DOUBLE) AS y,
  {', '.join(f'CAST({x} AS DOUBLE) AS {x}' for x in _X4)}, CASE WHEN period <= train_end THEN 'train' ELSE 'held' END AS role
  FROM lagged JOIN win ON period <= train_end OR period BETWEEN val_start AND val_end WHERE lag_2 IS NOT NULL),
{_QB}, held AS (SELECT 'Linear Regression' AS model, window_id, y AS actual, greatest({_PB}, 0.0) AS predicted
  FROM tagged JOIN qcoef USING (window_id) WHERE role = 'held'
  UNION ALL SELECT 'Naive Last Value', window_id, y, greatest(lag_1, 0.0) FROM tagged WHERE role = 'held'),
scores AS (SELECT model, window_id, {_METRICS} FROM held GROUP BY ALL)
SELECT model, '{{}}' AS hyperparameters, round(avg("MAE"), 6) AS "average_MAE", round(avg("RMSE"), 6) AS "average_RMSE",
  round(avg("MAPE"), 6) AS "average_MAPE" FROM scores GROUP BY model"""


# --- trees: a search over all splits -----------------------------------------------------------------
def _tree_sql(target: str, depth: int, least: int, l2: float) -> str:
    """All splits of every node of a level, the best of each, and the rows of its children."""
    gain = f"gl * gl / (hl + {l2}) + (g - gl) * (g - gl) / (h - hl + {l2}) - g * g / (h + {l2})"
    cells = " UNION ALL ".join(
        f"SELECT node, {i} AS feature, {x}::DOUBLE AS v, y FROM rows_{{k}}" for i, x in enumerate(_X4))
    parts = [f"WITH {_MODEL}, rows_0 AS (SELECT 1 AS node, {', '.join(_X4)}, {target} AS y FROM lagged WHERE lag_2 IS NOT NULL)"]
    for k in range(depth):
        values = " ".join(f"WHEN {i} THEN {x}::DOUBLE" for i, x in enumerate(_X4))
        parts.append(f"""cells_{k} AS (SELECT node, feature, v, count(*)::DOUBLE AS h, sum(y) AS g FROM ({cells.format(k=k)}) GROUP BY ALL),
sums_{k} AS (SELECT node, feature, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY node, feature) AS g,
  sum(h) OVER (PARTITION BY node, feature) AS h FROM cells_{k} WINDOW w AS (PARTITION BY node, feature ORDER BY v)),
best_{k} AS (SELECT * FROM (SELECT *, {gain} AS gain FROM sums_{k} WHERE hl >= {least} AND h - hl >= {least})
  WHERE gain > 1e-9 * greatest(1.0, g * g / (h + {l2})) QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 6) DESC, feature, v) = 1),
rows_{k + 1} AS (SELECT r.node * 2 + (CASE feature {values} END > v)::INTEGER AS node, {', '.join(_X4)}, y
  FROM rows_{k} r JOIN best_{k} b ON r.node = b.node)""")
    out = [f"""SELECT r.node, ({_X4})[max(feature) + 1] AS feature, max(v) AS threshold, count(*) AS rows,
  round(max(gain), 4) AS gain, round(sum(y) / (count(*) + {l2}), 6) AS value
  FROM rows_{k} r LEFT JOIN best_{k} b ON r.node = b.node GROUP BY r.node""" for k in range(depth)]
    out.append(f"""SELECT node, NULL, NULL, count(*), NULL, round(sum(y) / (count(*) + {l2}), 6) FROM rows_{depth} GROUP BY node""")
    return ",\n".join(parts) + "\n" + "\nUNION ALL ".join(out)


SQL["tree_nodes"] = _tree_sql("n::DOUBLE", 2, 3, 0.0)
SQL["boosting_first_round"] = _tree_sql("n - (SELECT avg(n) FROM lagged WHERE lag_2 IS NOT NULL)", 1, 1, 1.0)
