"""The registered queries again as SQL for another engine, written from the definitions.

Where a DataFrame operator avoids a join or a window over all rows, the SQL states it in the plain form.
"""

from __future__ import annotations

from tidewatch.schema import SCORES

KEY = "store_id, product_id, batch_number"

PANEL = """panel AS (
  SELECT 'S' || lpad(CAST(l_suppkey % 10 + 1 AS VARCHAR), 3, '0') AS store_id,
         'P' || lpad(CAST(l_partkey % 5 + 1 AS VARCHAR), 3, '0') AS product_id,
         CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS y
  FROM lineitem GROUP BY 1, 2, 3)"""


def r(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {name}"


def rs(*names: str) -> str:
    return ", ".join(r(n, n) for n in names)


def batched(days: int = 90, origin: str = "DATE '1995-01-01'") -> str:
    return f"""{PANEL}, batched AS (
  SELECT *, CAST(floor(date_diff('day', {origin}, day) / {days}) AS INTEGER) + 1 AS batch_number FROM panel)"""


def flags(p: str = "", threshold: float = 2.0, reference: int = 3) -> str:
    """Drift per (series, batch) from the rows of the batch and those of the batches before it."""
    return f"""{p}flags AS (
  SELECT *, CASE WHEN n1 >= 2 AND n0 >= 2 THEN (m1 - m0) / nullif(sqrt(v1 / n1 + v0 / n0), 0) END AS drift_score,
    CASE WHEN n1 >= 2 AND n0 >= 2 THEN coalesce(
      abs((m1 - m0) / nullif(sqrt(v1 / n1 + v0 / n0), 0)) > {threshold}, v1 = 0 AND v0 = 0 AND m1 <> m0)
      ELSE false END AS has_concept_drift
  FROM (
    SELECT b.store_id, b.product_id, b.batch_number,
      count(*) FILTER (p.batch_number = b.batch_number) AS n1,
      avg(p.y) FILTER (p.batch_number = b.batch_number) AS m1,
      var_samp(p.y) FILTER (p.batch_number = b.batch_number) AS v1,
      count(*) FILTER (p.batch_number < b.batch_number) AS n0,
      avg(p.y) FILTER (p.batch_number < b.batch_number) AS m0,
      var_samp(p.y) FILTER (p.batch_number < b.batch_number) AS v0
    FROM (SELECT DISTINCT {KEY} FROM batched) b
    JOIN batched p ON p.store_id = b.store_id AND p.product_id = b.product_id
      AND p.batch_number BETWEEN b.batch_number - {reference} AND b.batch_number
    GROUP BY 1, 2, 3))"""


def windows(p: str = "", holdout: int = 20) -> str:
    """Training windows by a join of ranked rows with the last row of every batch, and the scored rows."""
    scored = (
        f"rank_from_end < greatest(1, CAST(floor(data_points * {holdout} / 100.0) AS BIGINT))"
        if holdout
        else "true"
    )
    trained = f"NOT ({scored})" if holdout else "true"
    return f"""{p}ranked AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY day) AS rn FROM batched),
{p}ends AS (SELECT {KEY}, max(rn) AS end_rn FROM {p}ranked GROUP BY ALL),
{p}windows AS (
  SELECT store_id, product_id, e.batch_number, day, y, end_rn - rn AS rank_from_end, has_concept_drift,
    count(*) OVER w AS data_points,
    date_diff('day', min(day) OVER w, max(day) OVER w) AS training_period_days
  FROM {p}ends e JOIN {p}flags f USING (store_id, product_id, batch_number)
  JOIN (SELECT store_id, product_id, day, y, rn FROM {p}ranked) d USING (store_id, product_id)
  WHERE rn <= end_rn AND rn > end_rn - CASE WHEN has_concept_drift THEN 180 ELSE 365 END
  WINDOW w AS (PARTITION BY store_id, product_id, e.batch_number)),
{p}marked AS (
  SELECT *, {scored} AS is_scored, {trained} AS is_train,
    CAST(date_diff('day', DATE '1970-01-01', day) AS DOUBLE) AS t, isodow(day) - 1 AS weekday
  FROM {p}windows)"""


def fitted(p: str = "") -> str:
    """Trend by regression, then the mean residual of every weekday, over the training rows."""
    return f"""{p}trend AS (
  SELECT {KEY}, count(*) AS n_train, avg(y) AS mean_y, avg(t) AS mean_t,
    CASE WHEN max(t) > min(t) THEN regr_slope(y, t) ELSE 0 END AS slope
  FROM {p}marked WHERE is_train GROUP BY ALL),
{p}weekly AS (
  SELECT store_id, product_id, batch_number, weekday,
    avg(y - (mean_y + slope * (t - mean_t))) AS weekday_offset
  FROM {p}marked JOIN {p}trend USING (store_id, product_id, batch_number)
  WHERE is_train GROUP BY ALL),
{p}predicted AS (
  SELECT m.*, mean_y + slope * (t - mean_t) + coalesce(weekday_offset, 0) AS yhat,
    y - (mean_y + slope * (t - mean_t) + coalesce(weekday_offset, 0)) AS e
  FROM {p}marked m JOIN {p}trend USING (store_id, product_id, batch_number)
  LEFT JOIN {p}weekly USING (store_id, product_id, batch_number, weekday)
  WHERE is_scored)"""


def model_run(p: str = "", execution: str = "NULL", later: str = "0 hours") -> str:
    number = "" if execution == "NULL" else execution
    return f"""{p}model_run AS (
  SELECT md5(concat_ws('|', store_id, product_id, CAST(batch_number AS VARCHAR), '{number}')) AS run_id,
    {KEY}, CAST({execution} AS INTEGER) AS execution_number,
    CAST(max(day) AS TIMESTAMP) + INTERVAL {later} AS logged_at,
    sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae,
    100 * avg(abs(e) / nullif(abs(y), 0)) AS mape,
    1 - sum(e * e) / nullif(var_pop(y) * count(*), 0) AS r2,
    avg(e) AS erreur_moyenne, stddev_pop(e) AS erreur_std,
    data_points, CAST(training_period_days AS INTEGER) AS training_period_days, has_concept_drift
  FROM {p}predicted GROUP BY {KEY}, data_points, training_period_days, has_concept_drift)"""


MEASURES = """avg(rmse) AS rmse_global, avg(mae) AS mae_global, avg(r2) AS r2_global,
    stddev_pop(rmse) AS rmse_std, stddev_pop(mae) AS mae_std, stddev_pop(r2) AS r2_std,
    count(*) AS nombre_modeles, count(*) FILTER (has_concept_drift) AS modeles_avec_derive"""
MEASURE_NAMES = ["rmse_global", "mae_global", "r2_global", "rmse_std", "mae_std", "r2_std"]


def global_run(p: str = "") -> str:
    return f"""{p}global_run AS (
  SELECT md5(concat_ws('|', 'global', CAST(batch_number AS VARCHAR),
      coalesce(CAST(max(execution_number) AS VARCHAR), ''))) AS run_id,
    batch_number, max(execution_number) AS execution_number, max(logged_at) AS logged_at, {MEASURES}
  FROM {p}model_run GROUP BY batch_number)"""


def job(days: int = 90, holdout: int = 20, execution: str = "NULL", origin: str | None = None) -> str:
    start = batched(days, origin) if origin else batched(days)
    return ",\n".join([start, flags(), windows(holdout=holdout), fitted(), model_run("", execution)])


def chains() -> str:
    """Both stored chains: the tables a_* and b_*, and their unions models and rollups."""
    parts = [batched()]
    for p, threshold, execution, later in (("a_", 2.0, "1", "0 hours"), ("b_", 1.0, "2", "1 hour")):
        parts += [
            flags(p, threshold), windows(p), fitted(p), model_run(p, execution, later), global_run(p)
        ]
    parts.append("models AS (SELECT * FROM a_model_run UNION ALL SELECT * FROM b_model_run)")
    parts.append("rollups AS (SELECT * FROM a_global_run UNION ALL SELECT * FROM b_global_run)")
    return ",\n".join(parts)


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


RUN_COLUMNS = f"""run_id, {KEY}, logged_at, {rs(*SCORES)},
  data_points, training_period_days, has_concept_drift"""
ROLLUP_COLUMNS = f"""run_id, batch_number, logged_at, {rs(*MEASURE_NAMES)}, nombre_modeles, modeles_avec_derive"""

STREAM_ORIGIN = "DATE '1995-01-01'"
LINES2 = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)"


def _last_rows(rows: int) -> str:
    return f"""SELECT store_id, product_id, day, y FROM (
      SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY day DESC) AS rn FROM panel)
    WHERE rn <= {rows}"""


def _event_totals(length: int, slide: int) -> str:
    steps = length // slide
    return f"""
WITH placed AS (
  SELECT event_type, value, CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(s AS INTEGER) * {slide}) AS window_start
  FROM events, range({steps}) AS g(s))
SELECT window_start, window_start + to_days({length}) AS window_end, event_type,
  count(*) AS n, {r('sum(value)', 'total')}
FROM placed GROUP BY window_start, event_type"""


def _executions(source: str, ts: str, gap: str, keys: str = "") -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""numbered AS (
  SELECT *, CAST(sum(fresh) OVER ({part} ORDER BY {ts} RANGE UNBOUNDED PRECEDING) AS BIGINT) AS execution FROM (
    SELECT *, CASE WHEN {ts} - lag({ts}) OVER ({part} ORDER BY {ts}) <= INTERVAL {gap} THEN 0 ELSE 1 END AS fresh
    FROM {source})),
grouped AS (
  SELECT {lead}execution, min({ts}) AS started_at, max({ts}) AS ended_at, count(*) AS n_runs
  FROM numbered GROUP BY {lead}execution)"""


def _gaps(source: str, ts: str, key: str) -> str:
    return f"""gaps AS (
  SELECT {key}, {ts}, n_runs,
    date_diff('microseconds', lag({ts}) OVER (PARTITION BY {key} ORDER BY {ts}), {ts}) / 1e6 AS seconds
  FROM (SELECT {key}, {ts}, count(*) AS n_runs FROM {source} GROUP BY ALL))"""


def _quantiles(source: str, key: str, value: str, probabilities: list[float]) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, CAST({p} AS DOUBLE) AS probability, {r(f'quantile_cont({value}, {p})', 'quantile')}"
        f" FROM {source} WHERE {value} IS NOT NULL GROUP BY {key}"
        for p in probabilities
    )


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["metric_lines"] = f"""
SELECT event_id, date_trunc('milliseconds', ts) AS ts, {r('value', 'value')}, CAST(0 AS BIGINT) AS step FROM events"""
    sql["run_files"] = """
SELECT md5(CAST(user_id AS VARCHAR)) AS run_id, CASE event_id % 3 WHEN 0 THEN 'tags' ELSE 'metrics' END AS kind,
  event_type AS key, CAST(event_id AS VARCHAR) AS text FROM events WHERE event_id % 3 < 2"""
    sql["run_names"] = with_(
        batched(),
        """, keys AS (SELECT DISTINCT store_id, product_id, batch_number FROM batched)
SELECT DISTINCT 'Model_' || product_id || '_' || store_id AS name, 'model' AS kind, product_id, store_id,
  0 AS n FROM keys
UNION ALL SELECT 'Model_' || product_id || '_' || store_id || '_#' || batch_number, 'model', product_id, store_id,
  batch_number FROM keys
UNION ALL SELECT DISTINCT 'Global_Metrics_#' || batch_number, 'global', NULL, NULL, batch_number FROM keys
UNION ALL SELECT DISTINCT 'Unknown_#' || batch_number, NULL, NULL, NULL, 0 FROM keys""",
    )
    sql["identity_check"] = with_(
        chains(),
        """SELECT run_id, 'Model_' || product_id || '_' || store_id || '_#' || batch_number AS run_name,
  'P' || lpad(CAST(CAST(substr(product_id, 2) AS INTEGER) + 1 AS VARCHAR), 3, '0') AS product_id, store_id
FROM b_model_run""",
    )
    sql["wide_model_records"] = with_(chains(), f"SELECT execution_number, {RUN_COLUMNS} FROM models")
    sql["wide_global_records"] = with_(chains(), f"SELECT {ROLLUP_COLUMNS} FROM rollups")
    sql["latest_metric_points"] = f"""
SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key, ts, {r('value', 'value')}, event_id AS step FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC, ts DESC) AS rn FROM events)
WHERE rn = 1"""
    sql["record_kinds"] = with_(
        chains(),
        """SELECT batch_number, 'model' AS kind, count(*) AS n_runs FROM models GROUP BY batch_number
UNION ALL SELECT batch_number, 'global', count(*) FROM rollups GROUP BY batch_number""",
    )
    sql["written_runs"] = with_(
        chains(), f"SELECT {KEY}, run_id, execution_number, {rs('rmse')}, data_points FROM models"
    )
    sql["batch_extract"] = with_(
        batched(), f"SELECT {KEY}, day, {rs('y')} FROM batched WHERE batch_number = 3"
    )

    sql["daily_panel"] = with_(PANEL, f"SELECT store_id, product_id, day, {rs('y')} FROM panel")
    sql["dedup_panel"] = with_(
        PANEL.replace("FROM lineitem", f"FROM (SELECT DISTINCT * FROM {LINES2})"),
        f"SELECT store_id, product_id, day, {rs('y')} FROM panel",
    )
    sql["dedup_by_key"] = f"""
SELECT l_orderkey, l_linenumber, {rs('l_quantity', 'l_extendedprice')} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity, l_extendedprice) AS rn
  FROM lineitem) WHERE rn = 1"""
    sql["doubled_target"] = with_(
        PANEL,
        f"""SELECT store_id, product_id, {r('var_pop(2 * y)', 'doubled')}, {r('var_pop(y)', 'clean')},
  {r('var_pop(2 * y) / nullif(var_pop(y), 0)', 'ratio')} FROM panel GROUP BY ALL""",
    )
    sql["batch_assignment"] = with_(
        batched(),
        f"""SELECT batch_number, count(*) AS n_rows, min(day) AS first_day, max(day) AS last_day,
  {r('sum(y)', 'total')} FROM batched GROUP BY batch_number""",
    )
    visible = f"""SELECT {{b}}, count(*) AS visible_rows, min(day) AS first_day, max(day) AS last_day, {r('sum(y)', 'visible_y')}
FROM {{batches}} b JOIN batched p ON p.batch_number <= b.batch_number {{match}} GROUP BY ALL"""
    sql["history_asof"] = with_(
        batched(),
        visible.format(
            b="store_id, product_id, b.batch_number",
            batches="(SELECT DISTINCT batch_number FROM batched)",
            match="",
        ),
    )
    sql["history_profile"] = with_(
        batched(),
        visible.format(
            b="p.store_id, p.product_id, b.batch_number",
            batches=f"(SELECT DISTINCT {KEY} FROM batched)",
            match="AND p.store_id = b.store_id AND p.product_id = b.product_id",
        ),
    )
    for name, rows in (("long_window", 365), ("short_window", 180)):
        sql[name] = with_(
            PANEL, f"SELECT store_id, product_id, day, {rs('y')} FROM ({_last_rows(rows)})"
        )
    sizes = """count(*) AS data_points,
  CAST(date_diff('day', min(day), max(day)) AS INTEGER) AS training_period_days"""
    sql["rows_not_days"] = with_(
        PANEL,
        f"""SELECT store_id, product_id, {sizes} FROM ({_last_rows(180)}) GROUP BY ALL
HAVING count(*) < date_diff('day', min(day), max(day)) + 1""",
    )
    sql["window_profile"] = with_(
        batched(),
        f"""SELECT {KEY}, {sizes}, count(*) < date_diff('day', min(day), max(day)) + 1 AS has_gap
FROM batched GROUP BY ALL""",
    )
    sql["gap_list"] = with_(
        PANEL,
        """SELECT store_id, product_id, before + 1 AS gap_start, day - 1 AS gap_end,
  CAST(day - before - 1 AS INTEGER) AS gap_days
FROM (SELECT *, lag(day) OVER (PARTITION BY store_id, product_id ORDER BY day) AS before FROM panel)
WHERE day - before > 1""",
    )
    sql["missing_series"] = with_(
        batched(7),
        f"""SELECT store_id, product_id, CAST(n AS INTEGER) AS batch_number
FROM (SELECT store_id, product_id FROM (SELECT DISTINCT store_id FROM batched) CROSS JOIN (SELECT DISTINCT product_id FROM batched)) s
CROSS JOIN range(1, (SELECT max(batch_number) FROM batched) + 1) AS g(n)
WHERE NOT EXISTS (SELECT 1 FROM batched b WHERE b.store_id = s.store_id AND b.product_id = s.product_id
  AND b.batch_number = n)""",
    )
    sql["dense_calendar"] = with_(
        PANEL,
        f""", days AS (
  SELECT store_id, product_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM panel GROUP BY store_id, product_id)
SELECT store_id, product_id, day, {r('coalesce(y, 0)', 'y')}, y IS NULL AS filled
FROM days LEFT JOIN panel USING (store_id, product_id, day)""",
    )

    fit = ",\n".join([batched(), flags(), windows(), fitted()])
    sql["trend_fit"] = with_(
        fit,
        f"""SELECT {KEY}, {rs('slope', 'mean_y', 'mean_t')}, n_train, {r('mean_y - slope * mean_t', 'intercept')}
FROM trend""",
    )
    offsets = ", ".join(
        r(f"coalesce(max(weekday_offset) FILTER (weekday = {d}), 0)", f"weekday_{d}") for d in range(7)
    )
    sql["weekly_fit"] = with_(
        fit,
        f"""SELECT {KEY}, {r('max(slope)', 'slope')}, {r('max(mean_y)', 'mean_y')}, {r('max(mean_t)', 'mean_t')},
  max(n_train) AS n_train, {r('max(mean_y - slope * mean_t)', 'intercept')}, {offsets}
FROM trend LEFT JOIN weekly USING (store_id, product_id, batch_number) GROUP BY {KEY}""",
    )
    sql["additive_models"] = with_(
        fit,
        f"""SELECT {KEY}, count(*) AS n_train, min(t) AS t_start, greatest(max(t) - min(t), 1) AS t_span,
  CASE WHEN max(abs(y)) = 0 THEN 1 ELSE max(abs(y)) END AS y_scale FROM marked WHERE is_train GROUP BY {KEY}""",
    )
    sql["additive_trend"] = with_(
        fit, f"SELECT {KEY}, n_train, round(slope, 4) + 0.0 AS slope FROM trend WHERE n_train > 1"
    )
    sql["running_weekly"] = sql["weekly_fit"]
    sql["additive_by_days"] = with_(
        fit,
        f"""SELECT {KEY}, n_train, t_start, t_span, y_scale, round(slope, 4) + 0.0 AS slope FROM trend JOIN (
  SELECT {KEY}, min(t) AS t_start, greatest(max(t) - min(t), 1) AS t_span,
    CASE WHEN max(abs(y)) = 0 THEN 1 ELSE max(abs(y)) END AS y_scale FROM marked WHERE is_train GROUP BY ALL)
  USING (store_id, product_id, batch_number) WHERE n_train > 1""",
    )
    levels = ", ".join(r(f"max(coalesce(level, mean_y)) FILTER (weekday = {d})", f"level_{d}") for d in range(7))
    sql["additive_weekly"] = with_(
        fit,
        f""", within AS (
  SELECT {KEY}, weekday, t, y, avg(t) OVER w AS t_d, avg(y) OVER w AS y_d FROM marked WHERE is_train
  WINDOW w AS (PARTITION BY {KEY}, weekday)),
joint AS (
  SELECT {KEY}, count(*) AS n_train, avg(y) AS mean_y, avg(t) AS mid, CASE WHEN sum((t - t_d) * (t - t_d)) > 1e-6
    THEN sum((t - t_d) * (y - y_d)) / sum((t - t_d) * (t - t_d)) ELSE 0 END AS slope FROM within GROUP BY ALL),
levels AS (
  SELECT j.*, weekday, y_d - slope * (t_d - mid) AS level
  FROM joint j CROSS JOIN (SELECT CAST(range AS BIGINT) AS weekday FROM range(7))
  LEFT JOIN (SELECT DISTINCT {KEY}, weekday, t_d, y_d FROM within) USING (store_id, product_id, batch_number, weekday)),
errors AS (
  SELECT {KEY}, sqrt(avg(pow(m.y - (coalesce(level, mean_y) + slope * (m.t - mid)), 2))) AS rmse
  FROM marked m JOIN levels USING (store_id, product_id, batch_number, weekday) WHERE is_scored GROUP BY ALL)
SELECT {KEY}, max(n_train) AS n_train, {r('max(slope)', 'slope')}, {levels}, {r('max(rmse)', 'rmse')}
FROM levels JOIN errors USING (store_id, product_id, batch_number) GROUP BY {KEY}""",
    )
    ends = "SELECT date_trunc('month', day) AS m, min(day) AS opens, max(day) AS closes FROM panel GROUP BY 1"
    sql["holiday_calendar"] = with_(
        PANEL,
        f""", ends AS ({ends}), named AS (
  SELECT 'opens' AS holiday, opens AS d FROM ends UNION ALL SELECT 'closes', closes FROM ends)
SELECT DISTINCT CAST(d + CAST(o AS INTEGER) AS DATE) AS day, holiday, CAST(o AS INTEGER) AS "offset" FROM named, range(-2, 2) AS g(o)""",
    )
    sql["holiday_effects"] = with_(
        fit,
        f""", h AS (
  SELECT m.*, CASE WHEN c.opens IS NULL THEN 0.0 ELSE 1.0 END AS h,
    CASE WHEN max(t) OVER w - min(t) OVER w >= 14 THEN weekday ELSE 0 END AS part, count(*) OVER w AS n_train
  FROM marked m LEFT JOIN ({ends}) c ON c.opens = m.day WHERE is_train
  WINDOW w AS (PARTITION BY {KEY})),
c AS (
  SELECT {KEY}, h, h - avg(h) OVER p AS ch, t - avg(t) OVER p AS ct, y - avg(y) OVER p AS cy FROM h WHERE n_train >= 30
  WINDOW p AS (PARTITION BY {KEY}, part)),
s AS (
  SELECT {KEY}, CAST(sum(h) AS BIGINT) AS days, sum(ch * ch) AS hh, sum(ct * ct) AS tt, sum(ch * ct) AS ht,
    sum(ch * cy) AS hy, sum(ct * cy) AS ty FROM c GROUP BY ALL)
SELECT {KEY}, 'opens' AS holiday, days, round((tt * hy - ht * ty) / (tt * hh - ht * ht), 3) + 0.0 AS effect
FROM s WHERE days >= 3""",
    )
    angle = "2 * pi() * {k} * date_diff('day', DATE '1970-01-01', day) / 365.25"
    terms = ", ".join(
        r(f"{fn}({angle.format(k=k)})", f"season_{fn}_{k}") for k in (1, 2) for fn in ("sin", "cos")
    )
    sql["fourier_columns"] = with_(
        PANEL, f"SELECT store_id, product_id, day, {rs('y')}, {terms} FROM panel"
    )
    sql["predicted_days"] = with_(fit, f"SELECT {KEY}, day, {rs('y', 'yhat')} FROM predicted")
    sql["scoring_split"] = with_(
        fit,
        f"""SELECT {KEY}, count(*) FILTER (is_train) AS n_train, count(*) FILTER (is_scored) AS n_scored,
  min(day) FILTER (is_scored) AS first_scored, max(day) FILTER (is_scored) AS last_scored
FROM marked GROUP BY ALL""",
    )

    sql["model_scores"] = with_(job(), f"SELECT {RUN_COLUMNS} FROM model_run")
    sql["in_sample_scores"] = with_(job(holdout=0), f"SELECT {KEY}, {rs(*SCORES)} FROM model_run")
    sql["score_audit"] = with_(
        chains(),
        f"""SELECT {KEY}, 'decomposition' AS violation FROM b_model_run WHERE erreur_std > 1e-3
UNION ALL SELECT {KEY}, 'rmse_below_std' FROM b_model_run WHERE 2 * erreur_std > rmse * (1 + 1e-9)""",
    )
    implied = "rmse * rmse / nullif(1 - r2, 0)"
    sql["implied_variance"] = with_(
        chains(),
        f"""SELECT {KEY}, data_points, count(*) AS n_runs, {r('min(v)', 'min_variance')}, {r('max(v)', 'max_variance')},
  {r('max(v) / nullif(min(v), 0)', 'ratio')}, max(v) / nullif(min(v), 0) <= 1 + 1e-6 AS same_target
FROM (SELECT *, {implied} AS v FROM models) WHERE v IS NOT NULL GROUP BY {KEY}, data_points""",
    )

    sql["drift_flags"] = with_(
        f"{batched()}, {flags()}", f"SELECT {KEY}, {rs('drift_score')}, has_concept_drift FROM flags"
    )
    window_sql = ",\n".join([batched(), flags(), windows()])
    sql["train_windows"] = with_(
        window_sql,
        f"""SELECT {KEY}, has_concept_drift, max(data_points) AS data_points,
  CAST(max(training_period_days) AS INTEGER) AS training_period_days, count(*) AS n_rows, min(day) AS first_day,
  {r('sum(y)', 'total')}, CAST(sum(rank_from_end) AS BIGINT) AS rank_sum FROM windows GROUP BY {KEY}, has_concept_drift""",
    )
    sql["window_sizes"] = with_(
        window_sql,
        f"""SELECT DISTINCT {KEY}, data_points, CAST(training_period_days AS INTEGER) AS training_period_days,
  has_concept_drift FROM windows""",
    )
    sql["window_recovery"] = with_(
        chains(),
        f"""SELECT {KEY}, data_points, points_before FROM (
  SELECT *, lag(has_concept_drift) OVER w AS was_drift, lag(data_points) OVER w AS points_before FROM a_model_run
  WINDOW w AS (PARTITION BY store_id, product_id ORDER BY batch_number))
WHERE was_drift AND NOT has_concept_drift""",
    )
    sql["drift_episodes"] = with_(
        f"{batched()}, {flags(threshold=1.0)}",
        """SELECT store_id, product_id, min(batch_number) AS first_batch, max(batch_number) AS last_batch,
  count(*) AS n_batches FROM (
  SELECT *, batch_number - row_number() OVER (PARTITION BY store_id, product_id ORDER BY batch_number) AS island
  FROM flags WHERE has_concept_drift) GROUP BY store_id, product_id, island""",
    )

    rolled = with_(
        f"{job()},\n{global_run()}",
        f"SELECT {ROLLUP_COLUMNS} FROM global_run",
    )
    sql["batch_rollup"] = rolled
    sql["batch_rollup_dedup"] = rolled.replace(
        "FROM lineitem GROUP BY",
        f"""FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity
    FROM {LINES2}) GROUP BY""",
    )
    sql["partial_batches"] = with_(
        job(7),
        f"""SELECT CAST(n AS INTEGER) AS batch_number, coalesce(nombre_modeles, 0) AS nombre_modeles,
  coalesce(modeles_avec_derive, 0) AS modeles_avec_derive, {rs('rmse_global')},
  (SELECT count(*) FROM (SELECT DISTINCT store_id, product_id FROM batched)) - coalesce(n_seen, 0) AS series_absent,
  coalesce(n_seen, 0) - coalesce(nombre_modeles, 0) AS series_without_model
FROM range(1, (SELECT max(batch_number) FROM batched) + 1) AS b(n)
LEFT JOIN (SELECT batch_number, count(DISTINCT (store_id, product_id)) AS n_seen FROM batched GROUP BY batch_number) s
  ON s.batch_number = n
LEFT JOIN (SELECT batch_number, {MEASURES} FROM model_run GROUP BY batch_number) g ON g.batch_number = n""",
    )
    sql["sample_std_rollup"] = with_(
        chains(),
        f"""SELECT batch_number, {", ".join(r(f"stddev_samp({m})", f"{m}_std") for m in ("rmse", "mae", "r2"))}
FROM a_model_run GROUP BY batch_number""",
    )
    sql["dimension_rollup"] = with_(
        chains(),
        f"""SELECT CASE WHEN product_id IS NOT NULL THEN 'product' WHEN store_id IS NOT NULL THEN 'store' ELSE 'total' END
  AS level, product_id, store_id, {rs(*MEASURE_NAMES)}, nombre_modeles, modeles_avec_derive FROM (
  SELECT product_id, store_id, {MEASURES} FROM a_model_run GROUP BY GROUPING SETS ((product_id), (store_id), ()))""",
    )

    sql["latest_runs"] = with_(
        chains(),
        f"""SELECT {KEY}, run_id, execution_number, logged_at, data_points FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY logged_at DESC, run_id DESC) AS rn FROM models)
WHERE rn = 1""",
    )
    sql["closing_rollups"] = with_(
        chains(),
        """, marks AS (SELECT logged_at, min((run_id, batch_number, execution_number)) AS k FROM rollups GROUP BY logged_at)
SELECT m.run_id, store_id, product_id, m.logged_at, k[2] AS batch_number, k[3] AS execution_number,
  k[1] AS rollup_id, marks.logged_at AS rollup_logged_at
FROM models m ASOF LEFT JOIN marks ON m.logged_at <= marks.logged_at""",
    )
    sql["rollup_audit"] = with_(
        chains(),
        """SELECT r.batch_number, r.execution_number, members, r.nombre_modeles AS reported, members_in_drift,
  r.modeles_avec_derive AS reported_in_drift, members IS NOT NULL AS agrees
FROM rollups r LEFT JOIN (
  SELECT batch_number, execution_number, count(*) AS members, count(*) FILTER (has_concept_drift) AS members_in_drift
  FROM a_model_run GROUP BY ALL) f USING (batch_number, execution_number)""",
    )
    for name, key in (("next_purchase", "user_id"), ("next_purchase_of_all", None)):
        columns = f"{key}, ts" if key else "ts"
        match = f"e.{key} = k.{key} AND " if key else ""
        sql[name] = f"""
WITH marks AS (SELECT {columns}, min(event_id) AS purchase_id FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT event_id, {f"e.{key}, " if key else ""}e.ts, event_type, purchase_id, k.ts AS mark_ts
FROM events e ASOF LEFT JOIN marks k ON {match}e.ts <= k.ts"""
    sql["compare_chains"] = with_(
        chains(),
        f"""SELECT {KEY}, a.run_id IS NOT NULL AS in_left, b.run_id IS NOT NULL AS in_right,
  {r('b.rmse - a.rmse', 'rmse_delta')}, {r('b.mae - a.mae', 'mae_delta')}, b.data_points - a.data_points AS data_points_delta,
  a.has_concept_drift IS NOT DISTINCT FROM b.has_concept_drift AS same_flag
FROM a_model_run a FULL JOIN b_model_run b USING (store_id, product_id, batch_number)""",
    )
    sql["score_change"] = with_(
        chains(),
        f"""SELECT {KEY}, {rs('rmse')}, lag(batch_number) OVER w AS previous_batch,
  {r('rmse - lag(rmse) OVER w', 'change')} FROM a_model_run
WINDOW w AS (PARTITION BY store_id, product_id ORDER BY batch_number)""",
    )
    sql["worst_series"] = with_(
        chains(),
        f"""SELECT {KEY}, {rs('rmse')}, CAST(place AS INTEGER) AS rank FROM (
  SELECT *, rank() OVER (PARTITION BY batch_number ORDER BY rmse DESC) AS place FROM a_model_run) WHERE place <= 5""",
    )
    sql["product_ranking"] = with_(
        chains(),
        f"""SELECT batch_number, product_id, {r('m', 'mean_score')}, n_models,
  CAST(place AS INTEGER) AS place FROM (
  SELECT *, dense_rank() OVER (PARTITION BY batch_number ORDER BY m DESC) AS place FROM (
    SELECT batch_number, product_id, avg(rmse) AS m, count(*) AS n_models FROM a_model_run GROUP BY ALL))
WHERE place <= 3""",
    )
    sql["flag_changes"] = with_(
        chains(),
        """, f AS (SELECT store_id, product_id, coalesce(bool_or(has_concept_drift) FILTER (batch_number = 4), false) AS o,
  coalesce(bool_or(has_concept_drift) FILTER (batch_number = 5), false) AS n FROM b_model_run GROUP BY ALL)
SELECT store_id, product_id, CASE WHEN o AND n THEN 'both' WHEN o THEN 'only_before' ELSE 'only_after' END AS change
FROM f WHERE o OR n""",
    )
    sql["flag_transitions"] = with_(
        chains(),
        """SELECT batch_number, CASE WHEN was AND has_concept_drift THEN 'both' WHEN was THEN 'only_before'
  WHEN has_concept_drift THEN 'only_after' ELSE 'neither' END AS change, count(*) AS n_series FROM (
  SELECT *, lag(has_concept_drift) OVER (PARTITION BY store_id, product_id ORDER BY batch_number) AS was
  FROM b_model_run) WHERE was IS NOT NULL GROUP BY 1, 2""",
    )
    shares = ", ".join(
        r(f"1.0 - count({m}) / CAST(count(*) AS DOUBLE)", f"{m}_missing")
        for m in [*SCORES, "execution_number"]
    )
    sql["coverage"] = with_(
        chains(),
        f"""SELECT execution_number, CASE WHEN logged_at >= DATE '2000-01-01' THEN 'late'
  WHEN logged_at >= DATE '1997-01-01' THEN 'middle' WHEN logged_at >= DATE '1995-01-01' THEN 'early' END AS period,
  count(*) AS n_runs, {shares} FROM models GROUP BY 1, 2""",
    )
    sql["model_executions"] = with_(
        f"{chains()}, {_executions('models', 'logged_at', '5 days')}", "SELECT * FROM grouped"
    )
    sql["user_executions"] = with_(
        _executions("events", "ts", "6 hours", "user_id"), "SELECT * FROM grouped"
    )
    sql["event_executions"] = with_(
        _executions("events", "ts", "10 minutes"), "SELECT event_id, ts, execution FROM numbered"
    )
    sql["log_seconds"] = with_(
        _gaps("events", "ts", "event_type"),
        f"""SELECT event_type, CAST(sum(n_runs) AS BIGINT) AS n_runs, {r('avg(seconds)', 'mean_seconds')},
  {r('min(seconds)', 'min_seconds')}, {r('max(seconds)', 'max_seconds')} FROM gaps GROUP BY event_type""",
    )
    sql["log_seconds_median"] = with_(
        _gaps("events", "ts", "event_type"), _quantiles("gaps", "event_type", "seconds", [0.5])
    )
    sql["model_seconds"] = with_(
        f"{chains()}, {_gaps('models', 'logged_at', 'batch_number')}",
        _quantiles("gaps", "batch_number", "seconds", [0.5]),
    )
    sql["score_quantiles"] = with_(
        chains(), _quantiles("a_model_run", "batch_number", "rmse", [0.1, 0.5, 0.9])
    )
    sql["price_quantiles"] = _quantiles(
        "lineitem", "l_returnflag", "l_extendedprice", [0.25, 0.5, 0.75, 0.99]
    )
    sql["score_histogram"] = with_(
        chains(),
        """SELECT batch_number, CAST(least(greatest(floor(rmse / 5.0), -1), 12) + 1 AS BIGINT) AS bin, count(*) AS n_models
FROM a_model_run WHERE rmse IS NOT NULL GROUP BY 1, 2""",
    )

    again = "(product_id = 'P001' OR (product_id = 'P002' AND store_id <= 'S005'))"
    sql["revised_rollup"] = with_(
        chains(),
        f"""SELECT batch_number, {rs(*MEASURE_NAMES)}, nombre_modeles, modeles_avec_derive FROM (
  SELECT batch_number, {MEASURES} FROM (
    SELECT * FROM a_model_run WHERE NOT {again} UNION ALL SELECT * FROM b_model_run WHERE {again}) GROUP BY batch_number)""",
    )
    sql["doubled_loads"] = f"""
WITH sent AS (
  SELECT 'S' || lpad(CAST(l_suppkey % 10 + 1 AS VARCHAR), 3, '0') AS store_id,
    'P' || lpad(CAST(l_partkey % 5 + 1 AS VARCHAR), 3, '0') AS product_id,
    CAST(floor(date_diff('day', {STREAM_ORIGIN}, CAST(l_shipdate AS DATE)) / 90) AS INTEGER) + 1 AS batch_number,
    unnest(CASE WHEN l_linenumber % 2 = 1 THEN [1] ELSE [2, 3] END) AS load,
    concat_ws('|', l_shipdate, l_quantity, l_linenumber, l_extendedprice) AS row FROM lineitem),
listed AS (SELECT {KEY}, load, count(*) AS n_rows, string_agg(row, '/' ORDER BY row) AS rows FROM sent GROUP BY ALL)
SELECT {KEY}, CAST(b.load AS INTEGER) AS load, CAST(min(a.load) AS INTEGER) AS repeats, b.n_rows
FROM listed a JOIN listed b USING (store_id, product_id, batch_number) WHERE a.load < b.load AND a.rows = b.rows
GROUP BY {KEY}, b.load, b.n_rows"""
    sql["distribution_flags"] = with_(
        batched(),
        f""", binned AS (
  SELECT *, CASE WHEN y < 0 THEN 0 WHEN y >= 200 THEN 41 ELSE floor(y / 5.0) + 1 END AS bin FROM batched),
sides AS (
  SELECT k.store_id, k.product_id, k.batch_number, b,
    count(*) FILTER (p.batch_number = k.batch_number) AS n, count(*) FILTER (p.batch_number < k.batch_number) AS m,
    count(*) FILTER (p.batch_number = k.batch_number AND bin <= b) AS below_n,
    count(*) FILTER (p.batch_number < k.batch_number AND bin <= b) AS below_m
  FROM (SELECT DISTINCT {KEY} FROM batched) k CROSS JOIN range(0, 42) AS g(b) JOIN binned p
    ON p.store_id = k.store_id AND p.product_id = k.product_id AND p.batch_number BETWEEN k.batch_number - 3 AND k.batch_number
  GROUP BY ALL),
d AS (
  SELECT {KEY}, n, m, max(CASE WHEN n >= 2 AND m >= 2 THEN abs(below_n / n - below_m / m) END) AS distance FROM sides GROUP BY ALL)
SELECT {KEY}, {r('distance', 'distance')},
  coalesce(distance > 1.358 * sqrt((n + m) / nullif(CAST(n * m AS DOUBLE), 0)), false) AS has_concept_drift FROM d""",
    )
    sql["sketched_prices"] = """
SELECT l_returnflag, CAST(p AS DOUBLE) AS probability, count(*) AS n_rows, true AS within
FROM lineitem, (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]) AS p) GROUP BY ALL"""

    sql["stream_pickup"] = f"SELECT event_id, ts, user_id, event_type, {rs('value')} FROM events"
    sql["stream_monitor"] = with_(
        f"{job(origin=STREAM_ORIGIN)},\n{global_run()}",
        f"SELECT {ROLLUP_COLUMNS} FROM global_run",
    )
    sql["stream_monitor_dedup"] = sql["batch_rollup_dedup"]
    sql["stream_dedup"] = f"SELECT event_id, user_id, {rs('value')} FROM events"
    sql["stream_daily"] = _event_totals(1, 1)
    sql["stream_sliding"] = _event_totals(7, 1)
    sql["stream_executions"] = with_(
        _executions("events", "ts", "6 hours", "user_id"), "SELECT user_id, started_at, ended_at, n_runs FROM grouped"
    )
    sql["stream_drift"] = with_(
        f"{batched()}, {flags()}", f"SELECT {KEY}, {rs('drift_score')}, has_concept_drift, CAST(0 AS BIGINT) AS rows_skipped FROM flags"
    )
    return sql
