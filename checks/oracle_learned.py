"""SQL for models that have an exact form, scores, cold start, explanations and weather."""

from checks.sql_parts import auc_sql, brier_sql, day, r6, ts, with_

HD = "household_id, device"
WEATHER = ["temp", "dwpt", "rhum", "wdir", "wspd"]
FEATURES = "CASE i WHEN 1 THEN 'usage_lag_1' WHEN 2 THEN 'usage_lag_2' ELSE 'active_last_2_days' END AS feature"
AGENTS = ["activity", "usage_purchase", "usage_signup", "load_purchase", "load_signup"]


def run_errors(expr: str) -> str:
    return f"SELECT household_id, device, run_start, {expr} AS error FROM gap GROUP BY ALL"


def xai(kind: str, y: str, x: str) -> str:
    return f"SELECT household_id, device, {x} AS p, sum({y}) AS n_pos, sum(1 - ({y})) AS n_neg FROM xr GROUP BY ALL"


ABOVE = "CASE WHEN {} > 0.1 THEN 1 ELSE 0 END"
MEAN_DIFF = {f: f"round(avg(activity) FILTER ({c}) - avg(activity), 6)" for f, c in {
    "hour": "hour >= 12",
    **{f"d{i}": f"isodow(hour_ts) = {i}" for i in (1, 2, 3, 4, 6, 7)},
    **{f"l{k}": f"activity_lag_{k} = 1" for k in (24, 48, 72)},
}.items()}


def sentence(inactive: str, weekday: str) -> str:
    return f"""'We based the recommendation on your past activity and usage of the device. '
      || CASE WHEN greatest(l24, l48, l72) >= 0 THEN 'We believe you are active today since you were '
        || CASE WHEN {inactive} THEN 'not ' ELSE '' END || 'active during the last '
        || CASE WHEN l24 >= coalesce(l48, l24) AND l24 >= coalesce(l72, l24) THEN 'day' WHEN l48 >= coalesce(l72, l48) THEN 'two days' ELSE 'three days' END || '.' ELSE '' END
      || CASE WHEN ({weekday}) AND hour_i >= 0 THEN 'The weekday and hour strenghtens that prediction.'
        WHEN {weekday} THEN 'The weekday strenghtens that prediction.'
        WHEN hour_i >= 0 THEN 'The hour strenghtens that prediction.' ELSE '' END"""


SQL = {
    "m4_knn_usage": with_(f"SELECT {HD}, {day('day - 1', 'date')}, {day('day')}, y, {r6('p')}, error FROM ku_p"),
    "m4_knn_activity": with_(
        f"SELECT household_id, {day('day - 1', 'date')}, {ts('hour_ts')}, y, {r6('p')}, error FROM ka_p"
    ),
    "m14_knn_impute": with_(
        "SELECT 'W1' AS station, strftime(wi.time, '%Y-%m-%d %H:%M:%S') AS time, "
        + ", ".join(r6(f"max(v) FILTER (c = '{c}')", c) for c in WEATHER)
        + " FROM wi GROUP BY wi.time"
    ),
    "m13_weather_enriched": with_(
        "SELECT 'W1' AS station, strftime(x.time, '%Y-%m-%d %H:%M:%S') AS time, "
        + ", ".join(r6(f"max(s) FILTER (c = '{c}')", c) for c in WEATHER)
        + " FROM x GROUP BY x.time",
        x="SELECT time, c, (v - min(v) OVER (PARTITION BY c)) / (max(v) OVER (PARTITION BY c) - min(v) OVER (PARTITION BY c)) AS s FROM wi",
    ),
    "j4_weather_join": with_(
        f"SELECT a.household_id, w.station, {ts('w.time')}, a.activity, "
        + ", ".join(r6(f"w.{c}") for c in WEATHER)
        + " FROM act a RIGHT JOIN we w ON w.time = a.hour_ts"
    ),
    "e1_auc_by_date": with_(
        f"SELECT household_id, {day('date')}, {r6('auc')}, CAST(n AS BIGINT) AS n FROM x",
        x=auc_sql("y", "household_id, date"),
        y="SELECT household_id, date, p, sum(y) AS n_pos, sum(1 - y) AS n_neg FROM ar WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY ALL",
    ),
    "e2_activity_walk_forward": with_(
        f"SELECT household_id, {r6('auc_train')}, {r6('auc_test')}, n_dates, CAST(n_test AS BIGINT) AS n_test FROM wa"
    ),
    "e2_usage_walk_forward": with_(
        f"SELECT {HD}, {r6('auc_train')}, {r6('auc_test')}, n_dates, CAST(n_test AS BIGINT) AS n_test FROM wu"
    ),
    "e2_knn_activity_auc": with_(
        f"SELECT household_id, {r6('auc')}, CAST(n AS BIGINT) AS n FROM x",
        x=auc_sql("y", "household_id"),
        y="SELECT household_id, p, sum(y) AS n_pos, sum(1 - y) AS n_neg FROM ka_p WHERE p IS NOT NULL GROUP BY ALL",
    ),
    "e3_load_errors": with_(f"SELECT {HD}, {ts('run_start')}, {r6('error')} FROM mse"),
    "e3_load_score": with_(f"SELECT {HD}, {r6('avg(error)', 'error')}, count(*) AS n_runs FROM mse GROUP BY {HD}"),
    "e6_user_metric": with_(
        f"SELECT {HD}, {r6('avg(error)', 'error')}, count(*) AS n_runs FROM x GROUP BY {HD}",
        x=run_errors("max(abs(y - yh))"),
    ),
    "e7_normalised_distance": with_(
        f"SELECT {HD}, {ts('run_start')}, {r6('error')} FROM x",
        x=run_errors("sqrt(sum((y - yh) * (y - yh))) / sqrt(sum(y * y))"),
    ),
    "e4_agent_scores": with_(f"SELECT household_id, agent, device, {r6('score')} FROM agents"),
    "a18_a20_scores_by_position": with_(
        f"""SELECT household_id, {r6("max(score) FILTER (agent = 'activity_auc')", "activity_auc")},
        {r6("max(score) FILTER (agent = 'usage_auc' AND device = 'purchase')", "usage_auc_0")},
        {r6("max(score) FILTER (agent = 'usage_auc' AND device = 'signup')", "usage_auc_1")},
        {r6("max(score) FILTER (agent = 'load_mse' AND device = 'purchase')", "load_mse_0")},
        {r6("max(score) FILTER (agent = 'load_mse' AND device = 'signup')", "load_mse_1")} FROM agents GROUP BY 1"""
    ),
    "e5_predict_all_activity": with_(
        f"""SELECT household_id, {day("date")}, hour, {r6("p")}, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg
        FROM ar WHERE p IS NOT NULL"""
    ),
    "e5_predict_all_usage": with_(
        f"SELECT {HD}, {day('date')}, CAST(cell AS INTEGER) AS cell, {r6('p')} FROM urate"
    ),
    "e6_cold_start_scores": with_(f"SELECT household_id, agent, {day('date')}, {r6('score')} FROM cs"),
    "e6_cold_start_user_metrics": with_(
        f"""SELECT household_id, 'activity' AS agent, {day("date")}, {r6("score")} FROM ba
        UNION ALL SELECT household_id, 'usage_' || device, {day("date")}, {r6("score")} FROM bu
        UNION ALL SELECT household_id, 'load_' || device, {day("date")}, {r6("score")} FROM csl_max""",
        ba=brier_sql("csa", "household_id, date").replace("FROM csa", "FROM csa WHERE p IS NOT NULL"),
        bu=brier_sql("csu", "household_id, device, date").replace("FROM csu", "FROM csu WHERE p IS NOT NULL AND n_pos + n_neg > 0"),
    ),
    "e6_user_metric_activity": with_(
        f"""SELECT household_id, {r6("a.s", "brier_train")}, {r6("t.score", "brier_test")}, a.n_dates, CAST(t.n AS BIGINT) AS n_test FROM bt_ t
        JOIN (SELECT household_id, avg(score) AS s, count(score) AS n_dates FROM bd GROUP BY ALL) a USING (household_id)""",
        bt_=brier_sql("wa_test", "household_id"),
        bd=brier_sql("wa_train", "household_id, date"),
    ),
    "e6_user_metric_usage": with_(
        f"""SELECT {HD}, {r6("a.s", "brier_train")}, {r6("t.score", "brier_test")}, a.n_dates, CAST(t.n AS BIGINT) AS n_test FROM bt_ t
        JOIN (SELECT {HD}, avg(score) AS s, count(score) AS n_dates FROM bd GROUP BY ALL) a USING ({HD})""",
        bt_=brier_sql("wu_test", HD),
        bd=brier_sql("wu_train", f"{HD}, date"),
    ),
    "a22_cold_start_table": with_(
        f"SELECT household_id, {day('date')}, "
        + ", ".join(r6(f"max(score) FILTER (agent = '{a}')", a) for a in AGENTS)
        + " FROM cs GROUP BY household_id, cs.date"
    ),
    "w10_cold_start_days": with_("SELECT household_id, tolerance, agent, days FROM csf"),
    "a19_cold_start_summary": with_(
        "SELECT household_id, tolerance, "
        + ", ".join(
            f"max(days) FILTER (agent = '{a}') AS {b}"
            for a, b in zip(
                [*AGENTS, "framework"], ["activity", "usage_0", "usage_1", "load_0", "load_1", "framework"]
            )
        )
        + " FROM csf GROUP BY 1, 2"
    ),
    "x1_usage_shapley": with_(
        f"""SELECT {HD}, {day("date")}, {FEATURES}, {r6("CASE i WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END", "importance")},
        {r6("v0", "base_value")} FROM shap CROSS JOIN (SELECT unnest([1, 2, 3]) AS i)"""
    ),
    "x3_shapley_reconstruction": with_(
        f"SELECT {HD}, {day('date')}, {r6('p')}, {r6('v0 + f1 + f2 + f3', 'shap')} FROM shap"
    ),
    "t1_sorted_importance": with_(
        f"""SELECT {HD}, {day("date")}, string_agg(feature, ' > ' ORDER BY f DESC, feature) AS ranking FROM (
        SELECT {HD}, date, {FEATURES}, round(CASE i WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END, 6) + 0.0 AS f
        FROM shap CROSS JOIN (SELECT unnest([1, 2, 3]) AS i)) z GROUP BY {HD}, z.date"""
    ),
    "x7_t6_usage_sentences": with_(
        f"""SELECT {HD}, {day("date")}, 'We believe you are likely to use the device in the near future since you were '
        || CASE WHEN next_cell % 2 = 0 THEN 'not ' ELSE '' END || 'active during the last 2 days'
        || CASE WHEN round(f1, 6) >= 0 OR round(f2, 6) >= 0 THEN ' and have used the device in the last '
          || CASE WHEN round(f1, 6) >= round(f2, 6) THEN 'day' ELSE 'two days' END ELSE '' END || '.' AS sentence FROM shap"""
    ),
    "x6_sentence_rules": with_(
        f"""SELECT household_id, {ts("hour_ts")},
        {sentence("a = 0 AND b = 0 AND c = 0", "coalesce(greatest(d1, d2, d3, d4, d6, d7) >= 0, false)")} AS sentence,
        {sentence("a <> 0 AND b <> 0 AND c = 0", "coalesce(d7 >= 0, false)")} AS literal_sentence
        FROM (SELECT household_id, hour_ts, coalesce(activity_lag_24, 0) AS a, coalesce(activity_lag_48, 0) AS b, coalesce(activity_lag_72, 0) AS c
          FROM actf) h JOIN imp USING (household_id)""",
        imp="SELECT household_id, "
        + ", ".join(f"{e} AS {'hour_i' if n == 'hour' else n}" for n, e in MEAN_DIFF.items())
        + " FROM actf GROUP BY 1",
    ),
    "e8_xai_metric_rules": with_(
        f"""SELECT {HD}, {r6("a.auc", "lime_auc_true")}, {r6("b.auc", "lime_auc_pred")}, {r6("m.l", "lime_mae")},
        {r6("c.auc", "shap_auc_true")}, {r6("d.auc", "shap_auc_pred")}, {r6("m.s", "shap_mae")}
        FROM aa a JOIN ab b USING ({HD}) JOIN ac c USING ({HD}) JOIN ad d USING ({HD})
        JOIN (SELECT {HD}, avg(abs(p - lime)) AS l, avg(abs(p - shap)) AS s FROM xr GROUP BY {HD}) m USING ({HD})""",
        xr="SELECT household_id, device, y, p, round(p, 1) AS lime, round(v0, 3) AS shap FROM shap",
        x1=xai("true", "y", "lime"),
        x2=xai("pred", ABOVE.format("p"), ABOVE.format("lime")),
        x3=xai("true", "y", "shap"),
        x4=xai("pred", ABOVE.format("p"), ABOVE.format("shap")),
        aa=auc_sql("x1", HD),
        ab=auc_sql("x2", HD),
        ac=auc_sql("x3", HD),
        ad=auc_sql("x4", HD),
    ),
    "t7_weather_clause": with_(
        f"""SELECT 'W1' AS station, {day("d", "time")}, CASE WHEN n2 >= 0 THEN 'The weather conditions (' || t1 || ', ' || t2 || ') support that recommendation.'
        WHEN n1 >= 0 THEN 'The weather condition (' || t1 || ') support that recommendation.' ELSE '' END AS clause
        FROM (SELECT d, max(f) FILTER (r = 1) AS n1, max(f) FILTER (r = 2) AS n2, max(t) FILTER (r = 1) AS t1, max(t) FILTER (r = 2) AS t2 FROM ranked GROUP BY d)""",
        dly="SELECT date_trunc('day', time) AS d, c, avg(v) AS m FROM wl GROUP BY ALL",
        ranked="""SELECT d, f, t, row_number() OVER (PARTITION BY d ORDER BY f DESC, i) AS r FROM (
          SELECT d, round(m - avg(m) OVER (PARTITION BY c), 6) + 0.0 AS f, list_position(['dwpt','rhum','temp','wdir','wspd'], c) AS i,
          CASE c WHEN 'dwpt' THEN 'dewing point' WHEN 'rhum' THEN 'relative humidity' WHEN 'temp' THEN 'temperature' WHEN 'wdir' THEN 'wind direction'
            ELSE 'windspeed' END || ':' || CAST(round(m, 2) AS VARCHAR) AS t FROM dly)""",
    ),
    "stream_completed_hours": with_(
        f"""SELECT household_id, device AS entity_id, {ts("hour_ts")}, {r6("sum(v)", "value_sum")}, count(*) AS n FROM load_rows
        GROUP BY household_id, device, load_rows.hour_ts"""
    ),
    "stream_hourly_load": with_(f"SELECT household_id, device, {ts('hour_ts')}, {r6('value')} FROM ld"),
    "stream_hourly_sums": with_(
        f"""SELECT household_id, device AS entity_id, {ts("hour_ts")}, {r6("sum(v)", "value_sum")}, count(*) AS n FROM load_rows
        WHERE hour_ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM load_rows) - INTERVAL 2 HOUR GROUP BY household_id, device, load_rows.hour_ts"""
    ),
}
