"""SQL for feature tables, runs and profiles."""

from checks.sql_parts import day, r6, ts, with_

HD = "household_id, device"
N = "count(*) AS n"
DUMMIES = ", ".join(
    f"CASE WHEN dayname({{0}}) = '{d}' THEN 1 ELSE 0 END AS day_name_{d}"
    for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Saturday", "Sunday")
)
LAGS = "activity_lag_1, activity_lag_2, activity_lag_3, usage_lag_1, usage_lag_2, usage_lag_3"


def profile(thresholds: list[str]) -> str:
    devices = ["purchase", "signup", "view", "click", "error"]
    flags = ", ".join(f"max(CASE WHEN device = '{d}' AND value >= t THEN 1 ELSE 0 END) AS {d}_usage" for d in devices)
    means = ", ".join(r6(f"avg({d}_usage)", f"{d}_usage") for d in devices)

    def block(name: str, expr: str) -> str:
        return f"SELECT household_id, {r6('t', 'threshold')}, '{name}' AS dimension, CAST({expr} AS INTEGER) AS bucket, {r6('avg(activity)', 'activity')}, {means} FROM fl GROUP BY household_id, t, 4"

    return with_(
        " UNION ALL ".join(
            [block("hour", "hour(hour_ts)"), block("day_of_week", "isodow(hour_ts) - 1"), block("month", "month(hour_ts)")]
        ),
        fl=f"""SELECT household_id, hour_ts, t, max(CASE WHEN value >= t THEN 1 ELSE 0 END) AS activity, {flags}
          FROM ahm CROSS JOIN (SELECT CAST(unnest([{", ".join(thresholds)}]) AS DOUBLE) AS t) GROUP BY ALL""",
    )


def split_rows(end: int) -> str:
    return with_(
        f"""SELECT household_id, CASE WHEN hour_ts < CAST((SELECT d1 - 9 FROM span) AS TIMESTAMP) THEN 'train' ELSE 'test' END AS part,
        {ts("hour_ts")}, activity, hour, coalesce(activity_lag_24, 0) AS activity_lag_24, coalesce(activity_lag_48, 0) AS activity_lag_48,
        coalesce(activity_lag_72, 0) AS activity_lag_72 FROM actf
        WHERE hour_ts >= CAST((SELECT d1 - 40 FROM span) AS TIMESTAMP) AND hour_ts < CAST((SELECT d1 + {end} FROM span) AS TIMESTAMP)"""
    )


SPLIT = f"""SELECT household_id, {day("date")},
  CAST(coalesce((SELECT sum(r) FROM dd b WHERE b.household_id = a.household_id AND b.date <= a.date AND b.date >= {{start}}), 0) AS BIGINT) AS train_rows,
  CAST(coalesce((SELECT sum(p) FROM dd b WHERE b.household_id = a.household_id AND b.date <= a.date AND b.date >= {{start}}), 0) AS BIGINT) AS train_positives,
  CAST(c.r AS BIGINT) AS test_rows, CAST(c.p AS BIGINT) AS test_positives
  FROM dd a JOIN (SELECT household_id, date - 1 AS date, r, p FROM dd) c USING (household_id, date)"""
DD = "SELECT household_id, CAST(hour_ts AS DATE) AS date, count(*) AS r, sum(activity) AS p FROM act GROUP BY ALL"

SQL = {
    "f10_complete_rows": with_(
        f"SELECT {HD}, {day('min(day)', 'first_day')}, {N} FROM us WHERE usage_lag_3 IS NOT NULL GROUP BY {HD}"
    ),
    "f11_usage_flags": with_(f"SELECT {HD}, {ts('hour_ts')}, usage FROM ldp"),
    "f12_activity_flags": with_(f"SELECT household_id, {ts('hour_ts')}, activity FROM act"),
    "f13_masked_load": with_(f"SELECT {HD}, {ts('hour_ts')}, {r6('load')} FROM ldp"),
    "f14_active_last_2_days": with_(
        f"SELECT {HD}, {day('day')}, activity_lag_1, activity_lag_2, active_last_2_days FROM us"
    ),
    "f15_binarised_scores": with_(
        f"""SELECT {HD}, {day("d", "day")}, CASE WHEN p > 0 THEN 1 ELSE 0 END AS used,
        CASE WHEN p > 0.125 THEN 1 ELSE 0 END AS above, CASE WHEN p >= 0.125 THEN 1 ELSE 0 END AS reached
        FROM (SELECT {HD}, CAST(hour_ts AS DATE) AS d, avg(usage) AS p FROM ldp GROUP BY ALL)"""
    ),
    "f16_usage_model_columns": with_(
        f"SELECT {HD}, {day('day')}, usage, usage_lag_1, usage_lag_2, active_last_2_days FROM us"
    ),
    "a4_daily_usage": with_(f"SELECT {HD}, {day('day')}, usage, activity FROM ud JOIN uda USING (household_id, day)"),
    "p2_usage_all_devices": with_(
        f"""SELECT household_id, device, {day("day")}, max(usage) AS usage, any_value(activity) AS activity FROM (
          SELECT g.household_id, d.device, CAST(g.hour_ts AS DATE) AS day, CASE WHEN m.m >= 30 THEN 1 ELSE 0 END AS usage,
          max(CASE WHEN x.x >= 30 THEN 1 ELSE 0 END) OVER (PARTITION BY g.household_id, CAST(g.hour_ts AS DATE)) AS activity
          FROM wg g CROSS JOIN device d
          LEFT JOIN wm m ON m.household_id = g.household_id AND m.device = d.device AND m.hour_ts = g.hour_ts
          LEFT JOIN (SELECT household_id, hour_ts, max(m) AS x FROM wm GROUP BY ALL) x ON x.household_id = g.household_id AND x.hour_ts = g.hour_ts) y
          GROUP BY household_id, device, y.day""",
        wm="SELECT household_id, device, hour_ts, sum(v) / any_value(n) AS m FROM aw JOIN aw_n USING (household_id, hour_ts) GROUP BY ALL",
        wg="""SELECT household_id, unnest(generate_series(min(hour_ts), date_trunc('day', max(hour_ts))
          + abs(date_diff('day', CAST(max(hour_ts) AS DATE), (SELECT d1 FROM span))) * INTERVAL 1 DAY + INTERVAL 47 HOUR, INTERVAL 1 HOUR)) AS hour_ts
          FROM aw GROUP BY household_id""",
    ),
    "a9_threshold_profile": profile(["30.0"]),
    "a10_threshold_candidates": profile(["0.0", "10.0", "20.0", "40.0", "80.0"]),
    "a11_activity_by_hour": with_(f"SELECT household_id, hour, {r6('avg(activity)', 'activity')} FROM actf GROUP BY household_id, hour"),
    "a13_date_range": with_(
        f"""SELECT household_id, {day("CAST(min(last_updated_ts) AS DATE) + 1", "first_date")},
        {day("CAST(max(last_updated_ts) AS DATE) - 1", "last_date")} FROM st GROUP BY 1"""
    ),
    "a13_start_dates": with_(
        f"""SELECT household_id, {day("a.d", "activity")}, {day("u.d", "usage")}, {day("l.d", "load")},
        {day("CASE WHEN a.d IS NOT NULL AND u.d IS NOT NULL AND l.d IS NOT NULL THEN greatest(a.d, u.d, l.d) END", "combined")}
        FROM a FULL JOIN u USING (household_id) FULL JOIN l USING (household_id)""",
        a="SELECT household_id, min(CAST(hour_ts AS DATE)) AS d FROM actf WHERE hour = 0 AND activity_lag_72 IS NOT NULL GROUP BY 1",
        u="SELECT household_id, min(day) AS d FROM us WHERE usage_lag_3 IS NOT NULL GROUP BY 1",
        l="SELECT household_id, min(CAST(hour_ts AS DATE)) AS d FROM ldp WHERE hour(hour_ts) = 0 GROUP BY 1",
    ),
    "a14_train_start": with_(
        f"SELECT household_id, {day('CAST(min(hour_ts) AS DATE) + 3', 'train_start')} FROM act GROUP BY 1"
    ),
    "w1_activity_lags": with_(
        f"SELECT household_id, {ts('hour_ts')}, activity, activity_lag_24, activity_lag_48, activity_lag_72 FROM actf"
    ),
    "w1_usage_lags": with_(f"SELECT {HD}, {day('day')}, {LAGS} FROM us"),
    "w2_periods_since_last": with_(
        f"""SELECT {HD}, {ts("hour_ts")}, CAST(CASE WHEN rn > 1 THEN rn - coalesce(max(CASE WHEN load <> 0 THEN rn END) OVER
        (PARTITION BY household_id, device ORDER BY hour_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS INTEGER)
        AS periods_since_last_load FROM (SELECT *, row_number() OVER (PARTITION BY household_id, device ORDER BY hour_ts) AS rn FROM ldp) z"""
    ),
    "w3_w4_device_runs": with_(f'SELECT {HD}, {ts("run_start")}, offs AS "offset", {r6("load")} FROM run'),
    "w5_run_vectors": with_(
        f"SELECT {HD}, {ts('run_start')}, "
        + ", ".join(r6(f"coalesce(max(load) FILTER (offs = {j}), 0)", f"h{j + 1}") for j in range(24))
        + f" FROM run GROUP BY {HD}, run.run_start"
    ),
    "w6_starting_times": with_(
        f"""SELECT {HD}, {ts("hour_ts")} FROM (SELECT *, coalesce(lag(load) OVER (PARTITION BY {HD} ORDER BY hour_ts), 0) AS b FROM ldp)
        WHERE b = 0 AND load <> 0"""
    ),
    "w7_starting_hours": with_(
        f"""SELECT {HD}, {day("CAST(hour_ts AS DATE)", "day")}, string_agg(CAST(hour(hour_ts) AS VARCHAR), ',' ORDER BY hour_ts) AS hours
        FROM (SELECT *, coalesce(lag(load) OVER (PARTITION BY {HD} ORDER BY hour_ts), 0) AS b FROM ldp)
        WHERE b = 0 AND load <> 0 GROUP BY {HD}, CAST(hour_ts AS DATE)"""
    ),
    "w9_padding_to_tomorrow": with_(
        f"SELECT household_id, {ts('min(hour_ts)', 'first_hour')}, {ts('max(hour_ts)', 'last_hour')}, {N} FROM load_pad_grid GROUP BY 1"
    ),
    "w11_training_counts": with_(
        SPLIT.format(start="(SELECT min(date) + 3 FROM dd m WHERE m.household_id = a.household_id)"), dd=DD
    ),
    "m2_sliding_training_counts": with_(SPLIT.format(start="greatest(a.date - 10, (SELECT d0 + 2 FROM span))"), dd=DD),
    "m1_usage_split": with_(
        f"""SELECT {HD}, CASE WHEN day <= (SELECT d1 - 10 FROM span) THEN 'train' ELSE 'test' END AS part, {day("day")}, usage,
        usage_lag_1, usage_lag_2, active_last_2_days
        FROM (SELECT *, min(us.day) OVER (PARTITION BY {HD}) + 3 AS s FROM us) q
        WHERE (q.day BETWEEN s AND (SELECT d1 - 10 FROM span)) OR q.day = (SELECT d1 - 9 FROM span)"""
    ),
    "m2_activity_split": split_rows(-8),
    "m2_activity_split_open": split_rows(40_000),
    "p1_activity_table": with_(
        f"""SELECT household_id, {ts("hour_ts")}, activity, hour, {DUMMIES.format("actf.hour_ts")},
        activity_lag_24, activity_lag_48, activity_lag_72 FROM actf"""
    ),
    "p2_usage_table": with_(
        f"""SELECT {HD}, {day("day")}, usage, activity, periods_since_last_activity, periods_since_last_usage, {LAGS},
        active_last_2_days, 0 AS hour, {DUMMIES.format("us.day")} FROM us"""
    ),
    "p3_load_table": with_(f"SELECT {HD}, {ts('hour_ts')}, {r6('value')}, usage, {r6('load')} FROM ldp"),
    "a12_load_profile": with_(
        f"""SELECT {HD}, n_runs, o.offs AS "offset", {r6("coalesce(s / nullif(n_runs, 0), 0)", "load")}
        FROM dv JOIN (SELECT {HD}, count(DISTINCT run_start) AS n_runs FROM dv LEFT JOIN run USING ({HD}) GROUP BY ALL) USING ({HD})
        CROSS JOIN (SELECT CAST(unnest(range(24)) AS INTEGER) AS offs) o
        LEFT JOIN (SELECT {HD}, offs, sum(load) AS s FROM run GROUP BY ALL) x USING ({HD}, offs)""",
        dv=f"SELECT DISTINCT {HD} FROM ldp",
    ),
    "p5_profiles_by_date": with_(
        f"""SELECT {HD}, {day("date")}, n_runs, offs AS "offset", {r6("load")} FROM prof"""
    ),
}
