"""SQL for sources, filters, cleaning and table shaping."""

from checks.sql_parts import SHIFT, WATT, day, r6, ts, with_

EV = "household_id, entity_id, state"
ATTR_TEXT = """'{' || CASE WHEN entity_id IN ('purchase','signup','view') THEN '"unit_of_measurement": "W", ' ELSE '' END
  || '"friendly_name": "' || upper(entity_id[1]) || entity_id[2:] || ' plug ' || (k % 2) || '", "restored": '
  || CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END || ', "device_class": null'
  || CASE WHEN k = 7 THEN ', "calibration": {"offset": 0.5}' ELSE '' END || '}'"""
CAL = "CASE WHEN k = 7 THEN CAST(0.5 AS DOUBLE) END"
NAME = "upper(entity_id[1]) || entity_id[2:] || ' plug ' || (k % 2)"
N = "count(*) AS n"
# Without April, the first in alphabetical order.
MONTHS = "January February March May June July August September October November December".split()
WEATHER = ", ".join(r6(c) for c in ("temp", "dwpt", "rhum", "wdir", "wspd"))


def resample(seconds: int) -> str:
    return with_(
        f"""SELECT g.household_id, g.entity_id, {ts("g.o + g.b * INTERVAL " + str(seconds) + " SECOND", "last_updated_ts")}, {r6("m", "value")}
        FROM gr g LEFT JOIN bi USING (household_id, entity_id, b)""",
        w1=f"SELECT household_id, entity_id, last_updated_ts AS t, TRY_CAST(state AS DOUBLE) AS v FROM st WHERE entity_id IN {WATT}",
        o1="SELECT household_id, entity_id, date_trunc('day', min(t)) AS o FROM w1 GROUP BY ALL",
        bn=f"SELECT household_id, entity_id, o, CAST(floor(date_diff('second', o, date_trunc('minute', t)) / {seconds}.0) AS BIGINT) AS b, v FROM w1 JOIN o1 USING (household_id, entity_id)",
        bi="SELECT household_id, entity_id, b, avg(v) AS m FROM bn GROUP BY ALL",
        gr="SELECT household_id, entity_id, any_value(o) AS o, unnest(generate_series(min(b), max(b))) AS b FROM bn GROUP BY household_id, entity_id",
    )


SQL = {
    "s1_export_states": with_(
        f"""SELECT {EV}, {ts("last_updated_ts")}, attributes_id, {ATTR_TEXT} AS shared_attrs
        FROM st WHERE last_updated_ts > CAST((SELECT d1 - 19 FROM span) AS TIMESTAMP)"""
    ),
    "s1_epoch_time": f"SELECT {day('ts', 'day')}, {N} FROM events GROUP BY 1",
    "s2_reading_columns": with_(f"SELECT entity_id, {ts('last_updated_ts')}, state FROM st"),
    "s3_household_csv": f"""SELECT CAST(user_id // 5 AS INTEGER) AS household_id, {ts("date_trunc('second', ts)", "time")},
        event_type || ' meter' AS device, {r6("sum(value)", "value")} FROM events GROUP BY 1, 2, 3""",
    "s3_label_map": with_(
        """SELECT household_id, 'Appliance' || i AS appliance, l AS label FROM (SELECT DISTINCT household_id FROM st),
        (SELECT unnest(range(7)) AS i, unnest(['purchase meter','signup meter','view meter','click meter','error meter','spare','spare']) AS l)"""
    ),
    "s4_price_csv": with_(
        f"""SELECT {ts("hour - y * INTERVAL 1 YEAR", "time")}, {r6("price")} FROM pr, (SELECT unnest([0, 1, 2]) AS y)"""
    ),
    "s5_prices_around_date": with_(
        f"""SELECT zone, {ts("hour - INTERVAL 1 HOUR", "hour")}, {r6("price")} FROM pr
        WHERE hour BETWEEN TIMESTAMP '2023-12-27 00:00:00' AND TIMESTAMP '2024-02-05 00:00:00'"""
    ),
    "s6_price_history": with_(
        f"""SELECT zone, {ts("hour")}, {r6("price")} FROM pr
        WHERE hour >= TIMESTAMP '2024-01-05 00:00:00' AND hour < TIMESTAMP '2024-01-20 00:00:00'"""
    ),
    "s7_weather_range": with_(
        f"""SELECT station, {ts("time")}, {WEATHER} FROM we WHERE time BETWEEN
        (SELECT min(hour_ts) FROM ld) AND (SELECT max(hour_ts) FROM ld WHERE hour_ts < TIMESTAMP '2024-01-21 00:00:00')"""
    ),
    "s7_weather_daily": with_(
        "SELECT station, strftime(date_trunc('day', time), '%Y-%m-%d %H:%M:%S') AS time, "
        + ", ".join(r6(f"avg({c})", c) for c in ("temp", "dwpt", "rhum", "wdir", "wspd"))
        + " FROM we GROUP BY station, date_trunc('day', time)"
    ),
    "s8_config_files": with_(
        """SELECT DISTINCT household_id, CASE WHEN household_id % 2 = 0 THEN 'purchase,signup' ELSE 'signup' END AS shiftable_devices,
        'purchase,signup,view,click,error' AS active_appliances, CAST(30 AS DOUBLE) AS threshold FROM st"""
    ),
    "a21_device_legend": with_(
        """SELECT DISTINCT household_id, CASE WHEN household_id % 2 = 0 THEN 'purchase' ELSE 'signup' END AS device_0,
        CASE WHEN household_id % 2 = 0 THEN 'signup' END AS device_1 FROM st"""
    ),
    "s9_s10_store_round_trip": with_(
        f"""SELECT household_id, device, activity_model, usage_model, {N}, {r6('sum(load)', 'load')} FROM ld
        CROSS JOIN (VALUES ('knn', 'knn'), ('logit', 'rate')) m(activity_model, usage_model) GROUP BY ALL"""
    ),
    "f1_unpack_attributes": with_(
        f"""SELECT attributes_id, unit_of_measurement, friendly_name, CAST(NULL AS VARCHAR) AS device_class,
        CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS restored, {CAL} AS calibration_offset FROM attr"""
    ),
    "f1_attribute_value": with_(f"SELECT attributes_id, friendly_name, {CAL} AS calibration_offset FROM attr"),
    "f2_sparse_columns": with_(
        """SELECT * REPLACE (CASE WHEN n_non_null >= 9 THEN 1 ELSE 0 END AS kept) FROM (
        SELECT unnest(['household_id','entity_id','state','last_updated_ts','attributes_id','unit_of_measurement',
          'friendly_name','device_class','restored','calibration_offset']) AS column,
        unnest([count(*), count(*), count(*), count(*), count(*), count(*) FILTER (entity_id IN ('purchase','signup','view')),
          count(*), 0, count(*), count(*) FILTER (k = 7)]) AS n_non_null, 0 AS kept FROM st)"""
    ),
    "f3_numeric_states": with_(
        f"""SELECT entity_id, count(*) AS n_rows, count(TRY_CAST(state AS DOUBLE)) AS n_numbers,
        {r6("sum(TRY_CAST(state AS DOUBLE))", "total")} FROM st GROUP BY entity_id"""
    ),
    "f4_watt_devices": with_(f"SELECT {EV}, {ts('last_updated_ts')} FROM st WHERE entity_id IN {SHIFT}"),
    "f5_switched_on": with_(
        f"SELECT household_id, entity_id, 1 AS state, {ts('last_updated_ts')} FROM st WHERE state = 'on'"
    ),
    "f6_last_days": with_(
        f"SELECT household_id, entity_id, {N} FROM st WHERE last_updated_ts > CAST((SELECT d1 - 6 FROM span) AS TIMESTAMP) GROUP BY 1, 2"
    ),
    "f7_timespan": with_(
        f"""SELECT household_id, device, {ts("hour_ts")}, {r6("load")} FROM ld
        WHERE hour_ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-11 12:00:00'"""
    ),
    "f8_complete_days": with_(
        f"""SELECT household_id, device, {ts("min(hour_ts)", "first_hour")}, {ts("max(hour_ts)", "last_hour")}, {N}
        FROM ld JOIN dn USING (household_id, device) JOIN d0 USING (household_id, device)
        WHERE CAST(hour_ts AS DATE) = d AND hour_ts < CAST((SELECT d1 + 1 FROM span) AS TIMESTAMP)
          AND (c >= 24 OR d > f) AND (c >= 24 OR d < (SELECT d1 FROM span)) GROUP BY 1, 2""",
        dn="SELECT household_id, device, CAST(hour_ts AS DATE) AS d, count(*) AS c FROM ld GROUP BY ALL",
        d0="SELECT household_id, device, min(CAST(hour_ts AS DATE)) AS f FROM ld GROUP BY ALL",
    ),
    "f9_until_yesterday": with_(
        f"""SELECT household_id, device, {ts("max(hour_ts)", "last_hour")}, {N}, {r6("sum(load)", "load")}
        FROM ld WHERE hour_ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2"""
    ),
    "f17_numeric_columns": f"SELECT {r6('avg(event_id)', 'event_id')}, {r6('avg(user_id)', 'user_id')}, {r6('avg(value)', 'value')} FROM events",
    "j1_attribute_join": with_(
        f"SELECT household_id, entity_id, {N}, count(a.friendly_name) AS n_named FROM st LEFT JOIN (SELECT attributes_id, friendly_name FROM attr) a USING (attributes_id) GROUP BY 1, 2"
    ),
    "j2_outer_pivot": with_(
        f"""SELECT coalesce(w.household_id, s.household_id) AS household_id, {ts("coalesce(w.t, s.t)", "last_updated_ts")},
        purchase, signup, view, click, error FROM w FULL JOIN s ON w.household_id = s.household_id AND w.t = s.t""",
        w=f"""SELECT household_id, last_updated_ts AS t,
          coalesce(any_value(CAST(state AS DOUBLE)) FILTER (entity_id = 'purchase'), 0) AS purchase,
          coalesce(any_value(CAST(state AS DOUBLE)) FILTER (entity_id = 'signup'), 0) AS signup,
          coalesce(any_value(CAST(state AS DOUBLE)) FILTER (entity_id = 'view'), 0) AS view
          FROM st WHERE entity_id IN {WATT} GROUP BY ALL""",
        s="""SELECT household_id, last_updated_ts AS t, CAST(max(CASE WHEN entity_id = 'click' THEN 1 ELSE 0 END) AS DOUBLE) AS click,
          CAST(max(CASE WHEN entity_id = 'error' THEN 1 ELSE 0 END) AS DOUBLE) AS error FROM st WHERE state = 'on' GROUP BY ALL""",
    ),
    "j5_column_bind": with_(
        f"""SELECT {EV}, {ts("last_updated_ts")}, attributes_id, CASE WHEN entity_id IN {WATT} THEN 'W' END AS unit_of_measurement,
        {NAME} AS friendly_name FROM st"""
    ),
    "u1_union_years": with_(
        f"""SELECT zone, {ts("hour")}, {r6("price")} FROM pr UNION ALL
        SELECT zone, {ts("hour - INTERVAL 1 YEAR", "hour")}, {r6("price")} FROM pr"""
    ),
    "u2_distinct_days": with_(f"SELECT DISTINCT household_id, {day('last_updated_ts', 'day')} FROM st"),
    "u3_non_empty_columns": with_(
        """SELECT c AS column FROM (SELECT unnest(['temp','dwpt','rhum','wdir','wspd']) AS c,
        unnest([count(temp), count(dwpt), count(rhum), count(wdir), count(wspd)]) AS n FROM we) WHERE n > 0"""
    ),
    "a1_device_pivot": with_(
        f"""SELECT household_id, {ts("last_updated_ts")},
        coalesce(any_value(TRY_CAST(state AS DOUBLE)) FILTER (entity_id = 'purchase'), 0) AS purchase,
        coalesce(any_value(TRY_CAST(state AS DOUBLE)) FILTER (entity_id = 'signup'), 0) AS signup
        FROM st WHERE entity_id IN {SHIFT} GROUP BY household_id, st.last_updated_ts"""
    ),
    "a1_duplicate_readings": with_(
        " UNION ALL ".join(
            f"""SELECT household_id, entity_id, {ts(f"date_trunc('{unit}', last_updated_ts)", "last_updated_ts")}, {N}
            FROM st GROUP BY 1, 2, date_trunc('{unit}', st.last_updated_ts) HAVING count(*) > 1"""
            for unit in ("second", "hour")
        )
    ),
    "a2_hourly_load": with_(f"SELECT household_id, device, {ts('hour_ts')}, {r6('value')} FROM ld"),
    "a3_resample_7min": resample(420),
    "a3_resample_daily": resample(86400),
    "a5_outlier_truncation": with_(
        f"""SELECT household_id, entity_id, {ts("last_updated_ts")},
        {r6("CASE WHEN v > q3 + 0.2 * (q3 - q1) THEN trunc(q3 + 0.2 * (q3 - q1)) WHEN v < q1 - 0.2 * (q3 - q1) THEN trunc(q1 - 0.2 * (q3 - q1)) ELSE v END", "value")}
        FROM w JOIN q USING (household_id, entity_id)""",
        w=f"SELECT *, TRY_CAST(state AS DOUBLE) AS v FROM st WHERE entity_id IN {WATT}",
        q="SELECT household_id, entity_id, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM w GROUP BY ALL",
    ),
    "a6_truncate_non_zero": with_(
        f"""SELECT household_id, device, {ts("hour_ts")},
        {r6("CASE WHEN value = 0 THEN 0 WHEN value > q3 + 0.2 * (q3 - q1) THEN trunc(q3 + 0.2 * (q3 - q1)) WHEN value < q1 - 0.2 * (q3 - q1) THEN trunc(q1 - 0.2 * (q3 - q1)) ELSE value END", "value")}
        FROM ld LEFT JOIN q USING (household_id, device)""",
        q="SELECT household_id, device, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ld WHERE value <> 0 GROUP BY ALL",
    ),
    "a7_min_max_scale": with_(
        f"""SELECT household_id, device, {ts("hour_ts")},
        {r6("coalesce((value - min(value) OVER w) / nullif(max(value) OVER w - min(value) OVER w, 0), 0)", "value")}
        FROM ld WINDOW w AS (PARTITION BY household_id, device)"""
    ),
    "a8_friendly_names": with_(
        f"""SELECT DISTINCT household_id, entity_id, {NAME} AS friendly_name FROM st
        WHERE entity_id IN {SHIFT} AND last_updated_ts > CAST((SELECT d1 - 29 FROM span) AS TIMESTAMP)"""
    ),
    "p4_friendly_name_table": with_(
        f"""SELECT household_id, entity_id, arg_max({NAME}, last_updated_ts) AS friendly_name FROM st
        WHERE entity_id IN {SHIFT} AND last_updated_ts > CAST((SELECT d1 - 29 FROM span) AS TIMESTAMP) GROUP BY 1, 2"""
    ),
    "a15_days_in_range": with_(
        f"""SELECT household_id, {day("d", "day")} FROM (SELECT household_id, unnest(generate_series(
        date_trunc('day', min(last_updated_ts)), date_trunc('day', max(last_updated_ts)), INTERVAL 1 DAY)) AS d FROM st GROUP BY 1)"""
    ),
    "a16_last_reported": with_(
        f"""SELECT household_id, {day("max(last_updated_ts)", "last_reported")},
        CAST(abs(date_diff('day', CAST(max(last_updated_ts) AS DATE), DATE '2024-02-10')) AS INTEGER) AS days FROM st GROUP BY 1"""
    ),
    "a26_data_profile": with_(
        f"""SELECT household_id, entity_id, count(v) AS count, count(*) - count(v) AS missing, {r6("avg(v)", "mean")},
        {r6("stddev_samp(v)", "std")}, {r6("min(v)", "min")}, {r6("max(v)", "max")}, {r6("quantile_cont(v, 0.25)", "q1")},
        {r6("quantile_cont(v, 0.5)", "q2")}, {r6("quantile_cont(v, 0.75)", "q3")} FROM w GROUP BY 1, 2""",
        w=f"SELECT *, TRY_CAST(state AS DOUBLE) AS v FROM st WHERE entity_id IN {WATT}",
    ),
    "a26_histogram": with_(
        f"""SELECT household_id, entity_id, CAST(CASE WHEN v < 0 THEN 0 WHEN v >= 500 THEN 11 ELSE floor(v / 50) + 1 END AS INTEGER) AS bin, {N}
        FROM w GROUP BY 1, 2, 3""",
        w=f"SELECT *, TRY_CAST(state AS DOUBLE) AS v FROM st WHERE entity_id IN {WATT}",
    ),
    "fn_time_features": with_(
        f"""SELECT {ts("hour", "at")}, CAST(hour(p.hour) AS INTEGER) AS hour, CAST(isodow(p.hour) - 1 AS INTEGER) AS day_of_week,
        dayname(p.hour) AS day_name, CAST(month(p.hour) AS INTEGER) AS month, monthname(p.hour) AS month_name,
        CASE WHEN isodow(p.hour) >= 6 THEN 1 ELSE 0 END AS weekend FROM pr p"""
    ),
    "fn_safe_names": """SELECT DISTINCT 'Sensor.' || event_type || ' (Plug 1)' AS entity,
        'sensor_' || event_type || ' plug 1' AS safe, 'sensor.' || event_type || '_plug_1' AS safe_spaced FROM events""",
    "fn_dummies": with_(
        "SELECT household_id, "
        + ", ".join(f"count(*) FILTER (monthname(last_updated_ts) = '{m}') AS month_{m}" for m in MONTHS)
        + """, count(*) FILTER (entity_id = 'purchase') AS entity_purchase, count(*) FILTER (entity_id = 'signup') AS entity_signup,
        count(*) FILTER (entity_id = 'view') AS entity_view, count(*) FILTER (entity_id = 'error') AS entity_error
        FROM st GROUP BY 1"""
    ),
}
