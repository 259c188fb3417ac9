"""SQL for prices, costs, recommendations and the back-test."""

from checks.sql_parts import day, r6, ts, with_

HD = "household_id, device"
N = "count(*) AS n"
FLAGS = "flag_a AS no_recommend_flag_activity, flag_u AS no_recommend_flag_usage, recommendation"
HOUR_CAST = "CAST(best_launch_hour AS INTEGER) AS best_launch_hour"
INDEX = "strftime(date + 1, '%Y-%m-%d') || '_' || device AS index"
OFFS48 = "(SELECT CAST(unnest(range(48)) AS INTEGER) AS offs) o"
BEST = "SELECT household_id, device, date, arg_min(hour, (round(cost, 9), hour)) FILTER (cost IS NOT NULL) AS hour FROM cost GROUP BY ALL"
ADDED = ", ".join(["n_recommendations", r6("acceptable"), r6("total_savings"), r6("relative_savings_mean")])
SUMMARY = ", ".join([ADDED, r6("relative_savings_median")])
WHEN = "strftime(date + 1, '%d.%m.%Y')"
AT = "printf('%02d:00', best_launch_hour)"

SQL = {
    "cheapest_launch_hour": with_(
        f"""SELECT {HD}, {day("date")}, b.hour AS best_launch_hour, {r6("c.cost * 1000", "cost_mill")}
        FROM b LEFT JOIN cost c USING ({HD}, date, hour)""",
        b=BEST,
    ),
    "j14_price_fill": with_(
        f"SELECT f.zone, {ts('f.hour')}, {r6('p.price', 'raw')}, {r6('f.price', 'price')} FROM pf f LEFT JOIN pr p ON p.hour = f.hour"
    ),
    "r1_price_horizon": with_(
        f"""SELECT 'Z1' AS zone, {day("d", "date")}, offs AS "offset", {r6("price")}
        FROM (SELECT CAST(unnest(generate_series((SELECT d1 - 10 FROM span), (SELECT d1 FROM span), INTERVAL 1 DAY)) AS DATE) AS d) CROSS JOIN {OFFS48}
        LEFT JOIN pf p ON p.hour = CAST(d + 1 AS TIMESTAMP) + offs * INTERVAL 1 HOUR"""
    ),
    "r1_price_horizon_as_of": with_(
        f"""SELECT 'Z1' AS zone, {day("d", "date")}, offs AS "offset",
        {r6("CASE WHEN d + 1 > (SELECT max(CAST(hour AS DATE)) FROM pr) THEN t.price ELSE p.price END", "price")}
        FROM (SELECT CAST(unnest(generate_series((SELECT d1 - 4 FROM span), (SELECT d1 FROM span), INTERVAL 1 DAY)) AS DATE) AS d) CROSS JOIN {OFFS48}
        LEFT JOIN pf p ON p.hour = CAST(d + 1 AS TIMESTAMP) + offs * INTERVAL 1 HOUR
        LEFT JOIN pr t ON t.hour = CAST((SELECT d1 - 5 FROM span) AS TIMESTAMP) + (offs % 24) * INTERVAL 1 HOUR"""
    ),
    "w8_r2_shifted_prices": with_(
        f"SELECT 'Z1' AS zone, {day('date')}, h AS hour, "
        + ", ".join(r6(f"max(price) FILTER (offs = h + {i})", f"h{i}") for i in range(24))
        + " FROM hz CROSS JOIN (SELECT CAST(unnest(range(24)) AS INTEGER) AS h) GROUP BY hz.date, h"
    ),
    "r3_j10_cost_by_start": with_(f"SELECT {HD}, {day('date')}, hour, {r6('cost * 1000', 'cost_mill')} FROM cost"),
    "t4_best_hour": with_(f"SELECT {HD}, {day('date')}, hour FROM b", b=BEST),
    "r4_activity_mask": with_(
        f"""SELECT household_id, {day("date")}, hour, {r6("p")}, CASE WHEN p >= 0.15 THEN 1 ELSE 0 END AS acceptable,
        CASE WHEN max(p) OVER (PARTITION BY household_id, ar.date) >= 0.15 THEN 0 ELSE 1 END AS no_recommend_flag_activity
        FROM ar WHERE p IS NOT NULL AND target_date IS NOT NULL"""
    ),
    "r5_usage_gate": with_(
        f"SELECT {HD}, {day('date')}, {r6('p')}, CASE WHEN p < 0.5 THEN 1 ELSE 0 END AS no_recommend_flag_usage FROM ur"
    ),
    "r6_recommend_by_device": with_(f"SELECT {HD}, {day('date')}, {HOUR_CAST}, {FLAGS}, error FROM rec1"),
    "r7_j6_recommendation_table": with_(
        f"""SELECT {INDEX}, household_id, {day("date", "recommendation_calculation_date")}, {day("date + 1", "recommendation_date")},
        device, friendly_name, {HOUR_CAST}, {FLAGS} FROM rec1"""
    ),
    "r8_recommendations_on_dates": with_(
        f"""SELECT q.household_id, q.device, {day("q.date")}, r.best_launch_hour, r.recommendation,
        CASE WHEN r.date IS NULL THEN 'no load profile' ELSE r.error END AS error
        FROM (SELECT household_id, device, CAST(unnest(generate_series((SELECT d0 FROM span), (SELECT d1 - 1 FROM span), INTERVAL 1 DAY)) AS DATE) AS date
          FROM (SELECT DISTINCT household_id FROM st) CROSS JOIN device) q LEFT JOIN rec1 r USING ({HD}, date)"""
    ),
    "r9_sentences": with_(
        f"""SELECT household_id, {INDEX},
        CASE WHEN recommendation IS NOT NULL THEN 'You have one recommendation for the following device: ' || friendly_name || chr(10)
          || 'Please use it on ' || {WHEN} || ' at ' || {AT} || '.' END AS plain,
        CASE WHEN recommendation IS NOT NULL THEN 'You have a recommendation for the following device: ' || friendly_name || chr(10) || chr(10)
          || 'Please use the device on the ' || {WHEN} || ' at ' || {AT} || ' oclock because it costs you only '
          || CAST(round(z.price, 6) AS VARCHAR) || ' €.' || chr(10) END AS with_price,
        CASE WHEN recommendation IS NOT NULL THEN 'You have a recommendation for the following device: ' || friendly_name || chr(10) || chr(10)
          || 'Please use the device on the ' || {WHEN} || ' at ' || {AT} || ' o''clock because it saves you '
          || CAST(round((1 - z.price / m.mean) * 100, 2) AS VARCHAR) || ' % of costs compared to the mean of the day.' || chr(10)
          ELSE 'There is no recommendation for the device ' || friendly_name || ' .' END AS with_savings
        FROM rec1 r LEFT JOIN (SELECT date, offs AS best_launch_hour, price FROM hz) z USING (date, best_launch_hour)
        LEFT JOIN (SELECT date, sum(price) / 24 AS mean FROM hz WHERE offs < 24 GROUP BY 1) m USING (date)"""
    ),
    "a24_hour_histogram": with_(
        f"SELECT recommendation, {N} FROM rec1 WHERE recommendation IS NOT NULL GROUP BY 1"
    ),
    "a25_time_line": with_(f"SELECT {HD}, {day('date + 1', 'recommendation_date')}, recommendation FROM rec1"),
    "j13_stored_predictions": with_(f"SELECT {INDEX}, household_id, {HOUR_CAST}, recommendation FROM rec1"),
    "j7_usage_truth": with_(
        f"""SELECT {HD}, {day("d.date")}, u.usage AS usage_true FROM prof_day d JOIN dates USING (date)
        LEFT JOIN (SELECT {HD}, day - 1 AS date, usage FROM us) u USING ({HD}, date)"""
    ),
    "j8_activity_truth": with_(
        f"""SELECT b.household_id, b.device, {day("b.date")}, b.hour, x.activity AS activity_true FROM b
        LEFT JOIN act x ON x.household_id = b.household_id AND x.hour_ts = CAST(b.date + 1 AS TIMESTAMP) + b.hour * INTERVAL 1 HOUR""",
        b=BEST,
    ),
    "j9_run_lookup": with_(
        f"""SELECT d.household_id, d.device, {day("d.date")}, s.start_hour AS hour, """
        + ", ".join(r6(f"coalesce(max(r.load) FILTER (r.offs = {j}), 0)", f"h{j + 1}") for j in range(24))
        + f""" FROM prof_day d JOIN dates USING (date) LEFT JOIN rstart s USING ({HD}, date)
        LEFT JOIN run r ON r.household_id = d.household_id AND r.device = d.device AND r.run_start = s.run_start GROUP BY 1, 2, d.date, s.start_hour"""
    ),
    "j11_nearest_start": with_(
        f"""SELECT b.household_id, b.device, {day("b.date")}, b.hour,
        arg_min(s.start_hour, (coalesce(abs(s.start_hour - b.hour), 0), s.start_hour)) AS relevant_start
        FROM b LEFT JOIN rstart s ON s.household_id = b.household_id AND s.device = b.device AND s.date = b.date GROUP BY 1, 2, b.date, b.hour""",
        b=BEST,
    ),
    "j12_threshold_pairs": with_(
        "SELECT DISTINCT household_id, a AS activity_threshold, u AS usage_threshold FROM st CROSS JOIN athr CROSS JOIN uthr"
    ),
    "r10_run_cost": with_(
        f"""SELECT s.household_id, s.device, {day('s.date')}, s.start_hour AS hour, {r6('c.cost')} FROM rstart s
        LEFT JOIN rcost c ON c.household_id = s.household_id AND c.device = s.device AND c.date = s.date
          AND c.start_hour = s.start_hour AND c.hour = s.start_hour"""
    ),
    "r11_back_test": with_(
        f"""SELECT {HD}, {day("date")}, a AS activity_threshold, u AS usage_threshold, rec AS recommendation, acceptable, relevant_start,
        {r6("no_rec", "cost_no_recommendation")}, {r6("with_rec", "cost_recommendation")}, {r6("savings")}, {r6("relative_savings")} FROM bt"""
    ),
    "r12_evaluate_pair": with_(
        f"""SELECT device, count(rec) AS n_recommendations, CAST(sum(acceptable) AS BIGINT) AS n_acceptable, {r6("sum(savings)", "savings")}
        FROM bt WHERE a = 0.125 AND u = 0.5 GROUP BY 1"""
    ),
    "r13_a17_grid_search": with_(
        f"SELECT household_id, a AS activity_threshold, u AS usage_threshold, {SUMMARY} FROM summ"
    ),
    "a23_sensitivity": with_(
        "SELECT household_id, a AS activity_threshold, "
        + ", ".join(r6(f"max(total_savings) FILTER (u = {i}/8)", f"u{i}") for i in range(1, 8))
        + " FROM summ GROUP BY 1, 2"
    ),
    "t2_optimal_thresholds": with_(
        """SELECT household_id, b.a AS activity_threshold, b.u AS usage_threshold FROM (
        SELECT household_id, arg_max({'a': a, 'u': u}, (round(total_savings, 6), a, u)) AS b FROM summ GROUP BY 1)"""
    ),
    "t2_fine_thresholds": with_(
        f"""SELECT household_id, a AS activity_threshold, u AS usage_threshold, {ADDED} FROM (
        SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY round(total_savings, 6) DESC, a DESC, u DESC) AS r FROM summ) WHERE r = 1""",
        athr="SELECT unnest(range(1, 64)) / 64 AS a",
        uthr="SELECT unnest(range(1, 64)) / 64 AS u",
    ),
    "t3_optimal_result": with_(
        f"""SELECT household_id, a AS activity_threshold, u AS usage_threshold, {SUMMARY} FROM (
        SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY round(total_savings, 6) DESC, a DESC, u DESC) AS r FROM summ) WHERE r = 1"""
    ),
}
