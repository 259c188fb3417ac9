"""Named sub-queries shared by the SQL counterparts; ``with_`` adds those a statement needs, in order."""

from __future__ import annotations

import re

SHIFT = "('purchase','signup')"
WATT = "('purchase','signup','view')"
# The run's dates follow the events: today is the day of the last one.
TODAY = "(SELECT d1 FROM span)"


def on(days: int) -> str:
    """So many days after the first event's day; before today for negative numbers."""
    return f"(SELECT {'d0' if days >= 0 else 'd1'} + ({days}) FROM span)"


FIRST, LAST = on(4), on(-1)


def ts(x: str, name: str | None = None) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S') AS {name or x.split('.')[-1]}"


def day(x: str, name: str | None = None) -> str:
    return f"strftime({x}, '%Y-%m-%d') AS {name or x.split('.')[-1]}"


def r6(x: str, name: str | None = None) -> str:
    return f"round(({x}) + 1e-9, 6) + 0.0 AS {name or x.split('.')[-1]}"


def padded_end(h: str) -> str:
    return f"date_trunc('day', {h}) + abs(date_diff('day', CAST({h} AS DATE), {TODAY})) * INTERVAL 1 DAY + INTERVAL 47 HOUR"


def runs_sql(source: str) -> str:
    """Positive islands with their start and offset; at most 24 hours, one hour for an island at the first row."""
    return f"""SELECT household_id, device, hour_ts, run_start, offs, load FROM (
      SELECT household_id, device, hour_ts, load, min(hour_ts) OVER i AS run_start, min(rn) OVER i AS first_rn,
        CAST(row_number() OVER (PARTITION BY household_id, device, g ORDER BY hour_ts) - 1 AS INTEGER) AS offs
      FROM (SELECT *, row_number() OVER w AS rn, sum(CASE WHEN load > 0 THEN 0 ELSE 1 END) OVER w AS g FROM {source}
        WINDOW w AS (PARTITION BY household_id, device ORDER BY hour_ts)) x
      WHERE load > 0 WINDOW i AS (PARTITION BY household_id, device, g))
      WHERE offs < CASE WHEN first_rn = 1 THEN 1 ELSE 24 END"""


def auc_sql(source: str, keys: str) -> str:
    """ROC AUC from (keys, p, n_pos, n_neg): positives beat the negatives below them, ties count half."""
    return f"""SELECT {keys}, CASE WHEN sum(n_pos) > 0 AND sum(n_neg) > 0 THEN sum(n_pos * (below + n_neg / 2)) / (sum(n_pos) * sum(n_neg)) END AS auc,
      sum(n_pos) + sum(n_neg) AS n FROM (SELECT *, coalesce(sum(n_neg) OVER (PARTITION BY {keys} ORDER BY p
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM {source}) GROUP BY {keys}"""


def brier_sql(source: str, keys: str) -> str:
    return f"SELECT {keys}, sum(n_pos * (1 - p) * (1 - p) + n_neg * p * p) / sum(n_pos + n_neg) AS score, sum(n_pos + n_neg) AS n FROM {source} GROUP BY {keys}"


PARTS: dict[str, str] = {
    "span": "SELECT CAST(min(ts) AS DATE) AS d0, CAST(max(ts) AS DATE) AS d1 FROM events",
    "st": """SELECT CAST(user_id // 5 AS INTEGER) AS household_id, event_type AS entity_id,
      CASE WHEN event_type IN ('purchase','signup','view') THEN CAST(value AS VARCHAR)
           WHEN value >= 35 THEN 'on' ELSE 'off' END AS state,
      ts AS last_updated_ts, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k,
      CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) * 8
        + list_position(['purchase','signup','view','click','error'], event_type) - 1 AS attributes_id
      FROM events""",
    "attr": """SELECT DISTINCT attributes_id, k, entity_id,
      CASE WHEN entity_id IN ('purchase','signup','view') THEN 'W' END AS unit_of_measurement,
      upper(entity_id[1]) || entity_id[2:] || ' plug ' || (k % 2) AS friendly_name FROM st""",
    "load_rows": """SELECT household_id, entity_id AS device, last_updated_ts AS ts,
      date_trunc('hour', last_updated_ts) AS hour_ts, coalesce(TRY_CAST(state AS DOUBLE), 0) AS v
      FROM st WHERE entity_id IN ('purchase','signup')""",
    "load_n": "SELECT household_id, hour_ts, count(DISTINCT ts) AS n FROM load_rows GROUP BY ALL",
    "load_s": "SELECT household_id, device, hour_ts, sum(v) AS s FROM load_rows GROUP BY ALL",
    "load_span": "SELECT household_id, min(hour_ts) AS h0, max(hour_ts) AS h1 FROM load_rows GROUP BY ALL",
    "load_grid": "SELECT household_id, unnest(generate_series(h0, h1, INTERVAL 1 HOUR)) AS hour_ts FROM load_span",
    "load_pad_grid": f"SELECT household_id, unnest(generate_series(h0, {padded_end('h1')}, INTERVAL 1 HOUR)) AS hour_ts FROM load_span",
    "device": "SELECT unnest(['purchase','signup']) AS device",
    "ld": """SELECT g.household_id, d.device, g.hour_ts, coalesce(s.s / n.n, 0) AS value,
      CASE WHEN coalesce(s.s / n.n, 0) >= 30 THEN 1 ELSE 0 END AS usage,
      CASE WHEN coalesce(s.s / n.n, 0) >= 30 THEN s.s / n.n ELSE 0 END AS load
      FROM load_grid g CROSS JOIN device d
      LEFT JOIN load_s s ON s.household_id = g.household_id AND s.device = d.device AND s.hour_ts = g.hour_ts
      LEFT JOIN load_n n ON n.household_id = g.household_id AND n.hour_ts = g.hour_ts""",
    "ldp": """SELECT g.household_id, d.device, g.hour_ts, coalesce(s.s / n.n, 0) AS value,
      CASE WHEN coalesce(s.s / n.n, 0) >= 30 THEN 1 ELSE 0 END AS usage,
      CASE WHEN coalesce(s.s / n.n, 0) >= 30 THEN s.s / n.n ELSE 0 END AS load
      FROM load_pad_grid g CROSS JOIN device d
      LEFT JOIN load_s s ON s.household_id = g.household_id AND s.device = d.device AND s.hour_ts = g.hour_ts
      LEFT JOIN load_n n ON n.household_id = g.household_id AND n.hour_ts = g.hour_ts""",
    # activity: power means over distinct power timestamps, switches over distinct switch-on timestamps
    "aw": """SELECT household_id, entity_id AS device, last_updated_ts AS ts, date_trunc('hour', last_updated_ts) AS hour_ts,
      coalesce(TRY_CAST(state AS DOUBLE), 0) AS v FROM st WHERE entity_id IN ('purchase','signup','view')""",
    "aw_n": "SELECT household_id, hour_ts, count(DISTINCT ts) AS n FROM aw GROUP BY ALL",
    "ao": """SELECT household_id, entity_id AS device, last_updated_ts AS ts, date_trunc('hour', last_updated_ts) AS hour_ts
      FROM st WHERE state = 'on'""",
    "ao_n": "SELECT household_id, hour_ts, count(DISTINCT ts) AS n FROM ao GROUP BY ALL",
    "am": """SELECT household_id, device, hour_ts, sum(v) / any_value(n) AS m FROM aw JOIN aw_n USING (household_id, hour_ts) GROUP BY ALL
      UNION ALL SELECT household_id, device, hour_ts, count(*) / any_value(n) AS m FROM ao JOIN ao_n USING (household_id, hour_ts) GROUP BY ALL""",
    "act_span": "SELECT household_id, min(hour_ts) AS h0, max(hour_ts) AS h1 FROM am GROUP BY ALL",
    "act_grid": f"SELECT household_id, unnest(generate_series(h0, {padded_end('h1')}, INTERVAL 1 HOUR)) AS hour_ts FROM act_span",
    "ahm": """SELECT g.household_id, d.device, g.hour_ts, coalesce(m.m, 0) AS value FROM act_grid g
      CROSS JOIN (SELECT unnest(['purchase','signup','view','click','error']) AS device) d
      LEFT JOIN am m ON m.household_id = g.household_id AND m.device = d.device AND m.hour_ts = g.hour_ts""",
    "act": """SELECT household_id, hour_ts, max(CASE WHEN value >= 30 THEN 1 ELSE 0 END) AS activity FROM ahm GROUP BY ALL""",
    "actf": """SELECT *, CAST(hour(hour_ts) AS INTEGER) AS hour, lag(activity, 24) OVER w AS activity_lag_24,
      lag(activity, 48) OVER w AS activity_lag_48, lag(activity, 72) OVER w AS activity_lag_72
      FROM act WINDOW w AS (PARTITION BY household_id ORDER BY hour_ts)""",
    "ud": """SELECT household_id, device, CAST(hour_ts AS DATE) AS day, max(usage) AS usage FROM ldp GROUP BY ALL""",
    "uda": "SELECT household_id, day, max(usage) AS activity FROM ud GROUP BY ALL",
    "us": """SELECT household_id, device, day, usage, activity,
      CAST(CASE WHEN row_number() OVER w > 1 THEN coalesce(row_number() OVER w - last_value(CASE WHEN activity <> 0 THEN rn END IGNORE NULLS) OVER b, row_number() OVER w) END AS INTEGER) AS periods_since_last_activity,
      CAST(CASE WHEN row_number() OVER w > 1 THEN coalesce(row_number() OVER w - last_value(CASE WHEN usage <> 0 THEN rn END IGNORE NULLS) OVER b, row_number() OVER w) END AS INTEGER) AS periods_since_last_usage,
      lag(activity, 1) OVER w AS activity_lag_1, lag(activity, 2) OVER w AS activity_lag_2, lag(activity, 3) OVER w AS activity_lag_3,
      lag(usage, 1) OVER w AS usage_lag_1, lag(usage, 2) OVER w AS usage_lag_2, lag(usage, 3) OVER w AS usage_lag_3,
      CASE WHEN lag(activity, 1) OVER w = 1 OR lag(activity, 2) OVER w = 1 THEN 1 ELSE 0 END AS active_last_2_days
      FROM (SELECT *, row_number() OVER (PARTITION BY household_id, device ORDER BY day) AS rn FROM ud JOIN uda USING (household_id, day))
      WINDOW w AS (PARTITION BY household_id, device ORDER BY day),
        b AS (PARTITION BY household_id, device ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    # runs: all hours (run) and without an incomplete first day (runc)
    "run": runs_sql("ldp"),
    "ldc": """SELECT l.* FROM ldp l JOIN ld_first f USING (household_id, device)
      WHERE f.n >= 24 OR CAST(l.hour_ts AS DATE) > f.d""",
    "ld_first": """SELECT household_id, device, d, n FROM (SELECT household_id, device, CAST(hour_ts AS DATE) AS d, count(*) AS n,
      row_number() OVER (PARTITION BY household_id, device ORDER BY CAST(hour_ts AS DATE)) AS r FROM ldp GROUP BY household_id, device, CAST(hour_ts AS DATE)) WHERE r = 1""",
    "runc": runs_sql("ldc"),
    "prof_day": "SELECT DISTINCT household_id, device, CAST(hour_ts AS DATE) AS date FROM ldc",
    "prof_n": """SELECT d.household_id, d.device, d.date, CAST(count(DISTINCT r.run_start) AS INTEGER) AS n_runs FROM prof_day d
      LEFT JOIN runc r ON r.household_id = d.household_id AND r.device = d.device AND CAST(r.run_start AS DATE) < d.date GROUP BY ALL""",
    "prof_s": """SELECT d.household_id, d.device, d.date, r.offs, sum(r.load) AS s FROM prof_day d
      JOIN runc r ON r.household_id = d.household_id AND r.device = d.device AND CAST(r.hour_ts AS DATE) < d.date GROUP BY ALL""",
    "prof": """SELECT n.household_id, n.device, n.date, n.n_runs, o.offs, coalesce(s.s / n.n_runs, 0) AS load FROM prof_n n
      CROSS JOIN (SELECT CAST(unnest(range(24)) AS INTEGER) AS offs) o LEFT JOIN prof_s s
      ON s.household_id = n.household_id AND s.device = n.device AND s.date = n.date AND s.offs = o.offs""",
    "pr": """SELECT 'Z1' AS zone, date_trunc('hour', ts) AS hour, avg(value) - 5 AS price
      FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "pg": """SELECT 'Z1' AS zone, unnest(generate_series((SELECT min(hour) FROM pr),
      (SELECT date_trunc('day', max(hour)) + INTERVAL 71 HOUR FROM pr), INTERVAL 1 HOUR)) AS hour""",
    "pf": """SELECT g.zone, g.hour, coalesce(a.price, b.price, c.price) AS price FROM pg g LEFT JOIN pr a ON a.hour = g.hour
      LEFT JOIN pr b ON b.hour = g.hour - INTERVAL 24 HOUR LEFT JOIN pr c ON c.hour = g.hour - INTERVAL 48 HOUR""",
    "dates": f"SELECT CAST(unnest(generate_series({FIRST}, {LAST}, INTERVAL 1 DAY)) AS DATE) AS date",
    "hz": """SELECT d.date, o.offs, p.price FROM dates d CROSS JOIN (SELECT CAST(unnest(range(48)) AS INTEGER) AS offs) o
      LEFT JOIN pf p ON p.hour = CAST(d.date + 1 AS TIMESTAMP) + o.offs * INTERVAL 1 HOUR""",
    "cost": """SELECT p.household_id, p.device, p.date, CAST(z.offs - p.offs AS INTEGER) AS hour,
      CASE WHEN count(z.price) = 24 THEN sum(z.price * p.load) / 1e6 END AS cost
      FROM prof p JOIN hz z ON z.date = p.date AND z.offs >= p.offs AND z.offs - p.offs < 24 GROUP BY ALL""",
    # activity: share of active days per hour in the training set of each date
    "ar0": """SELECT household_id, CAST(hour_ts AS DATE) AS date, CAST(hour(hour_ts) AS INTEGER) AS hour, activity,
      min(CAST(hour_ts AS DATE)) OVER (PARTITION BY household_id) + 3 AS start FROM act""",
    "ar": """SELECT household_id, date, hour, activity AS truth, start,
      sum(CASE WHEN date >= start THEN activity ELSE 0 END) OVER w AS n_pos, sum(CASE WHEN date >= start THEN 1 - activity ELSE 0 END) OVER w AS n_neg,
      n_pos / nullif(n_pos + n_neg, 0) AS p, lead(activity) OVER w AS y, lead(date) OVER w AS target_date
      FROM ar0 WINDOW w AS (PARTITION BY household_id, hour ORDER BY date)""",
    # usage: share of used days per feature cell
    "uc": """SELECT household_id, device, day AS date, usage, coalesce(usage_lag_1, 0) * 4 + coalesce(usage_lag_2, 0) * 2 + active_last_2_days AS cell,
      day >= min(day) OVER (PARTITION BY household_id, device) + 3 AS ok FROM us""",
    "ucell": """SELECT d.household_id, d.device, d.date, t.cell, count(*) AS n, sum(t.usage) AS pos FROM uc d
      JOIN uc t ON t.household_id = d.household_id AND t.device = d.device AND t.ok AND t.date <= d.date GROUP BY ALL""",
    "uall": "SELECT household_id, device, date, sum(n) AS n, sum(pos) AS pos FROM ucell GROUP BY ALL",
    "ur": """SELECT a.household_id, a.device, a.date, x.date AS target_date, x.cell AS next_cell, x.usage AS y,
      coalesce(c.pos / c.n, a.pos / a.n) AS p FROM uall a
      JOIN uc x ON x.household_id = a.household_id AND x.device = a.device AND x.date = a.date + 1
      LEFT JOIN ucell c ON c.household_id = a.household_id AND c.device = a.device AND c.date = a.date AND c.cell = x.cell""",
    # recommendations for one threshold pair, and the back-test for all pairs
    "athr": "SELECT unnest(range(1, 8)) / 8 AS a",
    "uthr": "SELECT unnest(range(1, 8)) / 8 AS u",
    "best": """SELECT c.household_id, c.device, c.date, t.a,
      coalesce(arg_min(c.hour, (round(c.cost, 9), c.hour)) FILTER (c.cost IS NOT NULL AND r.p >= t.a),
               arg_min(c.hour, (round(c.cost, 9), c.hour)) FILTER (c.cost IS NOT NULL)) AS best_launch_hour,
      CASE WHEN count(r.p) > 0 THEN CASE WHEN max(r.p) >= max(t.a) THEN 0 ELSE 1 END END AS flag_a
      FROM cost c CROSS JOIN (SELECT a FROM athr UNION SELECT 0.15) t
      LEFT JOIN ar r ON r.household_id = c.household_id AND r.date = c.date AND r.hour = c.hour AND r.target_date IS NOT NULL GROUP BY c.household_id, c.device, c.date, t.a""",
    "name": """SELECT household_id, entity_id AS device, arg_max(upper(entity_id[1]) || entity_id[2:] || ' plug ' || (k % 2), last_updated_ts) AS friendly_name
      FROM st WHERE entity_id IN ('purchase','signup') AND last_updated_ts > CAST((SELECT d1 - 29 FROM span) AS TIMESTAMP) GROUP BY ALL""",
    "rec1": """SELECT b.household_id, b.device, b.date, n.friendly_name, b.best_launch_hour, b.flag_a,
      CASE WHEN u.p IS NOT NULL THEN CASE WHEN u.p < 0.5 THEN 1 ELSE 0 END END AS flag_u,
      CASE WHEN b.flag_a = 0 AND u.p >= 0.5 THEN b.best_launch_hour END AS recommendation,
      CASE WHEN b.best_launch_hour IS NULL THEN 'no price' WHEN b.flag_a IS NULL THEN 'no activity prediction'
           WHEN u.p IS NULL THEN 'no usage prediction' END AS error
      FROM best b LEFT JOIN ur u ON u.household_id = b.household_id AND u.device = b.device AND u.date = b.date
      LEFT JOIN name n ON n.household_id = b.household_id AND n.device = b.device WHERE b.a = 0.15""",
    "recg": """SELECT b.household_id, b.device, b.date, b.a, t.u, b.best_launch_hour,
      CASE WHEN b.flag_a = 0 AND u.p >= t.u THEN b.best_launch_hour END AS rec
      FROM best b CROSS JOIN uthr t LEFT JOIN ur u ON u.household_id = b.household_id AND u.device = b.device AND u.date = b.date
      WHERE b.a <> 0.15""",
    "rstart": "SELECT household_id, device, CAST(run_start AS DATE) - 1 AS date, CAST(hour(run_start) AS INTEGER) AS start_hour, run_start FROM run WHERE offs = 0",
    "near": """SELECT g.household_id, g.device, g.date, g.a, g.u, arg_min(s.start_hour, (coalesce(abs(s.start_hour - g.rec), 0), s.start_hour)) AS relevant_start
      FROM recg g JOIN rstart s ON s.household_id = g.household_id AND s.device = g.device AND s.date = g.date GROUP BY ALL""",
    # cost of the relevant run at every launch hour of the day
    "rcost": """SELECT s.household_id, s.device, s.date, s.start_hour, CAST(z.offs - r.offs AS INTEGER) AS hour, sum(coalesce(z.price * r.load, 0)) AS cost
      FROM rstart s JOIN run r ON r.household_id = s.household_id AND r.device = s.device AND r.run_start = s.run_start
      JOIN hz z ON z.date = s.date AND z.offs >= r.offs AND z.offs - r.offs < 24 GROUP BY ALL""",
    "bt": """SELECT *, no_rec - with_rec AS savings, (no_rec - with_rec) / nullif(no_rec, 0) AS relative_savings FROM (
      SELECT g.household_id, g.device, g.date, g.a, g.u, g.rec, CAST(u.usage * x.activity AS INTEGER) AS acceptable, n.relevant_start,
      c0.cost AS no_rec, CASE WHEN g.rec IS NULL THEN NULL WHEN n.relevant_start IS NULL THEN 0 ELSE c1.cost END AS with_rec
      FROM recg g LEFT JOIN us u ON u.household_id = g.household_id AND u.device = g.device AND u.day = g.date + 1
      LEFT JOIN act x ON x.household_id = g.household_id AND x.hour_ts = CAST(g.date + 1 AS TIMESTAMP) + g.rec * INTERVAL 1 HOUR
      LEFT JOIN near n ON n.household_id = g.household_id AND n.device = g.device AND n.date = g.date AND n.a = g.a AND n.u = g.u
      LEFT JOIN rcost c0 ON c0.household_id = g.household_id AND c0.device = g.device AND c0.date = g.date AND c0.start_hour = n.relevant_start AND c0.hour = n.relevant_start
      LEFT JOIN rcost c1 ON c1.household_id = g.household_id AND c1.device = g.device AND c1.date = g.date AND c1.start_hour = n.relevant_start AND c1.hour = g.rec)""",
    "summ": """SELECT household_id, a, u, count(rec) AS n_recommendations, avg(acceptable) AS acceptable,
      coalesce(sum(acceptable * savings), 0) AS total_savings, avg(relative_savings) AS relative_savings_mean,
      quantile_cont(relative_savings, 0.5) AS relative_savings_median FROM bt GROUP BY ALL""",
    "urate": """SELECT a.household_id, a.device, a.date, k.cell, coalesce(c.pos / c.n, a.pos / a.n) AS p, coalesce(c.n, 0) AS n, coalesce(c.pos, 0) AS pos
      FROM uall a CROSS JOIN (SELECT unnest(range(8)) AS cell) k
      LEFT JOIN ucell c ON c.household_id = a.household_id AND c.device = a.device AND c.date = a.date AND c.cell = k.cell""",
    # Shapley values of the three usage bits: value of each coalition, then weighted differences
    "sv": """SELECT x.household_id, x.device, x.date, x.y, x.p, x.next_cell, m.m, sum(b.n * r.p) / sum(b.n) AS v FROM ur x CROSS JOIN (SELECT unnest(range(8)) AS m) m
      JOIN ucell b ON b.household_id = x.household_id AND b.device = x.device AND b.date = x.date
      JOIN urate r ON r.household_id = x.household_id AND r.device = x.device AND r.date = x.date AND r.cell = ((x.next_cell & m.m) | (b.cell & (7 - m.m))) GROUP BY ALL""",
    "svw": """SELECT household_id, device, date, any_value(y) AS y, any_value(p) AS p, any_value(next_cell) AS next_cell,
      max(v) FILTER (m = 0) AS v0, max(v) FILTER (m = 1) AS v1, max(v) FILTER (m = 2) AS v2, max(v) FILTER (m = 3) AS v3,
      max(v) FILTER (m = 4) AS v4, max(v) FILTER (m = 5) AS v5, max(v) FILTER (m = 6) AS v6, max(v) FILTER (m = 7) AS v7 FROM sv GROUP BY household_id, device, date""",
    "shap": """SELECT household_id, device, date, y, p, next_cell, v0,
      (v4 - v0) / 3 + (v5 - v1) / 6 + (v6 - v2) / 6 + (v7 - v3) / 3 AS f1,
      (v2 - v0) / 3 + (v3 - v1) / 6 + (v6 - v4) / 6 + (v7 - v5) / 3 AS f2,
      (v1 - v0) / 3 + (v3 - v2) / 6 + (v5 - v4) / 6 + (v7 - v6) / 3 AS f3 FROM svw""",
    # runs against the profile of their day
    "truth": """SELECT r.household_id, r.device, r.run_start, o.offs, max(CASE WHEN r.offs = o.offs THEN r.load ELSE 0 END) AS y FROM run r
      CROSS JOIN (SELECT unnest(range(24)) AS offs) o GROUP BY ALL""",
    "gap": """SELECT t.*, coalesce(p.load, 0) AS yh FROM truth t LEFT JOIN prof p ON p.household_id = t.household_id AND p.device = t.device
      AND p.date = CAST(t.run_start AS DATE) AND p.offs = t.offs""",
    "mse": "SELECT household_id, device, run_start, avg((y - yh) * (y - yh)) AS error FROM gap GROUP BY ALL",
    # cold start
    "csa": """SELECT household_id, date, p, sum(w.n_pos) AS n_pos, sum(w.n_neg) AS n_neg FROM ar
      JOIN (SELECT household_id, hour, sum(truth) AS n_pos, sum(1 - truth) AS n_neg FROM ar WHERE date >= start AND date <= (SELECT d1 FROM span) GROUP BY ALL) w
      USING (household_id, hour) WHERE date >= start AND date < (SELECT d1 FROM span) GROUP BY ALL""",
    "csu": """SELECT r.household_id, r.device, r.date, r.p, sum(w.pos) AS n_pos, sum(w.n - w.pos) AS n_neg FROM urate r
      JOIN (SELECT household_id, device, cell, n, pos FROM ucell WHERE date = (SELECT d1 FROM span)) w USING (household_id, device, cell)
      WHERE r.date < (SELECT d1 FROM span) GROUP BY ALL""",
    "csl": """SELECT p.household_id, p.device, p.date, avg((p.load - l.load) * (p.load - l.load)) AS score FROM prof p
      JOIN (SELECT household_id, device, offs, arg_max(load, date) AS load FROM prof WHERE date <= (SELECT d1 FROM span) GROUP BY ALL) l USING (household_id, device, offs)
      WHERE p.date <= (SELECT d1 FROM span) GROUP BY ALL""",
    "cs": """SELECT household_id, 'activity' AS agent, date, auc AS score FROM csa_auc
      UNION ALL SELECT household_id, 'usage_' || device, date, auc FROM csu_auc
      UNION ALL SELECT household_id, 'load_' || device, date, score FROM csl""",
    "csa_auc": auc_sql("csa", "household_id, date"),
    "csu_auc": auc_sql("csu", "household_id, device, date"),
    "csg": """SELECT g.household_id, g.date, a.agent, c.score, CAST(dense_rank() OVER (PARTITION BY g.household_id ORDER BY g.date) AS INTEGER) AS d
      FROM (SELECT DISTINCT household_id, date FROM cs) g
      CROSS JOIN (SELECT unnest(['activity','usage_purchase','usage_signup','load_purchase','load_signup']) AS agent) a
      LEFT JOIN cs c ON c.household_id = g.household_id AND c.date = g.date AND c.agent = a.agent""",
    "csb": "SELECT *, max(score) OVER (PARTITION BY household_id, agent) AS best FROM csg",
    "csd": """SELECT household_id, t AS tolerance, agent, CAST(coalesce(max(d) FILTER (NOT coalesce(
        CASE WHEN agent LIKE 'load%' THEN score < t ELSE score > best * (1 - t) END, false)), 0) + 1 AS INTEGER) AS days
      FROM csb CROSS JOIN (SELECT CAST(unnest([0.05, 0.10, 0.15, 0.20, 0.25]) AS DOUBLE) AS t) GROUP BY ALL""",
    "csf": "SELECT * FROM csd UNION ALL SELECT household_id, tolerance, 'framework', max(days) FROM csd GROUP BY ALL",
    "csl_max": """SELECT p.household_id, p.device, p.date, max(abs(p.load - l.load)) AS score FROM prof p
      JOIN (SELECT household_id, device, offs, arg_max(load, date) AS load FROM prof WHERE date <= (SELECT d1 FROM span) GROUP BY ALL) l USING (household_id, device, offs)
      WHERE p.date <= (SELECT d1 FROM span) GROUP BY ALL""",
    # walk-forward scores
    "wa_test": """SELECT household_id, p, sum(y) AS n_pos, sum(1 - y) AS n_neg FROM ar WHERE p IS NOT NULL AND y IS NOT NULL
      AND date BETWEEN (SELECT d0 + 7 FROM span) AND (SELECT d1 - 2 FROM span) GROUP BY ALL""",
    "wa_train": """SELECT household_id, date, p, sum(n_pos) AS n_pos, sum(n_neg) AS n_neg FROM ar WHERE p IS NOT NULL
      AND date BETWEEN (SELECT d0 + 7 FROM span) AND (SELECT d1 - 2 FROM span) GROUP BY ALL""",
    "wa_test_auc": auc_sql("wa_test", "household_id"),
    "wa_train_auc": auc_sql("wa_train", "household_id, date"),
    "wa": """SELECT household_id, a.auc_train, t.auc AS auc_test, a.n_dates, t.n AS n_test FROM wa_test_auc t
      JOIN (SELECT household_id, avg(auc) AS auc_train, count(auc) AS n_dates FROM wa_train_auc GROUP BY ALL) a USING (household_id)""",
    "wu_test": """SELECT household_id, device, p, sum(y) AS n_pos, sum(1 - y) AS n_neg FROM ur
      WHERE date > (SELECT d0 + 7 FROM span) AND date < (SELECT d1 - 2 FROM span) GROUP BY ALL""",
    "wu_train": """SELECT household_id, device, date, p, sum(pos) AS n_pos, sum(n - pos) AS n_neg FROM urate
      WHERE n > 0 AND date > (SELECT d0 + 7 FROM span) AND date < (SELECT d1 - 2 FROM span) GROUP BY ALL""",
    "wu_test_auc": auc_sql("wu_test", "household_id, device"),
    "wu_train_auc": auc_sql("wu_train", "household_id, device, date"),
    "wu": """SELECT household_id, device, a.auc_train, t.auc AS auc_test, a.n_dates, t.n AS n_test FROM wu_test_auc t
      JOIN (SELECT household_id, device, avg(auc) AS auc_train, count(auc) AS n_dates FROM wu_train_auc GROUP BY ALL) a USING (household_id, device)""",
    "agents": """SELECT household_id, 'activity_auc' AS agent, '-' AS device, auc_test AS score FROM wa
      UNION ALL SELECT household_id, 'usage_auc', device, auc_test FROM wu
      UNION ALL SELECT household_id, 'load_mse', device, avg(error) FROM mse GROUP BY household_id, device""",
    # nearest neighbours: all pairs of a test row and the training rows of its date
    "ku": """SELECT household_id, device, day, usage, usage_lag_1 AS a, usage_lag_2 AS b, active_last_2_days AS c,
      day >= min(day) OVER (PARTITION BY household_id, device) + 3 AS ok FROM us""",
    "ku_nn": """SELECT t.household_id, t.device, t.day, t.usage AS y, r.usage,
      row_number() OVER (PARTITION BY t.household_id, t.device, t.day ORDER BY pow(t.a - r.a, 2) + pow(t.b - r.b, 2) + pow(t.c - r.c, 2), r.day DESC) AS k,
      count(r.usage) OVER g AS n, min(r.usage) OVER g AS lo, max(r.usage) OVER g AS hi
      FROM ku t LEFT JOIN ku r ON r.household_id = t.household_id AND r.device = t.device AND r.ok AND r.day < t.day
      WHERE t.day - 1 BETWEEN (SELECT d0 + 4 FROM span) AND (SELECT d1 - 1 FROM span) WINDOW g AS (PARTITION BY t.household_id, t.device, t.day)""",
    "ku_p": """SELECT household_id, device, day, any_value(y) AS y, CASE WHEN any_value(error) IS NULL THEN avg(usage) END AS p, any_value(error) AS error
      FROM (SELECT *, CASE WHEN n = 0 THEN 'no training rows' WHEN lo = hi THEN 'one class in the training rows' WHEN n < 10 THEN 'fewer training rows than neighbours' END AS error FROM ku_nn) WHERE k <= 10 GROUP BY household_id, device, day""",
    "ka": """SELECT household_id, hour_ts, CAST(hour_ts AS DATE) AS day, activity, hour, isodow(hour_ts) AS wd,
      coalesce(activity_lag_24, 0) AS a, coalesce(activity_lag_48, 0) AS b, coalesce(activity_lag_72, 0) AS c,
      CAST(hour_ts AS DATE) >= min(CAST(hour_ts AS DATE)) OVER (PARTITION BY household_id) + 3 AS ok FROM actf""",
    "ka_nn": """SELECT t.household_id, t.hour_ts, t.day, t.activity AS y, r.activity,
      row_number() OVER (PARTITION BY t.household_id, t.hour_ts ORDER BY (t.hour - r.hour) * (t.hour - r.hour)
        + CASE WHEN t.wd = r.wd THEN 0 WHEN t.wd = 5 OR r.wd = 5 THEN 1 ELSE 2 END
        + abs(t.a - r.a) + abs(t.b - r.b) + abs(t.c - r.c), r.hour_ts DESC) AS k,
      count(r.activity) OVER g AS n, min(r.activity) OVER g AS lo, max(r.activity) OVER g AS hi
      FROM ka t LEFT JOIN ka r ON r.household_id = t.household_id AND r.ok AND r.day < t.day
      WHERE t.day - 1 BETWEEN (SELECT d0 + 4 FROM span) AND (SELECT d1 - 1 FROM span) WINDOW g AS (PARTITION BY t.household_id, t.hour_ts)""",
    "ka_p": """SELECT household_id, hour_ts, day, any_value(y) AS y, CASE WHEN any_value(error) IS NULL THEN avg(activity) END AS p, any_value(error) AS error
      FROM (SELECT *, CASE WHEN n = 0 THEN 'no training rows' WHEN lo = hi THEN 'one class in the training rows' WHEN n < 10 THEN 'fewer training rows than neighbours' END AS error FROM ka_nn) WHERE k <= 10 GROUP BY household_id, hour_ts, day""",
    # weather imputation: all pairs of an hour with a gap and the hours that have the value
    "wl": "SELECT time, unnest(['temp','dwpt','rhum','wdir','wspd']) AS c, unnest([temp, dwpt, rhum, wdir, wspd]) AS v FROM we",
    "wg": "SELECT time FROM wl GROUP BY time HAVING count(v) < 5",
    "wd": """SELECT a.time AS t, b.time AS u, sqrt(sum((a.v - b.v) * (a.v - b.v)) * 5 / count(*)) AS d FROM wl a JOIN wg ON wg.time = a.time
      JOIN wl b ON b.c = a.c AND b.time <> a.time WHERE a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY a.time, b.time""",
    "wn": """SELECT a.time, a.c, b.v, wd.d, row_number() OVER (PARTITION BY a.time, a.c ORDER BY wd.d, b.time) AS k FROM wl a
      JOIN wd ON wd.t = a.time JOIN wl b ON b.time = wd.u AND b.c = a.c WHERE a.v IS NULL AND b.v IS NOT NULL""",
    "wi": """SELECT l.time, l.c, coalesce(l.v, n.v, (SELECT avg(v) FROM wl m WHERE m.c = l.c)) AS v FROM wl l
      LEFT JOIN (SELECT time, c, CASE WHEN min(d) = 0 THEN avg(v) FILTER (d = 0) ELSE sum(v / d) / sum(1 / d) END AS v FROM wn WHERE k <= 7 GROUP BY ALL) n
      ON n.time = l.time AND n.c = l.c""",
    "we": """SELECT 'W1' AS station, date_trunc('hour', ts) AS time,
      avg(value) FILTER (event_type = 'click') AS temp, avg(value) FILTER (event_type = 'error') AS dwpt,
      avg(value) FILTER (event_type = 'purchase') AS rhum, avg(value) FILTER (event_type = 'signup') AS wdir,
      avg(value) FILTER (event_type = 'view') AS wspd FROM events GROUP BY ALL""",
}


def with_(body: str, **extra: str) -> str:
    """Prefix ``body`` with the parts it uses, directly or through other parts."""
    parts = {**PARTS, **extra}
    used: list[str] = []

    def visit(text: str, own: str | None = None) -> None:
        for name in parts:
            if name != own and name not in used and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(parts[name], name)
                if name not in used:
                    used.append(name)

    visit(body)
    if not used:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in used) + "\n" + body
