"""Hand-written DuckDB oracles for the generic operator queries."""

from __future__ import annotations

from oracle.duck_models import AS_OF, half_up_avg, half_up_pct

D = "DECIMAL(18,4)"


def _cal(d: str) -> str:
    return (f"CAST(date_trunc('week', {d}) AS DATE) AS week_start, CAST(date_trunc('month', {d}) AS DATE) AS month_start, "
            f"CAST(date_trunc('quarter', {d}) AS DATE) AS quarter_start, CAST(date_trunc('year', {d}) AS DATE) AS year_start, "
            f"year({d}) AS year, quarter({d}) AS quarter, month({d}) AS month, strftime({d}, '%Y-%m') AS year_month, "
            f"day({d}) AS day_of_month, isodow({d}) AS day_of_week, strftime({d}, '%a') AS day_name, "
            f"isodow({d}) IN (6, 7) AS is_weekend, {d} = last_day({d}) AS is_month_end")


_JN01 = f"""SELECT n.n_name, count(*) AS n_orders, sum(CAST(o.o_totalprice AS {D})) AS revenue
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name"""

_FP = "SELECT user_id, min(ts) AS fp FROM events WHERE event_type = 'purchase' GROUP BY user_id"

GENERIC_ORACLE: dict[str, str] = {
    "src20_date_spine": f"""
WITH r AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day FROM r)
SELECT date_day, {_cal('date_day')} FROM d""",

    "prj_select_cast": f"""
SELECT *, status = 'F' AS is_filled, priority LIKE '1-%' AS is_urgent FROM (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
    CAST(o_totalprice AS {D}) AS total_price, CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS priority
  FROM orders) t""",

    "flt_eq_in_null": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, l_linestatus, l_shipdate FROM lineitem
WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'R') AND l_shipdate IS NOT NULL
  AND l_quantity NOT IN (1.0, 2.0, 3.0) AND NOT (l_discount > 0.09)""",

    "flt05_distinct_from": """
SELECT o.o_orderstatus, count(*) AS n_orders FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE (CASE WHEN o.o_orderpriority LIKE '1%' THEN 'BUILDING' END)
      IS DISTINCT FROM (CASE WHEN c.c_acctbal > 0 THEN c.c_mktsegment END)
GROUP BY o.o_orderstatus""",

    "flt06_like_ilike": """
SELECT p_partkey, CASE WHEN p_name ILIKE '%GREEN%' THEN 'green'
  WHEN p_type ILIKE 'promo%' OR p_type ILIKE '%polished%' THEN 'promo_or_polished'
  WHEN p_brand LIKE 'Brand#1_' THEN 'brand_1x' ELSE 'other' END AS bucket
FROM part""",

    "flt08_not_and_time": f"""
SELECT l.l_returnflag, l.l_linestatus, count(*) AS n_lines, sum(CAST(l.l_quantity AS {D})) AS sum_qty
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE NOT ((CASE WHEN l.l_returnflag = 'R' THEN TRUE WHEN l.l_returnflag = 'A' THEN NULL ELSE FALSE END)
           AND l.l_shipdate >= o.o_orderdate + INTERVAL 90 DAY)
GROUP BY 1, 2""",

    "jn01_inner": _JN01,

    "jn03_left": f"""
SELECT c.c_custkey, c.c_name, coalesce(a.n_orders, 0) AS n_orders, coalesce(a.order_total, 0) AS order_total
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(CAST(o_totalprice AS {D})) AS order_total
                           FROM orders GROUP BY o_custkey) a ON a.o_custkey = c.c_custkey""",

    "jn02_spine": """
WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS date_day FROM daily)
SELECT s.date_day, CAST(date_trunc('week', s.date_day) AS DATE) AS week_start, d.n_orders
FROM daily d JOIN spine s ON s.date_day = d.d""",

    "jn04_full_outer": """
WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus AS status, count(*) AS n
           FROM orders GROUP BY 1, 2),
l AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_linestatus AS status, count(*) AS n
      FROM lineitem GROUP BY 1, 2)
SELECT coalesce(o.month, l.month) AS month, coalesce(o.status, l.status) AS status,
  coalesce(o.n, 0) AS n_orders, coalesce(l.n, 0) AS n_lines
FROM o FULL OUTER JOIN l ON l.month = o.month AND l.status = o.status""",

    "jn05_full_outer_chain": """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
l AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1),
e AS (SELECT CAST(ts AS DATE) - 10000 AS day, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(o.day, l.day, e.day) AS day, coalesce(o.n, 0) AS n_orders, coalesce(l.n, 0) AS n_lines,
  coalesce(e.n, 0) AS n_events
FROM o FULL OUTER JOIN l ON l.day = o.day FULL OUTER JOIN e ON e.day = coalesce(o.day, l.day)""",

    "jn06_range_residual": """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, f.first_order_at
FROM orders o JOIN (SELECT o_custkey, min(o_orderdate) AS first_order_at FROM orders GROUP BY 1) f
  ON f.o_custkey = o.o_custkey AND o.o_orderdate > f.first_order_at""",

    "jn07_asof_backward": f"""
WITH fp AS ({_FP})
SELECT DISTINCT ON (fp.user_id) fp.user_id, v.event_id AS last_view_event_id
FROM fp JOIN events v ON v.user_id = fp.user_id AND v.event_type = 'view' AND v.ts < fp.fp
ORDER BY fp.user_id, v.ts DESC, v.event_id DESC""",

    "jn07_asof_scan": """
WITH v AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY user_id, ts),
e AS (SELECT user_id, ts, min(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY user_id, ts),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
pv AS (SELECT p.*, v.event_id AS last_view_event_id FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts > v.ts)
SELECT pv.event_id, pv.user_id, last_view_event_id, e.event_id AS first_error_event_id
FROM pv ASOF LEFT JOIN e ON pv.user_id = e.user_id AND pv.ts <= e.ts""",

    "jn07_asof_forward": f"""
WITH fp AS ({_FP})
SELECT DISTINCT ON (fp.user_id) fp.user_id, v.event_id AS first_error_event_id
FROM fp JOIN events v ON v.user_id = fp.user_id AND v.event_type = 'error' AND v.ts >= fp.fp
ORDER BY fp.user_id, v.ts ASC, v.event_id ASC""",

    "jn08_existence_flag": """
SELECT c.c_custkey, u.o_custkey IS NOT NULL AS has_urgent_order
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') u
  ON u.o_custkey = c.c_custkey""",

    "jn_left_null_keys": """
SELECT e.event_id, e.k, c.c_name
FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN user_id END AS k FROM events) e
LEFT JOIN customer c ON c.c_custkey = e.k""",

    "agg01_group_by": f"""
SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS {D})) AS sum_qty,
  sum(CAST(l_extendedprice AS {D})) AS sum_base_price, count(*) AS count_order, count(l_shipdate) AS count_shipped
FROM lineitem GROUP BY 1, 2""",

    "agg03_count_distinct": """
SELECT user_id, count(DISTINCT event_type) AS n_event_types, count(DISTINCT CAST(ts AS DATE)) AS n_active_days
FROM events GROUP BY 1""",

    "agg03_distinct_bitmaps": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(DISTINCT o_custkey) AS n_customers,
  count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS n_finished,
  count(DISTINCT o_custkey) FILTER (o_orderpriority = '1-URGENT') AS n_urgent
FROM orders GROUP BY 1""",

    "agg04_sum_flags": f"""
SELECT l_partkey, sum(CAST(l_quantity AS {D})) AS qty, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned
FROM lineitem GROUP BY 1""",

    "agg05_avg": f"""
SELECT l_suppkey, {half_up_avg(f'CAST(l_quantity AS {D})')} AS avg_qty,
  {half_up_avg(f'CAST(l_extendedprice AS {D})')} AS avg_price
FROM lineitem GROUP BY 1""",

    "agg06_min_max": f"""
SELECT user_id, min(ts) AS first_at, max(ts) AS last_at, min(CAST(value AS {D})) AS min_value,
  max(CAST(value AS {D})) AS max_value
FROM events GROUP BY 1""",

    "agg07_filter": f"""
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks,
  sum(CAST(value AS {D})) FILTER (WHERE event_type = 'purchase') AS purchase_value,
  min(ts) FILTER (WHERE event_type = 'error') AS first_error_at
FROM events GROUP BY 1""",

    "agg08_case_agg": f"""
SELECT o_orderstatus, count(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 END) AS high_priority,
  sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS {D}) END) AS low_priority_total
FROM orders GROUP BY 1""",

    "agg09_bool_or": """
SELECT user_id, bool_or(event_type = 'error') AS had_error, bool_and(value > 1) AS all_above_one
FROM events GROUP BY 1""",

    "agg10_latest_value": """
SELECT user_id, kind, ts AS latest_at FROM (
  SELECT user_id, ts, CASE WHEN event_type <> 'signup' THEN event_type END AS kind,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
WHERE rn = 1""",

    "agg11_dependent_attr": """
SELECT o.o_custkey, count(*) AS n_orders, max(n.n_name) AS nation
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY 1""",

    "agg12_preagg_join": """
WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
l AS (SELECT o.o_custkey, count(*) AS n FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1),
e AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT c.c_custkey, coalesce(o.n, 0) AS n_orders, coalesce(l.n, 0) AS n_lines, coalesce(e.n, 0) AS n_events
FROM customer c LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN l ON l.o_custkey = c.c_custkey
LEFT JOIN e ON e.user_id = c.c_custkey""",

    "win01_latest_per_key": """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) t WHERE rn = 1""",

    "win02_first_in_month": """
SELECT d AS order_date, count(*) AS new_customers_in_month FROM (
  SELECT CAST(o_orderdate AS DATE) AS d, row_number() OVER (
    PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) t
WHERE rn = 1 GROUP BY 1""",

    "win_earliest_per_key": """
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) t WHERE rn = 1""",

    "srt01_order_nulls_first": f"""
SELECT n_name, revenue, CASE WHEN n_orders > avg(n_orders) OVER () THEN 'large' END AS size_bucket FROM ({_JN01}) r
ORDER BY size_bucket DESC NULLS FIRST, revenue DESC NULLS FIRST, n_name""",

    "set01_union_all": f"""
SELECT day, sum(amount) AS amount, sum(n_lines) AS n_lines FROM (
  SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS {D}) AS amount, 0 AS n_lines FROM orders
  UNION ALL
  SELECT CAST(l_shipdate AS DATE), CAST(0 AS {D}), 1 FROM lineitem) u
GROUP BY day""",

    "sc01_sc04_strings": """
SELECT c_custkey,
  nullif(trim(CASE WHEN c_custkey % 5 <> 0 THEN '  ' || c_name || ' ' ELSE '   ' END), '') AS clean_name,
  upper(trim(lower(c_name))) AS upper_name,
  c_name || ' / ' || (CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END) AS name_and_segment,
  coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END, 'UNKNOWN') AS segment_or_default
FROM customer""",

    "sc06_json_key": """
SELECT event_id, list_contains(json_keys(p), 'k') AS has_k, list_contains(json_keys(p), 'x') AS has_x
FROM (SELECT event_id, CASE WHEN event_type <> 'signup' THEN props END AS p FROM events) t""",

    "sc07_json_text": "SELECT event_id, json_extract_string(props, '$.k') AS k_text FROM events",

    "sc08_date_trunc": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day_start, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start
FROM orders""",

    "sc09_days_between": """
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS days_to_ship
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",

    "sc10_interval_add": """
SELECT o_orderkey,
  CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) + INTERVAL 1 MONTH + INTERVAL 5 HOUR + INTERVAL 5 MINUTE AS snapshot_at,
  o_orderdate + INTERVAL 90 DAY AS plus_90_days
FROM orders""",

    "sc11_utc_to_eastern": """
SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS eastern_at,
  CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS eastern_date, CAST(ts AS DATE) AS utc_date
FROM events""",

    "sc12_instant_to_eastern": """
SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS eastern_at FROM events""",

    "sc13_as_of_age": f"""
SELECT o_orderkey, age_days, CASE WHEN age_days >= 7 THEN 1 ELSE 0 END AS is_mature_d7,
  CASE WHEN age_days >= 30 THEN 1 ELSE 0 END AS is_mature_d30,
  CASE WHEN age_days >= 10000 THEN 1 ELSE 0 END AS is_mature_d10000
FROM (SELECT o_orderkey, {AS_OF} - CAST(o_orderdate AS DATE) AS age_days FROM orders) t""",

    "sc15_seconds_between": """
SELECT user_id, CAST(round(date_diff('microsecond', first_view_at, first_purchase_at) / 1000000.0) AS INTEGER)
  AS seconds_to_purchase
FROM (SELECT user_id, min(ts) FILTER (WHERE event_type = 'view') AS first_view_at,
             min(ts) FILTER (WHERE event_type = 'purchase') AS first_purchase_at
      FROM events GROUP BY 1) t""",

    "sc17_pct": f"""
SELECT p_brand, {half_up_pct('coalesce(returned_qty, 0)', 'total_qty')} AS return_pct, -total_qty AS negated_total
FROM (SELECT p.p_brand, sum(CAST(l.l_quantity AS {D})) FILTER (WHERE l.l_returnflag = 'R') AS returned_qty,
             sum(CAST(l.l_quantity AS {D})) AS total_qty
      FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1) t""",

    "sc19_bool_algebra": """
SELECT o_orderkey, big AS is_big, big AND urgent AS big_and_urgent, big OR urgent AS big_or_urgent,
  NOT big AS not_big, coalesce(big, false) AS is_big_or_false
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice > 100000 END AS big,
             o_orderpriority = '1-URGENT' AS urgent FROM orders) t""",

    "sc_window_flags": """
SELECT l_orderkey, l_linenumber, CASE WHEN d <= 7 THEN 1 ELSE 0 END AS d7, CASE WHEN d <= 30 THEN 1 ELSE 0 END AS d30,
  CASE WHEN d <= 90 THEN 1 ELSE 0 END AS d90
FROM (SELECT l.l_orderkey, l.l_linenumber,
        CAST(CASE WHEN l.l_linenumber <> 3 THEN l.l_shipdate END AS DATE) - CAST(o.o_orderdate AS DATE) AS d
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey) t""",

    "dq01_not_null": "SELECT count(*) AS failures FROM events WHERE event_type = 'signup' OR props IS NULL",

    "dq02_unique": """
SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",

    "dq03_accepted_values": """
SELECT o_orderstatus, count(*) AS failures FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') GROUP BY 1""",

    "dq04_unique_combo": """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
}


def _dq_sql() -> str:
    from kestrel.plans.quality_checks import CHECKS
    from oracle.duck_models import with_chain_many

    def table(model: str) -> str:
        return "src_" + model.split(":", 1)[1] if model.startswith("source:") else model

    parts = []
    for ck in CHECKS:
        t, cols = table(ck.model), ", ".join(f'"{c}"' for c in ck.columns)
        first = f'"{ck.columns[0]}"'
        if ck.kind == "not_null":
            fail = f"SELECT count(*) FROM {t} WHERE {first} IS NULL"
        elif ck.kind == "accepted_values":
            vals = ", ".join("'" + v + "'" for v in ck.values)
            fail = f"SELECT count(*) FROM {t} WHERE {first} IS NOT NULL AND {first} NOT IN ({vals})"
        elif ck.kind == "unique":
            fail = f"SELECT count(*) FROM (SELECT {first} FROM {t} WHERE {first} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) x"
        else:
            fail = f"SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY ALL HAVING count(*) > 1) x"
        parts.append(f"SELECT '{ck.model}' AS model, '{ck.name}' AS test, '{ck.severity}' AS severity, ({fail}) AS failures")
    tables = sorted({table(ck.model) for ck in CHECKS})
    body = "\nUNION ALL\n".join(parts)
    return (f"{with_chain_many(tables)}\nSELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' "
            f"THEN 'warn' ELSE 'fail' END AS status FROM (\n{body}\n) checks")


GENERIC_ORACLE["dq_model_checks"] = _dq_sql()
