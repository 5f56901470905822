"""What each query of the catalogue must return, in SQL over the same tables."""

from __future__ import annotations

EVENTS = """
SELECT user_id, event_id, CAST(ts AS DATE) AS effective_date, event_type,
       CASE WHEN value >= 20 THEN CAST(floor(value / 50) AS BIGINT) END AS band
FROM events"""

# The newest row per customer.
NEWEST = """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority
FROM {rows}
QUALIFY row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

LANDING = NEWEST.format(rows="orders")

REJECTS = """
SELECT * FROM (
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority,
           row_number() OVER (
               PARTITION BY o_custkey
               ORDER BY o_orderdate DESC, o_orderkey DESC) AS _dedup_rank
    FROM orders)
WHERE _dedup_rank > 1"""


def _version_id(key: str, stamp: str) -> str:
    """Length and text of the key, then the moment with its microseconds."""
    return (
        f"md5(length(CAST({key} AS VARCHAR)) || ':' || {key} || '|' ||"
        f" strftime({stamp}, '%Y-%m-%d %H:%M:%S.%f'))"
    )


def _history(rows: str, key: str, date: str, tie: str, check: list[str]) -> str:
    changed = " OR ".join(
        f"{c} IS DISTINCT FROM lag({c}) OVER line" for c in check
    )
    stamp = f"CAST({date} AS TIMESTAMP)"
    return f"""
SELECT * EXCLUDE (_first, _changed),
       {_version_id(key, stamp)} AS dbt_scd_id,
       {stamp} AS dbt_updated_at,
       {stamp} AS dbt_valid_from,
       lead({stamp}) OVER (PARTITION BY {key} ORDER BY {date}) AS dbt_valid_to
FROM (
    SELECT *, lag({date}) OVER line IS NULL AS _first, {changed} AS _changed
    FROM (
        SELECT * FROM ({rows})
        QUALIFY row_number() OVER (
            PARTITION BY {key}, {date} ORDER BY {tie} DESC) = 1)
    WINDOW line AS (PARTITION BY {key} ORDER BY {date}))
WHERE _first OR _changed"""


EVENT_HISTORY = _history(
    EVENTS, "user_id", "effective_date", "event_id", ["event_type", "band"]
)
ORDER_HISTORY = _history(
    "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority"
    " FROM orders",
    "o_custkey",
    "o_orderdate",
    "o_orderkey",
    ["o_orderstatus", "o_orderpriority"],
)

FIRST_LANDING = NEWEST.format(
    rows="(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"
)
SECOND_LANDING = NEWEST.format(
    rows="(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')"
)


def _merge(close_missing: bool) -> str:
    gone = "n.o_custkey IS NULL" if close_missing else "FALSE"
    differs = (
        "(n.o_custkey IS NOT NULL AND (o.o_orderstatus IS DISTINCT FROM"
        " n.o_orderstatus OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority))"
    )
    first, second = "TIMESTAMP '1999-01-01'", "TIMESTAMP '2002-01-01'"
    return f"""
WITH o AS ({FIRST_LANDING}), n AS ({SECOND_LANDING})
SELECT o.*, {_version_id("o.o_custkey", first)} AS dbt_scd_id,
       {first} AS dbt_updated_at, {first} AS dbt_valid_from,
       CASE WHEN {differs} OR {gone} THEN {second} END AS dbt_valid_to,
       CASE WHEN {differs} OR {gone} THEN 'close' ELSE 'keep' END AS change
FROM o LEFT JOIN n ON o.o_custkey = n.o_custkey
UNION ALL
SELECT n.*, {_version_id("n.o_custkey", second)}, {second}, {second}, NULL, 'insert'
FROM n LEFT JOIN o ON o.o_custkey = n.o_custkey
WHERE o.o_custkey IS NULL OR {differs}"""


# An event lies in the window of its own five minutes and in the two before.
HOPPING = """
SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end,
       count(user_id) AS number_of_services
FROM (
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) - i * INTERVAL 5 MINUTE AS window_start,
           user_id
    FROM events CROSS JOIN (VALUES (0), (1), (2)) AS back(i))
WHERE year(window_start) = 2024
GROUP BY window_start"""

# Every instant is joined with the events of its window.
SLIDING = """
SELECT e.ts - INTERVAL 15 MINUTE AS window_start, e.ts AS window_end,
       c.n AS number_of_services
FROM events e JOIN (
    SELECT a.ts, count(b.user_id) AS n
    FROM (SELECT DISTINCT ts FROM events) a
    JOIN events b ON b.ts <= a.ts AND a.ts <= b.ts + INTERVAL 15 MINUTE
    GROUP BY a.ts) c ON c.ts = e.ts"""

# Minutes that hold events; a session starts at one that has none in the nine
# minutes before it.  Events that share a minute have no gap between them.
SESSIONS = """
SELECT d AS station_service_date, session_id_in_day,
       max(CASE WHEN copies > 1 THEN coalesce(gap, 0) ELSE gap END) AS gap_minutes,
       min(first_ts) AS window_start, max(last_ts) AS window_end,
       CAST(sum(known) AS BIGINT) AS number_of_services
FROM (
    SELECT minutes.*, starts.session_id_in_day
    FROM minutes ASOF JOIN starts ON minutes.d = starts.d AND minutes.m >= starts.m)
GROUP BY d, session_id_in_day"""
_MINUTES = """
minutes AS (
    SELECT d, m, copies, known, first_ts, last_ts,
           m - max(m) OVER (PARTITION BY d ORDER BY m ROWS BETWEEN 1 PRECEDING
                            AND 1 PRECEDING) AS gap
    FROM (
        SELECT CAST(ts AS DATE) AS d, CAST(epoch_us(ts) // 60000000 AS BIGINT) AS m,
               count(*) AS copies, count(user_id) AS known,
               min(ts) AS first_ts, max(ts) AS last_ts
        FROM events WHERE hour(ts) >= 6 GROUP BY ALL)),
starts AS (
    SELECT d, m, row_number() OVER (PARTITION BY d ORDER BY m) AS session_id_in_day
    FROM minutes a WHERE NOT EXISTS (
        SELECT 1 FROM minutes b WHERE b.d = a.d AND b.m BETWEEN a.m - 9 AND a.m - 1))"""
SESSIONS = f"WITH {_MINUTES} {SESSIONS}"

NEWEST_AND_LARGEST = """
a AS (SELECT o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
b AS (SELECT o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_totalprice DESC, o_orderkey DESC) = 1)"""

BAGS = f"""
e AS ({EVENTS}),
a AS (SELECT user_id, event_type, band FROM e WHERE effective_date <= DATE '2024-01-15'),
b AS (SELECT user_id, event_type, band FROM e WHERE effective_date > DATE '2024-01-15')"""

SIDES = """
sides AS (
    SELECT user_id, event_type, band,
           count(*) FILTER (side = 'a') AS copies_a,
           count(*) FILTER (side = 'b') AS copies_b
    FROM (SELECT *, 'a' AS side FROM a UNION ALL SELECT *, 'b' FROM b)
    GROUP BY user_id, event_type, band)"""

CUSTOMERS = """
SELECT CAST(c_custkey AS VARCHAR) AS peorgnr,
       CASE WHEN c_acctbal >= 0 THEN c_name END AS foretagsnamn,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' ELSE c_mktsegment END AS namn,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS coadress,
       CAST(c_nationkey AS VARCHAR) AS postort, c_mktsegment AS source_file
FROM customer"""


def _pseudonym(column: str, prefix: str, label: str) -> str:
    number = (
        f"list_reduce([0::BIGINT] || [('0x' || substr(sha256('{prefix}' || peorgnr),"
        " i * 8 + 1, 8))::BIGINT FOR i IN range(8)],"
        " lambda a, x: (a * 7296 + x) % 10000)"
    )
    return (
        f"CASE WHEN trim({column}) <> '' THEN 'DEMO {label} ' ||"
        f" lpad(CAST({number} AS VARCHAR), 4, '0') ELSE {column} END AS {column}"
    )


PSEUDONYMS = f"""
SELECT peorgnr, {_pseudonym("foretagsnamn", "ftg:", "AB")},
       {_pseudonym("namn", "ent:", "ENTITY")},
       {_pseudonym("coadress", "co:", "PERSON")}, postort, source_file
FROM ({CUSTOMERS})"""

# The name columns of the two segments that are done from the start.
HALF_DONE = f"""
SELECT * FROM ({CUSTOMERS}) WHERE source_file NOT IN ('BUILDING', 'HOUSEHOLD')
UNION ALL
SELECT * FROM ({PSEUDONYMS}) WHERE source_file IN ('BUILDING', 'HOUSEHOLD')"""

MELTED = """
SELECT 'householdID_' || l_orderkey AS row_id, l_returnflag AS filename,
       'report_' || l_linestatus AS report_table, column_id,
       CASE WHEN v >= 0.01 THEN v END AS val_dec
FROM (
    SELECT *, 'incomeBeforeTax' AS column_id, l_extendedprice AS v FROM lineitem
    UNION ALL SELECT *, 'debtTotal', l_tax FROM lineitem
    UNION ALL SELECT *, 'numChildren', CAST(l_linenumber AS DOUBLE) FROM lineitem
    UNION ALL SELECT *, 'ltiCreditAmount', l_discount FROM lineitem)"""

WIDE = f"""
SELECT regexp_extract(row_id, '(\\d+)$', 1) AS household_bk, filename AS source_file,
       CAST(max(val_dec) FILTER (column_id = 'incomeBeforeTax') AS DECIMAL(18, 2))
           AS income_before_tax,
       CAST(max(val_dec) FILTER (column_id = 'debtTotal') AS DECIMAL(18, 2))
           AS debt_total,
       CAST(max(val_dec) FILTER (column_id = 'numChildren') AS INTEGER)
           AS num_children,
       CAST(max(val_dec) FILTER (column_id = 'ltiCreditAmount') AS DECIMAL(18, 2))
           AS lti_credit_amount
FROM ({MELTED}) GROUP BY ALL"""

NAMES = """
SELECT o_orderkey,
       CASE o_orderstatus
           WHEN 'F' THEN 'reg_JE_' || strftime(o_orderdate, '%Y%m%d') || 'T120000_'
                || o_orderkey || '.txt'
           WHEN 'P' THEN 'a_' || strftime(o_orderdate, '%Y') || '0230_'
                || strftime(o_orderdate, '%Y%m%d') || '.txt'
           ELSE 'nodate_' || o_orderpriority || '.txt' END AS name
FROM orders"""

# The first eight digits in a row, if the calendar knows them.
LAYOUT = f"""
SELECT o_orderkey, name,
       CASE WHEN accepted THEN digits[1:4] END AS year,
       CASE WHEN accepted THEN digits[5:6] END AS month,
       CASE WHEN accepted THEN digits[7:8] END AS day, accepted
FROM (
    SELECT *, regexp_extract(name, '[0-9]{{8}}') AS digits,
           try_strptime(digits, '%Y%m%d') IS NOT NULL AS accepted
    FROM ({NAMES}))"""

# Orders as they were delivered: file, day, and whether the line fits its header.
DELIVERED = """
SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'reg_20240301T120000_1.txt'
                              WHEN 2 THEN 'reg_20240301T130000_2.txt'
                              ELSE 'reg_20240302T120000_1.txt' END AS source_file,
       CAST(CASE WHEN o_orderkey % 3 = 1 THEN 2 ELSE 1 END AS INTEGER) AS day,
       o_orderkey % 3 <> 1 OR (o_orderkey % 9 = 7 AND o_orderkey % 27 <> 7) AS sound
FROM orders"""

_EVENT_PARTS = """
    CAST(date_part('year', effective_date) AS INTEGER) AS year,
    CAST(date_part('month', effective_date) AS INTEGER) AS month,
    CAST(date_part('day', effective_date) AS INTEGER) AS day"""

ORACLE: dict[str, str] = {
    "stage_projection": f"""
SELECT *, {_EVENT_PARTS} FROM (
    SELECT CAST(user_id AS VARCHAR) AS user_id, event_type,
           CAST(event_id AS VARCHAR) AS event_id,
           make_date(CAST(year(ts) AS INTEGER), CAST(month(ts) AS INTEGER),
                     CAST(day(ts) AS INTEGER)) AS effective_date,
           'events/' || event_type AS source_file,
           TIMESTAMP '2024-02-01' AS last_updated_dt, 'run-1' AS invocation_id
    FROM events)""",
    "dedup_latest": LANDING,
    "dedup_rejects": REJECTS,
    "dedup_reconciliation": f"""
WITH b AS (
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority
    FROM orders),
kept AS (
    SELECT * FROM ({LANDING}) UNION ALL SELECT * EXCLUDE (_dedup_rank) FROM ({REJECTS}))
SELECT *, bronze_n - winners_n - rejects_n AS missing_rows
FROM (SELECT
    (SELECT count(*) FROM b) AS bronze_n,
    (SELECT count(*) FROM ({LANDING})) AS winners_n,
    (SELECT count(*) FROM ({REJECTS})) AS rejects_n,
    (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM kept)) AS lost_rows,
    (SELECT count(*) FROM (SELECT * FROM kept EXCEPT ALL SELECT * FROM b))
        AS foreign_rows)""",
    "dup_cross_delivery": f"""
SELECT user_id, count(DISTINCT effective_date) AS deliveries_seen
FROM ({EVENTS}) GROUP BY user_id HAVING count(DISTINCT effective_date) >= 2""",
    "dup_intra_delivery": f"""
SELECT user_id, effective_date, event_type, count(*) AS copies
FROM ({EVENTS}) GROUP BY ALL HAVING count(*) > 1""",
    "dup_losing_copies": f"""
SELECT user_id, effective_date, event_type, any_value(winner_date) AS winner_date,
       count(*) AS losing_copies,
       effective_date = any_value(winner_date) AS same_day_as_winner
FROM (
    SELECT *, max(effective_date) OVER (PARTITION BY user_id) AS winner_date,
           row_number() OVER (PARTITION BY user_id
               ORDER BY effective_date DESC, event_type DESC) AS place
    FROM ({EVENTS}))
WHERE place > 1 GROUP BY user_id, effective_date, event_type""",
    "scd2_history": EVENT_HISTORY,
    "scd2_current": f"SELECT * FROM ({EVENT_HISTORY}) WHERE dbt_valid_to IS NULL",
    "scd2_as_of": f"""
SELECT * FROM ({EVENT_HISTORY})
WHERE dbt_valid_from <= TIMESTAMP '2024-01-15 12:00:00'
  AND coalesce(dbt_valid_to, TIMESTAMP '9999-12-31') > TIMESTAMP '2024-01-15 12:00:00'
""",
    "scd2_totals": f"""
SELECT 'orders' AS src, count(*) AS n,
       count(CASE WHEN dbt_valid_to IS NULL THEN 1 END) AS current_n
FROM ({ORDER_HISTORY})
UNION ALL
SELECT 'events', count(*), count(CASE WHEN dbt_valid_to IS NULL THEN 1 END)
FROM ({EVENT_HISTORY})""",
    "scd2_point_in_time": f"""
SELECT f.o_orderkey, f.o_custkey AS customer, f.o_orderdate,
       h.o_orderstatus, h.o_orderpriority
FROM orders f LEFT JOIN ({ORDER_HISTORY}) h
  ON f.o_custkey = h.o_custkey AND h.dbt_valid_from <= f.o_orderdate
 AND (h.dbt_valid_to IS NULL OR h.dbt_valid_to > f.o_orderdate)""",
    "scd2_interval_check": """
WITH spans AS (
    SELECT l_orderkey, l_shipdate AS dbt_valid_from,
           CASE WHEN l_linestatus = 'F'
                THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER)) END
               AS dbt_valid_to
    FROM lineitem),
folded AS (
    SELECT l_orderkey, dbt_valid_from, count(*) AS copies,
           count(*) > count(dbt_valid_to) AS is_open,
           CASE WHEN count(*) = count(dbt_valid_to) THEN max(dbt_valid_to) END
               AS dbt_valid_to
    FROM spans GROUP BY l_orderkey, dbt_valid_from),
lined AS (
    SELECT *, lead(dbt_valid_from) OVER (
        PARTITION BY l_orderkey ORDER BY dbt_valid_from) AS next_from
    FROM folded)
SELECT * FROM (
    SELECT CASE WHEN copies > 1 THEN 'several versions start together'
                WHEN NOT is_open AND dbt_valid_from >= dbt_valid_to
                THEN 'empty interval'
                WHEN next_from IS NOT NULL AND is_open THEN 'overlap'
                WHEN next_from < dbt_valid_to THEN 'overlap'
                WHEN next_from > dbt_valid_to THEN 'gap' END AS problem,
           l_orderkey, dbt_valid_from, dbt_valid_to, next_from, copies
    FROM lined)
WHERE problem IS NOT NULL""",
    "scd2_merge": _merge(False),
    "scd2_merge_close_missing": _merge(True),
    "scd2_published": f"SELECT * EXCLUDE (change) FROM ({_merge(False)})",
    "tumbling_hour": """
SELECT date_trunc('hour', ts) AS station_service_time_hour,
       count(*) AS number_of_services
FROM events WHERE year(ts) = 2024 GROUP BY ALL""",
    "tumbling_quarter_profile": """
SELECT format('{:02d}:{:02d}', hour(ts), minute(ts) // 15 * 15)
           AS station_service_time_hour_quarter,
       sum(1) / 366 AS number_of_services
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'
GROUP BY hour(ts), minute(ts) // 15""",
    "tumbling_offset_profile": """
SELECT strftime(time_bucket(INTERVAL 25 MINUTE, ts, INTERVAL 5 MINUTE), '%H:%M')
           AS station_service_time_hour_quarter,
       count(*) / 30 AS number_of_services
FROM events WHERE year(ts) = 2024 GROUP BY ALL""",
    "hopping_all": HOPPING,
    "hopping_starts": """
SELECT unnest(range(
    (SELECT date_trunc('day', min(ts))::TIMESTAMP FROM events),
    (SELECT date_trunc('day', max(ts))::TIMESTAMP + INTERVAL 1 DAY FROM events),
    INTERVAL 5 MINUTE)) AS window_start""",
    "hopping_top5": f"{HOPPING} ORDER BY number_of_services DESC, window_start LIMIT 5",
    "sliding_count": SLIDING,
    "sliding_top5": f"{SLIDING} ORDER BY number_of_services DESC, window_start LIMIT 5",
    "session_windows": SESSIONS,
    "session_top_days": f"""
SELECT station_service_date, longest AS number_of_hours_without_gap,
       sessions AS number_of_sessions
FROM (
    SELECT station_service_date, count(*) AS sessions,
           max((date_diff('minute', window_start, window_end) + 59) // 60) AS longest
    FROM ({SESSIONS}) GROUP BY station_service_date)
WHERE longest > 0
QUALIFY row_number() OVER (ORDER BY sessions DESC, station_service_date) <= 5""",
    "session_of_day": f"""
SELECT * FROM ({SESSIONS}) WHERE station_service_date = DATE '2024-01-15'""",
    "session_gaps": f"SELECT DISTINCT gap_minutes FROM ({SESSIONS})",
    "layer_counts": f"""
SELECT 'raw' AS layer, count(*) AS rows FROM orders
UNION ALL SELECT 'bronze', count(*) FROM orders
UNION ALL SELECT 'landing', count(*) FROM ({LANDING})
UNION ALL SELECT 'rejects', count(*) FROM ({REJECTS})
UNION ALL SELECT 'scd2 total', count(*) FROM ({ORDER_HISTORY})
UNION ALL SELECT 'scd2 current only', count(*) FROM ({ORDER_HISTORY})
WHERE dbt_valid_to IS NULL""",
    "entity_lineage": f"""
WITH h AS ({ORDER_HISTORY}), target AS (
    SELECT coalesce(
        (SELECT min(o_custkey) FROM (
            SELECT o_custkey FROM h GROUP BY o_custkey HAVING count(*) > 1)),
        (SELECT min(o_custkey) FROM h)) AS k),
every AS (
    SELECT 'bronze' AS layer, o_custkey, o_orderstatus, o_orderdate,
           NULL::VARCHAR AS extra
    FROM orders
    UNION ALL SELECT 'landing', o_custkey, o_orderstatus, o_orderdate, NULL
    FROM ({LANDING})
    UNION ALL SELECT 'rejects, place ' || _dedup_rank, o_custkey,
                     o_orderstatus, o_orderdate, NULL
    FROM ({REJECTS})
    UNION ALL SELECT 'scd2', o_custkey, o_orderstatus, o_orderdate,
                     'valid ' || strftime(dbt_valid_from, '%Y-%m-%d %H:%M:%S')
                     || ' until ' || coalesce(
                         strftime(dbt_valid_to, '%Y-%m-%d %H:%M:%S'), 'now')
    FROM h)
SELECT * FROM every WHERE o_custkey = (SELECT k FROM target)""",
    "integrity_problems": f"""
WITH e AS ({EVENTS}),
per_delivery AS (
    SELECT * FROM e QUALIFY row_number() OVER (
        PARTITION BY user_id, effective_date ORDER BY event_id DESC) = 1),
h AS ({EVENT_HISTORY}),
recon AS (
    SELECT (SELECT count(*) FROM e) AS b,
           (SELECT count(DISTINCT user_id) FROM e) AS w,
           (SELECT count(*) - count(DISTINCT user_id) FROM per_delivery) AS r)
SELECT 'landing per delivery: user_id comes more than once' AS problem,
       CAST(user_id AS VARCHAR) AS user_id, count(*) AS n
FROM per_delivery GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'scd2: several open versions of one user_id', CAST(user_id AS VARCHAR), count(*)
FROM h WHERE dbt_valid_to IS NULL GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'scd2 all open: several open versions of one user_id', CAST(user_id AS VARCHAR),
       count(*)
FROM h GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'of ' || b || ' bronze rows, ' || w || ' won and ' || r || ' were rejected', NULL, b - (w + r)
FROM recon WHERE b <> w + r""",
    "scd2_listing": f"""
SELECT 'all' AS src, user_id, event_type, effective_date, dbt_valid_from,
       dbt_valid_to
FROM ({EVENT_HISTORY})
UNION ALL
SELECT 'current', user_id, event_type, effective_date, dbt_valid_from, dbt_valid_to
FROM ({EVENT_HISTORY}) WHERE dbt_valid_to IS NULL""",
    "unique_failures": """
SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders
WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""",
    "run_log": f"""
SELECT 'run-1' AS run_id, step, status, rows, TRUE AS timed FROM (
    SELECT 'bronze' AS step, 'success' AS status, count(*) AS rows FROM ({EVENTS})
    UNION ALL SELECT 'landing', 'success', count(*) FROM ({LANDING})
    UNION ALL SELECT 'history', 'success', count(*) FROM ({EVENT_HISTORY})
    UNION ALL SELECT 'not_null_band', 'fail', count(*) FROM ({EVENTS})
              WHERE band IS NULL)""",
    "not_null_failures": f"SELECT * FROM ({EVENTS}) WHERE band IS NULL",
    "stored_failures": f"""
WITH e AS ({EVENTS}),
n AS (SELECT (SELECT count(*) FROM e WHERE user_id IS NULL) AS no_user,
             (SELECT count(*) FROM (SELECT user_id FROM e GROUP BY user_id
                                    HAVING count(*) > 1)) AS twice,
             (SELECT count(*) FROM e WHERE band IS NULL) AS no_band)
SELECT 'not_null_user' AS name, CASE WHEN no_user > 0 THEN 'fail' ELSE 'pass' END
           AS status, no_user AS failures, NULL::BIGINT AS stored FROM n
UNION ALL SELECT 'unique_user', CASE WHEN twice > 0 THEN 'warn' ELSE 'pass' END,
                 twice, twice FROM n
UNION ALL SELECT 'not_null_band', CASE WHEN no_band > 0 THEN 'fail' ELSE 'pass' END,
                 no_band, NULL FROM n""",
    "relation_diff": f"""
WITH {NEWEST_AND_LARGEST},
parts AS (
    SELECT TRUE AS in_a, TRUE AS in_b, count(*) AS count
    FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
    UNION ALL SELECT TRUE, FALSE, count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT FALSE, TRUE, count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
SELECT in_a, in_b, count,
       round(100.0::DOUBLE * count / (SELECT sum(count) FROM parts), 2)
           AS percent_of_total
FROM parts WHERE count > 0""",
    "relation_diff_bag": f"""
WITH {BAGS},
parts AS (
    SELECT TRUE AS in_a, TRUE AS in_b, count(*) AS count
    FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b)
    UNION ALL SELECT TRUE, FALSE, count(*)
    FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    UNION ALL SELECT FALSE, TRUE, count(*)
    FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
SELECT in_a, in_b, count,
       round(100.0::DOUBLE * count / (SELECT sum(count) FROM parts), 2)
           AS percent_of_total
FROM parts WHERE count > 0""",
    "relation_surplus": f"""
WITH {BAGS}, {SIDES} SELECT * FROM sides WHERE copies_a <> copies_b""",
    "relation_diff_keyed": f"""
WITH a AS ({FIRST_LANDING}), b AS ({SECOND_LANDING}),
j AS (
    SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
           a.o_custkey IS NOT NULL AS in_a, b.o_custkey IS NOT NULL AS in_b,
           a.o_orderdate IS DISTINCT FROM b.o_orderdate AS c1,
           a.o_orderpriority IS DISTINCT FROM b.o_orderpriority AS c2,
           a.o_orderstatus IS DISTINCT FROM b.o_orderstatus AS c3
    FROM a FULL JOIN b ON a.o_custkey = b.o_custkey)
SELECT o_custkey,
       CASE WHEN NOT in_b THEN 'only_a' WHEN NOT in_a THEN 'only_b'
            ELSE 'changed' END AS status,
       CASE WHEN in_a AND in_b THEN concat_ws(',',
            CASE WHEN c1 THEN 'o_orderdate' END,
            CASE WHEN c2 THEN 'o_orderpriority' END,
            CASE WHEN c3 THEN 'o_orderstatus' END) ELSE '' END AS changed_columns,
       CAST(in_a AS BIGINT) AS copies_a, CAST(in_b AS BIGINT) AS copies_b
FROM j WHERE NOT in_a OR NOT in_b OR c1 OR c2 OR c3""",
    "relation_diff_repeated": f"""
WITH {BAGS},
sides AS (
    SELECT user_id, event_type, count(*) FILTER (side = 'a') AS copies_a,
           count(*) FILTER (side = 'b') AS copies_b,
           max(band) FILTER (side = 'a') AS band_a,
           max(band) FILTER (side = 'b') AS band_b
    FROM (SELECT *, 'a' AS side FROM a UNION ALL SELECT *, 'b' FROM b)
    GROUP BY user_id, event_type)
SELECT user_id, event_type,
       CASE WHEN copies_a > 1 OR copies_b > 1 THEN 'repeated'
            WHEN copies_b = 0 THEN 'only_a' WHEN copies_a = 0 THEN 'only_b'
            ELSE 'changed' END AS status,
       CASE WHEN copies_a = 1 AND copies_b = 1 THEN 'band' ELSE '' END
           AS changed_columns,
       copies_a, copies_b
FROM sides
WHERE NOT (copies_a = 1 AND copies_b = 1 AND band_a IS NOT DISTINCT FROM band_b)""",
    "set_common": f"WITH {BAGS} SELECT * FROM a INTERSECT SELECT * FROM b",
    "set_missing": f"WITH {BAGS} SELECT * FROM a EXCEPT SELECT * FROM b",
    "bag_missing": f"WITH {BAGS} SELECT * FROM a EXCEPT ALL SELECT * FROM b",
    "pseudonymise": PSEUDONYMS,
    "anonymised_check": f"""
SELECT source_file, count(*) AS rows_seen,
       CASE WHEN names > 0 AND names = marked THEN 0 ELSE count(*) END
           AS rows_rewritten,
       names > 0 AND names = marked AS already_anonymised
FROM (
    SELECT source_file,
           sum(n) OVER (PARTITION BY source_file) AS names,
           sum(m) OVER (PARTITION BY source_file) AS marked
    FROM (
        SELECT source_file,
               (trim(coalesce(foretagsnamn, '')) <> '')::INT
               + (trim(coalesce(namn, '')) <> '')::INT
               + (trim(coalesce(coadress, '')) <> '')::INT AS n,
               starts_with(coalesce(foretagsnamn, ''), 'DEMO ')::INT
               + starts_with(coalesce(namn, ''), 'DEMO ')::INT
               + starts_with(coalesce(coadress, ''), 'DEMO ')::INT AS m
        FROM ({HALF_DONE})))
GROUP BY source_file, names, marked""",
    "anonymise_open_files": PSEUDONYMS,
    "surrogate_keys": """
SELECT o_orderkey, strftime(o_orderdate, '%Y') || '_data.parquet' AS source_file,
       md5(o_orderkey || strftime(o_orderdate, '%Y') || '_data.parquet') AS order_sk,
       16 AS key_bytes
FROM orders""",
    "sequence_keys": """
SELECT o_orderkey, o_custkey,
       row_number() OVER (ORDER BY o_custkey, o_orderkey) AS order_seq
FROM orders""",
    "eav_pivot": WIDE,
    "household_landing": f"""
SELECT *, md5(household_bk || source_file) AS household_sk,
       TIMESTAMP '2024-02-01' AS stg_loaded_at, 'batch-1' AS dbt_batch_id
FROM ({WIDE})""",
    "eav_reports": f"""
SELECT report_table, count(*) AS rows FROM ({MELTED}) GROUP BY report_table""",
    "eav_sample": f"""
SELECT * FROM ({MELTED}) WHERE val_dec IS NOT NULL
ORDER BY row_id, column_id, filename, report_table, val_dec LIMIT 5""",
    "eav_first_report": f"""
SELECT * FROM ({MELTED})
WHERE report_table = (SELECT min(report_table) FROM ({MELTED}))
ORDER BY row_id, column_id, filename, report_table, val_dec LIMIT 10""",
    "filename_partition": LAYOUT,
    "filename_totals": f"""
SELECT count(*) FILTER (accepted) AS uploaded,
       count(*) FILTER (NOT accepted) AS skipped
FROM ({LAYOUT})""",
    "pruned_sum": """
SELECT p.province_sk, n.n_name AS province_name,
       CAST(sum(CAST(p.o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS number_of_rides
FROM (
    SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'unknown'
                ELSE CAST(c_nationkey AS VARCHAR) END AS province_sk, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE year(o_orderdate) = 1998) p
JOIN nation n ON p.province_sk = CAST(n.n_nationkey AS VARCHAR)
WHERE p.province_sk <> 'unknown' GROUP BY ALL""",
    "hive_pruned_sum": """
SELECT CAST(1998 AS INTEGER) AS service_year, o_orderstatus AS province_sk,
       count(*) AS number_of_rides
FROM orders WHERE year(o_orderdate) = 1998 GROUP BY ALL""",
    "raw_union_by_name": """
SELECT CAST(user_id AS VARCHAR) AS peorgnr, event_type AS namn,
       CASE WHEN day(ts) <= 15 THEN 'Å Ä Ö ' || event_id END AS gatuadress,
       CAST(ts AS DATE) AS effective_date, TIMESTAMP '2024-02-01' AS last_updated_dt,
       'run-1' AS invocation_id
FROM events""",
    "raw_layouts": """
SELECT 'o_orderkey,o_custkey' AS header, count(*) AS rows FROM orders
UNION ALL SELECT 'c_custkey,c_name', count(*) FROM customer""",
    "raw_landing": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "PeOrgNr", o_orderstatus AS "Namn",
       o_orderpriority AS "PostOrt", CAST(2024 AS INTEGER) AS year,
       CAST(3 AS INTEGER) AS month, day
FROM ({DELIVERED}) WHERE sound""",
    "raw_lineage": f"""
SELECT source_file, count(*) AS rows FROM ({DELIVERED}) WHERE sound
GROUP BY source_file""",
    "raw_quarantine": f"""
SELECT source_file, count(*) AS lines FROM ({DELIVERED}) WHERE NOT sound
GROUP BY source_file""",
    "raw_replaced": """
SELECT 'reg_2024030' || (o_orderkey % 4 + 1) || '.txt' AS source_file,
       CASE WHEN o_orderkey % 4 = 3 OR (o_orderkey % 4 = 1 AND o_orderkey % 5 = 0)
            THEN 'quarantine' ELSE 'raw' END AS side, count(*) AS rows
FROM orders WHERE o_orderkey % 4 <> 2 GROUP BY ALL""",
    "lake_versions": f"""
SELECT 'version 1' AS view, o_orderstatus, count(*) AS rows
FROM ({FIRST_LANDING}) GROUP BY o_orderstatus
UNION ALL SELECT 'as of 2000', o_orderstatus, count(*)
FROM ({FIRST_LANDING}) GROUP BY o_orderstatus
UNION ALL SELECT 'latest', o_orderstatus, count(*)
FROM ({SECOND_LANDING}) GROUP BY o_orderstatus""",
    "lake_increments": """
WITH files AS (
    SELECT 'orders-' || year(o_orderdate) AS source_file, year(o_orderdate) AS y, o_orderkey
    FROM orders
), second AS (
    SELECT * FROM files WHERE y > 1992 AND (y <> 1995 OR o_orderkey % 2 = 0)
)
SELECT 'as of 2000' AS view, source_file, count(*) AS rows
FROM files WHERE y <= 1995 GROUP BY source_file
UNION ALL SELECT 'latest', source_file, count(*) FROM second GROUP BY source_file
UNION ALL SELECT 'added', source_file, count(*)
FROM second WHERE y >= 1995 GROUP BY source_file""",
    "schema_evolution": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "strategy_modes": """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P')""",
    "strategy_replace": """
SELECT o_orderkey, CAST(o_orderpriority[1] AS INTEGER) AS priority
FROM orders WHERE o_orderstatus IN ('F', 'P')""",
    "anonymise_files": f"""
SELECT source_file || '.txt' AS source_file, count(*) AS rows_seen,
       CASE WHEN source_file IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY') THEN 0
            ELSE count(*) END AS rows_rewritten,
       source_file IN ('BUILDING', 'HOUSEHOLD') AS already_anonymised,
       CASE WHEN source_file = 'MACHINERY' THEN 'namn, coadress' ELSE '' END
           AS missing_columns
FROM ({CUSTOMERS}) GROUP BY source_file""",
    "anonymise_files_rows": f"""
SELECT peorgnr AS "PeOrgNr", nullif(foretagsnamn, '') AS "Foretagsnamn",
       nullif(trim(namn), '') AS "Namn", nullif(coadress, '') AS "CoAdress",
       postort AS "PostOrt", source_file || '.txt' AS source_file
FROM ({PSEUDONYMS}) WHERE source_file <> 'MACHINERY'
UNION ALL
SELECT peorgnr, nullif(foretagsnamn, ''), NULL, NULL, postort, source_file || '.txt'
FROM ({CUSTOMERS}) WHERE source_file = 'MACHINERY'""",
    "incremental_ingest": EVENT_HISTORY,
    "ingest_text": EVENT_HISTORY,
    "ingest_account": f"""
WITH e AS (
    SELECT event_id % 3 + 1 AS load_id, CASE WHEN event_id % 50 <> 0 THEN user_id END AS k,
           {{'d': effective_date, 'e': event_id}} AS at
    FROM ({EVENTS})
), newest AS (SELECT k, load_id, max(at) AS at FROM e WHERE k IS NOT NULL GROUP BY ALL
), seen AS (
    SELECT e.load_id, e.k, e.at,
           (SELECT max(n.at) FROM newest n WHERE n.k = e.k AND n.load_id < e.load_id) AS was
    FROM e
)
SELECT load_id, count(*) AS bronze,
       count(*) FILTER (k IS NOT NULL AND (was IS NULL OR at > was)) AS on_time,
       count(*) FILTER (k IS NOT NULL AND at <= was) AS late,
       count(*) FILTER (k IS NULL) AS quarantined
FROM seen GROUP BY load_id""",
    "stream_tumbling": """
SELECT date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS number_of_services
FROM events GROUP BY ALL""",
    "stream_hopping": """
WITH w AS (
    SELECT range AS window_start, range + INTERVAL 15 MINUTE AS window_end
    FROM range((SELECT date_trunc('day', min(ts)) - INTERVAL 1 DAY FROM events),
               (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY FROM events),
               INTERVAL 5 MINUTE))
SELECT window_start, window_end, count(*) AS number_of_services
FROM events JOIN w ON ts >= window_start AND ts < window_end GROUP BY ALL""",
    "stream_sessions": """
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 10 MINUTE AS window_end,
       count(*) AS number_of_services
FROM (
    SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                ROWS UNBOUNDED PRECEDING) AS session
    FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (
                           PARTITION BY user_id ORDER BY ts, event_id)
                           <= INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS starts
        FROM events))
GROUP BY user_id, session""",
}
