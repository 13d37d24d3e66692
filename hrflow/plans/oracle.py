"""DuckDB SQL oracles for the registered queries (same rows, same column names).

Only the driver's raw tables are registered in DuckDB, so each oracle inlines the
adapters of FIXTURES.md §2 as CTEs. The text mirrors the operator semantics: the
same tie-breaks (``keep_max`` = ORDER BY ... DESC NULLS LAST), the same decimal
ladder, the same integer HALF_UP percentage.
"""

from __future__ import annotations

from decimal import Decimal

from ..schemas import LADDER_STEPS
from .catalog import KEYS, MERGE_SPLIT_EPOCH

LADDER = [f"strike_{i}" for i in range(1, LADDER_STEPS + 1)]
# Spark upper-cases 'ß' to 'SS' (full case mapping); DuckDB does not.
TOK = "regexp_extract_all(upper(replace({m}, 'ß', 'ss')), '[\\p{{L}}\\p{{N}}_]+')"


def tok(m: str) -> str:
    return TOK.format(m=m)


def epoch_date(x: str) -> str:
    return f"CAST(DATE '1970-01-01' + CAST(floor({x} / 86400) AS INTEGER) AS DATE)"


def ladder_step(salary: str, count: str, i: int) -> str:
    f = Decimal("0.9") ** i
    return (f"CASE WHEN {count} >= {i} AND {salary} IS NOT NULL THEN CAST(round(CAST({salary} AS DECIMAL(24,8)) "
            f"* CAST('{f}' AS DECIMAL(11,10)), 2) AS DOUBLE) END")


def ladder(salary: str, count: str) -> str:
    return ", ".join(f"{ladder_step(salary, count, i)} AS strike_{i}" for i in range(1, LADDER_STEPS + 1))


NULL_LADDER = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in LADDER)

ADAPTERS = {
    "x_employee": """
  SELECT CAST(c_custkey AS VARCHAR) AS emp_id, c_name AS name,
         CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 77 = 0 THEN 'abc'
              WHEN c_custkey % 31 = 0 THEN '0.5' WHEN c_custkey % 29 = 0 THEN '-3'
              ELSE CAST(18 + c_custkey % 45 AS VARCHAR) END AS age
  FROM (SELECT c_custkey, c_name FROM customer
        UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 10 = 0) c""",
    "x_timeframe": """
  SELECT CAST(o_custkey AS VARCHAR) AS emp_id, o_orderpriority AS designation,
         CAST(epoch(o_orderdate) AS BIGINT) AS start_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(epoch(o_orderdate) AS BIGINT) + 7776000 END AS end_date,
         o_totalprice AS salary
  FROM orders""",
    "x_leave": """
  SELECT CAST(user_id AS VARCHAR) AS emp_id,
         CAST(DATE '2024-01-01' + CAST(event_id * 7919 % 366 AS INTEGER) AS DATE) AS date,
         CASE event_type WHEN 'signup' THEN 'CANCELLED' WHEN 'error' THEN 'PENDING' ELSE 'ACTIVE' END AS status
  FROM events""",
    "x_calendar": """
  SELECT * FROM (VALUES ('reason', CAST(NULL AS DATE)), ('New Year', DATE '2024-01-01'),
    ('Mid January', DATE '2024-01-15'), ('Summer', DATE '2024-07-04'), ('Winter', DATE '2024-12-25'),
    ('Winter', DATE '2024-12-25')) AS v(reason, date)""",
    "x_calendar_feed": """
  SELECT reason, CAST(date AS TIMESTAMP) AS date FROM x_calendar
  UNION ALL SELECT event_type AS reason, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date FROM events""",
    "x_quota": """
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS emp_id, CAST(20 + user_id % 20 AS INTEGER) AS leave_quota,
         2024 AS year FROM events""",
    "x_message": """
  SELECT CAST(conv_id AS VARCHAR) AS sender, CAST(conv_id + 1 AS VARCHAR) AS receiver,
         text AS message FROM conversations""",
    "x_marked": """
  SELECT * FROM (VALUES ('THAT'), ('FOR'), ('IS'), ('ERED')) AS v(word)""",
    "x_vocab": f"""
  SELECT word FROM (SELECT unnest(list_distinct({tok('message')})) AS word
                    FROM (SELECT DISTINCT sender, receiver, message FROM x_message) m) t
  GROUP BY word HAVING count(*) >= 2""",
    "x_strikes_whole_base": """
  SELECT CAST(c_custkey AS VARCHAR) AS employee_id,
         CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN coalesce(l.price, CAST(1 AS DOUBLE))
              ELSE CAST(1000 + c_custkey AS DOUBLE) END AS salary,
         CAST(c_custkey % 13 AS INTEGER) AS no_of_strikes, c_custkey % 13 >= 10 AS is_inactive
  FROM customer LEFT JOIN (
    SELECT o_custkey, max(o_totalprice) AS price
    FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rk FROM orders) z
    WHERE rk = 1 GROUP BY o_custkey) l ON l.o_custkey = c_custkey""",
    "x_strikes_base": "SELECT * FROM x_strikes_whole_base WHERE CAST(employee_id AS BIGINT) % 3 <> 0",
    "x_strikes_whole": f"""
  SELECT employee_id, salary, {ladder('salary', 'no_of_strikes')}, no_of_strikes, is_inactive
  FROM x_strikes_whole_base""",
    "x_strikes": f"""
  SELECT employee_id, salary, {ladder('salary', 'no_of_strikes')}, no_of_strikes, is_inactive
  FROM x_strikes_base""",
    "x_flag_log": """
  SELECT CAST(user_id AS VARCHAR) AS employee_id, ts AS start_date FROM events""",
}


# derived building blocks ---------------------------------------------------------------
def j2(src: str) -> str:
    return f"""
  SELECT emp_id, designation, start_date, end_date, salary FROM (
    SELECT *, row_number() OVER (PARTITION BY emp_id, start_date
      ORDER BY salary DESC NULLS LAST, end_date DESC NULLS LAST, designation DESC NULLS LAST) AS rn
    FROM {src}) z WHERE rn = 1"""


CHAIN = ("PARTITION BY emp_id ORDER BY start_date ASC NULLS FIRST, end_date ASC NULLS FIRST, "
         "salary ASC NULLS FIRST, designation ASC NULLS FIRST")


def j3(src: str) -> str:
    return f"""
  SELECT emp_id, designation, start_date,
         coalesce(end_date, lead(start_date) OVER ({CHAIN})) AS end_date, salary
  FROM {src}"""


def j5(src: str) -> str:
    return f"""
  SELECT emp_id, designation, {epoch_date('start_date')} AS start_date, {epoch_date('end_date')} AS end_date,
         salary, CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status
  FROM {src}"""


def j4(src: str) -> str:
    """dates -> dedupe on (emp_id, start, end) -> end := next start -> status"""
    return f"""
  SELECT emp_id, designation, start_date, end_date, salary,
         CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status FROM (
    SELECT emp_id, designation, start_date, lead(start_date) OVER ({CHAIN}) AS end_date, salary FROM (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY emp_id, start_date, end_date
          ORDER BY salary DESC NULLS LAST, designation DESC NULLS LAST) AS rn
        FROM (SELECT emp_id, designation, {epoch_date('start_date')} AS start_date,
                     {epoch_date('end_date')} AS end_date, salary FROM {src}) a) b WHERE rn = 1) c) d"""


def j8(src: str) -> str:
    return f"""
  SELECT designation,
         CASE WHEN designation IS NULL THEN CAST(0 AS BIGINT)
              ELSE count(CASE WHEN status = 'ACTIVE' THEN emp_id END) END AS active_employees
  FROM {src} GROUP BY designation"""


def usage(leave: str, before_month: int) -> str:
    return f"""
  SELECT emp_id, leaves_taken, leave_quota, year, CAST(h AS DOUBLE) / CAST(100 AS DOUBLE) AS leave_percent FROM (
    SELECT t.emp_id, t.leaves_taken, q.leave_quota, q.year,
           CASE WHEN q.leave_quota > 0 THEN (t.leaves_taken * 20000 + q.leave_quota) // (q.leave_quota * 2) END AS h
    FROM (SELECT emp_id, count(*) AS leaves_taken FROM {leave}
          WHERE month(date) < {before_month} AND year(date) = 2024 AND status = 'ACTIVE' GROUP BY emp_id) t
    LEFT JOIN (SELECT emp_id, leave_quota, year FROM quota_clean WHERE year = 2024) q ON t.emp_id = q.emp_id) u
  WHERE h > 8000"""


DERIVED = {
    "tf_dedupe": j2("x_timeframe"),
    "tf_intervals": j3("tf_dedupe"),
    "gold": j5("tf_intervals"),
    "tf_old_raw": f"SELECT * FROM x_timeframe WHERE start_date < {MERGE_SPLIT_EPOCH}",
    "tf_new_raw": f"SELECT * FROM x_timeframe WHERE NOT (start_date < {MERGE_SPLIT_EPOCH}) OR start_date IS NULL",
    "old_dedupe": j2("tf_old_raw"),
    "old_intervals": j3("old_dedupe"),
    "old_gold": j5("old_intervals"),
    "new_chained": j4("tf_new_raw"),
    "merged": f"""
  SELECT emp_id, designation, start_date, end_date, salary,
         CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status FROM (
    SELECT emp_id, designation, start_date,
           lead(start_date) OVER (PARTITION BY emp_id ORDER BY start_date ASC NULLS FIRST,
                                  salary ASC NULLS FIRST, designation ASC NULLS FIRST) AS end_date, salary
    FROM (SELECT DISTINCT emp_id, designation, start_date, salary FROM (
            SELECT emp_id, designation, start_date, salary FROM old_gold
            UNION ALL SELECT emp_id, designation, start_date, salary FROM new_chained) u) c) d""",
    "holidays": "SELECT DISTINCT date FROM x_calendar WHERE date IS NOT NULL",
    "lv_pre": """
  SELECT emp_id, date, status FROM x_leave
  WHERE dayofweek(date) NOT IN (0, 6) AND emp_id IS NOT NULL AND date IS NOT NULL AND status IS NOT NULL
    AND status IN ('ACTIVE', 'CANCELLED')""",
    "lv_hol": "SELECT * FROM lv_pre l WHERE NOT EXISTS (SELECT 1 FROM holidays h WHERE h.date = l.date)",
    "lv_known": "SELECT * FROM lv_hol l WHERE l.emp_id IN (SELECT emp_id FROM gold)",
    "lv_stamp": """
  SELECT emp_id, date, status, DATE '2024-01-02' AS ingest_date,
         TIMESTAMP '2024-01-02 07:00:00' AS ingest_timestamp FROM lv_known""",
    "lv_verdict": """
  SELECT emp_id, date,
         CASE WHEN sum(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END)
                   >= sum(CASE WHEN status = 'ACTIVE' THEN 1 ELSE 0 END) THEN 'CANCELLED' ELSE 'ACTIVE' END AS fin
  FROM lv_stamp GROUP BY emp_id, date""",
    "lv_resolved": """
  SELECT s.emp_id, s.date, s.status, s.ingest_date, s.ingest_timestamp
  FROM lv_stamp s JOIN lv_verdict v ON s.emp_id = v.emp_id AND s.date = v.date WHERE s.status = v.fin""",
    "lv_latest": """
  SELECT emp_id, date, status, ingest_date, ingest_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY emp_id, date ORDER BY ingest_timestamp DESC NULLS LAST,
                                 status DESC NULLS LAST, ingest_date DESC NULLS LAST) AS rn
    FROM lv_resolved) z WHERE rn = 1""",
    "leave_gold": """
  SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM lv_latest""",
    "report_days": """
  SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS date""",
    "workdays": """
  SELECT DISTINCT date FROM report_days d
  WHERE dayofweek(date) NOT IN (0, 6) AND NOT EXISTS (SELECT 1 FROM holidays h WHERE h.date = d.date)""",
    "quota_clean": """
  SELECT DISTINCT emp_id, leave_quota, year FROM x_quota
  WHERE emp_id IS NOT NULL AND leave_quota IS NOT NULL AND year IS NOT NULL""",
    "usage_report": usage("leave_gold", 12),
    "prev_alerts": f"SELECT emp_id FROM ({usage('leave_gold', 11)}) p",
    "new_alerts": """
  SELECT * FROM usage_report u
  WHERE u.emp_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM prev_alerts p WHERE p.emp_id = u.emp_id)""",
    "flagged": f"""
  SELECT * FROM x_message
  WHERE list_has_any({tok('message')}, (SELECT list(word) FROM x_marked))""",
    "ev": """
  SELECT sender AS employee_id, 'sender' AS role FROM flagged WHERE sender IS NOT NULL
  UNION ALL SELECT receiver AS employee_id, 'receiver' AS role FROM flagged WHERE receiver IS NOT NULL""",
    "cnt": "SELECT employee_id, count(*) AS strike_count FROM ev GROUP BY employee_id",
    "sal": """
  SELECT emp_id AS employee_id, salary FROM (
    SELECT emp_id, salary, row_number() OVER (PARTITION BY emp_id
      ORDER BY start_date DESC NULLS LAST, salary DESC NULLS LAST) AS rn
    FROM gold WHERE status = 'ACTIVE') z WHERE rn = 1""",
    "upserted": f"""
  SELECT coalesce(s.employee_id, i.employee_id) AS employee_id,
         coalesce(s.salary, i.new_salary) AS salary,
         {", ".join(f"s.{c} AS {c}" for c in LADDER)},
         CAST(coalesce(CAST(s.no_of_strikes AS BIGINT), 0) + coalesce(i.strike_count, 0) AS INTEGER) AS no_of_strikes,
         coalesce(s.is_inactive, false) AS is_inactive,
         i.employee_id IS NOT NULL AS aff
  FROM x_strikes s FULL OUTER JOIN (
    SELECT c.employee_id, c.strike_count, sal.salary AS new_salary
    FROM cnt c LEFT JOIN sal ON c.employee_id = sal.employee_id) i ON s.employee_id = i.employee_id""",
    "batch_applied": f"""
  SELECT employee_id, salary,
         {", ".join(f"CASE WHEN aff THEN {ladder_step('salary', 'no_of_strikes', i + 1)} ELSE {c} END AS {c}"
                    for i, c in enumerate(LADDER))},
         no_of_strikes,
         CASE WHEN aff THEN is_inactive OR no_of_strikes >= 10 ELSE is_inactive END AS is_inactive
  FROM upserted""",
    "totals": """
  SELECT c.employee_id, coalesce(st.no_of_strikes, 0) + c.strike_count AS strike_count
  FROM cnt c LEFT JOIN x_strikes st ON c.employee_id = st.employee_id""",
    "with_totals": """
  SELECT s.*, t.strike_count FROM x_strikes s JOIN totals t ON s.employee_id = t.employee_id""",
    "sync_new": f"""
  SELECT a.employee_id, a.salary, {NULL_LADDER}, CAST(0 AS INTEGER) AS no_of_strikes
  FROM sal a WHERE NOT EXISTS (SELECT 1 FROM x_strikes s WHERE s.employee_id = a.employee_id)""",
    "sync_changed": f"""
  SELECT a.employee_id, a.salary, {ladder('a.salary', 's.no_of_strikes')}, s.no_of_strikes
  FROM sal a JOIN x_strikes s ON a.employee_id = s.employee_id AND a.salary <> s.salary""",
}

COMMON = {**ADAPTERS, **DERIVED}


def with_ctes(final: str, extra: dict | None = None) -> str:
    ctes = {**COMMON, **(extra or {})}
    body = ",\n".join(f"{k} AS ({v}\n)" for k, v in ctes.items())
    return f"WITH {body}\n{final}"


NL = "chr(10)"

FINAL = {
    # sources
    "scan_csv_strings": "SELECT * FROM x_employee",
    "scan_csv_schema": "SELECT * FROM x_leave",
    "scan_csv_headerless": "SELECT * FROM x_calendar_feed",
    "scan_parquet": "SELECT * FROM leave_gold",
    "scan_partition": "SELECT * FROM gold WHERE status = 'ACTIVE'",
    "scan_jdbc": "SELECT * FROM x_strikes_whole WHERE employee_id IN (SELECT emp_id FROM gold WHERE status = 'ACTIVE')",
    "scan_json_array": "SELECT word FROM x_vocab",
    "scan_json_objects": "SELECT * FROM x_message",
    "scan_optional": "SELECT * FROM x_quota",
    "date_spine": """
SELECT emp_id, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT emp_id, min(date) AS s, max(date) AS e FROM x_leave GROUP BY emp_id) b""",
    "stream_messages": "SELECT * FROM x_message",
    # sinks
    "sink_append_partitioned": """
SELECT DISTINCT emp_id, name, age, 2024 AS year, 1 AS month, 2 AS day FROM x_employee
WHERE emp_id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL AND trunc(try_cast(age AS DOUBLE)) > 0""",
    "sink_overwrite_partitioned": "SELECT * FROM gold",
    "sink_parquet_plain": "SELECT * FROM usage_report",
    "sink_csv": "SELECT * FROM gold",
    "sink_jdbc": "SELECT * FROM sync_new UNION ALL SELECT * FROM sync_changed",
    "sink_text_alerts": f"""
SELECT emp_id, '2024-12-01' AS run_date,
       'Employee ID: ' || emp_id || {NL} || 'Leave Taken: ' || CAST(leaves_taken AS VARCHAR) || {NL}
       || 'Leave Quota: ' || CAST(leave_quota AS VARCHAR) || {NL}
       || 'Usage:       ' || CAST(leave_percent AS VARCHAR) || '%' || {NL}
       || 'Date:        2024-12-01' || {NL} AS content
FROM new_alerts""",
    "sink_kafka_messages": """
SELECT sender AS key, to_json(struct_pack(sender := sender, receiver := receiver, message := message)) AS value
FROM x_message WHERE sender IS NOT NULL AND receiver IS NOT NULL AND message IS NOT NULL""",
    "stream_file_ingest": "SELECT * FROM x_timeframe",
    # history
    "employee_clean": """
SELECT DISTINCT emp_id, name, age FROM x_employee
WHERE emp_id IS NOT NULL AND name IS NOT NULL AND age IS NOT NULL AND trunc(try_cast(age AS DOUBLE)) > 0""",
    "timeframe_dedupe": "SELECT * FROM tf_dedupe",
    "timeframe_intervals": "SELECT * FROM tf_intervals",
    "timeframe_chain": "SELECT * FROM (" + j4("x_timeframe") + ") z",
    "timeframe_status": "SELECT * FROM (" + j5("x_timeframe") + ") z",
    "timeframe_history": "SELECT * FROM gold",
    "timeframe_merge": "SELECT * FROM gold",
    "timeframe_merge_replace": "SELECT * FROM merged",
    "dept_active_report": "SELECT * FROM (" + j8("gold") + ") z",
    "dept_report_upsert": f"""
SELECT coalesce(s.designation, t.designation) AS designation,
       coalesce(s.active_employees, t.active_employees) AS active_employees
FROM ({j8('old_gold')}) t FULL OUTER JOIN ({j8('gold')}) s ON t.designation = s.designation""",
    # leave
    "leave_calendar": """
SELECT DISTINCT reason, date, CAST(year(date) AS INTEGER) AS year FROM x_calendar_feed WHERE date IS NOT NULL""",
    "leave_quota": "SELECT * FROM quota_clean",
    "leave_prefilter": "SELECT * FROM lv_pre",
    "leave_drop_holidays": "SELECT * FROM lv_hol",
    "leave_known_employees": "SELECT * FROM lv_known",
    "leave_stamp": "SELECT * FROM lv_stamp",
    "leave_resolve_status": "SELECT * FROM lv_resolved",
    "leave_latest": "SELECT * FROM lv_latest",
    "leave_clean": "SELECT * FROM leave_gold",
    "working_days": """
SELECT DISTINCT date FROM (
  SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT min(date) AS s, max(date) AS e FROM x_leave) b) d
WHERE dayofweek(date) NOT IN (0, 6) AND NOT EXISTS (SELECT 1 FROM holidays h WHERE h.date = d.date)""",
    "leave_anomaly_8pct": """
SELECT emp_id, upcoming_leaves_count FROM (
  SELECT emp_id, count(*) AS upcoming_leaves_count
  FROM (SELECT DISTINCT emp_id, date FROM leave_gold WHERE status = 'ACTIVE' AND date >= DATE '2024-01-01') l
  JOIN workdays w ON l.date = w.date GROUP BY emp_id) c
WHERE upcoming_leaves_count / (SELECT count(*) FROM workdays) * 100 > 8""",
    "leave_usage_80pct": "SELECT * FROM usage_report",
    "leave_alert_new": "SELECT * FROM new_alerts",
    "leave_alert_tracking": "SELECT DISTINCT emp_id FROM (SELECT emp_id FROM prev_alerts UNION ALL SELECT emp_id FROM new_alerts) u",
    # messages
    "message_validate": "SELECT * FROM x_message WHERE sender IS NOT NULL AND receiver IS NOT NULL AND message IS NOT NULL",
    "message_parse": "SELECT * FROM x_message WHERE sender IS NOT NULL AND receiver IS NOT NULL AND message IS NOT NULL",
    "message_flag": "SELECT * FROM flagged",
    "message_flag_vocab": f"""
SELECT sender, receiver, message FROM (SELECT *, row_number() OVER () AS mid FROM flagged) f
WHERE f.mid NOT IN (
  SELECT mid FROM (SELECT mid, unnest({tok('message')}) AS w FROM (SELECT *, row_number() OVER () AS mid FROM flagged) g) t
  WHERE w NOT IN (SELECT word FROM x_vocab))""",
    "strike_events": "SELECT * FROM ev",
    "strike_counts": "SELECT * FROM cnt",
    # strikes
    "strike_upsert": "SELECT employee_id, salary, no_of_strikes, is_inactive FROM upserted",
    "strike_penalties": "SELECT * FROM x_strikes_whole",
    "strike_deactivate": "SELECT * FROM batch_applied",
    "strike_penalties_frozen": "SELECT employee_id, salary, " + ", ".join(
        f"CASE WHEN strike_count >= {i} AND no_of_strikes < {i} THEN {ladder_step('salary', 'strike_count', i)} "
        f"WHEN strike_count < {i} THEN NULL ELSE strike_{i} END AS strike_{i}" for i in range(1, LADDER_STEPS + 1))
        + ", CAST(coalesce(strike_count, 0) AS INTEGER) AS no_of_strikes FROM with_totals",
    "strike_penalties_replace": f"""
SELECT employee_id, salary, {ladder('salary', 'strike_count')},
       CAST(coalesce(strike_count, 0) AS INTEGER) AS no_of_strikes FROM with_totals""",
    "strikes_sync_new": "SELECT * FROM sync_new",
    "strikes_sync_changed": "SELECT * FROM sync_changed",
    "strikes_sync": f"""
SELECT coalesce(s.employee_id, g.employee_id) AS employee_id,
       CASE WHEN g.employee_id IS NOT NULL THEN g.salary ELSE s.salary END AS salary,
       {", ".join(f"CASE WHEN g.employee_id IS NOT NULL THEN g.{c} ELSE s.{c} END AS {c}" for c in LADDER)},
       CAST(coalesce(CASE WHEN g.employee_id IS NOT NULL THEN g.no_of_strikes END, s.no_of_strikes, 0) AS INTEGER)
         AS no_of_strikes,
       CASE WHEN s.employee_id IS NULL THEN false ELSE s.is_inactive END AS is_inactive
FROM x_strikes s FULL OUTER JOIN (SELECT * FROM sync_new UNION ALL SELECT * FROM sync_changed) g
  ON s.employee_id = g.employee_id""",
    "strike_cooldown": f"""
SELECT employee_id, salary,
       {", ".join(f"CASE WHEN coalesce(is_inactive, false) THEN {c} END AS {c}" for c in LADDER)},
       CAST(CASE WHEN coalesce(is_inactive, false) THEN no_of_strikes ELSE 0 END AS INTEGER) AS no_of_strikes,
       is_inactive
FROM x_strikes_whole""",
    "flag_log_retention": """
SELECT employee_id, start_date FROM x_flag_log l
WHERE (l.start_date < TIMESTAMP '2024-01-11 00:00:00'
       AND l.employee_id IN (SELECT employee_id FROM x_strikes_whole WHERE NOT coalesce(is_inactive, false))) IS NOT TRUE""",
    "strike_leaderboard": """
SELECT employee_id, salary, no_of_strikes, strike_1, strike_2, strike_3, strike_4, strike_5, is_inactive
FROM x_strikes_whole ORDER BY no_of_strikes DESC NULLS LAST, employee_id ASC NULLS LAST LIMIT 20""",
    "strike_stats": """
SELECT count(*) AS total_employees, count(*) FILTER (WHERE no_of_strikes > 0) AS with_strikes,
       count(*) FILTER (WHERE is_inactive = true) AS suspended,
       coalesce(max(no_of_strikes), 0) AS max_strikes
FROM x_strikes_whole""",
    "flag_log_recent": """
SELECT employee_id, start_date FROM x_flag_log
ORDER BY start_date DESC NULLS LAST, employee_id ASC NULLS LAST LIMIT 10""",
    "suspended_report": """
SELECT employee_id, salary, no_of_strikes, strike_10 FROM x_strikes_whole WHERE is_inactive = true
ORDER BY no_of_strikes DESC NULLS LAST, employee_id ASC NULLS LAST LIMIT 10""",
    # streaming
    "stream_flag_log": "SELECT * FROM ev",
    "stream_strikes": "SELECT * FROM batch_applied",
    "stream_restart": "SELECT employee_id, count(*) AS logged, count(*) AS counted FROM ev GROUP BY employee_id",
    "stream_salary_enrich": "SELECT ev.employee_id, ev.role, sal.salary FROM ev LEFT JOIN sal ON ev.employee_id = sal.employee_id",
}

# Keys without an oracle get the driver's rows-only check. None at present.
NO_ORACLE: set[str] = set()


def oracle_sql() -> dict[str, str]:
    missing = [k for k in KEYS if k not in FINAL and k not in NO_ORACLE]
    if missing:
        raise KeyError(f"no oracle for {missing}")
    return {k: with_ctes(FINAL[k]) for k in KEYS if k in FINAL}
