"""DuckDB twins of the queries on the change list."""

from __future__ import annotations

CHANGES = """
changes AS (
  SELECT CAST(event_id AS VARCHAR) AS change_id, CASE WHEN event_type IN ('purchase', 'click', 'error') AND event_id % 19 = 0 THEN NULL
              WHEN user_id % 2 = 0 THEN user_id ELSE -user_id END AS record_id, ts AS change_time,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'update'
              WHEN 'click' THEN 'update' WHEN 'error' THEN 'delete' ELSE 'unknown' END AS operation,
         CASE WHEN event_type <> 'signup' OR event_id % 17 <> 0
              THEN CAST(floor(value / 20) AS BIGINT) END AS value
  FROM events),
base AS (
  SELECT c_custkey AS record_id, CAST(floor(c_acctbal / 1000) AS BIGINT) AS value
  FROM customer)
"""


def replay_ctes(source: str) -> str:
    return f"""
joined AS (
  SELECT c.*, b.record_id IS NOT NULL AS in_base, b.value AS base_value
  FROM {source} c LEFT JOIN base b USING (record_id)),
living AS (
  SELECT *, coalesce(last_value(CASE WHEN operation = 'delete' THEN false
      WHEN operation = 'insert' AND value IS NOT NULL THEN true END IGNORE NULLS) OVER w, in_base) AS present
  FROM joined
  WINDOW w AS (PARTITION BY record_id ORDER BY change_time, change_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
written AS (
  SELECT *, CASE WHEN (operation = 'insert' AND NOT present)
                   OR (operation = 'update' AND present) THEN value END AS set_value
  FROM living),
valued AS (
  SELECT *, coalesce(last_value(set_value IGNORE NULLS) OVER w, base_value) AS before_value
  FROM written
  WINDOW w AS (PARTITION BY record_id ORDER BY change_time, change_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (
  SELECT *, CASE WHEN operation = 'unknown' THEN 'unknown'
      WHEN operation = 'insert' AND value IS NULL THEN 'invalid'
      WHEN record_id IS NULL THEN 'missing_id'
      WHEN operation = 'insert' THEN CASE WHEN present THEN 'duplicate' ELSE 'ok' END
      WHEN NOT present THEN 'missing'
      WHEN operation = 'update' AND value = before_value THEN 'unchanged'
      ELSE 'ok' END AS outcome
  FROM valued),
outcomes AS (
  SELECT *, CASE WHEN outcome = 'ok' AND operation <> 'insert' THEN before_value END AS old_value,
         CASE WHEN outcome = 'ok' AND operation <> 'delete' THEN value END AS new_value,
         CASE WHEN outcome <> 'ok' THEN '' WHEN operation = 'insert' THEN 'record_id,value'
              WHEN operation = 'update' THEN 'value' ELSE '' END AS fields
  FROM judged)
"""


REPLAY = f"{CHANGES},{replay_ctes('changes')}"
SHOWN = "strftime(change_time, '%Y-%m-%d %H:%M:%S.%f')"


def row_json(value: str) -> str:
    return f"""'{{"record_id":' || record_id || ',"value":' || {value} || '}}'"""


LOG = f"""{REPLAY},
log AS (
  SELECT change_id, record_id, operation, change_time,
         CASE WHEN operation <> 'insert' THEN {row_json('old_value')} END AS old_data,
         CASE WHEN operation <> 'delete' THEN {row_json('new_value')} END AS new_data,
         CASE operation WHEN 'insert' THEN '["record_id","value"]' WHEN 'update' THEN '["value"]'
              ELSE '[]' END AS changed_fields,
         true AS user_triggered, fields
  FROM outcomes WHERE outcome = 'ok')
"""
LOG_VIEW = f"""SELECT change_id, record_id, operation, {SHOWN} AS change_time,
  fields AS changed_fields, user_triggered FROM log"""
NEWEST = "ORDER BY log.change_time DESC, change_id"
MESSAGE = f"""'{{"operation":"' || operation || '","timestamp":"' ||
  strftime(change_time, '%Y-%m-%dT%H:%M:%S.%f') || '","change_id":"' || change_id ||
  '","record_id":' || record_id ||
  CASE operation
    WHEN 'insert' THEN ',"data":' || {row_json('new_value')}
    WHEN 'delete' THEN ',"data":' || {row_json('old_value')}
    ELSE ',"old_data":' || {row_json('old_value')} || ',"new_data":' || {row_json('new_value')}
         || ',"changed_fields":["value"]' END ||
  ',"user_triggered":true,"affected_rows":1}}'"""
BROKEN_TEXT = """substr('{"operation":"' || operation || '","timestamp":"', 1, 20)"""

ORACLES = {
    "apply_outcomes": f"""WITH {REPLAY}
        SELECT change_id, CAST(record_id AS VARCHAR) AS record_id, operation, outcome, CAST(old_value AS VARCHAR) AS old_value,
          CAST(new_value AS VARCHAR) AS new_value FROM outcomes""",
    "apply_changes": f"""WITH {REPLAY},
        ends AS (
          SELECT record_id, any_value(in_base) AS in_base, any_value(base_value) AS base_value,
            arg_max(operation = 'insert', (change_time, change_id))
              FILTER (operation = 'delete' OR operation = 'insert' AND value IS NOT NULL) AS live,
            arg_max(set_value, (change_time, change_id)) FILTER (set_value IS NOT NULL) AS value
          FROM written WHERE record_id IS NOT NULL GROUP BY record_id)
        SELECT record_id, value FROM base WHERE record_id NOT IN (SELECT record_id FROM changes WHERE record_id IS NOT NULL)
        UNION ALL
        SELECT record_id, coalesce(value, base_value) FROM ends WHERE coalesce(live, in_base)""",
    "changed_fields": f"""WITH {REPLAY}
        SELECT change_id, operation, fields AS changed_fields FROM outcomes WHERE outcome = 'ok'""",
    "insert_rows": f"""WITH {CHANGES} SELECT * FROM base UNION ALL
        SELECT (SELECT max(record_id) FROM base)
               + row_number() OVER (ORDER BY change_time, change_id), value
        FROM changes WHERE operation = 'insert' AND value IS NOT NULL""",
    "update_rows": f"""WITH {CHANGES}, news AS (
          SELECT record_id, arg_max(value, (change_time, change_id)) AS new_value
          FROM changes WHERE operation = 'update' GROUP BY record_id)
        SELECT record_id, coalesce(new_value, value) AS value FROM base LEFT JOIN news USING (record_id)""",
    "delete_rows": f"""WITH {CHANGES} SELECT * FROM base
        WHERE record_id NOT IN (SELECT record_id FROM changes
          WHERE operation = 'delete' AND record_id IS NOT NULL)""",
    "change_messages": f"""WITH {REPLAY}
        SELECT CAST(record_id AS VARCHAR) AS key, {MESSAGE} AS value
        FROM outcomes WHERE outcome = 'ok'""",
    "change_log_rows": f"""WITH {LOG} SELECT change_id, record_id, operation,
        {SHOWN} AS change_time, old_data, new_data, changed_fields, user_triggered FROM log""",
    "change_history": f"WITH {LOG} {LOG_VIEW} {NEWEST} LIMIT 50",
    "changes_since": f"""WITH {LOG} {LOG_VIEW}
        WHERE log.change_time > TIMESTAMP '2024-01-15 00:00:00' {NEWEST} LIMIT 100""",
    "change_summary": f"""WITH {REPLAY} SELECT count(*) AS total,
        count(*) FILTER (outcome = 'ok') AS success, count(*) FILTER (outcome <> 'ok') AS failed
        FROM outcomes""",
    "parse_changes": f"""WITH {CHANGES} SELECT
          CASE WHEN good THEN change_id END AS change_id,
          CASE WHEN good THEN CAST(record_id AS VARCHAR) END AS record_id,
          CASE WHEN good THEN {SHOWN} END AS change_time,
          CASE WHEN good THEN operation END AS operation,
          CASE WHEN good THEN CAST(value AS VARCHAR) END AS value,
          CASE WHEN good THEN 'true' END AS user_triggered,
          NOT good AS is_error, CASE WHEN NOT good THEN {BROKEN_TEXT} END AS raw
        FROM (SELECT *, CAST(change_id AS BIGINT) % 50 <> 0 AS good FROM changes)""",
    "change_counters": f"""WITH {CHANGES},
        readable AS (SELECT * FROM changes
          WHERE CAST(change_id AS BIGINT) % 50 <> 0),
        broken AS (SELECT count(*) AS errors FROM changes
          WHERE CAST(change_id AS BIGINT) % 50 = 0),
        {replay_ctes('readable')}
        SELECT count(*) AS processed,
          count(*) FILTER (outcome = 'ok' AND operation = 'insert') AS insert_processed,
          count(*) FILTER (outcome = 'ok' AND operation = 'update') AS update_processed,
          count(*) FILTER (outcome = 'ok' AND operation = 'delete') AS delete_processed,
          count(*) FILTER (outcome <> 'ok') AS failed, any_value(errors) AS errors,
          strftime(max(change_time), '%Y-%m-%d %H:%M:%S.%f') AS last_time,
          round(100.0::DOUBLE * count(*) / (count(*) + any_value(errors)), 1) AS success_rate
        FROM outcomes, broken""",
    "parse_changed_fields": """SELECT event_id,
        CAST(CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN 0 ELSE 2 END AS INTEGER) AS n_fields,
        CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN '' ELSE event_type || ',value' END
          AS fields FROM events""",
    "change_ids": f"""WITH {CHANGES}, made AS (SELECT *, md5(concat_ws('|', coalesce('=' || record_id, '-'), '=' || epoch_us(change_time),
          '=' || operation, coalesce('=' || value, '-'))) AS d FROM changes)
        SELECT CASE WHEN CAST(change_id AS BIGINT) % 3 = 0 THEN change_id
          ELSE concat_ws('-', d[1:8], d[9:12], d[13:16], d[17:20], d[21:32]) END AS change_id,
          CAST(record_id AS VARCHAR) AS record_id, {SHOWN} AS change_time, operation FROM made""",
    "parse_times": """SELECT event_id, CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 THEN NULL
        WHEN event_id % 29 = 0 THEN strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f')
        WHEN event_id % 2 = 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f')
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events""",
}

ORACLES["profile_after_changes"] = f"""WITH final AS ({ORACLES['apply_changes']}),
    rows AS (SELECT record_id, CAST(value AS BIGINT) AS value, ((record_id % 7) + 7) % 7 AS rest FROM final),
    named AS (SELECT *, CASE WHEN value >= 5 THEN 'high' ELSE 'low' END AS label FROM rows),
    twice AS (SELECT * FROM named UNION ALL SELECT * REPLACE ('all' AS label) FROM named),
    pairs AS (SELECT label, 'value' AS f, 'value' AS g, value AS x, value AS y FROM twice
      UNION ALL SELECT label, 'value', 'rest', value, rest FROM twice UNION ALL SELECT label, 'rest', 'rest', rest, rest FROM twice)
    SELECT label, f, g, count(*) AS n, round(avg(x), 6) AS mean_f, round(avg(y), 6) AS mean_g,
      round(covar_pop(x, y), 6) AS covariance, round(corr(x, y), 6) AS r FROM pairs GROUP BY label, f, g"""
