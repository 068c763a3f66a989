"""DuckDB SQL of the expected rows of every query in ``ingest_checks``."""

from __future__ import annotations

from obsgate.plans.oracle import ARCHIVE, COVERAGE_BY_FILE, DAILY, LINEITEM, ORDERS, PLOADED, TEMP_FILES, TEMPERATURE_TABLE

LATE = "stockholm_barometer_1859_1861.txt"

ORACLE = {
    "duplicate_micros": """
WITH every AS (
  SELECT * FROM events UNION ALL BY NAME SELECT * FROM events WHERE event_id % 50 = 0
  UNION ALL BY NAME SELECT * REPLACE (ts + INTERVAL 1 MICROSECOND AS ts) FROM events),
n AS (SELECT * EXCLUDE (event_id), count(*) AS n FROM every GROUP BY ALL HAVING count(*) > 1)
SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM n""",
    "file_report": f"""
WITH {ARCHIVE}
SELECT '1' AS load_id, file_name, reason, n_rows, reason IS NULL AS loaded, false AS no_bytes FROM pfiles WHERE file_name = '{LATE}'
UNION ALL
SELECT '2' AS load_id, file_name, CASE WHEN again THEN 'REPEATED' ELSE reason END AS reason, CASE WHEN again THEN 0 ELSE n_rows END AS n_rows,
  reason IS NULL AND NOT again AND others > 0 AS loaded, false AS no_bytes
FROM (SELECT *, reason IS NULL AND file_name = '{LATE}' AS again, count(*) FILTER (WHERE reason IS NULL AND file_name <> '{LATE}') OVER () AS others FROM pfiles)
UNION ALL
SELECT '2' AS load_id, * FROM (VALUES ('stockholm_barometer_1700_1710.txt', 'EMPTY', CAST(0 AS BIGINT), false, true),
  ('stockholm_barometer_1711_1720.txt', 'EMPTY', CAST(0 AS BIGINT), false, false))""",
    "coverage_two_loads": COVERAGE_BY_FILE,
    "catalog_table": f"SELECT *, 'daily' AS LOAD_ID FROM ({TEMPERATURE_TABLE})",
    "incremental_load": f"""
WITH {ARCHIVE}, {PLOADED}
SELECT CASE WHEN SPLIT_RANGE = '1859_1861' THEN 'second' ELSE 'first' END AS load_id, SPLIT_RANGE, count(*) AS n_rows,
  count(DISTINCT (YEAR, MONTH, DAY)) AS n_days
FROM ploaded GROUP BY ALL""",
    "layout_gate": f"""
WITH {ARCHIVE}
SELECT added, CAST(files_that_differ AS BIGINT) AS files_that_differ, last_by_name, (SELECT count(*) FROM conv) AS n_rows
FROM (VALUES ('same', 0, NULL), ('type', 1, 'type'), ('name', 2, 'type'), ('order', 3, 'type')) t(added, files_that_differ, last_by_name)""",
    "acceptable_by_name": f"""
WITH {LINEITEM}
SELECT file_name, ok AS acceptable, count(*) AS n_lines, count(*) FILTER (WHERE ok) AS n_called FROM rows_ GROUP BY ALL""",
    "csv_source_rows": f"""
WITH {ORDERS}
SELECT file_name, CASE WHEN k % 79 = 0 THEN NULL ELSE y END AS YEAR, m AS MONTH, d AS DAY,
  CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(p AS DOUBLE) END AS OBSERVATION1, CAST(o_custkey AS DOUBLE) AS OBSERVATION2,
  CASE WHEN k % 97 = 0 OR k % 83 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS OBSERVATION3,
  CASE WHEN error_class IS NOT NULL THEN line END AS corrupt_line
FROM lines""",
    "temperature_quarantine": f"""
WITH {LINEITEM}, {TEMP_FILES}
SELECT file_name, line, COALESCE(err, 'MANDATORY_NULL') AS error_class, false AS acceptable
FROM rows_ WHERE NOT ok AND file_name IN (SELECT file_name FROM tfiles WHERE reason IS NULL)""",
    "temperature_text_load": TEMPERATURE_TABLE,
}
