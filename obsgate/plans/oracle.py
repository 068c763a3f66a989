"""DuckDB SQL computing the expected result of every query in ``tables``.

The SQL never parses text: it derives what the parse, routing, gates and
conversions must produce straight from the source columns and the defect
rules documented in ``obsgate.plans.tables``. Column names and types match
the Spark side.
"""

from __future__ import annotations

TAB = "chr(9)"


def _v(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _cat(*parts: str) -> str:
    return f" || {TAB} || ".join(parts)


# --- orders as layout-C lines ---------------------------------------------------

ORDERS = f"""
src AS (
  SELECT o_orderkey AS k, o_custkey,
         'orders_' || o_orderstatus || '.txt' AS file_name,
         CAST(year(o_orderdate) AS INTEGER) AS y,
         CAST(month(o_orderdate) AS INTEGER) AS m,
         CAST(day(o_orderdate) AS INTEGER) AS d,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS p
  FROM orders),
flags AS (
  SELECT *,
         (k % 97 = 0 OR k % 73 = 0) AS arity_bad,
         (k % 89 = 0 OR k % 79 = 0) AS type_bad,
         CASE WHEN k % 79 = 0 THEN {_v('y')} || '  ' ELSE {_v('y')} END AS t_year,
         CASE WHEN k % 89 = 0 THEN 'XXX' ELSE p END AS t_obs1,
         CASE WHEN k % 83 = 0 THEN '' ELSE {_v('k')} END AS t_obs3
  FROM src),
lines AS (
  SELECT *,
         CASE WHEN arity_bad AND type_bad THEN 'ARITY_TYPE' WHEN arity_bad THEN 'ARITY'
              WHEN type_bad THEN 'TYPE' END AS error_class,
         CASE WHEN k % 97 = 0 THEN base5
              WHEN k % 73 = 0 THEN base5 || {TAB} || t_obs3 || {TAB} || '0'
              ELSE base5 || {TAB} || t_obs3 END AS line
  FROM (SELECT *, {_cat('t_year', _v('m'), _v('d'), 't_obs1', _v('o_custkey'))} AS base5 FROM flags))
"""

PARSE_LINES_GOOD = f"""
WITH {ORDERS}
SELECT file_name, y AS YEAR, m AS MONTH, d AS DAY,
       CAST(p AS DOUBLE) AS OBSERVATION1, CAST(o_custkey AS DOUBLE) AS OBSERVATION2,
       CASE WHEN k % 83 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS OBSERVATION3
FROM lines WHERE error_class IS NULL
"""

PARSE_LINES_BAD = f"""
WITH {ORDERS}
SELECT file_name, line, error_class FROM lines WHERE error_class IS NOT NULL
"""

PARSE_PARTIAL_POLICY = f"""
WITH {ORDERS}
SELECT file_name,
       CASE WHEN k % 79 = 0 THEN NULL ELSE y END AS YEAR, m AS MONTH, d AS DAY,
       CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(p AS DOUBLE) END AS OBSERVATION1,
       CAST(o_custkey AS DOUBLE) AS OBSERVATION2,
       CASE WHEN k % 97 = 0 OR k % 83 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS OBSERVATION3,
       error_class
FROM lines
"""

# --- lineitem as temperature lines -------------------------------------------

LINEITEM = f"""
src AS (
  SELECT l_orderkey * 8 + l_linenumber AS k, l_orderkey, l_linenumber,
         'lineitem_' || l_returnflag || l_linestatus || '_1995_2001.txt' AS file_name,
         CAST(year(l_shipdate) AS INTEGER) AS y,
         CAST(month(l_shipdate) AS INTEGER) AS m,
         CAST(day(l_shipdate) AS INTEGER) AS d,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS qty,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
         CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS disc,
         CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) AS tax
  FROM (SELECT * FROM lineitem UNION ALL
        SELECT * FROM lineitem WHERE (l_orderkey * 8 + l_linenumber) % 103 = 0)),
flags AS (
  SELECT *,
         (k % 11 = 0 OR k % 19 = 0) AS arity_bad,
         (k % 17 = 0) AS type_bad,
         (k % 17 <> 0 AND k % 19 <> 0 AND k % 13 <> 0) AS ok,
         CASE WHEN k % 19 = 0 THEN '' ELSE {_v('y')} END AS t_year,
         CASE WHEN k % 17 = 0 THEN 'XXX' ELSE qty END AS t_morg,
         CASE WHEN k % 13 = 0 THEN '' ELSE price END AS t_noon
  FROM src),
rows_ AS (
  SELECT *,
         CASE WHEN arity_bad AND type_bad THEN 'ARITY_TYPE' WHEN arity_bad THEN 'ARITY'
              WHEN type_bad THEN 'TYPE' END AS err,
         CASE WHEN k % 11 = 0 THEN base6
              WHEN k % 19 = 0 THEN base6 || {TAB} || tax
              ELSE base6 || {TAB} || tax || {TAB} || {_v('l_linenumber')} || {TAB} || {_v('l_orderkey')}
         END AS line,
         CASE WHEN type_bad OR k % 19 = 0 THEN NULL ELSE y END AS YEAR,
         CASE WHEN type_bad THEN NULL ELSE m END AS MONTH,
         CASE WHEN type_bad THEN NULL ELSE d END AS DAY,
         CASE WHEN type_bad THEN NULL ELSE CAST(qty AS DOUBLE) END AS MORG_TEMP,
         CASE WHEN type_bad OR k % 13 = 0 THEN NULL ELSE CAST(price AS DOUBLE) END AS NOON_TEMP,
         CASE WHEN type_bad THEN NULL ELSE CAST(disc AS DOUBLE) END AS EVE_TEMP,
         CASE WHEN type_bad OR k % 11 = 0 THEN NULL ELSE CAST(tax AS DOUBLE) END AS MAX_TEMP,
         CASE WHEN type_bad OR k % 11 = 0 OR k % 19 = 0 THEN NULL
              ELSE CAST(l_linenumber AS DOUBLE) END AS MIN_TEMP,
         CASE WHEN type_bad OR k % 11 = 0 OR k % 19 = 0 THEN NULL
              ELSE CAST(l_orderkey AS DOUBLE) END AS MEAN_TEMP
  FROM (SELECT *, {_cat('t_year', _v('m'), _v('d'), 't_morg', 't_noon', 'disc')} AS base6 FROM flags))
"""

TEMP_COLS = "YEAR, MONTH, DAY, MORG_TEMP, NOON_TEMP, EVE_TEMP, MAX_TEMP, MIN_TEMP, MEAN_TEMP"
TEMP_NAN_FLAGS = """
       MAX_TEMP IS NULL AS MAX_TEMP_isnan,
       MIN_TEMP IS NULL AS MIN_TEMP_isnan,
       MEAN_TEMP IS NULL AS MEAN_TEMP_isnan"""

ACCEPT_ROUTE_KEEP = f"""
WITH {LINEITEM}
SELECT file_name, {TEMP_COLS},{TEMP_NAN_FLAGS}
FROM rows_ WHERE ok
"""

ACCEPT_ROUTE_BAD = f"""
WITH {LINEITEM}
SELECT file_name, line, COALESCE(err, 'MANDATORY_NULL') AS error_class
FROM rows_ WHERE NOT ok
"""

NAME_YEARS = """
  CASE WHEN len(string_split(file_name, '_')) > 5
       THEN TRY_CAST(string_split(file_name, '_')[5] AS INTEGER)
       ELSE TRY_CAST(string_split(file_name, '_')[3] AS INTEGER) END AS name_start_year,
  CASE WHEN len(string_split(file_name, '_')) > 5
       THEN TRY_CAST(string_split(file_name, '_')[6] AS INTEGER)
       WHEN length(string_split(file_name, '_')[4]) >= 4
       THEN TRY_CAST(substring(string_split(file_name, '_')[4], 1, 4) AS INTEGER) END AS name_end_year
"""

# Temperature files: every row's YEAR counts; accepted = covered.
TEMP_FILES = f"""
tfiles AS (
  SELECT *, CASE WHEN name_start_year IS NULL OR name_end_year IS NULL THEN 'BAD_NAME'
                 WHEN min_year IS NULL THEN 'NO_YEARS'
                 WHEN NOT (name_start_year = min_year AND name_end_year = max_year
                           AND name_end_year - name_start_year + 1 = year_count) THEN 'COVERAGE'
            END AS reason
  FROM (SELECT file_name, {NAME_YEARS}, min_year, max_year, year_count, n_rows
        FROM (SELECT file_name, min(YEAR) AS min_year, max(YEAR) AS max_year,
                     count(DISTINCT YEAR) AS year_count, count(*) AS n_rows
              FROM rows_ GROUP BY file_name))),
tkept AS (
  SELECT DISTINCT {TEMP_COLS},
         CASE WHEN YEAR BETWEEN 1756 AND 1858 THEN 'SMHI_STAFF'
              WHEN YEAR BETWEEN 1859 AND 1960 THEN 'IMPROVE'
              WHEN YEAR BETWEEN 1961 AND 2012 THEN 'SMHI'
              WHEN YEAR BETWEEN 2013 AND 2017 AND NOT starts_with(file_name, 'stockholmA') THEN 'MANUAL_STN'
              ELSE 'AUTOMATIC_STN' END AS PUBLISHED_CATEGORY
  FROM rows_ WHERE ok AND file_name IN (SELECT file_name FROM tfiles WHERE reason IS NULL))
"""

TEMPERATURE_LOAD = f"""
WITH {LINEITEM}, {TEMP_FILES}
SELECT {TEMP_COLS}, PUBLISHED_CATEGORY,{TEMP_NAN_FLAGS}
FROM tkept
"""

# --- orders as the barometer archive -----------------------------------------------

ARCHIVE = f"""
reg(file_name, first_year, n_years, split_range) AS (VALUES
  ('stockholm_barometer_1756_1858.txt', 1756, 103, '1756_1858'),
  ('stockholm_barometer_1859_1861.txt', 1859, 3, '1859_1861'),
  ('stockholm_barometer_1859_1861_copy.txt', 1859, 3, NULL),
  ('stockholm_barometer_1862_1937.txt', 1862, 76, '1862_1937'),
  ('stockholm_barometer_1938_1960.txt', 1938, 22, '1938_1960'),
  ('stockholm_barometer_1961_2012.txt', 1961, 52, '1961_2012'),
  ('stockholm_barometer_2013_2017.txt', 2013, 5, 'MAN_2013_2017'),
  ('stockholmA_barometer_2013_2017.txt', 2013, 5, 'AUTO_2013_2017')),
asrc AS (
  SELECT o_orderkey AS k, o_custkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'stockholm_barometer_1756_1858.txt'
              WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'
                   THEN 'stockholm_barometer_1859_1861_copy.txt'
              WHEN o_orderpriority = '2-HIGH' THEN 'stockholm_barometer_1859_1861.txt'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'stockholm_barometer_1862_1937.txt'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'stockholm_barometer_1938_1960.txt'
              WHEN o_orderstatus = 'P' THEN 'stockholmA_barometer_2013_2017.txt'
              WHEN o_orderstatus = 'F' THEN 'stockholm_barometer_2013_2017.txt'
              ELSE 'stockholm_barometer_1961_2012.txt' END AS file_name,
         CAST(month(o_orderdate) AS INTEGER) AS m,
         CAST(day(o_orderdate) AS INTEGER) AS d,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS p
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 101 = 0)),
arch AS (
  SELECT a.*, r.split_range, (r.split_range IS NOT NULL) AS known,
         CAST(r.first_year + a.k % r.n_years AS INTEGER) AS y,
         (r.split_range IS NOT NULL AND (a.k % 97 = 0 OR a.k % 89 = 0)) AS is_bad,
         (r.split_range IS NOT NULL AND a.k % 97 <> 0 AND a.k % 89 <> 0) AS is_good,
         CAST(substring(a.p, 1, length(a.p) - 1) AS DOUBLE) AS o1,
         CAST(a.o_custkey AS DOUBLE) AS o2,
         CASE WHEN a.k % 83 = 0 THEN NULL ELSE CAST(a.k AS DOUBLE) END AS o3
  FROM asrc a JOIN reg r USING (file_name)),
pfiles AS (
  SELECT *,
         CASE WHEN NOT known THEN 'UNKNOWN_FILE'
              WHEN n_bad = n_rows THEN 'ALL_CORRUPT'
              WHEN name_start_year IS NULL OR name_end_year IS NULL THEN 'BAD_NAME'
              WHEN min_year IS NULL THEN 'NO_YEARS'
              WHEN NOT (name_start_year = min_year AND name_end_year = max_year
                        AND name_end_year - name_start_year + 1 = year_count) THEN 'COVERAGE'
         END AS reason
  FROM (SELECT file_name, {NAME_YEARS}, known, min_year, max_year, year_count, n_rows, n_bad
        FROM (SELECT file_name, bool_or(known) AS known,
                     min(y) FILTER (WHERE is_good) AS min_year,
                     max(y) FILTER (WHERE is_good) AS max_year,
                     count(DISTINCT y) FILTER (WHERE is_good) AS year_count,
                     count(*) AS n_rows,
                     count(*) FILTER (WHERE is_bad) AS n_bad
              FROM arch GROUP BY file_name))),
good AS (SELECT * FROM arch WHERE is_good),
conv AS (
  SELECT *,
         {{conv1}} AS OBSERVATION1, {{conv2}} AS OBSERVATION2, {{conv3}} AS OBSERVATION3
  FROM good)
"""

FACTORS = {"1862_1937": "1.333224", "1756_1858": "33.8638896", "1859_1861": "3.38638896"}
REVERSE = {"1862_1937": ("0.75006", 1), "1756_1858": ("0.02953", 2), "1859_1861": ("0.2953", 1)}


def _round(x: str, factor: str, scale: int) -> str:
    return f"CAST(CAST({x} * CAST('{factor}' AS DOUBLE) AS DECIMAL(38,{scale})) AS DOUBLE)"


def _convert(x: str) -> str:
    whens = " ".join(f"WHEN '{r}' THEN {_round(x, f, 1)}" for r, f in FACTORS.items())
    return f"CASE split_range {whens} ELSE {x} END"


def _reverse(x: str) -> str:
    whens = " ".join(f"WHEN '{r}' THEN {_round(x, f, s)}" for r, (f, s) in REVERSE.items())
    return f"CASE split_range {whens} ELSE {x} END"


ARCHIVE = ARCHIVE.replace("{conv1}", _convert("o1")).replace("{conv2}", _convert("o2")).replace(
    "{conv3}", _convert("o3"))

COVERAGE_BY_FILE = f"""
WITH {ARCHIVE}
SELECT file_name, name_start_year, name_end_year, min_year, max_year, year_count, n_rows, n_bad, reason
FROM pfiles
"""

COVERAGE_ACCEPTED_ROWS = f"""
WITH {ARCHIVE}
SELECT file_name, y AS YEAR, m AS MONTH, d AS DAY
FROM good WHERE file_name IN (SELECT file_name FROM pfiles WHERE reason IS NULL)
"""

PROVENANCE_FLAG = f"""
WITH {ARCHIVE}
SELECT file_name, NOT starts_with(file_name, 'stockholmA') AS ISMANUAL, count(*) AS n_lines
FROM arch GROUP BY file_name
"""

RANGE_TAG = f"""
WITH {ARCHIVE}
SELECT file_name, split_range AS SPLIT_RANGE, count(*) AS n_lines
FROM arch GROUP BY file_name, split_range
"""

CATEGORIZE_YEAR = f"""
WITH {ARCHIVE}
SELECT file_name, y AS YEAR, m AS MONTH, d AS DAY,
       CASE WHEN y BETWEEN 1756 AND 1858 THEN 'SMHI_STAFF'
            WHEN y BETWEEN 1859 AND 1960 THEN 'IMPROVE'
            WHEN y BETWEEN 1961 AND 2012 THEN 'SMHI'
            WHEN y BETWEEN 2013 AND 2017 AND NOT starts_with(file_name, 'stockholmA') THEN 'MANUAL_STN'
            ELSE 'AUTOMATIC_STN' END AS PUBLISHED_CATEGORY
FROM good
"""

CANON = "y AS YEAR, m AS MONTH, d AS DAY, OBSERVATION1, OBSERVATION2, OBSERVATION3, split_range AS SPLIT_RANGE"

CONVERT_ROUND = f"""
WITH {ARCHIVE}
SELECT {CANON} FROM conv
"""

CONVERT_BACK_EXCEPT = f"""
WITH {ARCHIVE}
SELECT {_reverse('OBSERVATION1')} AS OBSERVATION1, {_reverse('OBSERVATION2')} AS OBSERVATION2,
       {_reverse('OBSERVATION3')} AS OBSERVATION3
FROM conv
EXCEPT
SELECT o1 AS OBSERVATION1, o2 AS OBSERVATION2, o3 AS OBSERVATION3
FROM good
"""

_INCH = {"1756_1858": repr(29.69 * 1.333224), "1859_1861": repr(29.69 * 1.333224 * 0.1)}
_OTHER = ", ".join(
    "CASE split_range " + " ".join(f"WHEN '{r}' THEN {_round(f'o{i}', f, 1)}" for r, f in _INCH.items())
    + f" ELSE OBSERVATION{i} END AS OBSERVATION{i}" for i in (1, 2, 3))
UNION_DISTINCT = f"""
WITH {ARCHIVE}
SELECT DISTINCT * FROM (SELECT {CANON} FROM conv UNION ALL
  SELECT y AS YEAR, m AS MONTH, d AS DAY, {_OTHER}, split_range AS SPLIT_RANGE FROM conv)
"""

SQL_DAYS = f"""
WITH {ARCHIVE}
SELECT DISTINCT split_range AS SPLIT_RANGE, y AS YEAR, m AS MONTH, d AS DAY FROM conv
"""

QUARANTINE_TWO_RUNS = f"""
WITH {ARCHIVE}
SELECT file_name, CASE WHEN k % 97 = 0 AND k % 89 = 0 THEN 'ARITY_TYPE' WHEN k % 97 = 0 THEN 'ARITY' ELSE 'TYPE' END
         AS error_class, 2 * count(*) AS n_lines, CAST(2 AS BIGINT) AS n_loads
FROM arch WHERE is_bad GROUP BY ALL
"""

PLOADED = """
ploaded AS (
  SELECT DISTINCT y AS YEAR, m AS MONTH, d AS DAY, OBSERVATION1, OBSERVATION2, OBSERVATION3,
         split_range AS SPLIT_RANGE
  FROM conv WHERE file_name IN (SELECT file_name FROM pfiles WHERE reason IS NULL))
"""

PRESSURE_LOAD = f"""
WITH {ARCHIVE}, {PLOADED}
SELECT YEAR, MONTH, DAY, OBSERVATION1, OBSERVATION2, OBSERVATION3, SPLIT_RANGE,
       OBSERVATION1 IS NULL AS OBSERVATION1_isnan,
       OBSERVATION2 IS NULL AS OBSERVATION2_isnan,
       OBSERVATION3 IS NULL AS OBSERVATION3_isnan
FROM ploaded
"""

DAILY = """
day_all AS (SELECT CAST(l_shipdate AS DATE) AS day, min(l_quantity) AS a, max(l_quantity) AS b, min(l_discount) AS c,
                   max(l_discount) AS d, min(l_tax) AS e, max(l_tax) AS f FROM lineitem GROUP BY 1),
day_returned AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_returnflag = 'R'),
td AS (
  SELECT CAST(2 AS BIGINT) AS files_seen, CAST(1 AS BIGINT) AS files_accepted,
    (SELECT count(*) + count(*) FILTER (WHERE day(day) = 1) FROM day_all)
      + (SELECT count(*) FROM day_returned) AS lines_read,
    (SELECT count(*) + count(*) FILTER (WHERE day(day) = 1) FROM day_all) AS rows_kept,
    CAST(0 AS BIGINT) AS rows_quarantined, (SELECT count(*) FROM day_all) AS rows_staged,
    false AS multi_record_days)
"""

TEMPERATURE_TABLE = f"""
WITH {DAILY}
SELECT CAST(year(day) AS INTEGER) AS YEAR, CAST(month(day) AS INTEGER) AS MONTH, CAST(day(day) AS INTEGER) AS DAY,
       {", ".join(f"CAST(CAST({x} AS DECIMAL(18,2)) AS DOUBLE) AS {n}" for x, n in zip("abcdef", (
           "MORG_TEMP", "NOON_TEMP", "EVE_TEMP", "MAX_TEMP", "MIN_TEMP", "MEAN_TEMP")))},
       CASE WHEN year(day) BETWEEN 1961 AND 2012 THEN 'SMHI' ELSE 'AUTOMATIC_STN' END AS PUBLISHED_CATEGORY,
       false AS MAX_TEMP_isnan, false AS MIN_TEMP_isnan, false AS MEAN_TEMP_isnan
FROM day_all
"""

LOAD_STATUS = f"""
WITH {LINEITEM}, {TEMP_FILES}, {ARCHIVE}, {PLOADED}, {DAILY},
t AS (
  SELECT
    (SELECT count(*) FROM tfiles) AS files_seen,
    (SELECT count(*) FROM tfiles WHERE reason IS NULL) AS files_accepted,
    (SELECT count(*) FROM rows_) AS lines_read,
    (SELECT count(*) FROM rows_ WHERE ok AND file_name IN
        (SELECT file_name FROM tfiles WHERE reason IS NULL)) AS rows_kept,
    (SELECT count(*) FROM rows_ WHERE NOT ok AND file_name IN
        (SELECT file_name FROM tfiles WHERE reason IS NULL)) AS rows_quarantined,
    (SELECT count(*) FROM tkept) AS rows_staged,
    EXISTS (SELECT 1 FROM tkept GROUP BY YEAR, MONTH, DAY HAVING count(*) > 1) AS multi_record_days),
p AS (
  SELECT
    (SELECT count(*) FROM pfiles) AS files_seen,
    (SELECT count(*) FROM pfiles WHERE reason IS NULL) AS files_accepted,
    (SELECT count(*) FROM arch) AS lines_read,
    (SELECT count(*) FROM good WHERE file_name IN
        (SELECT file_name FROM pfiles WHERE reason IS NULL)) AS rows_kept,
    (SELECT count(*) FROM arch WHERE is_bad) AS rows_quarantined,
    (SELECT count(*) FROM ploaded) AS rows_staged,
    EXISTS (SELECT 1 FROM ploaded GROUP BY YEAR, MONTH, DAY HAVING count(*) > 1) AS multi_record_days)
SELECT 'temperature' AS pipeline, files_seen, files_accepted, files_seen - files_accepted AS files_rejected,
       lines_read, rows_kept, rows_quarantined, CAST(0 AS BIGINT) AS rows_dropped, rows_staged,
       rows_kept - rows_staged AS rows_deduped, CASE WHEN (rows_staged > 0 AND NOT multi_record_days) THEN rows_staged ELSE 0 END AS rows_loaded,
       multi_record_days, CAST(NULL AS BOOLEAN) AS schema_ok, (rows_staged > 0 AND NOT multi_record_days) AS gates_passed, (rows_staged > 0 AND NOT multi_record_days) AS loaded
FROM t
UNION ALL
SELECT 'temperature' AS pipeline, files_seen, files_accepted, files_seen - files_accepted AS files_rejected,
       lines_read, rows_kept, rows_quarantined, CAST(0 AS BIGINT) AS rows_dropped, rows_staged,
       rows_kept - rows_staged AS rows_deduped, CASE WHEN (rows_staged > 0 AND NOT multi_record_days) THEN rows_staged ELSE 0 END AS rows_loaded,
       multi_record_days, CAST(NULL AS BOOLEAN) AS schema_ok, (rows_staged > 0 AND NOT multi_record_days) AS gates_passed, (rows_staged > 0 AND NOT multi_record_days) AS loaded
FROM td
UNION ALL
SELECT 'pressure' AS pipeline, files_seen, files_accepted, files_seen - files_accepted AS files_rejected,
       lines_read, rows_kept, rows_quarantined, CAST(0 AS BIGINT) AS rows_dropped, rows_staged,
       rows_kept - rows_staged AS rows_deduped, CASE WHEN (files_accepted > 0) THEN rows_staged ELSE 0 END AS rows_loaded,
       multi_record_days, CAST(NULL AS BOOLEAN) AS schema_ok, (files_accepted > 0) AS gates_passed, (files_accepted > 0) AS loaded
FROM p
"""

# --- plain table checks ---------------------------------------------------------

EVENTS_NULLS = """
ev AS (
  SELECT event_id,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id,
         event_id % 10 = 0 AS value_isnan,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value
  FROM events)
"""

NAN_FILL_COLS = f"WITH {EVENTS_NULLS} SELECT event_id, user_id, value, value_isnan FROM ev"
NAN_FILL_ALL = f"WITH {EVENTS_NULLS} SELECT event_id, COALESCE(user_id, 0) AS user_id, value, value_isnan FROM ev"

DUPLICATE_ROWS = """
SELECT text, lang, source, n_chars, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1
"""

MULTI_RECORD_DAYS = """
SELECT user_id, CAST(year(ts) AS INTEGER) AS YEAR, CAST(month(ts) AS INTEGER) AS MONTH,
       CAST(day(ts) AS INTEGER) AS DAY, count(*) AS n
FROM events GROUP BY ALL HAVING count(*) > 1
"""

DAY_RANK = """
SELECT o_orderkey, YEAR, MONTH, DAY,
       DENSE_RANK() OVER (ORDER BY MONTH NULLS FIRST, DAY NULLS FIRST, YEAR NULLS FIRST) AS day_rank
FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS YEAR,
             CAST(month(o_orderdate) AS INTEGER) AS MONTH, CAST(day(o_orderdate) AS INTEGER) AS DAY
      FROM orders)
"""

IN_RANGE = "COALESCE(" + " AND ".join(f"OBSERVATION{i} BETWEEN 938.4 AND 1063.7" for i in (1, 2, 3)) + ", false)"

RANGE_CHECK = f"""
WITH {ARCHIVE}
SELECT {CANON}, {IN_RANGE} AS in_range FROM conv
"""

RANGE_SUMMARY = f"""
WITH {ARCHIVE}
SELECT n_rows, n_in_range, n_rows - n_in_range AS n_out_of_range, n_in_range = n_rows AS all_in_range
FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE {IN_RANGE}) AS n_in_range FROM conv)
"""

ORACLE = {
    "parse_lines_good": PARSE_LINES_GOOD,
    "parse_lines_bad": PARSE_LINES_BAD,
    "parse_partial_policy": PARSE_PARTIAL_POLICY,
    "accept_route_keep": ACCEPT_ROUTE_KEEP,
    "accept_route_bad": ACCEPT_ROUTE_BAD,
    "coverage_by_file": COVERAGE_BY_FILE,
    "coverage_accepted_rows": COVERAGE_ACCEPTED_ROWS,
    "provenance_flag": PROVENANCE_FLAG,
    "range_tag": RANGE_TAG,
    "nan_fill_cols": NAN_FILL_COLS,
    "nan_fill_all": NAN_FILL_ALL,
    "categorize_year": CATEGORIZE_YEAR,
    "convert_round": CONVERT_ROUND,
    "convert_back_except": CONVERT_BACK_EXCEPT,
    "union_distinct": UNION_DISTINCT,
    "duplicate_rows": DUPLICATE_ROWS,
    "multi_record_days": MULTI_RECORD_DAYS,
    "day_rank": DAY_RANK,
    "range_check": RANGE_CHECK,
    "range_summary": RANGE_SUMMARY,
    "partitioned_roundtrip": CONVERT_ROUND,
    "quarantine_roundtrip": PARSE_LINES_BAD,
    "pressure_load": PRESSURE_LOAD,
    "temperature_load": TEMPERATURE_LOAD,
    "load_status": LOAD_STATUS,
    "temperature_table": TEMPERATURE_TABLE,
    "text_directory_load": PRESSURE_LOAD,
    "quarantine_two_runs": QUARANTINE_TWO_RUNS,
    "sql_days": SQL_DAYS,
}

# The converted rows' columns as they must come back from the table, with their values counted.
_COLUMNS = (("YEAR", "int", "y"), ("MONTH", "int", "m"), ("DAY", "int", "d"), ("OBSERVATION1", "double", "OBSERVATION1"),
            ("OBSERVATION2", "double", "OBSERVATION2"), ("OBSERVATION3", "double", "OBSERVATION3"),
            ("SPLIT_RANGE", "string", "split_range"))
ORACLE["schema_integrity"] = f"WITH {ARCHIVE}\n" + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS source_name, '{t}' AS source_type, '{n}' AS target_name, "
    f"'{t}' AS target_type, true AS matches, count(*) AS n_rows, count({c}) AS n_values FROM conv"
    for i, (n, t, c) in enumerate(_COLUMNS))
