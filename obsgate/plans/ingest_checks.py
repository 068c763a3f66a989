"""Checks of the loads' bookkeeping on the supplied tables: files, ledgers, states, catalog tables, gates.

Same conventions as :mod:`obsgate.plans.tables`: whole tables are rendered as observation
files, and the SQL in :mod:`obsgate.plans.ingest_oracle` derives the expected rows from the source columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from obsgate.functions.named import call_acceptable, register_acceptable
from obsgate.operators.parse import CORRUPT, parse_lines
from obsgate.operators.validate import coverage_from_state, duplicate_rows, merge_states
from obsgate.plans.common import FILE_KEYS
from obsgate.plans.pressure import PARTITION_COLS, load_pressure, parse_pressure, pressure_state, pressure_verdicts
from obsgate.plans.tables import convert_round, daily_lines, lineitem_lines, nan_as_flag, orders_lines, pressure_archive_lines, table
from obsgate.plans.temperature import load_temperature
from obsgate.sinks.parquet import LOAD_ID, new_load_id, scratch_path, stage, write_table
from obsgate.sinks.schema_gate import footer_layouts, other_files, remember, written_layouts
from obsgate.sources.csv import read_typed
from obsgate.sources.listing import read_ledger
from obsgate.sources.registry import PRESSURE_C, TEMPERATURE

LATE = "stockholm_barometer_1859_1861.txt"  # the file that one of two loads brings
EMPTY_FILE, BLANK_FILE = "stockholm_barometer_1700_1710.txt", "stockholm_barometer_1711_1720.txt"
MAXIMA = ["MAX_TEMP", "MIN_TEMP", "MEAN_TEMP"]


def _text_files(lines: DataFrame, path: str) -> str:
    """The lines as text files below ``path``, a folder ``file=<name>`` of part files for each."""
    lines.select("value", F.col("file_name").alias("file")).write.partitionBy("file").text(path)
    return path


def duplicate_micros(spark, sf_dir):
    """V2: events (without their key) once more a microsecond later, every fiftieth once more as it is: only the latter are duplicates."""
    e = table(spark, sf_dir, "events")
    again = e.filter(F.col("event_id") % 50 == 0)
    later = e.withColumn("ts", F.col("ts") + F.expr("INTERVAL 0.000001 SECOND"))
    rows = duplicate_rows(e.unionByName(again).unionByName(later).drop("event_id"))
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def file_report(spark, sf_dir):
    """The ledger of two loads; the second finds a file loaded before, one of no bytes and one of blank lines."""
    path, out, ledger = (scratch_path(spark, f"report-{n}") for n in ("text", "table", "ledger"))
    lines = pressure_archive_lines(spark, sf_dir)
    _text_files(lines, path)
    lines.limit(0).select("value").coalesce(1).write.text(f"{path}/file={EMPTY_FILE}")
    spark.range(3).select(F.lit(" \t").alias("value")).write.text(f"{path}/file={BLANK_FILE}")
    for run, source in (("1", f"{path}/file={LATE}"), ("2", path)):
        load_pressure(spark, source, out, unit="folder", ledger=ledger, load_id=run).release()
    rows = read_ledger(spark, ledger)
    return rows.select(F.col(LOAD_ID).cast("string").alias("load_id"), "file_name", "reason", "n_rows", "loaded", (F.col("length") == 0).alias("no_bytes"))


def coverage_two_loads(spark, sf_dir):
    """V1, A1, A2: every file's lines split over two loads; verdicts from their merged states."""
    parsed = stage(parse_pressure(pressure_archive_lines(spark, sf_dir)), "two-loads-parsed")
    half = F.pmod(F.xxhash64("file_name", "MONTH", "DAY", F.coalesce("YEAR", F.lit(0))), F.lit(2)) == 0
    states = [stage(pressure_state(parsed.filter(part)), "two-loads-state") for part in (half, ~half)]
    files = pressure_verdicts(coverage_from_state(merge_states(*states, keys=FILE_KEYS), FILE_KEYS))
    return files.select("file_name", "name_start_year", "name_end_year", "min_year", "max_year", "year_count", "n_rows", "n_bad", "reason")


def _table_name(kind: str) -> str:
    return f"obsgate_{kind}_{new_load_id()}"


def catalog_table(spark, sf_dir):
    """K1, K2, V7: daily rows published to a catalog table and read by name; a refused load before publishes nothing."""
    name, root = _table_name("temperature"), scratch_path(spark, "catalog-temperature")
    load_temperature(spark, daily_lines(spark, sf_dir), root, table=name, load_id="daily").release()
    load_temperature(spark, lineitem_lines(spark, sf_dir), root, table=name, load_id="refused").release()
    columns = ", ".join([*TEMPERATURE.names, "PUBLISHED_CATEGORY", LOAD_ID])
    rows = spark.sql(f"SELECT {columns} FROM {name} WHERE YEAR > 0")
    return nan_as_flag(rows, MAXIMA)


def incremental_load(spark, sf_dir):
    """The archive without one file, then all of it: the second load stores that file's rows only."""
    name, root = _table_name("pressure"), scratch_path(spark, "catalog-pressure")
    lines = pressure_archive_lines(spark, sf_dir)
    for run, part in (("first", lines.filter(F.col("file_name") != LATE)), ("second", lines)):
        load_pressure(spark, part, root, table=name, load_id=run).release()
    return spark.sql(f"SELECT {LOAD_ID} AS load_id, SPLIT_RANGE, count(*) AS n_rows, count(DISTINCT YEAR, MONTH, DAY) AS n_days FROM {name} GROUP BY ALL")


def layout_gate(spark, sf_dir):
    """V4, V7: files of a table whose footers differ from the rows to be stored, after one more file of each kind."""
    path, ledger = scratch_path(spark, "layout-table"), scratch_path(spark, "layout-ledger")
    rows = stage(convert_round(spark, sf_dir), "layout-rows")
    write_table(rows, path, PARTITION_COLS)
    remember(written_layouts(spark, path, rows.schema, PARTITION_COLS, ledger), ledger)
    one = rows.limit(1).drop(*PARTITION_COLS)
    other = {
        "same": one,
        "type": one.withColumn("DAY", F.col("DAY").cast("long")),
        "name": one.withColumnRenamed("DAY", "DAYS"),
        "order": one.select("DAY", "MONTH", *[c for c in one.columns if c not in ("DAY", "MONTH")]),
    }
    out = []
    for kind, df in other.items():
        df.coalesce(1).write.mode("append").parquet(f"{path}/SPLIT_RANGE={kind}/YEAR=1")
        differ = other_files(footer_layouts(spark, path, ledger), rows.schema, PARTITION_COLS)
        n = differ.agg(F.count(F.lit(1)).alias("files_that_differ"), F.max(F.regexp_extract("file_path", "SPLIT_RANGE=([^/]+)", 1)).alias("last_by_name"))
        out.append(stage(n.withColumn("added", F.lit(kind)), f"layout-{kind}"))
    counted = rows.agg(F.count(F.lit(1)).alias("n_rows"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3]).join(F.broadcast(counted))


def acceptable_by_name(spark, sf_dir):
    """UD1, F16, Q2: the mandatory-columns predicate called by name, from SQL text and from the DataFrame API."""
    name = register_acceptable(spark)
    parsed = parse_lines(lineitem_lines(spark, sf_dir), TEMPERATURE)
    parsed.withColumn("called", call_acceptable()).createOrReplaceTempView("parsed_temperature")
    return spark.sql(f"""
        SELECT file_name, {name}({", ".join(TEMPERATURE.mandatory)}) AS acceptable, count(*) AS n_lines, count_if(called) AS n_called
        FROM parsed_temperature GROUP BY ALL""")


def csv_source_rows(spark, sf_dir):
    """The order files written as text and read by the CSV source, corrupt lines captured."""
    path = _text_files(orders_lines(spark, sf_dir), scratch_path(spark, "csv-text"))
    return read_typed(spark, path, PRESSURE_C, unit="folder").select("file_name", *PRESSURE_C.names, F.col(CORRUPT).alias("corrupt_line"))


def temperature_quarantine(spark, sf_dir):
    """K4, Q3: bad lines of the lineitem files in the temperature quarantine, written and read back."""
    path = scratch_path(spark, "temperature-quarantine")
    load_temperature(spark, lineitem_lines(spark, sf_dir), None, path, load_id="k4").release()
    back = spark.read.options(header="true", inferSchema="false").csv(path)
    return back.select("file_name", "line", "error_class", F.col("isAcceptableNullColumns").cast("boolean").alias("acceptable"))


def temperature_text_load(spark, sf_dir):
    """Daily temperature files as text, a folder each, scanned, loaded and read back."""
    path, out = (scratch_path(spark, f"temperature-{n}") for n in ("text", "loaded"))
    load_temperature(spark, _text_files(daily_lines(spark, sf_dir), path), out, unit="folder").release()
    return nan_as_flag(spark.read.parquet(out).select(*TEMPERATURE.names, "PUBLISHED_CATEGORY"), MAXIMA)


QUERIES = {f.__name__: f for f in (
    duplicate_micros, file_report, coverage_two_loads, catalog_table, incremental_load, layout_gate, acceptable_by_name,
    csv_source_rows, temperature_quarantine, temperature_text_load)}
