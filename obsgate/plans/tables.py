"""Checks of every operator on the supplied tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame. Whole
tables are rendered as header-less text lines (a "virtual directory" of
observation files), then run through the same operators a real load uses.
Every row of every table is used; deterministic defects (short/long rows,
bad tokens, blanks) are written into some lines by key arithmetic so the
parse, routing and gates have something to catch. The matching SQL in
``obsgate.plans.oracle`` derives the expected result from the source
columns directly.

NaN has no portable text form in result comparisons, so columns that can
hold NaN are reported as a NULL-for-NaN value plus a ``<col>_isnan`` flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obsgate.operators.parse import ERROR_CLASS, parse_lines
from obsgate.operators.route import QUARANTINE_COLUMNS, route_pressure, route_temperature
from obsgate.operators.transform import (
    categorize_publisher,
    convert_back,
    dedupe,
    fill_missing,
    fill_nan,
    merge,
    to_hpa,
)
from obsgate.operators.validate import (
    accepted_rows,
    day_rank as day_rank_op,
    duplicate_rows as duplicate_rows_op,
    multi_record_days as multi_record_days_op,
    range_check as range_check_op,
    range_summary as range_summary_op,
    roundtrip_mismatches,
    schema_diff,
)
from obsgate.plans.batch import load_all
from obsgate.plans.pressure import load_pressure, parse_pressure, pressure_files, range_of
from obsgate.plans.temperature import load_temperature
from obsgate.sinks.parquet import scratch_path, stage, write_quarantine, write_table
from obsgate.sources.registry import (
    MAX_AIR_PRESSURE_HPA,
    MIN_AIR_PRESSURE_HPA,
    PRESSURE_C,
    PRESSURE_CANONICAL,
    TEMPERATURE,
)
from obsgate.sources.text import read_lines, with_provenance

TAB = "\t"
SWEDISH_INCH = 29.69  # mm; the other conversion of union_distinct
OBS = ["OBSERVATION1", "OBSERVATION2", "OBSERVATION3"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _dec2(c: Column) -> Column:
    return _s(c.cast("decimal(18,2)"))


def _join(*tokens: Column) -> Column:
    return F.concat_ws(TAB, *tokens)


def nan_as_flag(df: DataFrame, cols) -> DataFrame:
    """Replace NaN by NULL in ``cols`` and add ``<col>_isnan`` flags."""
    out = {}
    for c in cols:
        out[f"{c}_isnan"] = F.coalesce(F.isnan(F.col(c)), F.lit(False))
        out[c] = F.when(~F.isnan(F.col(c)), F.col(c))
    return df.withColumns(out)


# ---------------------------------------------------------------------------
# Virtual observation files derived from the tables
# ---------------------------------------------------------------------------

def orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as layout-C lines, one file per order status.

    Defects by order key k: k%97=0 last token missing; k%73=0 (and not
    k%97=0) one token too many; k%89=0 first reading 'XXX'; k%79=0 year with
    trailing blanks; k%83=0 third reading blank.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_custkey", "o_orderstatus")
    k = F.col("o_orderkey")
    y = _s(F.year("o_orderdate"))
    t_year = F.when(k % 79 == 0, F.concat(y, F.lit("  "))).otherwise(y)
    t_obs1 = F.when(k % 89 == 0, F.lit("XXX")).otherwise(_dec2(F.col("o_totalprice")))
    t_obs3 = F.when(k % 83 == 0, F.lit("")).otherwise(_s(k))
    base5 = _join(t_year, _s(F.month("o_orderdate")), _s(F.dayofmonth("o_orderdate")), t_obs1,
                  _s(F.col("o_custkey")))
    line = (
        F.when(k % 97 == 0, base5)
        .when(k % 73 == 0, _join(base5, t_obs3, F.lit("0")))
        .otherwise(_join(base5, t_obs3))
    )
    return o.select(line.alias("value"),
                    F.concat(F.lit("orders_"), F.col("o_orderstatus"), F.lit(".txt")).alias("file_name"))


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as temperature lines, one file per (return flag, line status).

    k = 8*l_orderkey + l_linenumber. Defects: k%11=0 only six tokens (still
    acceptable); k%19=0 blank year and seven tokens; k%13=0 blank noon
    reading (right arity, not acceptable); k%17=0 morning reading 'XXX'.
    Lines with k%103=0 come twice.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    y = _s(F.year("l_shipdate"))
    t_year = F.when(k % 19 == 0, F.lit("")).otherwise(y)
    morg = F.when(k % 17 == 0, F.lit("XXX")).otherwise(_dec2(F.col("l_quantity")))
    noon = F.when(k % 13 == 0, F.lit("")).otherwise(_dec2(F.col("l_extendedprice")))
    base6 = _join(t_year, _s(F.month("l_shipdate")), _s(F.dayofmonth("l_shipdate")), morg, noon,
                  _dec2(F.col("l_discount")))
    t_max = _dec2(F.col("l_tax"))
    line = (
        F.when(k % 11 == 0, base6)
        .when(k % 19 == 0, _join(base6, t_max))
        .otherwise(_join(base6, t_max, _s(F.col("l_linenumber")), _s(F.col("l_orderkey"))))
    )
    name = F.concat(F.lit("lineitem_"), F.col("l_returnflag"), F.col("l_linestatus"), F.lit("_1995_2001.txt"))
    return _doubled(li.select(line.alias("value"), name.alias("file_name"), (k % 103 == 0).alias("twice")))


def _doubled(lines: DataFrame) -> DataFrame:
    """Lines marked ``twice`` once more."""
    copies = F.when(F.col("twice"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.withColumn("copy", F.explode(copies)).drop("copy", "twice")


def daily_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as daily temperature files: one line per shipping day.

    ``daily_all_1995_2001.txt`` has every day (those of the first of a month
    twice, as equal lines); ``daily_returned_1990_2001.txt``, of the days
    with returned items, lacks years of its name and fails coverage.
    """
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    day = F.col("l_shipdate").cast("date").alias("day")
    stats = [F.min("l_quantity").alias("a"), F.max("l_quantity").alias("b"), F.min("l_discount").alias("c"),
             F.max("l_discount").alias("d"), F.min("l_tax").alias("e"), F.max("l_tax").alias("f")]
    every = li.groupBy(day).agg(*stats).withColumn("file_name", F.lit("daily_all_1995_2001.txt"))
    returned = (li.filter(F.col("l_returnflag") == "R").groupBy(day).agg(*stats)
                .withColumn("file_name", F.lit("daily_returned_1990_2001.txt")))
    rows = every.unionByName(returned)
    line = _join(_s(F.year("day")), _s(F.month("day")), _s(F.dayofmonth("day")), *[_dec2(F.col(c)) for c in "abcdef"])
    twice = (F.dayofmonth("day") == 1) & F.col("file_name").startswith("daily_all")
    return _doubled(rows.select(line.alias("value"), "file_name", twice.alias("twice")))


# FIXED VALUES of the virtual barometer archive: order priority (and status)
# -> file; file -> first year and number of years its YEAR tokens cycle over.
ARCHIVE_FILES = (
    ("stockholm_barometer_1756_1858.txt", 1756, 103),
    ("stockholm_barometer_1859_1861.txt", 1859, 3),
    ("stockholm_barometer_1859_1861_copy.txt", 1859, 3),
    ("stockholm_barometer_1862_1937.txt", 1862, 76),
    ("stockholm_barometer_1938_1960.txt", 1938, 22),
    ("stockholm_barometer_1961_2012.txt", 1961, 52),
    ("stockholm_barometer_2013_2017.txt", 2013, 5),
    ("stockholmA_barometer_2013_2017.txt", 2013, 5),
)


def archive_file(priority: Column, status: Column) -> Column:
    return (
        F.when(priority == "1-URGENT", F.lit("stockholm_barometer_1756_1858.txt"))
        .when((priority == "2-HIGH") & (status == "P"), F.lit("stockholm_barometer_1859_1861_copy.txt"))
        .when(priority == "2-HIGH", F.lit("stockholm_barometer_1859_1861.txt"))
        .when(priority == "3-MEDIUM", F.lit("stockholm_barometer_1862_1937.txt"))
        .when(priority == "4-NOT SPECIFIED", F.lit("stockholm_barometer_1938_1960.txt"))
        .when(status == "P", F.lit("stockholmA_barometer_2013_2017.txt"))
        .when(status == "F", F.lit("stockholm_barometer_2013_2017.txt"))
        .otherwise(F.lit("stockholm_barometer_1961_2012.txt"))
    )


def pressure_archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a directory of barometer files in all three layouts.

    Readings: o1 = order price cut to one decimal, o2 = customer key,
    o3 = order key. YEAR = first year + k % years. Defects: k%97=0 last token
    missing, k%89=0 o1 'XXX', k%83=0 o3 blank. 1938_1960 cycles over 22 of
    its 23 years (fails coverage); the ``_copy`` file is not in the registry.
    Lines with k%101=0 come twice.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    firsts = F.create_map(*[F.lit(x) for name, first, _ in ARCHIVE_FILES for x in (name, first)])
    spans = F.create_map(*[F.lit(x) for name, _, years in ARCHIVE_FILES for x in (name, years)])
    step = o.select(
        k,
        archive_file(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("file_name"),
        F.month("o_orderdate").alias("m"),
        F.dayofmonth("o_orderdate").alias("d"),
        _dec2(F.col("o_totalprice")).alias("p"),
        "o_custkey",
    )
    fname = F.col("file_name")
    year = F.element_at(firsts, fname) + k % F.element_at(spans, fname)
    p = F.col("p")
    o1 = F.when(k % 89 == 0, F.lit("XXX")).otherwise(F.substring(p, 1, F.length(p) - 1))
    o2 = _s(F.col("o_custkey"))
    o3 = F.when(k % 83 == 0, F.lit("")).otherwise(_s(k))
    date = [_s(year), _s(F.col("m")), _s(F.col("d"))]
    nan = F.lit("NaN")
    layout_a = F.array(*date, o1, F.lit("13.0"), o1, o2, F.lit("18.0"), o2, o3, F.lit("17.9"), o3)
    layout_b = F.array(*date, o1, nan, o2, nan, o3, nan)
    layout_c = F.array(*date, o1, o2, o3)
    toks = (
        F.when(fname == "stockholm_barometer_1859_1861.txt", layout_a)
        .when(fname == "stockholm_barometer_1756_1858.txt", layout_b)
        .otherwise(layout_c)
    )
    toks = F.when(k % 97 == 0, F.slice(toks, 1, F.size(toks) - 1)).otherwise(toks)
    return _doubled(step.select(F.concat_ws(TAB, toks).alias("value"), fname, (k % 101 == 0).alias("twice")))


# ---------------------------------------------------------------------------
# Queries (one per operator group)
# ---------------------------------------------------------------------------

def parse_lines_good(spark, sf_dir):
    """Typed good rows."""
    good, _ = route_pressure(parse_lines(orders_lines(spark, sf_dir), PRESSURE_C))
    return good.select("file_name", *PRESSURE_C.names)


def parse_lines_bad(spark, sf_dir):
    """Quarantined raw lines with their error class."""
    _, bad = route_pressure(parse_lines(orders_lines(spark, sf_dir), PRESSURE_C))
    return bad.select(*QUARANTINE_COLUMNS)


def parse_partial_policy(spark, sf_dir):
    """E1: 'partial' keeps the parseable tokens of TYPE-failed rows."""
    parsed = parse_lines(orders_lines(spark, sf_dir), PRESSURE_C, policy="partial")
    return parsed.select("file_name", *PRESSURE_C.names, F.col(ERROR_CLASS).alias("error_class"))


def _temperature_routed(spark, sf_dir):
    parsed = with_provenance(parse_lines(lineitem_lines(spark, sf_dir), TEMPERATURE))
    return route_temperature(fill_nan(parsed, ["MAX_TEMP", "MIN_TEMP", "MEAN_TEMP"]))


def accept_route_keep(spark, sf_dir):
    """Kept temperature rows (short rows with mandatory values included)."""
    kept, _ = _temperature_routed(spark, sf_dir)
    return nan_as_flag(kept.select("file_name", *TEMPERATURE.names), ["MAX_TEMP", "MIN_TEMP", "MEAN_TEMP"])


def accept_route_bad(spark, sf_dir):
    """Quarantined temperature lines (MANDATORY_NULL for blank mandatory values)."""
    _, bad = _temperature_routed(spark, sf_dir)
    return bad.select(*QUARANTINE_COLUMNS)


def coverage_by_file(spark, sf_dir):
    """Per-file verdicts of the barometer archive."""
    files = pressure_files(parse_pressure(pressure_archive_lines(spark, sf_dir)))
    return files.select("file_name", "name_start_year", "name_end_year", "min_year", "max_year",
                        "year_count", "n_rows", "n_bad", "reason")


def coverage_accepted_rows(spark, sf_dir):
    """Good rows of the accepted files only (left-semi join on verdicts)."""
    # Staged once: the verdicts and the rows read the same parsed lines, the join the verdicts' true size.
    parsed = stage(parse_pressure(pressure_archive_lines(spark, sf_dir)), "accepted-rows-parsed")
    good, _ = route_pressure(parsed)
    return accepted_rows(good, stage(pressure_files(parsed), "accepted-rows-files"), "file_path").select("file_name", "YEAR", "MONTH", "DAY")


def provenance_flag(spark, sf_dir):
    """manual/automatic station flag per file, with its line count."""
    lines = with_provenance(pressure_archive_lines(spark, sf_dir))
    return lines.groupBy("file_name", "ISMANUAL").agg(F.count(F.lit(1)).alias("n_lines"))


def range_tag(spark, sf_dir):
    """Year-range label of each line's file, with line counts."""
    lines = pressure_archive_lines(spark, sf_dir)
    tagged = lines.withColumn("SPLIT_RANGE", range_of(F.col("file_name")))
    return tagged.groupBy("file_name", "SPLIT_RANGE").agg(F.count(F.lit(1)).alias("n_lines"))


def _events_with_nulls(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        "event_id",
        F.when(k % 13 != 0, F.col("user_id")).alias("user_id"),
        F.when(k % 10 != 0, F.col("value")).alias("value"),
    )


def nan_fill_cols(spark, sf_dir):
    """NULL -> NaN in the chosen columns only (user_id stays NULL)."""
    return nan_as_flag(fill_nan(_events_with_nulls(spark, sf_dir), ["value"]), ["value"])


def nan_fill_all(spark, sf_dir):
    """Every numeric column: doubles NULL -> NaN, integers NULL -> 0."""
    return nan_as_flag(fill_missing(_events_with_nulls(spark, sf_dir)), ["value"])


def _archive_good(spark, sf_dir):
    good, _ = route_pressure(parse_pressure(pressure_archive_lines(spark, sf_dir)))
    return good.filter(F.col("SPLIT_RANGE").isNotNull())


def categorize_year(spark, sf_dir):
    """Publisher category by year band and station kind."""
    good = with_provenance(_archive_good(spark, sf_dir))
    return categorize_publisher(good).select("file_name", "YEAR", "MONTH", "DAY", "PUBLISHED_CATEGORY")


def convert_round(spark, sf_dir):
    """Readings in hPa, rounded where converted, canonical columns."""
    return to_hpa(_archive_good(spark, sf_dir))


def convert_back_except(spark, sf_dir):
    """Reverse-converted readings that do not round-trip (EXCEPT DISTINCT)."""
    # Staged once: both sides of the EXCEPT read the same parsed rows.
    good = stage(_archive_good(spark, sf_dir), "roundtrip-good")
    source_cols = {
        "1756_1858": ("BARO_OBS1", "BARO_OBS2", "BARO_OBS3"),
        "1859_1861": ("REDUCED_AIR_PRESSURE1", "REDUCED_AIR_PRESSURE2", "REDUCED_AIR_PRESSURE3"),
    }
    source = good.select(*[
        F.coalesce(*[F.when(F.col("SPLIT_RANGE") == r, F.col(cols[i])) for r, cols in source_cols.items()],
                   F.when(~F.col("SPLIT_RANGE").isin(*source_cols), F.col(OBS[i])))
        .alias(f"OBSERVATION{i + 1}") for i in range(3)
    ])
    return roundtrip_mismatches(convert_back(to_hpa(good)), source)


def union_distinct(spark, sf_dir):
    """Two conversions that differ in two ranges only (inch of 25.4 and of
    29.69 mm), merged, then de-duplicated."""
    good = _archive_good(spark, sf_dir)
    return dedupe(merge(to_hpa(good), to_hpa(good, swedish_inch_mm=SWEDISH_INCH)))


def duplicate_rows(spark, sf_dir):
    """V2: rows of documents that occur more than once, over all columns but the key."""
    return duplicate_rows_op(table(spark, sf_dir, "documents").drop("doc_id"))


def multi_record_days(spark, sf_dir):
    """V3: (user, day) keys with several events."""
    e = table(spark, sf_dir, "events").select(
        "user_id", F.year("ts").alias("YEAR"), F.month("ts").alias("MONTH"), F.dayofmonth("ts").alias("DAY"))
    return multi_record_days_op(e, ["user_id", "YEAR", "MONTH", "DAY"])


def day_rank(spark, sf_dir):
    """Dense rank of each order's day by (MONTH, DAY, YEAR)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("YEAR"), F.month("o_orderdate").alias("MONTH"),
        F.dayofmonth("o_orderdate").alias("DAY"))
    return day_rank_op(o)


def schema_integrity(spark, sf_dir):
    """V4: the converted rows against the table they were written to, with rows and values read back per column."""
    rows = stage(convert_round(spark, sf_dir), "schema-rows")
    path = scratch_path(spark, "schema-table")
    write_table(rows, path, ["SPLIT_RANGE", "YEAR"])
    back = spark.read.parquet(path).select(*rows.columns)
    counts = back.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(c) for c in back.columns])
    values = counts.unpivot(["n_rows"], back.columns, "target_name", "n_values")
    return schema_diff(spark, rows, back).join(values, "target_name")


def range_check(spark, sf_dir):
    """Three converted readings of every row checked against the plausible range."""
    return range_check_op(convert_round(spark, sf_dir), OBS, MIN_AIR_PRESSURE_HPA, MAX_AIR_PRESSURE_HPA)


def range_summary(spark, sf_dir):
    """V5: one-row summary of the same check."""
    return range_summary_op(convert_round(spark, sf_dir), OBS, MIN_AIR_PRESSURE_HPA, MAX_AIR_PRESSURE_HPA)


def partitioned_roundtrip(spark, sf_dir):
    """K1, K2: converted rows written as a (SPLIT_RANGE, YEAR) partitioned table and read back."""
    path = scratch_path(spark, "roundtrip-table")
    write_table(convert_round(spark, sf_dir), path, ["SPLIT_RANGE", "YEAR"])
    return spark.read.parquet(path).select(*PRESSURE_CANONICAL)


def quarantine_roundtrip(spark, sf_dir):
    """K3, K4: bad lines written to a per-file quarantine table and read back."""
    path = scratch_path(spark, "roundtrip-quarantine")
    write_quarantine(parse_lines_bad(spark, sf_dir), path, "only")
    back = (spark.read.schema("line string, error_class string, file_name string")
            .options(header="true").csv(path))
    return back.select("file_name", "line", "error_class")


def _pressure_load(spark, sf_dir):
    return load_pressure(spark, pressure_archive_lines(spark, sf_dir))


def pressure_load(spark, sf_dir):
    """The loaded pressure table of the barometer archive."""
    return nan_as_flag(_pressure_load(spark, sf_dir).loaded, OBS)


def temperature_load(spark, sf_dir):
    """B2: the de-duplicated temperature rows of the lineitem files."""
    res = load_temperature(spark, lineitem_lines(spark, sf_dir))
    return nan_as_flag(res.loaded, ["MAX_TEMP", "MIN_TEMP", "MEAN_TEMP"])


def load_status(spark, sf_dir):
    """One status row per load; the first is refused (several records a day), the others are written."""
    t = load_temperature(spark, lineitem_lines(spark, sf_dir), scratch_path(spark, "status-refused"))
    t.release()
    both = load_all(spark, daily_lines(spark, sf_dir), pressure_archive_lines(spark, sf_dir),
                    scratch_path(spark, "status-loaded"))
    return t.status.unionByName(both)


def temperature_table(spark, sf_dir):
    """K1, V7: the daily rows, loaded into a (PUBLISHED_CATEGORY, YEAR) table and read back."""
    path = scratch_path(spark, "temperature-table")
    load_temperature(spark, daily_lines(spark, sf_dir), path).release()
    back = spark.read.parquet(path)
    return nan_as_flag(back.select(*TEMPERATURE.names, "PUBLISHED_CATEGORY"), ["MAX_TEMP", "MIN_TEMP", "MEAN_TEMP"])


def _text_directory(spark, sf_dir):
    """The barometer archive as text files on disk, a folder per virtual file."""
    path = scratch_path(spark, "archive-text")
    lines = pressure_archive_lines(spark, sf_dir)
    lines.withColumnRenamed("file_name", "file").write.partitionBy("file").text(path)
    return read_lines(spark, path, unit="folder")


def text_directory_load(spark, sf_dir):
    """Text files scanned, loaded into the partitioned table, read back."""
    path = scratch_path(spark, "text-table")
    load_pressure(spark, _text_directory(spark, sf_dir), path).release()
    return nan_as_flag(spark.read.parquet(path).select(*PRESSURE_CANONICAL), OBS)


def quarantine_two_runs(spark, sf_dir):
    """Two loads into one quarantine; every bad line of both is read back."""
    path = scratch_path(spark, "quarantine-runs")
    lines = _text_directory(spark, sf_dir)
    for run in ("1", "2"):
        load_pressure(spark, lines, None, path, load_id=run).release()
    back = spark.read.options(header="true").csv(path)
    return back.groupBy("file_name", "error_class").agg(F.count("line").alias("n_lines"),
                                                        F.count_distinct("LOAD_ID").alias("n_loads"))


def sql_days(spark, sf_dir):
    """The converted rows as a view, queried as SQL text."""
    convert_round(spark, sf_dir).createOrReplaceTempView("converted_readings")
    return spark.sql("SELECT DISTINCT SPLIT_RANGE, YEAR, MONTH, DAY FROM converted_readings")


QUERIES = {
    "parse_lines_good": parse_lines_good,
    "parse_lines_bad": parse_lines_bad,
    "parse_partial_policy": parse_partial_policy,
    "accept_route_keep": accept_route_keep,
    "accept_route_bad": accept_route_bad,
    "coverage_by_file": coverage_by_file,
    "coverage_accepted_rows": coverage_accepted_rows,
    "provenance_flag": provenance_flag,
    "range_tag": range_tag,
    "nan_fill_cols": nan_fill_cols,
    "nan_fill_all": nan_fill_all,
    "categorize_year": categorize_year,
    "convert_round": convert_round,
    "convert_back_except": convert_back_except,
    "union_distinct": union_distinct,
    "duplicate_rows": duplicate_rows,
    "multi_record_days": multi_record_days,
    "day_rank": day_rank,
    "schema_integrity": schema_integrity,
    "range_check": range_check,
    "range_summary": range_summary,
    "partitioned_roundtrip": partitioned_roundtrip,
    "quarantine_roundtrip": quarantine_roundtrip,
    "pressure_load": pressure_load,
    "temperature_load": temperature_load,
    "load_status": load_status,
    "temperature_table": temperature_table,
    "text_directory_load": text_directory_load,
    "quarantine_two_runs": quarantine_two_runs,
    "sql_days": sql_days,
}

__all__ = ["QUERIES", "orders_lines", "lineitem_lines", "daily_lines", "pressure_archive_lines", "table", "nan_as_flag"]
