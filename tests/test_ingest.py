"""Ledger, file state, catalog tables, digest index, schema gate, resumed loads, functions by name, CSV source."""

import os

import pytest
from pyspark.sql import functions as F

from obsgate.functions.named import call_acceptable, register_acceptable
from obsgate.operators.digest_index import build_index, marked, rows_not_stored, write_index
from obsgate.operators.parse import CORRUPT, ERROR_CLASS, parse_lines
from obsgate.operators.validate import coverage_by_file, coverage_from_state, coverage_state, merge_states
from obsgate.plans.pressure import load_pressure
from obsgate.plans.temperature import load_temperature
from obsgate.sinks import parquet as sink
from obsgate.sinks.schema_gate import footer_layouts, other_files, remember, written_layouts
from obsgate.sources.csv import read_typed
from obsgate.sources.listing import list_files, read_ledger
from obsgate.sources.registry import PRESSURE_C, TEMPERATURE
from obsgate.sources.text import read_lines
from tests import sample_files as S

BARO = "stockholm_barometer_1938_1960.txt"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- listing and ledger


def test_listing_has_every_file_and_the_scans_paths(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", {"a b+c.txt": "1\t2\n", "empty.txt": "", "blank.txt": "\n \n"})
    got = {r.file_name: (r.length, r.modified is None) for r in list_files(spark, src).collect()}
    assert got == {"a b+c.txt": (4, False), "empty.txt": (0, True), "blank.txt": (3, False)}
    read = {r.file_path for r in read_lines(spark, src).select("file_path").distinct().collect()}
    assert read < {r.file_path for r in list_files(spark, src).collect()}
    assert "content" not in plan(list_files(spark, src)).split("ReadSchema")[1].split("\n")[0]
    folder = list_files(spark, src, unit="folder").collect()
    assert [(r.file_name, r.length) for r in folder] == [("in", 7)]
    with pytest.raises(ValueError):
        list_files(spark, src, unit="none")


def test_ledger_skips_files_loaded_before(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    src = S.write_dir(tmp_path / "in", {BARO: S.BARO_1938_1960, "empty.txt": ""})
    load_pressure(spark, src, out, ledger=ledger, load_id="1").release()
    again = load_pressure(spark, src, out, ledger=ledger, load_id="2")
    assert {r.file_name: r.reason for r in again.files.collect()} == {BARO: "REPEATED", "empty.txt": "EMPTY"}
    assert again.counts["rows_staged"] == 0 and not again.gates["loaded"] and spark.read.parquet(out).count() == 23
    # the same load once more is no repetition of itself; a changed file is another one
    assert load_pressure(spark, src, None, ledger=str(tmp_path / "l2"), load_id="1").counts["rows_staged"] == 23
    S.write_dir(tmp_path / "in", {BARO: S.BARO_1938_1960 + "\n1940\t12\t30\t1000.1\t1000.2\t1000.3"})
    assert load_pressure(spark, src, out, ledger=ledger, load_id="3").counts["rows_staged"] == 24
    rows = read_ledger(spark, ledger)
    assert rows.count() == 6 and rows.filter("loaded").count() == 2
    with pytest.raises(ValueError):
        load_pressure(spark, read_lines(spark, src), ledger=ledger)


# --- file states


def test_states_of_a_split_file_merge(spark):
    rows = [("x_y_1850_1990.txt", y, y % 5 == 0) for y in range(1850, 1991)] + [("x_y_1850_1852.txt", y, False) for y in (1850, 1852)] + [("x_y_1_9.txt", None, True), ("odd.txt", -3, False)]
    df = spark.createDataFrame(rows, "file_name string, YEAR int, flag boolean").repartition(5)
    whole = coverage_by_file(df, bad=F.col("flag"), sums={"n_flag": F.col("flag")}, tops={"top": F.col("YEAR")})
    parts = [coverage_state(df.filter(c), bad=F.col("flag"), sums={"n_flag": F.col("flag")}, tops={"top": F.col("YEAR")}) for c in ("YEAR % 2 = 0", "YEAR % 2 <> 0 OR YEAR IS NULL")]
    merged = coverage_from_state(merge_states(*parts))
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.select(*whole.columns).collect()))
    assert {r.file_name: r.reason for r in whole.collect()} == {"x_y_1850_1990.txt": None, "x_y_1850_1852.txt": "COVERAGE", "x_y_1_9.txt": "BAD_NAME", "odd.txt": "BAD_NAME"}
    assert {r.year_count for r in whole.collect()} == {141, 2, 0, 1}
    text = plan(coverage_by_file(df))
    assert "count(distinct" not in text and "bit_or" in text


def test_file_state_counts_for_a_later_load(spark, tmp_path):
    lines = S.BARO_1938_1960.split("\n")
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    sources = [S.write_dir(tmp_path / n, {BARO: "\n".join(part)}) for n, part in (("a", lines[:10]), ("b", lines[10:]))]
    first = load_pressure(spark, sources[0], out, file_state=state, load_id="1")
    assert [r.reason for r in first.files.collect()] == ["COVERAGE"]
    second = load_pressure(spark, sources[1], out, file_state=state, load_id="2")
    assert [(r.reason, r.n_rows) for r in second.files.collect()] == [(None, 13)] and second.gates["loaded"]
    assert [r.reason for r in load_pressure(spark, sources[0], out, file_state=state, load_id="1").files.collect()] == [None]
    assert spark.read.parquet(out).count() == 23


# --- catalog tables and incremental dedupe


def test_catalog_table_publishes_after_the_gates(spark, tmp_path):
    good = S.write_dir(tmp_path / "good", S.MOCK_TEMPERATURE)
    name, root = "published_temperature", str(tmp_path / "root")
    res = load_temperature(spark, good, root, table=name, load_id="a")
    assert res.gates["loaded"] and spark.sql(f"SELECT * FROM {name}").count() == 5
    parts = {p for d, _, names in os.walk(root) for p in names if p.endswith(".parquet") and "digests" not in d and "layouts" not in d}
    assert {os.path.basename(r.f) for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()} == parts  # each row written once
    # the same load again replaces its own partitions; another load of the same rows stores nothing new
    load_temperature(spark, good, root, table=name, load_id="a").release()
    assert spark.table(name).count() == 5
    again = load_temperature(spark, good, root, table=name, load_id="b")
    assert (again.counts["rows_staged"], again.gates["loaded"]) == (0, False)
    # a refused load publishes nothing, and its folder goes
    refused = load_temperature(spark, good, root, table=name, load_id="c", policy="partial")
    assert refused.gates["loaded"] is False and refused.gates["multi_record_days"] and refused.loaded.count() == 1
    refused.release()
    assert spark.table(name).count() == 5 and not [f for f in os.listdir(f"{root}/loads") if f.startswith("c-")]
    assert {r.LOAD_ID for r in spark.table(name).collect()} == {"a"}
    assert "PartitionFilters: [isnotnull(YEAR" in plan(spark.sql(f"SELECT * FROM {name} WHERE YEAR = 2014"))
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(ValueError):
        load_temperature(spark, good, table=name)


def test_a_foreign_file_closes_the_schema_gate(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", {BARO: S.BARO_1938_1960})
    name, root = "gated_pressure", str(tmp_path / "root")
    load_pressure(spark, src, root, table=name, load_id="a").release()
    changed = S.write_dir(tmp_path / "in2", {BARO: S.BARO_1938_1960.replace("\t960.0\t", "\t961.5\t", 1)})
    folder = next(d for d, _, names in os.walk(f"{root}/loads") if any(n.endswith(".parquet") for n in names))
    foreign = spark.createDataFrame([(1, 1, 1.0, 1.0, 1.0)], "DAY int, MONTH int, OBSERVATION1 double, OBSERVATION2 double, OBSERVATION3 double")
    foreign.coalesce(1).write.mode("append").parquet(folder)
    shut = load_pressure(spark, changed, root, table=name, load_id="b")
    assert (shut.gates["schema_ok"], shut.gates["loaded"], shut.counts["rows_staged"]) == (False, False, 1)
    assert {r.LOAD_ID for r in spark.table(name).select("LOAD_ID").collect()} == {"a"}
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("kind,ddl,refused", [
    ("same", "A int, B string, C double", False), ("case", "a int, B string, c double", False), ("type", "A bigint, B string, C double", True),
    ("name", "A int, D string, C double", True), ("order", "B string, A int, C double", True), ("fewer", "A int, B string", True), ("more", "A int, B string, C double, D int", True)])
def test_footers_of_single_files(spark, tmp_path, kind, ddl, refused):
    path, ledger = str(tmp_path / "t"), str(tmp_path / "ledger")
    own = spark.createDataFrame([(1, "x", 0.5)], "A int, B string, C double")
    own.repartition(2).write.parquet(path)
    remember(written_layouts(spark, path, own.schema, [], ledger), ledger)
    spark.createDataFrame([], ddl).coalesce(1).write.mode("append").parquet(path)
    for known in (ledger, None):
        assert (not other_files(footer_layouts(spark, path, known), own.schema).isEmpty()) is refused
    remember(footer_layouts(spark, path, ledger), ledger)
    os.utime(path)
    assert footer_layouts(spark, path, ledger).count() == footer_layouts(spark, path).count()


def test_only_rows_that_may_be_stored_are_compared(spark, tmp_path):
    cols, parts, path = ["k", "v", "YEAR"], ["YEAR"], str(tmp_path / "index")
    row = lambda n: n.select((F.col("id") % 97).cast("int").alias("k"), (F.col("id") * 0.5).alias("v"), (F.lit(1900) + F.col("id") % 3).cast("int").alias("YEAR"))
    stored = row(spark.range(20_000))
    stored.write.partitionBy("YEAR").parquet(str(tmp_path / "t"))
    write_index(stored, path, "1", cols, parts)
    table = spark.read.parquet(str(tmp_path / "t")).select(*cols)
    rows = row(spark.range(19_000, 21_000)).union(spark.createDataFrame([(None, float("nan"), 1900), (None, -0.0, 1901)], "k int, v double, YEAR int"))
    seen = marked(rows, spark.read.parquet(path), cols, parts).groupBy("may_be_stored").count().collect()
    seen = {r.may_be_stored: r["count"] for r in seen}
    assert seen[True] < 1200 and seen[False] > 800  # 1,000 are stored
    new = rows_not_stored(rows, table, path, cols, parts)
    assert sorted(r.v for r in new.collect() if r.v == r.v and r.v > 0) == [i * 0.5 for i in range(20_000, 21_000)] and new.count() == 1002
    text = plan(rows_not_stored(rows, table, path, cols, parts))
    assert "LeftSemi, BuildRight" in text and text.count("Exchange hashpartitioning") <= 2  # of the few digests and hits, not of stored rows
    assert rows_not_stored(rows, table, path, cols, parts, load_id="1").count() == 2002  # its own bitmaps don't count
    two = build_index(stored.filter("k < 40"), cols, parts).union(build_index(stored.filter("k >= 40"), cols, parts))
    merged = two.groupBy("partition", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    assert merged.exceptAll(build_index(stored, cols, parts)).isEmpty()
    with pytest.raises(ValueError):
        rows_not_stored(rows, table, str(tmp_path / "none"), cols, parts)


# --- resumed loads


def test_a_killed_load_resumes_without_reading_text(spark, tmp_path, monkeypatch):
    src = S.write_dir(tmp_path / "in", {BARO: S.BARO_1938_1960 + "\nx1\t1\t7\t1000.0\t1000.0\t1000.0"})
    out = str(tmp_path / "out")
    whole = load_pressure(spark, src, str(tmp_path / "other"))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr("obsgate.plans.pressure.dedupe", killed)
        with pytest.raises(KeyboardInterrupt):
            load_pressure(spark, src, out, load_id="r", resume=True)
    with monkeypatch.context() as m:
        m.setattr("obsgate.plans.common.read_lines", lambda *a, **b: spark.createDataFrame([], "value string, file_name string, file_path string"))
        res = load_pressure(spark, src, out, load_id="r", resume=True)
    assert res.stages.reused == ["parsed", "files"]
    assert res.counts == whole.counts and spark.read.parquet(out).count() == 23
    # of a source that has changed no step is taken
    S.write_dir(tmp_path / "in", {BARO: S.BARO_1938_1960})
    fresh = load_pressure(spark, src, None, load_id="r", resume=True)
    assert fresh.stages.reused == [] and fresh.counts["rows_quarantined"] == 0
    root = sink.local_path(fresh.stages.root)
    fresh.release()
    assert not os.path.exists(root)
    with pytest.raises(ValueError):
        load_pressure(spark, src, resume=True)


def test_counts_need_no_job_after_staging(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    back, seen = sink.write_observed(df, str(tmp_path / "o"), {"n": F.count(F.lit(1)), "top": F.max("v")})
    assert seen == {"n": 1000, "top": 6} and back.count() == 1000


def test_shared_folder_is_in_the_warehouse_if_unset(spark, monkeypatch):
    class Context:
        master, dirs = "spark://cluster", []

        def getCheckpointDir(self):
            return self.dirs[-1] if self.dirs else None

        def setCheckpointDir(self, d):
            self.dirs.append(d)

    class Conf:
        def get(self, key, default=None):
            return "hdfs://x/warehouse/" if key == "spark.sql.warehouse.dir" else default

    class Session:
        sparkContext, conf = Context(), Conf()

    first = sink.shared_dir(Session())
    assert first.startswith("hdfs://x/warehouse/obsgate-staging-") and sink.shared_dir(Session()) == first


# --- by name, and by the CSV source


def test_predicate_by_name_stays_native(spark):
    name = register_acceptable(spark)
    df = spark.createDataFrame([(2000, 1, 1, 1.0, 2.0), (2000, None, 1, 1.0, 2.0), (2000, 1, 1, None, 2.0)], "YEAR int, MONTH int, DAY int, MORG_TEMP double, NOON_TEMP double")
    df.createOrReplaceTempView("readings")
    by_sql = spark.sql(f"SELECT {name}({', '.join(TEMPERATURE.mandatory)}) AS ok FROM readings")
    assert [r.ok for r in by_sql.collect()] == [r.ok for r in df.select(call_acceptable().alias("ok")).collect()] == [True, False, False]
    text = plan(df.filter(call_acceptable()))
    assert "Python" not in text and "isnotnull(MORG_TEMP" in text


def test_csv_source_equals_the_parse_on_every_defect(spark, tmp_path):
    text = "\n".join([
        "2000\t1\t1\t1.0\t2.0\t3.0", "2000\t1\t1\t1.0\t2.0", "2000\t1\t1\t1.0\t2.0\t3.0\t4", "2000  \t1\t1\t1.0\t2.0\t3.0", "2000\t1\t1\tXXX\t2.0\t3.0",
        "2000\t1\t1\t\t2.0\t3.0", "\t\t\t\t\t", "   ", "", "2000\t1\t1\tNaN\t-Infinity\t1e3", "2000\t1\t1\t5d\t 1012.7 \t1013.3x", "99999999999\t1\t1\t1.0\t2.0\t3.0",
        "\"2000\"\t1\t1\t1.0\t2.0\t3.0", "2000\t1.5\t1\t1.0\t2.0\t3.0", "+2000\t-1\t1\t1.0\t2.0\t3.0", "x", "2000\t1\t1\t1,013.2\t2.0\t3.0"])
    src = S.write_dir(tmp_path / "in", {"f.txt": text})
    by_source = read_typed(spark, src, PRESSURE_C)
    by_parse = parse_lines(read_lines(spark, src), PRESSURE_C, policy="partial")
    columns = ["file_path", "file_name", *PRESSURE_C.names, CORRUPT]
    assert sorted(map(str, by_source.select(columns).collect())) == sorted(map(str, by_parse.select(columns).collect()))
    # pruning hides nothing: bad rows by year alone
    assert sorted(map(str, by_source.filter(F.col(CORRUPT).isNull()).select("YEAR").collect())) == sorted(map(str, by_parse.filter(F.col(ERROR_CLASS).isNull()).select("YEAR").collect()))
