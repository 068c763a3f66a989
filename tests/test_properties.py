"""Property tests: the Spark operators against a brute-force reference on
random small inputs."""

import math
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from obsgate.operators.parse import ERROR_CLASS, parse_lines
from obsgate.operators.route import route_pressure
from obsgate.operators.transform import convert_back, dedupe, merge, to_hpa
from obsgate.sources.registry import PRESSURE_C

INT_RE = re.compile(r"^[+-]?[0-9]+$")
NAMES = PRESSURE_C.names  # YEAR, MONTH, DAY int; OBSERVATION1..3 double

# Tokens the CSV reader and Python agree on (no quotes, no exponent/suffix letters).
token = st.one_of(
    st.integers(-3000, 3000).map(str),
    st.decimals(-2000, 2000, places=2, allow_nan=False).map(str),
    st.sampled_from(["", " ", "NaN", "XXX", "12x", "1,5", " 7 ", "+4", "-", ".5", "3.", "2017  "]),
)
line = st.lists(token, min_size=1, max_size=9).map("\t".join)


def reference_parse(text: str):
    """(values, error_class) the way the strict parse must classify a line, or None if skipped."""
    if not re.search(r"\S", text):
        return None
    toks = text.split("\t")
    arity = len(toks) != len(NAMES)
    toks = (toks + [""] * len(NAMES))[: len(NAMES)]
    values, type_bad = [], False
    for i, t in enumerate(toks):
        if t == "":
            values.append(None)
            continue
        if i < 3:
            ok = bool(INT_RE.match(t)) and -(2 ** 31) <= int(t) < 2 ** 31
            values.append(int(t) if ok else None)
        else:
            try:
                values.append(float(t))
                ok = True
            except ValueError:
                values.append(None)
                ok = False
        type_bad |= not ok
    if type_bad:
        values = [None] * len(NAMES)  # null_row policy
    err = "ARITY_TYPE" if arity and type_bad else "ARITY" if arity else "TYPE" if type_bad else None
    return values, err


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return a == b


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(line, min_size=1, max_size=25))
def test_parse_matches_reference(spark, lines):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, line_no int")
    got = {r["line_no"]: r for r in parse_lines(df, PRESSURE_C).collect()}
    for i, text in enumerate(lines):
        ref = reference_parse(text)
        if ref is None:
            assert i not in got
            continue
        values, err = ref
        row = got[i]
        assert row[ERROR_CLASS] == err, (text, row)
        assert all(_same(row[n], v) for n, v in zip(NAMES, values)), (text, row, values)
        assert (row["_corrupt_record"] == text) == (err is not None)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(line, min_size=1, max_size=25))
def test_routing_is_a_partition(spark, lines):
    df = spark.createDataFrame([(v, "f") for v in lines], "value string, file_name string")
    good, bad = route_pressure(parse_lines(df, PRESSURE_C))
    non_blank = sum(1 for t in lines if re.search(r"\S", t))
    assert good.count() + bad.count() == non_blank


reading = st.decimals(700, 800, places=1).map(float)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(reading, reading, reading), min_size=1, max_size=20),
       st.sampled_from(["1862_1937", "1859_1861", "1756_1858"]))
def test_convert_back_close_and_dedupe_idempotent(spark, obs, label):
    src_cols = {"1862_1937": "OBSERVATION", "1859_1861": "REDUCED_AIR_PRESSURE", "1756_1858": "BARO_OBS"}[label]
    rows = [(1900, 1, i + 1, label, *o) for i, o in enumerate(obs)]
    schema = "YEAR int, MONTH int, DAY int, SPLIT_RANGE string, " + ", ".join(
        f"{src_cols}{j} double" for j in (1, 2, 3))
    df = spark.createDataFrame(rows, schema)
    back = convert_back(to_hpa(df)).orderBy("DAY").collect()
    # forward factor f, reverse factor r, reverse rounding step
    f, r, step = {"1862_1937": (1.333224, 0.75006, 0.1),
                  "1859_1861": (25.4 * 1.333224 * 0.1, 0.2953, 0.1),
                  "1756_1858": (25.4 * 1.333224, 0.02953, 0.01)}[label]
    for row, o in zip(back, obs):
        for j in range(3):
            x = o[j]
            # half a reverse step + the forward rounding (0.05 hPa) scaled back + factor mismatch
            bound = step / 2 + 0.05 * r + abs(x) * abs(f * r - 1) + 1e-9
            assert abs(row[f"OBSERVATION{j + 1}"] - x) <= bound, (label, x, row)
    conv = to_hpa(df)
    once = dedupe(merge(conv, conv))
    assert once.count() == dedupe(once).count() == conv.distinct().count()


def test_ansi_off_gives_same_results(spark, lines_of):
    from tests import sample_files as S

    def run():
        lines = lines_of({"stockholm_barometer_1756_1858.txt": S.BARO_1756_1858,
                          "stockholm_barometer_1862_1937.txt": S.BARO_1862_1937})
        from obsgate.plans.pressure import parse_pressure, process_pressure

        good, bad = route_pressure(parse_pressure(lines))
        out = process_pressure(good.filter(F.col("SPLIT_RANGE").isNotNull()))
        return sorted(tuple(str(v) for v in r) for r in out.collect()), bad.count()

    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        on = run()
        spark.conf.set("spark.sql.ansi.enabled", "false")
        off = run()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert on == off
    assert on[1] == 1 and len(on[0]) == 14
