"""Sample observation files (tab-separated, header-less), with invented readings.

Readings come from simple rules; only the file names are those of the registry.
``UNIT`` holds one file per layout, ``MOCK_PRESSURE`` and ``MOCK_TEMPERATURE``
are whole directories. Files have no trailing newline.
"""

from decimal import ROUND_HALF_UP, Decimal


def rows(*lines: str) -> str:
    return "\n".join(lines)


def tsv(*tokens) -> str:
    return "\t".join(str(t) for t in tokens)


def hpa(reading: float, factor: float) -> float:
    """A reading in hPa to one decimal, half up."""
    return float(Decimal(repr(reading * factor)).quantize(Decimal("0.1"), ROUND_HALF_UP))


def tenths(first: int, *steps: int) -> list[float]:
    """Readings ``first``, ``first + step``, ... given in tenths."""
    out = [first]
    for s in steps:
        out.append(out[-1] + s)
    return [x / 10 for x in out]


# One row per year; 1950 is out of the plausible range.
YEARS_1938 = {y: tenths(9600 + 31 * (y - 1938), 17, -9) for y in range(1938, 1961)} | {1950: tenths(9201, 4, 4)}
BARO_1938_1960 = rows(*[tsv(y, y % 12 + 1, y % 28 + 1, *v) for y, v in YEARS_1938.items()])

# Four records of one day; the reduced readings are the third of each triple.
REDUCED_1859 = [tenths(2500 + 23 * i, 15, -8) for i in range(4)]
BARO_1859_1861 = rows(*[tsv(1859, 6, 2, *[t for k, x in enumerate(v) for t in (x + 1, 11 + k, x)]) for v in REDUCED_1859])

# First readings on seven days, third ones on five of them, second ones never.
FIRST_1756 = [25.02 + 0.07 * i for i in range(7)]
THIRD_1756 = [None, 25.31, 25.22, 25.47, None, 25.06, 25.6]
BARO_1756_1858 = rows(*[
    tsv(1756, 3, i + 1, f"{a:.2f}", "NaN", "NaN", "NaN", "NaN" if c is None else c, "NaN")
    for i, (a, c) in enumerate(zip(FIRST_1756, THIRD_1756))])

GOOD_1862 = [tenths(7351 + 29 * i, 12, 13) for i in range(7)]
BAD_1862 = tsv(1862, 4, 8, "QQQ", "740.2", "")
BARO_1862_1937 = rows(*[tsv(1862, 4, i + 1, *v) for i, v in enumerate(GOOD_1862)], BAD_1862)

# Space separated: every line is one token.
BARO_A_2013_2017_SPACES = rows(*[f"{2013 + i % 5}  2  {i + 1} 1001.{i} 1002.{i} 1003.{i}" for i in range(6)])


def daily(y: int, d: int, base: int) -> str:
    return tsv(y, 5, d, *tenths(base, -8, 3, 9, -6, 2))


TEMP_A_2013_2017_UNIT = rows(*[daily(2013 + i, i + 1, 70 + 5 * i) for i in range(5)])

UNIT = {
    "stockholm_barometer_1938_1960.txt": BARO_1938_1960,
    "stockholm_barometer_1859_1861.txt": BARO_1859_1861,
    "stockholm_barometer_1756_1858.txt": BARO_1756_1858,
    "stockholm_barometer_1862_1937.txt": BARO_1862_1937,
    "stockholmA_barometer_2013_2017.txt": BARO_A_2013_2017_SPACES,
    "stockholmA_daily_temp_obs_2013_2017_t1t2t3txtntm.txt": TEMP_A_2013_2017_UNIT,
}

# Year tokens that fail: letters; two tokens run together (the rest then lacks one); trailing blanks.
BAD_YEARS = {"year": "TYPE", "2013 7": "ARITY_TYPE", "20z47": "ARITY_TYPE", "20157": "ARITY_TYPE", "2016    ": "ARITY_TYPE"}

MOCK_PRESSURE = {
    "stockholmA_barometer_2013_2017.txt": rows(*[
        tsv(t, *([7, 2] if c == "TYPE" else [2]), "1004.5", "1006.1", "1003.8") for t, c in BAD_YEARS.items()]),
    "stockholm_barometer_1756_1858.txt": BARO_1756_1858,
    "stockholm_barometer_1859_1861.txt": BARO_1859_1861,
    "stockholm_barometer_1862_1937.txt": BARO_1862_1937,
    "stockholm_barometer_1938_1960.txt": rows(*[tsv(1938, 9, i + 1, *tenths(9980 + 7 * i, 5, 5)) for i in range(6)]),
    "stockholm_barometer_1961_2012.txt": rows(*[tsv(1961, 9, i + 1, *tenths(10020 + 9 * i, 3, 6)) for i in range(5)]),
}

BAD_TEMPERATURE = tsv(2014, 5, 9, "6", "5.2", "QQQ", "6.1", "5.5", "QQQ")

MOCK_TEMPERATURE = {
    # All five years, one day each, and one line with two bad tokens on a day of its own year.
    "stockholmA_daily_temp_obs_2013_2017_t1t2t3txtntm.txt": rows(
        *[daily(y, 9 if y == 2014 else y - 2010, 64 + i) for i, y in enumerate((2015, 2013, 2017, 2016, 2014))],
        BAD_TEMPERATURE),
    # Six of nine tokens: ten rows, six different ones, over two of the name's years; and a blank one.
    "stockholm_daily_temp_obs_1756_1858_t1t2t3_tempCopy.txt": rows(
        *[tsv(1756, 2, 3, *tenths(-61, -7), "NaN")] * 3,
        *[tsv(1756, 2, 3, *tenths(-70, 2), "NaN")] * 3,
        *[tsv(1858, 2, 3, *tenths(131 + 10 * i, 22, -5)) for i in range(3)],
        tsv(1858, 10, 4, *tenths(120, 31, -20)),
        tsv("", "", "", "", "13.1", "12.2", "13.3")),
    "stockholm_daily_temp_obs_2013_1858_t1t2t3_tempCopy.txt": rows(*[daily(2013, i + 1, 50 + i) for i in range(4)]),
}


def write_dir(root, files: dict[str, str]) -> str:
    """Write ``files`` under ``root`` (a pathlib.Path); returns the directory path."""
    root.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (root / name).write_text(text)
    return str(root)
