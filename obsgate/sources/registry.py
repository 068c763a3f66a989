"""Fixed registries: file-name -> year range, range -> input layout, unit factors.

Everything in the block marked FIXED VALUES must equal the values the
original loader uses, otherwise loads route, parse or convert differently.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INT = T.IntegerType()
DOUBLE = T.DoubleType()

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original loader exactly)
# ---------------------------------------------------------------------------

# Pressure file name -> year range label (exact, case-sensitive match).
PRESSURE_FILE_RANGES = {
    "stockholm_barometer_1756_1858.txt": "1756_1858",
    "stockholm_barometer_1859_1861.txt": "1859_1861",
    "stockholm_barometer_1862_1937.txt": "1862_1937",
    "stockholm_barometer_1938_1960.txt": "1938_1960",
    "stockholm_barometer_1961_2012.txt": "1961_2012",
    "stockholm_barometer_2013_2017.txt": "MAN_2013_2017",
    "stockholmA_barometer_2013_2017.txt": "AUTO_2013_2017",
}

# File names starting with this prefix come from automatic stations.
AUTOMATIC_STATION_PREFIX = "stockholmA"

# Unit factors.
MMHG_TO_HPA = 1.333224
SWEDISH_INCH_TO_MMHG = 25.4
# Reverse factors used by the round-trip check.
HPA_TO_MMHG = 0.75006
HPA_TO_SWEDISH_INCH = 0.02953
HPA_TO_SWEDISH_INCH_TENTH = 0.2953

# Publisher bands for temperature rows: (first year, last year, category);
# years 2013-2017 are MANUAL_STN only for manual stations, everything else
# (including NULL or out-of-band years) is AUTOMATIC_STN.
PUBLISHER_BANDS = (
    (1756, 1858, "SMHI_STAFF"),
    (1859, 1960, "IMPROVE"),
    (1961, 2012, "SMHI"),
)
MANUAL_BAND = (2013, 2017, "MANUAL_STN")
DEFAULT_CATEGORY = "AUTOMATIC_STN"

# Plausible station pressure range in hPa (lowest / highest on record).
MIN_AIR_PRESSURE_HPA = 938.4
MAX_AIR_PRESSURE_HPA = 1063.7

# ---------------------------------------------------------------------------
# Layouts
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Ordered, typed column list of one header-less delimited file kind."""

    name: str
    fields: tuple[tuple[str, T.DataType], ...]
    mandatory: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.fields])


def _obs(prefixes: tuple[str, ...], n: int = 3) -> tuple[tuple[str, T.DataType], ...]:
    return tuple((f"{p}{i}", DOUBLE) for i in range(1, n + 1) for p in prefixes)


DATE_FIELDS = (("YEAR", INT), ("MONTH", INT), ("DAY", INT))

TEMPERATURE = Layout(
    "temperature",
    DATE_FIELDS
    + tuple(
        (c, DOUBLE)
        for c in ("MORG_TEMP", "NOON_TEMP", "EVE_TEMP", "MAX_TEMP", "MIN_TEMP", "MEAN_TEMP")
    ),
    mandatory=("YEAR", "MONTH", "DAY", "MORG_TEMP", "NOON_TEMP"),
)

# Layout A: barometer, thermometer and reduced pressure, three times a day.
PRESSURE_A = Layout("A", DATE_FIELDS + _obs(("BARO_OBS", "THERMO_OBS", "REDUCED_AIR_PRESSURE")))
# Layout B: barometer and barometer temperature, three times a day.
PRESSURE_B = Layout("B", DATE_FIELDS + _obs(("BARO_OBS", "BARO_TEMP_OBS")))
# Layout C: three observations already in one unit.
PRESSURE_C = Layout("C", DATE_FIELDS + _obs(("OBSERVATION",)))

PRESSURE_LAYOUTS = {"A": PRESSURE_A, "B": PRESSURE_B, "C": PRESSURE_C}


def pressure_layout_key(range_label: str | None) -> str | None:
    """Range label -> layout key (case-insensitive, as the original)."""
    if range_label is None:
        return None
    r = range_label.lower()
    if r == "1859_1861":
        return "A"
    if r == "1756_1858":
        return "B"
    return "C"


@dataclass(frozen=True)
class Conversion:
    """Which source columns hold a range's readings, and the factor to hPa."""

    source: tuple[str, str, str]
    factor: float | None  # None: already hPa, passed through unrounded


def pressure_conversions(swedish_inch_mm: float = SWEDISH_INCH_TO_MMHG) -> dict[str, Conversion]:
    # Factors are formed by the same double products as the original loader.
    return {
        "1862_1937": Conversion(("OBSERVATION1", "OBSERVATION2", "OBSERVATION3"), MMHG_TO_HPA),
        "1756_1858": Conversion(("BARO_OBS1", "BARO_OBS2", "BARO_OBS3"), swedish_inch_mm * MMHG_TO_HPA),
        "1859_1861": Conversion(
            ("REDUCED_AIR_PRESSURE1", "REDUCED_AIR_PRESSURE2", "REDUCED_AIR_PRESSURE3"),
            swedish_inch_mm * MMHG_TO_HPA * 0.1,
        ),
    }


# Reverse conversion for the round-trip check: range -> (factor, decimal scale).
REVERSE_CONVERSIONS = {
    "1862_1937": (HPA_TO_MMHG, 1),
    "1756_1858": (HPA_TO_SWEDISH_INCH, 2),
    "1859_1861": (HPA_TO_SWEDISH_INCH_TENTH, 1),
}

PRESSURE_CANONICAL = [
    "YEAR", "MONTH", "DAY", "OBSERVATION1", "OBSERVATION2", "OBSERVATION3", "SPLIT_RANGE",
]
TEMPERATURE_CANONICAL = TEMPERATURE.names + ["PUBLISHED_CATEGORY"]
