"""obsgate: safe loading of header-less observation files into analytics
tables, as lazy Spark DataFrame operators.

Layers: ``sources`` (line scans, fixed registries), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame), ``sinks`` (tables,
quarantine, staging), ``plans`` (ready-made loads) and ``streaming``
(incremental loads of arriving files).
"""

from obsgate.operators.parse import bad_rows, good_rows, parse_by_layout, parse_lines
from obsgate.operators.route import acceptable, route_pressure, route_temperature
from obsgate.operators.transform import (
    canonical,
    categorize_publisher,
    convert_back,
    convert_range,
    dedupe,
    fill_missing,
    fill_nan,
    merge,
    tag_range,
    to_hpa,
)
from obsgate.operators.validate import (
    accepted_rows,
    coverage_by_file,
    day_rank,
    dense_rank_keys,
    duplicate_rows,
    has_duplicates,
    has_multi_record_days,
    multi_record_days,
    range_check,
    range_summary,
    roundtrip_mismatches,
    schema_diff,
    schema_matches,
)
from obsgate.plans.batch import load_all
from obsgate.plans.pressure import load_pressure
from obsgate.plans.temperature import load_temperature
from obsgate.sinks.parquet import stage, write_quarantine, write_table
from obsgate.sources.text import read_lines, with_provenance

__all__ = [name for name in dir() if not name.startswith("_")]
