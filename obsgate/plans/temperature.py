"""Temperature load: parse -> coverage gate -> NaN fill -> route -> categorise
-> de-duplicate -> one-record-per-day and schema gates -> partitioned write.

Jobs, whatever the number of files: stage the parsed lines (the only text
scan), stage the de-duplicated result, a few small aggregates for gates and
counts, then the writes. The original ran three jobs per file for the gate
alone and a single-task window for the per-day check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from obsgate.operators.parse import ERROR_CLASS, parse_lines
from obsgate.operators.route import acceptable, route_temperature
from obsgate.operators.transform import categorize_publisher, dedupe, fill_nan
from obsgate.operators.validate import accepted_rows, coverage_from_state, coverage_state
from obsgate.plans.common import FILE_KEY, FILE_KEYS, Load, LoadResult
from obsgate.sinks.parquet import write_quarantine
from obsgate.sources.registry import TEMPERATURE, TEMPERATURE_CANONICAL
from obsgate.sources.text import with_file_path, with_provenance

PARTITION_COLS = ["PUBLISHED_CATEGORY", "YEAR"]
NAN_FILL_COLS = ["MAX_TEMP", "MIN_TEMP", "MEAN_TEMP"]


def parse_temperature(lines: DataFrame, *, policy: str = "null_row") -> DataFrame:
    """Typed temperature rows with provenance flag, raw line and error class."""
    parsed = with_provenance(parse_lines(with_file_path(lines), TEMPERATURE, policy=policy))
    # Only rows that can end up in quarantine (corrupt, or a mandatory value
    # missing) keep the raw line.
    line = F.when(F.col(ERROR_CLASS).isNotNull() | ~acceptable(TEMPERATURE.mandatory), F.col("value"))
    return parsed.select("file_path", "file_name", line.alias("value"), *TEMPERATURE.names, "ISMANUAL",
                         ERROR_CLASS)


def temperature_state(parsed: DataFrame) -> DataFrame:
    """Mergeable per-file state; every parsed row's YEAR counts (bad rows too)."""
    corrupt, ok = F.col(ERROR_CLASS).isNotNull(), acceptable(TEMPERATURE.mandatory)
    return coverage_state(parsed, FILE_KEY, name_col="file_name", bad=corrupt, sums={"n_ok": ok, "n_refused": corrupt & ~ok})


def temperature_files(parsed: DataFrame) -> DataFrame:
    """Per-file verdicts."""
    return coverage_from_state(temperature_state(parsed), FILE_KEYS)


def process_temperature(accepted: DataFrame, *, legacy_mandatory_null: bool = False):
    """NaN fill, routing, categorisation; returns (kept rows pre-dedupe, quarantine)."""
    filled = fill_nan(accepted, NAN_FILL_COLS)
    kept, bad = route_temperature(filled, legacy_mandatory_null=legacy_mandatory_null)
    return categorize_publisher(kept).select(*TEMPERATURE_CANONICAL), bad


def load_temperature(
    spark: SparkSession,
    source: str | Sequence[str] | DataFrame,
    output: str | None = None,
    quarantine_path: str | None = None,
    *,
    policy: str = "null_row",
    legacy_mandatory_null: bool = False,
    mode: str = "append",
    quarantine_format: str = "csv",
    **options,
) -> LoadResult:
    """Load ``source`` into the Parquet table at ``output``.

    ``table``: publish to this catalog table instead, whose files lie below ``output``; rows that it holds are not
    stored again. ``existing``: rows stored before; they are not loaded again and count for the day gate. ``ledger``: folder
    of the ledger of files; those loaded before and unchanged are not read. ``file_state``: folder of the
    years seen per file, which count for later loads of a file of that name. ``resume`` (with ``load_id``): steps
    that an earlier run of this load completed are not made again. ``unit="folder"``: a file is a folder of part files.
    """
    with Load(spark, "temperature", source, output, PARTITION_COLS, mode=mode, **options) as run:
        parsed, _ = run.stages.add(parse_temperature(run.lines(), policy=policy), "parsed")
        ok = F.col("reason").isNull()
        files, counts = run.verdicts(temperature_state(parsed), lambda files: files, n_ok=F.when(ok, F.col("n_ok")),
                                     n_all=F.when(ok, F.col("n_rows")), n_refused=F.when(ok, F.col("n_refused")))
        accepted = accepted_rows(parsed, files, FILE_KEY)
        kept, bad = process_temperature(accepted, legacy_mandatory_null=legacy_mandatory_null)
        loaded, rows = run.store(dedupe(kept))

        n_ok, n_all, n_refused = (counts.pop(c) for c in ("n_ok", "n_all", "n_refused"))
        if not legacy_mandatory_null:
            kept_rows, refused = n_ok, n_all - n_ok
        else:  # the original rule: what is neither kept nor quarantined is dropped, and counted here
            kept_rows, refused = (n_ok if n_refused else n_all), n_refused
        multi = run.several_a_day(loaded)
        gates = {"multi_record_days": multi, "schema_ok": run.schema_ok(loaded)}
        gates["gates_passed"] = rows > 0 and not multi and gates["schema_ok"] is not False
        gates["loaded"] = output is not None and gates["gates_passed"]
        counts |= {"rows_kept": kept_rows, "rows_quarantined": refused, "rows_dropped": n_all - kept_rows - refused,
                   "rows_staged": rows, "rows_deduped": kept_rows - rows, "rows_loaded": rows if gates["loaded"] else 0}
        if quarantine_path is not None and refused > 0:
            write_quarantine(bad, quarantine_path, run.load_id, fmt=quarantine_format)
        return run.finish(loaded, bad, files, counts, gates)
