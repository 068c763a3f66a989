"""Shared pieces of the load plans: the steps of a load, result object and status row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from obsgate.operators.digest_index import rows_not_stored, write_index
from obsgate.operators.validate import coverage_from_state, has_multi_record_days, merge_states
from obsgate.sinks.catalog import CatalogTable
from obsgate.sinks.parquet import LOAD_ID, Stages, load_path, new_load_id, table_schema, write_observed, write_table
from obsgate.sinks.schema_gate import expected_layout, footer_layouts, other_files, remember, written_layouts
from obsgate.sources.listing import EMPTY, REPEATED, fingerprint, list_files, read_ledger, record_files, repeated_files
from obsgate.sources.text import read_lines, with_file_path

STATUS_SCHEMA = T.StructType(
    [T.StructField("pipeline", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in (
        "files_seen", "files_accepted", "files_rejected", "lines_read", "rows_kept", "rows_quarantined",
        "rows_dropped", "rows_staged", "rows_deduped", "rows_loaded")]
    + [T.StructField(c, T.BooleanType()) for c in ("multi_record_days", "schema_ok", "gates_passed", "loaded")]
)

FILE_KEYS = ["file_path", "file_name"]  # a file is its path in per-file gates (names may repeat across folders)
FILE_KEY = FILE_KEYS[0]


@dataclass
class LoadResult:
    """Everything one load produced. ``loaded`` is the staged final table (stored if the gates passed)."""

    pipeline: str
    loaded: DataFrame
    quarantine: DataFrame
    files: DataFrame
    status: DataFrame
    gates: dict[str, bool | None] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    stages: Stages | None = None
    load_id: str = ""

    @property
    def staged(self) -> list[str]:
        return self.stages.paths

    def release(self) -> None:
        """Delete the staged intermediate folders once nothing reads these frames any more."""
        self.stages.release()


def as_lines(spark: SparkSession, source: str | Sequence[str] | DataFrame, unit: str = "file") -> DataFrame:
    """``(value, file_name, file_path)``: a path / glob / list of paths is scanned;
    a DataFrame must carry ``value`` and ``file_name`` (``file_path`` optional)."""
    if isinstance(source, DataFrame):
        return with_file_path(source).select("value", "file_name", "file_path")
    return read_lines(spark, source, unit=unit)


def status_frame(spark: SparkSession, pipeline: str, counts: dict[str, int],
                 gates: dict[str, bool | None]) -> DataFrame:
    known = {"pipeline": pipeline, **counts, **gates}
    return spark.createDataFrame([tuple(known.get(f.name) for f in STATUS_SCHEMA)], STATUS_SCHEMA)


class Load:
    """One load: what both plans do with lines, verdicts, rows and tables.

    Used as a context manager: staged steps are deleted if the load breaks off,
    or kept for the next try if it is resumable.
    """

    def __init__(self, spark: SparkSession, pipeline: str, source, output: str | None, partition_cols: Sequence[str], *,
                 mode: str = "append", load_id: str | None = None, existing: DataFrame | None = None, unit: str = "file",
                 table: str | None = None, ledger: str | None = None, file_state: str | None = None, resume: bool = False):
        if resume and not load_id:
            raise ValueError("a load is resumed by its load id")
        if table and not output:
            raise ValueError("a catalog table needs its root folder as output")
        if ledger and isinstance(source, DataFrame):
            raise ValueError("a ledger is kept of files; the source is a DataFrame")
        self.spark, self.pipeline, self.source, self.unit = spark, pipeline, source, unit
        self.output, self.partition_cols, self.mode, self.existing = output, list(partition_cols), mode, existing
        self.load_id = load_id or new_load_id()
        self.ledger, self.file_state = ledger, file_state
        self.stages = Stages(spark, self.load_id, resume)
        self.table = CatalogTable(spark, table, output, partition_cols) if table else None
        self.folder: str | None = None  # of the staged rows that a catalog table may publish
        self.listing: DataFrame | None = None

    def __enter__(self) -> Load:
        if not isinstance(self.source, DataFrame):
            listed = list_files(self.spark, self.source, unit=self.unit)
            seen = repeated_files(listed, read_ledger(self.spark, self.ledger), self.load_id) if self.ledger else None
            again = F.lit(False)
            if seen is not None:
                listed, again = listed.join(seen.select(FILE_KEY, F.lit(True).alias("again")), FILE_KEY, "left"), F.coalesce("again", F.lit(False))
            self.listing, self.known = write_observed(
                listed.select(*FILE_KEYS, "length", "modified", again.alias("repeated")), f"{self.stages.root}/listing-{new_load_id()}",
                fingerprint() | {"n_repeated": F.count_if("repeated")})
            self.stages.source = f"{self.known['n_files']}-{self.known['digest']}-{self.known['n_repeated']}"
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            if self.folder and self.table:
                self.table.discard(self.folder)
            self.stages.failed()

    def lines(self) -> DataFrame:
        """The source's lines, without those of files that another load has loaded."""
        out = as_lines(self.spark, self.source, self.unit)
        if self.listing is None or not self.known["n_repeated"]:
            return out
        return out.join(self.listing.filter("repeated").select(FILE_KEY), FILE_KEY, "left_anti").select("value", *FILE_KEYS[::-1])

    def verdicts(self, state: DataFrame, decide: Callable[[DataFrame], DataFrame], **sums: Column) -> tuple[DataFrame, dict[str, int]]:
        """Per-file verdicts, staged, and their counts, observed on the way (no pass over rows or verdicts).

        Files without lines (``EMPTY``) and those loaded before (``REPEATED``) are told from the listing. With ``file_state``
        the years that earlier loads saw in a file of the same name count too.
        """
        if self.file_state:
            state = self._with_earlier(state)
        files = decide(coverage_from_state(state, FILE_KEYS))
        if self.listing is not None:
            own = F.when(F.col("repeated"), F.lit(REPEATED)).when(F.col("n_rows").isNull(), F.lit(EMPTY)).otherwise(F.col("reason"))
            files = self.listing.join(files.drop("file_name"), FILE_KEY, "left").withColumns({
                "reason": own, "covered": F.coalesce("covered", F.lit(False)), "n_rows": F.coalesce("n_rows", F.lit(0))}).drop("repeated")
        ok = F.col("reason").isNull()
        metrics = {"files_seen": F.count(F.lit(1)), "files_accepted": F.count_if(ok), "lines_read": F.sum("n_rows"),
                   "year_from": F.min(F.when(ok, F.col("min_year"))), "year_to": F.max(F.when(ok, F.col("max_year")))}
        metrics |= {n: F.sum(c) for n, c in sums.items()}
        rows, seen = self.stages.add(files, "files", metrics)
        self.years = seen.pop("year_from"), seen.pop("year_to")
        counts = {k: int(v or 0) for k, v in seen.items()}
        counts["files_rejected"] = counts["files_seen"] - counts["files_accepted"]
        return rows, counts

    def _with_earlier(self, state: DataFrame) -> DataFrame:
        """The state of this load's files, staged and kept, with the years of the same files in other loads."""
        own, _ = self.stages.add(state, "state")
        if table_schema(self.spark, self.file_state) is not None:
            earlier = self.spark.read.option("basePath", self.file_state).parquet(self.file_state)
            earlier = earlier.filter(F.col(LOAD_ID).cast("string") != self.load_id)
            years = earlier.groupBy("file_name", "word").agg(F.bit_or("years").alias("years"), F.min("min_year").alias("min_year"), F.max("max_year").alias("max_year"))
            state = merge_states(own, own.select(*FILE_KEYS).distinct().join(years, "file_name"), keys=FILE_KEYS)
        own.write.mode("overwrite").parquet(load_path(self.file_state, self.load_id))
        return state

    def touched(self, stored: DataFrame) -> DataFrame:
        """The stored rows of the years that the accepted files bring (a missing year is stored as 0 or NULL): other partitions are not read."""
        year = F.col("YEAR")
        return stored.filter(year.between(*self.years) | year.isNull() | (year == 0) if self.years[0] is not None else year.isNull() | (year == 0))

    def stored(self) -> DataFrame | None:
        """Rows of other loads that this one may repeat."""
        if self.table:
            rows = self.table.rows()
            return None if rows is None else self.touched(rows.filter(F.col(LOAD_ID) != self.load_id))
        return None if self.existing is None else self.touched(self.existing)

    def store(self, rows: DataFrame) -> tuple[DataFrame, int]:
        """The distinct rows that are not stored yet, staged, and their number, observed on the way.

        For a catalog table they are staged where they will be published from.
        """
        metrics = {"n": F.count(F.lit(1))}
        stored = self.stored()
        if self.table:
            if stored is not None:
                rows = rows_not_stored(rows, stored, f"{self.output.rstrip('/')}/digests", rows.columns, self.partition_cols, self.load_id, self.stages.paths)
            loaded, seen, self.folder = self.table.stage(rows, self.load_id, metrics)
        else:
            if stored is not None:
                rows = rows.subtract(stored.select(*rows.columns))
            loaded, seen = self.stages.add(rows, "loaded", metrics)
        return loaded, int(seen["n"])

    def several_a_day(self, loaded: DataFrame) -> bool:
        """Has some day several rows, with those stored before?"""
        stored = self.stored()
        return has_multi_record_days(loaded if stored is None else loaded.unionByName(stored.select(*loaded.columns)))

    def schema_ok(self, loaded: DataFrame) -> bool | None:
        """Names, types and order of the rows against the stored table's, and of each of its files. None if there is none yet."""
        if self.output is None:
            return None
        if self.table:
            target, files = self.table.schema(), f"{self.output.rstrip('/')}/loads"
        else:
            target, files = table_schema(self.spark, self.output), self.output
        if target is None:
            return None
        data = [f for f in loaded.schema.fields if f.name not in self.partition_cols]
        shown = T.StructType(data + [loaded.schema[c] for c in self.partition_cols])
        if expected_layout(target) != expected_layout(shown):
            return False
        if self.table:
            self._remember_own(self.folder, loaded.schema)
        layouts = footer_layouts(self.spark, files, self._layout_ledger())
        return other_files(layouts, loaded.schema, self.partition_cols).isEmpty()

    def _layout_ledger(self) -> str:
        return f"{self.output.rstrip('/')}-layouts" if self.table is None else f"{self.output.rstrip('/')}/layouts"

    def _remember_own(self, path: str, schema: T.StructType) -> None:
        """Files this load wrote need no reading: they have the rows' columns."""
        remember(written_layouts(self.spark, path, schema, self.partition_cols, self._layout_ledger()), self._layout_ledger())

    def finish(self, loaded: DataFrame, quarantine: DataFrame, files: DataFrame, counts: dict, gates: dict) -> LoadResult:
        """Publish or write the rows if the gates passed, and keep the ledger."""
        if gates["loaded"] and self.table:
            first = self.table.schema() is None
            self.table.publish(loaded, self.folder, self.load_id)
            write_index(loaded, f"{self.output.rstrip('/')}/digests", self.load_id, loaded.columns, self.partition_cols)
            if first:
                self._remember_own(self.folder, loaded.schema)
        elif gates["loaded"]:
            write_table(loaded, self.output, self.partition_cols, self.mode, self.load_id)
            self._remember_own(self.output, loaded.schema)
        elif self.folder:
            self.stages.paths.append(self.folder)  # read until release, seen by nobody else
        if self.ledger:
            record_files(files, self.ledger, self.load_id, bool(gates["loaded"]))
        status = status_frame(self.spark, self.pipeline, counts, gates)
        return LoadResult(self.pipeline, loaded, quarantine, files, status, gates, counts, self.stages, self.load_id)
