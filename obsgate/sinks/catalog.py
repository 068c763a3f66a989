"""Catalog tables that publish staged files instead of copying them.

A load's rows are written once, into a folder of their own below the table's
root. When the gates have passed, the folder's partitions are added to the
catalog table (``ALTER TABLE ... ADD PARTITION ... LOCATION``); readers by
name see a load's rows then, and only then. A load that is run again has its partitions
replaced by those of the new run. A refused load's folder is deleted, nothing is published.

Works with any session catalog that keeps partitions (Hive metastore, in-memory).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from obsgate.sinks.parquet import LOAD_ID, remove_paths, write_observed

PER_STATEMENT = 500  # partitions added by one statement


def _q(name: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _lit(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class CatalogTable:
    """The table ``name``, whose loads' folders lie below ``root``."""

    def __init__(self, spark: SparkSession, name: str, root: str, partition_cols: Sequence[str]):
        self.spark, self.name, self.root = spark, name, root.rstrip("/")
        self.partition_cols = list(partition_cols)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def schema(self) -> T.StructType | None:
        """The table's columns but the load id; None if there is no table yet."""
        if not self.exists():
            return None
        return T.StructType([f for f in self.spark.table(self.name).schema.fields if f.name != LOAD_ID])

    def rows(self) -> DataFrame | None:
        return self.spark.table(self.name) if self.exists() else None

    def laid_out(self, schema: T.StructType) -> T.StructType:
        """``schema`` as the table shows it: partition columns last."""
        data = [f for f in schema.fields if f.name not in self.partition_cols]
        return T.StructType(data + [schema[c] for c in self.partition_cols])

    def create(self, schema: T.StructType) -> None:
        data = [f for f in schema.fields if f.name not in self.partition_cols]
        cols = [*data, T.StructField(LOAD_ID, T.StringType()), *[schema[c] for c in self.partition_cols]]
        ddl = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in cols)
        parts = ", ".join(_q(c) for c in [LOAD_ID, *self.partition_cols])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(self.name)} ({ddl}) USING parquet PARTITIONED BY ({parts}) LOCATION '{self.root}/published'")

    def stage(self, rows: DataFrame, load_id: str, metrics=None) -> tuple[DataFrame, dict, str]:
        """Write a load's rows where they will be published from: the rows read back, what was observed, their folder."""
        path = f"{self.root}/loads/{load_id}-{uuid.uuid4().hex}"
        back, seen = write_observed(rows.hint("rebalance", *self.partition_cols), path, metrics, self.partition_cols)
        return back, seen, path

    def publish(self, staged: DataFrame, path: str, load_id: str) -> int:
        """Add the partitions of a staged load; how many there are. A load's earlier run is replaced."""
        self.create(staged.schema)
        values = [tuple(r) for r in staged.select(*self.partition_cols).distinct().collect()]  # one row a partition
        name, own = _q(self.name), f"{_q(LOAD_ID)}={_lit(load_id)}"
        before = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {name} PARTITION ({own})").collect()] if self.exists() else []
        if before:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({own})")
        for i in range(0, len(values), PER_STATEMENT):
            adds = " ".join(
                f"PARTITION ({own}, " + ", ".join(f"{_q(c)}={_lit(v)}" for c, v in zip(self.partition_cols, vs)) + f") LOCATION '{path}/{self._folder(vs)}'"
                for vs in values[i : i + PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {adds}")
        self.spark.catalog.refreshTable(self.name)
        return len(values)

    def _folder(self, values: Sequence) -> str:
        return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(self.partition_cols, values))

    def discard(self, path: str) -> None:
        """Delete a staged load that is not published."""
        remove_paths(self.spark, [path])
