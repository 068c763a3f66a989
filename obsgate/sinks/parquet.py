"""Sinks: partitioned Parquet tables, quarantine tables, staging.

Writes use the ``rebalance`` hint on the partition columns: rows of one
output partition go to few tasks (few files), and AQE splits a partition
that holds a large share of the rows instead of funnelling it through one
task.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, types as T

MODES = ("append", "overwrite", "replace_load")
LOAD_ID = "LOAD_ID"


def new_load_id() -> str:
    return uuid.uuid4().hex


def load_path(path: str, load_id: str) -> str:
    """The folder that one load's rows have under ``path``."""
    return f"{path.rstrip('/')}/{LOAD_ID}={load_id}"


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str], mode: str = "append",
                load_id: str | None = None) -> None:
    """Hive-style partitioned Parquet table (``append`` as the original loader).

    ``replace_load`` writes the rows under their own ``LOAD_ID=<load_id>`` and
    replaces that folder only: running a load again gives the same table, and
    no other load's rows are touched. A table holds either kind, not both.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "replace_load":
        if not load_id:
            raise ValueError("replace_load needs the id of the load it replaces")
        path = load_path(path, load_id)
    out = df.hint("rebalance", *partition_cols) if partition_cols else df
    w = out.write.partitionBy(*partition_cols) if partition_cols else out.write
    w.mode("append" if mode == "append" else "overwrite").parquet(path)


def write_quarantine(bad: DataFrame, path: str, load_id: str, *, fmt: str = "csv") -> None:
    """Quarantine rows of one load, by source file, under ``LOAD_ID=<load_id>``.

    Neither another load nor another folder's file of the same name (rows
    carry ``file_path``) is overwritten; the same load run again replaces its own rows.
    """
    w = bad.hint("rebalance", "file_name").write.partitionBy("file_name").mode("overwrite")
    if fmt == "csv":
        # Raw lines keep their blanks and tabs (the CSV writer trims by default).
        w.options(header="true", ignoreLeadingWhiteSpace="false",
                  ignoreTrailingWhiteSpace="false").csv(load_path(path, load_id))
    else:
        w.format(fmt).save(load_path(path, load_id))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, read from the session.

    Where it is unset, a folder in the warehouse (which is shared as well) is set; of a local session it goes with the process.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    d = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/obsgate-staging-{uuid.uuid4().hex}"
    if sc.master.startswith("local"):
        atexit.register(shutil.rmtree, local_path(d), ignore_errors=True)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/obsgate/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the staged files instead of
    re-running the whole upstream plan) and lets several later jobs read the
    result columnar, with pruning, instead of recomputing it. The path is
    appended to ``paths`` so the caller can :func:`remove_paths` it later.
    """
    path = scratch_path(df.sparkSession, name)
    if paths is not None:
        paths.append(path)
    return write_observed(df, path)[0]


def write_observed(df: DataFrame, path: str, metrics: Mapping[str, Column] | None = None,
                   partition_cols: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """Write ``df``, observing aggregates of its rows on the way; the rows read back, and the aggregates.

    The observation stands right below the write, whose tasks count once each however often they run.
    """
    seen = Observation()
    out = df.observe(seen, *[c.alias(n) for n, c in metrics.items()]) if metrics else df
    w = out.write.partitionBy(*partition_cols) if partition_cols else out.write
    w.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    return back, dict(seen.get) if metrics else {}


class Stages:
    """The staged steps of one load, with what was observed of each.

    Every step is a folder under the shared one. A resumable load keeps its steps
    by load id: each is complete once its observations (with the source's
    fingerprint) are written beside it, and a later run of the same
    load takes complete steps of the same source from there instead of making them again.
    """

    def __init__(self, spark: SparkSession, load_id: str, resume: bool = False):
        self.spark, self.resume, self.source = spark, resume, ""
        self.root = f"{shared_dir(spark)}/obsgate/loads/{load_id}" if resume else scratch_path(spark, f"load-{load_id}")
        self.paths = [self.root]
        self.reused: list[str] = []

    def add(self, df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None) -> tuple[DataFrame, dict]:
        """The step ``df``, staged, and the aggregates ``metrics`` of its rows."""
        path, mark = f"{self.root}/{name}", f"{self.root}/{name}-done"
        if not self.resume:
            return write_observed(df, path, metrics)
        if exists(self.spark, f"{mark}/_SUCCESS"):
            done = self.spark.read.parquet(mark).first().asDict()
            if done.pop("__source") == self.source and set(done) == set(metrics or ()):
                self.reused.append(name)
                return self.spark.read.schema(df.schema).parquet(path), done
        remove_paths(self.spark, [mark])
        rows, seen = write_observed(df, path, metrics)
        types = {n: t.dataType for n, t in zip(metrics or (), df.agg(*[c.alias(n) for n, c in metrics.items()]).schema)} if metrics else {}
        schema = T.StructType([T.StructField("__source", T.StringType()), *[T.StructField(n, t) for n, t in types.items()]])
        self.spark.createDataFrame([(self.source, *[seen[n] for n in types])], schema).coalesce(1).write.parquet(mark)
        return rows, seen

    def failed(self) -> None:
        """Delete the steps of a load that broke off, unless it is to be resumed."""
        if not self.resume:
            self.release()

    def release(self) -> None:
        """Delete the staged folders once nothing reads them any more."""
        remove_paths(self.spark, self.paths)
        self.paths = []


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of the Parquet table at ``path``, None if there is none yet."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath) or not any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(jpath)):
        return None
    return spark.read.parquet(path).schema


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Recursively delete staged folders (Hadoop FileSystem, any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for test helpers that list local output)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["LOAD_ID", "Stages", "exists", "load_path", "local_path", "new_load_id", "remove_paths", "scratch_path", "shared_dir", "stage", "table_schema", "write_observed", "write_quarantine", "write_table"]
