"""Batch job: temperature load, then pressure load; one status table.

Usable from ``spark-submit``::

    spark-submit -m obsgate.plans.batch TEMP_GLOB PRESSURE_GLOB OUT_ROOT
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from obsgate.plans.pressure import load_pressure
from obsgate.plans.temperature import load_temperature
from obsgate.sinks.parquet import LOAD_ID


def load_all(spark: SparkSession, temperature_source, pressure_source, out_root: str | None = None,
             **options) -> DataFrame:
    """Run both loads; returns their status rows (temperature first).

    With ``out_root`` the per-file verdicts of each load are kept under
    ``fileReport/``, so that a refused file can be looked up. Staged folders are
    gone when it returns or raises.
    """
    def sub(name):
        return None if out_root is None else f"{out_root.rstrip('/')}/{name}"

    loads = ((load_temperature, temperature_source, "airTemperature"), (load_pressure, pressure_source, "airPressure"))
    out = []
    for load, source, name in loads:
        res = load(spark, source, sub(name), sub(f"corruptRecords/{name}"), **options)
        try:
            if out_root is not None:
                res.files.write.mode("overwrite").parquet(f"{sub(f'fileReport/{name}')}/{LOAD_ID}={res.load_id}")
            out.append(res.status)
        finally:
            res.release()
    return out[0].unionByName(out[1])


def main(argv: list[str]) -> int:
    if len(argv) != 3:
        print("usage: batch TEMPERATURE_PATH PRESSURE_PATH OUT_ROOT", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("obsgate-load").getOrCreate()
    status = load_all(spark, argv[0], argv[1], argv[2])
    status.show(truncate=False)
    return 0 if all(r["loaded"] for r in status.collect()) else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
