"""Predicates as session functions, callable by name from SQL text and ``call_function``.

They are SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``): Catalyst puts the
body in the place of the call, so filters on them are optimised like written-out ones
and nothing runs in Python or row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from obsgate.sources.registry import TEMPERATURE, Layout

# FIXED VALUE: the name under which the predicate is called (also its column in quarantines).
ACCEPTABLE = "isAcceptableNullColumns"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_acceptable(spark: SparkSession, layout: Layout = TEMPERATURE, name: str = ACCEPTABLE) -> str:
    """Register the predicate "all mandatory columns are present" of ``layout``; its arguments are those columns in order."""
    types = dict(layout.fields)
    args = ", ".join(f"{_q(c)} {types[c].simpleString()}" for c in layout.mandatory)
    body = " AND ".join(f"{_q(c)} IS NOT NULL" for c in layout.mandatory)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS BOOLEAN RETURN {body}")
    return name


def call_acceptable(layout: Layout = TEMPERATURE, name: str = ACCEPTABLE) -> Column:
    """The registered predicate called on a frame's columns."""
    return F.call_function(name, *[F.col(c) for c in layout.mandatory])
