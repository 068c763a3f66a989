"""Line deduplication by site-relative frequency (operator 5, native DataFrame functions only).

A line's frequency on a host is the number of the host's pages that contain it
over all pages of the host. Lines above ``max_pct`` percent that stand on at
least ``min_pages`` pages are boilerplate and go; every other line stays, in
order, blank ones included.

Scale: each page contributes each line once, as a 64-bit hash; counts per
(host, line) are combined before the shuffle, so neither a hot host nor a hot
line gathers rows in one task. A host with L distinct lines a page on average
has at most ``100 * L / max_pct`` boilerplate lines, so the list per host is
bounded by the pages' length, not by their number. The lists, one row per host, are
staged, so their size is known when texts are joined with them: they are broadcast, and no
text is shuffled, while they are under the session's limit; beyond it hot hosts' partitions are split.

Defined results: null text: null, no lines. Null host: the pages without host
form one host. A text without boilerplate is returned unchanged, one of which
every line goes becomes empty. Repeated rows count as pages of their own. Extra
columns are kept by ``drop_boilerplate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgate.llm import common as C

MAX_PCT = 1  # hosts mix languages and sections, each with header and footer lines of its own on a few pages in a hundred
MIN_PAGES = 5


def _lines(text):
    return F.split(text, "\n", -1)


def _blank(line):
    return ~line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(df: DataFrame, *, host_col: str = "source", text_col: str = "text", max_pct: int = MAX_PCT, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, lines)``: hashes of the boilerplate lines of each host that has any."""
    pages = df.select(F.struct(F.col(f"`{host_col}`").alias("name")).alias("host"), F.col(f"`{text_col}`").alias("text"))
    own = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: ~_blank(x)), lambda x: F.xxhash64(x)))
    counts = pages.select("host", F.explode(own).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    frequent = counts.join(totals, "host").filter(F.col("n") * 100 > F.col("pages") * max_pct)
    return frequent.groupBy("host").agg(F.collect_list("line").alias("lines"))


def line_dedup(df: DataFrame, *, host_col: str = "source", text_col: str = "text", max_pct: int = MAX_PCT, min_pages: int = MIN_PAGES) -> DataFrame:
    """``df``'s rows as the struct ``row``, with ``kept_text``, ``n_lines`` and ``n_dropped``."""
    bad = C.stage(boilerplate(df, host_col=host_col, text_col=text_col, max_pct=max_pct, min_pages=min_pages), "boilerplate")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.struct(F.col(f"`{host_col}`").alias("name")).alias("host"))
    text = F.col("row").getField(text_col)
    joined = rows.join(bad, "host", "left").withColumn("all", _lines(text))
    kept = F.when(F.col("lines").isNull(), F.col("all")).otherwise(F.filter("all", lambda x: ~F.array_contains("lines", F.xxhash64(x))))
    out = joined.withColumn("kept", kept).withColumn("n_lines", F.coalesce(F.size("all"), F.lit(0)).cast("long"))
    out = out.withColumn("n_dropped", F.when(F.col("all").isNull(), 0).otherwise(F.size("all") - F.size("kept")).cast("long"))
    return out.select("row", F.when(F.col("n_dropped") == 0, text).otherwise(F.array_join("kept", "\n")).alias("kept_text"), F.when(F.col("all").isNull(), F.lit(0)).otherwise(F.col("n_lines")).cast("long").alias("n_lines"), "n_dropped")


def drop_boilerplate(df: DataFrame, *, text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """``df`` with its columns, boilerplate lines taken out of the text (and ``length_col`` counted again)."""
    out = line_dedup(df, text_col=text_col, **options)
    new = {text_col: F.col("kept_text")} | ({length_col: F.when(F.col("n_dropped") > 0, F.length("kept_text").cast(df.schema[length_col].dataType)).otherwise(F.col("row").getField(length_col))} if length_col else {})
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in df.columns])
