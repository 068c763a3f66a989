"""Strict typed parse of delimited text lines (one narrow stage, no UDF).

A line is *corrupt* when its token count differs from the layout
(``ARITY``) or a present token fails its type (``TYPE``). Blank tokens are
NULL and not corrupt; lines without any non-blank character are skipped,
like the CSV reader does.

Tokenising uses ``from_csv`` with an all-string schema, so quoting behaves
exactly like Spark's CSV reader; the type checks are explicit expressions
over every token, so column pruning downstream can never hide a bad token.

Policies for rows with a TYPE failure:

* ``null_row`` (default): every layout column becomes NULL, as the CSV
  reader of the original loader did, so such rows are never "acceptable".
* ``partial``: only the failing tokens become NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsgate.functions.tokens import NON_BLANK, typed_token_sql
from obsgate.sources.registry import Layout

CORRUPT = "_corrupt_record"
ERROR_CLASS = "_error_class"
POLICIES = ("null_row", "partial")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _tokens(value: Column, layout: Layout, delimiter: str) -> Column:
    ddl = ", ".join(f"{_q(n)} STRING" for n in [*layout.names, CORRUPT])
    return F.from_csv(
        value, ddl, {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _layout_exprs(tok: str, layout: Layout, prefix: str) -> dict[str, str]:
    """SQL for the typed columns plus the arity flag of one layout's tokens."""
    out = {prefix + name: typed_token_sql(f"{_q(tok)}.{_q(name)}", dtype)[0] for name, dtype in layout.fields}
    out[prefix + "arity"] = f"({_q(tok)}.{_q(CORRUPT)} IS NOT NULL)"
    return out


def _type_flag(tok: str, layout: Layout, prefix: str) -> str:
    """SQL for the type flag, from tokens and their typed values: each token is typed once."""
    return "(" + " OR ".join(f"({_q(tok)}.{_q(n)} IS NOT NULL AND {_q(prefix + n)} IS NULL)" for n in layout.names) + ")"


def parse_by_layout(
    df: DataFrame,
    layouts: Mapping[str, Layout],
    layout_col: str | None = None,
    *,
    value_col: str = "value",
    policy: str = "null_row",
    delimiter: str = "\t",
) -> DataFrame:
    """Parse ``value_col`` of every row against the layout named in ``layout_col``.

    With several layouts all of them are parsed in the same projection, each
    guarded by its key, so mixed inputs need one scan and no union. The output
    keeps the input columns and adds the union of all layout columns (NULL
    where a row's layout lacks the column), ``_corrupt_record`` (the raw line
    when corrupt) and ``_error_class`` (``ARITY``, ``TYPE``, ``ARITY_TYPE`` or
    NULL). Rows whose layout key is NULL/unknown get NULL everywhere and no
    error class: they belong to files that are rejected as a whole.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if len(layouts) > 1 and layout_col is None:
        raise ValueError("layout_col is required with more than one layout")
    value_col_expr = F.col(value_col)
    keys = list(layouts)

    # Tokenise once per row. The token structs are produced by a Generate
    # (inline of a one-element array) so they become plain attributes:
    # otherwise Catalyst inlines from_csv into every typed column and into
    # pushed-down filters and the line is re-tokenised dozens of times.
    tok_cols = {}
    for i, (key, layout) in enumerate(layouts.items()):
        tok = _tokens(value_col_expr, layout, delimiter)
        if layout_col is not None:
            tok = F.when(F.col(layout_col) == F.lit(key), tok)
        tok_cols[key] = (f"__tok{i}", tok)
    # The blank-line filter tests the generated copy of the line, so Catalyst
    # cannot push it below the Generate (into an upstream scan stage, where
    # it would re-derive a computed line just to test it).
    lines = df.select(
        "*",
        F.inline(F.array(F.struct(value_col_expr.alias("__line"),
                                  *[t.alias(n) for n, t in tok_cols.values()]))),
    ).filter(F.col("__line").rlike(NON_BLANK))

    # Typed values and flags per layout, materialised the same way: filters
    # downstream (good rows, acceptable rows) then test plain attributes
    # instead of re-running every token check inside the pushed-down filter.
    # Expressions are written as SQL text: one JVM call per step instead of
    # several per column.
    typed: dict[str, str] = {}
    prefixes = {}
    for i, (key, layout) in enumerate(layouts.items()):
        prefixes[key] = f"__p{i}_"
        typed.update(_layout_exprs(tok_cols[key][0], layout, prefixes[key]))
    toks = {n for n, _ in tok_cols.values()}
    inline = "inline(array(struct(" + ", ".join(f"{e} AS {_q(n)}" for n, e in typed.items()) + ")))"
    lines = lines.select(*[F.col(_q(c)) for c in lines.columns if c != "__line"], F.expr(inline))
    flags = {prefixes[key] + "type": _type_flag(tok_cols[key][0], layout, prefixes[key]) for key, layout in layouts.items()}
    lines = lines.selectExpr(*[_q(c) for c in lines.columns if c not in toks], *[f"{e} AS {_q(n)}" for n, e in flags.items()])
    typed |= flags

    def pick(get) -> str:
        if layout_col is None:
            return get(keys[0])
        branches = [(k, get(k)) for k in keys]
        whens = " ".join(f"WHEN {_q(layout_col)} = {_lit(k)} THEN {v}" for k, v in branches if v is not None)
        return f"CASE {whens} END"

    def value(key: str, name: str) -> str | None:
        if name not in layouts[key].names:
            return None
        v = _q(prefixes[key] + name)
        return f"CASE WHEN NOT {_q(prefixes[key] + 'type')} THEN {v} END" if policy == "null_row" else v

    out_fields: dict[str, T.DataType] = {}
    for layout in layouts.values():
        for name, dtype in layout.fields:
            out_fields.setdefault(name, dtype)

    arity = f"coalesce({pick(lambda k: _q(prefixes[k] + 'arity'))}, false)"
    typ = f"coalesce({pick(lambda k: _q(prefixes[k] + 'type'))}, false)"
    err = (f"CASE WHEN {arity} AND {typ} THEN 'ARITY_TYPE' WHEN {arity} THEN 'ARITY' "
           f"WHEN {typ} THEN 'TYPE' END")
    exprs = [f"CAST({pick(lambda k, n=name: value(k, n))} AS {dtype.simpleString()}) AS {_q(name)}"
             for name, dtype in out_fields.items()]
    exprs.append(f"{err} AS {_q(ERROR_CLASS)}")
    exprs.append(f"CASE WHEN {err} IS NOT NULL THEN {_q(value_col)} END AS {_q(CORRUPT)}")
    new_names = set(out_fields) | {ERROR_CLASS, CORRUPT}
    keep = [_q(c) for c in lines.columns if c not in typed and c not in new_names]
    return lines.selectExpr(*keep, *exprs)


def parse_lines(
    df: DataFrame,
    layout: Layout,
    *,
    value_col: str = "value",
    policy: str = "null_row",
    delimiter: str = "\t",
) -> DataFrame:
    """Parse every line of ``df`` against one layout (see :func:`parse_by_layout`)."""
    return parse_by_layout(
        df, {layout.name: layout}, None, value_col=value_col, policy=policy, delimiter=delimiter
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    """Rows without an error class."""
    return parsed.filter(F.col(ERROR_CLASS).isNull())


def bad_rows(parsed: DataFrame) -> DataFrame:
    """Rows with an error class."""
    return parsed.filter(F.col(ERROR_CLASS).isNotNull())
