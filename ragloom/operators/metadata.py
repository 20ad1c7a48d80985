"""P4 metadata sanitising and F7 conversions.

Document metadata arrives as free-form JSON (a `variant`). The store keeps
only scalar values: strings, numbers and booleans pass; a non-empty list is
kept as its JSON text; nulls, nested objects and empty lists are dropped.
Done per row with map functions (no explode, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALAR_PREFIXES = ("STRING", "BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL", "BOOLEAN")


def sanitize_metadata(meta: Column | str) -> Column:
    """`variant` (JSON object) → `map<string,string>` of the kept entries.

    Lists are rendered the way Python prints a list (`['a', 2, True, None]`,
    see `py_list_text`). A non-object input yields an empty map.
    """
    v = F.col(meta) if isinstance(meta, str) else meta
    m = F.try_variant_get(v, "$", "map<string,variant>")

    def keep(k, x):
        t = F.schema_of_variant(x)
        scalar = F.lit(False)
        for p in _SCALAR_PREFIXES:
            scalar = scalar | t.startswith(p)
        non_empty_list = t.startswith("ARRAY") & (F.array_size(F.try_variant_get(x, "$", "array<variant>")) > 0)
        return scalar | non_empty_list

    def render(k, x):
        t = F.schema_of_variant(x)
        return F.when(t.startswith("ARRAY"), py_list_text(x)).otherwise(F.try_variant_get(x, "$", "string"))

    kept = F.transform_values(F.map_filter(m, keep), render)
    return F.coalesce(kept, F.create_map().cast("map<string,string>"))


def bytes_to_text(b: Column | str) -> Column:
    """bytes → UTF-8 text (null when the bytes are not valid UTF-8)."""
    c = F.col(b) if isinstance(b, str) else b
    s = c.cast("string")
    return F.when(F.is_valid_utf8(s), s)


def list_to_text(a: Column | str) -> Column:
    """list → string (JSON form)."""
    c = F.col(a) if isinstance(a, str) else a
    return F.to_json(c)


def _py_str(s: Column) -> Column:
    """A string as Python's `repr` writes it: single quotes unless the text
    holds a single quote and no double quote; backslash, newline, carriage
    return and tab escaped."""
    esc = s
    for raw, rep in (("\\\\", "\\\\\\\\"), ("\n", "\\\\n"), ("\r", "\\\\r"), ("\t", "\\\\t")):
        esc = F.regexp_replace(esc, raw, rep)
    dq = F.instr(s, "'") > 0
    dq = dq & (F.instr(s, '"') == 0)
    single = F.concat(F.lit("'"), F.regexp_replace(esc, "'", "\\\\'"), F.lit("'"))
    return F.when(dq, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(single)


def _py_scalar(x: Column) -> Column:
    t = F.schema_of_variant(x)
    d = F.try_variant_get(x, "$", "double")
    return (F.when(t == "VOID", F.lit("None"))
             .when(t == "BOOLEAN", F.when(F.try_variant_get(x, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
             .when(t == "STRING", _py_str(F.try_variant_get(x, "$", "string")))
             .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.try_variant_get(x, "$", "string"))
             .when(t.startswith("DECIMAL") | (t == "DOUBLE"), d.cast("string"))
             .otherwise(F.to_json(x)))


def py_list_text(v: Column) -> Column:
    """a JSON list as Python's `str(list)` prints it, for lists of scalars
    (strings, integers, ordinary floats, booleans, null); nested values are
    written as JSON text. JSON `-0.0` parses to an unsigned decimal zero and
    prints as `0.0`."""
    items = F.try_variant_get(v, "$", "array<variant>")
    return F.concat(F.lit("["), F.array_join(F.transform(items, _py_scalar), ", "), F.lit("]"))
