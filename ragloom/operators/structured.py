"""Structured model output over a reply column: X1 typed parse, X2 strict
validation, X3 lax (coercing) validation, X4 quarantine, X5 schema export.

Replies are parsed once into `variant` (`try_parse_json`: malformed text →
null, never an exception). `check` compiles any Spark type into one column
expression over that variant, strict or lax: the typed value and a list of
(path, reason). That separates the cases `from_json` alone conflates: missing
vs null vs wrong type, a number where a string is required, and whole floats
(22.0) that both reference validators accept as integers.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The typed reply of the structured-output examples.
FRIEND = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age", T.LongType()),
    T.StructField("is_available", T.BooleanType()),
])
FRIEND_LIST = T.StructType([T.StructField("friends", T.ArrayType(FRIEND))])
# Strings the lax validator reads as booleans (case-insensitive).
LAX_TRUE = ("1", "on", "t", "true", "y", "yes")
LAX_FALSE = ("0", "off", "f", "false", "n", "no")

_INT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")
_INT_BITS = {T.LongType: 64, T.IntegerType: 32, T.ShortType: 16, T.ByteType: 8}
ERROR = "array<struct<path:string,reason:string>>"
#: Metadata key of a field that a reply may leave out (or give as null).
OPTIONAL = {"optional": True}


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_number(v: Column) -> Column:
    t = _vtype(v)
    return t.isin(*_INT_TYPES) | t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")


def _is_whole_number(v: Column) -> Column:
    d = F.try_variant_get(v, "$", "double")
    return _vtype(v).isin(*_INT_TYPES) | (_is_number(v) & (d == F.floor(d)))


def _whole(v: Column) -> Column:
    """A whole number as a long (never through double unless written as one); beyond 64 bits null."""
    exact = F.try_variant_get(v, "$", "long")
    return F.when(_is_whole_number(v), F.when(_vtype(v) == "DOUBLE", F.try_variant_get(v, "$", "double").try_cast("long")).otherwise(exact))


def _lax_int(v: Column) -> Column:
    """Lax integer: whole numbers, integer strings, booleans; else null."""
    s = F.trim(F.try_variant_get(v, "$", "string"))
    return (F.when(_is_number(v), _whole(v))
             .when((_vtype(v) == "STRING") & s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("long"))
             .when(_vtype(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("long")))


def _lax_float(v: Column) -> Column:
    s = F.trim(F.try_variant_get(v, "$", "string"))
    return (F.when(_is_number(v), F.try_variant_get(v, "$", "double"))
             .when((_vtype(v) == "STRING") & s.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), s.try_cast("double"))
             .when(_vtype(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("double")))


def _lax_bool(v: Column) -> Column:
    s = F.lower(F.try_variant_get(v, "$", "string"))
    d = F.try_variant_get(v, "$", "double")
    return (F.when(_vtype(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
             .when((_vtype(v) == "STRING") & s.isin(*LAX_TRUE), F.lit(True))
             .when((_vtype(v) == "STRING") & s.isin(*LAX_FALSE), F.lit(False))
             .when(_is_number(v) & (d == 1), F.lit(True))
             .when(_is_number(v) & (d == 0), F.lit(False)))


def _scalar(v: Column, kind: T.DataType, lax: bool) -> tuple[Column, str]:
    """A scalar as `kind`, null where it is none, and what was expected."""
    if isinstance(kind, T.StringType):
        return F.when(_vtype(v) == "STRING", F.try_variant_get(v, "$", "string")), "expected string"
    if type(kind) in _INT_BITS:
        return (_lax_int(v) if lax else _whole(v)).try_cast(kind), "expected integer"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        x = _lax_float(v) if lax else F.when(_is_number(v), F.try_variant_get(v, "$", "double"))
        return x.cast(kind), "expected number"
    if isinstance(kind, T.DecimalType):
        given = _is_number(v) | (_vtype(v) == "STRING") if lax else _is_number(v)
        return F.when(given, F.try_variant_get(v, "$", "string").try_cast(kind)), "expected number"
    if isinstance(kind, T.BooleanType):
        return (_lax_bool(v) if lax else F.when(_vtype(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))), "expected boolean"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):  # JSON writes them as text
        return F.when(_vtype(v) == "STRING", F.try_variant_get(v, "$", "string").try_cast(kind)), f"expected {kind.typeName()}"
    raise TypeError(f"no reply type: {kind.simpleString()}")


def _let(value: Column, body) -> Column:
    """`body` over a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), 0)


def _error(path: Column, reason: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(reason).alias("reason"))).cast(ERROR)


def _flat(errors: Column) -> Column:
    return F.coalesce(F.flatten(errors), F.array().cast(ERROR))


def check(v: Column, kind: T.DataType, lax: bool = False, path: Column | str = "$") -> Column:
    """`struct<value, errors>` of a variant against any Spark type, compiled into one
    expression: `value` is the typed value, with nulls where the reply does not fit,
    `errors` lists each misfit as (path, reason). Structs are objects whose fields
    are required unless their metadata is `OPTIONAL`; unknown keys are
    allowed; arrays and maps are checked element by element; every part of
    the reply is read once. Strict mode coerces nothing (22.0 is an integer);
    `lax` reads `"22"`, `"true"` and the like."""
    path = F.lit(path) if isinstance(path, str) else path
    none = F.array().cast(ERROR)

    def result(value: Column, errors: Column) -> Column:
        return F.struct(value.cast(kind).alias("value"), errors.alias("errors"))

    misfit = {T.StructType: "expected object", T.MapType: "expected object", T.ArrayType: "expected array"}.get(type(kind))
    if isinstance(kind, T.VariantType):
        return result(v, none)
    if misfit is None:
        value, reason = _scalar(v, kind, lax)
        return _let(value, lambda x: result(x, F.when(x.isNull(), _error(path, reason)).otherwise(none)))
    wrong = result(F.lit(None), _error(path, misfit))

    if isinstance(kind, T.StructType):
        def field(f: T.StructField) -> Column:
            quoted = f"$['{f.name}']" if "'" not in f.name else f'$["{f.name}"]'
            here = F.concat(path, F.lit(f".{f.name}"))
            empty = F.struct(F.lit(None).cast(f.dataType).alias("value"), none.alias("errors"))
            if f.metadata.get("optional"):
                return _let(F.try_variant_get(v, quoted, "variant"), lambda x: F.when(
                    x.isNull() | F.is_variant_null(x), empty).otherwise(check(x, f.dataType, lax, here)))
            lost = empty.withField("errors", _error(here, "missing"))
            return _let(F.try_variant_get(v, quoted, "variant"), lambda x: F.when(x.isNull(), lost).otherwise(check(x, f.dataType, lax, here)))

        parts = [field(f).alias(f"f{n}") for n, f in enumerate(kind.fields)]
        if not parts:
            return F.when(_vtype(v).startswith("OBJECT"), result(F.struct(), none)).otherwise(wrong)
        whole = _let(F.struct(*parts), lambda s: result(
            F.struct(*(s[f"f{n}"]["value"].alias(f.name) for n, f in enumerate(kind.fields))),
            F.concat(*(s[f"f{n}"]["errors"] for n in range(len(parts))))))
        return F.when(_vtype(v).startswith("OBJECT"), whole).otherwise(wrong)

    if isinstance(kind, T.ArrayType):
        items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: check(
            x, kind.elementType, lax, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        whole = _let(items, lambda xs: result(F.transform(xs, lambda x: x["value"]), _flat(F.transform(xs, lambda x: x["errors"]))))
        return F.when(_vtype(v).startswith("ARRAY"), whole).otherwise(wrong)

    if not isinstance(kind.keyType, T.StringType):
        raise TypeError("keys of a JSON object are strings")
    entries = F.transform_values(F.try_variant_get(v, "$", "map<string,variant>"), lambda key, x: check(
        x, kind.valueType, lax, F.concat(path, F.lit("."), key)))
    whole = _let(entries, lambda m: result(F.transform_values(m, lambda key, x: x["value"]),
                                           _flat(F.transform(F.map_values(m), lambda x: x["errors"]))))
    return F.when(_vtype(v).startswith("OBJECT"), whole).otherwise(wrong)


def parse_reply(reply: Column | str, schema: T.DataType = FRIEND_LIST, lax: bool = False) -> Column:
    """`check` of a JSON text, parsed once; malformed text is one error at `$`."""
    r = F.col(reply) if isinstance(reply, str) else reply
    bad = F.struct(F.lit(None).cast(schema).alias("value"), _error(F.lit("$"), "not JSON").alias("errors"))
    return _let(F.try_parse_json(r), lambda v: F.when(v.isNull(), bad).otherwise(check(v, schema, lax)))


def validate_strict(reply: Column | str, schema: T.DataType = FRIEND_LIST) -> Column:
    """Every required part is there and has its type; extra keys are allowed; nothing is coerced."""
    return F.size(parse_reply(reply, schema)["errors"]) == 0


def parse_lax(reply: Column | str) -> Column:
    """X1 (lax typing): `array<struct<name, age, is_available>>` with coercions,
    or null when the reply is not an object with a `friends` array."""
    return parse_reply(reply, FRIEND_LIST, lax=True)["value"]["friends"]


def validate_lax(reply: Column | str, schema: T.DataType = FRIEND_LIST) -> Column:
    """As X2 but `"22"` → 22, `"true"` → true and similar coercions accepted;
    a number for the name, a fractional age, a missing field stay invalid."""
    return F.size(parse_reply(reply, schema, lax=True)["errors"]) == 0


def quarantine(df: DataFrame, reply_col: str, mode: str = "strict", failfast: bool = False,
               schema: T.DataType = FRIEND_LIST, out_col: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """Split into (valid, invalid). Valid rows gain `out_col`, the typed reply;
    invalid ones `errors`, every misfit with its path. With `failfast`, the first
    invalid reply fails the job instead (the Python example's behaviour)."""
    flagged = df.withColumn("__checked", parse_reply(reply_col, schema, mode != "strict"))
    fits = F.size("__checked.errors") == 0
    if failfast:
        fits = F.when(fits, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("invalid reply: "), F.coalesce(F.col(reply_col).cast("string"), F.lit("null")))))
    valid = flagged.filter(fits).withColumn(out_col, F.col("__checked.value")).drop("__checked")
    invalid = flagged.filter(~fits).withColumn("errors", F.col("__checked.errors")).drop("__checked")
    return valid, invalid


def struct_to_json_schema(schema: T.DataType, required_all: bool = True) -> dict:
    """JSON Schema of a Spark type (metadata only, runs on the driver)."""
    if isinstance(schema, T.StructType):
        props = {f.name: struct_to_json_schema(f.dataType, required_all) for f in schema.fields}
        out = {"type": "object", "properties": props}
        if required_all:
            out["required"] = [f.name for f in schema.fields]
        return out
    if isinstance(schema, T.ArrayType):
        return {"type": "array", "items": struct_to_json_schema(schema.elementType, required_all)}
    if isinstance(schema, T.MapType):
        return {"type": "object", "additionalProperties": struct_to_json_schema(schema.valueType, required_all)}
    if isinstance(schema, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return {"type": "integer"}
    if isinstance(schema, (T.DoubleType, T.FloatType, T.DecimalType)):
        return {"type": "number"}
    if isinstance(schema, T.BooleanType):
        return {"type": "boolean"}
    return {"type": "string"}


def json_schema_text(schema: T.DataType) -> str:
    return json.dumps(struct_to_json_schema(schema))
