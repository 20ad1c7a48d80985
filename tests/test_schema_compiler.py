"""Any Spark type compiled into a check of JSON replies."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragloom.operators import structured as X

NESTED = T.StructType([
    T.StructField("a", T.StructType([T.StructField("n", T.IntegerType()), T.StructField("it's", T.StringType())])),
    T.StructField("xs", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("m", T.MapType(T.StringType(), T.StructType([T.StructField("ok", T.BooleanType())]))),
    T.StructField("d", T.DateType(), metadata=X.OPTIONAL),
    T.StructField("any", T.VariantType(), metadata=X.OPTIONAL),
])
GOOD = '{"a": {"n": 1, "it\'s": "x"}, "xs": [[1, 2.5], []], "m": {"k": {"ok": true}}, "d": "2024-02-03", "any": [1]}'

CASES = [  # reply, strict errors, lax errors
    (GOOD, [], []),
    (GOOD.replace('"n": 1', '"n": "1"'), ["$.a.n:expected integer"], []),
    (GOOD.replace('"n": 1', '"n": 3000000000'), ["$.a.n:expected integer"], ["$.a.n:expected integer"]),
    (GOOD.replace("2.5", '"2.5"'), ["$.xs[0][1]:expected number"], []),
    (GOOD.replace("[]]", "{}]"), ["$.xs[1]:expected array"], ["$.xs[1]:expected array"]),
    (GOOD.replace("true", '"yes"'), ["$.m.k.ok:expected boolean"], []),
    (GOOD.replace('{"ok": true}', "{}"), ["$.m.k.ok:missing"], ["$.m.k.ok:missing"]),
    (GOOD.replace('"2024-02-03"', '"soon"'), ["$.d:expected date"], ["$.d:expected date"]),
    (GOOD.replace('"2024-02-03"', "null"), [], []),
    (GOOD.replace(', "any": [1]', ""), [], []),
    (GOOD.replace('"it\'s": "x"', '"it\'s": null'), ["$.a.it's:expected string"], ["$.a.it's:expected string"]),
    ("[]", ["$:expected object"], ["$:expected object"]),
    ("{", ["$:not JSON"], ["$:not JSON"]),
    ("", ["$:not JSON"], ["$:not JSON"]),
    (None, ["$:not JSON"], ["$:not JSON"]),
    ('{"xs": 3}', ["$.a:missing", "$.xs:expected array", "$.m:missing"], ["$.a:missing", "$.xs:expected array", "$.m:missing"]),
]


def test_nested_schema(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(CASES)], "i int, r string")
    both = df.select("i", X.parse_reply("r", NESTED)["errors"].alias("s"), X.parse_reply("r", NESTED, lax=True).alias("l")).orderBy("i").collect()
    for row, (_, strict, lax) in zip(both, CASES, strict=True):
        assert [f"{e['path']}:{e['reason']}" for e in row["s"]] == strict, row["i"]
        assert [f"{e['path']}:{e['reason']}" for e in row["l"]["errors"]] == lax, row["i"]
    assert both[1]["l"]["value"]["a"]["n"] == 1 and both[3]["l"]["value"]["xs"] == [[1.0, 2.5], []]
    assert both[5]["l"]["value"]["m"]["k"]["ok"] is True


def test_value_types_and_quarantine(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(CASES)], "i int, r string")
    valid, invalid = X.quarantine(df, "r", "lax", schema=NESTED)
    assert valid.schema["parsed"].dataType.simpleString() == NESTED.simpleString()
    assert sorted(r["i"] for r in valid.collect()) == [i for i, (_, _, lax) in enumerate(CASES) if not lax]
    assert {r["i"]: len(r["errors"]) for r in invalid.collect()} == {i: len(lax) for i, (_, _, lax) in enumerate(CASES) if lax}


def test_top_level_kinds(spark):
    df = spark.createDataFrame([("[1, 2]",), ('"x"',), ("3",), ("{}",)], "r string")
    arrays = df.select(X.parse_reply("r", T.ArrayType(T.LongType()))).collect()
    assert [len(r[0]["errors"]) for r in arrays] == [0, 1, 1, 1] and arrays[0][0]["value"] == [1, 2]
    assert [len(r[0]["errors"]) for r in df.select(X.parse_reply("r", T.StringType())).collect()] == [1, 0, 1, 1]
    assert [len(r[0]["errors"]) for r in df.select(X.parse_reply("r", T.StructType([]))).collect()] == [1, 1, 1, 0]
    with pytest.raises(TypeError):
        X.check(F.col("v"), T.BinaryType())
    with pytest.raises(TypeError):
        X.check(F.col("v"), T.MapType(T.LongType(), T.StringType()))


def test_deep_schema_compiles_once(spark):
    kind = T.LongType()
    for _ in range(8):
        kind = T.StructType([T.StructField("x", kind)])
    text = '{"x": ' * 8 + "7" + "}" * 8
    got = spark.createDataFrame([(text,)], "r string").select(X.parse_reply("r", kind)["errors"]).first()[0]
    assert got == []
