"""Registered structured-reply queries: typed parse, strict and lax validation,
quarantine counts. Replies are derived from `customer` rows; the fixture rule
`c_custkey % 11` picks which defect (if any) a reply carries, so every
validator branch is exercised over the whole table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragloom.operators import structured as X
from ragloom.plans.catalog import register
from ragloom.session import table

N_CASES = 11
SECOND = ', {"name": "Alonso", "age": 23, "is_available": true}'


def replies(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    case = (F.col("c_custkey") % N_CASES).cast("int")
    age = (F.col("c_custkey") % 90 + 10).cast("string")
    avail = F.when(F.col("c_acctbal") > 0, "true").otherwise("false")
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit('"'))

    def friend(n, a, b, extra=""):
        return F.concat(F.lit('{"name": '), n, F.lit(', "age": '), a, F.lit(', "is_available": '), b, F.lit(extra), F.lit("}"))

    def wrap(f):
        return F.concat(F.lit('{"friends": ['), f, F.lit(SECOND + "]}"))

    q = F.lit('"')
    reply = (F.when(case == 0, wrap(friend(name, age, avail)))
              .when(case == 1, wrap(friend(name, F.concat(q, age, q), avail)))
              .when(case == 2, wrap(F.concat(F.lit('{"name": '), name, F.lit(', "is_available": '), avail, F.lit("}"))))
              .when(case == 3, F.concat(F.lit('{"friends": [{"name": '), name, F.lit(', "age": '), age))
              .when(case == 4, wrap(friend(name, F.concat(age, F.lit(".5")), avail)))
              .when(case == 5, wrap(friend(name, F.concat(age, F.lit(".0")), avail)))
              .when(case == 6, wrap(friend(name, age, F.concat(q, avail, q))))
              .when(case == 7, wrap(friend(F.col("c_nationkey").cast("string"), age, avail)))
              .when(case == 8, wrap(friend(name, age, avail, ', "city": "Madrid"')))
              .when(case == 9, F.lit('{"friends": []}'))
              .otherwise(F.lit("{}")))
    return c.select("c_custkey", case.alias("case_no"), reply.alias("reply"))


_REPLY_SQL = """
r AS (
  SELECT c_custkey, (c_custkey % 11)::INTEGER AS case_no, CASE c_custkey % 11
    WHEN 0 THEN '{"friends": [{"name": "' || c_name || '", "age": ' || (c_custkey % 90 + 10)::VARCHAR || ', "is_available": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || '}' || $S$ || ']}'
    WHEN 1 THEN '{"friends": [{"name": "' || c_name || '", "age": "' || (c_custkey % 90 + 10)::VARCHAR || '", "is_available": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || '}' || $S$ || ']}'
    WHEN 2 THEN '{"friends": [{"name": "' || c_name || '", "is_available": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || '}' || $S$ || ']}'
    WHEN 3 THEN '{"friends": [{"name": "' || c_name || '", "age": ' || (c_custkey % 90 + 10)::VARCHAR
    WHEN 4 THEN '{"friends": [{"name": "' || c_name || '", "age": ' || (c_custkey % 90 + 10)::VARCHAR || '.5, "is_available": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || '}' || $S$ || ']}'
    WHEN 5 THEN '{"friends": [{"name": "' || c_name || '", "age": ' || (c_custkey % 90 + 10)::VARCHAR || '.0, "is_available": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || '}' || $S$ || ']}'
    WHEN 6 THEN '{"friends": [{"name": "' || c_name || '", "age": ' || (c_custkey % 90 + 10)::VARCHAR || ', "is_available": "' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || '"}' || $S$ || ']}'
    WHEN 7 THEN '{"friends": [{"name": ' || c_nationkey::VARCHAR || ', "age": ' || (c_custkey % 90 + 10)::VARCHAR || ', "is_available": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || '}' || $S$ || ']}'
    WHEN 8 THEN '{"friends": [{"name": "' || c_name || '", "age": ' || (c_custkey % 90 + 10)::VARCHAR || ', "is_available": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || ', "city": "Madrid"}' || $S$ || ']}'
    WHEN 9 THEN '{"friends": []}'
    ELSE '{}' END AS reply
  FROM customer
),
p AS (
  SELECT *, CASE WHEN json_valid(reply) AND json_type(reply) = 'OBJECT' AND json_type(reply, '$.friends') = 'ARRAY'
                 THEN json_extract(reply, '$.friends[*]') END AS fr
  FROM r
),
v AS (
  SELECT c_custkey, case_no, fr,
    fr IS NOT NULL AND coalesce(list_bool_and(list_transform(fr, lambda f: coalesce(
        json_type(f) = 'OBJECT' AND json_type(f, '$.name') = 'VARCHAR'
        AND (json_type(f, '$.age') IN ('BIGINT', 'UBIGINT')
             OR (json_type(f, '$.age') = 'DOUBLE' AND json_extract(f, '$.age')::DOUBLE = floor(json_extract(f, '$.age')::DOUBLE)))
        AND json_type(f, '$.is_available') = 'BOOLEAN', false))), true) AS strict_valid,
    list_transform(fr, lambda f: {
      'name': CASE WHEN json_type(f, '$.name') = 'VARCHAR' THEN json_extract_string(f, '$.name') END,
      'age': CASE WHEN json_type(f, '$.age') IN ('BIGINT', 'UBIGINT') THEN json_extract(f, '$.age')::BIGINT
                  WHEN json_type(f, '$.age') = 'DOUBLE' AND json_extract(f, '$.age')::DOUBLE = floor(json_extract(f, '$.age')::DOUBLE)
                       THEN json_extract(f, '$.age')::DOUBLE::BIGINT
                  WHEN json_type(f, '$.age') = 'VARCHAR' AND regexp_full_match(trim(json_extract_string(f, '$.age')), '[+-]?[0-9]+')
                       THEN trim(json_extract_string(f, '$.age'))::BIGINT
                  WHEN json_type(f, '$.age') = 'BOOLEAN' THEN CASE WHEN json_extract(f, '$.age')::BOOLEAN THEN 1 ELSE 0 END END,
      'avail': CASE WHEN json_type(f, '$.is_available') = 'BOOLEAN' THEN json_extract(f, '$.is_available')::BOOLEAN
                    WHEN json_type(f, '$.is_available') = 'VARCHAR' AND lower(json_extract_string(f, '$.is_available')) IN ('1', 'on', 't', 'true', 'y', 'yes') THEN true
                    WHEN json_type(f, '$.is_available') = 'VARCHAR' AND lower(json_extract_string(f, '$.is_available')) IN ('0', 'off', 'f', 'false', 'n', 'no') THEN false
                    WHEN json_type(f, '$.is_available') IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND json_extract(f, '$.is_available')::DOUBLE = 1 THEN true
                    WHEN json_type(f, '$.is_available') IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND json_extract(f, '$.is_available')::DOUBLE = 0 THEN false END,
      'obj': json_type(f) = 'OBJECT'}) AS lax
  FROM p
),
w AS (
  SELECT *, fr IS NOT NULL AND coalesce(list_bool_and(list_transform(lax, lambda x:
      coalesce(x.obj AND x.name IS NOT NULL AND x.age IS NOT NULL AND x.avail IS NOT NULL, false))), true) AS lax_valid
  FROM v
)""".replace("$S$", "'" + SECOND + "'")


@register("validate_replies", f"""
WITH {_REPLY_SQL}
SELECT c_custkey, case_no, strict_valid, lax_valid, len(fr)::INTEGER AS n_friends,
       CASE WHEN lax_valid THEN coalesce(list_sum(list_transform(lax, lambda x: x.age)), 0) END::BIGINT AS age_total,
       CASE WHEN lax_valid THEN len(list_filter(lax, lambda x: x.avail)) END::INTEGER AS n_available
FROM w
""")
def q_validate_replies(spark, sf_dir):
    """X1 + X2 + X3: per reply, strict and lax validity, and the lax-typed parse
    summarised (friend count, age total, available count)."""
    out = _checked(spark, sf_dir).select(
        "c_custkey", "case_no", (F.size("strict.errors") == 0).alias("strict_valid"), (F.size("lax.errors") == 0).alias("lax_valid"),
        F.col("lax.value.friends").alias("__p"))
    ages = F.aggregate(F.transform("__p", lambda f: f["age"]), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("c_custkey", "case_no", "strict_valid", "lax_valid",
                      F.when(F.col("__p").isNotNull(), F.size("__p")).alias("n_friends"),
                      F.when(F.col("lax_valid"), ages).alias("age_total"),
                      F.when(F.col("lax_valid"), F.size(F.filter("__p", lambda f: f["is_available"]))).alias("n_available"))


def _checked(spark, sf_dir):
    """Replies with `strict` and `lax`, what the compiled schema says of each."""
    return replies(spark, sf_dir).select("c_custkey", "case_no", X.parse_reply("reply").alias("strict"),
                                         X.parse_reply("reply", lax=True).alias("lax"))


def _listed(errors):
    return F.array_join(F.transform(errors, lambda e: F.concat_ws(":", e["path"], e["reason"])), ";")


def _errors_sql(lax: bool) -> str:
    """SQL of a reply's misfits, field by field, from its JSON."""
    age = "json_type(f, '$.age') IN ('BIGINT', 'UBIGINT') OR (json_type(f, '$.age') = 'DOUBLE' AND json_extract(f, '$.age')::DOUBLE = floor(json_extract(f, '$.age')::DOUBLE))"
    flag = "json_type(f, '$.is_available') = 'BOOLEAN'"
    if lax:
        age += " OR (json_type(f, '$.age') = 'VARCHAR' AND regexp_full_match(trim(json_extract_string(f, '$.age')), '[+-]?[0-9]+'))"
        flag += " OR lower(json_extract_string(f, '$.is_available')) IN ('true', 'false')"

    def part(field, fits, kind):
        at = f"'$.friends[' || (i - 1)::VARCHAR || '].{field}:'"
        return f"CASE WHEN json_type(f, '$.{field}') IS NULL THEN {at} || 'missing' WHEN NOT ({fits}) THEN {at} || 'expected {kind}' END"
    each = ", ".join((part("name", "json_type(f, '$.name') = 'VARCHAR'", "string"), part("age", age, "integer"), part("is_available", flag, "boolean")))
    return f"""CASE WHEN NOT json_valid(reply) THEN '$:not JSON' WHEN json_type(reply, '$.friends') IS NULL THEN '$.friends:missing'
      ELSE array_to_string(list_filter(flatten(list_transform(fr, lambda f, i: [{each}])), lambda x: x IS NOT NULL), ';') END"""


@register("reply_errors", f"""
WITH {_REPLY_SQL}
SELECT c_custkey, {_errors_sql(False)} AS strict_errors, {_errors_sql(True)} AS lax_errors FROM p
""")
def q_reply_errors(spark, sf_dir):
    """X2 + X3: every misfit of a reply with its path and reason, under both validators."""
    return _checked(spark, sf_dir).select("c_custkey", _listed(F.col("strict.errors")).alias("strict_errors"),
                                          _listed(F.col("lax.errors")).alias("lax_errors"))


ORDER_REPLY = T.StructType([
    T.StructField("order", T.StructType([
        T.StructField("id", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("status", T.StringType()),
        T.StructField("placed", T.DateType())])),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("note", T.StringType(), metadata=X.OPTIONAL),
])
ORDER_CASES = 7


def order_replies(spark, sf_dir):
    """Replies about orders, nested three deep; `o_orderkey % 7` picks the defect."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed"),
                                              "o_orderpriority")
    case, key = F.col("o_orderkey") % ORDER_CASES, F.col("o_orderkey").cast("string")

    def text(c):
        return F.concat(F.lit('"'), c, F.lit('"'))
    head = F.concat(F.lit('{"id": '), F.when(case == 1, text(key)).otherwise(key),
                    F.when(case == 2, "").otherwise(F.concat(F.lit(', "total": '), F.col("o_totalprice").cast("string"))),
                    F.lit(', "status": '), text(F.col("o_orderstatus")), F.lit(', "placed": '),
                    F.when(case == 6, text(F.lit("soon"))).otherwise(text(F.col("placed"))), F.lit("}"))
    tags = F.concat(F.lit("["), text(F.col("o_orderpriority")), F.when(case == 3, ", 3").otherwise(""), F.lit("]"))
    scores = F.concat(F.lit('{"risk": 0.5, "size": '), F.when(case == 4, '"3"').otherwise("3"), F.lit("}"))
    reply = F.concat(F.lit('{"order": '), F.when(case == 5, "[]").otherwise(head), F.lit(', "tags": '), tags, F.lit(', "scores": '), scores,
                     F.when(case == 0, ', "note": null').otherwise(""), F.lit("}"))
    return o.select("o_orderkey", reply.alias("reply"))


_ORDER_ERRORS = {1: "$.order.id:expected integer", 2: "$.order.total:missing", 3: "$.tags[1]:expected string",
                 4: "$.scores.size:expected number", 5: "$.order:expected object", 6: "$.order.placed:expected date"}


def _order_sql(name, cases):
    return "CASE o_orderkey % 7 " + " ".join(f"WHEN {k} THEN '{_ORDER_ERRORS[k]}'" for k in cases) + f" ELSE '' END AS {name}"


@register("validate_orders", f"""
SELECT o_orderkey, {_order_sql("strict_errors", (1, 2, 3, 4, 5, 6))}, {_order_sql("lax_errors", (2, 3, 5, 6))},
       CASE WHEN o_orderkey % 7 <> 5 THEN o_orderkey END AS id,
       CASE WHEN o_orderkey % 7 NOT IN (2, 5) THEN o_totalprice END AS total,
       CASE WHEN o_orderkey % 7 NOT IN (5, 6) THEN strftime(o_orderdate, '%Y-%m-%d') END AS placed,
       CASE WHEN o_orderkey % 7 = 3 THEN 2 ELSE 1 END AS n_tags, 3.5::DOUBLE AS score_total
FROM orders
""")
def q_validate_orders(spark, sf_dir):
    """X1-X3 over another schema: nested structs, an array, a map, a date and an
    optional field, compiled from the type; the lax value as far as it fits."""
    both = order_replies(spark, sf_dir).select("o_orderkey", X.parse_reply("reply", ORDER_REPLY).alias("strict"),
                                               X.parse_reply("reply", ORDER_REPLY, lax=True).alias("lax"))
    v = F.col("lax.value")
    return both.select("o_orderkey", _listed(F.col("strict.errors")).alias("strict_errors"), _listed(F.col("lax.errors")).alias("lax_errors"),
                       v["order"]["id"].alias("id"), v["order"]["total"].alias("total"),
                       F.date_format(v["order"]["placed"], "yyyy-MM-dd").alias("placed"), F.size(v["tags"]).alias("n_tags"),
                       F.aggregate(F.map_values(v["scores"]), F.lit(0.0), lambda a, x: a + x).alias("score_total"))


@register("quarantine_counts", f"""
WITH {_REPLY_SQL}
SELECT case_no, count(*) FILTER (WHERE strict_valid) AS strict_ok, count(*) FILTER (WHERE NOT strict_valid) AS strict_rejected,
       count(*) FILTER (WHERE lax_valid) AS lax_ok, count(*) FILTER (WHERE NOT lax_valid) AS lax_rejected
FROM w GROUP BY case_no
""")
def q_quarantine(spark, sf_dir):
    """Valid / quarantined reply counts per fixture case under both validators,
    each split by `structured.quarantine`."""
    r = replies(spark, sf_dir).select("case_no", "reply")
    parts = []
    for mode in ("strict", "lax"):
        for side, rows in zip(("ok", "rejected"), X.quarantine(r, "reply", mode), strict=True):
            parts.append(rows.select("case_no", F.lit(f"{mode}_{side}").alias("side")))
    sides = functools.reduce(DataFrame.unionByName, parts).groupBy("case_no")
    return sides.agg(*(F.count_if(F.col("side") == c).alias(c) for c in ("strict_ok", "strict_rejected", "lax_ok", "lax_rejected")))
