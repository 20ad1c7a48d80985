"""H/J4/J7/J8/F tool operators and X1-X5 structured replies on literals."""

import json

from pyspark.sql import functions as F

from ragloom.operators import structured as X
from ragloom.operators import tools as H


def test_integer_tools(spark):
    df = spark.createDataFrame([("subtract_two_numbers", {"a": "1", "b": "2"}),
                                ("add_two_numbers", {"a": "30", "b": "12"}),
                                ("add_two_numbers", {"a": " 3 ", "b": "12.7"})],
                               "name string, args map<string,string>")
    got = [r[0] for r in df.select(H.builtin_output(F.col("name"), F.col("args"))).collect()]
    assert got == ["-1", "42", None]


def test_explode_and_dispatch(spark):
    replies = spark.createDataFrame([
        (1, json.dumps({"message": {"role": "assistant", "content": "", "tool_calls": [
            {"function": {"name": "add_two_numbers", "arguments": {"a": "1", "b": "2"}}},
            {"function": {"name": "nope", "arguments": {}}}]}})),
        (2, json.dumps({"message": {"role": "assistant", "content": "hi"}})),
        (3, "not json")], "rid long, reply string")
    calls = H.explode_calls(replies, ["rid"])
    rows = {(r["rid"], r["pos"]): r["name"] for r in calls.collect()}
    assert rows == {(1, 0): "add_two_numbers", (1, 1): "nope", (2, None): None, (3, None): None}
    d = H.dispatch(calls.filter("name is not null"), H.registry(spark))
    found = {r["name"]: r["found"] for r in d.collect()}
    assert found == {"add_two_numbers": True, "nope": False}


def test_query_params(spark):
    df = spark.createDataFrame([(None, None), ("2024-01-01", None), (None, "2024-02-01"),
                                ("2024-01-01", "2024-02-01"), ("", "")], "f string, t string")
    got = [r[0] for r in df.select(H.query_params("f", "t")).collect()]
    assert got == ["", "?fromDate=2024-01-01", "?toDate=2024-02-01",
                   "?fromDate=2024-01-01&toDate=2024-02-01", ""]


def test_alert_summary_branches(spark):
    payloads = [None, json.dumps({"type": "x"}), json.dumps({"features": []}),
                json.dumps({"features": [{"properties": {"event": "Flood", "areaDesc": "CA", "severity": None}},
                                         {"properties": {"event": "Wind"}}]})]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    got = [r[0] for r in df.select(H.summarize_alerts(F.from_json("p", H.ALERTS_PAYLOAD))).collect()]
    assert got[0] == H.ALERTS_UNAVAILABLE and got[1] == H.ALERTS_UNAVAILABLE and got[2] == H.ALERTS_NONE
    assert got[3].count("\n---\n") == 1 and "Severity: Unknown" in got[3]
    assert "Instructions: No specific instructions provided" in got[3]


def test_forecast_first_five(spark):
    def payload(n):
        return json.dumps({"properties": {"periods": [
            {"name": f"P{i}", "temperature": i, "temperatureUnit": "F", "windSpeed": "5 mph",
             "windDirection": "N", "detailedForecast": "ok"} for i in range(n)]}})
    df = spark.createDataFrame([(payload(7),), (payload(3),), (payload(0),)], "p string")
    got = [r[0] for r in df.select(H.format_forecast(F.from_json("p", H.FORECAST_PAYLOAD))).collect()]
    assert [g.count("Temperature:") for g in got] == [5, 3, 0]


def test_two_hop_misses(spark):
    req = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "rid long, pk long")
    points = spark.createDataFrame([(10, json.dumps({"properties": {"forecast": "u1"}})),
                                    (20, json.dumps({"properties": {"forecast": "u2"}}))], "pk long, point string")
    fc = spark.createDataFrame([("u1", json.dumps({"properties": {"periods": []}}))], "url string, payload string")
    got = {r["rid"]: r["forecast"] for r in H.two_hop_forecast(req, points, fc, "rid", "pk").collect()}
    assert got == {1: "", 2: H.FORECAST_MISSING, 3: H.POINT_MISSING}


def test_between_dates(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-05 23:59:59",), ("2024-01-06 00:00:00",)],
                               "s string").select(F.to_timestamp("s").alias("ts"))
    assert H.between_dates(df, "ts").count() == 3
    assert H.between_dates(df, "ts", "2024-01-05").count() == 2
    assert H.between_dates(df, "ts", None, "2024-01-05").count() == 2
    assert H.between_dates(df, "ts", "2024-01-02", "2024-01-05").count() == 1


CASES = [
    ('{"friends": [{"name": "O", "age": 22, "is_available": false}]}', True, True),
    ('{"friends": [{"name": "O", "age": "22", "is_available": false}]}', False, True),
    ('{"friends": [{"name": "O", "age": 22.5, "is_available": false}]}', False, False),
    ('{"friends": [{"name": "O", "age": 22.0, "is_available": false}]}', True, True),
    ('{"friends": [{"name": "O", "age": 22, "is_available": "true"}]}', False, True),
    ('{"friends": [{"name": "O", "is_available": true}]}', False, False),
    ("{}", False, False),
    ("not json", False, False),
    ('{"friends": [{"name": "O", "age": 22, "is_available": true, "x": 1}]}', True, True),
    ('{"friends": []}', True, True),
    ('{"friends": [{"name": 7, "age": 22, "is_available": true}]}', False, False),
]


def test_validators(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CASES], "r string")
    got = df.select(X.validate_strict("r"), X.validate_lax("r")).collect()
    assert [(a, b) for a, b in got] == [(s, lx) for _, s, lx in CASES]


def test_parse_and_quarantine(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CASES], "r string")
    parsed = df.select(X.parse_lax("r").alias("p")).collect()
    assert parsed[1]["p"][0]["age"] == 22 and parsed[4]["p"][0]["is_available"] is True
    ok, bad = X.quarantine(df, "r", "strict")
    assert ok.count() == sum(1 for _, s, _ in CASES if s) and bad.count() == sum(1 for _, s, _ in CASES if not s)
    import pytest
    with pytest.raises(Exception):
        X.quarantine(df, "r", "strict", failfast=True)[0].collect()


def test_json_schema():
    sch = X.struct_to_json_schema(X.FRIEND_LIST)
    assert sch["required"] == ["friends"]
    item = sch["properties"]["friends"]["items"]
    assert item["properties"]["age"] == {"type": "integer"} and item["required"] == ["name", "age", "is_available"]


def test_weather_url(spark):
    df = spark.createDataFrame([("New York",)], "l string")
    assert df.select(H.weather_url("l")).first()[0] == "https://wttr.in/New+York?format=%C+%t"


def test_user_tools(spark):
    specs = [("multiply_two_numbers", "Multiply two numbers",
              '{"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "integer"}}}')]
    reg = H.register_tools(spark, specs)
    calls = spark.createDataFrame([("multiply_two_numbers", {"a": "6", "b": "7"}),
                                   ("multiply_two_numbers", {"a": "x", "b": "7"}),
                                   ("add_two_numbers", {"a": "1", "b": "2"})],
                                  "name string, arguments map<string,string>")
    d = H.dispatch(calls, reg).withColumn("output", H.builtin_output(F.col("name"), F.col("arguments")))
    out = H.run_user_tools(d, {"multiply_two_numbers": lambda a, b: int(a) * int(b)})
    got = [(r["name"], r["found"], r["output"]) for r in out.orderBy("name", "output").collect()]
    assert got[0] == ("add_two_numbers", True, "3")
    assert ("multiply_two_numbers", True, "42") in got
    assert any(o is not None and o.startswith("Error:") for _, _, o in got)
