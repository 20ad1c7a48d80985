"""Handlers, messages, the no-calls branch."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ragloom.operators import toolrun as TR
from ragloom.operators import tools as H


def reply(*calls, text=""):
    body = {"role": "assistant", "content": text}
    if calls:
        body["tool_calls"] = [{"function": {"name": n, "arguments": a}} for n, a in calls]
    return json.dumps({"message": body})


def handlers(spark, keys):
    weather = spark.createDataFrame([("Madrid", "Sunny +30°C")], "place string, report string")
    events = spark.createDataFrame([("2024-01-01 10:00:00", 2.5), ("2024-01-02 10:00:00", 4.0)], "s string, value double").select(
        F.to_timestamp("s").alias("ts"), "value")
    alerts = spark.createDataFrame([("CA", json.dumps({"features": [{"properties": {"event": "Fire"}}]})), ("NV", json.dumps({"features": []}))],
                                   "state string, payload string")
    return {"add_two_numbers": TR.integer_tool(F.try_add),
            "weather_forecast": TR.lookup_tool("location", weather, "place", "report", TR.BAD_LOCATION),
            "get_deployments_from_api": TR.deployments_tool(events, keys),
            "get_alerts": TR.alerts_tool(alerts, "state", "payload"),
            "shout": TR.python_tool("shout", lambda word: word.upper()),
            "silent": lambda calls: calls.where("false").withColumn("output", F.lit("x"))}


CASES = {
    1: [("add_two_numbers", {"a": "2", "b": "3"}), ("stock", {}), ("weather_forecast", {"location": "Madrid"})],
    2: [("add_two_numbers", {"a": "x", "b": "3"}), ("weather_forecast", {"location": "Atlantis"}), ("stock", {})],
    3: [("get_deployments_from_api", {"fromDate": "2024-01-02"}), ("get_deployments_from_api", {}), ("get_deployments_from_api", {"toDate": "soon"})],
    4: [("shout", {"word": "hey"}), ("shout", {}), ("silent", {})],
    5: [("get_alerts", {"state": "CA"}), ("get_alerts", {"state": "NV"}), ("get_alerts", {"state": "TX"})],
    6: [("stock", {}), ("bond", {})],
    7: [],
}


def _replies(spark):
    rows = [(k, reply(*calls, text="hi" if not calls else "")) for k, calls in CASES.items()]
    return spark.createDataFrame([*rows, (None, reply(("add_two_numbers", {"a": "1", "b": "1"}))), (9, "not json")], "id long, reply string")


def test_outputs(spark):
    done = TR.execute(H.explode_calls(_replies(spark), ["id"]), ["id"], handlers(spark, ["id", "pos"]))
    got = {(r["id"], r["pos"]): r["output"] for r in done.collect()}
    assert got[1, 0] == "5" and got[1, 1] == "Function stock not found" and got[1, 2] == "Sunny +30°C"
    assert got[2, 0] == TR.BAD_INTEGER and got[2, 1] == TR.BAD_LOCATION
    assert json.loads(got[3, 0]) == {"deployments": 1, "total": 4.0} and json.loads(got[3, 1]) == {"deployments": 2, "total": 6.5}
    assert got[3, 2] == TR.BAD_DATE
    assert got[4, 0] == "HEY" and got[4, 1].startswith("Error:") and got[4, 2] == "Error: silent returned nothing"
    assert "Fire" in got[5, 0] and got[5, 1] == H.ALERTS_NONE and got[5, 2] == H.ALERTS_UNAVAILABLE
    assert got[None, 0] == "2" and got[7, None] is None and got[9, None] is None


def test_messages(spark):
    hs = handlers(spark, ["id", "pos"])
    one = {r["id"]: r for r in TR.tool_round(_replies(spark), ["id"], hs).collect()}
    assert [m["content"] for m in one[1]["messages"]][1:] == ["Sunny +30°C"]
    assert one[2]["messages"][-1]["content"] == TR.BAD_LOCATION          # the last found call, not the last call
    assert one[6]["messages"][-1]["content"] == "Function bond not found"
    assert one[7]["status"] == H.NO_CALLS and len(one[7]["messages"]) == 1 and one[1]["status"] is None
    assert one[9]["status"] == H.NO_CALLS and one[None]["messages"][-1]["content"] == "2"
    every = {r["id"]: r for r in TR.tool_round(_replies(spark), ["id"], hs, all=True).collect()}
    assert [m["name"] for m in every[1]["messages"][1:]] == ["add_two_numbers", "stock", "weather_forecast"]
    assert all(m["role"] == "tool" for m in every[4]["messages"][1:]) and len(every[4]["messages"]) == 4
    assert TR.tool_round(_replies(spark).limit(0), ["id"], hs).count() == 0
    asked = _replies(spark).withColumn("q", F.lit("what?"))
    assert [m["role"] for m in TR.tool_round(asked, ["id"], hs, question_col="q").where("id = 1").first()["messages"]] == ["user", "assistant", "tool"]
