"""Derived inputs built from the driver tables (same definitions are written
in SQL in the oracle): model replies with tool calls from `events`, alert /
point / forecast API payloads from `events`, `customer`, `nation`, `region`.

Every view is a pure function of the given tables, so its size grows with
them. Group keys are bounded: a reply is one user's calls of one day, an
alert payload one nation's alerts of one day, a forecast one region's nations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.operators.rows import with_group_ordinal
from ragloom.session import table

# Fixture rules (ours): which event type asks for which tool, and which
# lookup rows are absent so that every miss branch is exercised.
EVENT_TOOL = {
    "click": "add_two_numbers",
    "view": "subtract_two_numbers",
    "purchase": "get_deployments_from_api",
    "signup": "weather_forecast",
    "error": "get_stock_price",          # not in the registry
}
POINTS_MISSING_FROM_NATION = 23          # nations >= 23 have no grid point
FORECAST_MISSING_REGION = 3              # region 3's forecast URL is dead
ALERTS_MISSING_REGION = 0                # no alert payload for region 0
WEATHER = ["Sunny", "Cloudy", "Light rain", "Clear"]
MAX_CALLS_PER_REPLY = 16                 # a reply carries at most this many tool calls
ALERTS_PER_PAGE = 20                     # alert payloads are served in pages


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls `(user_id, day, ts, event_id, name, arguments map)` from events."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    name = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_TOOL.items()])
    k = F.get_json_object("props", "$.k")
    uid = F.col("user_id").cast("string")
    args = (F.when(name.isin("add_two_numbers", "subtract_two_numbers"), F.create_map(F.lit("a"), k, F.lit("b"), uid))
             .when(name == "get_deployments_from_api", F.create_map(
                 F.lit("fromDate"), F.when(F.col("value") >= 20, F.date_format(F.date_sub(F.to_date("ts"), 3), "yyyy-MM-dd")),
                 F.lit("toDate"), F.when(F.col("value") < 80, F.date_format("ts", "yyyy-MM-dd"))))
             .when(name == "weather_forecast", F.create_map(F.lit("location"), F.concat(F.lit("City "), uid)))
             .otherwise(F.create_map(F.lit("symbol"), F.upper("event_type"))))
    return ev.select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", name.alias("name"),
                     args.alias("arguments"))


def _by_pos(left, right):
    """Comparator on the in-day position, for arrays whose elements hold maps
    (maps are not orderable, so `array_sort` needs an explicit comparator)."""
    return F.when(left["day_pos"] < right["day_pos"], -1).when(left["day_pos"] > right["day_pos"], 1).otherwise(0)


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies as JSON text `(user_id, day, reply_no, reply)`: a user's
    calls of one day in time order, at most `MAX_CALLS_PER_REPLY` per reply.

    The in-day position comes from `with_group_ordinal` (a user with a third
    of all events is spread over many tasks), and each reply groups a bounded
    number of calls, so no group grows with the data."""
    c = with_group_ordinal(calls(spark, sf_dir), ["user_id", "day"], ["ts", "event_id"], "day_pos")
    c = c.withColumn("reply_no", F.floor(F.col("day_pos") / MAX_CALLS_PER_REPLY).cast("long"))
    call = F.struct(F.struct("name", "arguments").alias("function"))
    grouped = c.groupBy("user_id", "day", "reply_no").agg(
        F.array_sort(F.collect_list(F.struct("day_pos", call.alias("call"))), _by_pos).alias("__c"))
    msg = F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content"),
                   F.transform("__c", lambda x: x["call"]).alias("tool_calls"))
    return grouped.select("user_id", "day", "reply_no", F.to_json(F.struct(msg.alias("message"))).alias("reply"))


def user_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user → nation through the customer with the same key."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nat = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    return cust.join(F.broadcast(nat), "c_nationkey")


def alert_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert API responses `(n_name, day, page, payload JSON)`: a nation's
    error events of a day are its alerts, served in pages of at most
    `ALERTS_PER_PAGE` (event order); a nation-day with events but no alert
    gets one empty page; region 0's API is unavailable (no payload row)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    e = (ev.join(user_nation(spark, sf_dir), "user_id")
           .filter(F.col("n_regionkey") != ALERTS_MISSING_REGION)
           .withColumn("day", F.to_date("ts")))
    errs = with_group_ordinal(e.filter(F.col("event_type") == "error"), ["n_name", "day"], ["event_id"], "__ord")
    errs = errs.withColumn("page", F.floor(F.col("__ord") / ALERTS_PER_PAGE).cast("long"))
    props = F.struct(
        F.concat(F.lit("Error "), F.col("event_id").cast("string")).alias("event"),
        F.col("n_name").alias("areaDesc"),
        F.when(F.col("value") > 100, "Severe").when(F.col("value") > 20, "Moderate").alias("severity"),
        F.col("props").alias("description"),
        F.when(F.col("value") > 50, "Stay indoors").alias("instruction"))
    feat = F.struct(F.col("event_id"), F.struct(props.alias("properties")).alias("f"))
    pages = errs.groupBy("n_name", "day", "page").agg(F.array_sort(F.collect_list(feat)).alias("__f"))
    pages = pages.select("n_name", "day", "page",
                         F.to_json(F.struct(F.transform("__f", lambda x: x["f"]).alias("features"))).alias("payload"))
    quiet = (e.select("n_name", "day").distinct()
              .join(errs.select("n_name", "day").distinct(), ["n_name", "day"], "left_anti")
              .select("n_name", "day", F.lit(0).cast("long").alias("page"), F.lit('{"features":[]}').alias("payload")))
    return pages.unionByName(quiet)


def alert_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """get_alerts(state) requests: one per nation and day with a signup event."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup").select("user_id", "ts")
    return ev.join(user_nation(spark, sf_dir), "user_id").select("n_name", F.to_date("ts").alias("day")).distinct()


def point_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid-point API responses per nation: `{"properties": {"forecast": url}}`."""
    nat = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") < POINTS_MISSING_FROM_NATION)
    url = F.concat(F.lit("https://forecast.example/region/"), F.col("n_regionkey").cast("string"))
    return nat.select(F.col("n_nationkey").alias("c_nationkey"),
                      F.to_json(F.struct(F.struct(url.alias("forecast")).alias("properties"))).alias("point"))


def forecast_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast API responses per region URL: periods = the nations whose key is
    at least 3 × the region key, in key order (so counts differ by region)."""
    reg = table(spark, sf_dir, "region").filter(F.col("r_regionkey") != FORECAST_MISSING_REGION)
    nat = table(spark, sf_dir, "nation")
    pairs = reg.join(nat, F.col("n_nationkey") >= F.col("r_regionkey") * 3)
    period = F.struct(
        F.col("n_name").alias("name"), (F.col("n_nationkey") * 3).cast("long").alias("temperature"),
        F.lit("F").alias("temperatureUnit"), F.concat(F.col("n_nationkey").cast("string"), F.lit(" mph")).alias("windSpeed"),
        F.lit("NW").alias("windDirection"), F.concat(F.lit("Clear near "), F.col("n_name")).alias("detailedForecast"))
    grouped = pairs.groupBy("r_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", period.alias("p")))).alias("__p"))
    url = F.concat(F.lit("https://forecast.example/region/"), F.col("r_regionkey").cast("string"))
    payload = F.to_json(F.struct(F.struct(F.transform("__p", lambda x: x["p"]).alias("periods")).alias("properties")))
    return grouped.select(url.alias("url"), payload.alias("payload"))


def weather_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather service answers `(location, report)`: one place per customer, named
    after its key; condition and temperature follow the nation."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    names = F.array(*map(F.lit, WEATHER))
    warm = F.col("c_nationkey") * 3 - 20
    return cust.select(F.concat(F.lit("City "), F.col("c_custkey").cast("string")).alias("location"), F.concat(
        F.get(names, (F.col("c_nationkey") % len(WEATHER)).cast("int")), F.lit(" "), F.when(warm >= 0, "+").otherwise(""),
        warm.cast("string"), F.lit("°C")).alias("report"))


def tool_handlers(spark: SparkSession, sf_dir: str, keys: list[str]) -> dict:
    """Handlers of the tools that the replies call; `keys` name a call."""
    from ragloom.operators import toolrun as TR
    events = table(spark, sf_dir, "events").select("ts", "value")
    return {"add_two_numbers": TR.integer_tool(F.try_add), "subtract_two_numbers": TR.integer_tool(F.try_subtract),
            "weather_forecast": TR.lookup_tool("location", weather_reports(spark, sf_dir), "location", "report", TR.BAD_LOCATION),
            "get_deployments_from_api": TR.deployments_tool(events, keys)}


def spoken_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies without tool calls `(conv_id, turn, reply)`: the assistant's turns."""
    conv = table(spark, sf_dir, "conversations").where(F.col("role") == "assistant")
    message = F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content"))
    return conv.select("conv_id", "turn", F.to_json(F.struct(message.alias("message"))).alias("reply"))


def args_text(args) -> F.Column:
    """Map arguments as `k=v;k=v` in key order (nulls shown as `null`)."""
    entries = F.array_sort(F.map_entries(args))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))), ";")



def args_repr(args) -> F.Column:
    """Map arguments rendered the way a Python dict of strings prints:
    `{'a': '1', 'b': '2'}` in the map's own key order, null as `None`."""
    def item(e):
        v = F.when(e["value"].isNull(), F.lit("None")).otherwise(F.concat(F.lit("'"), e["value"], F.lit("'")))
        return F.concat(F.lit("'"), e["key"], F.lit("': "), v)
    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(args), item), ", "), F.lit("}"))
