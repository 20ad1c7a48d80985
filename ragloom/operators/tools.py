"""Tool-call operators: H1 explode calls, J4 dispatch against a registry,
F4 typed integer tools, J8 date-range lookup, J7 two-hop lookup, H3 last
tool message, H4 transcript rendering, H5 usage counts, H6 payload
formatting, A5 alert summaries, P7-P10 filters and defaults.

Model replies and API payloads are JSON text columns; they are parsed with
`from_json` (PERMISSIVE: a malformed payload becomes null, as a failed HTTP
call does in the reference) and processed with JVM expressions. External
calls are not made: their data is read as tables and joined.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragloom.plans.sizing import broadcast_if_small

# Tool names, descriptions and parameter schemas as declared by
# the reference examples, and the messages its handlers print.
TOOL_SPECS = [
    ("add_two_numbers", "Add two numbers",
     '{"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "integer", "description": "The first number"}, "b": {"type": "integer", "description": "The second number"}}}'),
    ("subtract_two_numbers", "Subtract two numbers",
     '{"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "integer", "description": "The first number"}, "b": {"type": "integer", "description": "The second number"}}}'),
    ("weather_forecast", "Get the weather forecast for a location",
     '{"type": "object", "required": ["location"], "properties": {"location": {"type": "string", "description": "The location to get the weather forecast for"}}}'),
    ("get_deployments_from_api", "Get deployments from an API that have access to all the different deployments happening in the system",
     '{"type": "object", "required": [], "properties": {"fromDate": {"type": "string", "description": "The start date of the deployments must be in the format ISO 8601 format"}, "toDate": {"type": "string", "description": "The end date of the deployments must be in the format ISO 8601 format"}}}'),
    ("get_alerts", "Get weather alerts for a US state.",
     '{"type": "object", "required": ["state"], "properties": {"state": {"type": "string"}}}'),
    ("get_forecast", "Get weather forecast for a location.",
     '{"type": "object", "required": ["latitude", "longitude"], "properties": {"latitude": {"type": "number"}, "longitude": {"type": "number"}}}'),
]
NOT_FOUND = "Function {name} not found"
NO_CALLS = "No tool calls returned from model"
ALERTS_UNAVAILABLE = "Unable to fetch alerts or no alerts found."
ALERTS_NONE = "No active alerts for this state."
POINT_MISSING = "Unable to fetch forecast data for this location."
FORECAST_MISSING = "Unable to fetch detailed forecast."
ALERT_DEFAULTS = {
    "event": "Unknown",
    "areaDesc": "Unknown",
    "severity": "Unknown",
    "description": "No description available",
    "instruction": "No specific instructions provided",
}
BLOCK_SEP = "\n---\n"
FORECAST_PERIODS = 5
MONEY = "decimal(38,12)"
WEATHER_URL = "https://wttr.in/{location}?format=%C+%t"

CALL = T.StructType([T.StructField("function", T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("arguments", T.MapType(T.StringType(), T.StringType())),
]))])
REPLY = T.StructType([T.StructField("message", T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("tool_calls", T.ArrayType(CALL)),
]))])
ALERT_PROPS = T.StructType([T.StructField(k, T.StringType()) for k in ALERT_DEFAULTS])
ALERTS_PAYLOAD = T.StructType([T.StructField("features", T.ArrayType(
    T.StructType([T.StructField("properties", ALERT_PROPS)])))])
POINT_PAYLOAD = T.StructType([T.StructField("properties", T.StructType([
    T.StructField("forecast", T.StringType())]))])
PERIOD = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("temperature", T.StringType()),
    T.StructField("temperatureUnit", T.StringType()), T.StructField("windSpeed", T.StringType()),
    T.StructField("windDirection", T.StringType()), T.StructField("detailedForecast", T.StringType())])
FORECAST_PAYLOAD = T.StructType([T.StructField("properties", T.StructType([
    T.StructField("periods", T.ArrayType(PERIOD))]))])


def registry(spark) -> DataFrame:
    """K3: the tool registry `(name, description, parameters)` (a handful of rows)."""
    return spark.createDataFrame(TOOL_SPECS, "name string, description string, parameters string")


def project_tool_specs(reg: DataFrame) -> DataFrame:
    """Keep three fields, renaming the schema field to `input_schema`."""
    return reg.select("name", "description", F.col("parameters").alias("input_schema"))


def explode_calls(replies: DataFrame, keys: list[str], reply_col: str = "reply") -> DataFrame:
    """H1: one row per tool call in reply order (`pos` 0-based). A reply
    without calls keeps one row with `pos`/`name` null (the "no calls" branch)."""
    parsed = replies.select(*keys, F.from_json(reply_col, REPLY).alias("__r"))
    return parsed.select(*keys, F.posexplode_outer("__r.message.tool_calls").alias("pos", "__c")).select(
        *keys, "pos", F.col("__c.function.name").alias("name"), F.col("__c.function.arguments").alias("arguments"))


def int_arg(args: Column | str, key: str) -> Column:
    """an argument as an integer the way `int(x)` reads a string: surrounding
    spaces allowed, decimals rejected (null = the handler would raise, or more
    than 38 digits)."""
    a = F.col(args) if isinstance(args, str) else args
    v = F.trim(a.getItem(key))
    return F.when(v.rlike(r"^[+-]?[0-9]+$"), v.try_cast("decimal(38,0)"))


def dispatch(calls: DataFrame, reg: DataFrame) -> DataFrame:
    """Left join of calls with the registry by name (registry broadcast:
    bounded by the number of tools); adds `found`."""
    names = reg.select("name", F.lit(True).alias("__found"))
    out = calls.join(F.broadcast(names), "name", "left")
    return out.withColumn("found", F.coalesce(F.col("__found"), F.lit(False))).drop("__found")


def builtin_output(name: Column, args: Column) -> Column:
    """H2 for the integer tools and the not-found branch; other tools' outputs
    come from joins (J7, J8)."""
    a, b = int_arg(args, "a"), int_arg(args, "b")
    return (F.when(name == "add_two_numbers", F.try_add(a, b).cast("string"))
             .when(name == "subtract_two_numbers", F.try_subtract(a, b).cast("string")))


def query_params(from_col: Column | str, to_col: Column | str) -> Column:
    """`?fromDate=..&toDate=..`, one of them, or empty when neither (empty
    strings count as absent, as the reference tests truthiness)."""
    f = F.col(from_col) if isinstance(from_col, str) else from_col
    t = F.col(to_col) if isinstance(to_col, str) else to_col
    fp = F.when(F.coalesce(f, F.lit("")) != "", F.concat(F.lit("fromDate="), f))
    tp = F.when(F.coalesce(t, F.lit("")) != "", F.concat(F.lit("toDate="), t))
    joined = F.concat_ws("&", fp, tp)
    return F.when(joined == "", F.lit("")).otherwise(F.concat(F.lit("?"), joined))


def between_dates(df: DataFrame, ts_col: str, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """Optional inclusive date bounds on a timestamp column (each bound
    pushes down to the Parquet scan as a timestamp comparison)."""
    out = df
    ts_type = df.schema[ts_col].dataType        # compare in the column's own type (NTZ or LTZ):
    if from_date:                               # no session-time-zone shift, literal bound pushes down
        out = out.filter(F.col(ts_col) >= F.lit(f"{from_date} 00:00:00").cast(ts_type))
    if to_date:
        next_day = F.date_add(F.to_date(F.lit(to_date)), 1)
        out = out.filter(F.col(ts_col) < F.date_format(next_day, "yyyy-MM-dd 00:00:00").cast(ts_type))
    return out


def date_range_summary(calls: DataFrame, deployments: DataFrame, call_keys: list[str], ts_col: str = "ts",
                       value_col: str = "value") -> DataFrame:
    """Per call `(fromDate?, toDate?)`, the deployments whose day lies in
    the inclusive range: their count and value total.

    No range join: the big side is reduced to one row per calendar day
    (partial aggregation), turned into running totals over a dense calendar
    (one row per day of the table's date span — bounded by the calendar, not
    by the data, and size-checked before broadcast), and each call reads two
    running totals by equality: at its upper bound and on the day before its
    lower bound. Open bounds use the ends of the calendar. Totals are decimals
    (12 places), so a small day after a huge one keeps its cents. A bound that
    is no date gives null count and total: the request would fail.
    """
    per_day = (deployments.groupBy(F.to_date(ts_col).alias("day"))
                          .agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(value_col).try_cast(MONEY)).alias("__v")))
    first = per_day.select(F.date_sub(F.min("day"), 1)).scalar()    # day before the first day
    last = per_day.select(F.max("day")).scalar()
    cal = per_day.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = (cal.join(per_day, "day", "left")
              .select("day", F.sum(F.coalesce("__n", F.lit(0))).over(w).alias("__cn"),
                      F.sum(F.coalesce("__v", F.lit(0).cast(MONEY))).over(w).alias("__cv")))
    cum, _ = broadcast_if_small(cum)
    said_f, said_t = F.nullif(F.col("fromDate"), F.lit("")), F.nullif(F.col("toDate"), F.lit(""))
    f, t = said_f.try_cast("date"), said_t.try_cast("date")
    bad = (said_f.isNotNull() & f.isNull()) | (said_t.isNotNull() & t.isNull())

    def clip(d):
        return F.least(F.greatest(d, first), last)
    c = (calls.withColumn("__hi", clip(F.coalesce(t, last)))
              .withColumn("__lo", clip(F.coalesce(F.date_sub(f, 1), first)))
              .withColumn("__bad", bad)
              .withColumn("__empty", F.coalesce(f > t, F.lit(False)) | (F.col("__hi") <= F.col("__lo"))))
    hi = cum.select(F.col("day").alias("__hi"), F.col("__cn").alias("__hn"), F.col("__cv").alias("__hv"))
    lo = cum.select(F.col("day").alias("__lo"), F.col("__cn").alias("__ln"), F.col("__cv").alias("__lv"))
    j = c.join(hi, "__hi", "left").join(lo, "__lo", "left")
    n = F.when(~F.col("__bad"), F.when(F.col("__empty"), F.lit(0)).otherwise(F.col("__hn") - F.col("__ln")))
    v = F.when(~F.col("__bad"), F.when(F.col("__empty"), F.lit(0.0)).otherwise(
        (F.col("__hv") - F.col("__lv")).cast("double")))
    return j.select(*call_keys, n.cast("long").alias("n_deployments"), F.round(v, 2).alias("total_value"))


def last_tool_output(executed: DataFrame, keys: list[str]) -> DataFrame:
    """H3: per reply, the output and name of the last call that was found
    (the reference sends only the last output back). Replies whose calls all
    missed get the not-found message of their last call."""
    ranked = executed.withColumn("__r", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.desc("found"), F.desc("pos"))))
    return ranked.filter(F.col("__r") == 1).select(
        *keys, F.col("name").alias("tool_name"), F.col("output").alias("tool_output"))


def format_alert(props: Column) -> Column:
    """H6 / P10: one alert block; missing or null properties take defaults."""
    def g(k):
        return F.coalesce(props[k], F.lit(ALERT_DEFAULTS[k]))
    return F.concat(F.lit("\nEvent: "), g("event"), F.lit("\nArea: "), g("areaDesc"),
                    F.lit("\nSeverity: "), g("severity"), F.lit("\nDescription: "), g("description"),
                    F.lit("\nInstructions: "), g("instruction"), F.lit("\n"))


def summarize_alerts(payload: Column) -> Column:
    """A5: unavailable (null payload or no features key) / none / joined blocks."""
    feats = payload["features"]
    blocks = F.transform(feats, lambda f: format_alert(f["properties"]))
    return (F.when(payload.isNull() | feats.isNull(), F.lit(ALERTS_UNAVAILABLE))
             .when(F.size(feats) == 0, F.lit(ALERTS_NONE))
             .otherwise(F.array_join(blocks, BLOCK_SEP)))


def format_period(p: Column) -> Column:
    """One forecast period; a missing or null part reads `None`, numbers as written."""
    def g(k):
        return F.coalesce(p[k], F.lit("None"))
    return F.concat(F.lit("\n"), g("name"), F.lit(":\nTemperature: "), g("temperature"),
                    F.lit("°"), g("temperatureUnit"), F.lit("\nWind: "), g("windSpeed"), F.lit(" "),
                    g("windDirection"), F.lit("\nForecast: "), g("detailedForecast"), F.lit("\n"))


def format_forecast(payload: Column, periods: int = FORECAST_PERIODS) -> Column:
    """H6 + T3: the first `periods` periods, formatted and joined."""
    ps = F.slice(payload["properties"]["periods"], 1, periods)
    return F.array_join(F.transform(ps, format_period), BLOCK_SEP)


def two_hop_forecast(requests: DataFrame, points: DataFrame, forecasts: DataFrame, req_key: str,
                     point_key: str, url_col: str = "url") -> DataFrame:
    """Request → point payload (gives the forecast URL) → forecast payload.

    `points(point_key, point)` and `forecasts(url, payload)` hold JSON text;
    either hop may miss, which yields the matching message. Both hops are
    left equi-joins (shuffled or broadcast as Spark/AQE decide by size).
    """
    p = points.select(point_key, F.from_json("point", POINT_PAYLOAD).alias("__p"))
    f = forecasts.select(F.col(url_col).alias("__url"), F.from_json("payload", FORECAST_PAYLOAD).alias("__f"))
    hop1 = requests.join(p, point_key, "left").withColumn("__url", F.col("__p.properties.forecast"))
    hop2 = hop1.join(f, "__url", "left")
    text = (F.when(F.col("__p").isNull(), F.lit(POINT_MISSING))
             .when(F.col("__f").isNull(), F.lit(FORECAST_MISSING))
             .otherwise(format_forecast(F.col("__f"))))
    return hop2.select(req_key, text.alias("forecast"))


def render_blocks(blocks: Column) -> Column:
    """H4: text blocks as-is, tool-use blocks as a bracketed call note, joined by newline."""
    def one(b):
        return (F.when(b["type"] == "text", b["text"])
                 .when(b["type"] == "tool_use", F.concat(F.lit("[Calling tool "), b["name"], F.lit(" with args "),
                                                          b["input_text"], F.lit("]"))))
    return F.array_join(F.transform(blocks, one), "\n")


def weather_url(location: Column | str) -> Column:
    """the forecast URL of a location (form encoding: space becomes `+`)."""
    loc = F.col(location) if isinstance(location, str) else location
    head, tail = WEATHER_URL.split("{location}")
    return F.concat(F.lit(head), F.url_encode(loc), F.lit(tail))


def register_tools(spark, specs: list[tuple[str, str, str]]) -> DataFrame:
    """K3: a registry DataFrame `(name, description, parameters)` extended with
    user tool specs (parameters as JSON-schema text)."""
    return registry(spark).unionByName(
        spark.createDataFrame(specs, "name string, description string, parameters string"))


def run_user_tools(calls: DataFrame, handlers: dict, name_col: str = "name", args_col: str = "arguments",
                   out_col: str = "output") -> DataFrame:
    """H2 for user tools: `handlers` maps a tool name to a Python function taking
    the call's arguments as keyword strings and returning a value (rendered
    with `str`). One Arrow-batched pandas UDF dispatches per row by name; rows
    of other tools keep their existing output (or null). A handler that raises
    yields `Error: <message>` for that call, as the reference prints and
    continues."""
    names = sorted(handlers)

    @F.pandas_udf(T.StringType())
    def _run(name: pd.Series, args: pd.Series) -> pd.Series:
        out = []
        for n, a in zip(name, args):
            fn = handlers.get(n)
            if fn is None:
                out.append(None)
                continue
            kwargs = dict(a) if a is not None else {}
            try:
                out.append(str(fn(**kwargs)))
            except Exception as e:  # noqa: BLE001
                out.append(f"Error: {e}")
        return pd.Series(out, dtype=object)

    mine = F.col(name_col).isin(names)
    result = F.when(mine, _run(F.col(name_col), F.col(args_col)))
    if out_col in calls.columns:
        result = F.when(mine, result).otherwise(F.col(out_col))
    return calls.withColumn(out_col, result)
