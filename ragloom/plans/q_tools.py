"""Registered tool-call and API-payload queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ragloom.operators import toolrun as TR
from ragloom.operators import tools as H
from ragloom.plans import fixtures as X
from ragloom.plans import oracle as O
from ragloom.plans.catalog import register
from ragloom.session import table

_NAME_CASE = "CASE event_type " + " ".join(f"WHEN {O.q(k)} THEN {O.q(v)}" for k, v in X.EVENT_TOOL.items()) + " END"
_REGISTERED = ", ".join(O.q(n) for n, _, _ in H.TOOL_SPECS)

_DEPLOYED_SQL = """
days AS (SELECT ts::DATE AS d, count(*) AS n, sum(value::DECIMAL(38,12)) AS v FROM events GROUP BY 1),
asked AS (
  SELECT DISTINCT CASE WHEN value >= 20 THEN strftime(ts::DATE - 3, '%Y-%m-%d') ELSE '' END AS lo,
         CASE WHEN value < 80 THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS hi FROM events
),
ranges AS (
  SELECT lo, hi, '{"deployments": ' || coalesce(sum(n), 0)::BIGINT::VARCHAR || ', "total": '
         || round(coalesce(sum(v), 0), 2)::DECIMAL(38,2)::VARCHAR || '}' AS deployed
  FROM asked LEFT JOIN days ON (lo = '' OR d >= lo::DATE) AND (hi = '' OR d <= hi::DATE) GROUP BY lo, hi
)"""

_REPORTS_SQL = f"""
reports AS (
  SELECT c_custkey AS user_id, ({[*X.WEATHER]!r})[c_nationkey % {len(X.WEATHER)} + 1] || ' '
         || CASE WHEN c_nationkey * 3 - 20 >= 0 THEN '+' ELSE '' END || (c_nationkey * 3 - 20)::VARCHAR || '°C' AS report
  FROM customer
)"""

_CALLS_SQL = f"""{_DEPLOYED_SQL},{_REPORTS_SQL},
calls AS (
  SELECT user_id, ts::DATE AS day, ts, event_id, event_type, value, {_NAME_CASE} AS name,
         json_extract_string(props, '$.k') AS k,
         CASE WHEN value >= 20 THEN strftime(ts::DATE - 3, '%Y-%m-%d') END AS fromDate,
         CASE WHEN value < 80 THEN strftime(ts, '%Y-%m-%d') END AS toDate,
         (row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) - 1)::INTEGER AS pos
  FROM events
),
calls2 AS (
  SELECT *, name IN ({_REGISTERED}) AS found,
    CASE WHEN name IN ('add_two_numbers', 'subtract_two_numbers') THEN 'a=' || k || ';b=' || user_id::VARCHAR
         WHEN name = 'get_deployments_from_api' THEN 'fromDate=' || coalesce(fromDate, 'null') || ';toDate=' || coalesce(toDate, 'null')
         WHEN name = 'weather_forecast' THEN 'location=City ' || user_id::VARCHAR
         ELSE 'symbol=' || upper(event_type) END AS args,
    CASE WHEN name IN ('add_two_numbers', 'subtract_two_numbers') THEN '{{''a'': ''' || k || ''', ''b'': ''' || user_id::VARCHAR || '''}}'
         WHEN name = 'get_deployments_from_api' THEN '{{''fromDate'': ' || coalesce('''' || fromDate || '''', 'None')
              || ', ''toDate'': ' || coalesce('''' || toDate || '''', 'None') || '}}'
         WHEN name = 'weather_forecast' THEN '{{''location'': ''City ' || user_id::VARCHAR || '''}}'
         ELSE '{{''symbol'': ''' || upper(event_type) || '''}}' END AS args_repr,
    (pos // {X.MAX_CALLS_PER_REPLY})::BIGINT AS reply_no,
    CASE WHEN name = 'add_two_numbers' THEN (k::BIGINT + user_id)::VARCHAR
         WHEN name = 'subtract_two_numbers' THEN (k::BIGINT - user_id)::VARCHAR
         WHEN name = 'weather_forecast' THEN coalesce(report, {O.q(TR.BAD_LOCATION)})
         WHEN name = 'get_deployments_from_api' THEN deployed
         ELSE 'Function ' || name || ' not found' END AS output
  FROM calls LEFT JOIN reports USING (user_id) LEFT JOIN ranges ON lo = coalesce(fromDate, '') AND hi = coalesce(toDate, '')
)"""


def _exploded(spark, sf_dir):
    """Calls of every reply; `pos` is the call's position within its day."""
    ex = H.explode_calls(X.replies(spark, sf_dir), ["user_id", "day", "reply_no"])
    return ex.withColumn("pos", (F.col("reply_no") * X.MAX_CALLS_PER_REPLY + F.col("pos")).cast("int"))


_REPLY = ["user_id", "day", "reply_no"]


def _executed(spark, sf_dir):
    """Calls with their outputs: every tool's handler runs over its own calls."""
    handlers = X.tool_handlers(spark, sf_dir, [*_REPLY, "pos"])
    return TR.execute(_exploded(spark, sf_dir), _REPLY, handlers)


@register("explode_calls", f"""
WITH {_CALLS_SQL}
SELECT user_id, day, pos, name, args FROM calls2
""")
def q_explode_calls(spark, sf_dir):
    """H1: reply JSON → one row per tool call in order (S10/F5 parse included)."""
    ex = _exploded(spark, sf_dir)
    return ex.select("user_id", "day", "pos", "name", X.args_text(F.col("arguments")).alias("args"))


@register("execute_calls", f"""
WITH {_CALLS_SQL}
SELECT user_id, day, pos, name, found, output FROM calls2
""")
def q_execute_calls(spark, sf_dir):
    """J4 + F4 + H2: every tool's handler over its calls (integer tools, J7-like
    weather lookup, J8 date ranges), not-found message for unknown names."""
    return _executed(spark, sf_dir).select("user_id", "day", "pos", "name", "found", "output")


@register("last_tool_message", f"""
WITH {_CALLS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, reply_no ORDER BY found DESC, pos DESC) AS rn FROM calls2)
SELECT user_id, day, reply_no, name AS tool_name, output AS tool_output FROM r WHERE rn = 1
""")
def q_last_tool_message(spark, sf_dir):
    """H3: the tool message appended after each reply's calls — the last found call's output."""
    return H.last_tool_output(_executed(spark, sf_dir), ["user_id", "day", "reply_no"])


_ROUND_SQL = f"""
WITH {_CALLS_SQL},
said AS (
  SELECT user_id, day, reply_no, count(*)::INTEGER AS n_calls,
         string_agg('tool|' || name || '|' || output, chr(10) ORDER BY pos) AS every,
         max_by('tool|' || name || '|' || output, (CASE WHEN found THEN 1000000 ELSE 0 END) + pos) AS one
  FROM calls2 GROUP BY user_id, day, reply_no
)
"""


def _message_lines(messages):
    return F.array_join(F.transform(messages, lambda m: F.concat_ws("|", m["role"], F.coalesce(m["name"], F.lit("")), m["content"])), "\n")


def _round(spark, sf_dir, all):
    handlers = X.tool_handlers(spark, sf_dir, [*_REPLY, "pos"])
    out = TR.tool_round(X.replies(spark, sf_dir), _REPLY, handlers, all=all)
    return out.select(*_REPLY, "n_calls", _message_lines(F.col("messages")).alias("messages"), "status")


@register("tool_round", _ROUND_SQL + """
SELECT user_id, day, reply_no, n_calls, 'assistant||' || chr(10) || one AS messages, NULL::VARCHAR AS status FROM said
""")
def q_tool_round(spark, sf_dir):
    """The messages after each reply's tool round: the reply and the last found call's output (H3)."""
    return _round(spark, sf_dir, False)


@register("tool_round_all", _ROUND_SQL + """
SELECT user_id, day, reply_no, n_calls, 'assistant||' || chr(10) || every AS messages, NULL::VARCHAR AS status FROM said
""")
def q_tool_round_all(spark, sf_dir):
    """E3 with every call's output appended, in call order (H3 `all`)."""
    return _round(spark, sf_dir, True)


@register("tool_round_no_calls", f"""
SELECT conv_id, turn, 0 AS n_calls, 'assistant||' || coalesce(text, '') AS messages, {O.q(H.NO_CALLS)} AS status
FROM conversations WHERE role = 'assistant'
""")
def q_tool_round_no_calls(spark, sf_dir):
    """H1's no-calls branch: replies that call nothing keep their messages and say so."""
    handlers = X.tool_handlers(spark, sf_dir, ["conv_id", "turn", "pos"])
    out = TR.tool_round(X.spoken_replies(spark, sf_dir), ["conv_id", "turn"], handlers)
    return out.select("conv_id", "turn", "n_calls", _message_lines(F.col("messages")).alias("messages"), "status")


@register("tool_usage", f"""
WITH {_CALLS_SQL}
SELECT name, found, count(*) AS n_calls FROM calls2 GROUP BY name, found
""")
def q_tool_usage(spark, sf_dir):
    """H5: calls per tool name and whether the name is registered."""
    return _executed(spark, sf_dir).groupBy("name", "found").agg(F.count(F.lit(1)).alias("n_calls"))


def _registry_sql() -> str:
    rows = ", ".join(f"({O.q(n)}, {O.q(d)}, {O.q(p)})" for n, d, p in H.TOOL_SPECS)
    return f"reg(name, description, parameters) AS (VALUES {rows})"


@register("tool_specs_usage", f"""
WITH {_CALLS_SQL}, {_registry_sql()},
u AS (SELECT name, count(*) AS n_calls FROM calls2 GROUP BY name)
SELECT reg.name, reg.description, reg.parameters AS input_schema, coalesce(u.n_calls, 0)::BIGINT AS n_calls
FROM reg LEFT JOIN u USING (name)
""")
def q_tool_specs(spark, sf_dir):
    """P8 + K3: tool specs projected to (name, description, input_schema) with their call counts."""
    usage = _executed(spark, sf_dir).groupBy("name").agg(F.count(F.lit(1)).alias("n_calls"))
    specs = H.project_tool_specs(H.registry(spark))
    return (specs.join(usage, "name", "left")
                 .select("name", "description", "input_schema",
                         F.coalesce(F.col("n_calls"), F.lit(0)).cast("long").alias("n_calls")))


@register("render_transcript", f"""
WITH {_CALLS_SQL}
SELECT user_id, day, reply_no,
       'I will use ' || count(*)::VARCHAR || ' tool(s).' || chr(10)
       || string_agg('[Calling tool ' || name || ' with args ' || args_repr || ']', chr(10) ORDER BY pos) AS transcript
FROM calls2 GROUP BY user_id, day, reply_no
""")
def q_render_transcript(spark, sf_dir):
    """H4: content blocks (one text block, then a tool-use block per call) rendered in order."""
    ex = _exploded(spark, sf_dir)
    blocks = ex.groupBy("user_id", "day", "reply_no").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), "name",
        X.args_repr(F.col("arguments")).alias("input_text")))).alias("__b"))
    lead = F.struct(F.lit(-1).alias("pos"), F.lit("text").alias("type"),
                    F.concat(F.lit("I will use "), F.size("__b").cast("string"), F.lit(" tool(s).")).alias("text"),
                    F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("input_text"))
    return blocks.select("user_id", "day", "reply_no",
                         H.render_blocks(F.concat(F.array(lead), F.col("__b"))).alias("transcript"))


@register("deployments_by_call", f"""
WITH {_CALLS_SQL},
days AS (SELECT ts::DATE AS d, count(*) AS n, sum(value) AS v FROM events GROUP BY 1)
SELECT c.user_id, c.day, c.pos,
       CASE WHEN coalesce(fromDate, '') <> '' AND coalesce(toDate, '') <> '' THEN '?fromDate=' || fromDate || '&toDate=' || toDate
            WHEN coalesce(fromDate, '') <> '' THEN '?fromDate=' || fromDate
            WHEN coalesce(toDate, '') <> '' THEN '?toDate=' || toDate ELSE '' END AS query_url,
       coalesce(sum(n), 0)::BIGINT AS n_deployments, round(coalesce(sum(v), 0), 2) AS total_value
FROM calls2 c LEFT JOIN days ON (fromDate IS NULL OR d >= fromDate::DATE) AND (toDate IS NULL OR d <= toDate::DATE)
WHERE name = 'get_deployments_from_api'
GROUP BY ALL
""")
def q_deployments(spark, sf_dir):
    """J8 + F3: each deployments call's optional (from, to) dates against the events
    table; URL query string and per-call count / value total."""
    ex = _exploded(spark, sf_dir).filter(F.col("name") == "get_deployments_from_api")
    calls = ex.select("user_id", "day", "pos", F.col("arguments")["fromDate"].alias("fromDate"),
                      F.col("arguments")["toDate"].alias("toDate"))
    calls = calls.withColumn("query_url", H.query_params("fromDate", "toDate"))
    dep = table(spark, sf_dir, "events").select("ts", "value")
    out = H.date_range_summary(calls, dep, ["user_id", "day", "pos", "query_url"])
    return out.select("user_id", "day", "pos", "query_url", "n_deployments", "total_value")


def _between(name, lo, hi):
    conds = []
    if lo:
        conds.append(f"ts >= TIMESTAMP '{lo} 00:00:00'")
    if hi:
        conds.append(f"ts < TIMESTAMP '{hi} 00:00:00' + INTERVAL 1 DAY")
    where = (" WHERE " + " AND ".join(conds)) if conds else ""

    @register(name, f"SELECT event_id, user_id, event_type, value FROM events{where}")
    def q(spark, sf_dir):
        ev = table(spark, sf_dir, "events")
        return H.between_dates(ev, "ts", lo, hi).select("event_id", "user_id", "event_type", "value")
    q.__doc__ = f"P7: events between {lo or 'open'} and {hi or 'open'} (inclusive dates)."
    return q


_between("between_dates_both", "2024-01-05", "2024-01-10")
_between("between_dates_from", "2024-01-25", None)
_between("between_dates_to", None, "2024-01-03")
_between("between_dates_none", None, None)


_PERIOD_SQL = ("chr(10) || n_name || ':' || chr(10) || 'Temperature: ' || (n_nationkey * 3)::VARCHAR || '°F' || chr(10)"
               " || 'Wind: ' || n_nationkey::VARCHAR || ' mph NW' || chr(10) || 'Forecast: Clear near ' || n_name || chr(10)")


@register("forecast_two_hop", f"""
WITH periods AS (
  SELECT r.r_regionkey, n.n_nationkey, n.n_name,
         row_number() OVER (PARTITION BY r.r_regionkey ORDER BY n.n_nationkey) AS pn
  FROM region r JOIN nation n ON n.n_nationkey >= r.r_regionkey * 3
  WHERE r.r_regionkey <> {X.FORECAST_MISSING_REGION}
),
fc AS (
  SELECT r_regionkey, string_agg({_PERIOD_SQL}, chr(10) || '---' || chr(10) ORDER BY n_nationkey) AS txt
  FROM periods WHERE pn <= {H.FORECAST_PERIODS} GROUP BY r_regionkey
)
SELECT c.c_custkey,
       CASE WHEN n.n_nationkey IS NULL OR n.n_nationkey >= {X.POINTS_MISSING_FROM_NATION} THEN {O.q(H.POINT_MISSING)}
            WHEN fc.txt IS NULL THEN {O.q(H.FORECAST_MISSING)} ELSE fc.txt END AS forecast
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN fc ON fc.r_regionkey = n.n_regionkey
""")
def q_forecast(spark, sf_dir):
    """J7 + H6 + T3 + S10: customer → grid point payload → forecast payload → first 5 periods."""
    req = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return H.two_hop_forecast(req, X.point_payloads(spark, sf_dir), X.forecast_payloads(spark, sf_dir),
                              "c_custkey", "c_nationkey")


_ALERT_BLOCK = ("chr(10) || 'Event: Error ' || event_id::VARCHAR || chr(10) || 'Area: ' || n_name || chr(10)"
                " || 'Severity: ' || CASE WHEN value > 100 THEN 'Severe' WHEN value > 20 THEN 'Moderate' ELSE 'Unknown' END"
                " || chr(10) || 'Description: ' || props || chr(10) || 'Instructions: '"
                " || CASE WHEN value > 50 THEN 'Stay indoors' ELSE 'No specific instructions provided' END || chr(10)")


@register("alert_summaries", f"""
WITH un AS (SELECT c.c_custkey AS user_id, n.n_name, n.n_regionkey FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey),
ev AS (SELECT e.*, e.ts::DATE AS day, un.n_name, un.n_regionkey FROM events e JOIN un USING (user_id)),
req AS (SELECT DISTINCT n_name, day FROM ev WHERE event_type = 'signup'),
errs AS (
  SELECT *, ((row_number() OVER (PARTITION BY n_name, day ORDER BY event_id) - 1) // {X.ALERTS_PER_PAGE})::BIGINT AS page
  FROM ev WHERE event_type = 'error' AND n_regionkey <> {X.ALERTS_MISSING_REGION}
),
pages AS (
  SELECT n_name, day, page, string_agg({_ALERT_BLOCK}, chr(10) || '---' || chr(10) ORDER BY event_id) AS txt
  FROM errs GROUP BY n_name, day, page
),
active AS (SELECT DISTINCT n_name, day FROM ev WHERE n_regionkey <> {X.ALERTS_MISSING_REGION}),
pay AS (
  SELECT n_name, day, page, txt FROM pages
  UNION ALL
  SELECT a.n_name, a.day, 0::BIGINT AS page, NULL AS txt FROM active a
  WHERE NOT EXISTS (SELECT 1 FROM errs e WHERE e.n_name = a.n_name AND e.day = a.day)
)
SELECT req.n_name, req.day, pay.page,
       CASE WHEN pay.n_name IS NULL THEN {O.q(H.ALERTS_UNAVAILABLE)} WHEN pay.txt IS NULL THEN {O.q(H.ALERTS_NONE)}
            ELSE pay.txt END AS summary
FROM req LEFT JOIN pay USING (n_name, day)
""")
def q_alerts(spark, sf_dir):
    """A5 + P9 + P10 + H6 + S10: per alert request (area, day), each payload page
    parsed, defaults filled, blocks joined — or the unavailable / none message."""
    req = X.alert_requests(spark, sf_dir)
    pay = X.alert_payloads(spark, sf_dir).select("n_name", "day", "page",
                                                 F.from_json("payload", H.ALERTS_PAYLOAD).alias("p"))
    return req.join(pay, ["n_name", "day"], "left").select("n_name", "day", "page",
                                                           H.summarize_alerts(F.col("p")).alias("summary"))


@register("weather_urls", f"""
WITH {_CALLS_SQL}
SELECT user_id, day, pos,
       'https://wttr.in/' || replace(url_encode('City ' || user_id::VARCHAR), '%20', '+') || '?format=%C+%t' AS url
FROM calls2 WHERE name = 'weather_forecast'
""")
def q_weather_urls(spark, sf_dir):
    """URL-encoded forecast URL for every weather_forecast call (no HTTP call
    is made). Form encoding turns a space into `+`; the SQL twin maps DuckDB's
    `%20` accordingly (the locations hold letters, digits and spaces only)."""
    ex = _exploded(spark, sf_dir).filter(F.col("name") == "weather_forecast")
    return ex.select("user_id", "day", "pos", H.weather_url(F.col("arguments")["location"]).alias("url"))


_PRETTY_SQL = """SELECT event_id,
       CASE WHEN json_extract(props, '$.k') IS NULL THEN '{ }'
            ELSE '{' || chr(10) || '  "k" : ' || json_extract(props, '$.k')::BIGINT::VARCHAR || chr(10) || '}' END AS pretty
FROM events
"""


@register("pretty_payloads", _PRETTY_SQL)
def q_pretty_payloads(spark, sf_dir):
    """parse the event property JSON (schema `k long`) and pretty-print it
    (two-space indent, `"key" : value`, as the JSON writer lays it out)."""
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    parsed = F.from_json("props", "k long")
    return ev.select("event_id", F.to_json(parsed, {"pretty": "true"}).alias("pretty"))
