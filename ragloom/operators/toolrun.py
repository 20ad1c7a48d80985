"""Running tool calls as fan-out and fan-in of DataFrame handlers.

A handler answers all calls of one tool at once: it gets a DataFrame of calls
(the call's key columns and `arguments`) and returns the key columns and
`output`. So a tool that looks something up is a join, a tool that computes is a
projection, and a user's Python function is an Arrow UDF; all have one form.
`execute` splits the calls by tool, runs each tool's handler over its part, and
joins the outputs back by the call's key. Calls of tools without a handler, and
handlers that return nothing for a call, get a message instead of an output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.operators import tools as H

Handler = Callable[[DataFrame], DataFrame]

NO_OUTPUT = "Error: {name} returned nothing"
BAD_INTEGER = "Error: arguments must be integers"
BAD_DATE = "Error: dates must be in ISO 8601 format"
BAD_LOCATION = "Error: unknown location"
MESSAGE = "struct<role:string,content:string,name:string>"


@dataclass(frozen=True)
class ColumnTool:
    """A tool that is an expression over its arguments. `execute` evaluates it where the
    calls are, without splitting them off."""
    fn: Callable[[Column], Column]

    def __call__(self, calls: DataFrame) -> DataFrame:
        return calls.withColumn("output", self.fn(F.col("arguments")))


def python_tool(name: str, fn: Callable) -> Handler:
    """A tool that is a Python function of keyword strings (K3, see `run_user_tools`)."""
    return lambda calls: H.run_user_tools(calls.withColumn("__tool", F.lit(name)), {name: fn}, "__tool").drop("__tool")


def integer_tool(fn: Callable[[Column, Column], Column]) -> Handler:
    """a tool over the integers `a` and `b`, given as text."""
    return ColumnTool(lambda args: F.coalesce(fn(H.int_arg(args, "a"), H.int_arg(args, "b")).cast("string"), F.lit(BAD_INTEGER)))


def lookup_tool(argument: str, table: DataFrame, key: str, value: str, missing: str) -> Handler:
    """A tool that answers from a table `(key, value)` with one row per key: an equi-join on the argument."""
    def run(calls: DataFrame) -> DataFrame:
        rows = table.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
        asked = calls.withColumn("__key", F.col("arguments")[argument])
        return asked.join(rows, "__key", "left").withColumn("output", F.coalesce("__value", F.lit(missing))).drop("__key", "__value")
    return run


def deployments_tool(deployments: DataFrame, keys: Sequence[str], ts_col: str = "ts", value_col: str = "value") -> Handler:
    """J8 as a tool: the count and total of the deployments in the call's date range, as JSON."""
    def run(calls: DataFrame) -> DataFrame:
        args = F.col("arguments")
        asked = calls.select(*keys, args["fromDate"].alias("fromDate"), args["toDate"].alias("toDate"))
        found = H.date_range_summary(asked, deployments, list(keys), ts_col, value_col)
        body = F.concat(F.lit('{"deployments": '), F.col("n_deployments").cast("string"), F.lit(', "total": '),
                        F.col("total_value").cast("decimal(38,2)").cast("string"), F.lit("}"))
        return found.withColumn("output", F.coalesce(body, F.lit(BAD_DATE)))
    return run


def alerts_tool(payloads: DataFrame, area_col: str, payload_col: str) -> Handler:
    """A5 as a tool: the alert pages of the asked state, formatted and joined; `payloads` has a row per page."""
    pages = payloads.select(F.col(area_col).alias("__key"), H.summarize_alerts(F.from_json(payload_col, H.ALERTS_PAYLOAD)).alias("text"))
    whole = pages.groupBy("__key").agg(F.array_join(F.array_sort(F.collect_list("text")), H.BLOCK_SEP).alias("__value"))
    return lookup_tool("state", whole, "__key", "__value", H.ALERTS_UNAVAILABLE)


def execute(calls: DataFrame, keys: Sequence[str], handlers: dict[str, Handler]) -> DataFrame:
    """H2: `calls (keys..., pos, name, arguments)` with `found` and `output`. `keys` and
    `pos` name a call. A row without a call (H1's no-calls branch) has a null output;
    every call has a text. Several rows of a handler for one call count as their greatest."""
    call = [*keys, "pos"]
    given = [F.col(c).alias(f"__{c}") for c in call]
    inline = {n: h for n, h in handlers.items() if isinstance(h, ColumnTool)}
    done = [h(calls.where((F.col("name") == n) & F.col("pos").isNotNull()).select(*call, "arguments")).select(
        *given, F.col("output").cast("string").alias("__output")) for n, h in handlers.items() if n not in inline]
    said = F.lit(None).cast("string")
    for n, h in inline.items():
        said = F.when(F.col("name") == n, h.fn(F.col("arguments")).cast("string")).otherwise(said)
    found = F.coalesce(F.col("name").isin(list(handlers)), F.lit(False))
    if not done:
        return calls.withColumns({"found": found, "output": _missing(found, said)})
    outputs = reduce(DataFrame.unionByName, done).groupBy(*(f"__{c}" for c in call)).agg(F.max("__output").alias("__output"))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in call))
    out = calls.join(outputs, same, "left").withColumns({"found": found, "output": _missing(found, F.coalesce("__output", said))})
    return out.drop("__output", *(f"__{c}" for c in call))


def _missing(found: Column, output: Column) -> Column:
    def said(text):
        head, tail = text.split("{name}")
        return F.concat(F.lit(head), F.col("name"), F.lit(tail))
    return F.when(found, F.coalesce(output, said(NO_OUTPUT))).otherwise(said(H.NOT_FOUND))


def append_tool_messages(messages: DataFrame, executed: DataFrame, keys: Sequence[str], messages_col: str = "messages",
                         all: bool = False) -> DataFrame:
    """H3: `messages (keys..., messages array<role, content, name>)` with the outcome of the reply's
    calls appended as messages of role `tool`: only the last found call (of a reply whose
    calls all missed, the last one), or with `all` every call in order. Messages of
    replies without calls stay as they are."""
    calls = executed.where(F.col("pos").isNotNull())
    said = F.struct(F.lit("tool").alias("role"), F.col("output").alias("content"), F.col("name").alias("name"))
    if all:
        tail = calls.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", said.alias("m")))).alias("__t"))
        tail = tail.withColumn("__t", F.transform("__t", lambda x: x["m"]))
    else:
        tail = calls.groupBy(*keys).agg(F.array(F.max_by(said, F.struct("found", "pos"))).alias("__t"))
    tail = tail.select(*(F.col(c).alias(f"__{c}") for c in keys), "__t")
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys))
    none = F.array().cast(f"array<{MESSAGE}>")
    out = messages.join(tail, same, "left")
    return out.withColumn(messages_col, F.concat(messages_col, F.coalesce("__t", none))).drop("__t", *(f"__{c}" for c in keys))


def tool_round(replies: DataFrame, keys: Sequence[str], handlers: dict[str, Handler], reply_col: str = "reply",
               question_col: str | None = None, all: bool = False) -> DataFrame:
    """E3 up to the second model call: `(keys..., n_calls, messages, status)` per reply. The
    messages are the question (if there is one), the reply, and what its tools
    said; `status` is null, or the text of the no-calls branch. Put K4 over
    the messages for the final answer."""
    parsed = F.from_json(reply_col, H.REPLY)["message"]
    parts = [F.struct(F.coalesce(parsed["role"], F.lit("assistant")).alias("role"), parsed["content"].alias("content"),
                      F.lit(None).cast("string").alias("name"))]
    if question_col:
        parts.insert(0, F.struct(F.lit("user").alias("role"), F.col(question_col).alias("content"), F.lit(None).cast("string").alias("name")))
    n = F.coalesce(F.size(parsed["tool_calls"]), F.lit(0))
    base = replies.select(*keys, F.greatest(n, F.lit(0)).alias("n_calls"), F.array(*parts).cast(f"array<{MESSAGE}>").alias("messages"))
    executed = execute(H.explode_calls(replies, list(keys), reply_col), keys, handlers)
    out = append_tool_messages(base, executed, keys, all=all)
    return out.withColumn("status", F.when(F.col("n_calls") == 0, F.lit(H.NO_CALLS)))
