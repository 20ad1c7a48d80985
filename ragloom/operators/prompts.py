"""Ordered concatenation (A2, A3, A6) and prompt / message column builders
(G1-G5). All JVM expressions: `listagg ... WITHIN GROUP` for ordered string
aggregation, `format_string` / `concat` for templates, array functions for
message lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prompt texts and fallbacks as worded by the reference.
RAG_TEMPLATE = (
    "\n    Answer the question based only on the following context. If you don't know the answer or \n"
    "    the information is not provided in the context, just say so - don't make up an answer. \n"
    "    Use the same language as the user question.\n"
    "    \n"
    "    Context:\n"
    "    {context}\n"
    "    \n"
    "    Question: {question}\n"
    "    \n"
    "    Answer:\n"
    "    "
)
AUGMENTED_TEMPLATE = "Using this data: {context}. Respond to this prompt: {question}"
NO_CONTEXT = "No relevant docs"
HISTORY_QUESTION = "Previous question {i}: {q}\n"        # also used by the streaming twin
HISTORY_ANSWER = "Previous answer {i}: {a}\n\n"
HISTORY_BRIDGE = " Based on the above conversation, please answer: "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(s: str) -> str:
    """Spark SQL string literal for `s`."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t") + "'"


def ordered_concat(df: DataFrame, keys: list[str], text_col: str, order_col: str, sep: str,
                   out_col: str) -> DataFrame:
    """Concatenate `text_col` per group in `order_col` order with `sep` (A2/A3/A6 core).

    `listagg` is a regular aggregate: Spark combines it per group after the
    exchange on `keys`; the group size is the size of one output string.
    """
    agg = F.expr(f"listagg({text_col}, {sql_str(sep)}) WITHIN GROUP (ORDER BY {order_col})")
    return df.groupBy(*keys).agg(agg.alias(out_col))


def stuff_context(questions: DataFrame, hits: DataFrame, q_key: str, text_col: str, sep: str = "\n\n",
                  fallback: str | None = NO_CONTEXT) -> DataFrame:
    """A2: per question, hit texts in rank order joined by `sep`; no hits → fallback.

    Output `(q_key, question columns..., n_hits, context)`.
    """
    ctx = (hits.groupBy(q_key)
               .agg(F.count(F.lit(1)).alias("n_hits"),
                    F.expr(f"listagg({text_col}, {sql_str(sep)}) WITHIN GROUP (ORDER BY rank)").alias("context")))
    out = questions.join(ctx, q_key, "left")
    ctx_col = F.col("context") if fallback is None else F.coalesce(F.col("context"), F.lit(fallback))
    return (out.withColumn("n_hits", F.coalesce(F.col("n_hits"), F.lit(0)).cast("long"))
               .withColumn("context", ctx_col))


def rag_prompt(context: Column | str, question: Column | str) -> Column:
    """G1: the answer-only-from-context prompt."""
    head, rest = RAG_TEMPLATE.split("{context}")
    mid, tail = rest.split("{question}")
    return F.concat(F.lit(head), _col(context), F.lit(mid), _col(question), F.lit(tail))


def augmented_prompt(context: Column | str, question: Column | str) -> Column:
    """The one-line prompt form."""
    head, rest = AUGMENTED_TEMPLATE.split("{context}")
    mid, tail = rest.split("{question}")
    return F.concat(F.lit(head), _col(context), F.lit(mid), _col(question), F.lit(tail))


def history_query(history: Column | str, question: Column | str) -> Column:
    """Numbered previous exchanges, then the bridge sentence and the question.

    `history` is `array<struct<q string, a string>>`, oldest first. An empty or
    null history leaves the question unchanged.
    """
    h = _col(history)
    lines = F.transform(h, lambda x, i: F.concat(
        F.lit("Previous question "), (i + 1).cast("string"), F.lit(": "), x["q"], F.lit("\n"),
        F.lit("Previous answer "), (i + 1).cast("string"), F.lit(": "), x["a"], F.lit("\n\n")))
    text = F.concat(F.array_join(lines, ""), F.lit(HISTORY_BRIDGE), _col(question))
    return F.when(F.coalesce(F.size(h), F.lit(0)) > 0, text).otherwise(_col(question))


def message(role: Column | str, content: Column | str, name: Column | str | None = None) -> Column:
    """A chat message struct `struct<role, content>` (plus `name` when given,
    as tool messages carry the tool's name)."""
    r = F.lit(role) if isinstance(role, str) and role in ("user", "assistant", "system", "tool") else _col(role)
    c = F.lit(content) if isinstance(content, str) else content
    fields = [r.cast("string").alias("role"), c.cast("string").alias("content")]
    if name is not None:
        fields.append(_col(name).cast("string").alias("name"))
    return F.struct(*fields)


def with_system(messages: Column | str, system_text: Column | str, position: str = "first") -> Column:
    """Place a system message `first`, `before_last` (just before the last
    message, i.e. the pending user turn) or `after_last`."""
    msgs = _col(messages)
    sys_msg = message("system", system_text)
    one = F.array(sys_msg)
    if position == "first":
        return F.concat(one, msgs)
    if position == "after_last":
        return F.concat(msgs, one)
    if position == "before_last":
        n = F.size(msgs)
        return F.when(n == 0, one).otherwise(
            F.concat(F.slice(msgs, F.lit(1), F.greatest(n - 1, F.lit(0))), one, F.slice(msgs, n, F.lit(1))))
    raise ValueError("position must be first, before_last or after_last")


def seed_history(messages: Column | str, seed: list[tuple[str, str]]) -> Column:
    """Fixed opening messages `(role, content)` placed before the live ones."""
    seed_arr = F.array(*[message(r, c) for r, c in seed])
    return F.concat(seed_arr, _col(messages))
