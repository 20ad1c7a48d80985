"""Conversation operators over a turn table `(conv_id, turn, role, text)`:
P2 blank turns, P3 exit words, W1-W5 windows, A3/A4 ordered collection.

All windows are partitioned by the conversation key and ordered by turn;
frames are bounded (`n` preceding rows) wherever the operator allows it, so a
row's work does not grow with the conversation length. A conversation is the
unit of ordering, so its rows meet in one task; `split_long_conversations`
splits very long conversations into turn blocks with an `n`-row overlap for
the bounded-frame operators (exact, see its docstring).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words that end a chat session (compared lower-cased,
# without stripping) and the default history sizes (3 shown, 6 kept).
EXIT_WORDS = ("exit", "quit", "q")
DEFAULT_HISTORY = 3

EXCHANGE = T.StructType([T.StructField("q", T.StringType()), T.StructField("a", T.StringType())])


# Whitespace as Python's str.strip() sees it: ASCII \s, the Unicode separator
# categories, and the file/group/record/unit separators and NEL.
WS_CLASS = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
STRIP_PATTERN = f"^{WS_CLASS}+|{WS_CLASS}+$"


def strip(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, STRIP_PATTERN, "")


def skip_blank_turns(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Drop turns whose text is empty after stripping whitespace."""
    return df.filter(strip(text_col) != "")


def skip_blank_inputs(df: DataFrame, text_col: str = "text", role_col: str = "role") -> DataFrame:
    """P2 inside a conversation: blank user turns are skipped, a blank reply is
    still a reply. Turns without a text (null) are no turns."""
    return df.filter(F.col(text_col).isNotNull() & ((F.col(role_col) != "user") | (strip(text_col) != "")))


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose value is not the empty string (no stripping)."""
    return df.filter(F.col(col) != "")


def is_exit(text_col: str = "text", words=EXIT_WORDS, strip_first: bool = False) -> Column:
    t = strip(text_col) if strip_first else F.col(text_col)
    return F.lower(t).isin(list(words))


def truncate_at_exit(df: DataFrame, conv: str = "conv_id", order: str = "turn", text_col: str = "text",
                     role_col: str | None = "role", words=EXIT_WORDS, strip_first: bool = False) -> DataFrame:
    """A session ends at its first user turn that is an exit word; that
    turn and everything after it are dropped. Running max over an
    unbounded-preceding frame: O(1) state per row."""
    cond = is_exit(text_col, words, strip_first)
    if role_col:
        cond = cond & (F.col(role_col) == "user")
    cond = F.coalesce(cond, F.lit(False))
    w = Window.partitionBy(conv).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (df.withColumn("__ended", F.max(cond.cast("int")).over(w))
              .filter(F.col("__ended") == 0).drop("__ended"))


def pair_exchanges(df: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """W4 + W5: each user turn with the first assistant turn before the next
    user turn; turns of other roles in between do not matter.

    Output `(conv_id, turn, ex_no, q, a)`; `ex_no` is 1-based within the
    conversation; an unanswered user turn keeps `a = null`.
    """
    w = Window.partitionBy(conv).orderBy(order)
    talk = df.filter(F.col("role").isin("user", "assistant"))
    nxt = (talk.withColumn("__nrole", F.lead("role").over(w))
             .withColumn("__ntext", F.lead("text").over(w)))
    ex = nxt.filter(F.col("role") == "user").select(
        conv, order, F.col("text").alias("q"),
        F.when(F.col("__nrole") == "assistant", F.col("__ntext")).alias("a"))
    return ex.withColumn("ex_no", F.row_number().over(Window.partitionBy(conv).orderBy(order)))


def _answered(ex: DataFrame) -> Column:
    return F.col("a").isNotNull().cast("long")


def _item() -> Column:
    return F.when(F.col("a").isNotNull(), F.struct(F.col("q").alias("q"), F.col("a").alias("a")))


def answered_before(ex: DataFrame, conv: str = "conv_id", block: int = 10_000, out_col: str = "n_before") -> DataFrame:
    """Number of answered exchanges before each exchange of its conversation
    (needs `ex_no`). Running counts inside blocks of `block` exchanges plus the
    totals of the blocks before: the only window keyed by the conversation
    alone runs over one row per block."""
    blk = F.floor((F.col("ex_no") - 1) / F.lit(block)).cast("long")
    inside = Window.partitionBy(conv, "__blk").orderBy("ex_no").rowsBetween(Window.unboundedPreceding, -1)
    numbered = ex.withColumn("__blk", blk).withColumn(
        "__in", F.coalesce(F.sum(_answered(ex)).over(inside), F.lit(0)))
    per_block = ex.groupBy(conv, blk.alias("__blk")).agg(F.sum(_answered(ex)).alias("__n"))
    earlier = Window.partitionBy(conv).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(conv, "__blk", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    return (numbered.join(offsets, [conv, "__blk"])
                    .withColumn(out_col, F.col("__off") + F.col("__in")).drop("__blk", "__in", "__off"))


def last_n_exchanges(ex: DataFrame, n: int = DEFAULT_HISTORY, conv: str = "conv_id", order: str = "turn",
                     out_col: str = "history", block: int | None = None) -> DataFrame:
    """The previous `n` answered exchanges, oldest first, current excluded.

    `n = 0` means no history (the reference's `[-0:]` slice would return all
    of it; we implement the intent). Unanswered exchanges take no place: the
    frame counts answered ones (range over their running number). With `block`
    set (needs `ex_no`), conversations are split into blocks of that many
    answered exchanges first (`split_long_conversations`), so one very long
    conversation is spread over many tasks; the result is identical.
    """
    if n <= 0:
        return ex.withColumn(out_col, F.array().cast(T.ArrayType(EXCHANGE)))
    if block:
        if block < n:
            raise ValueError("block must be >= n")
        parts = split_long_conversations(answered_before(ex, conv, out_col="__b"), block, n, "__b")
        w = Window.partitionBy(conv, "blk").orderBy("__b").rangeBetween(-n, -1)
        return (parts.withColumn(out_col, F.collect_list(_item()).over(w))
                     .filter(F.col("__own")).drop("blk", "__own", "__b"))
    before = Window.partitionBy(conv).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    w = Window.partitionBy(conv).orderBy("__b").rangeBetween(-n, -1)
    return (ex.withColumn("__b", F.coalesce(F.sum(_answered(ex)).over(before), F.lit(0)))
              .withColumn(out_col, F.collect_list(_item()).over(w)).drop("__b"))


def retained_history(ex: DataFrame, n: int = DEFAULT_HISTORY, conv: str = "conv_id", order: str = "turn",
                     out_col: str = "kept") -> DataFrame:
    """History as stored after each exchange — the last `2n` answered
    exchanges including the current one (only `n` of them are shown); an
    unanswered exchange leaves it as it was."""
    if n <= 0:
        return ex.withColumn(out_col, F.array().cast(T.ArrayType(EXCHANGE)))
    upto = Window.partitionBy(conv).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w = Window.partitionBy(conv).orderBy("__b").rangeBetween(-(2 * n - 1), 0)
    return (ex.withColumn("__b", F.sum(_answered(ex)).over(upto))
              .withColumn(out_col, F.collect_list(_item()).over(w)).drop("__b"))


def full_prefix(df: DataFrame, conv: str = "conv_id", order: str = "turn", out_col: str = "messages") -> DataFrame:
    """Every message so far, current included last, as
    `array<struct<role, content>>` (the unbounded chat history)."""
    w = Window.partitionBy(conv).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    msg = F.struct(F.col("role").alias("role"), F.col("text").alias("content"))
    return df.withColumn(out_col, F.collect_list(msg).over(w))


def collect_messages(df: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """A4: ordered message array per conversation `(conv_id, n_messages, messages)`."""
    agg = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("role"), F.col("text"))))
    return (df.groupBy(conv).agg(agg.alias("__m"))
              .select(conv, F.size("__m").alias("n_messages"),
                      F.transform("__m", lambda m: F.struct(m["role"].alias("role"),
                                                            m["text"].alias("content"))).alias("messages")))


def render_messages(messages: Column | str, sep: str = "\n") -> Column:
    """Flatten a message array to `role: content` lines (for display and checks)."""
    m = F.col(messages) if isinstance(messages, str) else messages
    return F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(": "), x["content"])), sep)


def tail(arr: Column | str, n: int) -> Column:
    """T4: the last `n` elements (all when shorter; `slice(a, -n, n)` would
    return an empty array for short inputs)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.slice(a, F.greatest(F.size(a) - F.lit(n - 1), F.lit(1)), F.lit(n))


def split_pieces(df: DataFrame, text_col: str, every: int, keys: list[str]) -> DataFrame:
    """Cut a text into consecutive pieces of `every` characters with `seq`
    (0-based) and a `done` flag on the last piece (token stream shape)."""
    n = F.length(text_col)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(every))
    out = df.select(*keys, text_col, F.posexplode(starts).alias("seq", "__s"))
    return out.select(*keys, "seq", F.substring(text_col, F.col("__s") + 1, every).alias("piece"),
                      ((F.col("__s") + every) >= n).alias("done"))


def assemble_stream(pieces: DataFrame, keys: list[str], seq: str = "seq", piece: str = "piece",
                    out_col: str = "reply") -> DataFrame:
    """A3: concatenate reply pieces in `seq` order per reply (arrival order is irrelevant)."""
    agg = F.expr(f"listagg({piece}, '') WITHIN GROUP (ORDER BY {seq})")
    return pieces.groupBy(*keys).agg(agg.alias(out_col), F.count(F.lit(1)).alias("n_pieces"))


def split_long_conversations(ex: DataFrame, block: int, overlap: int, number: str = "n_before") -> DataFrame:
    """Skew guard for bounded-frame windows.

    Rows get `blk = number // block`, where `number` counts the answered
    exchanges before the row; each block also receives the answered rows of the
    `overlap` numbers before it (flag `__own = false`), so a window partitioned
    by `(conv, blk)` with a frame of at most `overlap` preceding numbers sees
    exactly what it would see over the whole conversation. Keep only `__own`
    rows afterwards. A conversation holding a third of the data is then spread
    over many tasks.
    """
    blk = F.floor(F.col(number) / F.lit(block)).cast("long")
    own = ex.withColumn("blk", blk).withColumn("__own", F.lit(True))
    near_end = F.col(number) - blk * block >= block - overlap
    spill = ex.filter(near_end & F.col("a").isNotNull()).withColumn("blk", blk + 1).withColumn("__own", F.lit(False))
    return own.unionByName(spill)


# ---------------------------------------------------------------------------
# Balanced forms: no window partitioned by the conversation alone
# ---------------------------------------------------------------------------

def exchanges_balanced(turns: DataFrame, conv: str = "conv_id", order: str = "turn", words=EXIT_WORDS) -> DataFrame:
    """P2 + P3 + W4 + W5 with every shuffle keyed by (conversation, position),
    so a conversation holding a third of all turns is spread over all tasks.

    * positions inside a conversation: `with_group_ordinal` (range sort);
    * the session end (P3): per-conversation minimum exit turn — a map-side
      combined aggregate — joined back (AQE splits a skewed join partition);
    * the next turn (W4): equality join on (conversation, position + 1);
    * the exchange number (W5): `with_group_ordinal` over the user turns.
    Same rows as `pair_exchanges(truncate_at_exit(skip_blank_inputs(...)))`.
    """
    from ragloom.operators.rows import with_group_ordinal
    t = skip_blank_inputs(turns).select(conv, order, "role", "text").filter(F.col("role").isin("user", "assistant"))
    exit_turn = (t.filter((F.col("role") == "user") & is_exit("text", words))
                  .groupBy(conv).agg(F.min(order).alias("__exit")))
    t = (t.join(exit_turn, conv, "left")
          .filter(F.col("__exit").isNull() | (F.col(order) < F.col("__exit"))).drop("__exit"))
    t = with_group_ordinal(t, [conv], [order], "__o")
    nxt = t.select(conv, (F.col("__o") - 1).alias("__o"), F.col("role").alias("__nrole"),
                   F.col("text").alias("__ntext"))
    users = t.filter(F.col("role") == "user").join(nxt, [conv, "__o"], "left")
    ex = users.select(conv, order, F.col("text").alias("q"),
                      F.when(F.col("__nrole") == "assistant", F.col("__ntext")).alias("a"))
    ex = with_group_ordinal(ex, [conv], [order], "__e")
    return ex.withColumn("ex_no", (F.col("__e") + 1).cast("int")).drop("__e")


def last_n_exchanges_balanced(ex: DataFrame, n: int = DEFAULT_HISTORY, conv: str = "conv_id",
                              out_col: str = "history") -> DataFrame:
    """W1 without a conversation window: each exchange asks for the numbers of
    the `n` answered exchanges before it (n rows, exploded), an equality join on
    (conversation, number) fetches them, and a group of at most n items per
    exchange is collected in order. Same result as `last_n_exchanges`."""
    if n <= 0:
        return ex.withColumn(out_col, F.array().cast(T.ArrayType(EXCHANGE)))
    numbered = answered_before(ex, conv, out_col="__b")
    want = numbered.select(conv, "ex_no", "__b", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("__back"))
    prev = numbered.filter(F.col("a").isNotNull()).select(conv, F.col("__b").alias("__pno"), "q", "a")
    got = (want.withColumn("__pno", F.col("__b") - F.col("__back"))
               .join(prev, [conv, "__pno"])
               .groupBy(conv, "ex_no")
               .agg(F.array_sort(F.collect_list(F.struct("__pno", "q", "a"))).alias("__h")))
    hist = got.select(conv, "ex_no", F.transform("__h", lambda x: F.struct(x["q"].alias("q"), x["a"].alias("a")))
                      .alias(out_col))
    out = ex.join(hist, [conv, "ex_no"], "left")
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.array().cast(T.ArrayType(EXCHANGE))))
