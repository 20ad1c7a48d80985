"""P2/P3, W1-W5, A3/A4, G1-G5 on literal conversations."""

from pyspark.sql import functions as F

from ragloom.operators import prompts as G
from ragloom.operators import sessions as S

CONV = "conv_id long, turn long, role string, text string"


def _ex(spark, rows):
    return S.pair_exchanges(spark.createDataFrame(rows, CONV))


def test_exit_words(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "EXIT"), (1, 3, "user", "more"),
            (2, 0, "user", "q"), (3, 0, "user", " exit "), (3, 1, "assistant", "still here")]
    kept = S.truncate_at_exit(spark.createDataFrame(rows, CONV)).select("conv_id", "turn").collect()
    assert sorted(tuple(r) for r in kept) == [(1, 0), (1, 1), (3, 0), (3, 1)]


def test_blank_turns(spark):
    rows = [(1, 0, "user", "  "), (1, 1, "user", "\t\n"), (1, 2, "user", " x "),
            (1, 3, "user", "\u00a0\u3000\u2028\x1c\x85"), (1, 4, "user", "\u00a0y")]
    kept = S.skip_blank_turns(spark.createDataFrame(rows, CONV)).select("turn").collect()
    assert [r[0] for r in kept] == [t for t, (_, _, _, x) in enumerate(rows) if x.strip() != ""] == [2, 4]


def test_pair_exchanges_keeps_unanswered(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2")]
    ex = _ex(spark, rows).orderBy("turn").collect()
    assert [(r["ex_no"], r["q"], r["a"]) for r in ex] == [(1, "q1", "a1"), (2, "q2", None)]


def _five(spark):
    rows = []
    for i in range(6):
        rows += [(1, 2 * i, "user", f"q{i}"), (1, 2 * i + 1, "assistant", f"a{i}")]
    return _ex(spark, rows)


def test_last_n_exchanges(spark):
    ex = S.last_n_exchanges(_five(spark), 3).orderBy("turn").collect()
    last = ex[5]["history"]
    assert [(h["q"], h["a"]) for h in last] == [("q2", "a2"), ("q3", "a3"), ("q4", "a4")]
    assert ex[0]["history"] == []
    assert S.last_n_exchanges(_five(spark), 0).first()["history"] == []


def test_last_n_blocked_equals_plain(spark):
    plain = S.last_n_exchanges(_five(spark), 3).select("turn", "history")
    for block in (3, 4, 5):
        blocked = S.last_n_exchanges(_five(spark), 3, block=block).select("turn", "history")
        assert plain.exceptAll(blocked).count() == 0 and blocked.count() == plain.count()


def test_retained_2n(spark):
    rows = []
    for i in range(9):
        rows += [(1, 2 * i, "user", f"q{i}"), (1, 2 * i + 1, "assistant", f"a{i}")]
    ex = S.retained_history(_ex(spark, rows), 3).orderBy("turn").collect()
    assert [h["q"] for h in ex[-1]["kept"]] == [f"q{i}" for i in range(3, 9)]
    shown = spark.createDataFrame([([1, 2, 3, 4, 5],), ([1],)], "a array<int>").select(S.tail("a", 3)).collect()
    assert [r[0] for r in shown] == [[3, 4, 5], [1]]


def test_history_query_text(spark):
    ex = S.last_n_exchanges(_five(spark), 2).orderBy("turn").collect()
    df = spark.createDataFrame([(ex[2]["history"], "now?")], "h array<struct<q:string,a:string>>, q string")
    text = df.select(G.history_query("h", "q")).first()[0]
    assert text == ("Previous question 1: q0\nPrevious answer 1: a0\n\n"
                    "Previous question 2: q1\nPrevious answer 2: a1\n\n"
                    " Based on the above conversation, please answer: now?")
    empty = spark.createDataFrame([([], "solo")], "h array<struct<q:string,a:string>>, q string")
    assert empty.select(G.history_query("h", "q")).first()[0] == "solo"


def test_full_prefix_and_collect(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "user", "c")]
    df = spark.createDataFrame(rows, CONV)
    pre = S.full_prefix(df).orderBy("turn").collect()
    assert [len(r["messages"]) for r in pre] == [1, 2, 3]
    msgs = S.collect_messages(df).first()["messages"]
    assert [m["content"] for m in msgs] == ["a", "b", "c"]


def test_with_system_positions(spark):
    df = spark.createDataFrame([([("user", "u1"), ("assistant", "a1"), ("user", "u2")],)],
                               "m array<struct<role:string,content:string>>")
    first = df.select(G.with_system("m", "S", "first")).first()[0]
    before = df.select(G.with_system("m", "S", "before_last")).first()[0]
    after = df.select(G.with_system("m", "S", "after_last")).first()[0]
    assert [x["role"] for x in first] == ["system", "user", "assistant", "user"]
    assert [x["content"] for x in before] == ["u1", "a1", "S", "u2"]
    assert after[-1]["role"] == "system"
    seeded = df.select(G.seed_history("m", [("user", "s1"), ("assistant", "s2")])).first()[0]
    assert [x["content"] for x in seeded][:3] == ["s1", "s2", "u1"]


def test_assemble_out_of_order(spark):
    pieces = spark.createDataFrame([(1, 1, 2, "c", True), (1, 1, 0, "a", False), (1, 1, 1, "", False)],
                                   "conv_id long, turn long, seq int, piece string, done boolean")
    out = S.assemble_stream(pieces, ["conv_id", "turn"]).first()
    assert out["reply"] == "ac" and out["n_pieces"] == 3


def test_prompts(spark):
    df = spark.createDataFrame([("ctx", "why?")], "c string, q string")
    assert df.select(G.augmented_prompt("c", "q")).first()[0] == "Using this data: ctx. Respond to this prompt: why?"
    p = df.select(G.rag_prompt("c", "q")).first()[0]
    assert "Context:\n    ctx\n" in p and "Question: why?" in p
    q = spark.createDataFrame([(1, "x"), (2, "y")], "id long, question string")
    hits = spark.createDataFrame([(1, 2, "second"), (1, 1, "first")], "id long, rank int, t string")
    ctx = {r["id"]: r["context"] for r in G.stuff_context(q, hits, "id", "t").collect()}
    assert ctx == {1: "first\n\nsecond", 2: "No relevant docs"}


def _windowed(df, n=3):
    ex = S.pair_exchanges(S.truncate_at_exit(S.skip_blank_inputs(df)))
    return S.last_n_exchanges(ex, n).select("conv_id", "turn", "ex_no", "q", "a", "history")


def _balanced(df, n=3):
    return S.last_n_exchanges_balanced(S.exchanges_balanced(df), n).select(
        "conv_id", "turn", "ex_no", "q", "a", "history")


def test_balanced_equals_windowed_literals(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "  "),
            (1, 4, "user", "q2"), (1, 5, "user", "q3"), (1, 6, "assistant", "a3"), (1, 7, "user", "QUIT"),
            (1, 8, "user", "after"), (2, 0, "user", "only"), (3, 5, "user", "x"), (3, 9, "assistant", "y")]
    df = spark.createDataFrame(rows, CONV)
    w, b = _windowed(df), _balanced(df)
    assert w.count() == b.count() == 5
    assert w.exceptAll(b).count() == 0


def test_balanced_equals_windowed_hot_conversation(spark):
    # one conversation with 3,000 turns next to many short ones
    rows = [(0, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(3000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"c{c}t{t}") for c in range(1, 200) for t in range(4)]
    df = spark.createDataFrame(rows, CONV).repartition(7)
    w, b = _windowed(df), _balanced(df)
    assert w.count() == b.count() == 1500 + 199 * 2
    assert w.exceptAll(b).count() == 0


def test_flow_equals_windows(spark):
    from ragloom.plans.flows import exchanges_with_history
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(40)]
    df = spark.createDataFrame(rows, CONV)
    a, b = _windowed(df), exchanges_with_history(df, 3).select(*_windowed(df).columns)
    assert a.count() == 20 and a.exceptAll(b).count() == 0


IRREGULAR = [(1, 0, "user", "q0"), (1, 1, "assistant", "a0"), (1, 2, "user", "q1"), (1, 3, "system", "s"),
             (1, 4, "assistant", "a1"), (1, 5, "user", "q2"), (1, 6, "assistant", "  "), (1, 7, "user", "lost"),
             (1, 8, "user", " "), (1, 9, "user", "q3"), (1, 10, "assistant", "a3"), (1, 11, "assistant", "more"),
             (1, 12, "user", "q4"), (1, 13, "assistant", None), (1, 14, "user", "q5")]
SHOWN = {0: [], 2: [("q0", "a0")], 5: [("q0", "a0"), ("q1", "a1")], 7: [("q0", "a0"), ("q1", "a1"), ("q2", "  ")],
         9: [("q0", "a0"), ("q1", "a1"), ("q2", "  ")], 12: [("q1", "a1"), ("q2", "  "), ("q3", "a3")],
         14: [("q1", "a1"), ("q2", "  "), ("q3", "a3")]}


def _shown(df):
    return {r["turn"]: [(h["q"], h["a"]) for h in r["history"]] for r in df.collect()}


def test_history_counts_answered_exchanges(spark):
    """Unanswered turns take no place; other roles, blank and null replies follow one rule."""
    turns = spark.createDataFrame(IRREGULAR, CONV)
    ex = S.pair_exchanges(S.truncate_at_exit(S.skip_blank_inputs(turns)))
    assert _shown(S.last_n_exchanges(ex, 3)) == SHOWN
    assert _shown(S.last_n_exchanges(ex, 3, block=3)) == SHOWN
    assert _shown(S.last_n_exchanges_balanced(S.exchanges_balanced(turns), 3)) == SHOWN
    kept = {r["turn"]: [h["q"] for h in r["kept"]] for r in S.retained_history(ex, 1).collect()}
    assert kept == {0: ["q0"], 2: ["q0", "q1"], 5: ["q1", "q2"], 7: ["q1", "q2"], 9: ["q2", "q3"], 12: ["q2", "q3"],
                    14: ["q2", "q3"]}


def test_answered_before_over_blocks(spark):
    ex = S.pair_exchanges(S.skip_blank_inputs(spark.createDataFrame(IRREGULAR, CONV)))
    for block in (1, 2, 100):
        got = {r["turn"]: r["n_before"] for r in S.answered_before(ex, block=block).collect()}
        assert got == {0: 0, 2: 1, 5: 2, 7: 3, 9: 3, 12: 4, 14: 4}


def test_stream_history_follows_the_batch_rule(spark, tmpdir_path):
    from ragloom.streaming import history as SH
    from ragloom.streaming import retrieve as SR
    spark.createDataFrame(IRREGULAR, CONV).write.parquet(tmpdir_path + "/turns")
    for n in (3, 0):
        turns = spark.readStream.schema(CONV).parquet(tmpdir_path + "/turns")
        out = f"{tmpdir_path}/out{n}"
        SR.run_to_parquet(SH.stream_history(turns, n), out, out + "-ckpt")
        got = {r["turn"]: r["history_text"] for r in spark.read.parquet(out).collect()}
        assert got == {t: "\n".join(f"{q} -> {a}" for q, a in h) if n else "" for t, h in SHOWN.items()}
