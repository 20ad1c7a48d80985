"""Repeated ids lose no text, column names never clash, quoted speech, host prior."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ragloom.llm import decontam, hilbert, linededup, neardup, quality, toxicity, warc

A, B, C = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
CLASHES = ["_id", "_drop", "_gone", "_nth", "_host", "_s", "h", "_h", "_cell", "_hash", "hash", "row", "text_key", "cls", "best",
           "failed", "host", "s", "pos", "rank", "group", "groups", "cell", "stays", "component", "drop", "line_no", "key", "score"]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)


@pytest.mark.parametrize("edits", [None, 1])
def test_lines_of_repeated_ids(spark, edits):
    one = "first line of everything here\nx y z and some more words\nthird line of everything here"
    two = "a wholly unique line of its own\nsecond thing that nobody else says\nfirst line of everything here"
    rows = [(1, "first line of everything here"), (2, one), (2, two), (2, one), (3, "a wholly unique line of its own\nnew words in the last line")]
    got = sorted((r["doc_id"], r["text"]) for r in linededup.dedup_lines(_docs(spark, rows), edits=edits).collect())
    rest = "x y z and some more words\nthird line of everything here"
    assert got == sorted([(1, rows[0][1]), (2, rest), (2, rest), (2, "a wholly unique line of its own\nsecond thing that nobody else says"),
                          (3, "new words in the last line")])


def test_near_duplicates_of_repeated_ids(spark):
    def kept(rows):
        return sorted(((r["doc_id"], r["text"]) for r in neardup.drop_near_duplicates(_docs(spark, rows), 80).collect()), key=str)
    assert kept([(1, A), (2, A), (2, B), (3, C)]) == [(1, A), (2, B), (3, C)]
    assert kept([(1, A), (1, B), (3, C)]) == [(1, A), (1, B), (3, C)]
    assert kept([(1, A), (1, A), (1, A + " end")]) in ([(1, A)], [(1, A + " end")])
    assert len(kept([(2, A), (1, A + " end"), (1, A + " end"), (5, B), (5, B)])) == 2
    assert len(kept([(None, A), (None, A), (1, A), (2, ""), (2, "")])) == 5


def test_names_do_not_clash(spark):
    rows = [(i, t) for i, t in enumerate([A, A, B, "", None, C + "\n" + A])]
    df = _docs(spark, rows).withColumns({c: F.col("doc_id") * 10 for c in CLASHES}).withColumn("source", F.lit("site"))
    items = spark.createDataFrame([(1, B)], "item_id long, text string")
    outs = {"lines": linededup.dedup_lines(df), "near": neardup.drop_near_duplicates(df), "leaks": decontam.drop_contaminated(df, items),
            "quality": quality.filter_documents(df), "shards": hilbert.assign(df, 3, ["source"], "doc_id")}
    for name, out in outs.items():
        extra = [c for c in CLASHES if not (name == "shards" and c == "h")]
        for r in out.collect():
            assert all(r[c] == r["doc_id"] * 10 for c in extra), name
        assert len(set(out.columns)) == len(out.columns) >= len(df.columns)
    assert outs["leaks"].count() == 5 and outs["shards"].count() == 6
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string").withColumns({c: F.lit(1) for c in CLASHES})
    assert warc.read_records(warc.write_archives(pages)).count() == 1


def _score(text, lexicon):
    return toxicity.Grammar(lexicon).features([text.encode()])[0][0]


def test_quoted_speech():
    words, _ = toxicity._words([b"idiot"])
    lexicon = {int(words.hash[0]): 4.0}
    plain = _score("you are an idiot", lexicon)
    for said in ('he said you are an idiot', 'he said "you are an idiot"', "he said: you are an idiot", "he said, you are an idiot",
                 'he wrote: "It is late. You are an idiot" and left', 'she said (you are an idiot)'):
        assert _score(said, lexicon) < plain, said
    for own in ('he said "good day". you are an idiot', 'he said "good day" - and you, you are an idiot', "he said so. you are an idiot",
                'he left. "you are an idiot"'):
        assert _score(own, lexicon) == pytest.approx(plain), own


def _verdicts(spark, hosts):
    rows = [(h, i < f) for h, (n, f) in hosts.items() for i in range(n)]
    return {r["host"]: r for r in quality.host_verdicts(spark.createDataFrame(rows, "host string, failed boolean")).collect()}


def test_hosts_that_differ_by_chance_are_not_refused(spark):
    rng = random.Random(1)
    single = _verdicts(spark, {f"s{i}": (1, int(rng.random() < 0.3)) for i in range(800)})
    assert not any(r["refused"] for r in single.values())
    few = {f"f{i}": (4, sum(rng.random() < 0.3 for _ in range(4))) for i in range(300)}
    mixed = _verdicts(spark, {**{f"s{i}": (1, int(rng.random() < 0.3)) for i in range(800)}, **few})
    assert sum(r["refused"] for r in mixed.values()) <= 3


def test_bad_hosts_are_refused(spark):
    hosts = {f"good{i}": (50, 2) for i in range(20)} | {"bad": (50, 48), "small bad": (3, 3)}
    got = _verdicts(spark, hosts)
    assert got["bad"]["refused"] and not got["good1"]["refused"]
    assert quality.beta_prior(0, 0, 0, 0, 0)[0] == 0 and quality.beta_prior(3, 9, 0, 0, 27)[0] == 0
    mean, strength = quality.beta_prior(2, 200, 100, 100, 20_000)   # one host all bad, one all good
    assert mean == 0.5 and strength < 0.1


def test_training_rows_keep_every_text(spark):
    docs = _docs(spark, [(i, f"common word {i}") for i in range(60)] + [(100 + i, "common word 1") for i in range(20)])
    labels = docs.select("doc_id", (F.col("doc_id") % 7 == 0).cast("int").alias("toxic"))
    rows = toxicity._training_rows(docs, labels, "doc_id", "text").collect()
    ids = {r["doc_id"] for r in docs.where(~toxicity.held_out(F.col("doc_id"))).collect()}
    texts = {f"common word {i if i < 100 else 1}" for i in ids}
    assert sorted(r["text"] for r in rows) == sorted(texts)
