"""Passages contained in documents, against a plain search."""

from __future__ import annotations

import random

from ragloom.plans import rag


def test_contained_pairs(spark):
    rng = random.Random(2)
    words = ["red", "fox", "sea", "x1", "É́t", "日本", "a", "b"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "Red, FOX! sea-side"), (102, "Red, FOX! sea-side")]
    items = []
    for i in range(80):
        t = rng.choice(docs[:60])[1]
        a = rng.randint(0, len(t))
        items.append((i, t[a:a + rng.randint(0, 30)]))
    items += [(200, "absent words that never occur here"), (201, ""), (202, None), (203, "ed, FO"), (204, "  "), (205, "d"), (206, "fox" * 3)]
    got = rag.contained_pairs(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    want = {(i, d) for i, p in items if p for d, t in docs if t and p in t}
    pairs = [tuple(r) for r in got.select("item_id", "doc_id").collect()]
    assert set(pairs) == want and len(pairs) == len(want)


def test_documents_are_cut_into_grams_once(spark):
    docs = spark.createDataFrame([(1, "a red fox by the sea"), (2, "the sea")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "red fox by"), (8, "the sea")], "item_id long, text string")
    got = rag.contained_pairs(items, docs)
    assert sorted(map(tuple, got.collect())) == [(7, 1), (8, 1), (8, 2)]
    assert got._jdf.queryExecution().withCachedData().toString().count("InMemoryRelation") >= 2  # counted and searched
