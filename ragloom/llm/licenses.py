"""License scans: fixed phrases, and an exact set-similarity join with
templates.

Templates are short public license notices as word sets. Their words are
ordered by corpus frequency, rarest first; a block that holds at least
THRESHOLD of a template's words holds one of its first |T| - t + 1 words, so
only these prefix words are posted and joined with the word places of the
documents. Each place names the blocks of the text it lies in (overlapping
runs of three template lengths, so every passage of up to two lengths is
whole in one); length and position bounds cut blocks that cannot reach t, and
the containment of the rest is counted exactly. Only DataFrame functions run.

Defined cases: a null or empty text has no words and no label; each row of
`docs` gives one row, repeated doc_ids too; extra columns are ignored; empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import keep
from ragloom.llm.wordscan import corpus_counts, tokens, words_of

THRESHOLD = 0.9
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
# Public notices that the licenses ask to be put into files (fixed values).
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def _table(spark, rows: list[tuple[str, str]]) -> DataFrame:
    """(label, seq): a bounded table of texts as word arrays, built by SQL."""
    texts = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(text).alias("text")) for label, text in rows])).alias("t"))
    return texts.select("t.label", words_of(F.col("t.text")).alias("seq"))


def anchor_table(docs: DataFrame, text_col: str, phrases, templates, threshold: float) -> DataFrame:
    """(word, label, off, seq, need): phrases (need = 0, `off` the place of the
    posted word) and templates (need = words a block must hold, `off` the rank
    of the posted word among its words, rarest first)."""
    spark = docs.sparkSession
    seqs = _table(spark, phrases).withColumn("exact", F.lit(True))
    if templates:
        seqs = seqs.union(_table(spark, templates).select("label", F.array_distinct("seq"), F.lit(False)))
    seqs = seqs.withColumn("id", F.monotonically_increasing_id())
    vocabulary = seqs.select(F.explode("seq").alias("word")).distinct()
    counts = corpus_counts(docs, text_col, vocabulary, small=True)
    need = F.ceil(F.size("seq") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    ranked = (seqs.select("*", F.posexplode("seq").alias("place", "word")).join(counts, "word")
              .groupBy("id", "label", "seq", "exact")
              .agg(F.sort_array(F.collect_list(F.struct("n", "word", "place"))).alias("order"))
              .withColumn("need", F.when(F.col("exact"), F.lit(0)).otherwise(need)))
    prefix = F.when(F.col("exact"), F.lit(1)).otherwise(F.size("seq") - F.col("need") + 1)
    return ranked.select("label", "seq", "need", F.posexplode(F.slice("order", F.lit(1), prefix)).alias("rank", "o")).select(
        F.col("o.word").alias("word"), "label", F.when(F.col("need") == 0, F.col("o.place")).otherwise(F.col("rank")).alias("off"),
        "seq", "need")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=tuple(PHRASES),
         templates=tuple(TEMPLATES), threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score (1 with a phrase, else the greatest
    containment at or above the threshold, else 0), blocks (label, first word
    and containment of every matching block)."""
    posts = keep(anchor_table(docs, text_col, list(phrases), list(templates), threshold), "licenses")
    marker = docs.sparkSession.range(1).select(
        F.lit("").alias("word"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("off"),
        F.lit(None).cast("array<string>").alias("seq"), F.lit(-1).alias("need"))
    places = tokens(docs, id_col, text_col).join(F.broadcast(posts.union(marker)), "word")
    exact = (F.col("pos") >= F.col("off")) & (
        F.expr("slice(words, pos - off + 1, size(seq))") == F.col("seq"))
    last = F.floor(F.col("pos") / F.size("seq")).cast("int")
    at = F.when(F.col("need") > 0, F.sequence(F.greatest(last - 2, F.lit(0)), last))
    cand = places.where((F.col("need") < 0) | (F.col("need") > 0) | exact).select(
        "rid", "doc_id", "words", "label", "need", "seq", F.col("pos"), F.col("off"), F.explode_outer(at).alias("block"))
    block = F.expr("slice(words, block * size(seq) + 1, 3 * size(seq))")
    # length bound: the block has `need` words at all; position bound: the posted
    # word's rank leaves `need` words of the template
    cand = cand.where((F.col("need") <= 0) | (
        (F.size(block) >= F.col("need")) & (F.size("seq") - F.col("off") >= F.col("need"))))
    share = F.when(F.col("need") > 0, F.size(F.array_intersect(block, "seq")))
    cand = cand.withColumn("both", share).where((F.col("need") <= 0) | (F.col("both") >= F.col("need")))
    rows = cand.select(
        "rid", "doc_id", F.when(F.col("need") < 0, F.col("pos")).alias("n"), F.when(F.col("need") == 0, F.col("label")).alias("base"),
        F.when(F.col("need") == 0, F.col("pos") - F.col("off")).alias("start"),
        F.when(F.col("need") > 0, F.struct("label", (F.col("block") * F.size("seq")).alias("first"),
                                           (F.col("both") / F.size("seq")).alias("share"))).alias("hit"))
    found = rows.groupBy("rid", "doc_id").agg(
        F.max("n").cast("long").alias("n_words"), F.count("start").alias("n_base"),
        F.min("start").cast("long").alias("first_word"), F.max("start").cast("long").alias("last_word"),
        F.array_sort(F.collect_set("base")).alias("base"), F.array_sort(F.collect_set("hit")).alias("blocks"))
    named = F.array_sort(F.array_distinct(F.concat("base", F.transform("blocks", lambda b: b["label"]))))
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["share"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(named, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"), "blocks")
