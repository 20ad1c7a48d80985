"""Benchmark decontamination: exact containment of item-sized windows.

Every benchmark item gives its windows of `WINDOW` consecutive words (an item
of fewer words is one window). A window must be contained whole, so its
necessary prefix in rarity order is its rarest word: corpus counts order the
words of each window, windows with a word that no document has are dropped,
and each remaining window is posted under its rarest word only. The document
scan joins word places with these postings; length and position bounds cut
windows that would stick out of the text, and the words of the place are
compared one by one. Only DataFrame functions run.

Defined cases: a null text has no words; items with a null id or no word are
ignored, items with equal windows all count; each row of `docs` gives one row
(repeated doc_ids are judged row by row); extra columns are ignored; empty
tables give no rows, an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import keep
from ragloom.llm.wordscan import MAX_BROADCAST_ROWS, corpus_counts, tokens, words_of

WINDOW = 10


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """(seq, items): each distinct window (array of words) with the ids of its items."""
    w = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    cut = w.where(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("at"))
    return (cut.select(F.expr(f"slice(w, at, {width})").alias("seq"), "item_id")
            .groupBy("seq").agg(F.collect_set("item_id").alias("items")))


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(word, off, len, seq, items): each window under its rarest word."""
    places = windows.select("seq", "items", F.posexplode("seq").alias("off", "word")).join(counts, "word")
    rarest = places.groupBy("seq").agg(
        F.min(F.struct("n", "word", "off")).alias("least"), F.first("items").alias("items"))
    return rarest.where("least.n > 0").select(
        F.col("least.word").alias("word"), F.col("least.off").alias("off"), F.size("seq").alias("len"), "seq", "items")


def _hits(docs: DataFrame, posts: DataFrame, small: bool, id_col: str, text_col: str) -> DataFrame:
    """(rid, doc_id, n, start, len, items): matched places, and for every row
    of `docs` one with its number of words."""
    scan = tokens(docs, id_col, text_col)
    end = F.col("pos") - F.col("off") + F.col("len")
    fits = (F.col("pos") >= F.col("off")) & (end <= F.size("words"))
    same = F.expr("slice(words, pos - off + 1, len)") == F.col("seq")
    start = (F.col("pos") - F.col("off")).alias("start")
    if small:
        marker = posts.limit(0).union(posts.sparkSession.range(1).select(
            F.lit("").alias("word"), F.lit(0).alias("off"), F.lit(0).alias("len"),
            F.lit(None).cast("array<string>").alias("seq"), F.lit(None).cast(posts.schema["items"].dataType).alias("items")))
        both = scan.join(F.broadcast(posts.union(marker)), "word")
        end_row = F.col("word") == ""
        return both.where(end_row | (fits & same)).select(
            "rid", "doc_id", F.when(end_row, F.col("pos")).alias("n"), start, "len", "items")
    # the postings outgrow a broadcast: places meet windows by their whole text
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                       words_of(F.col(text_col)).alias("words"))
    lengths = [r["len"] for r in posts.select("len").distinct().collect()]  # at most WINDOW values
    parts = [rows.where(F.size("words") >= k).select(
        "rid", "doc_id", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("start"), "words")
        .select("rid", "doc_id", "start", F.lit(k).alias("len"),
                F.array_join(F.expr(f"slice(words, start + 1, {k})"), " ").alias("key")) for k in sorted(lengths)]
    out = rows.select("rid", "doc_id", F.size("words").alias("n"), F.lit(0).alias("start"), F.lit(0).alias("len"),
                      F.lit(None).cast(posts.schema["items"].dataType).alias("items"))
    keyed = posts.select(F.array_join("seq", " ").alias("key"), "items")
    for p in parts:
        out = out.union(p.join(keyed, "key").select("rid", "doc_id", F.lit(None).cast("int"), "start", "len", "items"))
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", width: int = WINDOW,
                  max_broadcast: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit (words inside any
    occurrence of a window), items (sorted ids, as strings), n_items,
    contaminated."""
    windows = keep(item_windows(items, item_col, item_text, width), "windows")
    small = windows.count() <= max_broadcast
    vocabulary = windows.select(F.explode("seq").alias("word")).distinct()
    posts = keep(anchors(windows, corpus_counts(docs, text_col, vocabulary, small)), "anchors")
    hits = _hits(docs, posts, small, id_col, text_col)
    found = hits.groupBy("rid", "doc_id").agg(
        F.max("n").cast("long").alias("n_words"),
        F.collect_set(F.when(F.col("len") > 0, F.struct("start", "len"))).alias("places"),
        F.collect_set("items").alias("items"))
    covered = F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p["start"], p["start"] + p["len"] - 1))))
    names = F.array_sort(F.transform(F.array_distinct(F.flatten("items")), lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", F.size(covered).cast("long").alias("n_hit"), names.alias("items")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` without a benchmark window, with all columns. A
    doc_id that repeats goes if any of its rows is contaminated; rows without
    a doc_id stay."""
    bad = contamination(docs, items).where("contaminated").select("doc_id").distinct()
    whole = docs.select(F.struct("*").alias("row"), "doc_id")
    return whole.join(bad, "doc_id", "left_anti").select("row.*")
