"""Native word scan shared by the phrase operators: lower-case A-Z, cut words,
and join the places of anchor words, all with DataFrame functions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Anchor tables are broadcast up to this many rows (some tens of MB); beyond, the scan is joined by shuffle.
MAX_BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    """Array of the words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased (A-Z) text; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, SEPARATORS), "")


def tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, doc_id, words, pos, word): a row per word place, and for every row
    of `docs` one more with an empty word at pos = number of words."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                       words_of(F.col(text_col)).alias("words"))
    return rows.select("rid", "doc_id", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "word"))


def corpus_counts(docs: DataFrame, text_col: str, vocabulary: DataFrame, small: bool) -> DataFrame:
    """(word, n): how often each word of `vocabulary` occurs in all documents."""
    found = docs.select(F.explode(words_of(F.col(text_col))).alias("word")).join(
        F.broadcast(vocabulary) if small else vocabulary, "word", "left_semi")
    return vocabulary.join(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word", "left").select(
        "word", F.coalesce("n", F.lit(0)).alias("n"))
