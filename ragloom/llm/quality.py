"""Quality rules with host verdicts.

Every document gets counts from its whole text and the rules it fails; the
failures are aggregated by host (domain), each host's failure rate is shrunk
towards the corpus rate with a beta prior estimated from all hosts, and hosts
whose shrunk rate is too high are refused whole. The verdict is joined back.

Defined cases: a null or empty text has no words and fails `few words`; null
hosts form one host of their own; repeated rows are judged one by one; extra
columns pass through untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import SPACE_BYTES, Hasher, keep, pieces, release_memory, utf8, windows

SIGNALS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, n_lines long")
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
#: Refused hosts are broadcast up to this many rows; beyond, the join shuffles.
MAX_BROADCAST_HOSTS = 100_000
#: Prior documents where hosts do not differ at all.
STRONGEST = 1e6


@dataclass(frozen=True)
class Rules:
    """Thresholds; each rule compares integers, so results are exact."""
    min_words: int = 20
    max_repeat_percent: int = 30     # words in repeated windows, of words
    max_symbol_percent: int = 30     # symbols, of words
    max_dup_line_percent: int = 60   # repeated lines, of lines with a word
    max_host_rate: float = 0.6       # shrunk share of refused documents of a host


_hasher: list[Hasher] = []


def _repeated_words(h: np.ndarray, width: int) -> int:
    """Words that lie in a window of `width` words found twice or more."""
    w = windows(h, width)
    if len(w) < 2:
        return 0
    order = np.sort(w)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, inverse, count = np.unique(w, return_inverse=True, return_counts=True)
    edge = np.zeros(len(h) + 1, np.int64)
    at = np.flatnonzero(count[inverse] > 1)
    edge[at] += 1
    edge[at + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def text_signals(texts: list[bytes]) -> dict[str, list[int]]:
    """The counts of `SIGNALS` for each UTF-8 text."""
    if not _hasher:
        _hasher.append(Hasher(SPACE_BYTES, lower=False))
    out: dict[str, list[int]] = {k: [] for k in [x.split()[0] for x in SIGNALS.split(", ")]}
    for lo, hi in pieces(texts):
        part = texts[lo:hi]
        words, _ = _hasher[0].words(part)
        for i, t in enumerate(part):
            h = words.hash[words.of(i)]
            lines = [x for x in t.split(b"\n") if x.strip(SPACE_BYTES)]
            out["n_words"].append(len(h))
            out["word_chars"].append(len(t.decode("utf-8")) - sum(map(t.count, (bytes([b]) for b in SPACE_BYTES))))
            out["n_symbols"].append(sum(map(t.count, (bytes([b]) for b in SYMBOLS))))
            out["n_dup_lines"].append(len(lines) - len(set(lines)))
            out["n_repeat_words"].append(_repeated_words(h, REPEAT_WINDOW))
            out["n_lines"].append(len(lines))
    return out


def signals(text: Column) -> Column:
    """Struct column of the counts of the whole text."""
    import pyarrow as pa

    @F.arrow_udf(f"struct<{SIGNALS.replace(' long', ':bigint')}>")
    def count(column):
        found = text_signals(utf8(column))
        release_memory()
        return pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in found.values()], list(found))

    return count(text)


def base_failed(s: Column, rules: Rules = Rules()) -> Column:
    """Fails the base rules: too few words, or too many of them in repeated windows."""
    return ((s["n_words"] < rules.min_words)
            | (100 * s["n_repeat_words"] > rules.max_repeat_percent * s["n_words"]))


def rule_failed(s: Column, rules: Rules = Rules()) -> Column:
    """Fails any rule on the document alone."""
    return (base_failed(s, rules)
            | (100 * s["n_symbols"] > rules.max_symbol_percent * s["n_words"])
            | (100 * s["n_dup_lines"] > rules.max_dup_line_percent * s["n_lines"]))


def host_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def beta_prior(hosts: int, docs: float, failures: float, squares: float, sizes: float) -> tuple[float, float]:
    """Mean and strength (prior documents) of the beta prior, from the number of hosts,
    sum(n), sum(f), sum(f * f / n) and sum(n * n) over hosts with f failures in n documents."""
    if not docs or not 0 < failures < docs:
        return (failures / docs if docs else 0.0), STRONGEST
    mean = failures / docs
    spread = (squares - failures * mean) / (mean * (1 - mean))     # k - 1 is expected by chance
    room = docs - sizes / docs - (hosts - 1)                       # 0 if every host has one document
    alike = (spread - (hosts - 1)) / room if room > 1e-9 else 0.0  # correlation within hosts
    return mean, min(STRONGEST, max(1 / min(alike, 1.0) - 1, 1 / STRONGEST)) if alike > 0 else STRONGEST


def host_verdicts(judged: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per host of `judged` (columns `host`, `failed`): documents,
    failures, shrunk rate, refused. The beta prior is fitted to all hosts by moments:
    of the spread of host rates, what equal hosts of these sizes would show by chance
    is taken off, and the rest tells how unlike hosts are. Hosts that differ no more
    than by chance, as hosts of one document always do, all get the common rate.
    The sums it needs are one row."""
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("docs"),
                                       F.sum(F.col("failed").cast("long")).alias("failures"))
    d = F.col("docs").cast("double")
    m = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum(d).alias("n"), F.sum("failures").cast("double").alias("f"),
                  F.sum(F.col("failures") * F.col("failures") / d).alias("q"), F.sum(d * d).alias("s")).first()
    mean, strength = beta_prior(m["k"], m["n"] or 0.0, m["f"] or 0.0, m["q"] or 0.0, m["s"] or 0.0)
    shrunk = (F.col("failures") + mean * strength) / (F.col("docs") + strength)
    return (hosts.withColumn("shrunk_rate", shrunk)
            .withColumn("refused", F.col("shrunk_rate") > rules.max_host_rate))


def judge(docs: DataFrame, keys: list[str], text_col: str = "text", host_col: str = "source",
          rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict per row of `docs`: `keys`, the counts, `base_failed`,
    `failed` (any rule), `host_refused`, `kept`. Counted once into a narrow
    table in the shared folder; the text itself is never shuffled."""
    s = F.col("_s")
    judged = (docs.select(*[F.col(k) for k in keys], host_of(F.col(host_col)).alias("host"),
                          signals(F.col(text_col)).alias("_s"))
              .select(*keys, "host", "_s.*", base_failed(s, rules).alias("base_failed"),
                      rule_failed(s, rules).alias("failed")))
    judged = keep(judged, "quality")
    bad = host_verdicts(judged, rules).where("refused").select("host", F.lit(True).alias("host_refused"))
    out = judged.join(bad, "host", "left").withColumn("host_refused", F.coalesce("host_refused", F.lit(False)))
    return out.withColumn("kept", ~F.col("failed") & ~F.col("host_refused"))


def filter_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                     rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` that the rules and the host verdicts keep, with all
    columns of `docs` under any names. Rows are counted once, into a table in the shared folder.
    Refused hosts are few as a rule: they are broadcast when counted to be at most
    MAX_BROADCAST_HOSTS, else joined by shuffle."""
    judged = docs.select(F.struct("*").alias("row"), host_of(F.col(host_col)).alias("host"), signals(F.col(text_col)).alias("s"))
    judged = keep(judged.select("row", "host", rule_failed(F.col("s"), rules).alias("failed")), "quality-rows")
    bad = keep(host_verdicts(judged, rules).where("refused").select("host"), "hosts")
    if bad.count() <= MAX_BROADCAST_HOSTS:
        bad = F.broadcast(bad)
    return judged.where("NOT failed").join(bad, "host", "left_anti").select("row.*")
