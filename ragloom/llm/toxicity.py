"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer maps words to symbols: insults (with a weight), threats,
targets (who is addressed), negations, reporting verbs. Further transducers
rewrite the symbol string of one clause: negation weakens the insults that
follow it closely, reported speech weakens what is quoted, a target in the
clause strengthens it. The cascade scores whole clauses; a logistic link over
clause scores gives the document's score.

The insult lexicon and the link are learned from labelled rows: log-odds of
words and word beginnings, counted in Spark over at most MAX_TRAIN documents
(each different text once; near copies in one fold), with two-fold
cross-fitting for the link. Labels,
language, source and id are never inputs of a score.

Defined cases: null or empty texts have no clause and get the score of the
intercept; texts of any length are read whole; repeated rows are scored one by
one; without labelled rows of both kinds every document gets the share of
toxic training rows (0 without any); extra columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import NON_ALNUM_BYTES, Hasher, mix, pieces, utf8

#: Bounds of the fitted model (a bounded sample of labelled rows, a bounded lexicon).
MAX_TRAIN = 10_000
MAX_LEXICON = 4_096
#: Beginnings of words, in bytes, that may become lexicon entries.
STEMS = (4, 5)
#: Least lower bound of the log-odds of a lexicon entry, and least documents.
MIN_LOG_ODDS, MIN_DOCS = 1.8, 3

# Fixed closed-class words of the grammar.
THREATS = "kill hurt destroy shoot stab burn beat attack murder die töten umbringen tuer matar".split()
TARGETS = "you your yours u he she they them him people everyone du dich ihr euch tu toi vous tú usted ustedes".split()
NEGATIONS = "not no never none neither nor without nicht kein keine nie pas jamais nunca jamás".split()
REPORTS = "said says say wrote writes called calls claimed reported quoted quote according sagte dit dijo".split()

CLAUSE_END = np.zeros(256, bool)
CLAUSE_END[list(b".!?;:,\n\r\"()")] = True
#: Of these, those after which nobody is being quoted any more (but in a quotation that is still open).
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[list(b".!?;\n\r")] = True

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
THREAT_WEIGHT = 0.5        # of the weakest insult: threats matter with a target
NEGATION_REACH = 3         # words a negation reaches
NEGATED, REPORTED, TARGETED = 0.3, 0.5, 1.25


@dataclass
class Transducer:
    """Deterministic weighted transducer: arcs (state, symbol) -> (state, factor);
    a symbol without an arc goes to `default[state]` with factor 1. A symbol's
    weight is multiplied by the factor of the arc that reads it."""
    arcs: dict[tuple[int, int], tuple[int, float]]
    default: dict[int, int] = field(default_factory=dict)

    def run(self, symbols: list[int], weights: list[float], state: int = 0) -> list[float]:
        out = []
        for symbol, weight in zip(symbols, weights, strict=True):
            state, factor = self.arcs.get((state, symbol), (self.default.get(state, state), 1.0))
            out.append(weight * factor)
        return out


def _negation() -> Transducer:
    """State s > 0: a negation reaches s more words."""
    arcs = {(s, NEGATION): (NEGATION_REACH, 1.0) for s in range(NEGATION_REACH + 1)}
    for s in range(1, NEGATION_REACH + 1):
        arcs |= {(s, INSULT): (s - 1, NEGATED), (s, THREAT): (s - 1, NEGATED)}
    return Transducer(arcs, {s: max(0, s - 1) for s in range(NEGATION_REACH + 1)})


#: After a reporting verb the rest is someone else's speech; `Speech` tells where it ends.
_REPORT = Transducer({(0, REPORT): (1, 1.0), (1, INSULT): (1, REPORTED), (1, THREAT): (1, REPORTED)})
#: After a target, insults and threats of the clause count more; read in both directions.
_TARGET = Transducer({(0, TARGET): (1, 1.0), (1, INSULT): (1, TARGETED), (1, THREAT): (1, TARGETED)})
_NEGATION = _negation()


def clause_score(symbols: list[int], weights: list[float], reported: bool = False) -> float:
    """The cascade over one clause: negation, reported speech (`reported`: it goes
    on from an earlier clause), target."""
    w = _REPORT.run(symbols, _NEGATION.run(symbols, weights), int(reported))
    ahead = _TARGET.run(symbols, w)
    back = _TARGET.run(symbols[::-1], w[::-1])[::-1]
    return sum(map(max, ahead, back))


class Speech:
    """How far reported speech reaches beyond the clause of its verb: over commas,
    colons and brackets to the end of the sentence, and from a quotation mark that
    opens after the verb to the one that closes it, whatever sentences lie between."""

    def __init__(self, data: np.ndarray):
        self.sentence = np.flatnonzero(SENTENCE_END[data])
        self.mark = np.flatnonzero(data == 0x22)
        self.verb = -1  # byte after the last reporting verb

    def reaches(self, place: int) -> bool:
        if self.verb < 0:
            return False
        marks = int(np.searchsorted(self.mark, place) - np.searchsorted(self.mark, self.verb))
        stop = int(np.searchsorted(self.sentence, self.verb))
        ended = stop < len(self.sentence) and self.sentence[stop] < place
        opened = marks and not (ended and self.sentence[stop] < self.mark[np.searchsorted(self.mark, self.verb)])
        return marks == 1 if opened else not ended


_hasher: list[Hasher] = []


def _words(texts: list[bytes]):
    if not _hasher:
        _hasher.append(Hasher(NON_ALNUM_BYTES, lower=True))
    return _hasher[0].words(texts, STEMS)


def _closed_class() -> dict[int, int]:
    out = {}
    for symbol, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
        found, _ = _words([w.encode() for w in words])
        out |= {int(h): symbol for h in found.hash}
    return out


class Grammar:
    """The lexical transducer (entries: hash of a word or beginning -> weight)
    with the clause cascade."""

    def __init__(self, lexicon: dict[int, float]):
        closed = _closed_class()
        floor = min(lexicon.values(), default=MIN_LOG_ODDS)
        table = {h: (s, THREAT_WEIGHT * floor if s == THREAT else 0.0) for h, s in closed.items()}
        table |= {h: (INSULT, w) for h, w in lexicon.items() if h not in closed}
        self.keys = np.array(sorted(table), np.uint64)
        self.symbols = [table[int(k)][0] for k in self.keys]
        self.weights = [table[int(k)][1] for k in self.keys]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes in the lexicon, and the entries there."""
        at = np.flatnonzero(self.seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        good = self.keys[k] == h[at]
        return at[good], k[good]

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Per text: greatest clause score, their sum, matched clauses, and the
        sum against the length (all on a log scale)."""
        out = np.zeros((len(texts), 4))
        for lo, hi in pieces(texts):
            words, stems = _words(texts[lo:hi])
            entry: dict[int, int] = {}
            for h in [*(stems[p] for p in STEMS), words.hash]:  # a whole word outranks its beginning
                entry.update(zip(*map(np.ndarray.tolist, self._lookup(h)), strict=True))
            if not entry:
                continue
            place = np.array(sorted(entry), np.int64)
            symbol = np.array([self.symbols[entry[i]] for i in place.tolist()])
            weight = np.array([self.weights[entry[i]] for i in place.tolist()])
            ends = np.flatnonzero(CLAUSE_END[words.data])
            clause = np.searchsorted(ends, words.start[place])
            doc = np.searchsorted(words.first_word, place, "right") - 1
            clause = clause + doc  # a clause never spans two texts
            cut = np.flatnonzero(np.diff(clause, prepend=-1, append=-1) != 0)
            speech, of = Speech(words.data), -1
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                if doc[a] != of:
                    speech.verb, of = -1, doc[a]
                reported = speech.reaches(int(words.start[place[a]]))
                verbs = np.flatnonzero(symbol[a:b] == REPORT)
                if len(verbs):
                    speech.verb = int(words.end[place[a + verbs[-1]]])
                if weight[a:b].max() <= 0:
                    continue
                symbols, weights, last = [], [], place[a] - 1
                for i in range(a, b):
                    gap = int(place[i] - last - 1)
                    symbols += [OTHER] * min(gap, NEGATION_REACH) + [int(symbol[i])]
                    weights += [0.0] * min(gap, NEGATION_REACH) + [float(weight[i])]
                    last = place[i]
                s = clause_score(symbols, weights, reported)
                row = out[lo + int(doc[a])]
                row[0] = max(row[0], s)
                row[1] += s
                row[2] += 1
            n = np.diff(words.first_word)
            out[lo:hi, 3] = out[lo:hi, 1] / np.sqrt(np.maximum(n, 1))
        return np.log1p(out)


@dataclass
class Model:
    lexicon: dict[int, float]
    coef: np.ndarray

    def scores(self, grammar: Grammar, texts: list[bytes]) -> np.ndarray:
        z = grammar.features(texts) @ self.coef[1:] + self.coef[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps of a ridge logistic fit on the bounded training features."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _group(words, i: int) -> int:
    """Near copies mostly share the least word hash: all rows of such a group are in one fold."""
    h = words.hash[words.of(i)]
    return int(mix(h).min().astype(np.int64)) if len(h) else 0


def _training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """At most MAX_TRAIN labelled rows that are not held out, each different text
    once: text, toxic, fold. The label side is bounded, so it is broadcast."""
    import pyarrow as pa
    picked = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(MAX_TRAIN))
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), F.col("_doc") == F.col("_id")).select("text", F.col("_toxic").alias("toxic"))
    rows = rows.groupBy("text").agg(F.max("toxic").alias("toxic"))

    def group(batches):
        for b in batches:
            texts = utf8(b.column(0))
            keys = []
            for lo, hi in pieces(texts):
                words, _ = _words(texts[lo:hi])
                keys += [_group(words, i) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.int64())], ["text", "toxic", "grp"])

    grouped = rows.mapInArrow(group, "text string, toxic int, grp long")
    return grouped.select("text", "toxic", (F.pmod(F.xxhash64("grp"), F.lit(2))).cast("int").alias("fold"))


def _counts(rows: DataFrame) -> DataFrame:
    """(feature, fold, toxic, n): documents with each word or beginning."""
    import pyarrow as pa

    def count(batches):
        for b in batches:
            texts, toxic, fold = utf8(b.column(0)), b.column(1).to_pylist(), b.column(2).to_pylist()
            parts: dict[tuple[int, int], list] = {(f, t): [] for f in (0, 1) for t in (0, 1)}
            for lo, hi in pieces(texts):
                words, stems = _words(texts[lo:hi])
                for i in range(hi - lo):
                    at = words.of(i)
                    parts[fold[lo + i], int(toxic[lo + i] > 0)].append(
                        np.unique(np.concatenate([words.hash[at], *(stems[p][at] for p in STEMS)])))
            for (f, t), found in parts.items():
                if found:
                    u, n = np.unique(np.concatenate(found), return_counts=True)
                    u, n = u[u != 0], n[u != 0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(u.view(np.int64)), pa.array(np.full(len(u), f, np.int32)),
                         pa.array(np.full(len(u), t, np.int32)), pa.array(n.astype(np.int64))],
                        ["feature", "fold", "toxic", "n"])

    return rows.mapInArrow(count, "feature long, fold int, toxic int, n long")


def _lexicon(table: DataFrame, sizes: dict[tuple[int, int], int], folds: tuple[int, ...]) -> dict[int, float]:
    """The strongest entries by the lower bound of their log-odds."""
    n1, n0 = (sum(v for (f, t), v in sizes.items() if t == k and f in folds) for k in (1, 0))
    if not n1 or not n0:
        return {}
    a = sum(F.col(f"t{f}") for f in folds)
    b = sum(F.col(f"c{f}") for f in folds)
    odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    low = odds - 1.28 * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    rows = (table.where(a >= MIN_DOCS).select("feature", low.alias("w")).where(F.col("w") >= MIN_LOG_ODDS)
            .orderBy(F.desc("w"), "feature").limit(MAX_LEXICON).collect())
    return {r["feature"] % (1 << 64): r["w"] for r in rows}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn lexicon and link from labelled rows that are not held out."""
    from ragloom.llm.common import keep
    rows = keep(_training_rows(docs, labels, id_col, text_col), "toxic-train")
    sizes = {(r["fold"], int(r["toxic"] > 0)): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    n1, n = sum(v for (_, t), v in sizes.items() if t), sum(sizes.values())
    if not n1 or n1 == n:
        share = min(max(n1 / n, 1e-6), 1 - 1e-6) if n else 1e-6
        return Model({}, np.array([np.log(share / (1 - share)), 0, 0, 0, 0]))
    table = keep(_counts(rows).groupBy("feature").agg(*[
        F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"{'ct'[t]}{f}")
        for f in (0, 1) for t in (0, 1)]).where(f"t0 + t1 >= {MIN_DOCS}"), "toxic-counts")
    other = [Grammar(_lexicon(table, sizes, (1 - f,))) for f in (0, 1)]  # for the rows of fold f

    @F.arrow_udf("array<double>")
    def cross(text, fold):
        import pyarrow as pa
        f, texts = fold.to_pylist(), utf8(text)
        both = [g.features(texts) for g in other]
        return pa.array([both[k][i].tolist() for i, k in enumerate(f)], pa.list_(pa.float64()))

    got = rows.select(cross("text", "fold").alias("x"), "toxic").collect()
    x, y = np.array([r["x"] for r in got]), np.array([float(r["toxic"] > 0) for r in got])
    return Model(_lexicon(table, sizes, (0, 1)), _logistic(x, y))


def score(model: Model, text: Column) -> Column:
    """Score column (0 to 1) of whole texts; a map-only Arrow function."""
    cache: list[Grammar] = []

    @F.arrow_udf("double")
    def scores(column):
        import pyarrow as pa
        if not cache:
            cache.append(Grammar(model.lexicon))
        return pa.array(model.scores(cache[0], utf8(column)), pa.float64())

    return scores(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `score`, `predicted` and `held_out` added (replacing columns of these names)."""
    model = fit(docs, labels, id_col, text_col)
    return (docs.withColumn("score", score(model, F.col(text_col)))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .withColumn("held_out", F.coalesce(held_out(F.col(id_col)), F.lit(False))))
