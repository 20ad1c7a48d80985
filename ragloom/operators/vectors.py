"""Vector operators: V1 user embedder, V2 hashed sparse embedder, V2b IDF
weighting, V3 fit dimension, V4 assert dimension, V5 mean pooling, V6 metrics.

Sparse vectors are long rows `(keys..., dim int, w double)`: one row per
non-zero coordinate. That layout turns similarity search into an equi-join on
`dim` (see `retrieve.knn_sparse`) and keeps every step a JVM expression.
Dense vectors are `array<float>` at rest and `array<double>` in arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Token boundary = any run of characters that are neither
# letters nor digits (Unicode classes); bucket = first 8 hex digits of the
# token's md5, read as an integer, modulo the dimension count.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
DEFAULT_DIMS = 4096
DEFAULT_DENSE_DIM = 768


def tokens(text: Column | str) -> Column:
    """Lower-cased word tokens of a text column, empty strings removed."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(col), TOKEN_SPLIT), lambda t: t != F.lit(""))


def bucket(token: Column, dims: int) -> Column:
    """Stable hash bucket of a token in [0, dims)."""
    h = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(dims)).cast("int")


def hashed_tf(df: DataFrame, keys: Sequence[str], text_col: str, dims: int = DEFAULT_DIMS) -> DataFrame:
    """V2 (counts): `(keys..., dim, tf)` — token counts per hash bucket.

    The aggregation is on `keys + [dim]`; when `df` is already hash-partitioned
    on a prefix of `keys` (see `embed_corpus`) Spark needs no exchange here.
    """
    keys = list(keys)
    # explode the raw split and drop the empty edge tokens as a row filter:
    # both stay inside whole-stage codegen (no per-array lambda)
    exploded = (df.select(*keys, F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)).alias("__tok"))
                  .filter(F.col("__tok") != ""))
    return (exploded.select(*keys, bucket(F.col("__tok"), dims).alias("dim"))
                    .groupBy(*keys, "dim").agg(F.count(F.lit(1)).cast("double").alias("tf")))


def token_bags(df: DataFrame, keys: Sequence[str], text_col: str, dims: int = DEFAULT_DIMS) -> DataFrame:
    """V2 (one row per text): `(keys..., __d array<int>, __w null)` — the hash bucket
    of every token, repeats kept, made where the text lies (no exchange). The JVM
    cuts the tokens; each different token of an Arrow batch is hashed once."""
    @F.arrow_udf("array<int>")
    def buckets(tokens):
        import hashlib

        import numpy as np
        import pyarrow as pa
        words = tokens.flatten().dictionary_encode()
        named = words.dictionary.to_pylist()
        number = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dims if w else -1 for w in named], np.int32)
        flat = number[np.asarray(words.indices)] if named else np.empty(0, np.int32)
        ends = np.r_[0, np.cumsum(np.asarray(tokens.value_lengths().fill_null(0)))]
        kept = np.r_[0, np.cumsum(flat >= 0)]
        return pa.ListArray.from_arrays(pa.array(kept[ends], pa.int32()), pa.array(flat[flat >= 0], pa.int32()))

    return df.select(*keys, buckets(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)).alias("__d"), F.lit(None).cast("array<double>").alias("__w"))


def term_counts(df: DataFrame, keys: Sequence[str], text_col: str, dims: int = DEFAULT_DIMS, carry: Sequence[str] = ()) -> DataFrame:
    """V2 as two aligned arrays per row, `(keys..., carry..., dims, tfs)` in the order of `dims`: the
    counts of `hashed_tf` without a row per term or a shuffle."""
    @F.arrow_udf("array<struct<dim:int,tf:double>>")
    def counted(bags):
        import numpy as np
        import pyarrow as pa
        row = np.repeat(np.arange(len(bags)), np.asarray(bags.value_lengths().fill_null(0)))
        cell, n = np.unique(row * dims + np.asarray(bags.flatten()).astype(np.int64), return_counts=True)
        ends = np.r_[0, np.cumsum(np.bincount(cell // dims, minlength=len(bags)))]
        pairs = pa.StructArray.from_arrays([pa.array(cell % dims, pa.int32()), pa.array(n, pa.float64())], ["dim", "tf"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    bags = token_bags(df, [*keys, *carry], text_col, dims)
    return bags.select(*keys, *carry, counted("__d").alias("__p")).select(
        *keys, *carry, F.transform("__p", lambda x: x["dim"]).alias("dims"), F.transform("__p", lambda x: x["tf"]).alias("tfs"))


def l2_normalize(rows: DataFrame, keys: Sequence[str], w_col: str = "w") -> DataFrame:
    """Divide each coordinate by the vector's L2 norm; zero vectors are dropped."""
    keys = list(keys)
    norm = F.sqrt(F.sum(F.col(w_col) * F.col(w_col)).over(Window.partitionBy(*keys)))
    return (rows.withColumn("__norm", norm)
                .filter(F.col("__norm") > 0)
                .withColumn(w_col, F.col(w_col) / F.col("__norm"))
                .drop("__norm"))


def embed_hashed(df: DataFrame, keys: Sequence[str], text_col: str, dims: int = DEFAULT_DIMS) -> DataFrame:
    """V2: L2-normalised hashed term counts, sparse rows `(keys..., dim, w)`."""
    tf = hashed_tf(df, keys, text_col, dims).withColumnRenamed("tf", "w")
    return l2_normalize(tf, keys)


def idf_table(tf: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`(dim, idf)` with idf = ln(N / df) over the corpus tf rows.

    At most `dims` rows, so it is broadcast back to the postings by design
    (its size is bounded by a parameter, not by the data). `N` is a scalar
    subquery over the same rows. Dimensions present in every vector get
    idf = 0 and are dropped: they contribute exactly nothing to any score.
    """
    keys = list(keys)
    n_vectors = tf.select(*keys).distinct().select(F.count(F.lit(1)).cast("double")).scalar()
    per_dim = tf.groupBy("dim").agg(F.count(F.lit(1)).cast("double").alias("df"))
    return (per_dim.select("dim", F.log(n_vectors / F.col("df")).alias("idf"))
                   .filter(F.col("idf") > 0))


def apply_idf(tf: DataFrame, idf: DataFrame, keys: Sequence[str], normalize: bool = True) -> DataFrame:
    """Weight tf rows by idf and (by default) L2-normalise: `(keys..., dim, w)`."""
    weighted = (tf.join(F.broadcast(idf), "dim")
                  .select(*keys, "dim", (F.col("tf") * F.col("idf")).alias("w")))
    return l2_normalize(weighted, keys) if normalize else weighted


def embed_corpus(chunks: DataFrame, keys: Sequence[str], text_col: str, dims: int = DEFAULT_DIMS,
                 weighting: str = "tfidf", normalize: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Embed a chunk table. Returns (vectors, idf table or None).

    `weighting` is "tf" (plain V2) or "tfidf" (V2 + V2b). With
    `normalize=False` the weights are left unscaled, for consumers that
    normalise per vector themselves (the block search does it inside the
    aggregation it needs anyway, which saves a sort of every posting).
    """
    tf = hashed_tf(chunks, keys, text_col, dims)
    if weighting == "tf":
        raw = tf.withColumnRenamed("tf", "w")
        return (l2_normalize(raw, keys) if normalize else raw), None
    # The term counts feed two consumers (the global IDF table and the
    # weighted vectors): keep them so the corpus is tokenised once. Lost
    # blocks are recomputed from lineage; spills go to local disk.
    tf = tf.persist(StorageLevel.MEMORY_AND_DISK)
    tf.count()                      # fill the cache once, in parallel, before both readers
    idf = materialize_small(idf_table(tf, keys), dims)
    return apply_idf(tf, idf, keys, normalize), idf


def materialize_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Compute a table that is bounded by a parameter (here: at most `dims`
    rows) once and keep it as a local relation, so every later consumer (the
    corpus weights, each batch of questions) reuses it instead of re-running
    its aggregation."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)


def embed_queries(queries: DataFrame, keys: Sequence[str], text_col: str, dims: int = DEFAULT_DIMS,
                  idf: DataFrame | None = None) -> DataFrame:
    """Embed questions with the corpus's weighting (same function for both sides)."""
    tf = hashed_tf(queries, keys, text_col, dims)
    if idf is None:
        return l2_normalize(tf.withColumnRenamed("tf", "w"), keys)
    return apply_idf(tf, idf, keys)


# ---------------------------------------------------------------------------
# Dense vectors
# ---------------------------------------------------------------------------

def fit_dimension(vec: Column | str, n: int = DEFAULT_DENSE_DIM) -> Column:
    """V3: truncate or zero-pad a float array to exactly `n` entries."""
    v = F.col(vec) if isinstance(vec, str) else vec
    pad = F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(n) - F.size(v), F.lit(0)))
    return F.concat(F.slice(v, 1, n), pad)


def assert_dimension(df: DataFrame, vec_col: str, n: int) -> DataFrame:
    """V4: fail the job on the first vector whose length is not `n`."""
    check = F.when(F.coalesce(F.size(vec_col), F.lit(-1)) != n,
                   F.raise_error(F.concat(F.lit(f"vector dimension mismatch: expected {n}, got "),
                                          F.size(vec_col).cast("string"))))
    return df.withColumn("__dimcheck", check).filter(F.col("__dimcheck").isNull()).drop("__dimcheck")


def mean_pool(df: DataFrame, key: str | Sequence[str], vec_col: str = "embedding",
              out_col: str = "embedding") -> DataFrame:
    """V5: element-wise mean of the vectors of each group, as `array<double>`.

    Spark ML's vector summarizer keeps one partial mean per group and task, so no
    vector becomes rows, and a group that holds a third of all rows is combined
    map-side. Vectors of a group have one length (V4); null ones count for nothing.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.where(F.col(vec_col).isNotNull()).select(*keys, array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    return rows.groupBy(*keys).agg(Summarizer.mean(F.col("__v")).alias("__m")).select(*keys, vector_to_array("__m").alias(out_col))


def dot(a: Column | str, b: Column | str) -> Column:
    """V6: inner product in double precision."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """V6: cosine similarity (null when either vector is zero)."""
    d = norm(a) * norm(b)
    return F.when(d > 0, dot(a, b) / d)


def l2_squared(a: Column | str, b: Column | str) -> Column:
    """V6: squared Euclidean distance, the reference store's default metric."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    diffs = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)


# ---------------------------------------------------------------------------
# V1: user-supplied embedder
# ---------------------------------------------------------------------------

def embed_with(df: DataFrame, text_col: str, fn: Callable[[list[str]], list[list[float]]],
               out_col: str = "embedding", dim: int | None = None) -> DataFrame:
    """V1: apply a batch embedding function `fn(list[str]) -> list[list[float]]`.

    Runs as an Arrow-batched pandas UDF: `fn` is called once per Arrow batch
    (not per row), inside the Python worker, so a model loaded at module level
    or behind a cache is loaded once per worker. With `dim` set, vectors are
    fitted to that dimension (V3) JVM-side afterwards.
    """
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(texts: pd.Series) -> pd.Series:
        vals = texts.fillna("").tolist()
        return pd.Series([list(map(float, v)) for v in fn(vals)])

    out = df.withColumn(out_col, _embed(F.col(text_col)))
    if dim is not None:
        out = out.withColumn(out_col, fit_dimension(out_col, dim))
    return out
