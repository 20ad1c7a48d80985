"""K2 / K4: user-supplied models over a column, batched through Arrow. Models
live outside this library: a registered factory makes one in each Python worker,
which then serves every batch and every task that the worker gets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EMBEDDERS: dict[str, Callable[[], Callable]] = {}
_GENERATORS: dict[str, Callable[[], Callable]] = {}
#: Models that this worker process has made, by their factory.
_made: dict[bytes, Callable] = {}
#: Words whose place the stand-in model remembers.
REMEMBERED_WORDS = 200_000


def register_embedder(name: str, factory: Callable[[], Callable[[list[str]], list[list[float]]]]) -> None:
    """K2: an embedding model by name. `factory` makes the model, `texts -> vectors`; it
    runs in the workers, once in each, however many batches and tasks it serves."""
    _EMBEDDERS[name] = factory


def register_generator(name: str, factory: Callable[[], Callable[[list[str], dict], list[str]]]) -> None:
    """K4: a text model by name. `factory` makes it, `(prompts, options) -> replies`."""
    _GENERATORS[name] = factory


def _known(models: dict, name: str) -> Callable:
    if name not in models:
        raise KeyError(f"unknown model {name!r}; registered: {sorted(models)}")
    return models[name]


def embedder(name: str) -> Callable[[], Callable[[list[str]], list[list[float]]]]:
    return _known(_EMBEDDERS, name)


def _model(key: bytes, factory: Callable[[], Callable]) -> Callable:
    if key not in _made:
        _made[key] = factory()
    return _made[key]


def _key(factory: Callable) -> bytes:
    """The pickled factory: equal for all tasks of a job, and apart for different models."""
    from pyspark import cloudpickle
    return cloudpickle.dumps(factory)


def embed_named(df: DataFrame, text_col: str, name: str, out_col: str = "embedding") -> DataFrame:
    """V1 with a registered model: batches of texts go through one model per worker. A null text is empty."""
    factory = embedder(name)
    key = _key(factory)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from ragloom.functions.infer import _model
        fn = _model(key, factory)
        for texts in batches:
            yield pd.Series([[float(x) for x in v] for v in fn(texts.fillna("").tolist())], dtype=object)

    # not deterministic: Spark then calls the model once per row, whatever reads the vector
    return df.withColumn(out_col, _embed.asNondeterministic()(F.col(text_col)))


def generate_named(df: DataFrame, prompt_col: str, name: str, out_col: str = "response", options: dict | None = None) -> DataFrame:
    """K4 with a registered model, one per worker; see `batch_infer` for the options."""
    return batch_infer(df, prompt_col, None, out_col, options, _known(_GENERATORS, name))


def batch_infer(df: DataFrame, prompt_col: str, fn: Callable[[list[str], dict], list[str]] | None,
                out_col: str = "response", options: dict | None = None, factory: Callable[[], Callable] | None = None) -> DataFrame:
    """K4: `fn(prompts, options) -> replies` over a prompt column, one call per
    Arrow batch; options such as temperature are passed through unchanged. With
    `factory`, the function is made once in each worker. A reply too few or too
    many fails the job."""
    opts = dict(options or {})
    make = factory or (lambda: fn)
    key = _key(make)

    @F.pandas_udf(T.StringType())
    def _gen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from ragloom.functions.infer import _model
        model = _model(key, make)
        for prompts in batches:
            replies = model(prompts.fillna("").tolist(), opts)
            if len(replies) != len(prompts):
                raise ValueError(f"{len(prompts)} prompts, {len(replies)} replies")
            yield pd.Series(replies, dtype=object)

    return df.withColumn(out_col, _gen.asNondeterministic()(F.col(prompt_col)))


def hashed_dense_embedder(dims: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """A deterministic dense stand-in model (token hashing, L2-normalised),
    for tests and for running the pipeline without a model server."""
    import hashlib
    import re

    import numpy as np

    tok = re.compile(r"[^\W_]+", re.UNICODE)

    class Places(dict):
        def __missing__(self, w: str) -> int:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            at = self[w] = int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") % dims
            return at

    place = Places().__getitem__

    def fn(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            at = np.fromiter(map(place, tok.findall(t.lower())), np.int64)
            v = np.bincount(at, minlength=dims).astype(np.float64)
            n = np.linalg.norm(v)
            out.append((v / n if n > 0 else v).tolist())
        return out

    return fn
