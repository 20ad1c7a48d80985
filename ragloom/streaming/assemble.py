"""Assemble streamed reply pieces into full replies, emitted at end of reply.

Keyed by `(conv_id, turn)`; pieces may arrive out of order and across
micro-batches. A reply is emitted once its `done` piece and every piece
before it have arrived; its state is then removed. State is the pieces of
one unfinished reply (bounded by the reply's length).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

OUTPUT_SCHEMA = "conv_id long, turn long, reply string, n_pieces long"
STATE_SCHEMA = "pieces string, last_seq long"


def _update(key, pdfs: Iterator[pd.DataFrame], state):
    if state.exists:
        pieces_json, last_seq = state.get
        pieces = {int(k): v for k, v in json.loads(pieces_json).items()}
    else:
        pieces, last_seq = {}, -1
    for pdf in pdfs:
        for seq, piece, done in zip(pdf["seq"], pdf["piece"], pdf["done"]):
            pieces[int(seq)] = "" if piece is None else piece
            if bool(done):
                last_seq = int(seq)
    if last_seq >= 0 and all(i in pieces for i in range(last_seq + 1)):
        reply = "".join(pieces[i] for i in range(last_seq + 1))
        state.remove()
        yield pd.DataFrame([(int(key[0]), int(key[1]), reply, last_seq + 1)],
                           columns=["conv_id", "turn", "reply", "n_pieces"])
    else:
        state.update((json.dumps(pieces), last_seq))
        yield pd.DataFrame([], columns=["conv_id", "turn", "reply", "n_pieces"])


def stream_assemble(pieces: DataFrame) -> DataFrame:
    """Pieces `(conv_id, turn, seq, piece, done)` → `(conv_id, turn, reply, n_pieces)`."""
    return (pieces.select("conv_id", "turn", "seq", "piece", "done")
                  .groupBy("conv_id", "turn")
                  .applyInPandasWithState(_update, OUTPUT_SCHEMA, STATE_SCHEMA, "append",
                                          GroupStateTimeout.NoTimeout))
