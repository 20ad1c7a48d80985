"""DuckDB SQL twins of the registered queries (the correctness oracle).

The SQL is written independently from the Spark code, in plain CTEs over
the driver's pre-registered views. Shared fragments (chunking, hashed
vectors) are small functions returning CTE text, so each query reads as
one statement.
"""

from __future__ import annotations

DIMS = 4096


def q(s: str) -> str:
    """DuckDB string literal."""
    return "'" + s.replace("'", "''") + "'"


def nl(s: str) -> str:
    """DuckDB expression for a string that may contain newlines."""
    parts = s.split("\n")
    if len(parts) == 1:
        return q(s)
    return "(" + " || chr(10) || ".join(q(p) for p in parts) + ")"


TOKENS = r"list_filter(regexp_split_to_array(lower({col}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def tokens(col: str) -> str:
    return TOKENS.format(col=col)


def bucket(tok: str, dims: int = DIMS) -> str:
    return f"((('0x' || substr(md5({tok}), 1, 8))::BIGINT % {dims})::INTEGER)"


def chunks_cte(size: int = 1000, overlap: int = 200, name: str = "chunks") -> str:
    step = size - overlap
    return f"""{name} AS (
  SELECT doc_id, lang, source, (s // {step})::INTEGER AS chunk_no, s::INTEGER AS chunk_start,
         substr(text, s + 1, {size}) AS chunk
  FROM (SELECT doc_id, lang, source, text,
               unnest(generate_series(0, greatest(length(text) - {overlap + 1}, 0), {step})) AS s
        FROM documents WHERE length(text) > 0)
)"""


def tf_cte(name: str, src: str, keys: str, text: str, dims: int = DIMS) -> str:
    return f"""{name} AS (
  SELECT {keys}, {bucket('t', dims)} AS dim, count(*)::DOUBLE AS tf
  FROM (SELECT {keys}, unnest({tokens(text)}) AS t FROM {src})
  GROUP BY ALL
)"""


def corpus_ctes(dims: int = DIMS, weighting: str = "tfidf") -> str:
    """CTEs chunks, ctf, [idf], cvec(doc_id, chunk_no, dim, w)."""
    parts = [chunks_cte(), tf_cte("ctf", "chunks", "doc_id, chunk_no", "chunk", dims)]
    if weighting == "tfidf":
        parts.append("""idf AS (
  SELECT dim, ln((SELECT count(*) FROM (SELECT DISTINCT doc_id, chunk_no FROM ctf))::DOUBLE / count(*)) AS idf
  FROM ctf GROUP BY dim
)""")
        parts.append("""cw AS (SELECT doc_id, chunk_no, dim, tf * idf AS w FROM ctf JOIN idf USING (dim) WHERE idf > 0)""")
    else:
        parts.append("""cw AS (SELECT doc_id, chunk_no, dim, tf AS w FROM ctf)""")
    parts.append("""cvec AS (
  SELECT doc_id, chunk_no, dim, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, chunk_no)) AS w FROM cw
)""")
    return ",\n".join(parts)


def question_ctes(dims: int = DIMS, weighting: str = "tfidf", src: str = "benchmark", keys: str = "item_id",
                  text: str = "text") -> str:
    """CTEs qtf, qvec(keys, dim, w) over a question source (needs corpus_ctes for idf)."""
    parts = [tf_cte("qtf", src, keys, text, dims)]
    if weighting == "tfidf":
        parts.append(f"""qw AS (SELECT {keys}, dim, tf * idf AS w FROM qtf JOIN idf USING (dim) WHERE idf > 0)""")
    else:
        parts.append(f"""qw AS (SELECT {keys}, dim, tf AS w FROM qtf)""")
    parts.append(f"""qvec AS (
  SELECT {keys}, dim, w / sqrt(sum(w * w) OVER (PARTITION BY {keys})) AS w FROM qw
)""")
    return ",\n".join(parts)


def search_ctes(k: int = 4, dims: int = DIMS, weighting: str = "tfidf", src: str = "benchmark",
                keys: str = "item_id", text: str = "text") -> str:
    """CTEs ending in hits(keys, doc_id, chunk_no, score, rank)."""
    qk = ", ".join(f"qvec.{x.strip()}" for x in keys.split(","))
    return f"""{corpus_ctes(dims, weighting)},
{question_ctes(dims, weighting, src, keys, text)},
scores AS (
  SELECT {qk}, cvec.doc_id, cvec.chunk_no, round(sum(qvec.w * cvec.w), 6) AS score
  FROM qvec JOIN cvec USING (dim) GROUP BY ALL
),
hits AS (
  SELECT * FROM (
    SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, doc_id, chunk_no))::INTEGER AS rank
    FROM scores) WHERE rank <= {k}
)"""


def gold_cte() -> str:
    return """gold AS (
  SELECT DISTINCT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON instr(d.text, b.text) > 0
)"""
