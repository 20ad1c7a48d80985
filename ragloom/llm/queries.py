"""The registered queries of this subpackage: one per operator, each over its
whole table with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.llm import bpe, convtrie, decontam, hilbert, licenses, linededup, merkle, neardup, quality, rlz, tokenbin, toxicity, warc
from ragloom.llm.common import keep
from ragloom.session import table

#: Vocabulary files are a parameter: names in the public tokenizer folder.
BYTE_BPE, WORD_BPE, WORD_BPE_SIZE, END_ID = "byte_bpe_50k.json", "word_bpe_49k.json", 49_408, 1
SHARDS, SHARD_DIMS = 24, ["lang", "source", "n_chars"]


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.dedup_lines(docs)
    return out.select("doc_id", "n_removed_lines", F.length("text").cast("long").alias("n_chars_left"),
                      F.sha2("text", 256).alias("text_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    both = docs.select("doc_id", bpe.round_trip(F.col("text"), tokenizer_path(BYTE_BPE)).alias("r"))
    return both.select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256")


def word_encoder(path: str) -> Callable[[], bpe.SpacedWords]:
    """Encoder of the word vocabulary, whose white space makes no ids."""
    def make():
        key = f"words:{path}"
        if key not in bpe._loaded:
            bpe._loaded[key] = bpe.SpacedWords(bpe.load(path))
        return bpe._loaded[key]
    return make


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenbin.write_tokens(table(spark, sf_dir, "documents"), word_encoder(tokenizer_path(WORD_BPE)),
                                     END_ID, WORD_BPE_SIZE)
    return tokenbin.read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", "n_chars", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    out = hilbert.assign(rows, SHARDS, SHARD_DIMS, "doc_id")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = convtrie.number_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    ids, turns = convtrie.graft(keep(turns, "trie-turns"), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, 3)
    return convtrie.trie(keep(ids, "trie-ids"), turns).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    cut = [*whole[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaf = merkle.row_digest(whole)
    return merkle.verify(table(spark, sf_dir, "documents").select(
        "doc_id", "source", leaf.alias("leaf"), F.when(tampered, merkle.row_digest(cut)).otherwise(leaf).alias("seen")))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.drop_repeats(table(spark, sf_dir, "documents"), with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc, op2_toxicity, op3_line_dedup, op4_decontamination, op5_bpe, op6_token_file, op7_sharding,
    op8_licenses, op9_near_duplicates, op10_quality, op11_conversation_trie,
    op12_merkle_manifest, op13_substring_dedup)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP1_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT *, list_aggregate(list_transform(range(0, 8), lambda g:
    list_aggregate(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, g * 5 + 1, 5))::INT >> s) & 31) + 1, 1)),
      'string_agg', '')), 'string_agg', '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h, octet_length(b)) AS last_id
  FROM p
)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to
FROM d"""

_OP4_SQL = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iwin AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS s
         FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iwin),
dwin AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM dw, sizes WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.k, d.n, i.item_id FROM dwin d JOIN iwin i USING (n, s)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""

def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text in DuckDB: a step for each bit of each byte."""
    bit = "list_reduce(list_concat([xor(c, x)], range(0, 8)), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda t: ascii(t)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, x: {bit}), 4294967295)"


_OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, {_crc32_sql("conv_id::VARCHAR")} % 4 AS h,
         list({{'r': r, 'x': x, 'w': len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))}} ORDER BY k) AS l FROM t GROUP BY conv_id
), rb AS (
  SELECT a.conv_id, list_concat(coalesce(b.l, [])[1:a.h], a.l[a.h + 1:]) AS l
  FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id - a.conv_id % 20
), m AS (
  SELECT conv_id, d, len(l) = d AS ends, sha256(l[1:d]::VARCHAR) || d AS p, coalesce(l[d].w, 0) AS w,
         CASE WHEN d > 0 THEN sha256(l[1:d - 1]::VARCHAR) || (d - 1) END AS up
  FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM rb)
), n AS (
  SELECT p, d, any_value(up) AS up, any_value(w) AS w, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS names
  FROM m GROUP BY p, d
), k AS (SELECT up AS p, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
s AS (
  SELECT a.p, sum((b.n_convs - 1) * b.w) AS saved, count(*) FILTER (WHERE k.p IS NULL) AS leaves
  FROM n b JOIN m a ON a.conv_id = b.conv_id AND a.d <= b.d LEFT JOIN k ON k.p = b.p GROUP BY a.p
)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(n.names) AS ends_sha256
FROM n JOIN s ON s.p = n.p LEFT JOIN k ON k.p = n.p LEFT JOIN n u ON u.p = n.up"""

_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

_OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, sha256({_FIELDS} || {_FIELD.format("text")}) AS leaf,
         sha256({_FIELDS} || {_FIELD.format("replace(text, chr(10), '')")}) AS cut, {_crc32_sql("doc_id::VARCHAR")} % 2 = 0 AS tampered
  FROM documents
), g AS (
  SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM d GROUP BY source
), l AS (
  SELECT d.*, g.s, g.n, row_number() OVER (PARTITION BY g.s ORDER BY doc_id, leaf) - 1 AS p FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), up AS (
  SELECT s, 0 AS lvl, p, leaf AS h, n FROM l
  UNION ALL
  SELECT s, lvl + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY s, lvl, p // 3, n
), sub AS (SELECT s, h, lvl FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, s AS p, h, (SELECT count(*) FROM g) AS n FROM sub
  UNION ALL
  SELECT lvl + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, p // 3, n
), root AS (SELECT h FROM top WHERE n = 1),
step AS (
  SELECT l.r, up.lvl AS k, coalesce(string_agg(up.h, '' ORDER BY up.p) FILTER (WHERE up.p < l.p // (3 ** up.lvl)::BIGINT), '') AS a,
         coalesce(string_agg(up.h, '' ORDER BY up.p) FILTER (WHERE up.p > l.p // (3 ** up.lvl)::BIGINT), '') AS b
  FROM l JOIN up ON up.s = l.s AND up.n > 1 AND up.p // 3 = l.p // (3 ** (up.lvl + 1))::BIGINT GROUP BY l.r, up.lvl
  UNION ALL
  SELECT l.r, sub.lvl + top.lvl, coalesce(string_agg(top.h, '' ORDER BY top.p) FILTER (WHERE top.p < l.s // (3 ** top.lvl)::BIGINT), ''),
         coalesce(string_agg(top.h, '' ORDER BY top.p) FILTER (WHERE top.p > l.s // (3 ** top.lvl)::BIGINT), '')
  FROM l JOIN sub USING (s) JOIN top ON top.n > 1 AND top.p // 3 = l.s // (3 ** (top.lvl + 1))::BIGINT GROUP BY l.r, sub.lvl, top.lvl
), proof AS (SELECT r, count(*) AS steps, string_agg(a || b, '' ORDER BY k) AS t FROM step GROUP BY r),
fold AS (
  SELECT r, 0 AS k, CASE WHEN tampered THEN cut ELSE leaf END AS h FROM l
  UNION ALL
  SELECT r, k + 1, sha256(a || h || b) FROM fold JOIN step USING (r, k)
)
SELECT l.doc_id, l.leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(t, '')) AS proof_sha256, fold.h AS folded_root,
       fold.h = root.h AS verified
FROM l JOIN sub USING (s) LEFT JOIN proof USING (r) JOIN fold ON fold.r = l.r AND fold.k = coalesce(steps, 0), root"""

_OP13_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, k, sha256(array_to_string(w[k:k + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d WHERE len(w) >= 50)
), hit AS (
  SELECT doc_id, k FROM win JOIN (SELECT s, min(doc_id) AS lo FROM win GROUP BY s) USING (s) WHERE lo < doc_id
), gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(k, k + 50)) AS p FROM hit)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

ORACLE: dict[str, str] = {"op1_warc": _OP1_SQL, "op4_decontamination": _OP4_SQL, "op11_conversation_trie": _OP11_SQL,
                          "op12_merkle_manifest": _OP12_SQL, "op13_substring_dedup": _OP13_SQL}
