"""C1 / C2 / C4 chunking: literal cases and splitter invariants."""

from pyspark.sql import functions as F

from ragloom.operators import chunk as C


def _chunks(spark, texts, size, overlap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    rows = C.chunk_fixed(df, "text", size, overlap).orderBy("id", "chunk_no").collect()
    return rows


def test_fixed_counts_literal(spark):
    # 10/2 windows: 10, 11, 18, 19 characters -> 1, 2, 2, 3 chunks
    rows = _chunks(spark, ["a" * 10, "b" * 11, "c" * 18, "d" * 19], 10, 2)
    counts = {}
    for r in rows:
        counts[r["id"]] = counts.get(r["id"], 0) + 1
    assert counts == {0: 1, 1: 2, 2: 2, 3: 3}


def test_fixed_overlap_and_cover(spark):
    text = "".join(chr(ord("a") + i % 26) for i in range(57))
    rows = _chunks(spark, [text], 10, 3)
    starts = [r["chunk_start"] for r in rows]
    assert starts == list(range(0, 57 - 3, 7))
    for r in rows:
        assert text[r["chunk_start"]:r["chunk_start"] + 10] == r["chunk"]
    assert rows[-1]["chunk_start"] + len(rows[-1]["chunk"]) == 57


def test_fixed_empty_and_unicode(spark):
    rows = _chunks(spark, ["", "ñandú é"], 4, 1)
    assert [r["chunk"] for r in rows] == ["ñand", "dú é"]


def test_fixed_rejects_bad_overlap(spark):
    import pytest
    df = spark.createDataFrame([(1, "x")], "id long, text string")
    with pytest.raises(ValueError):
        C.chunk_fixed(df, "text", 10, 10)


PARAGRAPHS = (
    "La inflación de la ciudad subió en marzo.\n\nLos precios de los alimentos aumentaron. "
    "El transporte también.\n\n  Una lista:\n  - pan\n  - leche\n\n"
    + "".join(f"Frase número {i} sin saltos " for i in range(30))
)


def test_recursive_invariants():
    chunks = C.split_recursive(PARAGRAPHS, 120, 30)
    assert chunks
    starts, prev = [], -1
    for c in chunks:
        assert 0 < len(c) <= 120
        assert c == c.strip()
        p = PARAGRAPHS.find(c, prev + 1)        # each chunk is a substring, starts increase
        assert p > prev
        starts.append(p)
        prev = p
    covered = set()
    for c, p in zip(chunks, starts):
        covered.update(range(p, p + len(c)))
    assert all(i in covered for i, ch in enumerate(PARAGRAPHS) if not ch.isspace())


def test_recursive_short_document():
    assert C.split_recursive("short text", 1000, 200) == ["short text"]


def test_recursive_prefers_paragraphs():
    text = "aaa aaa\n\nbbb bbb\n\nccc ccc"
    assert C.split_recursive(text, 9, 0) == ["aaa aaa", "bbb bbb", "ccc ccc"]


def test_recursive_udf_matches_python_and_repartition(spark):
    from tests.conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    a = C.chunk_recursive(docs, "text").select("doc_id", "chunk_no", "chunk")
    b = C.chunk_recursive(docs.repartition(5), "text").select("doc_id", "chunk_no", "chunk")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    one = docs.orderBy("doc_id").first()
    expect = C.split_recursive(one["text"])
    got = [r["chunk"] for r in a.filter(F.col("doc_id") == one["doc_id"]).orderBy("chunk_no").collect()]
    assert got == expect
    for r in a.collect():
        assert 0 < len(r["chunk"]) <= 1000


def test_concat_pages(spark):
    pages = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b"), (2, 0, "x")],
                                  "doc_id long, page int, text string")
    plain = {r["doc_id"]: r["text"] for r in C.concat_pages(pages).collect()}
    assert plain == {1: "abc", 2: "x"}
    ocr = {r["doc_id"]: r["text"] for r in C.concat_pages(pages, sep="\n", trailing="\n").collect()}
    assert ocr == {1: "a\nb\nc\n", 2: "x\n"}
