"""What the recursive splitter and the sparse search hold or send at once."""

from ragloom.operators import blockmax as BM
from ragloom.operators import chunk as C
from ragloom.operators import retrieve as R


def test_splitter_cuts_bounded_runs(spark, monkeypatch):
    sizes = [3, 4, 2 << 20, 0, 5] + [1] * 200
    runs = list(C._bounded(sizes))
    assert [a for a, _ in runs] == [0, *(b for _, b in runs[:-1])] and runs[-1][1] == len(sizes)
    assert all(b - a == 1 or (b - a <= C.CUT_ROWS and sum(sizes[a:b]) <= C.CUT_BYTES) for a, b in runs)
    assert not list(C._bounded([]))
    texts = [None, "", "a b. c\n\nd " * 300, "x" * 2500, *(f"word {i}. " * i for i in range(150))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    got = C.chunk_recursive(df, "text").select("id", "chunk_no", "chunk_start", "chunk").collect()
    want = [(i, n, at, c) for i, t in enumerate(texts) for n, (c, at) in enumerate(C.split_recursive_spans(t or ""))]
    assert sorted(map(tuple, got)) == want


def test_counts_are_not_copied_to_shards(spark):
    corpus = spark.createDataFrame([(i, f"w{i} w{i % 3} all") for i in range(40)], "id long, text string")
    asked = spark.createDataFrame([(0, "w5 w2"), (1, "w7")], "qid long, text string").repartition(8)
    hits = R.knn_text(asked, corpus, ["qid"], ["id"], "text", "text", 2)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join Inner"):]
    assert "__stats" in plan and "__stats" not in join
    assert [(r["qid"], r["id"]) for r in hits.orderBy("qid", "rank").where("rank = 1").collect()] == [(0, 5), (1, 7)]


def test_search_holds_a_shard_and_one_pack(spark, monkeypatch):
    corpus = spark.createDataFrame([(i, f"w{i} w{i % 3} all") for i in range(60)], "id long, text string")
    asked = spark.createDataFrame([(i, f"w{i} w{(i + 1) % 3}") for i in range(50)], "qid long, text string").repartition(20)
    hits = R.knn_text(asked, corpus, ["qid"], ["id"], "text", "text", 2)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    left, right = plan[plan.index("Join Inner"):].split("\n   ", 1)[1].split("collect_list", 1)
    assert "__asked" in left and "__asked" not in right  # a merge join holds its right side: the blocks, never the packs
    assert "RebalancePartitions" in left                 # questions of many tasks make full packs
    want = sorted(map(tuple, hits.collect()))
    rows = [{"id": i, "__d": [i], "__w": None} for i in range(9)]
    blocks = [BM.Block.of(BM.postings(_struct(rows[i:i + 3]), ["id"], None, False)) for i in (0, 3, 6)]
    made, of = [], BM.Block.of
    for room, times in ((0, 6), (blocks[0].nbytes, 5), (1 << 20, 3)):  # one or no block fits: the others are made anew for each of two packs
        made.clear()
        monkeypatch.setattr(BM, "HELD_BYTES", room)
        monkeypatch.setattr(BM.Block, "of", lambda p: made.append(1) or of(p))
        found = [r for b in BM._scorer(["q"], ["id"], 1, False)(_pairs(rows)) for r in b.to_pylist()]
        assert len(made) == times
        assert sorted((r["q"], r["id"], r["__score"]) for r in found) == [(i, i, 1.0) for i in range(9)]
    assert want == sorted(map(tuple, R.knn_text(asked, corpus, ["qid"], ["id"], "text", "text", 2).collect()))


def _struct(rows, key="id"):
    import pyarrow as pa
    kind = pa.struct([(key, pa.int64()), ("__d", pa.list_(pa.int32())), ("__w", pa.list_(pa.float64()))])
    return pa.array([{key: r["id"], "__d": r["__d"], "__w": r["__w"]} for r in rows], kind)


def _pairs(rows):
    """Two packs of questions, each with three blocks of one shard."""
    import pyarrow as pa
    pairs = [(0, b, f"p{p}", q, None, c) for p, q in enumerate((rows[:5], rows[5:])) for b, c in enumerate((rows[:3], rows[3:6], rows[6:]))]

    def listed(parts, key):
        ends = [0]
        for x in parts:
            ends.append(ends[-1] + len(x))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _struct([r for x in parts for r in x], key))
    shard, blk, pack, asked, stats, items = zip(*pairs)
    yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(blk), pa.array(pack), listed(asked, "q"), pa.nulls(len(pairs)), listed(items, "id")],
                                     ["__shard", "__blk", "__pack", "__asked", "__stats", "__items"])
