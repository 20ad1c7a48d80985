"""Model output and files with awkward values: no job ends, no row is lost."""

import csv
import json
import os

from pyspark.sql import functions as F

from ragloom.operators import retrieve as R
from ragloom.operators import structured as X
from ragloom.operators import tools as H
from ragloom.plans import flows
from ragloom.sources import files as FS


def test_integer_tools_with_long_numbers(spark):
    big = "99999999999999999999"
    rows = [("add_two_numbers", {"a": big, "b": "1"}), ("subtract_two_numbers", {"a": "-1", "b": big}),
            ("add_two_numbers", {"a": "9" * 60, "b": "1"}), ("add_two_numbers", {"a": "1.5", "b": "1"}),
            ("add_two_numbers", {"a": " 2 ", "b": "+3"}), ("add_two_numbers", {"b": "3"})]
    df = spark.createDataFrame(rows, "name string, args map<string,string>")
    got = [r[0] for r in df.select(H.builtin_output(F.col("name"), F.col("args"))).collect()]
    assert got == [str(int(big) + 1), str(-1 - int(big)), None, None, "5", None]


def test_lax_validation_of_large_integers(spark):
    def reply(age):
        return json.dumps({"friends": [{"name": "x", "age": age, "is_available": True}]})
    ages = [9007199254740993, "9007199254740993", "99999999999999999999", 22.0, 22.5, 1e300, 99999999999999999999]
    df = spark.createDataFrame([(i, reply(a)) for i, a in enumerate(ages)], "i int, reply string").coalesce(1)
    got = [(r[0], r[1][0]["age"]) for r in df.select(X.validate_lax("reply"), X.parse_lax("reply")).collect()]
    assert got == [(True, 9007199254740993), (True, 9007199254740993), (False, None), (True, 22), (False, None),
                   (False, None), (False, None)]


def test_date_range_with_bad_dates_and_large_days(spark):
    events = spark.createDataFrame([("2024-01-01 10:00:00", 1e15), ("2024-01-02 10:00:00", 0.37)], "ts string, value double")
    events = events.withColumn("ts", F.to_timestamp("ts"))
    calls = spark.createDataFrame([(1, "2024-01-02", "2024-01-02"), (2, "last monday", None), (3, None, "2024-13-01"),
                                   (4, "", None)], "id int, fromDate string, toDate string")
    got = {r["id"]: (r["n_deployments"], r["total_value"])
           for r in H.date_range_summary(calls, events, ["id"]).collect()}
    assert got == {1: (1, 0.37), 2: (None, None), 3: (None, None), 4: (2, 1e15 + 0.37)}


def test_forecast_keeps_every_period(spark):
    periods = [{"name": "Tonight", "temperature": 70.5, "temperatureUnit": "F", "windSpeed": None,
                "windDirection": "N", "detailedForecast": "dry"},
               {"name": "Monday", "temperature": 60, "temperatureUnit": "F", "windSpeed": "5 mph"}]
    text = json.dumps({"properties": {"periods": periods}})
    df = spark.createDataFrame([(text,)], "p string").select(H.format_forecast(F.from_json("p", H.FORECAST_PAYLOAD)))
    assert df.first()[0] == ("\nTonight:\nTemperature: 70.5°F\nWind: None N\nForecast: dry\n" + H.BLOCK_SEP
                             + "\nMonday:\nTemperature: 60°F\nWind: 5 mph None\nForecast: None\n")


def test_markdown_keeps_what_is_no_mark(spark):
    text = ("# Title\n\nsnake_case_name and 2*3*4, *one* **two** _three_ ***four***\n\n- item `a_b`\n\n#hashtag\n\n"
            "## Next\n```py\n# comment\n* not a list\n```\nend")
    got = spark.createDataFrame([(text,)], "t string").select(FS.markdown_to_text("t")).first()[0]
    assert got == ("Title\n\nsnake_case_name and 2*3*4, one two three four\n\nitem a_b\n\n#hashtag\n\n"
                   "Next\n\n# comment\n* not a list\n\nend")


def test_asciidoc_keeps_what_is_no_mark(spark):
    text = "= Title\n:toc: left\n\na_b_c *bold* 2*3*4\n\n----\n= code\n*x*\n----\n\n.Caption\nend"
    got = spark.createDataFrame([(text,)], "t string").select(FS.asciidoc_to_text("t")).first()[0]
    assert got == "Title\n\na_b_c bold 2*3*4\n\n= code\n*x*\n\nCaption\nend"


def test_csv_with_long_fields_and_many_rows(spark, tmpdir_path):
    long = "word " * 40_000
    with open(os.path.join(tmpdir_path, "long.csv"), "w", newline="") as f:
        csv.writer(f).writerows([["a"], ["one"], [long], ["three"]])
    with open(os.path.join(tmpdir_path, "many.csv"), "w", newline="") as f:
        csv.writer(f).writerows([["a"], *([f"row {i}"] for i in range(30_000))])
    with open(os.path.join(tmpdir_path, "bad.csv"), "wb") as f:
        f.write(b"a\nfine\n\xff\xfe\n")
    docs = FS.scan_csv_docs(spark, tmpdir_path)
    kept = docs.filter("error is null")
    assert kept.filter(F.col("source").endswith("long.csv")).count() == 3
    assert kept.agg(F.max(F.length("text"))).first()[0] == len("a: " + long.strip())
    assert kept.filter(F.col("source").endswith("bad.csv")).count() == 0 and docs.filter("error is not null").count() == 1
    done = flows.embed_directory(spark, tmpdir_path, tmpdir_path + "-store")
    assert done["documents"] == 30_003 and done["added"] == done["chunks"]
    assert spark.read.parquet(done["store"]).select("doc_id", "chunk_no").distinct().count() == done["chunks"]


def test_chunks_without_tokens_are_stored(spark):
    docs = spark.createDataFrame([("marks", 0, "*** --- !!!"), ("words", 2_000_000_000, "some words")],
                                 "source string, page int, text string")
    rows = {r["doc_id"]: r for r in flows.document_rows(docs).collect()}
    assert rows["marks"]["dims"] == [] and rows["marks"]["document"] == "*** --- !!!"
    assert rows["words"]["id"] == "words_2000000000_0" and len(rows["words"]["dims"]) == 2


def test_ann_join_beyond_the_broadcast_bound(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    vecs = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 8)))]
    df = spark.createDataFrame(vecs, "id long, embedding array<double>")
    assigned, cents = R.ivf_index(df, "id", n_cells=4)
    queries = df.filter("id < 40").withColumnRenamed("id", "qid")
    small = R.ann_join(queries, assigned, cents, "qid", "id", k=3, nprobe=2)
    large = R.ann_join(queries, assigned, cents, "qid", "id", k=3, nprobe=2, max_probes=5)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.select(*small.columns).collect()))
    probes = queries.select("qid", F.col("embedding").alias("__qv"), F.array(*map(F.lit, range(4))).alias("__cells"))
    split = R._ann_shuffled(probes, assigned, "qid", "id", "embedding", 3, block=7)
    every = R.ann_join(queries, assigned, cents, "qid", "id", k=3, nprobe=4)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, split.select(*every.columns).collect()))
