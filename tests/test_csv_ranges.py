"""CSV files read by byte ranges equal the csv module on whole files."""

from __future__ import annotations

import csv
import io
import os
import random
import sys

import pytest

from ragloom.sources import csvranges as CR
from ragloom.sources import files as FS


def whole(data: bytes):
    """(page, text) of a file by the csv module, or None if it cannot be read."""
    csv.field_size_limit(sys.maxsize)
    try:
        text = data.decode("utf-8-sig")
        return [(i, "\n".join(f"{k.strip() if k else k}: {v.strip() if isinstance(v, str) else v}" for k, v in row.items()))
                for i, row in enumerate(csv.DictReader(io.StringIO(text)))]
    except (csv.Error, UnicodeDecodeError):
        return None


FILES = {
    "plain.csv": b"a,b\n1,2\n3,4\n",
    "quoted break.csv": b'a,b\n1,"x\ny\n\nz"\n2,"p ""q"" r\n,still"\n3,end',
    "crlf+plus.csv": b'a,b\r\n1,"x\r\ny"\r\n\r\n2,3\r\n',
    "bom.CSV": "﻿naïve,b\n1,ü\n".encode(),
    "header.csv": b'"long\nheader\nover many lines ' + b"h" * 200 + b'",b\n1,2\n"3\n3",4\n',
    "pipe.csv": b'a,b\n5" pipe,x\n6" "pipe",y"\n"a"b"c,z\n',
    "ragged.csv": b"a,b\n1\n1,2,3\n\n\n4,5\n",
    "open.csv": b'a,b\n1,"never closed\n2,3\n',
    "lone.csv": b"a,b\n1,2\rx,3\n",
    "bad.csv": b"a,b\n1,2\n\xff\xfe,3\n",
    "empty.csv": b"",
    "only header.csv": b"a,b\n",
    "wide.csv": b"a,b\n1," + b"w" * 300_000 + b"\n2,\"" + b"line\n" * 3_000 + b"\"\n3,3\n",
}


@pytest.mark.parametrize("most", ["37", "64k", "64m"])
def test_ranges_equal_whole_files(spark, tmpdir_path, most):
    os.makedirs(f"{tmpdir_path}/d/deep dir")
    rng = random.Random(4)
    made = {k: v for k, v in FILES.items() if most != "37" or len(v) < 1000}
    for n in range(2):
        cells = ['x', '"a\nb"', '""', '"q""q"', ' sp ', '"', 'é', '"\n\n"', '', '"c,\nd"e"']
        made[f"r{n}.csv"] = ("h1,h2,h3\n" + "\n".join(",".join(rng.choice(cells) for _ in range(rng.randint(1, 4))) for _ in range(25))).encode()
    for name, data in made.items():
        with open(f"{tmpdir_path}/d/deep dir/{name}" if name.startswith("r") else f"{tmpdir_path}/d/{name}", "wb") as f:
            f.write(data)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    try:
        rows = FS.scan_csv_docs(spark, f"{tmpdir_path}/d").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got, errors = {}, {}
    for r in rows:
        name = r["source"].rsplit("/", 1)[1]
        if r["error"] is None:
            got.setdefault(name, []).append((r["page"], r["text"]))
        else:
            errors[name] = r["error"]
            assert r["page"] is None and r["text"] is None
    for name, data in made.items():
        want = whole(data)
        if want is None:
            assert name in errors and name not in got, name
        else:
            assert sorted(got.get(name, [])) == want and name not in errors, name
    if most == "37":
        assert FS.scan_csv_docs(spark, f"{tmpdir_path}/d").columns == ["source", "page", "text", "error"]


def test_walk_follows_the_csv_module():
    rng = random.Random(0)
    for _ in range(3000):
        line = "".join(rng.choice('",ab ') for _ in range(rng.randint(0, 9)))
        rows = list(csv.reader(io.StringIO(line + "\nZ\n")))
        assert CR.walk(line, False) == (rows[-1] != ["Z"]), line
        rows = list(csv.reader(io.StringIO('"' + line + "\nZ\n")))
        assert CR.walk(line, True) == (rows[-1] != ["Z"]), line


def test_one_file_is_many_ranges(spark, tmpdir_path):
    with open(f"{tmpdir_path}/big.csv", "w") as f:
        f.write("n,t\n" + "".join(f'{i},"a\n{i}"\n' for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert CR.ranges(spark, tmpdir_path, "*.csv").count() > 10
        docs = FS.scan_csv_docs(spark, tmpdir_path)
        assert docs.count() == 5000 and docs.where("page = 4321").first()["text"] == "n: 4321\nt: a\n4321"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
