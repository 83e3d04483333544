"""CSV cut at any place, against the reader that takes a file in one task and against Python's."""

import csv
import random

import pytest

from marlstone.sources import documents
from marlstone.sources.split_csv import csv_records


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    for k, v in old.items():
        spark.conf.set(k, v)


def written(folder, rng, files=3, rows=60):
    want = {}
    for f in range(files):
        path = folder / f"f{f}.csv"
        with open(path, "w", newline="") as out:
            writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
            writer.writerow(["id", "note", "last"])
            data = []
            for i in range(rng.randint(0, rows)):
                note = "".join(rng.choice(["a", "b,", "\n", '"', "é", " ", "\n\n"]) for _ in range(rng.randint(1, 40))).strip(" ")
                data.append([str(i), "x" + note + "y", rng.choice(["1", "two"])])
                writer.writerow(data[-1])
                if rng.random() < 0.1:
                    out.write("\n")
        want[path.name] = data
    return want


@pytest.mark.parametrize("size", [20, 111, 1 << 20])
def test_equal_to_python(spark, tmp_path, small_splits, size):
    want = written(tmp_path, random.Random(size))
    small_splits(size)
    got = csv_records(spark, str(tmp_path))
    rows = {name: [None] * len(data) for name, data in want.items()}
    for r in got.collect():
        rows[r._file.split("/")[-1]][r._row] = list(r._record)
    assert rows == want


def test_many_tasks_and_long_records(spark, tmp_path, small_splits):
    path = tmp_path / "big.csv"
    long = "\n".join(f"line {i}" for i in range(400))
    path.write_text('id,text\n1,"' + long + '"\n2,short\n3,"' + long + '"')
    small_splits(300)
    lines = spark.read.text(str(path))
    assert lines.selectExpr("count(distinct _metadata.file_block_start)").first()[0] > 10
    assert {r._row: tuple(r._record) for r in csv_records(spark, str(path)).collect()} == {0: ("1", long), 1: ("2", "short"), 2: ("3", long)}
    docs = {r.row: (r.doc_id.split("#")[1], r.text) for r in documents.csv_documents(spark, str(path), key=None).collect()}
    assert docs == {0: ("0", "1"), 1: ("1", "2"), 2: ("2", "3")}


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n")
    assert csv_records(spark, str(tmp_path / "a.csv")).collect() == []
    (tmp_path / "b.csv").write_text("id,text\n1,\"open\nquote")
    assert [tuple(r._record) for r in csv_records(spark, str(tmp_path / "b.csv")).collect()] == [("1", "open\nquote")]
