"""Large files read in many tasks: equal to what one task reads."""

import csv
import json
import random

import pytest

from folioforge.sources import readers, splitting, writers

SCHEMA = "a long, t string, l array<string>, o struct<x:string,y:long>"


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def odd_text(rng):
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "\n", " ", "é", "రా", "x", "\\\"", "}\n", "{\""]) for _ in range(rng.randint(0, 60)))


def objects(n, seed):
    rng = random.Random(seed)
    return [{"a": i, "t": odd_text(rng), "l": [odd_text(rng) for _ in range(rng.randint(0, 3))], "o": {"x": odd_text(rng), "y": rng.randrange(9)} if i % 3 else None} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_array_in_many_tasks(spark, tmp_path, small_blocks, indent):
    rows = objects(300, 1)
    (tmp_path / "a.json").write_text(" \n" + json.dumps(rows, indent=indent, ensure_ascii=bool(indent)) + "\n")
    path = f"file://{tmp_path}/a.json"
    assert splitting.is_large(spark, path) and splitting._pieces(spark, path, "}").select("block").distinct().count() > 5
    got = readers.read_json_array(spark, path, SCHEMA).collect()
    assert sorted((r.a, r.t, r.l, r.o and r.o.asDict()) for r in got) == [(r["a"], r["t"], r["l"], r["o"]) for r in rows]
    got = readers.read_records(spark, path, "a long, t string").orderBy("index").collect()
    assert [(r["index"], r.a, r.t, json.loads(r.json)) for r in got] == [(i, r["a"], r["t"], r) for i, r in enumerate(rows)]


def test_other_arrays_are_read_whole(spark, tmp_path, small_blocks):
    mixed = [{"a": 1, "t": "x" * 3000}, 7, {"a": 2}]
    (tmp_path / "m.json").write_text(json.dumps(mixed))
    path = f"file://{tmp_path}/m.json"
    assert splitting.json_records(spark, path) is None
    assert [(r["index"], r.a) for r in readers.read_records(spark, path, "a long").orderBy("index").collect()] == [(0, 1), (1, None), (2, 2)]
    for name, text in (("open", '[{"a": 1}, {"a": '), ("comma", '[{"a": 1} {"a": 2}]'), ("ends", '[{"a": 1}] x')):
        (tmp_path / name).write_text(text + " " * 3000)
        assert splitting.json_records(spark, f"file://{tmp_path}/{name}") is None
    (tmp_path / "none").write_text("[" + " " * 3000 + "]")
    assert splitting.json_records(spark, f"file://{tmp_path}/none").count() == 0


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_many_tasks(spark, tmp_path, small_blocks, end):
    rng = random.Random(2)
    rows = [[str(i), "".join(rng.choice(['"', ",", "\n", "a", "é", " "]) for _ in range(rng.randint(0, 20))), rng.choice(["", "x"])] for i in range(600)]
    with open(tmp_path / "c.csv", "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([["n", "t", "u v"], *rows])
    path = f"file://{tmp_path}/c.csv"
    assert splitting.csv_records(spark, path) is not None
    got = readers.read_csv_rows(spark, path).collect()
    assert sorted((list(r) for r in got), key=lambda r: int(r[0])) == rows and got[0].__fields__ == ["n", "t", "u v"]


def test_csv_with_quotes_in_bare_fields_is_read_whole(spark, tmp_path, small_blocks):
    (tmp_path / "q.csv").write_text("a,b\n" + 'x"y,1\n' * 900)
    path = f"file://{tmp_path}/q.csv"
    assert splitting.csv_records(spark, path) is None
    assert readers.read_csv_rows(spark, path).filter("a = 'x\"y'").count() == 900


def test_sinks_are_written_by_one_task_in_order(spark, tmp_path):
    rows = [(i, odd_text(random.Random(i)), None if i % 2 else "v") for i in range(500)]
    df = spark.createDataFrame(rows, "n int, t string, u string").repartition(7)
    folder = f"file://{tmp_path}"
    writers.write_jsonl_file(df, f"{folder}/a.jsonl", ["n"])
    writers.write_jsonl_file(df, f"{folder}/a.jsonl", ["n"], ["u"])  # takes the place of the first
    assert [json.loads(x) for x in (tmp_path / "a.jsonl").read_text().split("\n")[:-1]] == [{"n": n, "t": t} for n, t, _ in rows]
    want = [{"n": n, "t": t, "u": u} for n, t, u in rows]
    for end in ("\n", ""):
        writers.write_json_array(df, f"{folder}/a.json", ["n"], end=end)
        assert (tmp_path / "a.json").read_text() == json.dumps(want, ensure_ascii=False, indent=2) + end
        writers.write_json_array(df.limit(0), f"{folder}/b.json", ["n"], end=end)
        assert (tmp_path / "b.json").read_text() == "[]" + end
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["a.json", "a.jsonl", "b.json"]
