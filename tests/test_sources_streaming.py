import json

import pytest
from pyspark.sql import functions as F

from tesserae.sources import images as I
from tesserae.sources import jsonl as J
from tesserae.streaming import incremental as N


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_tolerant_and_strict(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", ['{"k": "x", "v": 1}', "", "not json", '{"v": 5}', '{"k": "x", "v": 2}', '{"k": "", "v": 3}', '{"k": "y", "v": 4}'])
    assert {(r.k, r.v) for r in J.read_keyed(spark, p, "k string, v long", "k").collect()} == {("x", 2), ("y", 4)}
    assert J.read_tolerant(spark, p, "k string, v long").count() == 5
    assert sorted(r.key for r in J.read_keys(spark, p, "k string, v long", F.nullif("k", F.lit(""))).collect()) == ["x", "y"]
    assert [r.v for r in J.head(spark, p, "k string, v long", 2).collect()] == [1, 5]
    with pytest.raises(Exception):
        J.read_strict(spark, p, "k string, v long").collect()
    with pytest.raises(Exception):
        J.read_strict_lines(spark, p).collect()
    missing = str(tmp_path / "none.jsonl")
    assert J.read_tolerant(spark, missing, "k string").count() == 0 and J.read_keyed(spark, missing, "k string, v long", "k").count() == 0
    with pytest.raises(Exception):
        J.read_strict(spark, missing, "k string").collect()


def test_array_and_sinks(spark, tmp_path):
    p = write(tmp_path / "a.json", ['[{"id": "1",', '"image": null}, {"id": "2"}]'])
    assert J.read_array(spark, p, "id string, image string").count() == 2
    out = str(tmp_path / "out")
    d = spark.createDataFrame([("图", None)], "a string, b string")
    J.append(d, out)
    J.append(d, out)
    assert spark.read.option("recursiveFileLookup", True).text(out).first().value == '{"a":"图","b":null}'
    J.overwrite(J.read_strict(spark, out, "a string, b string").limit(1), out)
    assert spark.read.text(out).count() == 1 and J.exists(spark, out + ".bak")
    s = J.stats_json(spark.createDataFrame([("b", 2), ("a", 1)], "metric string, value long")).first().stats
    assert json.loads(s) == {"a": 1, "b": 2}


def test_the_last_run_wins(spark, tmp_path):
    out = str(tmp_path / "log")
    write(tmp_path / "log" / "zz-old.jsonl", ['{"k": "x", "v": -2}', '{"k": "x", "v": -1}', '{"k": "w", "v": -1}'])
    for v in range(11):
        J.append(spark.createDataFrame([("x", v), (f"k{v}", v)], "k string, v long"), out)
        assert {r.k: r.v for r in J.read_keyed(spark, out, "k string, v long", "k").collect()} == {"x": v, "w": -1, **{f"k{i}": i for i in range(v + 1)}}
    assert [r.v for r in J.head(spark, out, "k string, v long", 3).collect()] == [-2, -1, -1]


def test_last_wins_in_a_file_of_many_parts(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", [f'{{"k": "x", "v": {i}, "t": "{"t" * 200}"}}' for i in range(3000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert J.read_keyed(spark, p, "k string, v long", "k").first().v == 2999
        assert [r.v for r in J.head(spark, p, "k string, v long", 2).collect()] == [0, 1]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_manifest(spark, tmp_path):
    out = str(tmp_path / "m")
    J.write_manifest(spark.createDataFrame([("A", "x/../y/./1.png", 1), ("B", "/r//2.png", 2)], "dataset string, image_path string, n int"), out, "/root")
    write(tmp_path / "m" / "more.json", ["not json", '{"dataset": "C"}'])
    assert sorted(tuple(r) for r in J.read_manifest(spark, out).collect()) == [("A", "/root/y/1.png"), ("B", "/r/2.png")]
    J.write_manifest(J.read_manifest(spark, out), out)
    assert J.read_manifest(spark, out).count() == 2 and J.read_manifest(spark, str(tmp_path / "none")).count() == 0


def test_scan(spark, tmp_path):
    for f in ("LEVIR-CD+/train/B/1.png", "LEVIR-CD+/train/A/1.png", "LEVIR-CD+/train/B/1.jpg", "EBD/x/images/x_1_post_disaster.jpg", "EBD/x/images/x_1_pre_disaster.png"):
        write(tmp_path / f, ["x"])
    got = I.scan(spark, str(tmp_path), ["LEVIR-CD+", "EBD", "SECOND", "odd"])
    assert sorted((r.dataset, r.image_path.rsplit("/", 1)[1]) for r in got.collect()) == [("EBD", "x_1_post_disaster.jpg"), ("LEVIR-CD+", "1.png")]
    data = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "EBD"))
    assert {r.mime for r in I.encode(data).collect()} == {"image/png", "image/jpeg"} and I.encode(data).first().data == "eAo="
    assert I.by_suffix(data.select("path"), "path", [".jpg"]).count() == 1


def test_append_new_survives_a_restart(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")
    write(src / "1.json", ['{"k": "a", "v": 1}', '{"k": "a", "v": 2}', '{"k": "b", "v": 3}'])
    N.append_new(spark, str(src), "k string, v long", ["k"], out, ck)
    write(src / "2.json", ['{"k": "b", "v": 4}', '{"k": "c", "v": 5}'])
    N.append_new(spark, str(src), "k string, v long", ["k"], out, ck)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_upsert_stream(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "t"), str(tmp_path / "ck")
    schema = "id string, decision string, updated_at string"
    write(src / "1.json", ['{"id": "a", "decision": "approved", "updated_at": "1"}', '{"id": "b", "decision": "approved", "updated_at": "1"}'])
    N.upsert_stream(spark, str(src), schema, ["id"], ["updated_at"], out, ck)
    write(src / "2.json", ['{"id": "a", "decision": "rejected", "updated_at": "2"}', '{"id": "b", "decision": "rejected", "updated_at": "0"}'])
    N.upsert_stream(spark, str(src), schema, ["id"], ["updated_at"], out, ck)
    assert {(r.id, r.decision) for r in N.newest(spark, out, schema).collect()} == {("a", "rejected"), ("b", "approved")}
    assert N.newest(spark, str(tmp_path / "none"), schema).count() == 0
    # only touched buckets are written anew, and a batch may run twice
    batch = spark.createDataFrame([("a", "approved", "3")], schema)
    before = N.current(spark, out)
    for _ in range(2):
        N.upsert(batch, out, ["id"], ["updated_at"], 7)
    after = N.current(spark, out)
    assert sum(after[b] != before.get(b) for b in after) == 1 and {(r.id, r.decision) for r in N.newest(spark, out, schema).collect()} == {("a", "approved"), ("b", "approved")}
    N.upsert(batch.where("id is null"), out, ["id"], ["updated_at"], 8)
    assert N.current(spark, out) == after
