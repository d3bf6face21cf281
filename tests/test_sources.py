import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomline.operators import dedup, gate, records, split, stats
from loomline.sources import pdf, readers, sinks
from loomline.streaming import incremental


def test_json_lines(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n\n  \n{"a": 2}\nnope\n{"a": 3}\n')
    got = readers.read_jsonl_prefix(spark, str(p)).orderBy("ord").select(F.try_variant_get("value", "$.a", "int").alias("a")).collect()
    assert [r.a for r in got] == [1, 2]
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(p)).collect()
    assert readers.read_jsonl_prefix(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_batches_and_datasets(spark, tmp_path):
    (tmp_path / "b2.json").write_text('[{"k": 3}, {"k": 4}]')
    (tmp_path / "b1.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "b3.json").write_text('{"k": 5}')
    (tmp_path / "b4.json").write_text("broken")
    got = readers.read_batches(spark, str(tmp_path)).orderBy("ord").select(F.try_variant_get("value", "$.k", "int").alias("k")).collect()
    assert [r.k for r in got] == [1, 2, 3, 4]
    assert sorted(r.reason for r in readers.skipped_batches(spark, str(tmp_path)).collect()) == ["not JSON", "not a list"]
    assert readers.read_batches(spark, str(tmp_path / "missing")).count() == 0
    (tmp_path / "d.json").write_text('{"examples": [{"k": 1}, {"k": 2}]}')
    assert readers.read_dataset(spark, str(tmp_path / "d.json")).count() == 2 and readers.read_dataset(spark, str(tmp_path / "b1.json")).count() == 2
    for bad in ("b3.json", "x.csv"):
        with pytest.raises(ValueError):
            readers.read_dataset(spark, str(tmp_path / bad))
    assert readers.default_source(["b.pdf", "a.pdf", "x.txt"]) == "a.pdf" and readers.default_source(["/z/b_Book.pdf", "a.pdf"], "book") == "/z/b_Book.pdf"
    with pytest.raises(FileNotFoundError):
        readers.default_source([])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "k int, text string")
    sinks.write_dataset(df, str(tmp_path / "out"))
    lines = [json.loads(x) for f in (tmp_path / "out/jsonl").glob("part-*") for x in f.read_text().splitlines()]
    assert sorted(lines, key=lambda r: r["k"]) == [{"k": 1, "text": "é"}, {"k": 2, "text": None}]
    sinks.write_jsonl(df, str(tmp_path / "out/jsonl"), append=True)
    assert readers.read_texts(spark, str(tmp_path / "out/jsonl")).count() == 4
    with pytest.raises(ValueError):
        readers.read_texts(spark, _no_text(spark, tmp_path))
    row = sinks.write_report(spark.createDataFrame([(4098.605, 3)], "a double, n int"), str(tmp_path / "deep/r.json"), model="m")
    again = json.loads((tmp_path / "deep/r.json").read_text())
    assert again["a"] == row["a"] == 4098.6 and again["model"] == "m" and "timestamp" in again
    assert sinks.run_folder("/r", datetime(2024, 1, 2, 3, 4, 5))["metadata"] == "/r/run_20240102_030405/metadata.json"
    sinks.write_text(df.filter("k = 1"), str(tmp_path / "t"))
    assert readers.read_state(spark, str(tmp_path / "nothing"), "a int").count() == 0


def _no_text(spark, tmp_path):
    spark.range(2).write.json(str(tmp_path / "no_text"))
    return str(tmp_path / "no_text")


def test_pdf_blocks(spark, tmp_path):
    (tmp_path / "My_book.pdf").write_bytes(b"one|two")

    def parser(content):
        return [(1, k, 0.0, 60.0 + k, 9.0, 70.0, 800.0, t) for k, t in enumerate(content.decode().split("|"))]

    got = pdf.read_blocks(spark, str(tmp_path), parser).orderBy("block_ord").collect()
    assert [(r.source_book, r.text, r.y0) for r in got] == [("My book", "one", 60.0), ("My book", "two", 61.0)]


def test_stream_is_idempotent_and_resumes(spark, tmp_path):
    root, src = str(tmp_path / "run"), tmp_path / "in"
    answer = lambda i, r: json.dumps({"instruction": i, "response": r * 200, "concept": "c", "difficulty": "easy"})
    schema = "chunk_id string, answer string, source_book string, chapter string, source_chunk string"
    row = lambda c, a: (c, a, "b", "ch", "text")

    def feed(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(src))
        incremental.run_stream(spark.readStream.schema(schema).parquet(str(src)), root).awaitTermination()

    feed([row("c1", answer("q1", "r")), row("c2", "nothing"), row("c3", answer("Q1 ", "s"))])
    feed([row("c4", answer("q 1", "t")), row("c5", answer("q2", "u")), row("c2", answer("q3", "v"))])
    status = {r.chunk_id: r.status for r in incremental.status_table(spark, root).collect()}
    assert status == {"c1": "ok", "c2": "generation_failed", "c3": "duplicate", "c4": "duplicate", "c5": "ok"}
    assert sorted(r.chunk_id for r in incremental.example_table(spark, root).collect()) == ["c1", "c5"]
    batch = spark.createDataFrame([row("c4", answer("q 1", "t")), row("c5", answer("q2", "u"))], schema)
    last = max(r.batch for r in incremental.status_table(spark, root).collect())
    incremental.take_batch(batch, last, root)
    assert sorted(r.chunk_id for r in incremental.example_table(spark, root).collect()) == ["c1", "c5"]


def test_end_to_end(spark):
    record = lambda i, r: json.dumps({"instruction": i, "response": r, "concept": "c", "difficulty": "easy", "chapter": "1", "source_book": "b"})
    make = lambda rows: spark.createDataFrame(list(enumerate(rows)), "ord int, t string").select("ord", F.parse_json("t").alias("value"))
    merged = records.merge(make([record("q1", "Hello! " + "r" * 60)]), make([record("q2", "s" * 60)])).withColumn("ord", F.col("source_rank"))
    gated = gate.gate_pairs(merged.select("ord", "instruction", "response", "concept", "difficulty"))
    assert gate.gate_report(gated).first().status == "PASS"
    assert tuple(split.split_sizes(split.train_val(gated, "ord", 0.5)).first()) == (2, 1, 1)
    assert stats.dataset_statistics(merged).first().total_examples == 2 and dedup.by_pair_hash(merged).count() == 2


def test_json_replaces_what_is_there(spark, tmp_path):
    path = tmp_path / "r.json"
    for k in (1, 2):
        sinks.write_json(spark, {"k": k}, str(path))
        assert json.loads(path.read_text()) == {"k": k}
    assert not (tmp_path / "r.json.part").exists()
