"""Zip members by range, and the bulk sink's batches and commits."""

import json
import os
import zipfile

import pyarrow as pa
import pytest

from civicflow.sinks import bulk, writers
from civicflow.sources import archives


def test_members_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "TASK_MEMBERS", 300)
    want = {}
    for n in range(2):
        with zipfile.ZipFile(tmp_path / f"a{n}.zip", "w") as z:
            z.mkdir("folder")
            for i in range(1000):
                body = os.urandom(20) + b"text " * (i % 50)
                z.writestr(f"folder/{i}.txt", body, zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED)
                want[f"a{n}.zip", f"folder/{i}.txt"] = body
    (tmp_path / "other.bin").write_bytes(b"no archive")
    found = archives.members(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() >= 6
    assert {(r["archive"].rsplit("/", 1)[1], r["name"]): bytes(r["content"]) for r in found.collect()} == want
    assert archives.members(spark, str(tmp_path), names="/7.txt$").count() == 2


@pytest.mark.parametrize("wide", [False, True])
def test_large_archives_are_written_in_parts(spark, tmp_path, monkeypatch, wide):
    monkeypatch.setattr(archives, "PART_MEMBERS", 100)
    monkeypatch.setattr(archives, "TASK_MEMBERS", 70)
    monkeypatch.setattr(archives, "WIDE_BYTES", 1 if wide else archives.FULL)
    want = {("small.zip" if i % 10 == 0 else "é.zip", f"é{i}" if i % 2 else f"n{i}"): (None if i % 9 == 0 else os.urandom(i % 7) + b"text " * (i % 40)) for i in range(1000)}
    archives.write_archives(spark.createDataFrame([(*k, v) for k, v in want.items()], "archive string, name string, content binary").repartition(5), str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == sorted(["small.zip", "é.zip"])
    for archive in ("small.zip", "é.zip"):
        with zipfile.ZipFile(tmp_path / archive) as z:
            assert z.testzip() is None
            assert {n: z.read(n) for n in z.namelist()} == {n: v or b"" for (a, n), v in want.items() if a == archive}
    found = archives.members(spark, str(tmp_path)).collect()
    assert sorted((os.path.basename(r["archive"]), r["name"], bytes(r["content"])) for r in found) == sorted((a, n, v or b"") for (a, n), v in want.items())
    lots = archives.lots(spark, str(tmp_path)).collect()
    assert sum(r["count"] for r in lots) == 1000 and max(r["count"] for r in lots) == 70


def test_members_far_apart_or_large_are_read_each(spark, tmp_path, monkeypatch):
    bodies = {f"{i}.txt": os.urandom(n) for i, n in enumerate([10, 3_000, 0, 50_000, 20, 20, 20_000])}
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_STORED) as z:
        for name, body in bodies.items():
            info = zipfile.ZipInfo(name)
            info.extra = b"\x99\x99" + (100).to_bytes(2, "little") + b"e" * 100  # longer than the entry's name tells
            z.writestr(info, body)
    monkeypatch.setattr(archives, "BATCH_BYTES", 2_000)
    for names in (None, "[0346]"):
        with archives.opened(str(tmp_path / "a.zip")) as f:
            rows = [r for r in archives.entries(f) if names is None or r[0][0] in names]
            batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["name", "offset", "compressed", "size", "method", "crc"])
            got = [(names.to_pylist(), found) for names, found in archives.contents(f, batch.take(pa.array(range(len(rows))[::-1])))]
        assert len(got) > 1 and {n: c for ns, cs in got for n, c in zip(ns, cs)} == {r[0]: bodies[r[0]] for r in rows}


def test_damaged_members_are_told(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x", b"hello hello hello")
        info = z.infolist()[0]
    with archives.opened(f"file:{path}") as f:
        assert archives.member(f, info.header_offset, info.compress_size, info.file_size, info.compress_type, info.CRC) == b"hello hello hello"
        for wrong in ({"offset": 3}, {"crc": 1}, {"method": 99}):
            with pytest.raises(ValueError):
                archives.member(f, **({"offset": info.header_offset, "compressed": info.compress_size, "size": info.file_size, "method": info.compress_type, "crc": info.CRC} | wrong))


def test_batches_are_bounded():
    docs = [(str(i), "x" * n) for i, n in enumerate([10] * 7 + [500, 10, 10])]
    got = list(bulk.batches(iter(docs), 3, 200))
    assert [len(b) // 2 for b in got] == [3, 3, 1, 1, 2] and sum(len(b) for b in got) == 20
    assert all(sum(len(x) + 1 for x in b) <= 200 or len(b) == 2 for b in got)


SCHEMA = "k int, v string"


def documents(spark, path):
    return {r["k"]: r["v"] for r in bulk.read_documents(spark, path, SCHEMA).collect()}


def test_documents_come_whole_or_not(spark, tmp_path):
    path = str(tmp_path / "out")
    assert documents(spark, path) == {}
    bulk.write_documents(spark.createDataFrame([(i, f"a{i}") for i in range(230)], SCHEMA).repartition(3), path, "k")
    assert documents(spark, path) == {i: f"a{i}" for i in range(230)}
    files = [f for _, _, names in os.walk(f"{path}/batches") for f in names if f.endswith(".ndjson")]
    assert len(files) >= 5

    def broken(parts):
        for p in parts:
            if (p["k"] == 77).any():
                raise ValueError("this task dies")
            yield p

    from pyspark.errors import PythonException
    with pytest.raises(Exception) as e:
        bulk.write_documents(spark.createDataFrame([(i, f"b{i}") for i in range(90)], SCHEMA).repartition(4).mapInPandas(broken, SCHEMA), path, "k")
    assert isinstance(e.value, PythonException) or "this task dies" in str(e.value)
    assert documents(spark, path) == {i: f"a{i}" for i in range(230)}  # nothing of it is seen
    bulk.write_documents(spark.createDataFrame([(5, "c"), (5, "c"), (6, "d")], SCHEMA), path, "k")
    assert documents(spark, path) == {5: "c", 6: "d"}  # what was there before is gone
    assert not os.path.exists(f"{path}/_attempts") or not os.listdir(f"{path}/_attempts")
    with open(f"{path}/current.json") as f:
        assert json.load(f)["documents"] == 2


def test_a_failing_commit_leaves_the_last_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    bulk.write_documents(spark.createDataFrame([(1, "a")], SCHEMA), path, "k")
    writer = bulk.BulkWriter({"path": path, "commit": "next"})
    message = bulk.Written(f"{path}/_attempts/next/0-x", ["gone.ndjson"], 1)
    with pytest.raises(OSError):
        writer.commit([message])
    assert documents(spark, path) == {1: "a"}
    writer.abort([message])


def test_ids_are_needed(spark, tmp_path):
    with pytest.raises(Exception, match="k is null"):
        bulk.write_documents(spark.createDataFrame([(None, "a")], SCHEMA), str(tmp_path / "out"), "k")


def test_batches_for_a_service(spark):
    sent, calls = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def send(rows):
        sent.add(sum(r["id"] for r in rows))
        calls.add(1)

    writers.for_each_batch(spark.range(0, 200, 1, 2), send, 30)
    assert (sent.value, calls.value) == (19900, 8)
