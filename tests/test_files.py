"""Files of their own names, written by tasks."""

import hashlib
import os

import pytest

from registry.fixtures import write_named_files
from starloom import folders
from starloom.plans import worklist
from starloom.sinks.files import write_files
from starloom.sources.streams import listed_by_tasks, listed_files, store_of, with_digests


def test_named_files_cost_the_driver_no_call_each(spark, tmp_path, monkeypatch):
    calls, at = [], folders._at
    monkeypatch.setattr(folders, "_at", lambda *a: calls.append(a) or at(*a))
    rows = spark.range(300).selectExpr("concat('f_', id, '.csv.gz') AS filename", "if(id = 7, '', concat('é', id)) AS content")
    path = write_named_files(rows, str(tmp_path / "named"))
    assert len(calls) <= 2
    found = {os.path.basename(r["path"]): r["length"] for r in listed_files(spark, path).collect()}
    assert found == {f"f_{i}.csv.gz": len(f"é{i}\n".encode()) if i != 7 else 1 for i in range(300)}


def test_files_written_again_are_replaced(spark, tmp_path):
    path = str(tmp_path / "again")
    for text in ("first", "other text"):
        write_files(spark.createDataFrame([("a b=c", bytearray(text.encode())), ("x", bytearray())], "filename string, content binary"), path)
    found = {os.path.join(base, n) for base, _, names in os.walk(path) for n in names if not n.endswith(".crc")}
    assert {os.path.basename(f): open(f, "rb").read() for f in found} == {"a b=c": b"other text", "x": b""}


def test_a_folder_is_verified_without_its_files_on_the_driver(spark, tmp_path):
    rows = spark.range(300).selectExpr("concat('f_', id, '.csv.gz') AS filename", "concat('é', id) AS content")
    path = write_named_files(rows, str(tmp_path / "named"))
    sums = spark.createDataFrame(
        [(hashlib.md5(f"é{i}{'?' if i % 3 == 0 else ''}\n".encode()).hexdigest(), f"f_{i}.csv.gz") for i in range(300) if i % 5], "hash string, filename string")
    found = worklist.verify_folder(spark, path, sums)
    # Spark's reader has the driver hold every file, and a task for some 30 of them.
    assert "binaryFile" not in found._jdf.queryExecution().toString()
    got = {r.filename: (r.length, r.intact, r.error) for r in found.collect()}
    assert got == {f"f_{i}.csv.gz": (len(f"é{i}\n".encode()), bool(i % 3) if i % 5 else None, None) for i in range(300)}


@pytest.mark.parametrize("tasks", [1, 24])
def test_files_listed_by_tasks_are_those_that_spark_sees(spark, tmp_path, monkeypatch, tasks):
    # With few tasks the folders on top are enough, and tasks go down from there.
    monkeypatch.setattr("starloom.sources.streams.TASKS_PER_CORE", tasks)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 1)
    names = ("a.gz", "b c.gz", "é.gz", "k=1", "a%20b", ".h", "_s", "_s=1", "_common_metadata1", "x._COPYING_", "a,b", "n\nl", "q[1]")
    for folder in ("", "in", "in/deep/er", "_d", "_d=1", ".d", "_metadata", "c._COPYING_", "é d"):
        os.makedirs(tmp_path / folder, exist_ok=True)
        for name in names:
            (tmp_path / folder / name).write_text(name)
        (tmp_path / folder / "empty.gz").write_bytes(b"")
    os.symlink("a.gz", tmp_path / "link")
    os.symlink("nothing", tmp_path / "broken")
    for path, pattern in ((tmp_path, None), (tmp_path / "a.gz", None), (tmp_path / "[a-z]*", None),
                          (tmp_path, "{a,b c}.gz"), (tmp_path, "[^a]*"), (tmp_path, "n?l")):
        want = listed_files(spark, str(path), pattern).collect()
        assert sorted(listed_by_tasks(spark, str(path), pattern).collect()) == sorted(want)
    assert listed_by_tasks(spark, str(tmp_path)).count() > 40
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        listed_by_tasks(spark, str(tmp_path / "none")).collect()


def test_stores_are_opened_once_and_files_told_apart(spark, tmp_path):
    known = {}
    assert store_of("file:/a/b\nc", known)[1] == "/a/b\nc" and store_of("file:/d", known)[0] is store_of("file:/e", known)[0]
    files = []
    for i in range(50):
        (tmp_path / f"f{i}").write_text(str(i) * i)
        files.append((f"{'file:' if i % 2 else ''}{tmp_path}/f{i}", i, hashlib.sha1((str(i) * i).encode()).hexdigest() if i % 7 else "nowhere"))
    files = [(path, len(open(path.removeprefix("file:")).read()), wanted) for path, _, wanted in files]
    got = with_digests(spark.createDataFrame(files, "path string, length bigint, hash string").coalesce(1)).collect()
    assert sorted(map(tuple, got)) == sorted((*f, f[2] if f[2] != "nowhere" else None, None) for f in files)
