"""The keyed table: what loads change, what they read, and what they leave alone."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.sinks.keyed import KeyedTable

SCHEMA = "source_id bigint, rank int, v string"


def files_below(path):
    found = {}
    for base, _, names in os.walk(path):
        found |= {os.path.join(base, n): os.stat(os.path.join(base, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def content(table):
    return sorted(((r.source_id, r.v) for r in table.rows().collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), range_rows=100)


def frame(spark, keys, v, rank=0):
    return spark.createDataFrame([(k, rank, v) for k in keys], SCHEMA)


def test_loads_split_into_ranges_and_touch_few(spark, table):
    first = table.insert_new(frame(spark, range(1000), "a"), ["rank"])
    assert first.inserted == 1000 and first.read == []
    ranges = table.ranges()
    assert len(ranges) == 10 and sum(r["rows"] for r in ranges) == 1000 and max(r["rows"] for r in ranges) <= 200
    before = files_below(f"{table.path}/rows")
    got = table.upsert(frame(spark, [5, 6, 5], "b"), ["rank"])
    assert got[:3] == (0, 2, 1) and got.read == got.rewritten and len(got.rewritten) == 1
    after = files_below(f"{table.path}/rows")
    kept = {p: t for p, t in before.items() if p in after}
    assert len(kept) == len(ranges) - 1 and all(after[p] == t for p, t in kept.items())
    assert content(table) == sorted([(k, "b" if k in (5, 6) else "a") for k in range(1000)], key=repr)
    # Once more: the same rows, and still the other ranges' files.
    table.upsert(frame(spark, [5, 6], "b"), ["rank"])
    assert {p: t for p, t in files_below(f"{table.path}/rows").items() if p in kept} == kept
    assert content(table) == sorted([(k, "b" if k in (5, 6) else "a") for k in range(1000)], key=repr)


def test_new_keys_read_no_data_file(spark, table):
    table.insert_new(frame(spark, range(0, 1000, 2), "a"), ["rank"])
    files = files_below(f"{table.path}/rows")
    whole = {p: open(p, "rb").read() for p in files}
    for p in files:
        with open(p, "wb") as f:
            f.write(b"no parquet file")
    got = table.insert_new(frame(spark, [10**9 + k for k in range(3)], "b"), ["rank"])
    assert got == (3, 0, 0, [], [])
    for p, data in whole.items():
        with open(p, "wb") as f:
            f.write(data)
        if os.path.exists(os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc")):
            assert open(p, "rb").read() == data
    assert len(content(table)) == 503


def test_repeated_loads_and_counts(spark, table):
    rows = frame(spark, [1, 2, 3, None, None], "a")
    assert table.insert_new(rows, ["rank"])[:3] == (4, 0, 1)
    assert table.insert_new(rows, ["rank"])[:3] == (0, 0, 5)
    assert table.upsert(frame(spark, [None, 9], "b", 1), ["rank"])[:3] == (1, 1, 0)
    assert content(table) == sorted([(1, "a"), (2, "a"), (3, "a"), (None, "b"), (9, "b")], key=repr)
    assert table.insert_new(rows.limit(0), ["rank"])[:3] == (0, 0, 0)


def test_many_small_writes_are_put_together(spark, table, monkeypatch):
    monkeypatch.setattr("starloom.sinks.keyed.MOST_WRITES", 2)
    for k in range(5):
        table.insert_new(frame(spark, [k], "a"), ["rank"])
    assert max(len(r["writes"]) for r in table.ranges()) <= 3 and len(content(table)) == 5
    assert len(os.listdir(f"{table.path}/versions")) <= 3


def test_an_unfinished_load_changes_nothing(spark, table, monkeypatch):
    table.insert_new(frame(spark, range(50), "a"), ["rank"])
    monkeypatch.setattr(KeyedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.upsert(frame(spark, range(10), "b"), ["rank"])
    monkeypatch.undo()
    assert {v for _, v in content(table)} == {"a"} and len(content(table)) == 50
    table.upsert(frame(spark, range(10), "b"), ["rank"])
    assert sorted(k for k, v in content(table) if v == "b") == list(range(10))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.lists(st.integers(-300, 300) | st.none(), max_size=40)), min_size=2, max_size=4))
def test_loads_equal_a_dictionary(spark, tmp_path_factory, loads):
    table, want = KeyedTable(spark, str(tmp_path_factory.mktemp("t")), range_rows=16), {}
    for n, (replace, keys) in enumerate(loads):
        batch = spark.createDataFrame([(k, i, f"{n}-{i}") for i, k in enumerate(keys)], SCHEMA)
        (table.upsert if replace else table.insert_new)(batch, ["rank"])
        first = {}
        for i, k in enumerate(keys):
            first.setdefault(k, f"{n}-{i}")
        want = want | first if replace else first | want
    assert (content(table) if table.rows() is not None else []) == sorted(want.items(), key=repr)


def test_places_by_compiled_search(spark, table):
    """Every number of ranges, with keys at, between, below and beyond the lows; no search is interpreted."""
    keys = [None, -(2**63), -7, 0, 9, 10, 11, 55, 90, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "source_id bigint")
    for n in (1, 2, 3, 4, 9, 10):
        ranges = [{"range": 100 - i, "low": None if i == 0 else 10 * i} for i in range(n)]
        placed = table._placed(df, ranges)
        want = {k: 100 - (0 if k is None else sum(10 * i <= k for i in range(1, n))) for k in keys}
        assert {r["source_id"]: r["_range"] for r in placed.collect()} == want
        assert "lambda" not in placed._jdf.queryExecution().optimizedPlan().toString()


def test_many_ranges_are_listed_by_few_tasks(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "many"), range_rows=10)
    table.insert_new(frame(spark, range(900), "a"), ["rank"])
    assert len(table.ranges()) > 70
    before, ahead = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism"), set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    rows = table.rows()
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in set(tracker.getJobIdsForGroup(None)) - ahead]
    assert max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds) <= 64
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert rows.count() == 900 and table.insert_new(frame(spark, range(890, 910), "b"), ["rank"])[:3] == (10, 0, 10)
