import gzip
import hashlib
import json
import os
from contextlib import contextmanager

import pytest
from pyspark.sql import types as T

from starloom import schemas
from starloom.plans import objects, publish, stars, worklist
from starloom.session import shared_root, staging, staging_path, staged
from starloom.sinks.keyed import KeyedTable
from starloom.sources import labels, pages, streams, tables
from starloom.sources.arrays import array_rows
from starloom.sources.tables import survey_files
from starloom.streaming import arrivals

HEADER = [*schemas.RAW_COLUMNS, "extra"]


def write_source(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    lines = ["# a comment", "# another", ",".join(HEADER)]
    lines += [",".join(str(r.get(c, "null")) for c in HEADER) for r in rows]
    with gzip.open(os.path.join(folder, name), "wt") as f:
        f.write("\n".join(lines) + "\n")


def star(i, **more):
    return {
        "source_id": i,
        "ra": i % 360,
        "dec": i % 90,
        "parallax": 1 + i % 5,
        "parallax_error": 0.1,
        "parallax_over_error": 10 * (1 + i % 5),
        "phot_g_mean_mag": 10,
        **more,
    }


def test_survey_files(spark, tmp_path):
    write_source(tmp_path / "s", "a.csv.gz", [star(1, pseudocolour="NaN"), star(2, grvs_mag="null")])
    write_source(tmp_path / "s", "b.csv.gz", [star(3, parallax="null")])
    df = survey_files(spark, str(tmp_path / "s"))
    assert df.columns == list(schemas.RAW_COLUMNS)
    rows = {r.source_id: r for r in df.collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1].pseudocolour is None and rows[2].grvs_mag is None and rows[3].parallax is None
    assert rows[1].parallax_error == 0.1


def test_ingest_and_load_are_idempotent(spark, tmp_path):
    source, filtered, table = (str(tmp_path / n) for n in ("s", "f", "t"))
    write_source(source, "a.csv.gz", [star(i) for i in range(50)])
    write_source(source, "b.csv.gz", [star(i, parallax_over_error=1) for i in range(100, 120)])
    for _ in range(2):
        stars.ingest(spark, source, filtered)
        sizes, totals = stars.load(spark, filtered, table)
    assert totals.first().equal and totals.first().table_rows == 50
    assert [(r.file_id, r.rows, r.running) for r in sizes.collect()] == [("a.csv.gz", 50, 50)]
    write_source(source, "c.csv.gz", [star(i) for i in range(200, 230)])
    stars.ingest(spark, source, filtered)
    stars.load(spark, filtered, table)
    assert spark.read.parquet(table).count() == 80
    stars.cluster(spark, table, str(tmp_path / "clustered"))
    assert spark.read.parquet(str(tmp_path / "clustered")).count() == 80


def test_files_are_known_by_their_path_and_loaded_whole(spark, tmp_path):
    source, filtered, table = (str(tmp_path / n) for n in ("s", "f", "t"))
    write_source(f"{source}/n", "a.csv.gz", [star(i) for i in range(10)])
    write_source(f"{source}/s", "a.csv.gz", [star(i) for i in range(100, 112)])
    # The smallest key of this file is in another one as well.
    write_source(source, "b.csv.gz", [star(0), star(300), star(301)])
    stars.ingest(spark, source, filtered)
    stars.load(spark, filtered, table)
    assert spark.read.parquet(table).count() == 25
    write_source(source, "c.csv.gz", [star(0), star(400)])
    for _ in range(2):
        stars.ingest(spark, source, filtered)
        sizes, totals = stars.load(spark, filtered, table)
        assert totals.first().equal and totals.first().table_rows == 27
    assert {(r.file_id, r.rows) for r in sizes.collect()} == {
        ("n/a.csv.gz", 10), ("s/a.csv.gz", 12), ("b.csv.gz", 3), ("c.csv.gz", 2)}


def write_by(folder, name, columns, rows, zipped=True):
    os.makedirs(folder, exist_ok=True)
    lines = ["# by its own header", ",".join(columns)] + [",".join(str(r.get(c, "null")) for c in columns) for r in rows]
    with (gzip.open if zipped else open)(os.path.join(folder, name), "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    source, log, out = (str(tmp_path / n) for n in ("s", "l", "o"))
    write_source(source, "a.csv.gz", [star(i) for i in range(5)])
    swapped = [{"ra": "dec", "dec": "ra"}.get(c, c) for c in HEADER]
    write_by(source, "b.csv.gz", swapped, [star(i) for i in range(5, 9)])
    write_by(f"{source}/n", "c.csv", ["more", *reversed(HEADER)], [star(i) for i in range(9, 12)], zipped=False)
    write_by(source, "empty.csv", [], [], zipped=False)
    got = {r.source_id: r for r in survey_files(spark, source, file_column="file").collect()}
    want = {i: star(i) for i in range(12)}
    assert set(got) == set(want) and all(got[i].ra == want[i]["ra"] and got[i].dec == want[i]["dec"] for i in want)
    assert {r.file.rsplit("/", 1)[-1] for r in got.values()} == {"a.csv.gz", "b.csv.gz", "c.csv"}
    raw = arrivals.arriving(spark, source, files_per_trigger=1)
    arrivals.run_to_files(raw, out, log).awaitTermination()
    streamed = spark.read.parquet(out)
    batch = survey_files(spark, source)
    assert streamed.columns == batch.columns
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    write_by(source, "d.csv", HEADER[1:], [star(20)], zipped=False)
    with pytest.raises(ValueError, match="source_id.*d.csv"):
        survey_files(spark, source)


def test_headers_by_scan_where_files_cannot_be_opened(spark, tmp_path, monkeypatch):
    write_source(str(tmp_path / "s"), "a.csv.gz", [star(1)])
    write_by(str(tmp_path / "s"), "b.csv", ["dec", *[c for c in HEADER if c != "dec"]], [star(2)], zipped=False)
    direct = tables.header_groups(spark, str(tmp_path / "s"))
    broken = spark.createDataFrame([("x", None, "no such store")], "path string, header string, error string")
    monkeypatch.setattr(tables, "with_headers", lambda *a: broken)
    by_scan = tables.header_groups(spark, str(tmp_path / "s"))
    names = [{h: sorted(p.rsplit("/", 1)[-1] for p in files) for h, files in g.items()} for g in (direct, by_scan)]
    assert names[0] == names[1] and len(names[0]) == 2


def test_array_lines_give_every_row_or_fail(spark, tmp_path):
    folder = tmp_path / "arrays"
    folder.mkdir()
    (folder / "d.js").write_text('var d = [[1.0,2.0],[3.0,4.0]]\n')
    (folder / "e.js").write_text('var e = [\n[5.0,6.0],\n[7.0,"a [b]"]\n]\n')
    rows = array_rows(spark, str(folder), T.StructType().add("x", "double").add("y", "string"))
    assert sorted((r.x, r.y) for r in rows.collect()) == [(1.0, "2.0"), (3.0, "4.0"), (5.0, "6.0"), (7.0, "a [b]")]
    (folder / "f.js").write_text("var f = [[1.0,\n2.0]]\n")
    with pytest.raises(Exception, match="not array rows"):
        array_rows(spark, str(folder), T.StructType().add("x", "double")).collect()


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("s", "o", "l"))
    write_source(source, "a.csv.gz", [star(i) for i in range(40)])

    def run():
        raw = arrivals.arriving(spark, source, files_per_trigger=1)
        arrivals.run_to_files(arrivals.star_stream(raw), out, log).awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 40
    write_source(source, "b.csv.gz", [star(i) for i in range(100, 130)])
    got = run()
    batch = stars.loadable(stars.ingested(survey_files(spark, source)))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert run().count() == 70


def test_keyed_stream_ignores_repeated_stars(spark, tmp_path):
    source, out = str(tmp_path / "s"), str(tmp_path / "o")
    write_source(source, "a.csv.gz", [star(i) for i in range(40)])
    write_source(source, "b.csv.gz", [star(i) for i in range(20, 60)])
    raw = arrivals.arriving(spark, source, files_per_trigger=1)
    query = arrivals.run_keyed(arrivals.star_stream(raw), out, str(tmp_path / "l"), ["dist"])
    query.awaitTermination()
    ids = [r[0] for r in KeyedTable(spark, out).rows().select("source_id").collect()]
    assert sorted(ids) == list(range(60))


def test_another_version_of_a_file_is_loaded(spark, tmp_path):
    source, filtered, table = (str(tmp_path / n) for n in ("s", "f", "t"))
    for version, mag in ((0, 10), (1, 12)):
        write_source(source, "a.csv.gz", [star(i, phot_g_mean_mag=mag) for i in range(20)])
        write_source(source, "b.csv.gz", [star(i) for i in range(50, 60)])
        stars.ingest(spark, source, filtered)
        for compare in (False, True, True):
            stars.load(spark, filtered, table, compare=compare)
        rows = spark.read.parquet(table)
        assert rows.count() == 30
        found = {round(r.m - r.d, 6) for r in rows.filter("source_id < 20").selectExpr("abs_mag m", "5 - 5 * log10(dist * 3.261563777) d").collect()}
        assert found == {mag - 0.25}


@contextmanager
def small_blocks(spark, size=1024):
    """Files in blocks of `size` bytes, as very large ones would be."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pages_are_cut_by_many_tasks(spark, tmp_path):
    for page, stop in (("a", 150), ("b", None), ("c", 1)):
        lines = [f"{page} line {n}" + (" (end)" if stop and n in (stop, stop + 7) else "") for n in range(1, 301)]
        (tmp_path / f"{page}.txt").write_text("\n".join(lines) + "\n")
    with small_blocks(spark):
        every = pages.numbered_lines(spark, str(tmp_path))
        assert every.rdd.getNumPartitions() > 3
        got = pages.lines_through(every, "(end)").collect()
    assert all(r.line.removesuffix(" (end)") == f"{r.page[-5]} line {r.n}" for r in got)
    assert sorted((p, sum(r.page.endswith(f"{p}.txt") for r in got)) for p in "abc") == [("a", 150), ("b", 300), ("c", 1)]


def test_rows_over_several_lines_are_read_by_many_tasks(spark, tmp_path):
    folder = tmp_path / "wrapped"
    folder.mkdir()
    rows = [(float(i), f"star {i}") for i in range(200)]
    (folder / "a.js").write_text("var a = [" + ",\n".join(f'[{x},\n  "{n}"\n]' for x, n in rows) + "];\n")
    odd = [(0.5, "a [b]"), (1.5, 'q " ] "'), (2.5, "]]"), (3.5, "back \\")]
    schema = T.StructType().add("x", "double").add("name", "string")
    with small_blocks(spark):
        read = array_rows(spark, str(folder), schema, wrapped=True)
        assert sorted((r.x, r.name) for r in read.collect()) == rows
        (folder / "b.js").write_text("var b = [" + ",".join(f"[{x},\n{json.dumps(n)}]" for x, n in odd * 30) + "]")
        read = array_rows(spark, str(folder), schema, wrapped=True)
        assert sorted((r.x, r.name) for r in read.collect()) == sorted(rows + odd * 30)
    (folder / "c.js").write_text("var c = [[1.0,2.0], nonsense [3.0,4.0]]")
    with pytest.raises(Exception, match="not array rows"):
        array_rows(spark, str(folder), schema, wrapped=True).collect()


def test_bins_are_put_together_over_many_batches(spark, tmp_path):
    path, source = str(tmp_path / "bins"), str(tmp_path / "source")
    schema = "x double, y double, z double, color double"
    want = {}
    for batch in range(26):
        rows = [(float(10 * (i % (batch + 1))), 0.0, 0.0, float(batch)) for i in range(5)]
        for x, _, _, c in rows:
            want.setdefault(int(x // 10), []).append(c)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        if batch % 6 == 5:  # several batches a run; each run resumes
            stars = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
            stream = arrivals.bin_stream(stars, 10, "color")
            arrivals.run_bins(stream, path, str(tmp_path / "log"), most=4).awaitTermination()
            folders = sum(len(os.listdir(f"{path}/{n}")) for n in ("changes", "snapshots") if os.path.isdir(f"{path}/{n}"))
            assert folders <= 10
            got = {r.x: (r.rows, r["mean"]) for r in arrivals.latest_bins(spark, path).collect()}
            assert got == {x: (len(c), pytest.approx(sum(c) / len(c))) for x, c in want.items()}


def test_lines_through_the_first_marker(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo end\nthree end\n")
    (tmp_path / "b.txt").write_text("four\nfive\n")
    kept = pages.lines_through(pages.numbered_lines(spark, str(tmp_path)), "end")
    assert sorted(r.line for r in kept.collect()) == ["five", "four", "one", "two end"]


def test_verify_folder(spark, tmp_path):
    (tmp_path / "files").mkdir()
    for name, text in (("a.gz", b"abc"), ("b.gz", b"xyz")):
        (tmp_path / "files" / name).write_bytes(text)
    sums = spark.createDataFrame(
        [(hashlib.md5(b"abc").hexdigest(), "a.gz"), (hashlib.sha1(b"other").hexdigest(), "b.gz")],
        "hash string, filename string",
    )
    (tmp_path / "files" / "c d.gz").write_bytes(b"no checksum")
    got = worklist.verify_folder(spark, str(tmp_path / "files"), sums, "*.gz").collect()
    assert {r.filename: (r.length, r.intact) for r in got} == {"a.gz": (3, True), "b.gz": (3, False), "c d.gz": (11, None)}
    assert all(r.error is None for r in got)


def test_files_are_read_in_pieces(tmp_path):
    data = bytes(range(256)) * 41
    (tmp_path / "f").write_bytes(data)
    for piece in (1, 7, 4096, 1 << 20):
        sizes = []

        class Watched:
            def __init__(self, source):
                self.source = source

            def read(self, n):
                part = self.source.read(n)
                sizes.append(len(part))
                return part

        with streams.opened(f"file:{tmp_path}/f") as source:
            got = streams.stream_digest(Watched(source), "sha512", piece)
        assert got == (len(data), hashlib.sha512(data).hexdigest()) and max(sizes) <= piece


def test_files_that_cannot_be_read_are_reported(spark, tmp_path):
    (tmp_path / "short").write_bytes(b"abc")
    md5 = hashlib.md5(b"abc").hexdigest()
    files = spark.createDataFrame(
        [(f"file:{tmp_path}/short", 3, md5.upper()), (f"file:{tmp_path}/short", 4, md5), (f"file:{tmp_path}/gone", 3, md5),
         ("nowhere://host/x", 1, md5), (f"file:{tmp_path}/short", 3, "abc"), (f"file:{tmp_path}/short", 3, None)],
        "path string, length bigint, hash string")
    got = [(r.path.rsplit("/", 1)[-1], r.length, r.digest, r.error) for r in streams.with_digests(files).collect()]
    assert sorted(x[:3] for x in got if x[3] is None and x[2]) == [("short", 3, md5)]
    assert len([x for x in got if x[2] is None and x[3] is None]) == 2
    reasons = {(x[0], x[1]): x[3] for x in got if x[3]}
    assert reasons["short", 4] == "3 of 4 bytes" and "gone" in reasons["gone", 3] and ("x", 1) in reasons


def test_state_of_listed_files(spark):
    work = spark.createDataFrame([(e, f"{e}.gz") for e in "abcdefg"], "element string, filename string")
    seen = spark.createDataFrame(
        [("a.gz", 1, True, None), ("b.gz", 1, False, None), ("c.gz", 1, None, None), ("d.gz", 1, False, "lost"), ("e.gz", 1, True, None),
         ("g.gz", 1, True, None), ("g.gz", 2, False, None)], "filename string, length bigint, intact boolean, error string")
    rows = spark.createDataFrame([("a", 20_000), ("e", 19_999)], "element string, rows bigint")
    got = {r.element: r.state for r in worklist.checked(work, seen, rows).collect()}
    assert got == {"a": "good", "b": "damaged", "c": "no checksum", "d": "unread", "e": "few rows", "f": "missing", "g": "damaged"}
    assert {r.state for r in worklist.checked(work.filter("element IN ('a', 'e')"), seen).collect()} == {"good"}


def test_published_sets_and_neighbourhood(spark, star_frame, tmp_path):
    rows = [(i, 100.0, float(i), 0.0, 0.0, float(i), 1.0, -4.0) for i in range(1, 400)]
    df = star_frame(rows)
    publish.write_sets(df, str(tmp_path / "sets"), publish.STAR_SETS[:2])
    lines = spark.read.text(str(tmp_path / "sets"))
    assert lines.select("set_name").distinct().count() == 2
    assert lines.filter("set_name = 'snr20-dist5000-mag15'").count() == 399
    # No set at all when all are too large.
    assert publish.set_slices(df, limit=10).count() == 0
    placed = spark.createDataFrame(
        [(300.0, 1.0, 1.0, 300.0, "near"), (None, None, None, 1.0, "unplaced")],
        "x double, y double, z double, dist double, name string",
    )
    objects.write_neighbourhood(df, placed, str(tmp_path / "near"))
    near = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "near" / "stars"))
    # The box goes from 120 to 480 along x and around 0 along y and z.
    assert near.count() == len(range(121, 400))


def test_files_by_their_own_column_names(spark, tmp_path):
    (tmp_path / "older.csv").write_text(
        "v_mag,note,HIP,RA,DE,Plx,B-V\n5.5,x,1,10.0,-20.0,2.0,0.5\n,y,2,11,21,-,NaN\n6,z,3,n/a,21,deep,0.1\n7,w,12345678901234567890,1,1,1,1\n")
    columns = {"hip": "HIP", "ra": "RA", "dec": "DE", "plx": "Plx", "mag": "v_mag", "colour": "B-V"}
    rows, unread = labels.listed_file(spark, str(tmp_path / "older.csv"), labels.CATALOGUE, columns)
    assert [tuple(r)[:6] for r in rows.orderBy("pos").collect()] == [
        (1, 10.0, -20.0, 2.0, 5.5, 0.5), (2, 11.0, 21.0, None, None, None)]
    found = labels.all_rejected({"older": unread}).orderBy("pos").collect()
    assert [(r.file, r.unreadable, json.loads(r.row)["mag"]) for r in found] == [("older", "ra,plx", "6"), ("older", "hip", "7")]


def test_labels_from_files_scan_the_stars_twice(spark, tmp_path, star_frame, monkeypatch):
    star_frame([(7, 10.0, 1.0, 2.0, 3.0, 4.0, 1.0, 2.0), (70, 10.0, 5.0, 6.0, 7.0, 8.0, 1.0, 2.0)]).write.parquet(str(tmp_path / "stars"))
    stars_read = spark.read.parquet(str(tmp_path / "stars"))
    texts = {
        "first.csv": "Name,HIP\nAlpha,1\nBeta,2\nnone,-\n", "second.csv": "Name,HIP\nGamma,1\n",
        "ids.txt": "oid|id\n---+---\n5|HIP 2\n5|NAME Two \n6|NAME Alone \n6|Gaia DR3 70\n",
        "near.csv": "hip,source_id\n1,7\n", "newer.csv": "hip,ra,dec,plx,mag,colour\n2,0,0,3261.563777,4,0.5\nx,1,1,1,1,1\n",
        "older.csv": "hip,ra,dec,plx,mag,colour\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    at = {n: str(tmp_path / n) for n in texts}
    listed = {"hip": "HIP", "name": "Name"}
    files = objects.LabelFiles((at["first.csv"], listed), (at["second.csv"], listed), at["ids.txt"], at["near.csv"], at["newer.csv"], at["older.csv"])
    scans = []
    real = objects.C.star_positions
    monkeypatch.setattr(objects.C, "star_positions", lambda stars, keys: scans.append(1) or real(stars, keys))
    inputs, _ = objects.read_labels(spark, files, stars_read)
    outputs = objects.label_outputs(inputs)
    assert len(scans) == 2
    for df in outputs.values():
        assert str(tmp_path / "stars") not in df._jdf.queryExecution().executedPlan().toString()
    objects.labels_from_files(spark, files, stars_read, str(tmp_path / "out"))
    lines = {n: [r.value for r in spark.read.text(str(tmp_path / "out" / n)).collect()] for n in outputs}
    assert lines["star_labels"] == ['var star_labels = [[1.0,2.0,3.0,"Alpha / Gamma"]]']
    assert lines["catalogue_labels"] == ['var catalogue_labels = [[1.0,0.0,0.0,"Beta"]]']
    assert lines["source_labels"] == ['var source_labels = [[5.0,6.0,7.0,"Alone"]]']
    gone = spark.read.parquet(str(tmp_path / "out" / "rejected")).collect()
    assert [(r.file, r.unreadable) for r in gone] == [("newer", "hip")]


def test_nebulae_from_a_file(spark, tmp_path):
    (tmp_path / "n.tsv").write_text(
        "dist|ra_text|dec_text|name|fieldradius_text|rotation_deg|dirname\n"
        "100|0h 0m 0s|+0° 0′ 0″|Here|10 arcmins|5|here\n100|unknown|+1° 0′ 0″|Nowhere|10|5|no\nfar|0h 0m 0s|+0° 0′ 0″|Far|10|5|far\n")
    objects.nebulae_from_file(spark, str(tmp_path / "n.tsv"), str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out" / "nebulae")).collect()]
    assert len(lines) == 1 and '"Here"' in lines[0]
    gone = spark.read.parquet(str(tmp_path / "out" / "rejected")).orderBy("pos").collect()
    assert [(r.unreadable, json.loads(r.row)["name"]) for r in gone] == [("ra_text,dec_text", "Nowhere"), ("dist", "Far")]


def test_rejected_clusters(spark):
    df = spark.createDataFrame(
        [(10.0, "04^h 26.9^m", "+15° 52′", "good"), (10.0, "soon", "+15° 52′", "bad")],
        "dist_pc double, ra_text string, dec_text string, name string",
    )
    placed = objects.placed_clusters(df)
    assert [r.name for r in objects.rejected(placed).collect()] == ["bad"]
    assert objects.rejected(objects.placed_clusters(df, "zero")).count() == 0


def test_staged_tables_are_dropped_after_a_job(spark):
    assert shared_root(spark)
    with staging(spark):
        rows = staged(spark.range(10), "scoped")
        files = rows.inputFiles()
        assert rows.count() == 10
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    kept = staged(spark.range(10), "kept")
    assert kept.count() == 10 and staging_path(spark, "a") != staging_path(spark, "a")


def test_star_scan_prunes_and_pushes_down(spark, star_frame, tmp_path):
    from starloom.operators.sets import STAR_SETS, set_counts
    from starloom.sources.tables import star_table

    path = str(tmp_path / "t")
    star_frame([(1, 100.0, 1.0, 1.0, 1.0, 10.0, 1.0, 1.0)]).write.parquet(path)
    df = star_table(spark, path, STAR_SETS[0].predicate(), ["source_id", "x"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(px_over_err,20.0)" in plan
    assert "ReadSchema: struct<source_id:bigint,px_over_err:double,x:double," in plan
    scan = set_counts(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<px_over_err:double,dist:double,abs_mag:double>" in scan
    assert scan.count("FileScan") == 1
