"""Growing files, ledgers, repeated batches, lost checkpoints, and hot keys."""

import os
import pickle
import struct
import tracemalloc
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from nightsift.operators import lightcurve, requests
from nightsift.plans import registry
from nightsift.sources import readers, sinks
from nightsift.streaming import jobs

T0 = datetime(2026, 5, 12, 12)
SF = "/root/testdata/sf0.001"
DONE = "x\nProcessing complete!"


def poll(spark, base, name="q", ledger=None, out="out"):
    """One look at the report files; what has ended goes to the output."""
    gate = jobs.completion_gate(jobs.stream_revisions(spark, f"{base}/in", f"{base}/log"), ledger=ledger)
    q = gate.writeStream.format("parquet").option("path", f"{base}/{out}").option("checkpointLocation", f"{base}/{name}").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return sorted((r.report_id, r.text) for r in spark.read.schema(jobs.REVISION).parquet(f"{base}/{out}").collect())


def put(base, name, text, mode="w"):
    os.makedirs(f"{base}/in/{name}", exist_ok=True)
    with open(f"{base}/in/{name}/index.html", mode, newline="") as f:
        f.write(text)


def test_growing_report_comes_once_at_its_end(spark, tmp_path):
    put(tmp_path, "results_a", "begun\r\n")
    put(tmp_path, "results_b", DONE)
    put(tmp_path, "other", DONE)  # no report directory
    assert poll(spark, tmp_path) == [("results_b", DONE)]
    assert poll(spark, tmp_path) == [("results_b", DONE)]  # nothing new
    put(tmp_path, "results_a", "more\n", "a")
    assert poll(spark, tmp_path) == [("results_b", DONE)]
    put(tmp_path, "results_a", "Processing complete!", "a")
    both = [("results_a", "begun\nmore\nProcessing complete!"), ("results_b", DONE)]
    assert poll(spark, tmp_path) == both
    put(tmp_path, "results_a", "\nand a late line", "a")
    put(tmp_path, "results_b", "\nlate", "a")
    assert poll(spark, tmp_path) == both
    old = (datetime.now() - timedelta(hours=13)).timestamp()
    put(tmp_path, "results_old", DONE)
    os.utime(f"{tmp_path}/in/results_old/index.html", (old, old))
    assert poll(spark, tmp_path) == both  # beyond the look-back


def test_lost_checkpoint(spark, tmp_path):
    """A new checkpoint that begins from the ledger combines what is new, and nothing twice."""
    put(tmp_path, "results_a", DONE)
    first = poll(spark, tmp_path)
    done = spark.read.schema(jobs.REVISION).parquet(f"{tmp_path}/out")
    sinks.append_ledger(done, f"{tmp_path}/ledger", "q-0")
    put(tmp_path, "results_c", DONE)
    assert first == [("results_a", DONE)]
    assert poll(spark, tmp_path, "fresh", sinks.read_ledger(spark, f"{tmp_path}/ledger"), "more") == [("results_c", DONE)]
    assert poll(spark, tmp_path, "without", None, "twice") == [("results_a", DONE), ("results_c", DONE)]


def test_end_to_end(spark, tmp_path, monkeypatch):
    """A batch that fails before the ledger, a restart, and a lost checkpoint: each report is combined once."""

    def run(name):
        q = jobs.combine_stream(spark, f"{tmp_path}/in", f"{tmp_path}/base", name, availableNow=True)
        q.awaitTermination(120)
        return q.exception()

    def combined():
        return sorted((r.report_id, r.text) for r in spark.read.parquet(f"{tmp_path}/base/combined").collect())

    put(tmp_path, "results_a", DONE)
    put(tmp_path, "results_b", "begun\n")
    assert run("one") is None and combined() == [("results_a", DONE)]
    put(tmp_path, "results_b", "Processing complete!", "a")
    append = sinks.append_ledger
    monkeypatch.setattr(sinks, "append_ledger", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        run("one")
    monkeypatch.setattr(sinks, "append_ledger", append)
    both = [("results_a", DONE), ("results_b", "begun\nProcessing complete!")]
    assert run("one") is None and combined() == both
    put(tmp_path, "results_c", DONE)
    assert run("two") is None and combined() == [*both, ("results_c", DONE)]
    assert {r.report_id for r in sinks.read_ledger(spark, f"{tmp_path}/base/ledger").collect()} == {"results_a", "results_b", "results_c"}


def test_revision_is_read_as_it_was_listed(tmp_path):
    from nightsift.sources.revisions import RevisionReader

    put(tmp_path, "results_a", "one")
    options = {"path": str(tmp_path / "in"), "log": str(tmp_path / "log")}
    reader = RevisionReader(options)
    end = reader.latestOffset()
    (part,) = reader.partitions(reader.initialOffset(), end)
    put(tmp_path, "results_a", " two", "a")
    assert [r[4] for r in reader.read(part)] == ["one"]
    later = RevisionReader(options)  # a restart: goes on from the log
    new = later.latestOffset()
    assert new["poll"] == end["poll"] + 1 and [r[4] for p in later.partitions(end, new) for r in later.read(p)] == ["one two"]
    assert later.latestOffset() == new
    later.commit(new)
    assert list(later.polls()) == [new["poll"]]
    assert [r[4] for p in later.partitions(later.initialOffset(), new) for r in later.read(p)] == ["one two"]  # from the beginning


def test_polls_are_compared_by_shards(tmp_path, monkeypatch):
    """The driver holds one shard of a poll's files, never all; parts are places in the polls and cover each last revision once."""
    from nightsift.sources.revisions import RevisionReader

    n, touched = 20_000, set()
    files = lambda: ((f"/in/results_20260219_{i}/index.html", 9 if i in touched else 5, i) for i in range(n))
    monkeypatch.setattr(RevisionReader, "listed", lambda self: files())
    options = {"path": "/in", "log": str(tmp_path / "log")}
    reader = RevisionReader(options)
    tracemalloc.start()
    ends = [reader.initialOffset(), reader.latestOffset()]
    parts = reader.partitions(*ends)
    for touched in (set(range(0, n, 7)), set(range(0, n, 3))):
        ends.append(reader.latestOffset())
    assert tracemalloc.get_traced_memory()[1] < 10 << 20
    tracemalloc.stop()
    assert ends[-1] == {"poll": 3} and reader.latestOffset() == ends[-1] and len(pickle.dumps(parts)) < 1 << 20

    def sizes(start, end):
        return sorted(r[3] for p in reader.partitions(start, end) for r in reader.read(p))

    reader.most_bytes = -1  # sizes alone, no texts
    assert sizes(*ends[:2]) == sizes(ends[0], ends[3]) == list(range(n)) and len(parts) > 300
    turned = {i for i in range(n) if (i % 7 == 0) != (i % 3 == 0)}
    assert sizes(ends[2], ends[3]) == sorted(turned)
    assert sizes(ends[1], ends[3]) == sorted(turned | set(range(0, n, 7)))


def test_batch_that_fails_between_sink_and_ledger(spark, tmp_path, monkeypatch):
    rows = lambda *ids: spark.createDataFrame([(i, T0) for i in ids], "report_id string, mtime timestamp")
    out, ledger = f"{tmp_path}/out", f"{tmp_path}/ledger"
    sinks.combine_once(rows("a", "b", "b"), out, ledger, "q-0")
    append = sinks.append_ledger
    monkeypatch.setattr(sinks, "append_ledger", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sinks.combine_once(rows("b", "c"), out, ledger, "q-1")
    assert sorted(r.report_id for r in sinks.read_ledger(spark, ledger).collect()) == ["a", "b"]
    monkeypatch.setattr(sinks, "append_ledger", append)
    for _ in range(2):
        sinks.combine_once(rows("b", "c"), out, ledger, "q-1")
        sinks.combine_once(rows("a", "b"), out, ledger, "q-0")
    assert sorted(r.report_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    assert sorted(r.report_id for r in sinks.read_ledger(spark, ledger).collect()) == ["a", "b", "c"]
    assert sinks.read_ledger(spark, f"{tmp_path}/none").count() == 0


def test_comets_by_key(spark, tmp_path):
    def lines(report, *seen):
        rows = [x for name, mag in seen for x in (f" 2024 01 02.6422  2460311.1422  {mag}  19:38:41.84 +37:43:59.1", f'This object is listed in comets.txt 30.5"  9.2mag {name}')]
        return spark.createDataFrame([(report, i, x) for i, x in enumerate(rows)], "report_id string, line_no int, line string")

    path = str(tmp_path / "comets")
    assert jobs.read_comets(spark, path).count() == 0
    jobs.refresh_comets(lines("r1", ("B/b", "12.1"), ("A/a", "11.0")), "q-0", path, parts=4)
    before = [tuple(r) for r in jobs.read_comets(spark, path).collect()]
    jobs.refresh_comets(lines("r2", ("B/b", "12.0")), "q-1", path, parts=4)
    table = [(r.name, r.mag) for r in jobs.read_comets(spark, path).collect()]
    assert table == [("A/a", "11.0"), ("B/b", "12.0"), ("B/b", "12.1")] and len(before) == 2
    for batch in ("q-0", "q-1"):  # repeats change nothing
        jobs.refresh_comets(lines("r2", ("B/b", "12.0")), batch, path, parts=4)
    jobs.refresh_comets(lines("r2", ("B/b", "12.0")), "q-2", path, parts=4)  # nor does a report that comes again
    jobs.refresh_comets(lines("r3"), "q-3", path, parts=4)
    assert [(r.name, r.mag) for r in jobs.read_comets(spark, path).collect()] == table


def test_requests_without_a_time(spark, tmp_path):
    rows = [(i, i % 2, None if i % 5 == 0 else T0 + timedelta(minutes=i)) for i in range(40)]
    schema = "event_id long, k int, ts timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    admitted = jobs.stream_admit(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "k", "ts", 3, 3600)
    q = admitted.writeStream.format("memory").queryName("untimed").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    batch = requests.admit(spark.createDataFrame(rows, schema), "k", "ts", "event_id", 3, 3600)
    got = sorted((r.event_id, r.accepted) for r in spark.table("untimed").collect())
    assert got == sorted((r.event_id, r.accepted) for r in batch.collect()) and all(ok for i, ok in got if i % 5 == 0)


def greedy(rows, limit, span):
    held, out = {}, {}
    for i, k, t in sorted(rows, key=lambda r: (r[2], r[0])):
        held[k] = [x for x in held.get(k, []) if x > t - span]
        out[i] = len(held[k]) < limit
        held[k] += [t] * out[i]
    return out


def test_hot_key_is_cut_at_its_gaps(spark):
    """One key with stretches of requests: spread over tasks, equal to the plain scan; gaps of just under and just over the time."""
    n, per, span = 60_000, 60, 600
    df = spark.range(n).selectExpr("id AS event_id", "'hot' AS k", f"timestamp_seconds(1700000000 + (id DIV {per}) * (59 * 7 + {span} - 1 + (id DIV {per}) % 3) + (id % {per}) * 7) AS ts").repartition(8)
    out = requests.admit(df, "k", "ts", "event_id", 5, span)
    rows = [(r.event_id, r.k, r.ts.timestamp()) for r in df.collect()]
    got = out.withColumn("task", F.spark_partition_id())
    assert {r.event_id: r.accepted for r in got.collect()} == greedy(rows, 5, span)
    timed = df.select("k", F.unix_micros("ts").alias("t"))
    assert requests.stretches(timed, "k", "t", span * 1_000_000).agg(F.max("_stretch")).first()[0] > 300
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in requests.admit(df, "k", "ts", "event_id", 5, span).groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 4 and max(sizes) < 0.5 * n


@pytest.mark.parametrize("slices", [1, 4])
def test_trailing_counts_by_slices(spark, slices):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN 'k' END AS k", "CASE WHEN id % 50 > 0 THEN timestamp_micros(1700000000000000 + (id * 7919 % 86400) * 1000000 - 43200000000 * (id % 2)) END AS ts")
    want = df.withColumn("in_window", F.count("*").over(Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-3_600_000_000, 0)))
    got = requests.rolling_count(df, "k", "ts", 3600, slices)
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "_at#" in got._jdf.queryExecution().optimizedPlan().toString()


def test_newest_images_of_several_fields(spark):
    """Equal to a ranking of the whole join, which is not in the plan."""
    load = lambda x: registry.load(spark, SF, x)
    targets = lightcurve.clamp_targets(load("fx_targets"))
    fields = targets.select("target_id", F.explode(F.transform(F.sequence(F.lit(0), F.col("target_id") % 4), lambda i: F.concat(F.lit("Fld"), (F.col("target_id") + 3 * i) % 20))).alias("field"))
    images = load("fx_images")
    joined = targets.join(fields.distinct(), "target_id").join(images, "field").toPandas()
    joined["stamp"] = joined["path"].str.extract(r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})")[0]
    joined["dir"], joined["name"] = joined["path"].str.split("/").str[0], joined["path"].str.split("/").str[1]
    want = []
    for t, g in joined.groupby("target_id"):
        rows = sorted(g.to_dict("records"), key=lambda r: r["name"])
        rows.sort(key=lambda r: (r["stamp"], r["dir_date"], r["dir"]), reverse=True)
        want += [(t, r["event_id"], k, len(rows), len(rows) > r["images"]) for k, r in enumerate(rows, 1) if k <= r["images"]]
    found = lightcurve.newest_images(targets, fields, images)
    got = found.select("target_id", "event_id", "rank", "total", "capped")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4


def test_sparse_archive_of_three_gigabytes(spark, tmp_path):
    """The directory of a large archive, with ZIP64 records, is listed without its content."""
    big = tmp_path / "big.zip"
    with zipfile.ZipFile(big, "w") as z:
        for name in ("a.fits", "sub/b.fts"):
            z.writestr(name, b"x")
    whole = big.read_bytes()
    at = whole.index(b"PK\x01\x02")  # the directory moves behind 3 GB of nothing
    start, directory, end = 3 << 30, whole[at : whole.index(b"PK\x05\x06")], whole[whole.index(b"PK\x05\x06") :]
    n = struct.unpack("<H", end[10:12])[0]
    zip64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, len(directory), start)
    locator = struct.pack("<IIQI", 0x07064B50, 0, start + len(directory), 1)
    last = struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    with open(big, "wb") as f:
        f.write(whole[:at])
        f.seek(start)
        f.write(directory + zip64 + locator + last)
    (tmp_path / "none.zip").write_bytes(b"PK no")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    tracemalloc.start()
    with open(big, "rb") as f:
        assert readers._directory(f) == ["a.fits", "sub/b.fts"]
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()
    got = readers.read_archive_entries(spark, str(tmp_path)).withColumn("archive", F.substring_index("archive", "/", -1)).collect()
    assert sorted((r.archive, r.pos, r.entry) for r in got if r.archive == "big.zip") == [("big.zip", 0, "a.fits"), ("big.zip", 1, "sub/b.fts")]
    assert next(r.size_bytes for r in got if r.archive == "big.zip") > 3 << 30
    assert [(r.archive, r.entry) for r in got if r.archive != "big.zip"].count(("none.zip", None)) == 1 and ("empty.zip", None) in [(r.archive, r.entry) for r in got]


def test_one_bad_document_among_a_hundred(spark, tmp_path):
    for i in range(99):
        (tmp_path / f"d{i:02}.json").write_text(f'{{"schema_version": {1 + i % 2},\n "candidates": [{{"id": "c{i}", "classification": "new", "later_field": {{"x": 1}}}}]}}')
    (tmp_path / "bad.json").write_text('{"schema_version": 2, "candidates": [{"id": "c"')
    good, aside = readers.split_candidate_json(spark, str(tmp_path))
    assert good.count() == 99 and {r.candidates[0].id for r in good.collect()} == {f"c{i}" for i in range(99)}
    assert [(r.path.rpartition("/")[2], r.reason) for r in aside.collect()] == [("bad.json", "not readable")]
    for name, text in {"v3": '{"schema_version": 3, "candidates": []}', "types": '{"schema_version": 2, "candidates": [], "totals": {"new": "x"}}', "bare": '{"schema_version": 2}', "array": "[1]", "blank": "\n"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    _, aside = readers.split_candidate_json(spark, str(tmp_path))
    assert {r.path.rpartition("/")[2]: r.reason for r in aside.collect()} == {"bad.json": "not readable", "v3.json": "newer version", "types.json": "not readable", "bare.json": "no candidates", "array.json": "not readable"}


def test_document_warnings_and_late_rows(spark, tmp_path):
    cands = spark.createDataFrame([("r", 0, "a", "new", "x"), ("r", 1, None, "new", "x")], "report_id string, pos int, id string, classification string, pre string")
    docs = spark.createDataFrame([("r",), ("none",)], "report_id string")
    sinks.write_candidate_documents(cands, docs, str(tmp_path / "k1"), "2026-01-01T00:00:00Z")
    got = {r.source_report: r for r in readers.read_candidate_json(spark, str(tmp_path / "k1"), lines=True).collect()}
    assert got["r"].parse_warnings == ["candidates: without an id, only counted: 1"] and got["r"].totals.total == 2
    assert got["none"].candidates == [] and got["none"].parse_warnings == []
    late = spark.createDataFrame([("a", T0), ("b", T0 - timedelta(hours=13))], "report_id string, mtime timestamp")
    assert [r.report_id for r in jobs.write_late(late, 3, str(tmp_path / "late"), now=T0).collect()] == ["a"]
    assert [r.report_id for r in spark.read.parquet(str(tmp_path / "late/batch=3")).collect()] == ["b"]


def test_newest_images_are_merged_once_for_a_set_of_fields(spark):
    """1,200 targets of 3 sets of fields: rows that are ranked grow with the sets, not with the targets."""
    targets = spark.range(1200).selectExpr("id AS target_id", "CAST(1 + id % 50 AS INT) AS images")
    fields = targets.selectExpr("target_id", "explode(CASE target_id % 400 WHEN 0 THEN array('a') WHEN 1 THEN array('b', 'c') ELSE array('a', 'b', 'c') END) AS field")
    images = spark.range(300).selectExpr("id AS event_id", "DATE '2024-01-01' AS dir_date", "substr('abc', CAST(id % 3 + 1 AS INT), 1) AS field", "concat('d/wcs_fd_x_2024-01-01_00-', lpad(CAST(id % 60 AS STRING), 2, '0'), '-00_', id, '.fits') AS path")
    got = lightcurve.newest_images(targets, fields, images)
    rows = got.groupBy("target_id").agg(F.count("*").alias("n"), F.max("total").alias("total"), F.max("images").alias("images")).collect()
    assert len(rows) == 1200 and all(r.n == min(r.images, r.total) for r in rows) and {r.total for r in rows} == {100, 200, 300}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [row_number()" in plan and not any("target_id" in line for line in plan.splitlines() if "Window" in line)
