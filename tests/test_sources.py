"""Sources and sinks on real files."""

import zipfile

from pyspark.sql import functions as F

from nightsift import functions as fn
from nightsift.operators import candidates, comets, coverage, lightcurve, requests
from nightsift.sources import readers, sinks

PIECE = '<a name="1_Fld_2026-1"><pre>The object was not found in VSX</pre><HR>'


def test_field_reports(spark, tmp_path):
    for d in ("results_a_Stas", "other"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "index.html").write_bytes(b"x\r\ny")
    rows = readers.read_field_reports(spark, str(tmp_path)).collect()
    assert [(r.report_id, r.text, r.size_bytes) for r in rows] == [("results_a_Stas", "x\ny", 4)]


def test_documents_round_trip(spark, tmp_path):
    reports = spark.createDataFrame([("20260512_evening_Stas.html", PIECE), ("20260513_morning_Stas.html", "none"), ("bad.html", '<a name="1"> no block <HR>')], "report_id string, text string")
    cands = candidates.parse_candidates(reports, "http://b")
    sinks.write_candidate_documents(cands, reports.select("report_id"), str(tmp_path / "docs"), "2026-01-01T00:00:00Z", "http://b")
    got = {r.source_report: r for r in spark.read.schema(readers.CANDIDATE_DOCUMENT).json(str(tmp_path / "docs")).collect()}
    full, empty, bad = got["20260512_evening_Stas.html"], got["20260513_morning_Stas.html"], got["bad.html"]
    assert full.totals.new == 1 and full.candidates[0].id == "1_Fld_2026-1" and full.schema_version == 2
    assert empty.totals.total == 0 and not empty.candidates
    assert bad.totals is None and bad.error


def test_candidate_json(spark, tmp_path):
    (tmp_path / "v1.json").write_text('{"schema_version": 1,\n "generated_at_utc": "t",\n "candidates": [{"id": "a", "classification": "new", "extra": 1}]}')
    (tmp_path / "error.json").write_text('{"schema_version": 2, "generated_at_utc": "t", "candidates": [], "error": "boom"}')
    rows = {r.schema_version: r for r in readers.read_candidate_json(spark, str(tmp_path)).collect()}
    assert rows[1].candidates[0].id == "a" and rows[2].error == "boom" and rows[2].totals is None


def test_archives(spark, tmp_path):
    for name, entries in {"good.zip": ["a.fits", "sub/b.fts"], "one.zip": ["a.fits"], "exe.zip": ["a.fits", "b.exe", "c.fit"]}.items():
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for e in entries:
                z.writestr(e, "x")
    (tmp_path / "broken.zip").write_bytes(b"PK no")
    rows = readers.read_archive_entries(spark, str(tmp_path)).withColumn("archive_id", F.substring_index("archive", "/", -1))
    assert rows.where("archive_id = 'broken.zip' AND entry IS NULL").count() == 1
    ok = {r.archive_id: (r.ok, r.message) for r in requests.archive_verdict(rows.where("entry IS NOT NULL")).collect()}
    assert ok == {"good.zip": (True, None), "one.zip": (False, "too few images"), "exe.zip": (False, "not an image: b.exe")}
    assert {r.archive_id for r in rows.where(~requests.type_ok(F.col("ext"), F.col("magic"))).collect()} == {"broken.zip"}


def test_archives_elsewhere_are_read_whole(spark, tmp_path, monkeypatch):
    """Where tasks cannot read ranges, archives come through Spark's binary reader, with the same rows."""
    for name, n in (("small.zip", 1), ("large.zip", 400)):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for i in range(n):
                z.writestr(f"{i}.fits", "x" * 100)
    (tmp_path / "broken.zip").write_bytes(b"PK no")
    got = sorted(map(str, readers.read_archive_entries(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(readers, "IN_PARTS", ())
    assert sorted(map(str, readers.read_archive_entries(spark, str(tmp_path)).collect())) == got and len(got) == 402


def test_served_url_of_a_long_path(spark):
    path = "/srv/uploads/" + "d/" * 9000 + "x.fits"
    url = lightcurve.served_url(spark.createDataFrame([(path,)], "path string"), "/srv/uploads", "http://b").first().url
    assert url == "http://b/" + path.removeprefix("/srv/uploads/")


def test_inventories(spark, tmp_path):
    d = tmp_path / "img_2026-05-12_up"
    d.mkdir()
    for n in ("wcs_fd_F_2026-05-12_01-02-03.fits.fz", "wcs_fd_F.cat", "fd_F.fits"):
        (d / n).write_text("x")
    (tmp_path / "top.FIT").write_text("x")
    assert [r.basename for r in readers.read_image_inventory(spark, str(tmp_path)).collect()] == ["wcs_fd_F_2026-05-12_01-02-03.fits.fz"]
    assert [r.path.rpartition("/")[2] for r in readers.read_reference_inventory(spark, str(tmp_path)).collect()] == ["top.FIT"]


def test_text_sinks(spark, tmp_path):
    (tmp_path / "log.txt").write_text(" 12.5 min  -- Total\n 9.0 min  -- analysis\nThe script exit code is 0\n######## date ####\n 1.5 min  -- Total\nThe script exit code is 2\n####")
    assert sorted((r.total_min, r.exit_code) for r in readers.read_run_log(spark, str(tmp_path / "log.txt")).collect()) == [(1.5, 2), (12.5, 0)]
    obs = spark.createDataFrame([("2024 01 02.5", "2460311.1", "12.0", "1:2:3", "+1:2:3", "9.2", "B/b c"), ("2024 01 02.5", "2460311.1", "12.0", "1:2:3", "+1:2:3", "9.2", "A/a")], "date_frac string, jd string, mag string, ra_hms string, dec_dms string, pred_mag string, name string")
    sinks.write_comets(comets.comet_lines(obs), str(tmp_path / "comets"))
    assert {r.name for r in readers.read_comet_table(spark, str(tmp_path / "comets")).collect()} == {"A/a", "B/b c"}
    m = spark.createDataFrame([(2460311.123456, "12.0005", "0.0001", "detection"), (2460311.5, ">13.25", "-", "upperlimit")], "jd double, mag string, err string, status string")
    sinks.write_lightcurve(*lightcurve.lightcurve_lines(m), str(tmp_path / "lc"))
    assert [r.value for r in spark.read.text(str(tmp_path / "lc/points")).collect()] == ["2460311.12346 12.000 0.001"]
    assert [r.value for r in spark.read.text(str(tmp_path / "lc/limits")).collect()] == ["2460311.50000 13.250"]
    for _ in range(2):  # a batch that is repeated
        sinks.append_ledger(obs.select(F.col("name").alias("report_id")), str(tmp_path / "ledger"), "q-0")
    assert sinks.read_ledger(spark, str(tmp_path / "ledger"), schema="report_id string").count() == 2


def test_coverage_at_the_edges(spark):
    """The zone join finds what brute force finds at RA 0/360 and near the poles, and its plan has no nested loop."""
    img = spark.createDataFrame([(f"i{k}", 9576, 6388, 5.9, 5.9, ra, dec) for k, (ra, dec) in enumerate([(0.5, 0.0), (359.0, 10.0), (10.0, 88.0), (200.0, -89.0), (120.0, 45.0)])], "path string, nx int, ny int, scale_x double, scale_y double, ra0 double, dec0 double")
    tgt = spark.createDataFrame([(k, ra, dec) for k, (ra, dec) in enumerate([(0.01, 0.1), (359.99, 0.2), (1.0, 12.0), (190.0, 89.9), (20.0, -89.9), (121.0, 46.0), (240.0, 0.0)])], "target_id int, ra double, dec double")
    x, y, cosine = coverage.project(F.col("ra"), F.col("dec"))
    brute = tgt.crossJoin(coverage.with_transform(img)).where(cosine > 0).withColumn("x", x).withColumn("y", y).where("x >= 0 AND x <= nx AND y >= 0 AND y <= ny")
    got = coverage.coverage(tgt, img)
    key = lambda d: sorted((r.target_id, r.path) for r in d.collect())
    assert key(got) == key(brute) and len(key(got)) >= 5
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_sql_functions(spark):
    fn.register(spark)
    r = spark.sql("SELECT jd_to_iso(2461172.6997D) AS a, hms_to_deg('01:00:00') AS b, dms_to_deg('-00:30:00') AS c, field_of('d/wcs_fd_Cyg5_x.fits') AS d, classify(false, true, true, false) AS e").first()
    assert tuple(r) == ("2026-05-12T04:47:34Z", 15.0, -0.5, "Cyg5", "new")


def test_report_files_are_listed_by_tasks(spark, tmp_path):
    """The driver lists no files: the number of tasks does not grow with them, and empty, hidden and other files are left out."""
    for i in range(300):
        d = tmp_path / f"results_{i}"
        d.mkdir()
        (d / "index.html").write_bytes(b"" if i == 7 else f"a{i}\r\nb\rc".encode())
        (d / "other.html").write_text("no")
    (tmp_path / "elsewhere").mkdir()
    (tmp_path / "elsewhere" / "index.html").write_text("no")
    got = readers.read_field_reports(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() <= 4
    assert sorted((r.report_id, r.text, r.size_bytes) for r in got.collect()) == sorted((f"results_{i}", f"a{i}\nb\nc", len(f"a{i}\r\nb\rc")) for i in range(300) if i != 7)
    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "20260219_evening_Stas.html").write_text("x\r\ny")
    (flat / "_hidden").write_text("no")
    assert [tuple(r) for r in readers.read_combined_reports(spark, f"file://{flat}").select("report_id", "session", "camera", "text").collect()] == [("20260219_evening_Stas.html", "evening", "Stas", "x\ny")]
