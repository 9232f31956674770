"""Golden rows of the text rules."""

import pytest
from pyspark.sql import functions as F

from nightsift.operators import candidates as c
from nightsift.operators import lightcurve, reports, requests

PRE = """<pre>     2026 05 12.1997  2461172.6997  10.86  17:12:51.43 -00:58:24.1
     12.93943  17.18504 galactic  Oph  Second-epoch detections are separated by <font>1.5" and 0.2 pix</font>
The object was found in VSX
 15" V1 &amp; more
Mira
The object was not found in ASASSN-V
The object was found in astcheck
 ast line
Online MPChecker
This object is listed in tocp_transients_list.txt  7"  Nova (8.7mag)
Forced photometry on wcs_a.fits at 17:12:51.43 -00:58:24.1:  13.05 +/- 0.05  detection
Forced photometry reference-image weighted average: 13.10 +/- 0.02
</pre>"""
FULL = f"""<html>head <a name='00001_fd_Cyg5_2026-5-12_x'> <a class='field-processing-log-link' href='./'>Cyg5 field processing log</a>
<img src="pre_00001_fd_Cyg5_2026-5-12_x_reference.png"><img src="./a_00001_fd_Cyg5_2026-5-12_x_discovery1.png"><img src="b_00001_fd_Cyg5_2026-5-12_x_discovery1.png"><img src="other_reference.png">
<table><tr><th>h</th></tr><tr><td>Discovery image 1 &nbsp;</td><td>2026 05 12.1997</td><td>2461172.6997</td><td>10.86</td><td>17:12:51.43 -00:58:24.1</td><td>12.5 20.25</td><td>/d/img_1.fts</td></tr>
<tr><td>short</td></tr><tr><td>Discovery image 2</td><td>x</td><td>bad</td><td>-</td><td>?</td><td>1</td><td>/d/img_2.fts</td></tr></table>
<div id='fullframepreview_1'><a href="p/img_1.fts"> img_1.fts </a></div>
{PRE}
<a href='https://www.wis-tns.org/a'>t</a> <a href='https://www.wis-tns.org/b'>t</a> <a href='http://simbad.u-strasbg.fr/x'>s</a>
<form action='http://h/sky_archive/q'><input name='ra' value='1 2'><input name='dec' value='+3'><input name='submit' value='go'></form>
<div id='mpcstub_00001_fd_Cyg5_2026-5-12_x'><pre>mean line</pre><pre>one
 two

</pre></div><div id='tocpstub_00001_fd_Cyg5_2026-5-12_x'><pre> tocp </pre></div>
<div id='varstarstub_00001_fd_Cyg5_2026-5-12_x'><pre>aavso text
**** VSNET file format ****
vsnet text</pre></div>
<HR><a name="00002_Vul_2026-1"> no block <HR><p>no id</p><pre>x</pre><HR>tail</html>"""


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([("r1", FULL), ("r2", "<html>nothing</html>")], "report_id string, text string")
    return {(r.report_id, r.pos): r for r in c.parse_candidates(df, "http://b/").collect()}


def test_split_and_ids(rows):
    assert sorted(rows) == [("r1", 0), ("r1", 1), ("r1", 2)]
    assert [rows["r1", i].id for i in range(3)] == ["00001_fd_Cyg5_2026-5-12_x", "00002_Vul_2026-1", None]


def test_full_candidate(rows):
    r = rows["r1", 0]
    assert r.field == "Cyg5" and r.classification == "known_asteroid"
    assert r["mean"].date_utc_iso == "2026-05-12T04:47:34Z" and r["mean"].constellation == "Oph"
    assert r["mean"].dec_deg == pytest.approx(-0.97336111) and r["mean"].ra_deg == pytest.approx(258.21429167)
    assert (r.second_epoch_separation.arcsec, r.second_epoch_separation.pix) == (1.5, 0.2)
    assert r.cutouts == {"reference": "http://b/pre_00001_fd_Cyg5_2026-5-12_x_reference.png", "discovery1": "http://b/b_00001_fd_Cyg5_2026-5-12_x_discovery1.png"}
    assert [d.label for d in r.discovery_images] == ["Discovery image 1", "Discovery image 2"]
    first, second = r.discovery_images
    assert (first.x_pix, first.y_pix, first.fits_url, first.dec_dms) == (12.5, 20.25, "http://b/p/img_1.fts", "-00:58:24.1")
    assert (second.jd_utc, second.mag, second.y_pix, second.fits_url) == (None, None, None, None)
    assert r.crossmatches["vsx"].raw == ' 15" V1 & more\nMira' and not r.crossmatches["asassn_v"].found
    assert r.crossmatches["astcheck"].raw == " ast line" and r.crossmatches["tocp"].raw == '7"  Nova (8.7mag)'
    assert r.forced_photometry.per_image[0].flag == "detection" and r.forced_photometry.reference_weighted_avg.mag == 13.1
    assert r.external_links == {"tns": "https://www.wis-tns.org/a", "simbad": "http://simbad.u-strasbg.fr/x", "sky_archive": "http://h/sky_archive/q?ra=1%202&dec=%2B3"}
    assert (r.report_stubs.mpc_mean, r.report_stubs.mpc_per_image, r.report_stubs.tocp) == ("mean line", ["one", " two"], "tocp")
    assert (r.report_stubs.aavso, r.report_stubs.vsnet) == ("aavso text", "vsnet text") and r.parse_warnings == []


def test_broken_candidates(rows, spark):
    assert rows["r1", 1].pre is None and rows["r1", 1].cutouts is None and "discovery_images: no rows parsed" in rows["r1", 1].parse_warnings
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "y")], "report_id string, pre string")
    assert {r.report_id: (r.error, r.usable) for r in c.report_errors(df, ["report_id"]).collect()} == {"a": (True, 1), "b": (False, 1)}
    assert not c.report_errors(df, ["report_id"], lenient=True).where("error").count()


@pytest.mark.parametrize(
    ("text", "vsx", "asassn"),
    [
        ('The object was found in VSX\n15" V', True, False),
        ('The object was found in VSX\n45" V', False, False),
        ('The object was found in VSX\n30" V', True, False),
        ('The object was found in VSX\n31" V', False, False),
        ('The object was found in ASASSN-V\n20" V', False, True),
        ('The object was found in VSX\n0.5" V', False, False),
        ("The object was found in VSX\n", False, False),
        ("The object was found in VSX", False, False),
        ("", False, False),
    ],
)
def test_variable(spark, text, vsx, asassn):
    r = spark.createDataFrame([(text,)], "pre string").select(c.is_variable(F.col("pre"), "VSX").alias("v"), c.is_variable(F.col("pre"), "ASASSN-V").alias("a")).first()
    assert (r.v, r.a) == (vsx, asassn)


def test_precedence(spark):
    keep = 'galactic Second-epoch detections are separated by This object is listed in neverexclude_list.txt\nThe object was found in VSX\n1" V'
    listed = "This object is listed in tns_transients_list.txt"
    texts = [keep, keep.replace("galactic ", "galactic\n"), listed, "The object was found in astcheck\n" + keep, "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, pre string")
    assert [r.classification for r in c.classify(df).orderBy("i").collect()] == ["new", "known_variable", "known_transient", "known_asteroid", "new"]


def test_names_and_sizes(spark):
    names = {"img.fits": False, "../etc/passwd": False, "a..b": True, ".hidden": True, "a;b.fits": True, "sub/ok-1_2.fts": False, "a b": True, "": True, "d/": True, "é.fits": False, "a\\b": True}
    df = spark.createDataFrame(list(names.items()), "n string, bad boolean")
    assert df.where(requests.unsafe_name(F.col("n")) != F.col("bad")).count() == 0
    sizes = spark.createDataFrame([(2 << 20, True), ((2 << 20) - 1, False), (2 << 30, True), ((2 << 30) + 1, False)], "s long, ok boolean")
    assert sizes.where(requests.size_ok(F.col("s")) != F.col("ok")).count() == 0


def test_fwhm(spark):
    text = "SECOND_EPOCH__FIRST_IMAGE= /d/a_2.fts<br>\nSECOND_EPOCH__SECOND_IMAGE= /d/a_3.fts<br>\nThe star elongation: median(A-B)=0.12 pix  a_2.fts\n 1.5 pix  fd_a_2.fts\n{}"
    df = spark.createDataFrame([("x", text.format(" 1.7 pix fd_a_3.fts")), ("y", text.format(" 2.3 pix a_3.fts")), ("z", text.replace(" 1.5 pix  fd_a_2.fts\n", "").format(""))], "report_id string, text string")
    assert {r.report_id: r.fwhm_pix for r in reports.max_fwhm(df).collect()} == {"x": 1.7, "y": 2.3, "z": None}


def test_stuck_camera(spark):
    df = spark.createDataFrame([("a", "ERROR: the camera is stuck\nFound 1 unidentified candidates (excluding asteroids, hot pixels and known variables)\nProcessing fields X <br>")], "report_id string, text string")
    assert reports.field_runs(df).first().status == "CAMERA STUCK"


def test_targets(spark):
    texts = {"17:12:51 -08:58:24": "17:12:51 -08:58:24", "1 2 3 4 5 6": "1:2:3 4:5:6", "10.5, -3": "10.5 -3", "": None, "1 2 3": None, "a b": None}
    df = spark.createDataFrame(list(texts.items()), "text string, want string")
    assert requests.normalize_targets(df).where("NOT (coords <=> want)").count() == 0


def test_rounding(spark):
    df = spark.createDataFrame([("23:59:59.96", "24:00:00.0"), ("-00:30:00.04", "-00:30:00.0"), ("1:2:3.25", "01:02:03.2")], "a string, want string")
    assert lightcurve.round_sexagesimal(df, "a").where("a_rounded <> want").count() == 0
    m = spark.createDataFrame([("0.125", "detection"), (">12.345", "upperlimit"), ("nan?", "detection")], "mag string, status string")
    assert [r.mag_shown for r in lightcurve.format_magnitudes(m).collect()] == ["0.12", ">12.34", "nan?"]


def test_entities_and_white_space(spark):
    df = spark.createDataFrame([("a&#176;b &#x27;c&#39; &deg;&mdash;&amp;#65; &#128640; &nope; <b>x</b>", "The object was found in VSX\n\t15\" V1")], "html string, pre string")
    r = df.select(c.text_of(F.col("html")).alias("t"), c.is_variable(F.col("pre"), "VSX").alias("v")).first()
    assert r.t == "a°b 'c' °—&#65; \U0001f680 &nope; x" and r.v


def test_archive_key_is_passed_on(spark):
    html = '<a name="1_F_2026-1"><pre>x</pre><form action="/sky_archive/q"><input name="ra" value="1"><input name="dec" value="2"></form><HR>'
    got = c.parse_candidates(spark.createDataFrame([("r", html)], "report_id string, text string"), "http://b", "my_archive").first()
    assert got.external_links["my_archive"].endswith("?ra=1&dec=2")
