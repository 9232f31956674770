"""Test inputs derived from the driver's tables: SQL that Spark (time zone UTC) and DuckDB both run unchanged."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "events", "lineitem", "orders", "pages", "part", "supplier")

SQL: dict[str, str] = {
    "fx_camera_rules": r"""
SELECT * FROM (VALUES (1,'Stas','Stas','TYCHO2_V'),(2,'STL-11000M','STL-11000M','TYCHO2_V'),(3,'TICA_TESS','TICA_TESS','APASS_I'),
 (4,'ED80__Black','ED80__Black','APASS_V'),(5,'TTUQ1b1x1','TTUQ1b1x1','APASS_V'),(6,'TTUQ2b1x1','TTUQ2b1x1','APASS_V')) AS t(priority, pattern, camera, calibration)
""",
    "fx_candidates": r"""
SELECT event_id, user_id, CAST(user_id % 6 + 1 AS INT) AS cam_no,
 concat(lpad(CAST(event_id % 100000 AS STRING),5,'0'), CASE WHEN event_id % 2 = 0 THEN '_fd_' ELSE '_' END, 'Fld', CAST(user_id % 20 AS STRING), '_2026-5-', CAST(1 + event_id % 28 AS STRING), '_23-4-47_003') AS id,
 concat('     2026 05 ', lpad(CAST(1 + event_id % 28 AS STRING),2,'0'), '.', lpad(CAST(event_id * 37 % 10000 AS STRING),4,'0'), '  ', CAST(2461160 + event_id % 28 AS STRING), '.', lpad(CAST(event_id * 37 % 10000 AS STRING),4,'0'),
  '  ', CAST(7 + event_id % 10 AS STRING), '.', lpad(CAST(event_id % 100 AS STRING),2,'0'), '  ', lpad(CAST(event_id % 24 AS STRING),2,'0'), ':', lpad(CAST(event_id % 60 AS STRING),2,'0'), ':', lpad(CAST(event_id * 7 % 60 AS STRING),2,'0'), '.43 ',
  CASE WHEN event_id % 3 = 0 THEN '-' ELSE '+' END, lpad(CAST(event_id % 90 AS STRING),2,'0'), ':', lpad(CAST(event_id * 11 % 60 AS STRING),2,'0'), ':', lpad(CAST(event_id * 13 % 60 AS STRING),2,'0'), '.1', chr(10),
  '     ', CAST(event_id % 360 AS STRING), '.93943  -', CAST(event_id % 90 AS STRING), '.18504 galactic  Oph  Second-epoch detections are separated by ', CAST(event_id % 9 AS STRING), '.5" and 0.', CAST(event_id % 9 AS STRING), ' pix',
  CASE WHEN event_id % 17 = 0 THEN ' This object is listed in neverexclude_list.txt' ELSE '' END, chr(10),
  CASE WHEN event_id % 3 = 0 THEN concat('The object was found in VSX', chr(10), CAST(event_id % 60 AS STRING), '" V', CAST(user_id AS STRING)) ELSE 'The object was not found in VSX' END, chr(10),
  CASE WHEN event_id % 5 = 0 THEN 'The object was found in astcheck' ELSE 'The object was not found in astcheck' END, chr(10),
  CASE WHEN event_id % 17 <> 0 AND event_id % 11 = 0 THEN concat('This object is listed in ', CASE WHEN event_id % 4 = 0 THEN 'tocp_transients_list.txt' WHEN event_id % 4 = 1 THEN 'tns_transients_list.txt' WHEN event_id % 4 = 2 THEN 'moons.txt' ELSE 'comets.txt' END, ' ', CAST(event_id % 90 AS STRING), '"  Body (8.7mag)', chr(10)) ELSE '' END,
  'Forced photometry on wcs_a', CAST(event_id % 7 AS STRING), '.fits at 17:12:51.43 -00:58:24.1:  13.', lpad(CAST(event_id % 100 AS STRING),2,'0'), ' +/- 0.05  detection') AS pre
FROM events
""",
    "fx_field_reports": r"""
SELECT concat('results_', CAST(y AS STRING), CASE WHEN l_suppkey % 29 = 0 THEN '_test_' ELSE '_' END, 'Fld', CAST(l_suppkey % 20 AS STRING), '_', cam, '_', CAST(l_suppkey AS STRING)) AS report_id, cam,
 CASE WHEN l_suppkey % 20 = 7 THEN 'Sco6' ELSE concat('Fld', CAST(l_suppkey % 20 AS STRING)) END AS field, mtime, n_candidates, CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE n_unid END AS n_unidentified, l_suppkey % 13 <> 0 AS complete, size_bytes
FROM (SELECT l_suppkey, extract(year FROM l_shipdate) AS y, CASE l_suppkey % 6 WHEN 0 THEN 'Stas' WHEN 1 THEN 'STL-11000M' WHEN 2 THEN 'TICA_TESS' WHEN 3 THEN 'ED80__Black' WHEN 4 THEN 'TTUQ1b1x1' ELSE 'TTUQ2b1x1' END AS cam,
 max(l_shipdate) AS mtime, count(*) AS n_candidates, sum(CASE WHEN l_discount < 0.02 THEN 1 ELSE 0 END) AS n_unid, CAST(sum(l_partkey) * 37 AS BIGINT) AS size_bytes FROM lineitem GROUP BY 1, 2, 3) g
""",
    "fx_images": r"""
SELECT event_id, CAST(ts AS DATE) AS dir_date, concat('Fld', CAST(user_id % 20 AS STRING)) AS field,
 concat('img_', substr(CAST(ts AS STRING),1,10), '_up', CAST(event_id % 9 AS STRING), '/', CASE WHEN event_id % 10 = 0 THEN 'fd_' ELSE 'wcs_fd_' END, 'Fld', CAST(user_id % 20 AS STRING), '-', CASE WHEN event_id % 3 = 0 THEN 'TICA_TESS' ELSE 'TTUQ1b1x1' END, '_', substr(CAST(ts AS STRING),1,10), '_', replace(substr(CAST(ts AS STRING),12,8),':','-'), '_', CAST(event_id AS STRING), CASE event_id % 4 WHEN 0 THEN '.fits' WHEN 1 THEN '.fts' WHEN 2 THEN '.fits.fz' ELSE '.cat' END) AS path FROM events
""",
    "fx_ref_images": r"""
SELECT s_suppkey AS ref_id, concat('wcs_fd_Fld', CAST(s_suppkey % 20 AS STRING), '_ref_', CAST(s_suppkey AS STRING), '.fits') AS path, 9576 AS nx, 6388 AS ny, CAST(5.9 AS DOUBLE) AS scale_x, CAST(5.9 AS DOUBLE) AS scale_y,
 CAST((s_suppkey * 47) % 360 AS DOUBLE) AS ra0, CAST((s_suppkey * 31) % 151 - 75 AS DOUBLE) AS dec0 FROM supplier
""",
    "fx_targets": r"""
SELECT c_custkey AS target_id, CAST((c_custkey * 7919) % 36000 AS DOUBLE) / 100 AS ra, CAST((c_custkey * 104729) % 17000 - 8500 AS DOUBLE) / 100 AS dec, CAST(c_custkey % 40 - 3 AS INT) AS window_days, CAST(c_custkey % 60 AS INT) AS max_images FROM customer
""",
    "fx_measurements": r"""
SELECT event_id, user_id % 20 AS field_no, CAST(2460310.5 AS DOUBLE) + CAST(event_id AS DOUBLE) / 1000 AS jd, concat(CASE WHEN event_id % 4 = 0 THEN '>' ELSE '' END, CAST(10 + event_id % 8 AS STRING), '.', lpad(CAST(event_id * 3 % 1000 AS STRING),3,'0')) AS mag,
 CASE WHEN event_id % 4 = 0 THEN '-' ELSE concat('0.', lpad(CAST(event_id % 50 AS STRING),4,'0')) END AS err, CASE WHEN event_id % 4 = 0 THEN 'upperlimit' WHEN event_id % 9 = 0 THEN 'saturated' ELSE 'detection' END AS status FROM events WHERE event_type <> 'error'
""",
    "fx_requests": r"""
SELECT event_id, ts, user_id AS limit_key, concat('http://h/x/uploads/results_', CAST(user_id AS STRING), CASE event_id % 5 WHEN 0 THEN '/index.html' WHEN 1 THEN '/' WHEN 2 THEN '/../etc' WHEN 3 THEN '/a b.html' ELSE '' END, CASE WHEN event_id % 7 = 0 THEN '' ELSE concat('#c', CAST(event_id % 50 AS STRING)) END) AS url FROM events
""",
    "fx_archive_entries": r"""
SELECT p_partkey % 400 AS archive_id, CASE WHEN p_partkey % 800 < 400 THEN '.zip' ELSE '.rar' END AS ext, p_partkey AS pos, concat('sub/', CASE p_partkey % 97 WHEN 0 THEN '.hidden' WHEN 1 THEN 'a;b.fits' WHEN 2 THEN 'x.exe' ELSE concat('img_', CAST(p_partkey AS STRING), CASE p_partkey % 3 WHEN 0 THEN '.fits' WHEN 1 THEN '.fts' ELSE '.FIT' END) END) AS entry, CAST(p_size AS BIGINT) * 60000 AS size_bytes FROM part
""",
    "fx_runs": r"""
SELECT o_orderkey AS run_id, o_orderdate AS finished, concat(' 12.', lpad(CAST(o_orderkey % 100 AS STRING),2,'0'), ' min  -- Total', chr(10), '  9.', lpad(CAST(o_orderkey * 3 % 100 AS STRING),2,'0'), ' min  -- analysis', chr(10), '  1.00 min  -- wait due to high server load', chr(10), 'The script exit code is ', CAST(CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS STRING)) AS entry FROM orders
""",
    "fx_comet_lines": r"""
SELECT event_id, concat(' 2024 01 ', lpad(CAST(1 + event_id % 28 AS STRING),2,'0'), '.6422  2460311.1422  12.', lpad(CAST(event_id % 100 AS STRING),2,'0'), '  19:38:41.84 +37:43:59.1', chr(10), 'This object is listed in comets.txt ', CAST(event_id % 120 AS STRING), '.5"  ', CAST(8 + event_id % 6 AS STRING), '.2mag ', CAST(event_id % 12 AS STRING), 'P/Name') AS block FROM events WHERE event_type = 'signup'
""",
    "fx_hrefs": r"""
SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages
""",
    "fx_report_text": r"""
SELECT c_custkey AS report_no, concat('results_20260219_Fld', CAST(c_custkey % 20 AS STRING), '_Stas_', CAST(c_custkey AS STRING)) AS report_id, concat(
 'SECOND_EPOCH__FIRST_IMAGE= /d/', CAST(c_custkey AS STRING), '_002.fts<br>', chr(10), 'SECOND_EPOCH__SECOND_IMAGE= /d/', CAST(c_custkey AS STRING), '_003.fts<br>', chr(10),
 'The star elongation is within the allowed range: median(A-B)=0.12 pix  ', CAST(c_custkey AS STRING), '_002.fts', chr(10),
 ' ', CAST(1 + c_custkey % 4 AS STRING), '.', CAST(c_custkey % 10 AS STRING), ' pix  fd_', CAST(c_custkey AS STRING), '_002.fts', chr(10),
 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(' ', CAST(1 + c_custkey % 5 AS STRING), '.', CAST(c_custkey * 3 % 10 AS STRING), ' pix  fd_', CAST(c_custkey AS STRING), '_003.fts', chr(10)) END,
 'Last  image: UT 2026-02-19 18:', lpad(CAST(c_custkey % 60 AS STRING),2,'0'), ':38.000 UTC', chr(10), 'Record 39: TIMESYS = ''UTC     '' / Default time system', chr(10),
 CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('Angular distance between the image centers 0.', lpad(CAST(c_custkey % 1000 AS STRING),3,'0'), ' deg', chr(10), 'Angular distance between the image centers 0.', lpad(CAST(c_custkey * 7 % 1000 AS STRING),3,'0'), ' deg', chr(10)) END,
 'All-image limiting magnitude estimate 12.', CAST(c_custkey % 10 AS STRING), chr(10), 'All-image limiting magnitude estimate 13.', CAST(c_custkey * 3 % 10 AS STRING), chr(10),
 CASE WHEN c_custkey % 19 = 0 THEN concat('ERROR: the camera is stuck', chr(10)) WHEN c_custkey % 11 = 0 THEN concat('ERROR: too few reference images', chr(10)) ELSE '' END,
 CASE WHEN c_custkey % 5 = 0 THEN concat('WARNING: server h is low on disk space, only 9 MB free', chr(10)) ELSE '' END, CASE WHEN c_custkey % 4 = 0 THEN concat('WARNING: tracking is poor', chr(10)) ELSE '' END,
 CASE WHEN c_custkey % 23 = 0 THEN '' ELSE concat('Found ', CAST(c_custkey % 30 AS STRING), ' unidentified candidates (excluding asteroids, hot pixels and known variables)', chr(10)) END,
 CASE WHEN c_custkey % 8 = 0 THEN '' ELSE concat('List of TOCP transients', chr(10)) END, 'Processing fields Fld', CAST(c_custkey % 20 AS STRING), ' <br>', chr(10),
 repeat(concat('<script>printCandidateNameWithAbsLink("x");</script><img src="a.png">', chr(10)), CAST(c_custkey % 120 AS INT)),
 CASE WHEN c_custkey % 13 = 0 THEN 'unfinished' ELSE 'Processing complete!' END) AS text FROM customer
""",
    "fx_tool_text": r"""
SELECT p_partkey AS image_id, concat('/ref/wcs_fd_Fld', CAST(p_partkey % 20 AS STRING), '_', CAST(p_partkey AS STRING), '.fits', chr(9), '315.0 30.0 J2000 -> ', CASE p_partkey % 9 WHEN 0 THEN 'offscale' WHEN 1 THEN '10.5 20.5 (off image)' ELSE concat(CAST(p_partkey AS STRING), '.250 ', CAST(p_partkey % 6000 AS STRING), '.500') END) AS projection_line,
 concat('941.5''x626.9''', chr(10), '15.7 (deg) x 10.4 (deg)', chr(10), CASE WHEN p_partkey % 14 = 0 THEN '' ELSE concat(CAST(9000 + p_partkey % 600 AS STRING), ' x 6388 pix', chr(10)) END, 'Image center: 21:', lpad(CAST(p_partkey % 60 AS STRING),2,'0'), ':59.', lpad(CAST(p_partkey % 1000 AS STRING),3,'0'), ' +30:59:59.', lpad(CAST(p_partkey * 7 % 100 AS STRING),2,'0'), ' J2000 4789.000 3195.000', chr(10), '5.', lpad(CAST(p_partkey % 100 AS STRING),2,'0'), '"/pix along the X axis and 5.90"/pix along the Y axis') AS metadata_text,
 concat(CASE WHEN p_partkey % 10 = 0 THEN '' ELSE concat('# aperture_diameter_pix: 8.', CAST(p_partkey % 10 AS STRING), chr(10), '# target_pixel: ', CAST(p_partkey AS STRING), '.1 22.5', chr(10)) END, '# C implementation:', chr(10), CASE WHEN p_partkey % 15 = 1 THEN 'bad line' ELSE concat('2461181.', lpad(CAST(p_partkey AS STRING),6,'0'), ' 13.', CAST(p_partkey % 100 + 100 AS STRING), ' 0.021 detection img_', CAST(p_partkey AS STRING), '.fits') END) AS measurement_text,
 concat('         JD 2461177.', lpad(CAST(p_partkey AS STRING),8,'0'), chr(10), ' ATel style 2026-05-17.', lpad(CAST(p_partkey * 17 % 100000 AS STRING),5,'0')) AS date_text FROM part
""",
}


def spread(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """df in as many tasks as there are cores, and of about so many rows at most, if it has fewer: the texts made of a row cost far more than to move it."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, df.count() // rows)
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input over the tables in sf_dir."""
    sql = SQL[name]
    for t in TABLES:
        if re.search(rf"\b{t}\b", sql):
            rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
            (rows if t == "lineitem" else spread(rows)).createOrReplaceTempView(t)  # lineitem is only summed: moving it costs more
    return spark.sql(sql)


def oracle(body: str) -> str:
    """DuckDB SQL: the derived inputs that the body names, then the body."""
    named = [n for n in SQL if re.search(rf"\b{n}\b", body)]
    views = ", ".join(f"{n} AS ({SQL[n].strip()})" for n in named)
    if not named:
        return body
    return f"WITH RECURSIVE {views}, " + body[5:] if body.startswith("WITH ") else f"WITH {views} {body}"
