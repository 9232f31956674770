"""Field reports: which are taken up, how each one stands, and what a run of the processing took."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightsift.functions import extracted, number
from nightsift.operators.candidates import lines_of

#: Cameras in the order in which they claim reports, and the fields that are always included.
CAMERAS = ("Stas", "STL-11000M", "TICA_TESS", "ED80__Black", "TTUQ1b1x1", "TTUQ2b1x1")
CROWDED_FIELDS = ("Sco6", "Oph-08-Q1b1x1", "Oph-08-Q2b1x1", "Sco-04-Q1b1x1", "Sco-04-Q2b1x1", "Sgr-04-Q1b1x1", "Sgr-04-Q2b1x1", "242")
TEST_SPELLINGS = "(?i)test_run|testrun|_test|test_|-test"
NO_COUNT = 99999


def with_session(df: DataFrame, ts_col: str, tz: str = "UTC", split_hour: int = 17) -> DataFrame:
    """Local date and morning (before split_hour) or evening."""
    local = F.from_utc_timestamp(F.col(ts_col).cast("timestamp"), tz)
    return df.withColumn("session_date", F.date_format(local, "yyyyMMdd")).withColumn("session", F.when(F.hour(local) < split_hour, "morning").otherwise("evening"))


def recent_reports(df: DataFrame, now: datetime, minutes: int = 720) -> DataFrame:
    """Modified within so many minutes before now."""
    return df.where(F.col("mtime") >= F.lit(now) - F.expr(f"INTERVAL {minutes} MINUTES"))


def split_late(df: DataFrame, now: datetime, minutes: int = 720) -> tuple[DataFrame, DataFrame]:
    """Reports in time, and those too old at the time of the poll."""
    recent = F.col("mtime") >= F.lit(now) - F.expr(f"INTERVAL {minutes} MINUTES")
    return df.where(recent), df.where(~recent)


def drop_tests(df: DataFrame) -> DataFrame:
    """Without test directories; those that look like a test run otherwise are flagged."""
    return df.where(~F.contains("report_id", F.lit("_test"))).withColumn("test_run", F.col("report_id").rlike(TEST_SPELLINGS))


def complete_only(df: DataFrame) -> DataFrame:
    """C9."""
    return df.where(F.contains("text", F.lit("Processing complete!")))


def quarantine_oversize(df: DataFrame, mb: int = 100) -> tuple[DataFrame, DataFrame]:
    """Reports of at most mb rounded megabytes, and the larger ones, kept apart."""
    large = F.bround(F.col("size_bytes") / 1048576.0, 0) > mb
    return df.where(~large), df.where(large)


def gate_reports(df: DataFrame, exempt: tuple[str, ...] = CROWDED_FIELDS) -> DataFrame:
    """C11: OK, PARSE_ERROR or TOO_MANY. The limit is higher where nearly all candidates are identified."""
    unid = F.coalesce("n_unidentified", F.lit(NO_COUNT))
    limit = F.when(unid <= 9, 100).otherwise(60)
    ok = ((F.col("n_candidates") < limit) & (unid < 20)) | F.col("field").isin(*exempt)
    return df.withColumn("verdict", F.when(ok, "OK").when(unid == NO_COUNT, "PARSE_ERROR").otherwise("TOO_MANY"))


def first_line(lines: Column, phrase: str) -> Column:
    return F.get(F.filter(lines, lambda x: F.contains(x, F.lit(phrase))), 0)


def last_line(lines: Column, phrase: str) -> Column:
    return F.try_element_at(F.filter(lines, lambda x: F.contains(x, F.lit(phrase))), F.lit(-1))


def tokens(line: Column) -> Column:
    """Fields of a line as awk counts them, from 0."""
    return F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")


def count_candidates(df: DataFrame) -> DataFrame:
    """A2."""
    hits = F.filter(lines_of(F.col("text")), lambda x: F.contains(x, F.lit("script")) & F.contains(x, F.lit("printCandidateNameWithAbsLink")))
    return df.withColumn("n_candidates", F.size(hits).cast("long"))


def count_unidentified(df: DataFrame) -> DataFrame:
    """A3: the count of the summary sentence; a sentinel without one."""
    n = extracted(F.col("text"), r"Found (\d+) unidentified candidates \(excluding asteroids, hot pixels and known").try_cast("long")
    return df.withColumn("n_unidentified", F.coalesce(n, F.lit(NO_COUNT).cast("long")))


def pointing_offset(df: DataFrame) -> DataFrame:
    """A4: the largest seventh field of the distance lines, in four places; ERROR without one."""
    found = F.filter(lines_of(F.col("text")), lambda x: F.contains(x, F.lit("Angular distance between the image centers")))
    most = F.array_max(F.filter(F.transform(found, lambda x: number(F.get(tokens(x), 6))), lambda v: v > -1))
    return df.withColumn("offset_deg", most).withColumn("offset_text", F.coalesce(F.format_string("%.4f", most), F.lit("ERROR")))


def mag_limit(df: DataFrame) -> DataFrame:
    """A5: the last limiting magnitude."""
    return df.withColumn("mag_limit", number(F.get(tokens(last_line(lines_of(F.col("text")), "All-image limiting magnitude estimate")), 4)))


def last_image_time(df: DataFrame) -> DataFrame:
    """Time of the image line without .000 and UTC, then the time system."""
    lines = lines_of(F.col("text"))
    t = tokens(first_line(lines, "Last  image"))
    when = F.trim(F.replace(F.replace(F.concat_ws(" ", F.get(t, 3), F.get(t, 4)), F.lit(".000"), F.lit(" ")), F.lit("UTC"), F.lit(" ")))
    system = F.replace(F.get(tokens(first_line(lines, "time system")), 4), F.lit("'"), F.lit(""))
    return df.withColumn("obs_time", F.trim(F.concat_ws(" ", when, system)))


def max_fwhm(df: DataFrame) -> DataFrame:
    """The largest first field, if a number, of the lines 'pix ... name' of the two second-epoch images."""
    df = df.withColumn("_lines", lines_of(F.col("text")))
    for column, key in (("_first", "SECOND_EPOCH__FIRST_IMAGE="), ("_second", "SECOND_EPOCH__SECOND_IMAGE=")):
        df = df.withColumn(column, F.nullif(F.regexp_replace(F.substring_index(first_line(F.col("_lines"), key), "/", -1), "<.*", ""), F.lit("")))
    df = df.withColumn("_pix", F.filter("_lines", lambda x: F.contains(x, F.lit("pix"))))
    names = lambda x: F.regexp_replace(x, "^.*?pix", "")
    hits = F.filter("_pix", lambda x: F.coalesce(F.contains(names(x), F.col("_first")), F.lit(False)) | F.coalesce(F.contains(names(x), F.col("_second")), F.lit(False)))
    values = F.filter(F.transform(hits, lambda x: F.get(tokens(x), 0)), lambda v: v.rlike(r"^[0-9.]+$"))
    return df.withColumn("fwhm_pix", F.array_max(F.transform(values, number))).drop("_lines", "_first", "_second", "_pix")


def with_warning(df: DataFrame) -> DataFrame:
    """The last disk-space warning, else the last that is not about symlinks, else a note on a broken log."""
    lines = F.filter(lines_of(F.col("text")), lambda x: F.contains(x, F.lit("WARNING")))
    disk = last_line(lines, "low on disk space")
    other = F.try_element_at(F.filter(lines, lambda x: ~F.contains(x, F.lit("replace_file_with_symlink_if_filename_contains_white_spaces"))), F.lit(-1))
    broken = F.when(~F.contains("text", F.lit("List of TOCP transients")) & ~F.contains("text", F.lit("Truncated list of TOCP transients")), "WARNING: corrupted log file")
    return df.withColumn("warning", F.coalesce(disk, other, broken))


def with_status(df: DataFrame) -> DataFrame:
    """ERROR if not included, CAMERA STUCK, ERROR with its first message, or OK with the warning."""
    lines = lines_of(F.col("text"))
    error = first_line(lines, "ERROR")
    stuck = F.exists(lines, lambda x: F.contains(x, F.lit("ERROR")) & F.contains(x, F.lit("camera is stuck")))
    status = F.when(F.col("verdict") != "OK", "ERROR").when(stuck, "CAMERA STUCK").when(error.isNotNull(), "ERROR").otherwise("OK")
    comment = F.when(F.col("verdict") != "OK", F.col("verdict")).when(stuck, F.lit(None)).when(error.isNotNull(), error).otherwise(F.col("warning"))
    return df.withColumn("status", status).withColumn("comment", comment)


def field_runs(reports: DataFrame) -> DataFrame:
    """All columns of the summary table from report texts (report_id, text); narrow."""
    df = with_warning(max_fwhm(last_image_time(mag_limit(pointing_offset(count_unidentified(count_candidates(reports)))))))
    df = df.withColumn("field", F.get(tokens(F.regexp_replace(first_line(lines_of(F.col("text")), "Processing fields"), "Processing fields|<br>", "")), 0))
    return with_status(gate_reports(df))


def summary_table(runs: DataFrame) -> DataFrame:
    """K2: the 11 columns of the nightly summary from field_runs with a camera; a stuck camera's row has no values, an error's no limit."""
    stuck, error = F.col("status") == "CAMERA STUCK", F.col("status") == "ERROR"
    directory = F.col("report_id")
    return runs.select(
        "camera",
        F.regexp_replace("obs_time", " UTC", "").alias("obs_time"),
        "field",
        F.concat(directory, F.lit("/small_field_preview.png")).alias("preview"),
        "status",
        F.concat(directory, F.lit("/")).alias("log"),
        F.when(~stuck, F.col("offset_deg")).alias("pointing_offset_deg"),
        F.when(~stuck & (~error | (F.col("verdict") != "OK")), F.col("mag_limit")).alias("mag_limit"),
        F.when(~stuck, F.col("fwhm_pix")).alias("fwhm_pix"),
        F.when(~stuck, F.concat_ws("/", "n_unidentified", "n_candidates")).alias("candidates"),
        F.col("comment").alias("comments"),
        *(c for c in ("session_date", "session") if c in runs.columns),
    )


def not_in_ledger(reports: DataFrame, ledger: DataFrame) -> DataFrame:
    """Reports that were not combined before."""
    return reports.join(ledger, "report_id", "left_anti")


def assign_camera(reports: DataFrame, cameras: tuple[str, ...] = CAMERAS) -> DataFrame:
    """The first camera whose name is in the report's; without a join, as the list is short and fixed."""
    names = F.array(*map(F.lit, cameras))
    return reports.withColumn("camera", F.get(F.filter(names, lambda c: F.contains("report_id", c)), 0))


def first_claim(df: DataFrame, keys: list[str], priority: str) -> DataFrame:
    """The row of least priority for each key. A minimum of structs, combined before the shuffle; no window sort."""
    rest = [c for c in df.columns if c not in keys and c != priority]
    best = df.groupBy(*keys).agg(F.min(F.struct(priority, *rest)).alias("b"))
    return best.select(*keys, F.col(f"b.{priority}").alias(priority), *(F.col(f"b.{c}").alias(c) for c in rest))


def oldest_first(reports: DataFrame) -> DataFrame:
    """T1."""
    return reports.orderBy("mtime", "report_id")


def combine_session(cands: DataFrame, runs: DataFrame) -> DataFrame:
    """Candidates of the included reports; they keep their report_id."""
    return cands.join(runs.where("verdict = 'OK'").select("report_id"), "report_id", "left_semi")


def night_index(sessions: DataFrame) -> DataFrame:
    """K7: a row for each product of a session, with its display name."""
    base = F.concat_ws("_", "session_date", "session", "camera")
    products = F.array(*(F.struct(F.lit(p).alias("product"), F.concat(base, F.lit(s)).alias("file")) for p, s in (("combined", ""), ("filtered", "_filtered"), ("summary", "_summary"))))
    out = sessions.select("session_date", "session", "camera", F.explode(products).alias("p")).select("session_date", "session", "camera", "p.*")
    return out.withColumn("display", F.replace("file", F.lit("_"), F.lit(" "))).withColumn("file", F.concat("file", F.lit(".html")))


def parse_session_name(df: DataFrame, name_col: str) -> DataFrame:
    """Date, session and camera from a combined report's file name; nulls where it does not match."""
    pattern = r"(?i)^(\d{8})_(morning|evening)_(\S+?)(?:_filtered)?\.html$"
    day = extracted(F.col(name_col), pattern, 1)
    return df.withColumn("date_utc", F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))).withColumn("date_utc", F.when(day.isNotNull(), F.col("date_utc"))).withColumn("session", F.lower(extracted(F.col(name_col), pattern, 2))).withColumn("camera", extracted(F.col(name_col), pattern, 3))


def parse_run_log(df: DataFrame, entry_col: str = "entry") -> DataFrame:
    """The four durations in minutes and the exit code of a run's log entry."""
    minutes = lambda label: number(extracted(F.col(entry_col), rf"(?m)^\s*([0-9.]+) min  -- {label}"))
    return df.select("*", minutes("Total").alias("total_min"), minutes("(?!Total|wait|unpack)").alias("analysis_min"), minutes("wait").alias("wait_min"), minutes("unpack").alias("unpack_min"), extracted(F.col(entry_col), r"The script exit code is (\d+)").try_cast("int").alias("exit_code"))


def runs_with_reports(runs: DataFrame, reports: DataFrame) -> DataFrame:
    """Runs with the reports of their directory, if any."""
    return runs.join(reports, "report_id", "left")


def run_outcome(runs: DataFrame) -> DataFrame:
    """Of runs joined with their reports (size_bytes, stuck, has_error; null without a report)."""
    out = F.when(F.col("size_bytes").isNull(), "MISSING_REPORT").when(F.col("size_bytes") == 0, "EMPTY_REPORT").when(F.col("stuck"), "CAMERA_STUCK").when(F.col("has_error") | (F.coalesce("exit_code", F.lit(1)) != 0), "ERROR").otherwise("OK")
    return runs.withColumn("outcome", out)


def processing_times(runs: DataFrame, keys: list[str]) -> DataFrame:
    """A10: least, mean and largest durations of each group."""
    each = [f(c).alias(f"{n}_{c}") for c in ("total_min", "analysis_min") for n, f in (("min", F.min), ("avg", F.avg), ("max", F.max))]
    return runs.groupBy(*keys).agg(F.count("*").alias("runs"), *each)


def with_context(reports: DataFrame, before: int, after: int) -> DataFrame:
    """report_id, line_no, line, context: for each line of a report's text the lines around it, in order; no row moves."""
    lines = F.split("text", "\n")
    split = reports.select("report_id", lines.alias("_lines"))
    rows = split.select("report_id", "_lines", F.posexplode("_lines").alias("line_no", "line"))
    first = F.greatest(F.col("line_no") - before, F.lit(0))
    return rows.select("report_id", "line_no", "line", F.slice("_lines", first + 1, F.col("line_no") - first + 1 + after).alias("context"))
