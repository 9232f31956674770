"""Scalar functions as columns; each is also registered for SQL by register()."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def extracted(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, null instead of empty where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def number(text: Column) -> Column:
    return text.try_cast("double")


def jd_to_iso(jd: Column) -> Column:
    """Julian date (UTC) to ISO 8601, cut to the second."""
    return F.date_format(F.timestamp_micros(F.round((jd - 2440587.5) * 86400e6).cast("long")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _sexagesimal(text: Column) -> Column:
    """Degrees (or hours) without a sign; null unless there are three numeric parts."""
    parts = F.split(text, ":")
    value = F.get(parts, 0).try_cast("int") + F.get(parts, 1).try_cast("int") / 60.0 + number(F.get(parts, 2)) / 3600.0
    return F.when(F.size(parts) == 3, value)


def hms_to_deg(hms: Column) -> Column:
    return _sexagesimal(hms) * 15.0


def dms_to_deg(dms: Column) -> Column:
    """The sign is the character's, so -00:30:00 is negative."""
    value = _sexagesimal(F.regexp_replace(dms, r"^[+-]", ""))
    return F.when(dms.startswith("-"), -value).otherwise(value)


def absolute_url(url: Column, base_url: str) -> Column:
    """http(s) URLs as they are; others without ./ or leading slashes, after the base; blank is null."""
    u = F.trim(url)
    rest = F.regexp_replace(F.regexp_replace(u, r"^\./", ""), r"^/+", "")
    return F.when(u == "", F.lit(None)).when(u.rlike("^https?://"), u).otherwise(F.concat(F.lit(base_url.rstrip("/") + "/"), rest))


def field_of(path: Column) -> Column:
    """Field of an image name: one of wcs_fd_, wcs_, fd_ stripped once, then the token before the first underscore."""
    return F.split_part(F.regexp_replace(F.substring_index(path, "/", -1), r"^(wcs_fd_|wcs_|fd_)", ""), F.lit("_"), F.lit(1))


def register(spark: SparkSession) -> None:
    """SQL functions of the same names, for use from SQL text."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION jd_to_iso(jd DOUBLE) RETURNS STRING RETURN date_format(timestamp_micros(CAST(round((jd - 2440587.5D) * 86400e6D) AS BIGINT)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hms_to_deg(t STRING) RETURNS DOUBLE RETURN CASE WHEN size(split(t, ':')) = 3 THEN (try_cast(get(split(t, ':'), 0) AS INT) + try_cast(get(split(t, ':'), 1) AS INT) / 60.0D + try_cast(get(split(t, ':'), 2) AS DOUBLE) / 3600.0D) * 15.0D END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION dms_to_deg(t STRING) RETURNS DOUBLE RETURN CASE WHEN startswith(t, '-') THEN -1 ELSE 1 END * hms_to_deg(regexp_replace(t, '^[+-]', '')) / 15.0D")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION field_of(p STRING) RETURNS STRING RETURN split_part(regexp_replace(substring_index(p, '/', -1), '^(wcs_fd_|wcs_|fd_)', ''), '_', 1)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION classify(asteroid BOOLEAN, variable BOOLEAN, never_exclude BOOLEAN, known BOOLEAN) RETURNS STRING RETURN CASE WHEN asteroid THEN 'known_asteroid' WHEN variable AND NOT never_exclude THEN 'known_variable' WHEN known THEN 'known_transient' ELSE 'new' END")
