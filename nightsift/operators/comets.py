"""The all-time table of comet observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightsift.functions import extracted, number

LISTED = r'This object is listed in comets\.txt\s+([0-9.]+)"\s+([0-9.]+)mag\s+(.*)$'


def pair_comet_lines(lines: DataFrame) -> DataFrame:
    """Each comet line with the line before it, which holds the measurement (report_id, line_no, line)."""
    w = Window.partitionBy("report_id").orderBy("line_no")
    out = lines.withColumn("measurement", F.lag("line").over(w))
    return out.where(F.contains("line", F.lit("comets.txt"))).select("report_id", "measurement", F.col("line").alias("comet_line"))


def comet_observations(pairs: DataFrame, max_arcsec: float = 60) -> DataFrame:
    """Observations within max_arcsec of a listed comet, with the predicted magnitude and the name."""
    t = F.split(F.trim(F.regexp_replace("measurement", r"\s+", " ")), " ")
    dist = number(extracted(F.col("comet_line"), LISTED, 1))
    out = pairs.select("report_id", F.array_join(F.slice(t, 1, 3), " ").alias("date_frac"), F.get(t, 3).alias("jd"), F.get(t, 4).alias("mag"), F.get(t, 5).alias("ra_hms"), F.get(t, 6).alias("dec_dms"), dist.alias("dist"), extracted(F.col("comet_line"), LISTED, 2).alias("pred_mag"), F.trim(F.regexp_extract("comet_line", LISTED, 3)).alias("name"))
    return out.where(F.col("dist") <= max_arcsec)


def sort_comets(obs: DataFrame) -> DataFrame:
    """T5."""
    return obs.orderBy("name", "date_frac", "jd", "mag", "ra_hms", "dec_dms")


def comet_inputs(reports: DataFrame, min_year: int = 2023) -> DataFrame:
    """Combined reports but filtered and summary products and those of years before min_year."""
    p = F.col("file")
    return reports.where(~F.contains(p, F.lit("_filtered")) & ~F.contains(p, F.lit("summary")) & (F.substring(F.substring_index(p, "/", -1), 1, 4).try_cast("int") >= min_year))


def parse_comet_table(df: DataFrame) -> DataFrame:
    """Lines of the text table: seven leading fields, then the name, which may have spaces."""
    t = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ", 9)
    rows = df.where(F.get(t, 3).try_cast("double").isNotNull())
    return rows.select(F.concat_ws(" ", t[0], t[1], t[2]).alias("date_frac"), number(t[3]).alias("jd"), number(t[4]).alias("mag"), t[5].alias("ra_hms"), t[6].alias("dec_dms"), number(t[7]).alias("pred_mag"), t[8].alias("name"))


def comet_lines(obs: DataFrame) -> DataFrame:
    """K3: a line of the text table for each observation."""
    return obs.select("name", F.concat_ws("  ", "date_frac", "jd", "mag", F.concat_ws(" ", "ra_hms", "dec_dms"), "pred_mag", "name").alias("line"))
