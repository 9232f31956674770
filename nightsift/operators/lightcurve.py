"""Light curves: which images of a target's fields to use, and what their measurements give."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightsift.functions import extracted, number
from nightsift.operators.candidates import lines_of

#: Fixed values.
BANDS = ("U", "B", "V", "R", "I", "g", "r", "i", "z")
IMAGE_ENDS = r"(?i)\.(fits|fit|fts)(\.fz)?$"
MIN_ERROR = 0.001


def image_inventory(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Survey images among listed files dir/name, with date, time in the name, ending and compression."""
    directory, name = F.split_part(path_col, F.lit("/"), F.lit(-2)), F.split_part(path_col, F.lit("/"), F.lit(-1))
    day = F.expr(f"try_to_date(regexp_extract({path_col}, '(?:^|/)img_([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})_', 1), 'yyyy-MM-dd')")
    out = files.select("*", directory.alias("dir_name"), name.alias("basename"), day.alias("img_date"), extracted(name, r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})").alias("file_ts"), F.lower(extracted(name, IMAGE_ENDS, 1)).alias("ext"), F.lower(name).endswith(".fz").alias("compressed"))
    return out.where(F.col("img_date").isNotNull() & F.col("basename").startswith("wcs_fd_") & F.col("basename").rlike(IMAGE_ENDS))


def with_band(images: DataFrame, rules: DataFrame, override: str | None = None) -> DataFrame:
    """Camera and band of each image from the first rule whose pattern its path holds.

    rules is a short dimension (priority, pattern, camera, calibration) with one row a camera: it is broadcast into one
    sorted array, so no row is multiplied and nothing is ranked afterwards.
    """
    one = rules.agg(F.array_sort(F.collect_list(F.struct("priority", "pattern", "camera", "calibration"))).alias("rules"))
    first = F.get(F.filter("rules", lambda r: F.contains("path", r["pattern"])), 0)
    band = F.substring_index(first["calibration"], "_", -1)
    out = images.crossJoin(F.broadcast(one)).withColumn("camera", first["camera"])  # one row
    return out.withColumn("band", F.coalesce(F.lit(override), F.when(band.isin(*BANDS), band), F.lit("V"))).drop("rules")


def clamp_targets(targets: DataFrame) -> DataFrame:
    """Days in [1, 30] (7 by default), images in [1, 50] (8 by default), and whether a given band is valid."""
    out = targets.withColumn("days", F.least(F.greatest(F.coalesce("window_days", F.lit(7)), F.lit(1)), F.lit(30))).withColumn("images", F.least(F.greatest(F.coalesce("max_images", F.lit(8)), F.lit(1)), F.lit(50)))
    return out.withColumn("band_ok", F.col("band").isNull() | F.col("band").isin(*BANDS)) if "band" in targets.columns else out


def _blocks(targets: DataFrame, images: DataFrame, by: list[str], block: int = 128, part: int = 1000) -> DataFrame:
    """Targets with blocks (_images) of about `block` images of their field that agree in the columns `by`.

    The pairs are far more than targets and images, so neither is moved once a pair. A field's targets are cut into parts of about
    `part`, each of which meets all of the field's blocks in one task, block by block: a block repeats for one target after the
    other, so that pairs written as columns take little space. AQE would put all of these tasks, small until then, into few.
    """
    names = [c for c in images.columns if c not in by]
    blocks = images.groupBy(*by).agg(F.ceil(F.count("*") / block).alias("_blocks")).withColumnsRenamed({c: f"_{c}" for c in by})
    cut = targets.where("field is not null").groupBy("field").agg(F.ceil(F.count("*") / part).alias("_parts"))
    numbered = images.join(blocks, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by)))
    held = numbered.groupBy(*by, F.pmod(F.xxhash64(*names), F.col("_blocks")).alias("_block")).agg(F.collect_list(F.struct(*names)).alias("_images"))
    theirs = held.join(cut, "field").select(*by, "_images", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"))
    mine = targets.join(cut, "field").withColumn("_part", F.pmod(F.xxhash64("target_id"), F.col("_parts"))).drop("_parts")
    spark = images.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return theirs.repartition(tasks, "field", "_part").join(mine.repartition(tasks, "field", "_part").hint("merge"), ["field", "_part"]).drop("_part")


def _unblocked(df: DataFrame) -> DataFrame:
    return df.select(*(c for c in df.columns if c != "_images"), F.inline("_images"))


def images_for_targets(images: DataFrame, fields: DataFrame) -> DataFrame:
    """Images of each target's fields; fields (target_id, field) are made distinct first."""
    return _unblocked(_blocks(fields.select("target_id", "field").distinct(), images, ["field"]))


def images_within_days(targets: DataFrame, images: DataFrame, today: date) -> DataFrame:
    """W3 of each target's field: targets (target_id, field, days) with the images (field, dir_date, ...) of their last days."""
    return _unblocked(within_days(_blocks(targets, images, ["field", "dir_date"]), today))


def within_days(df: DataFrame, today: date, days: str = "days") -> DataFrame:
    """Directory dates in the last `days` days, today included."""
    return df.where(F.col("dir_date") >= F.date_sub(F.lit(today), F.col(days) - 1))


def _newest(key: str) -> Column:
    """Rank of an image among those of the key: by the time in the name, newest first, then directory date and names."""
    name = F.substring_index("path", "/", -1)
    stamp = extracted(name, r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})")
    return F.row_number().over(Window.partitionBy(key).orderBy(stamp.desc_nulls_last(), F.col("dir_date").desc(), F.substring_index("path", "/", 1).desc(), name))


def newest_images(targets: DataFrame, fields: DataFrame | None, images: DataFrame, limit: str = "images", most: int = 50) -> DataFrame:
    """The newest images of each target's fields by the time in the name: targets' columns, the images', rank, total, capped.

    targets (target_id, limit of at most `most`), fields (target_id, field; made distinct here; none where targets have sorted
    lists of them, fields, which had better be on disk, as they are read several times), images (field, path, dir_date, ...). The newest of several fields are among the newest of each, so each field's `most` newest are kept, and
    merged once for each set of fields: targets of one set share the list, and images are never joined to targets. Lists of sets
    with a 1,000th of all targets or more (at most 1,000) are broadcast, those of rarer ones joined by a shuffle. Images without
    a time in their name come last; total: images of all the target's fields; capped: there were more than the limit.
    """
    mine = targets.drop("field", "fields")
    if fields is None:
        placed = targets.where(F.size("fields") > 0).withColumnRenamed("fields", "_fields").drop("field")
    else:
        sets = fields.where("field is not null").groupBy("target_id").agg(F.sort_array(F.collect_set("field")).alias("_fields"))
        placed = mine.join(sets, "target_id")
    classes = placed.groupBy("_fields").agg(F.count("*").alias("_n"))
    each = classes.select("_fields", F.explode("_fields").alias("field"))
    best = images.withColumn("rank", _newest("field")).where(F.col("rank") <= most).drop("rank")
    found = each.join(best, "field").withColumn("rank", _newest("_fields")).where(F.col("rank") <= most)
    lists = found.groupBy("_fields").agg(F.collect_list(F.struct(*images.columns, "rank")).alias("_list"))
    total = each.join(images.groupBy("field").agg(F.count("*").alias("n")), "field").groupBy("_fields").agg(F.sum("n").alias("total"))
    often = F.col("_n") * 1000 >= F.col("_all")
    counted = classes.crossJoin(F.broadcast(classes.agg(F.sum("_n").alias("_all")))).select("_fields", often.alias("_often"))  # one row
    ready = lists.join(total, "_fields").join(counted, "_fields")
    hot = ready.where("_often").select("_fields", "_list", "total")
    known = placed.join(F.broadcast(hot), "_fields", "left")
    rare = known.where("total is null").drop("_list", "total").join(ready.where("not _often").select("_fields", "_list", "total"), "_fields")
    got = known.where("total is not null").unionByName(rare)
    within = F.filter("_list", lambda x: x["rank"] <= F.col(limit))
    out = got.select("target_id", *(c for c in mine.columns if c != "target_id"), F.explode(within).alias("_x"), "total").select("target_id", *(c for c in mine.columns if c != "target_id"), "_x.*", "total")
    return out.withColumn("capped", F.col("total") > F.col(limit))


def attach_measurements(selected: DataFrame, measurements: DataFrame, on: str = "event_id") -> DataFrame:
    """Every selected image has a row; without a measurement its status is skipped."""
    return selected.join(measurements, on, "left").withColumn("status", F.coalesce("status", F.lit("skipped")))


def with_dates(measurements: DataFrame, dates: DataFrame, on: str = "event_id") -> DataFrame:
    """The date tool's Julian date and date, else the measured one in four places and a dash."""
    return measurements.join(dates, on, "left").withColumn("jd_shown", F.coalesce("tool_jd", F.bround("jd", 4))).withColumn("date_shown", F.coalesce("tool_date", F.lit("-")))


def catalogue_reuse(images: DataFrame, inventory: DataFrame) -> DataFrame:
    """The catalogue of an image: its name without wcs_ and ending .cat, else its own with .cat; only with an .aperture sibling."""
    name = F.substring_index("path", "/", -1)
    directory = F.regexp_replace("path", "[^/]*$", "")
    names = F.array(F.struct(F.lit(1).alias("p"), F.concat(directory, F.regexp_replace(name, "^wcs_", ""), F.lit(".cat")).alias("cat")), F.struct(F.lit(2).alias("p"), F.concat(F.col("path"), F.lit(".cat")).alias("cat")))
    tried = images.select("event_id", F.explode(names).alias("t")).select("event_id", "t.*")
    have = inventory.select("file").distinct()
    found = tried.join(have.withColumnRenamed("file", "cat"), "cat", "left_semi").withColumn("side", F.concat("cat", F.lit(".aperture"))).join(have.withColumnRenamed("file", "side"), "side", "left_semi")
    best = found.groupBy("event_id").agg(F.min_by("cat", "p").alias("catalogue"))
    return images.join(best, "event_id", "left").withColumn("hit", F.col("catalogue").isNotNull())


def split_lightcurve(measurements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points (magnitude, error floored) and upper limits (without >); rows with an unreadable date are dropped."""
    rows = measurements.withColumn("jd", F.col("jd").cast("string").try_cast("double")).where("jd is not null")
    limit = F.col("status") == "upperlimit"
    points = rows.where(~limit).withColumn("m", number(F.col("mag"))).withColumn("e", F.greatest(number(F.col("err")), F.lit(MIN_ERROR))).where(F.col("m").isNotNull() & number(F.col("err")).isNotNull())
    limits = rows.where(limit).withColumn("m", number(F.replace("mag", F.lit(">"), F.lit("")))).where("m is not null")
    return points, limits


def half_even(x: Column, places: int) -> Column:
    """Text of a number in fixed places, halves to even."""
    v = F.bround(x.cast("decimal(30,12)"), places)
    return v.cast(f"decimal(30,{places})").cast("string")


def format_magnitudes(df: DataFrame) -> DataFrame:
    """Two places, > before upper limits, what is no number as it is."""
    n = F.replace("mag", F.lit(">"), F.lit("")).try_cast("decimal(30,12)")
    shown = F.bround(n, 2).cast("decimal(30,2)").cast("string")
    return df.withColumn("mag_shown", F.when(n.isNull(), F.col("mag")).when(F.col("status") == "upperlimit", F.concat(F.lit(">"), shown)).otherwise(shown))


def round_sexagesimal(df: DataFrame, col: str, decimals: int = 1) -> DataFrame:
    """Seconds rounded to so many places, with carry to minutes and hours."""
    sign, body = F.regexp_extract(col, r"^([+-]?)", 1), F.regexp_replace(col, r"^[+-]", "")
    p = F.split(body, ":")
    units = 10**decimals
    all_ = (F.get(p, 0).try_cast("long") * 3600 + F.get(p, 1).try_cast("long") * 60) * units + F.bround(F.get(p, 2).try_cast("decimal(20,8)") * units, 0).cast("long")
    whole, rest = F.floor(all_ / units), all_ % units
    text = F.concat(sign, F.lpad(F.floor(whole / 3600).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.floor(whole % 3600 / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((whole % 60).cast("string"), 2, "0"), *([F.lit("."), F.lpad(rest.cast("string"), decimals, "0")] if decimals else []))
    return df.withColumn(f"{col}_rounded", text)


def served_url(df: DataFrame, root: str, base_url: str) -> DataFrame:
    """URL of a path under the uploads root; null outside."""
    top = root.rstrip("/") + "/"
    return df.withColumn("url", F.when(F.col("path").startswith(top), F.concat(F.lit(base_url.rstrip("/") + "/"), F.substring("path", F.lit(len(top) + 1), F.length("path")))))


def lightcurve_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows processed, solved, catalogue hits and misses, decompressed, and mean seconds, for each target."""
    return df.groupBy(*keys).agg(F.count("*").alias("processed"), F.count_if("solved").alias("solved"), F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.count_if("compressed").alias("decompressed"), F.avg("seconds").alias("mean_seconds"))


def skip_log(df: DataFrame, lines: int = 20) -> DataFrame:
    """K8: image, reason, return code, and the last lines of its errors."""
    parts = F.split("stderr", "\n")
    last = F.when(F.size(parts) > lines, F.slice(parts, F.size(parts) - lines + 1, F.lit(lines))).otherwise(parts)
    return df.where("reason is not null").select("event_id", "reason", "return_code", F.array_join(last, "\n").alias("stderr_tail"))


def parse_measurements(df: DataFrame, text_col: str = "measurement_text") -> DataFrame:
    """Aperture, target pixel and the measured fields; ok, or the reason why not."""
    lines = lines_of(F.col(text_col))
    at = F.array_position(F.transform(lines, lambda x: F.contains(x, F.lit("# C implementation:"))), True)
    t = F.split(F.trim(F.get(lines, at.cast("int"))), r"\s+")
    reason = F.when(at == 0, "no measurement line").when(F.coalesce(F.size(t), F.lit(0)) < 5, "too few fields")
    num = lambda p: number(extracted(F.col(text_col), p))
    return df.select("*", num(r"# aperture_diameter_pix:\s*(\S+)").alias("aperture"), num(r"# target_pixel:\s*(\S+)").alias("x"), num(r"# target_pixel:\s*\S+\s+(\S+)").alias("y"), *(F.when(reason.isNull(), F.get(t, i)).alias(n) for i, n in enumerate(("jd_text", "mag", "err", "status"))), reason.alias("reason"), reason.isNull().alias("ok"))


def parse_date_lines(df: DataFrame, text_col: str = "date_text") -> DataFrame:
    """The first Julian date in four places (half to even), the first date with four digits of its fraction, never carried."""
    jd = F.bround(extracted(F.col(text_col), r"(?m)^\s*JD\s+([0-9.]+)").try_cast("decimal(20,10)"), 4).cast("double")
    return df.withColumn("tool_jd", jd).withColumn("tool_date", extracted(F.col(text_col), r"ATel style\s+(\d{4}-\d{2}-\d{2}\.\d{1,4})"))


def text_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """K5: lines of fixed width: columns padded to their longest value, two spaces between, nothing after the last."""
    text = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols))
    width = text.agg(*(F.max(F.length(c)).alias(f"w_{c}") for c in cols))  # one row
    padded = [F.rpad(c, F.col(f"w_{c}"), F.lit(" ")) for c in cols[:-1]] + [F.col(cols[-1])]
    return text.crossJoin(F.broadcast(width)).select(F.rtrim(F.concat_ws("  ", *padded)).alias("line"))


def lightcurve_lines(measurements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K4: 'JD magnitude error' and 'JD limit' lines."""
    points, limits = split_lightcurve(measurements)
    jd = half_even(F.col("jd"), 5)
    return points.select(F.concat_ws(" ", jd, half_even(F.col("m"), 3), half_even(F.col("e"), 3)).alias("line")), limits.select(F.concat_ws(" ", jd, half_even(F.col("m"), 3)).alias("line"))
