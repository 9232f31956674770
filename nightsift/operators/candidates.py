"""From report text to classified candidates. All of it is narrow selects on array and string functions but the roll-ups."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightsift.functions import absolute_url, dms_to_deg, extracted, hms_to_deg, jd_to_iso, number
from nightsift.functions.html import COMMENT, RAW, attribute, once, opening, stripped, tags, text_of

#: Fixed values of the report format.
EXCLUSION_KEYS = {
    "tocp_transients_list.txt": "tocp",
    "asassn_transients_list.txt": "asassn_transients",
    "tns_transients_list.txt": "tns_transients",
    "neverexclude_list.txt": "neverexclude_list",
    "moons.txt": "moons",
    "planets.txt": "planets",
    "spacecraft.txt": "spacecraft",
}
TRANSIENT_LISTS = ("tocp", "asassn_transients", "tns_transients")
LINK_RULES = (
    ("tns", "wis-tns.org"),
    ("asassn_list", "astronomy.ohio-state.edu/asassn"),
    ("simbad", "simbad.u-strasbg.fr"),
    ("vizier", "vizier.u-strasbg.fr"),
    ("wise", "irsa.ipac.caltech.edu"),
    ("aladin_lite", "aladin.u-strasbg.fr"),
    ("snad_ztf", "ztf.snad.space"),
)
CATALOGUES = (("vsx", "vsx"), ("asassn_v", "asassn_v"), ("astcheck", "astcheck"))
PAYLOAD_ENDS = ("Forced photometry", "online_id", "Check this position in", "Online MPChecker")
MEAN_LINE = r"^\s*(\d{4}\s+\d{1,2}\s+\d{1,2}\.\d+)\s+(\d+\.\d+)\s+(-?\d+\.\d+)\s+(\d{1,2}:\d{2}:\d{2}(?:\.\d+)?)\s+([+\-]\d{1,2}:\d{2}:\d{2}(?:\.\d+)?)"
GALACTIC_LINE = r"(?m)^\s*(-?\d+\.\d+)\s+(-?\d+\.\d+)\s+galactic\s+([A-Za-z]{3})"
SEPARATION = r"""Second-epoch detections are separated by\s+(-?\d+\.?\d*)"\s+and\s+(-?\d+\.?\d*)\s*pix"""
SENTINEL = r"The object was\s+(found|not found)\s+in\s+([A-Za-z0-9_\-]+)"
LISTED = r"This object is listed in (\S+\.txt)(.*)"
PHOTOMETRY = r"(?m)^Forced photometry on\s+(\S+)\s+at\s+(\d{1,2}:\d{2}:\d{2}(?:\.\d+)?\s+[+\-]\d{1,2}:\d{2}:\d{2}(?:\.\d+)?)\s*:\s*(-?\d+\.\d+)\s*\+/-\s*(-?\d+\.\d+)\s+(\S+)\s*$"
AVERAGE = r"(?m)^Forced photometry reference-image weighted average:\s*(-?\d+\.\d+)\s*\+/-\s*(-?\d+\.\d+)\s*$"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def split_candidates(reports: DataFrame) -> DataFrame:
    """report_id, pos, html: from the first anchor, cut at <HR>, without the last piece."""
    begun = once(F.col("text"), lambda t: F.when(F.contains(t, F.lit("<a name")), F.substring(t, F.instr(t, "<a name"), F.length(t))))
    pieces = once(F.split(begun, "<HR>"), lambda p: F.slice(p, F.lit(1), F.size(p) - 1))
    # outer: else Spark tests the pieces before it makes them, and so makes the text and the pieces twice
    return reports.select("report_id", F.posexplode_outer(pieces).alias("pos", "html")).where("html is not null")


def with_candidate_id(df: DataFrame) -> DataFrame:
    """Null ids stay, to be counted in totals."""
    return df.withColumn("id", extracted(F.col("html"), r"""<a name=['"]([^'"]+)['"]\s*>"""))


def block(html: Column, name: str) -> Column:
    """The first element of this name that is in no comment or script, from its opening tag to its end; null if there is none."""
    # of the alternatives only the last has a group
    found = F.regexp_extract_all(html, F.lit(rf"(?is)(?:{COMMENT}|{RAW}|({opening(name)}.*?(?:</{name}\s*>)))"), F.lit(1))
    return F.get(F.filter(found, lambda x: x != ""), 0)


def with_pre_text(df: DataFrame) -> DataFrame:
    """The pre block's text, no-break spaces made spaces for the patterns on it; null if there is no block."""
    return df.withColumn("pre", F.translate(text_of(block(F.col("html"), "pre")), "\u00a0", " "))


def with_field(df: DataFrame) -> DataFrame:
    """From the processing-log link, else from the id."""
    from_id = extracted(F.col("id"), r"^\d+_(?:fd_)?(.+?)_\d{4}-")
    if "html" in df.columns:
        ours = "field-processing-log-link"
        is_log = lambda t: F.contains(t, F.lit(ours)) & F.array_contains(F.split(attribute(t, "class"), r"\s+"), ours)
        df = df.withColumn("_tag", F.get(F.filter(tags(F.col("html"), "a"), is_log), 0))
        after = F.substring("html", F.instr("html", F.col("_tag")) + F.length("_tag"), F.length("html"))
        link = stripped(text_of(F.regexp_extract(after, r"(?is)^(.*?)</a[\s>]", 1)))
        from_id = F.coalesce(F.trim(extracted(link, r"(?s)^(.+?)\s+field processing log$")), from_id)
    return df.withColumn("field", from_id).drop("_tag")


def mean_line(pre: Column) -> Column:
    return F.get(F.filter(lines_of(pre), lambda x: x.rlike(MEAN_LINE)), 0)


def with_mean(df: DataFrame) -> DataFrame:
    """Date, JD, magnitude, position, galactic position and constellation."""
    df = df.withColumn("_line", mean_line(F.col("pre")))  # columns of their own are evaluated once
    df = df.withColumn("_sky", F.when(F.col("_line").isNotNull(), F.regexp_extract("pre", GALACTIC_LINE, 0)))
    part = lambda n: extracted(F.col("_line"), MEAN_LINE, n)
    sky = lambda n: extracted(F.col("_sky"), GALACTIC_LINE, n)
    jd = number(part(2))
    return df.withColumn("mean", F.struct(jd_to_iso(jd).alias("date_utc_iso"), part(1).alias("date_utc_dayfraction"), jd.alias("jd_utc"), number(part(3)).alias("mag"), part(4).alias("ra_hms"), part(5).alias("dec_dms"), hms_to_deg(part(4)).alias("ra_deg"), dms_to_deg(part(5)).alias("dec_deg"), number(sky(1)).alias("galactic_l_deg"), number(sky(2)).alias("galactic_b_deg"), sky(3).alias("constellation"))).drop("_line", "_sky")


def with_separation(df: DataFrame) -> DataFrame:
    """P7."""
    return df.withColumn("second_epoch_separation", F.when(F.col("pre").rlike(SEPARATION), F.struct(number(F.regexp_extract("pre", SEPARATION, 1)).alias("arcsec"), number(F.regexp_extract("pre", SEPARATION, 2)).alias("pix"))))


def with_cutouts(df: DataFrame, base_url: str) -> DataFrame:
    """Reference and discovery cut-outs of this id; the last of a name wins; null if there are none."""
    sources = F.filter(F.transform(tags(F.col("html"), "img"), lambda t: attribute(t, "src")), lambda x: x.isNotNull())
    name = lambda x: F.when(x.endswith("_reference.png"), F.lit("reference")).otherwise(F.concat(F.lit("discovery"), extracted(x, r"_discovery(\d+)\.png$")))
    pairs = F.filter(F.transform(F.filter(sources, lambda x: F.contains(x, F.col("id"))), lambda x: F.struct(name(x).alias("k"), absolute_url(x, base_url).alias("v"))), lambda p: p["k"].isNotNull())
    df = df.withColumn("_pairs", pairs)  # a column of its own is evaluated once
    return df.withColumn("cutouts", F.when(F.size("_pairs") > 0, last_map(F.col("_pairs")))).drop("_pairs")


def last_map(pairs: Column) -> Column:
    """W8 in a row: a map of (k, v) structs in which the last value of a key wins."""
    later = F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), (~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"])).alias("last")))
    return F.map_from_entries(F.transform(F.filter(later, lambda p: p["last"]), lambda p: F.struct(p["k"], p["v"])))


def with_discovery_images(df: DataFrame, base_url: str) -> DataFrame:
    """Rows of the first table (header skipped, at least seven cells), with their preview links by base name."""
    table = F.regexp_extract(block(F.col("html"), "table"), rf"(?is)^{opening('table')}(.*)</table\s*>$", 1)
    rows = F.regexp_extract_all(table, F.lit(rf"(?is){opening('tr')}(.*?)(?=<tr[\s/>]|\z)"), F.lit(1))
    cells = F.transform(F.filter(rows, lambda _, i: i > 0), lambda r: F.transform(F.regexp_extract_all(r, F.lit(rf"(?is){opening('td')}(.*?)(?=<td[\s/>]|</td|</tr|\z)"), F.lit(1)), lambda c: stripped(text_of(c))))
    position = r"^(\d{1,2}:\d{2}:\d{2}(?:\.\d+)?)\s+([+\-]\d{1,2}:\d{2}:\d{2}(?:\.\d+)?)"
    frame = F.regexp_extract("html", r"""(?is)<div[^>]*id=['"]fullframepreview_[^>]*>(.*?)</div>""", 1)
    anchors = F.transform(F.regexp_extract_all(frame, F.lit(rf"(?is)({opening('a')}.*?</a\s*>)"), F.lit(1)), lambda a: F.struct(stripped(text_of(a)).alias("t"), attribute(a, "href").alias("h")))
    link = lambda path: absolute_url(F.get(F.filter("_anchors", lambda a: a["t"] == F.substring_index(path, "/", -1)), 0)["h"], base_url)

    def row(c: Column) -> Column:
        xy, jd = F.split(c[5], r"\s+"), number(c[2])
        return F.struct(c[0].alias("label"), jd_to_iso(jd).alias("date_utc_iso"), c[1].alias("date_utc_dayfraction"), jd.alias("jd_utc"), number(c[3]).alias("mag"), extracted(c[4], position, 1).alias("ra_hms"), extracted(c[4], position, 2).alias("dec_dms"), number(F.get(xy, 0)).alias("x_pix"), number(F.get(xy, 1)).alias("y_pix"), c[6].alias("fits_path"), link(c[6]).alias("fits_url"))

    df = df.withColumn("_cells", F.filter(cells, lambda c: F.size(c) >= 7)).withColumn("_anchors", anchors)
    return df.withColumn("discovery_images", F.when(F.size("_cells") > 0, F.transform("_cells", row))).drop("_cells", "_anchors")


def with_crossmatch_entries(df: DataFrame) -> DataFrame:
    """P10: entries: array of (k, found, raw) for the three catalogues; the last sentinel of a name wins."""
    df = df.withColumn("_lines", lines_of(F.col("pre")))
    lines = F.col("_lines")
    # most lines are no sentinels: a substring test keeps the pattern for those that may be
    maybe = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda p: F.contains(p["x"], F.lit("The object was")))
    df = df.withColumn("_marks", F.filter(F.transform(maybe, lambda p: F.struct(p["i"].alias("i"), F.regexp_extract(p["x"], SENTINEL, 1).alias("s"), F.lower(F.replace(F.regexp_extract(p["x"], SENTINEL, 2), F.lit("-"), F.lit("_"))).alias("n"))), lambda m: m["s"] != ""))
    begins = lambda x: reduce(or_, (F.startswith(F.ltrim(x), F.lit(e)) for e in PAYLOAD_ENDS))
    df = df.withColumn("_ends", F.transform(lines, lambda x, i: F.when(begins(x), i)))
    marks, ends = F.col("_marks"), F.col("_ends")
    for _, n in CATALOGUES:
        df = df.withColumn(f"_{n}", last_mark(marks, n))

    def entry(key: str, name: str) -> Column:
        mark = F.col(f"_{name}")
        stop = F.array_min(F.concat(F.filter(F.transform(marks, lambda m: m["i"]), lambda i: i > mark["i"]), F.filter(ends, lambda i: i > mark["i"]), F.array(F.size(lines))))
        raw = F.rtrim(F.array_join(F.slice(lines, mark["i"] + 2, stop - mark["i"] - 1), "\n"), F.lit(" \n\t"))
        return F.when(mark.isNotNull(), F.struct(F.lit(key).alias("k"), (mark["s"] == "found").alias("found"), F.when(mark["s"] == "found", F.nullif(raw, F.lit(""))).alias("raw")))

    entries = F.filter(F.array(*(entry(k, n) for k, n in CATALOGUES)), lambda e: e.isNotNull())
    return df.withColumn("entries", entries).drop("_lines", "_marks", "_ends", *(f"_{n}" for _, n in CATALOGUES))


def last_mark(marks: Column, name: str) -> Column:
    return F.try_element_at(F.filter(marks, lambda m: m["n"] == name), F.lit(-1))


def exclusion_key(pre: Column, keys: dict[str, str] = EXCLUSION_KEYS) -> Column:
    """The key of the first exclusion list named; unknown lists by their name without .txt."""
    name = extracted(pre, LISTED, 1)
    known = F.create_map(*(F.lit(x) for kv in keys.items() for x in kv))
    return F.coalesce(F.try_element_at(known, name), F.regexp_replace(name, r"\.[^.]*$", ""))


def exclusion_details(pre: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(pre, LISTED, 2)), F.lit(""))


def with_crossmatches(df: DataFrame) -> DataFrame:
    """Key -> (found, raw); null if nothing is named."""
    listed = F.struct(exclusion_key(F.col("pre")).alias("k"), F.lit(True).alias("found"), exclusion_details(F.col("pre")).alias("raw"))
    df = with_crossmatch_entries(df)
    all_ = F.concat("entries", F.filter(F.array(listed), lambda e: e["k"].isNotNull()))
    pairs = F.transform(all_, lambda e: F.struct(e["k"].alias("k"), F.struct(e["found"].alias("found"), e["raw"].alias("raw")).alias("v")))
    df = df.withColumn("_pairs", pairs)
    return df.withColumn("crossmatches", F.when(F.size("_pairs") > 0, last_map(F.col("_pairs")))).drop("entries", "_pairs")


def with_forced_photometry(df: DataFrame) -> DataFrame:
    """Rows of each image and the reference average; null if there is neither.

    Lines are split once and those that begin like a row or an average are kept, so patterns see few lines.
    """
    lines = F.filter(lines_of(F.col("pre")), lambda x: x.startswith("Forced photometry "))
    one, average = PHOTOMETRY.removeprefix("(?m)"), AVERAGE.removeprefix("(?m)")
    # a line that matches is parted by a character that texts do not hold; one that does not stays whole
    parts = F.transform("_lines", lambda x: F.split(F.regexp_replace(x, one, "$1\u0001$2\u0001$3\u0001$4\u0001$5"), "\u0001"))
    row = lambda p: F.struct(p[0].alias("wcs_fits"), p[1].alias("position_hms"), number(p[2]).alias("mag"), number(p[3]).alias("mag_err"), p[4].alias("flag"))
    stated = F.get(F.filter("_lines", lambda x: x.startswith("Forced photometry reference")), 0)
    stated = F.split(F.regexp_replace(stated, average, "$1\u0001$2"), "\u0001")
    df = df.withColumn("_lines", lines)
    df = df.withColumn("_rows", F.transform(F.filter(parts, lambda p: F.size(p) == 5), row)).withColumn("_average", stated)
    some, known = F.size("_rows") > 0, F.size("_average") == 2
    found = F.when(known, F.struct(number(F.col("_average")[0]).alias("mag"), number(F.col("_average")[1]).alias("mag_err")))
    return df.withColumn("forced_photometry", F.when(some | known, F.struct(F.when(some, F.col("_rows")).alias("per_image"), found.alias("reference_weighted_avg")))).drop("_lines", "_rows", "_average")


def link_key(href: Column, rules: tuple[tuple[str, str], ...] = LINK_RULES) -> Column:
    """The first rule whose text is in the link."""
    out = F.when(F.contains(href, F.lit(rules[0][1])), F.lit(rules[0][0]))
    for key, needle in rules[1:]:
        out = out.when(F.contains(href, F.lit(needle)), F.lit(key))
    return out


def first_links(hrefs: Column, base_url: str, rules: tuple[tuple[str, str], ...] = LINK_RULES) -> Column:
    """Array of (k, v): the first link of each service."""
    first = lambda key: F.get(F.filter(hrefs, lambda h: link_key(h, rules) == F.lit(key)), 0)
    every = [F.struct(F.lit(k).alias("k"), absolute_url(first(k), base_url).alias("v")) for k, _ in rules]
    return F.filter(F.array(*every), lambda e: e["v"].isNotNull())


def with_external_links(df: DataFrame, base_url: str, archive_key: str = "sky_archive") -> DataFrame:
    """Services by link, and two archives by form (hidden values become a query string)."""
    hrefs = F.filter(F.transform(tags(F.col("html"), "a"), lambda t: attribute(t, "href")), lambda x: x.isNotNull())
    asas = extracted(F.col("html"), r"""(?is)<form[^>]*action=['"]([^'"]*astrouw\.edu\.pl[^'"]*)['"]""")
    form = F.regexp_extract("html", r"""(?is)(<form[^>]*action=['"][^'"]*sky_archive[^'"]*['"].*?</form>)""", 1)
    action = extracted(form, r"""(?is)action=['"]([^'"]*)['"]""")
    blank = lambda x: F.coalesce(attribute(x, "value"), F.when(x.rlike(r"""(?i)\svalue\s*=\s*(?:""|'')"""), F.lit("")))
    inputs = F.transform(tags(form, "input"), lambda x: F.struct(attribute(x, "name").alias("k"), blank(x).alias("v")))
    inputs = F.filter(inputs, lambda p: p["k"].isNotNull() & p["v"].isNotNull())
    names = F.transform(inputs, lambda p: p["k"])
    query = F.array_join(F.transform(F.filter(inputs, lambda p: p["k"] != "submit"), lambda p: F.concat(p["k"], F.lit("="), F.replace(F.url_encode(p["v"]), F.lit("+"), F.lit("%20")))), "&")
    archive = F.when(F.array_contains(names, "ra") & F.array_contains(names, "dec"), F.concat(action, F.lit("?"), query))
    more = F.array(F.struct(F.lit("asas3").alias("k"), absolute_url(asas, base_url).alias("v")), F.struct(F.lit(archive_key).alias("k"), archive.alias("v")))
    df = df.withColumn("_hrefs", hrefs)
    df = df.withColumn("_links", F.concat(first_links(F.col("_hrefs"), base_url), F.filter(more, lambda e: e["v"].isNotNull())))
    return df.withColumn("external_links", F.when(F.size("_links") > 0, F.map_from_entries("_links"))).drop("_hrefs", "_links")


def with_report_stubs(df: DataFrame) -> DataFrame:
    """Texts of the three stub blocks of this id."""
    blank = lambda c: F.nullif(F.trim(c, F.lit(" \n\t\r")), F.lit(""))

    def pres(name: str) -> Column:
        start = F.greatest(F.instr("html", F.concat(F.lit(f"id='{name}_"), "id", F.lit("'"))), F.instr("html", F.concat(F.lit(f'id="{name}_'), "id", F.lit('"'))))
        part = F.when(start > 0, F.split_part(F.substring("html", start, F.length("html")), F.lit("</div>"), F.lit(1)))
        return F.transform(F.regexp_extract_all(part, F.lit(rf"(?is)({opening('pre')}.*?</pre\s*>)"), F.lit(1)), text_of)

    df = df.withColumn("_mpc", pres("mpcstub")).withColumn("_var", F.get(pres("varstarstub"), 0))  # columns of their own are evaluated once
    mpc, tocp, var = F.col("_mpc"), F.get(pres("tocpstub"), 0), F.col("_var")
    each = F.filter(F.split(F.trim(F.get(mpc, 1), F.lit(" \n")), "\n"), lambda x: F.trim(x) != "")
    mark = r"\*\*\*\*\s*VSNET file format\s*\*\*\*\*"
    halves = F.split(var, mark, 2)
    return df.withColumn("report_stubs", F.struct(blank(F.get(mpc, 0)).alias("mpc_mean"), F.when(F.size(each) > 0, each).alias("mpc_per_image"), blank(tocp).alias("tocp"), blank(F.get(halves, 0)).alias("aavso"), blank(F.get(halves, 1)).alias("vsnet"))).drop("_mpc", "_var")


def with_warnings(df: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    """The messages whose condition holds; never drops a candidate."""
    return df.withColumn("parse_warnings", F.filter(F.array(*(F.when(c, F.lit(m)) for c, m in checks)), lambda x: x.isNotNull()))


#: The messages below.
def standard_checks() -> list[tuple[Column, str]]:
    pre = F.col("pre").isNotNull()
    return [
        (F.col("field").isNull(), "field: could not derive from link or id"),
        (pre & F.col("mean.date_utc_dayfraction").isNull(), "mean: regex no match"),
        (pre & F.col("mean.date_utc_dayfraction").isNotNull() & F.col("mean.constellation").isNull(), "mean: galactic/constellation line not found"),
        (pre & F.col("second_epoch_separation").isNull(), "second_epoch_separation: regex no match"),
        (F.col("discovery_images").isNull(), "discovery_images: no rows parsed"),
        (pre & F.col("forced_photometry").isNull() & F.contains("pre", F.lit("Forced photometry on")), "forced_photometry: regex no match"),
    ]


def is_asteroid(pre: Column) -> Column:
    """C1."""
    return F.contains(pre, F.lit("The object was found in astcheck"))


def is_variable(pre: Column, catalogue: str, max_arcsec: int = 30) -> Column:
    """Found, and a whole number of arcseconds, at most max_arcsec, begins the line after the first that names the catalogue."""
    lines = lines_of(pre)
    at = F.array_position(F.transform(lines, lambda x: F.contains(x, F.lit(catalogue))), True)
    token = F.replace(F.regexp_extract(F.get(lines, at.cast("int")), r"(?U)^\s*(\S+)", 1), F.lit('"'), F.lit(""))
    whole = F.when(token.rlike(r"^[+-]?\d+$"), token.try_cast("int"))
    return F.coalesce(F.contains(pre, F.lit(f"The object was found in {catalogue}")) & (whole <= max_arcsec), F.lit(False))


def is_never_excluded(pre: Column) -> Column:
    """One line has all three phrases."""
    return F.exists(lines_of(pre), lambda x: F.contains(x, F.lit("galactic")) & F.contains(x, F.lit("Second-epoch detections are separated by")) & F.contains(x, F.lit("This object is listed in neverexclude_list.txt")))


def is_known_transient(pre: Column, lists: tuple[str, ...] = TRANSIENT_LISTS) -> Column:
    """C4."""
    return F.coalesce(exclusion_key(pre).isin(*lists), F.lit(False))


def is_known(pre: Column) -> Column:
    """Asteroid or variable, without the exemption."""
    return is_asteroid(pre) | is_variable(pre, "VSX") | is_variable(pre, "ASASSN-V")


def classify(df: DataFrame) -> DataFrame:
    """Asteroid before variable (unless never excluded) before known transient before new."""
    pre = F.col("pre")
    variable = (is_variable(pre, "VSX") | is_variable(pre, "ASASSN-V")) & ~is_never_excluded(pre)
    return df.withColumn("classification", F.when(is_asteroid(pre), "known_asteroid").when(variable, "known_variable").when(is_known_transient(pre), "known_transient").otherwise("new"))


def parse_candidates(reports: DataFrame, base_url: str, archive_key: str = "sky_archive") -> DataFrame:
    """All of a report's candidates as nested rows (the central table). archive_key: the name of the archive form's link."""
    df = with_pre_text(with_candidate_id(split_candidates(reports)))
    for step in (with_field, with_mean, with_separation, lambda d: with_cutouts(d, base_url), lambda d: with_discovery_images(d, base_url), with_crossmatches, with_forced_photometry, lambda d: with_external_links(d, base_url, archive_key), with_report_stubs, classify):
        df = step(df)
    return with_warnings(df, standard_checks())


def session_totals(cands: DataFrame, keys: list[str]) -> DataFrame:
    """A1: candidates by class for each group; counts are combined before the shuffle."""
    kinds = ("new", "known_asteroid", "known_variable", "known_transient")
    return cands.groupBy(*keys).agg(F.count("*").alias("candidates"), *(F.count_if(F.col("classification") == k).alias(k) for k in kinds))


def all_known(cands: DataFrame, keys: list[str]) -> DataFrame:
    """Whether no candidate of a group is new, and the message."""
    out = cands.groupBy(*keys).agg(F.bool_and(F.col("classification") != "new").alias("all_known"))
    return out.withColumn("message", F.when(F.col("all_known"), "All candidates are known objects"))


def report_errors(cands: DataFrame, keys: list[str], lenient: bool = False) -> DataFrame:
    """A candidate without a pre block makes its report an error; lenient reports keep their others."""
    broken = F.bool_or(F.col("pre").isNull())
    return cands.groupBy(*keys).agg(broken.alias("broken"), (F.lit(False) if lenient else broken).alias("error"), F.count("pre").alias("usable"))


def reference_average(cands: DataFrame) -> DataFrame:
    """The average that the report states, and the inverse-variance average of its rows as a check."""
    rows = F.filter(F.col("forced_photometry.per_image"), lambda r: r["mag_err"] > 0)
    top = F.aggregate(rows, F.lit(0.0), lambda s, r: s + r["mag"] / (r["mag_err"] * r["mag_err"]))
    low = F.aggregate(rows, F.lit(0.0), lambda s, r: s + 1.0 / (r["mag_err"] * r["mag_err"]))
    return cands.withColumn("stated_avg", F.col("forced_photometry.reference_weighted_avg.mag")).withColumn("computed_avg", F.when(low > 0, top / low))


def bright_alerts(cands: DataFrame, lo: float = -5, hi: float = 9.5, min_not_found: int = 3) -> DataFrame:
    """C14: bright, in few catalogues, not listed among planets, comets or moons, seen on no third discovery image."""
    pre = F.col("pre")
    mag = number(extracted(mean_line(pre), MEAN_LINE, 3))
    missing = F.size(F.filter(lines_of(pre), lambda x: F.contains(x, F.lit("not found"))))
    listed = F.coalesce(extracted(pre, LISTED, 1).isin("planets.txt", "comets.txt", "moons.txt"), F.lit(False))
    third = F.exists("discovery_images", lambda d: F.contains(d["label"], F.lit("Discovery image 3"))) if "discovery_images" in cands.columns else F.lit(False)
    return cands.withColumn("mag", mag).withColumn("not_found", missing).where((mag > lo) & (mag < hi) & (missing >= min_not_found) & ~listed & ~F.coalesce(third, F.lit(False)))


def last_by_key(df: DataFrame, keys: list[str], pos: str, value: str) -> DataFrame:
    """The value at the last position of each key."""
    return df.groupBy(*keys).agg(F.max_by(value, pos).alias(value))


def report_bodies(reports: DataFrame) -> DataFrame:
    """report_id, body: the lines between the first 'Processing fields' and 'Processing complete!', without either."""
    lines = lines_of(F.col("text"))
    begin = F.array_position(F.transform(lines, lambda x: F.contains(x, F.lit("Processing fields"))), True).cast("int")
    end = F.array_position(F.transform(lines, lambda x: F.contains(x, F.lit("Processing complete!"))), True).cast("int")
    body = F.filter(F.slice(lines, begin + 1, F.greatest(end - begin - 1, F.lit(0))), lambda x: ~F.contains(x, F.lit("Processing fields")) & ~F.contains(x, F.lit("Processing complete")))
    return reports.where((begin > 0) & (end > begin)).select("report_id", body.alias("body"))


def combined_body(reports: DataFrame) -> DataFrame:
    """P19's lines: report_id, line_no, line."""
    return report_bodies(reports).select("report_id", F.posexplode("body").alias("line_no", "line"))


def rewrite_links(lines: DataFrame, dir_col: str = "report_id") -> DataFrame:
    """P20: image sources and the log's link to itself get the report's directory."""
    line = F.replace("line", F.lit('src="'), F.concat(F.lit('src="'), dir_col, F.lit("/")))
    log = "class='field-processing-log-link' href='./"
    return lines.withColumn("line", F.replace(line, F.lit(log), F.concat(F.lit(log[:-2]), dir_col, F.lit("/"))))
