"""Secret scans with corpus-wide ownership frequency (operator 3, native).

Base spans come from fixed patterns; places are counted in code points from the matches and the gaps between them. Each
candidate is then judged by how many repositories and how many owners in the whole corpus hold its value (kept as a hash):
values of many are widely copied examples, values of few look live. Runs elsewhere that repeat a value which looks live
are added to the spans.

Spans depend on the text alone, so they are found once for each distinct text and joined to the rows by the text's MD5:
copies never meet in a group. Runs that repeat no live value stay in their tasks but for the few that a filter lets pass. Frequencies are pre-aggregated by (value, owner, repository). All work in a text is linear in
its length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bits_of, in_bits, materialize, once, whole_row

#: The kinds in their order, the words of assignments, the patterns, and the least length of a value.
KINDS = ("assign", "access", "hex", "bare")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
PATTERNS = (ASSIGN, r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}", r"[A-Za-z0-9+/_.=-]{8,}")
LEAST = 8
#: Numbers of the filter of live values: 4 MB of bits; it passes one in eight of other values where 4 million are live.
FILTER = 1 << 25
BARE = len(KINDS) - 1


def before(numbers: Column, op: Callable[[Column, Column], Column], block: int = 64) -> Column:
    """For each of an array of non-negative integers: op over all that come before it (0 for the first).

    Appending to an array copies it, so the running result is built in blocks: copies stay short in texts with very many.
    """

    def running(start: Column, part: Column) -> Column:
        first = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, first, lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: op(a, x)))
        return F.flatten(F.zip_with(running(F.lit(0), totals), blocks, running))

    def cut(x: Column) -> Column:
        last = F.greatest(F.ceil(F.size(x) / block).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(x, b * block + 1, F.lit(block)))

    return once(once(numbers, cut), whole)


def found(text: Column, kind: int) -> Column:
    """array<struct<start, kind, end, value>>: the kind's matches, leftmost and not overlapping, whose value is long enough.

    For all but assignments the least length is part of the pattern: their runs are maximal, so the matches are the same.
    """
    pattern = PATTERNS[kind]
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:bigint>>")
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def place(p: Column) -> Column:
        lengths = F.transform(p, lambda x: F.length(x["g"]) + F.length(x["m"]))
        return F.zip_with(p, before(lengths, lambda a, b: a + b), one)

    def one(x: Column, at: Column) -> Column:
        start = at + F.length(x["g"])
        value = F.regexp_extract(x["m"], pattern, 2) if kind == 0 else x["m"]
        span = lambda v: F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(x["m"])).alias("end"), hashed(v).alias("value"))
        return once(value, lambda v: F.when(F.length(v) >= LEAST, span(v)))

    parts = once(matches, lambda m: F.arrays_zip(m.alias("m"), F.slice(gaps, F.lit(1), F.size(m)).alias("g")))
    holds = text.rlike(pattern)
    if kind == 0:  # a plain search is many times faster than a pattern without regard to case
        lower = F.lower(text)
        holds = reduce(or_, (F.contains(lower, F.lit(w)) for w in WORDS)) & holds
    return F.when(holds, F.filter(once(parts, place), lambda x: x.isNotNull())).otherwise(none)


def hashed(value: Column) -> Column:
    """Hash of a value without the dots, dashes and equals signs that end it."""
    return F.xxhash64(F.rtrim(value, F.lit(".=-")))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def ownership(held: DataFrame, live_owners: int, live_repos: int) -> DataFrame:
    """held (value, owner, repo; a row for each document that holds the value) -> value, owners, repos, docs, live.

    A repository is one of its owner's, so its name counts with the owner's. Null owners and repositories are ones of their
    own. Each step is combined before its shuffle.
    """
    by_repo = held.groupBy("value", "owner", "repo").agg(F.count("*").alias("docs"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("docs").alias("docs"))
    spread = by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("docs").alias("docs"))
    return spread.withColumn("live", (F.col("owners") <= live_owners) & (F.col("repos") <= live_repos))


def outside(spans: DataFrame) -> DataFrame:
    """spans (key, start, kind, end, ...) without bare ones that overlap a base span of their text; base spans of a kind do not overlap."""
    base = F.col("kind") < BARE
    up = Window.partitionBy("key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("key").orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = spans.withColumn("ended", F.max(F.when(base, F.col("end"))).over(up)).withColumn("begins", F.min(F.when(base, F.col("start"))).over(down))
    free = (F.coalesce("ended", F.lit(0)) <= F.col("start")) & (F.coalesce("begins", F.col("end")) >= F.col("end"))
    return out.where(base | free).drop("ended", "begins")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None, live_owners: int = 2, live_repos: int = 4, keep: bool = False) -> DataFrame:
    """Per row: the id, n_assign, n_access, n_hex, base_sha256, spans, live (places), n_live, n_example, owners, repos; with keep also row, a struct of all columns.

    A base candidate counts as live if at most `live_owners` distinct owners and `live_repos` distinct repositories hold its
    value, else as an example. Without repo_col an owner has one repository. Added spans (kind bare) are runs of 8 or more
    characters outside of base spans that repeat a live value. owners, repos: the most that hold one of the row's base
    candidates, 0 without any. Null texts are empty (no spans; the hash of the empty string); a null owner is one owner,
    other than the empty name. Repeated rows stay and count as documents each. An empty table gives an empty one.
    """
    repo = F.col(repo_col) if repo_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), whole_row(docs, keep).alias("row"), F.col(owner_col).alias("owner"), repo.alias("repo"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumn("key", F.unhex(F.md5(F.col("t").cast("binary"))))

    base = rows.select("owner", "repo", "key", F.concat(*(found(F.col("t"), k) for k in range(BARE))).alias("base"))
    base = materialize(base.where(F.size("base") > 0), "secrets")
    held = base.select("owner", "repo", F.explode(F.array_distinct(F.transform("base", lambda x: x["value"]))).alias("value"))
    spread = materialize(ownership(held, live_owners, live_repos), "ownership")

    runs = rows.select("key", F.explode(found(F.col("t"), BARE)).alias("s")).select("key", "s.*")
    # most runs are words: a filter of at most 4 MB (FILTER bits) goes to the tasks first, and what passes it is joined
    live = spread.where("live").select("value")
    may_be = F.broadcast(bits_of(live.select(F.pmod("value", F.lit(FILTER)).alias("x")), "x"))
    runs = runs.join(may_be, in_bits(F.pmod("value", F.lit(FILTER))), "left_semi")
    again = runs.join(live, "value", "left_semi")
    again = again.select("key", "start", "kind", "end", "value").distinct()
    each = base.groupBy("key").agg(F.first("base").alias("base")).select("key", F.explode("base").alias("s")).select("key", "s.*")
    judged = outside(each.union(again).join(spread, "value"))

    place, is_base = F.struct("start", "kind", "end"), F.col("kind") < BARE
    all_ = F.array_sort(F.collect_list(place))
    spans = judged.groupBy("key").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{name}") for k, name in enumerate(KINDS[:BARE])),
        F.array_sort(F.collect_list(F.when(is_base, place))).alias("base"),
        all_.alias("all"),
        F.array_sort(F.collect_list(F.when(F.col("live"), F.struct("start", "end", "kind")))).alias("live"),
        F.count_if(F.col("live") & is_base).alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
        F.max(F.when(is_base, F.col("owners"))).alias("owners"),
        F.max(F.when(is_base, F.col("repos"))).alias("repos"),
    )
    counts = [*(f"n_{k}" for k in KINDS[:BARE]), "n_live", "n_example", "owners", "repos"]
    spans = materialize(spans.select("key", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"), "live"), "spans")

    out = rows.select("id", "row", "key").join(spans, "key", "left")  # a broadcast if few texts hold spans
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    return out.select(F.col("id").alias(id_col), *map(zero, counts[:BARE]), F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("live", empty).alias("live"), *map(zero, counts[BARE:]), *["row"] * keep)


def masked(text: Column, live: Column, mask: str = "[secret]", chunk: int = 4096) -> Column:
    """The text with each of the live places (start, end; sorted by start) replaced by the mask; overlapping ones merge.

    A null text is null; without places the text is as it was. The text is cut into chunks first, since a place in a long
    text is found only by counting from its beginning.
    """

    def piece(chunks: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / chunk).cast("int"), F.floor(b / chunk).cast("int")
        inside = F.substring(F.get(chunks, first), a % chunk + 1, b - a)
        across = F.concat(F.substring(F.get(chunks, first), a % chunk + 1, F.lit(chunk)), F.array_join(F.slice(chunks, first + 2, last - first - 1), ""), F.coalesce(F.substring(F.get(chunks, last), F.lit(1), b % chunk), F.lit("")))
        return F.coalesce(F.when(first == last, inside).otherwise(across), F.lit(""))

    def whole(chunks: Column) -> Column:
        ends = F.transform(live, lambda x: x["end"])
        parts = F.zip_with(live, before(ends, F.greatest), lambda x, at: F.when(x["start"] >= at, F.concat(piece(chunks, at, x["start"]), F.lit(mask))).otherwise(""))
        return F.concat(F.array_join(parts, ""), piece(chunks, F.array_max(ends), F.length(text)))

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    return F.when(F.size(live) > 0, once(cut, whole)).otherwise(text)
