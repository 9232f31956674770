"""WARC archives: writing with revisits, segments and chunked transfer framing, and reading back (operator 5).

Writing is a plain Spark text job: a record ends with the line separator CR LF CR LF, which is what the format asks for.
Records whose block is longer than `segment` bytes are cut into continuation records. Reading parses whole archive files
by Content-Length (their size is bounded by records a file and bytes a segment); segments are grouped by the record they
began with, ordered by number, checked against the total length, and their chunked framing is decoded. Revisits take
length and digest from the response that they refer to.

Which of equal payloads is the response is decided on digests, ids and row numbers alone. The rows that are revisits go to
the tasks as bitmaps, whose size is checked, so payloads are not shuffled; beyond it they move once.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .common import bits_of, in_bits, materialize, scratch, slices

END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = 4096) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in [*parts, b""])


def unchunked(body: bytes) -> bytes:
    """Decodes chunked transfer framing; extensions and trailers are dropped. ValueError if it is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if not n:
            return b"".join(out)
        if body[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def header(fields: dict[str, object]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n"


def records(page_id: object, row: int, url: str | None, payload: bytes, digest: str, refers: str | None, date: str, segment: int) -> Iterator[bytes]:
    """The records of a page: a revisit, a response, or a response's first segment and its continuations."""
    uri = re.sub(r"[\s\x00-\x1f<>]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "about:blank")
    name = record_id(page_id, row)
    fields = {"WARC-Record-ID": f"<{name}>", "WARC-Date": date, "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{digest}"}
    if refers is not None:
        more = {"WARC-Type": "revisit", "WARC-Profile": REVISIT, "WARC-Refers-To": f"<{refers}>", "Content-Type": "application/http; msgtype=response", "Content-Length": len(HTTP)}
        yield header(fields | more) + HTTP
        return
    block = HTTP + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    for k, part in enumerate(parts, 1):
        more = {"WARC-Type": "response", "Content-Type": "application/http; msgtype=response"} if k == 1 else {"WARC-Type": "continuation", "WARC-Record-ID": f"<{name}:{k}>", "WARC-Segment-Origin-ID": f"<{name}>"}
        more |= ({"WARC-Segment-Number": k} if len(parts) > 1 else {}) | ({"WARC-Segment-Total-Length": len(block)} if k == len(parts) > 1 else {})
        yield header(fields | more | {"Content-Length": len(part)}) + part


def record_id(page_id: object, row: int) -> str:
    """The id percent-encoded (so it cannot break a header), with a letter that tells null from empty text."""
    return f"urn:x-page:{'n' if page_id is None else 'v' + quote(str(page_id), safe='')}:{row}"


def page_of(record: Column, kind: DataType) -> Column:
    """The page id in a record id."""
    return F.when(record.startswith("urn:x-page:v"), F.url_decode(F.regexp_extract(record, r"^urn:x-page:v(.*):\d+$", 1)).cast(kind))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000, date: str = "2026-01-01T00:00:00Z", segment: int = 16384, records_per_file: int = 4000, most_bits: int = 32 << 20) -> None:
    """Writes a record per row of pages to gzipped WARC files under path.

    Of rows with equal payloads of at least `least` bytes that with the largest id (then the last row) is a response, the
    others revisit it. Null ids come before all others. pages is read twice and must give its rows in the same tasks both
    times, as tables in files do; write any other to a table first.

    Ids, urls and digests are written once; from them alone it is decided which rows revisit which. Payloads stay in their
    tasks as long as the bitmap of the rows that are revisits has at most `most_bits` bytes, and move once beyond that.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    heads = materialize(rows.select("id", "url", "row", F.sha1("payload").alias("digest"), (F.octet_length("payload") >= least).alias("large")), "heads")
    first = heads.where("large").groupBy("digest").agg(F.max(F.struct("id", "row")).alias("first"), F.count("*").alias("n"))
    first = materialize(first.where("n > 1").select("digest", "n", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row")), "copies")
    # a payload of a 10,000th of all copies or more: at most 10,000 are so, and are broadcast; the others fill no task
    copies = first.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * 10_000 >= copies
    hot = F.broadcast(first.where(often))
    large = heads.where("large")
    found = large.join(hot, "digest").unionByName(large.join(hot, "digest", "left_anti").join(first.where(~often), "digest"))
    revisits = materialize(found.where(F.col("first_row") != F.col("row")).select("id", "row", "url", "digest", F.col("first_id").alias("refers"), F.col("first_row").alias("refers_row")), "revisits")
    bits = materialize(bits_of(revisits, "row"), "revisit-rows")
    if bits.count() * 4096 <= most_bits:
        responses = rows.join(F.broadcast(bits), in_bits(F.col("row")), "left_anti")
    else:
        responses = rows.join(revisits.select("row"), "row", "left_anti")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 128):
            out = []
            for page_id, row, url, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out += records(page_id, row, url, payload, hashlib.sha1(payload).hexdigest(), None, date, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    def refer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            out = []
            for page_id, row, url, digest, refers, refers_row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out += records(page_id, row, url, None, digest, record_id(refers, refers_row), date, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    joined = responses.select("id", "row", "url", "payload").mapInArrow(run, "record binary").union(revisits.mapInArrow(refer, "record binary"))
    out = joined.select(F.col("record").cast("string").alias("value"))
    out.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def unpacked(data: bytes) -> bytes:
    """The content of a file: all members of a gzip file (most archives have one for each record), or the file itself."""
    if data[:2] != b"\x1f\x8b":
        return data
    out, at = [], 0
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof and at < len(data):
            part = data[at : at + (1 << 16)]
            out.append(member.decompress(part))
            at += len(part) - len(member.unused_data)
        if not member.eof:
            raise ValueError("the archive ends within a gzip member")
        while data[at : at + 1] == b"\0":  # padding between members
            at += 1
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive: header fields (names in lower case) and block."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        version, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        at = start + int(fields["content-length"])
        yield fields, data[start:at]
        if data[at : at + 4] != END:
            raise ValueError(f"the record at byte {start} does not end where it should")
        at += 4


def decoded(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?i)\r\ntransfer-encoding:\s*chunked", head) else body


PARSED = "record string, type string, digest string, refers string, number int, total long, bytes long, sha1 string, block binary"


def parsed_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under path; unsegmented responses are decoded, segments keep their block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            data = b.column(0)[0].as_py()
            rows, held = [], 0
            for f, block in parse(unpacked(data)):
                bare = lambda k: f[k].strip("<>") if k in f else None  # noqa: B023, E731
                kind, segment = f["warc-type"], f.get("warc-segment-number")
                name = bare("warc-segment-origin-id") if kind == "continuation" else bare("warc-record-id")
                payload = decoded(block) if kind == "response" and not segment else None
                rows.append((name, kind, f.get("warc-payload-digest", "").removeprefix("sha1:"), bare("warc-refers-to"), segment and int(segment), int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, None if payload is None else len(payload), None if payload is None else hashlib.sha1(payload).hexdigest(), block if segment else None))
                held += len(block)
                if held > 4 << 20:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    names, kinds = [x.split()[0] for x in PARSED.split(", ")], [pa.string()] * 4 + [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, PARSED)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per response or revisit of the archives under path: record, record_type, bytes, sha1, refers (record), intact.

    intact: all segments are there and add up to the total length, framing is whole, and the digest is that of the header.
    """
    all_ = materialize(parsed_records(spark, path), "records")
    part = F.struct("number", "block", "total", "digest", "type")
    grouped = all_.where("number is not null").groupBy("record").agg(F.sort_array(F.collect_list(part)).alias("parts"))  # of one record: as many as its length needs

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            out = []
            for name, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                block = b"".join(x["block"] for x in parts)
                whole = [x["number"] for x in parts] == list(range(1, len(parts) + 1)) and parts[-1]["total"] == len(block)
                try:
                    payload = decoded(block)
                except ValueError:
                    payload, whole = b"", False
                sha1 = hashlib.sha1(payload).hexdigest()
                out.append((name, len(payload), sha1, whole and sha1 == parts[0]["digest"]))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.bool_()), strict=True)], ["record", "bytes", "sha1", "intact"])

    joined = grouped.mapInArrow(run, "record string, bytes long, sha1 string, intact boolean")
    single = all_.where("type = 'response' and number is null").select("record", "bytes", "sha1", (F.col("sha1") == F.col("digest")).alias("intact"))
    responses = materialize(single.union(joined), "responses")
    revisits = all_.where("type = 'revisit'").select(F.col("record").alias("own"), F.col("refers").alias("record"), "digest")
    resolved = revisits.join(responses, "record", "left").select(F.col("own").alias("record"), F.lit("revisit").alias("record_type"), "bytes", "sha1", F.col("record").alias("refers"), (F.coalesce("intact", F.lit(False)) & F.col("digest").eqNullSafe(F.col("sha1"))).alias("intact"))
    return responses.select("record", F.lit("response").alias("record_type"), "bytes", "sha1", F.lit(None).cast("string").alias("refers"), "intact").union(resolved)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000, segment: int = 16384) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back: the id, payload_bytes, payload_digest, record_type, refers_to, intact.

    Null payloads are empty, null urls about:blank, null ids come before all others. Rows that repeat an id get a record
    each, whose WARC ids also hold the row's number. An empty table gives an empty one. Other columns of pages, whatever
    their names, are not used. pages is a table in files (write_archives).
    """
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, payload_col, least, segment=segment)
    kind = pages.schema[id_col].dataType
    got = read_archives(pages.sparkSession, path)
    return got.select(page_of(F.col("record"), kind).alias(id_col), F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type", page_of(F.col("refers"), kind).alias("refers_to"), "intact")
