"""WARC archives: written and read by Spark, with segmented records.

A record longer than ``SEGMENT_BYTES`` is split: the first segment keeps the
record's type, the others are ``continuation`` records that name the first
one's id and their number, the last also the total length.  Reading groups the
segments by that id, orders them by number, checks number and total length and
decodes the chunked transfer framing of the HTTP message.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.tables import ROW, with_row_ids
from riskfold.llm.text import PIECE_ROWS, pieces, utf8

#: Payloads of at least this many bytes are stored once.
LEAST_SHARED = 100
SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 16 << 10
#: Records in one archive file; with the segment size, this bounds a file.
FILE_RECORDS = 1000
#: Bytes that a worker reads, unpacks or gives back at once, beside one record or page.
PIECE_BYTES = 1 << 20
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:riskfold:warc")

RECORD = T.StructType([
    T.StructField("record_id", T.StringType(), False), T.StructField("record_type", T.StringType(), False),
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to_id", T.StringType()),
    T.StructField("segment", T.LongType()), T.StructField("origin_id", T.StringType()),
    T.StructField("total", T.LongType()), T.StructField("block", T.BinaryType(), False),
])
#: What a record is known by once its segments are joined.
KEPT = RECORD.names[:6]


def record_name(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, key)}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(message: bytes, at: int = 0) -> bytes:
    """The payload of a message body in chunked framing from ``at`` on; extensions and trailers are skipped."""
    out = []
    while True:
        end = message.index(b"\r\n", at)
        n = int(message[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if len(message) < at + n + 2 or message[at + n: at + n + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out.append(message[at: at + n])
        at += n + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    end = block.index(END)
    head = block[:end].lower()
    return unchunked(block, end + 4) if b"transfer-encoding: chunked" in head else block[end + 4:]


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the blank lines after it, which the writer puts between records."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def _lines_out(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def _uri(url: str | None) -> list[tuple[str, object]]:
    """The address as it is.  Line ends, which no address has, would end the header: they are escaped in it, and the
    page's own text is in a header of ours, from which it is read back."""
    if url is None or url == _lines_out(url):
        return [("WARC-Target-URI", url)]
    return [("WARC-Target-URI", _lines_out(url)), ("Page-Url", _lines_out(url.replace("%", "%25")))]


def _url_of(headers: dict[str, str]) -> str | None:
    own = headers.get("page-url")
    if own is None:
        return headers.get("warc-target-uri")
    return own.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def records_of(
    page_id, row: int, url: str | None, payload: bytes, digest: str, first: bool, shared: bool, segment_bytes: int,
) -> list[bytes]:
    """The records of one page: a revisit, or a response in one or more segments."""
    own = record_name(f"row {row}")
    stored = record_name(f"payload {digest}")
    common = [
        ("WARC-Date", DATE), *_uri(url), ("Page-Id", page_id),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    http = [("Content-Type", "application/http;msgtype=response")]
    if shared and not first:
        return [_record([
            ("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Refers-To", stored),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), *http,
        ], b"HTTP/1.1 200 OK" + END)]
    name = stored if shared else own
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_record([
        ("WARC-Type", "response"), ("WARC-Record-ID", name), *common, *http,
        ("WARC-Segment-Number", 1 if len(parts) > 1 else None),
    ], parts[0])]
    for i, part in enumerate(parts[1:], 2):
        out.append(_record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", record_name(f"{name} {i}")), ("WARC-Date", DATE),
            ("WARC-Segment-Number", i), ("WARC-Segment-Origin-ID", name),
            ("WARC-Segment-Total-Length", len(block) if i == len(parts) else None),
        ], part))
    return out


def unpacked(content: bytes, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """A gzip file's bytes, ``most`` of them at once."""
    stream = zlib.decompressobj(wbits=31)
    for at in range(0, len(content), most):
        data, part = content[at: at + most], b""
        while data or len(part) == most:
            if part := stream.decompress(data, most):
                yield part
            data = stream.unconsumed_tail
    if not stream.eof:
        raise ValueError("an archive file is cut off")


def parsed(parts: Iterable[bytes]) -> Iterator[tuple]:
    """The records of an archive file given in parts, as the columns of ``RECORD``."""
    parts, data, at, before = iter(parts), b"", 0, 0

    def more(least: int) -> bool:
        """Read on until ``least`` bytes are there from ``at`` on; false if the file ends before."""
        nonlocal data, at, before
        held, n = [data[at:]], len(data) - at
        while n < least and (part := next(parts, None)) is not None:
            held.append(part)
            n += len(part)
        before, data, at = before + at, b"".join(held), 0
        return n >= least

    while at < len(data) or more(1):
        while (end := data.find(END, at)) < 0:
            if not more(len(data) - at + 1):
                raise ValueError(f"the record at byte {before + at} has no end of its headers")
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {before + at}")
        h = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        n = int(h["content-length"])
        size = end + 4 - at + n + 4
        if len(data) - at < size:
            more(size)
        start = at + size - 4 - n
        if data[start + n: start + n + 4] != END:
            raise ValueError(f"the record at byte {before + at} has another length than it says")
        number = lambda k: int(h[k]) if k in h else None
        yield (
            h["warc-record-id"], h["warc-type"], number("page-id"), _url_of(h),
            h["warc-payload-digest"].removeprefix("sha256:") if "warc-payload-digest" in h else None,
            h.get("warc-refers-to"), number("warc-segment-number"), h.get("warc-segment-origin-id"),
            number("warc-segment-total-length"), data[start: start + n],
        )
        at = start + n + 4


def _batches(rows: Iterable[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """``rows``, whose last column is binary, in batches of about ``PIECE_BYTES``."""
    arrow = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()])
                       for f in schema])

    def batch_of(held):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), arrow.types)], schema=arrow)

    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[-1] or b"")
        if n >= PIECE_BYTES or len(held) >= PIECE_ROWS:
            yield batch_of(held)
            held, n = [], 0
    if held:
        yield batch_of(held)


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_shared: int = LEAST_SHARED, segment_bytes: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS,
) -> None:
    """Write a record for each row of ``pages`` into gzip archive files under ``path``.

    Of rows with equal payloads of at least ``least_shared`` bytes, the one
    with the smallest page id (null last; of repeated rows any one) is the
    response, the others revisit it.  A null html is an empty payload.  The
    text writer puts each record's bytes between blank lines, so Spark's
    commit protocol covers the archives.  Until then the payloads are kept and
    shuffled deflated.  A worker holds a batch as it comes, ``PIECE_BYTES`` of
    what it makes of it, and one page with its records.
    """
    given = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
    )

    def pack(batches):
        for batch in batches:
            for part in pieces(batch, 2, PIECE_BYTES):
                payloads = utf8(part.column(2))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([zlib.compress(p, 6) for p in payloads], pa.binary()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads]), pa.array(list(map(len, payloads)), pa.int64()),
                ], names=["page_id", "url", "payload", "digest", "bytes"])

    rows = with_row_ids(
        given.mapInArrow(pack, "page_id long, url string, payload binary, digest string, bytes long"), "warc-pages")
    shared = F.col("bytes") >= least_shared
    firsts = rows.where(shared).groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull(), "page_id", ROW))[ROW].alias("first"), F.count(F.lit(1)).alias("copies"),
    ).where("copies > 1").select("digest", "first")
    decided = rows.join(firsts, "digest", "left").select(
        "page_id", ROW, "url", F.when(F.col("first").isNull() | (F.col("first") == F.col(ROW)), F.col("payload")).alias("payload"),
        "digest", (F.col("first").isNull() | (F.col("first") == F.col(ROW))).alias("is_first"), shared.alias("is_shared"),
    )

    def records(batches):
        for batch in batches:
            for part in pieces(batch, 3, PIECE_BYTES):
                for page, row, url, data, digest, first, is_shared in zip(*(c.to_pylist() for c in part.columns)):
                    whole = b"" if data is None else zlib.decompress(data)
                    for r in records_of(page, row, url, whole, digest, first, is_shared, segment_bytes):
                        yield (r,)

    schema = T.StructType([T.StructField("record", T.BinaryType())])

    def run(batches):
        yield from _batches(records(batches), schema)

    decided.mapInArrow(run, schema).select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", END.decode()
    ).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def _read(spark: SparkSession, path: str, schema: T.StructType, rows_of: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """The rows that ``rows_of`` makes of each file's records; a task reads whole files, unpacked ``PIECE_BYTES`` at once."""

    def run(batches):
        yield from _batches(
            (r for batch in batches for i in range(batch.num_rows) for r in rows_of(parsed(unpacked(batch.column(0)[i].as_py())))),
            schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path``, of files of ``FILE_RECORDS`` segments at most each."""
    return _read(spark, path, RECORD, lambda records: records)


def reassembled(records: DataFrame) -> DataFrame:
    """Records with their continuations joined: ``RECORD`` without the segment columns.

    Only segments are shuffled, grouped by the id of their first; a group is
    one record.  Missing or repeated segments and a wrong total length fail.
    """
    whole = records.where("segment is null").select(*KEPT, "block")
    return whole.unionByName(_joined(records.where("segment is not null")))


def _joined(segments: DataFrame) -> DataFrame:
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    grouped = segments.groupBy(
        F.coalesce("origin_id", "record_id").alias("record_id")
    ).agg(
        *[first(c) for c in KEPT[1:]], F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    sizes = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    good = (numbers == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))) & (sizes == F.col("total"))
    return grouped.select(
        *KEPT,
        F.when(good, F.aggregate("parts", F.lit(b"").cast("binary"), lambda b, p: F.concat(b, p["block"])))
        .otherwise(F.raise_error(F.concat(F.lit("segments are missing of "), "record_id")).cast("binary")).alias("block"),
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits under ``path``, with the payload of each response.

    ``record_id, record_type, page_id, url, payload_digest`` (as the header has
    it), ``refers_to_id, payload`` (null for revisits).  Records in one segment
    get their payload where they are read, others once they are joined, so a
    task has one worker.
    """
    n = len(KEPT)
    schema = T.StructType([*RECORD.fields[:n], T.StructField("payload", T.BinaryType())])
    number = RECORD.names.index("segment")
    whole = _read(spark, path, schema, lambda records: (
        (*r[:n], payload_of(r[-1]) if r[1] == "response" else None) for r in records if r[number] is None))
    segments = _read(spark, path, RECORD, lambda records: (r for r in records if r[number] is not None))

    def run(batches):
        yield from _batches((
            (*row[:n], payload_of(row[n]) if row[1] == "response" else None)
            for batch in batches for part in pieces(batch, n, PIECE_BYTES)
            for row in zip(*(c.to_pylist() for c in part.columns))
        ), schema)

    return whole.unionByName(_joined(segments).mapInArrow(run, schema))
