"""WARC archives: captures written as records, records assembled into captures.

A capture is a transaction of three records: the response (or, where an equal
payload is archived already, a revisit), the request and metadata. The latter
two name the first in WARC-Concurrent-To. Reading frames records by their
lengths and joins them through these identifiers into one nested row a capture.
"""

import hashlib
import io
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisflow.sources import archives
from aisflow.storage import written

# Names of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"

#: Smaller payloads are archived in full every time.
LEAST_REVISIT = 100
#: Captures of a file; three records each.
FILE_CAPTURES = 10_000
#: Digests that may be broadcast (72 bytes each), and bytes of records that a task hands over at a time.
BROADCAST_DIGESTS = 200_000
BATCH_BYTES = 8 << 20

RECORDS = (
    "type string, record_id string, concurrent_to string, refers_to string, uri string, date string, "
    "digest string, http_length long, fields map<string,string>, bytes long, sha256 string, payload binary"
)


def _lines(*pairs: tuple[str, Column | str]) -> Column:
    """Header lines; a null value leaves its line out."""
    parts = [F.concat(F.lit(name + ": "), F.lit(v) if isinstance(v, str) else v, F.lit(_END)) for name, v in pairs]
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def _record(kind: Column | str, record_id: Column, headers: Column, block: Column) -> Column:
    first = _lines(("WARC-Type", kind), ("WARC-Record-ID", record_id))
    length = F.octet_length(block).cast("string")
    return F.concat(F.lit(VERSION + _END), first, headers, _lines(("Content-Length", length)), F.lit(_END), block)


def _urn(*of: Column | str) -> Column:
    """A record id from what it stands for."""
    hex_ = F.md5(F.concat_ws("\t", *[F.lit(x) if isinstance(x, str) else x.cast("string") for x in of]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(hex_, at, n) for at, n in cuts]), F.lit(">"))


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, bytes, first_id: the page to which a payload's revisits refer.

    Only digests with several pages are joined back, by broadcast while they are
    few; bodies are shuffled only if they are not.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    told = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("payload"))
    told = told.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    groups = told.where(F.col("bytes") >= LEAST_REVISIT).groupBy(F.col("digest").alias("_digest"))
    several = groups.agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest", "first_id")
    several = written(several, "digests")
    if several.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        several = F.broadcast(several)
    return told.join(several, F.col("digest") == F.col("_digest"), "left").drop("_digest")


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", file_captures: int = FILE_CAPTURES) -> None:
    """Writes three records per row of (page_id, url, html) to gzip files below ``path``.

    Of rows with equal payloads of LEAST_REVISIT bytes or more, those with the
    smallest page_id are responses and the others revisits of it. A null html is
    an empty payload; a null url leaves the target out, and line ends and spaces
    in it are percent-encoded. Repeated rows are captures of their own, with a
    common id. Every file is committed by Spark's writer, so a lost executor
    leaves no half of one.
    """
    told = captures(pages)
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    uri = F.col("url")
    for raw, safe in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        uri = F.replace(uri, F.lit(raw), F.lit(safe))
    main = _urn("response", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.col("digest"))
    first = _urn("response", F.col("first_id"), F.col("digest"))
    told = told.withColumns({"revisit": revisit, "uri": uri, "main": main})
    base = _lines(("WARC-Date", date), ("WARC-Target-URI", F.col("uri")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + _END),
        _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("bytes").cast("string"))),
        F.lit(_END),
    )
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    about = _lines(
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.when(F.col("revisit"), first)),
    )
    kind = F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    response = _record(kind, F.col("main"), F.concat(base, about), F.concat(http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload"))))
    beside = _lines(("WARC-Concurrent-To", F.col("main")))
    asked = F.concat(F.lit("GET "), F.coalesce("uri", F.lit("/")), F.lit(" HTTP/1.1" + _END), F.lit(_END))
    request_about = F.concat(base, beside, _lines(("Content-Type", "application/http; msgtype=request")))
    request = _record("request", _urn("request", F.col("main")), request_about, asked)
    known = _lines(("page-id", F.col("page_id").cast("string")), ("fetched", date))
    metadata_about = F.concat(base, beside, _lines(("Content-Type", "application/warc-fields")))
    metadata = _record("metadata", _urn("metadata", F.col("main")), metadata_about, known)
    lines = told.select(F.explode(F.array(request, response, metadata)).alias("value"))
    writer = lines.write.mode("overwrite").option("lineSep", _END * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", 3 * file_captures).text(path)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {line[:80]!r}")
        headers = _headers(stream)
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("the archive ends within a record")
        yield headers, block


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        found[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return found


class _Unzipped(io.RawIOBase):
    """Reads gzip members one after the other, a part at a time; plain bytes as they are. The source
    is bytes or a file."""

    def __init__(self, source) -> None:
        self.source = io.BytesIO(source) if isinstance(source, bytes) else source
        self.held = self.source.read(1 << 16)
        self.zipped = self.held[:2] == b"\x1f\x8b"
        self.unzip = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def _more(self) -> bytes:
        found, self.held = self.held or self.source.read(1 << 16), b""
        return found

    def readinto(self, out) -> int:
        if not self.zipped:
            part = self._more()
            part, self.held = part[: len(out)], part[len(out) :]
            out[: len(part)] = part
            return len(part)
        while True:
            if self.unzip.eof:
                self.held = self.unzip.unused_data or self.source.read(1 << 16)
                if not self.held:
                    return 0
                self.unzip = zlib.decompressobj(31)
            fresh = self.unzip.unconsumed_tail or self._more()
            part = self.unzip.decompress(fresh, len(out))
            if part:
                out[: len(part)] = part
                return len(part)
            if not fresh and not self.unzip.eof:
                raise ValueError("the archive ends within a gzip member")


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, payload, http_length, fields, size, sha256 = headers.get("warc-type"), None, None, None, None, None
    if kind in ("response", "revisit") and headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _headers(io.BytesIO(head.partition(b"\r\n")[2] + b"\r\n\r\n"))
        http_length = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
        payload = None if kind == "revisit" else payload
        if payload is not None:
            size, sha256 = len(payload), hashlib.sha256(payload).hexdigest()
    elif kind == "metadata":
        fields = list(_headers(io.BytesIO(block + b"\r\n")).items())
    digest = headers.get("warc-payload-digest")
    names = ("warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date")
    return (kind, *(headers.get(n) for n in names), digest, http_length, fields, size, sha256, payload if payloads else None)


@contextmanager
def _opened(path: str, content: bytes | None) -> Iterator[io.BufferedReader]:
    """An archive as a stream of plain bytes, from its content or from its file system."""
    if content is not None:
        yield io.BufferedReader(_Unzipped(content), 1 << 16)
        return
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as stream:
        yield io.BufferedReader(_Unzipped(stream), 1 << 16)


def _records(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = [part.strip().split(" ")[0] for part in RECORDS.replace("map<string,string>", "map").split(",")]
    kinds = [pa.string()] * 7 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, held = [], 0
            with _opened(path, content.as_buffer().to_pybytes() if content.is_valid else None) as stream:
                for headers, block in parse(stream):
                    rows.append(_row(headers, block, payloads))
                    held += (len(block) if payloads else 0) + 1000
                    if held > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """RECORDS of all archives below ``path``, gzip or plain; a broken one is an error, an empty folder
    has none. ``bytes`` and ``sha256`` are of a response's payload as read, and are there without
    ``payloads`` as well. Request blocks and other types' blocks are not returned.

    Archives on a file system that tasks can open are streamed, whatever their
    size; others are taken in whole and must be smaller than 2 GB.
    """
    found = spark.read.format("binaryFile").load(path)
    listed = [row["path"] for row in found.select("path").collect()]
    if listed and all(archives.can_stream(p) for p in listed):
        # one archive a partition, by a list of paths, which holds one for FILE_CAPTURES pages
        files = spark.createDataFrame([(p,) for p in sorted(listed)], "path string").repartition(len(listed), "path")
        files = files.withColumn("content", F.lit(None).cast("binary"))
    else:
        files = found.select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _records(batches, payloads)

    return files.mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, uri, date, response, request, metadata.

    Requests and metadata are joined to the response or revisit that they are
    concurrent to; where several are, the one with the smallest id counts, where
    none is, the struct is null. ``response`` has type, digest (bare hexadecimal),
    bytes, payload (null for revisits) and refers_to, the record that holds it.
    Digest and length of a response are those of the payload read, of a revisit
    those it states. Records concurrent to nothing that is there are left out.
    """
    full = F.col("type") == "response"
    digest = F.when(full, F.col("sha256")).otherwise(F.regexp_replace("digest", "^sha256:", ""))
    size = F.when(full, F.col("bytes")).otherwise(F.col("http_length"))
    main = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", "uri", "date",
        F.struct("type", digest.alias("digest"), size.alias("bytes"), "payload", "refers_to").alias("response"),
    )

    def beside(kind: str, *values: str) -> DataFrame:
        own = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        least = own.groupBy(F.col("concurrent_to").alias(f"_{kind}")).agg(F.min_by(F.struct("record_id", *values), "record_id").alias(kind))
        return least

    for kind, values in (("request", ["uri", "date"]), ("metadata", ["fields"])):
        other = beside(kind, *values)
        main = main.join(other, F.col("record_id") == F.col(f"_{kind}"), "left").drop(f"_{kind}")
    return main


def page_ids(assembled: DataFrame, records: DataFrame) -> DataFrame:
    """The captures with page_id, from their metadata, and refers_to, the page whose response a
    revisit refers to, from the metadata that are concurrent to that response.

    A response may have any number of revisits: the pages are stored, so that
    Spark can split the revisits of one in the join. Captures that refer to
    nothing get keys of their own instead of a common null.
    """

    def page(fields: str) -> Column:
        return F.col(fields)["page-id"].cast("long")

    known = records.where((F.col("type") == "metadata") & F.col("concurrent_to").isNotNull())
    pages = written(known.groupBy(F.col("concurrent_to").alias("_first")).agg(F.min(page("fields")).alias("_page")), "pages")
    named = assembled.withColumn("page_id", page("metadata.fields"))
    key = F.coalesce("response.refers_to", F.concat(F.lit("none "), "record_id"))
    joined = named.withColumn("_key", key).join(pages, F.col("_key") == F.col("_first"), "left")
    return joined.withColumn("refers_to", F.col("_page")).drop("_key", "_first", "_page")
