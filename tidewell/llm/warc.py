"""WARC archives: writing page captures, and reading them back with reassembly.

Each page becomes a WARC/1.1 response whose HTTP message has chunked transfer
coding; of pages with equal payloads, those with smaller ids become revisits.
A block over ``SEGMENT`` bytes is cut into a first record and continuation
records. Reading groups segments by the identifier of their origin, orders them
by number, verifies the total length, and decodes the chunks.

Archives are written and read with Spark's own sources: one record per line of a
text file whose line separator is the blank line that ends a WARC record, in
gzip files of a bounded number of records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_map, new_path, written

#: Payloads of at least this many bytes are stored once.
LEAST_SHARED = 1000
#: Bytes of a record's block beyond which it is cut, and records of a file: a file holds 32 MiB and headers at most.
SEGMENT, RECORDS = 8192, 4096
CHUNK = 4096
#: Bytes of an archive that are decompressed at once.
PIECE = 1 << 20
#: Names of files that are archives.
ARCHIVES = "*.{warc,warc.gz,txt.gz}"
#: Revisits up to which their table is broadcast when records are typed; more are joined by page.
BROADCAST = 200_000
END = b"\r\n\r\n"
RECORD = "record_id string, page_id long, url string, record_type string, refers_to long, digest string, number int, total long, block binary"
READ = "page_id long, url string, record_type string, refers_to long, digest string, payload binary"


# --- one record --------------------------------------------------------------


def identifier(page_id: int | None, sha1: str, number: int = 1, serial: str = "") -> str:
    """Record identifier: page, start of the payload's digest, serial of the record where rows may repeat, segment."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{sha1[:16].lower()}:{serial}:{number}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer coding of a payload."""
    parts = [b"%x\r\n%b\r\n" % (len(part := payload[k : k + size]), part) for k in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def http_message(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)


def payload_of(message: bytes) -> bytes:
    """The payload of an HTTP message, chunked or not."""
    head, _, body = message.partition(END)
    coding = [x.split(b":", 1)[1].strip().lower() for x in head.split(b"\r\n") if x.lower().startswith(b"transfer-encoding:")]
    return dechunked(body) if coding == [b"chunked"] else body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the blank line that ends it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def records_of(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, segment: int = SEGMENT, serial: str = "") -> Iterator[bytes]:
    """The records of one capture: a revisit, or a response in one or more segments."""
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    target = [("WARC-Target-URI", "".join(url.split()))] if url and url.split() else []
    common = [("WARC-Date", "1970-01-01T00:00:00Z"), *target]
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\n\r\n"
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", identifier(page_id, sha1, serial=serial)), *common, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", identifier(refers_to, sha1)), ("WARC-Payload-Digest", f"sha1:{sha1}"), ("Content-Type", "application/http; msgtype=response")], block)
        return
    block = http_message(payload)
    parts = [block[k : k + segment] for k in range(0, len(block), segment)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", identifier(page_id, sha1, serial=serial)), *common, ("WARC-Payload-Digest", f"sha1:{sha1}"), ("Content-Type", "application/http; msgtype=response")]
    yield _record([*first, ("WARC-Segment-Number", "1")] if len(parts) > 1 else first, parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if k == len(parts) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", identifier(page_id, sha1, k, serial)), *common, ("WARC-Segment-Origin-ID", identifier(page_id, sha1, serial=serial)), ("WARC-Segment-Number", str(k)), *last], part)


def _pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Pieces of bounded size of gzip data of any number of members; of other data as it is."""
    if data[:2] != b"\x1f\x8b":
        for k in range(0, len(data), size):
            yield data[k : k + size]
        return
    at = 0
    while at < len(data):
        z = zlib.decompressobj(31)
        rest = b""
        while not z.eof:
            if not rest:
                rest, at = data[at : at + size], at + size
                if not rest:
                    raise ValueError("an archive's compressed data ends too early")
            yield z.decompress(rest, size)
            rest = z.unconsumed_tail
        at = min(at, len(data)) - len(z.unused_data)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of an archive, one record at a time."""
    pieces, held, at = _pieces(data), bytearray(), 0

    def fill(n: int) -> bool:
        """Read on until n bytes are held after ``at``; whether they are."""
        nonlocal at
        if at > PIECE:
            del held[:at]
            at = 0
        while len(held) - at < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        head_end, seen = held.find(END, at), 0
        while head_end < 0:
            seen = len(held) - at
            if not fill(seen + 1):
                raise ValueError("an archive ends inside a header")
            head_end = held.find(END, max(at, at + seen - len(END)))
        lines = held[at:head_end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts here: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size, head = int(fields["content-length"]), head_end + len(END) - at
        if not fill(head + size):
            raise ValueError("an archive ends inside a record")
        block = bytes(held[at + head : at + head + size])
        fill(head + size + len(END))
        at = min(at + head + size + len(END), len(held))
        yield fields, block


def page_of(identity: str) -> int | None:
    """The page in an identifier that ``identifier`` made; null for any other."""
    parts = identity.strip("<>").split(":")
    return int(parts[2]) if parts[:2] == ["urn", "x-page"] and parts[2].lstrip("-").isdigit() else None


# --- on Spark ----------------------------------------------------------------


def write_archives(pages: DataFrame, path: str, least: int = LEAST_SHARED, segment: int = SEGMENT, records: int = RECORDS) -> None:
    """Write a record per page below ``path``.

    Of pages with equal payloads of at least ``least`` bytes, the one with the
    largest page_id is the response; rows that repeat a page_id are all as that
    page is. A null html is empty and a null page_id is never referred to.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    keys = rows.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull()).select("page_id", F.sha1("payload").alias("d"))
    shared = keys.groupBy("d").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to")
    revisits = keys.join(shared, "d").where("page_id < refers_to").select("page_id", F.concat_ws(":", "d", F.col("refers_to").cast("string")).alias("r"))
    # a repeated page_id may have several payloads: its row finds the one of its own digest
    by_page = written(revisits.groupBy("page_id").agg(F.collect_set("r").alias("refs")), "revisits")
    by_page = F.broadcast(by_page) if by_page.count() <= BROADCAST else by_page
    own = F.get(F.filter("refs", lambda r: F.startswith(r, F.sha1("payload"))), F.lit(0))
    typed = rows.join(by_page, "page_id", "left").select("page_id", "url", "payload", F.substring_index(own, ":", -1).cast("long").alias("refers_to"))

    numbered = [0]

    def run(batch: pa.RecordBatch) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        for page_id, url, data, refers_to in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
            numbered[0] += 1  # tells repeated rows apart
            for record in records_of(page_id, url, data.as_py(), refers_to, segment, f"{part}-{numbered[0]}"):
                yield (record,)

    lines = arrow_map(typed, run, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every capture below ``path``: page_id, url, type, refers_to, digest (hex) and payload.

    Archives are the files named ``*.warc``, ``*.warc.gz`` or ``*.txt.gz``; any
    other file is an error, hidden ones aside. A file is one task, which holds it
    compressed and one record decompressed. A revisit's payload is null; its
    digest is the one its record states. Segments may lie in any order and in
    different files; the same segment twice counts once, missing ones are an
    error. Other records than responses, revisits and continuations are skipped.
    A page_id is null in archives with identifiers of another form. Without
    records there are no rows.
    """
    other = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").where(~F.col("path").rlike(r"(?i)\.(?:warc|warc\.gz|txt\.gz)\z")).head(1)
    if other:
        raise ValueError(f"{other[0]['path']} is no archive")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", ARCHIVES).load(path).select("content")

    def run(batch: pa.RecordBatch) -> Iterator[tuple]:
        for data in batch.column(0):
            for f, block in parse(data.as_py()):
                own, kind = f["warc-record-id"], f["warc-type"]
                if kind not in ("response", "revisit", "continuation"):
                    continue
                digest = f.get("warc-payload-digest")
                number, total = f.get("warc-segment-number"), f.get("warc-segment-total-length")
                whole = number is None
                if whole and kind == "response":
                    block = payload_of(block)
                refers = f.get("warc-refers-to")
                yield (f.get("warc-segment-origin-id", own), page_of(own), f.get("warc-target-uri"), kind, page_of(refers) if refers else None, hexadecimal(digest),
                       int(number) if number else None, int(total) if total else None, None if kind == "revisit" else block)

    parsed = arrow_map(files, run, RECORD)
    whole = parsed.where("number IS NULL").select("page_id", "url", "record_type", "refers_to", "digest", F.col("block").alias("payload"))
    # every row has an origin of its own, so a group is one document's segments
    segments = parsed.where("number IS NOT NULL").groupBy("record_id").agg(F.sort_array(F.collect_set(F.struct("number", "total", "block", "page_id", "url", "digest"))).alias("parts"))

    def join(batch: pa.RecordBatch) -> Iterator[tuple]:
        for origin, parts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield assembled(origin, parts.as_py())

    return whole.unionByName(arrow_map(segments, join, READ))


def hexadecimal(digest: str | None) -> str | None:
    """The hex SHA-1 of a payload digest field, which may have it in base 32 or 16."""
    if not digest or not digest.lower().startswith("sha1:"):
        return None
    value = digest[5:]
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def assembled(origin: str, parts: list[dict]) -> tuple:
    """The capture of a segmented record; repeated records are equal."""
    by_number = {p["number"]: p for p in parts}
    message = b"".join(by_number[k]["block"] for k in sorted(by_number))
    total = next((p["total"] for p in parts if p["total"] is not None), None)
    if sorted(by_number) != list(range(1, len(by_number) + 1)) or total != len(message):
        raise ValueError(f"segments of {origin} are missing: {len(message)} of {total} bytes")
    first = by_number[1]
    return first["page_id"], first["url"], "response", None, first["digest"], payload_of(message)


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages written to archives in the shared folder and read back.

    One row per input row, repeated rows too; null html and null page_id as in
    ``write_archives``; an empty table gives no rows; further columns are
    ignored. A URL loses its white space, an empty one is null.
    """
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)


def digest(captures: DataFrame) -> DataFrame:
    """The contract's columns: a revisit's length is that of the response it refers to."""
    own = captures.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("computed", F.sha1("payload")).drop("payload", "url")
    own = written(own, "captures")  # archives are read once, for responses and for what revisits refer to
    responses = own.where("record_type = 'response'").select("page_id", "payload_bytes", F.coalesce("computed", "digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    sizes = responses.where("page_id IS NOT NULL").select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("size")).distinct()
    revisits = own.where("record_type = 'revisit'").select("page_id", "refers_to", "digest", "record_type").join(sizes, ["refers_to", "digest"], "left")
    return responses.unionByName(revisits.select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"))
