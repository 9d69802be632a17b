"""WARC archives with segmented records (operator 8).

Writing: a page is a response record: an HTTP head and the payload in chunked transfer framing. Blocks longer than a segment are cut: the
first part stays a response record with WARC-Segment-Number 1, the others are continuation records that name it as their origin, and
the last one gives the total length. Pages of equal payloads have one response, the one of the largest id; the others are revisit
records without a payload that refer to it. Every record is a gzip member of its own.

Reading: unsegmented records are decoded where they are read. Segments are grouped by their origin's identifier, ordered by number
and checked: the numbers run from 1, the total length holds. Then the chunked framing is decoded and the payload's digest is checked.
A revisit's length comes from the response that it refers to. Whatever does not hold raises ValueError.

Defined results: null payloads count as empty; a null url has a placeholder; null page ids and rows that repeat the largest id (a tie)
are responses of their own; very long payloads are held whole by one task each; extra columns are dropped, whatever their names; an
empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import put_file, shared_dir, stored, tidy

SEGMENT = 64 << 10
CHUNK = 8 << 10
#: Compressed bytes of an archive at which the next one begins, and parts that a payload's copies are dealt to.
FILE_BYTES, SALTS = 8 << 20, 32
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunked body without a last chunk")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk's length does not hold")
        out.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode()
    packer = zlib.compressobj(1, wbits=31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an archive."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, pieces = zlib.decompressobj(wbits=31), []
        while not member.eof:
            if at >= len(view):
                raise ValueError("a record is cut off")
            pieces.append(member.decompress(view[at : at + 16_384]))  # in parts: what is unused of each is copied
            at += min(16_384, len(view) - at)
        at -= len(member.unused_data)
        raw = b"".join(pieces)
        head, _, rest = raw.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        size = int(headers["content-length"])
        if rest[size:] != b"\r\n\r\n":
            raise ValueError("a record's length does not hold")
        yield headers, rest[:size]


def page_records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, unique: str, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page."""
    name = f"<urn:page:{page_id}:{unique}>"
    uri = url.replace("\r", "%0D").replace("\n", "%0A") if url else f"urn:page:{page_id}"
    same = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("X-Page-ID", page_id)]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    kind = [("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *same, ("WARC-Profile", profile), ("WARC-Refers-To", f"<urn:page:{refers_to}>"), *kind], head)
        return
    block = head + chunked(payload)
    if len(block) <= segment:
        yield record([("WARC-Type", "response"), ("WARC-Record-ID", name), *same, *kind], block)
        return
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield record([("WARC-Type", "response"), ("WARC-Record-ID", name), *same, ("WARC-Segment-Number", 1), *kind], parts[0])
    for i, part in enumerate(parts[1:], 2):
        last = len(block) if i == len(parts) else None
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{i}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", i), ("WARC-Segment-Total-Length", last)], part)


def payload_of(block: bytes, expected: str) -> bytes:
    """The payload of a whole response block, its digest checked."""
    head, _, body = block.partition(b"\r\n\r\n")
    payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    if f"sha1:{digest(payload)}" != expected:
        raise ValueError("a payload's digest does not hold")
    return payload


def write(spark: SparkSession, pages: DataFrame, least: int = 0, segment: int = SEGMENT, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the archives and returns their manifest (uri, n_records). Payloads of fewer than least bytes are never revisited.

    Copies find their response by a sum per digest, joined to the pages in SALTS parts, so no task gets all copies of a payload. The sums
    are not broadcast: their size has no bound.
    """
    folder = shared_dir(spark, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    key = [F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").alias("size")]
    rows = rows.select("*", *key, F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt"))
    keys = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(html), F.lit("")).alias("html")).select("page_id", *key)
    copies = keys.where(f"page_id is not null and size >= {least}").groupBy("sha", "size").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1")
    copies = copies.select("sha", "size", "head", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    placed = rows.join(copies.hint("merge"), ["sha", "size", "salt"], "left").select("page_id", "url", "html", F.when(F.col("head") != F.col("page_id"), F.col("head")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, held, size, count, row = TaskContext.get().partitionId(), 0, [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal number, held, size, count
            uri = f"{folder}/{shard:06d}-{number:06d}-{uuid.uuid4().hex}.warc.gz"
            put_file(uri, b"".join(held))
            done = pa.RecordBatch.from_pydict({"uri": [uri], "n_records": pa.array([count], pa.int64())})
            number, held, size, count = number + 1, [], 0, 0
            return done

        for batch in batches:
            for i in range(len(batch)):
                page, link, text, refers = (batch.column(c)[i].as_py() for c in range(4))
                for packed in page_records(page, link, text.encode(), refers, f"{shard}-{row}", segment):
                    held.append(packed)
                    size, count = size + len(packed), count + 1
                    if size >= FILE_BYTES:
                        yield close()
                row += 1
        if held:
            yield close()

    return stored(spark, placed.mapInArrow(tidy(run), "uri string, n_records long"), "warc-manifest")


_PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _archives(batch: pa.RecordBatch) -> Iterator[tuple[dict[str, str], bytes]]:
    from pyarrow import fs

    for uri in batch.column(0).to_pylist():
        store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_stream(path, compression=None) as f:
            yield from parse(f.read())


_COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int64())


def _pages(rows: list[tuple]) -> pa.RecordBatch:
    """Pages, or segments: their block as the payload, with origin, number and total length."""
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], [*_COLUMNS, "origin", "number", "total"])


def _int(value: str | None) -> int | None:
    return None if value in (None, "None") else int(value)


def read(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of each page in the manifest's archives.

    The archives are read once. payload is null for revisits, and for all if payloads is false (it is decoded and checked all the same).
    """
    files = manifest.select("uri").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages that are one record, and the segments of the others."""
        rows, size = [], 0
        for batch in batches:
            for h, block in _archives(batch):
                page, sha = _int(h.get("x-page-id")), h.get("warc-payload-digest")
                if "warc-segment-number" in h:
                    origin = h["warc-record-id"] if h["warc-type"] != "continuation" else h["warc-segment-origin-id"]
                    rows.append((page, None, sha, None, None, block, origin, int(h["warc-segment-number"]), _int(h.get("warc-segment-total-length"))))
                elif h["warc-type"] == "revisit":
                    rows.append((page, None, sha[5:], "revisit", int(h["warc-refers-to"][10:-1]), None, None, None, None))
                else:
                    payload = payload_of(block, sha)
                    rows.append((page, len(payload), sha[5:], "response", None, payload if payloads else None, None, None, None))
                size += len(block)
                if size > 4 << 20 or len(rows) >= 2000:
                    yield _pages(rows)
                    rows, size = [], 0
        if rows:
            yield _pages(rows)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segments in batch.column(0).to_pylist():
                if [s["number"] for s in segments] != list(range(1, len(segments) + 1)):
                    raise ValueError("segments are missing")
                block = b"".join(s["block"] for s in segments)
                if segments[-1]["total"] != len(block):
                    raise ValueError("a segmented record's total length does not hold")
                payload = payload_of(block, segments[0]["sha"])
                sha = segments[0]["sha"][5:]
                yield _pages([(segments[0]["page_id"], len(payload), sha, "response", None, payload if payloads else None, None, None, None)]).select(_COLUMNS)

    records = stored(spark, files.mapInArrow(tidy(one_pass), f"{_PAGE}, origin string, number int, total long"), "warc-records")
    part = F.struct("number", "total", "page_id", F.col("payload_digest").alias("sha"), F.col("payload").alias("block"))
    cut = records.where("origin is not null").groupBy("origin").agg(F.sort_array(F.collect_list(part)).alias("segments"))
    pages = records.where("origin is null").select(_COLUMNS).unionAll(cut.select("segments").mapInArrow(tidy(joined), _PAGE))
    return pages if payloads else stored(spark, pages, "warc-pages")


def resolved(pages: DataFrame) -> DataFrame:
    """Pages of read() with each revisit's payload_bytes, taken from the response that it refers to and whose digest it shares.

    The join may not broadcast: its size would be guessed from the small manifest.
    """
    head = pages.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("bytes"))
    return pages.join(head.hint("merge"), ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "bytes")).drop("bytes")
