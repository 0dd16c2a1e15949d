"""WARC archives: written as one gzip stream, normalised to one member per record, read by index.

A whole-file gzip stream cannot be entered in the middle.  The normaliser inflates such a
stream once, writes every record again as a member of its own and leaves an index beside the
archive, so that any record can be read by offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm import files
from marlstone.llm.common import encoded, stored, table
from marlstone.session import scratch_path

LEAST_REVISIT_BYTES = 1000
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def _one_line(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def warc_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record; a revisit keeps the HTTP header and the full payload's digest and length, not the payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page is None else page}>"),
        ("WARC-Date", date),
        *([("WARC-Target-URI", _one_line(url))] if url else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + END


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(END)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def inflated(source):
    """The content of a gzip file of one or many members, piece by piece."""
    opener = zlib.decompressobj(31)
    while data := source.read(READ_BYTES):
        while data:
            yield opener.decompress(data)
            data = b""
            if opener.eof:
                data, opener = opener.unused_data, zlib.decompressobj(31)


def records_of(pieces):
    """Whole records from a stream of bytes; holds one record and one piece at a time."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                at = held.find(END)
                if at < 0:
                    break
                length = re.search(rb"\r\nContent-Length: *(\d+)", bytes(held[:at + 2]), re.I)
                if not length:
                    raise ValueError("record without a length")
                need = at + 4 + int(length[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("archive is cut short")


def _page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write one gzip stream per task; returns the committed archives as rows (path).

    A null html is an empty payload, a null url is left out, a null page_id never serves as response
    to others (such rows are responses themselves when their group has no other id).  Rows that repeat
    the kept page_id are all responses.  Empty table: no archive.  Other columns are not read.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    digested = pages.select("page_id", "url", html.alias("html")).withColumn(
        "digest", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    copies = digested.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "bytes", "keeper")
    # A written table has a known size: Spark broadcasts it below its limit and sort-merges above,
    # where the adaptive planner splits a digest that holds many pages.
    marked = digested.join(stored(copies, "warc-copies"), ["digest", "bytes"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    rows = marked.select(F.col("page_id").cast("long"), "url", "html", refers.cast("long").alias("refers_to"))

    def write(batches):
        path = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if path is None:
                path = files.unique_name(folder, "stream", ".warc.gz")
                opened = files.writing(path)
                out, packer = opened.__enter__(), zlib.compressobj(6, zlib.DEFLATED, 31)
            for i in range(0, batch.num_rows, 256):
                for row in batch.slice(i, 256).to_pylist():
                    record = warc_record(row["page_id"], row["url"], encoded(row["html"]), row["refers_to"])
                    out.write(packer.compress(record))
        if path is not None:
            out.write(packer.flush())
            opened.__exit__(None, None, None)
            yield pa.RecordBatch.from_pydict({"path": [path]})

    return stored(rows.mapInArrow(write, "path string"), "warc-streams")


def _spread(paths: DataFrame) -> DataFrame:
    """One task per archive; without a number, the small rows would be put into one task."""
    return paths.repartition(max(1, paths.count()))


def normalise_archives(streams: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with one gzip member per record; returns (path, index, records)."""
    def rewrite(batches):
        for batch in batches:
            for source_path in batch.column("path").to_pylist():
                path = files.unique_name(folder, "records", ".warc.gz")
                at, index = 0, io.StringIO()
                with files.reading(source_path) as source, files.writing(path) as out:
                    for n, record in enumerate(records_of(inflated(source)), 1):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(record) + packer.flush()
                        out.write(member)
                        index.write(f"{at}\t{len(member)}\n")
                        at += len(member)
                sidecar = path.removesuffix(".warc.gz") + ".idx"
                with files.writing(sidecar) as out:
                    out.write(index.getvalue().encode())
                yield pa.RecordBatch.from_pydict({"path": [path], "index": [sidecar], "records": [n]})

    return stored(_spread(streams.select("path")).mapInArrow(rewrite, "path string, index string, records long"),
                  "warc-normal")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record through the index, by offset and length; digests of stored payloads are checked."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def read(batches):
        for batch in batches:
            for path, sidecar in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist()):
                with files.reading(sidecar) as source:
                    entries = [tuple(map(int, line.split(b"\t"))) for line in source.read().splitlines()]
                rows: list[tuple] = []
                with files.reading(path) as source:
                    for at, length in entries:
                        source.seek(at)
                        fields, block = parse_record(zlib.decompress(source.read(length), 31))
                        http, _, payload = block.partition(END)
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        kind = fields["warc-type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"payload of {fields['warc-record-id']} in {path} is damaged")
                        rows.append((_page_of(fields["warc-record-id"]), size, digest, kind,
                                     _page_of(fields.get("warc-refers-to"))))
                        if len(rows) >= 2048:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _spread(archives.select("path", "index")).mapInArrow(read, schema)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm-warc")
    return read_archives(normalise_archives(write_archives(table(spark, sf_dir, "pages"), folder), folder))


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), q AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS keeper FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM q
"""
