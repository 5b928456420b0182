"""WARC archives with an index, read back by byte ranges.

Each task writes archives of compressed records and gives back a row of the index
per record: file, offset, length, URL, digest. The index is a table that Spark
commits, so an archive of a task that was lost or ran twice is simply not in it.
Reading starts from the index: the wanted records are sorted by place, neighbours
are joined to one read, and the records are cut out of it.
"""

import gzip
import hashlib
import re
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import as_bytes, runs
from gleanspark.llm.files import coalesced, opened
from gleanspark.operators.skew import is_small
from gleanspark.workspace import settle

# Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 * 1024 * 1024
# A read joins records up to this gap and size.
GAP_BYTES, READ_BYTES = 64 * 1024, 8 * 1024 * 1024
# Records that lie in one part of an archive of this size are read by one task.
PART_BYTES = 64 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "page_id string, url string, payload_digest string, payload_bytes bigint, "
    "record_type string, refers_to string, file string, offset bigint, length bigint"
)


def _record(row: dict, name: str, at: int) -> bytes:
    """One record as a member of its own; a revisit has the HTTP head, but no payload.

    Its id comes from its place in the archive, so no two records share one.
    """
    original = row["original"]
    fields = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
    ]
    if row["page"] is not None:
        fields.append(("X-Page-ID", quote(row["page"], safe="")))
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _uri(row["url"])))
    if original is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To-Date", DATE)]
        if row["original_url"] is not None:
            fields.append(("WARC-Refers-To-Target-URI", _uri(row["original_url"])))
        fields.append(("X-Refers-To-Page-ID", quote(original, safe="")))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    block = http.encode() + (row["payload"] if original is None else b"")
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def fields_of(lines: list[str]) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines)


def parsed(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header fields, HTTP header fields and payload of a record."""
    head, _, rest = gzip.decompress(record).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record: {lines[0]!r}")
    fields = fields_of(lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, fields_of(http.decode().split("\r\n")[1:]), payload


def _marked(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Pages with digest, size and, for a revisit, the page it refers to."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("size"),
    )
    originals = (
        rows.where(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max(F.struct("page", "url")).alias("last"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("last.page").isNotNull())
        .select(
            "digest", F.col("last.page").alias("original"), F.col("last.url").alias("original_url")
        )
    )
    originals = settle(originals, "originals")
    if is_small(originals):
        originals = F.broadcast(originals)
    marked = rows.join(originals, "digest", "left")
    return marked.withColumn(
        "original", F.when(~F.col("page").eqNullSafe(F.col("original")), F.col("original"))
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write all pages to archives under ``path``; the index, read from its table.

    Null html is an empty payload, a null URL or id has no header. Of equal payloads
    of at least ``REVISIT_BYTES`` the page with the largest id is the response, and rows
    that repeat it are responses too; a null id is no largest one. Without any id, all
    are responses. An empty table gives an empty index. Other columns are not read,
    whatever their names. A page is held in memory whole, however long.

    A table of pages has no HTTP heads, so each record gets a plain one of status 200
    before its payload; digest and size are the payload's alone.
    """

    def write(batches):
        files, base = opened(f"{path}/archives")
        files.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                found = []
                for row in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    record = _record(row, name, at)
                    out.write(record)
                    kind = "response" if row["original"] is None else "revisit"
                    found.append((name, at, len(record), kind))
                    at += len(record)
                names, offsets, lengths, kinds = zip(*found, strict=True) if found else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page"),
                        batch.column("url"),
                        batch.column("digest"),
                        batch.column("size"),
                        pa.array(kinds, pa.string()),
                        batch.column("original"),
                        pa.array(names, pa.string()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()),
                    ],
                    names=[c.split()[0] for c in INDEX.split(", ")],
                )
        finally:
            if out is not None:
                out.close()

    marked = _marked(pages, id_col, url_col, html_col)
    marked = marked.withColumns({n: F.col(n).cast("string") for n in ("page", "original")})
    marked.mapInArrow(write, INDEX).write.parquet(f"{path}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{path}/index")


def read_records(wanted: DataFrame, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the index rows ``wanted``, from the archives.

    ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to`` as their headers say (ids as strings), and ``payload``, which
    a revisit has not. A payload that does not fit its digest is an error.
    """

    def read(batches):
        files, base = opened(f"{path}/archives")
        for rows in runs(batches, "job"):
            ranges = list(
                zip(rows.column("offset").to_pylist(), rows.column("length").to_pylist(), strict=True)
            )
            with files.open_input_file(f"{base}/{rows.column('file')[0].as_py()}") as file:
                for offset, length, first, last in coalesced(ranges, GAP_BYTES, READ_BYTES):
                    held = file.read_at(length, offset)
                    found = [
                        _row(held[at - offset : at - offset + size], with_payload)
                        for at, size in ranges[first:last]
                    ]
                    columns = dict(zip(names, zip(*found, strict=True), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[n], t) for n, t in zip(names, kinds, strict=True)], names=names
                    )

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    schema = (
        "page_id string, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to string"
    )
    if with_payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], schema + ", payload binary"
    part = F.call_function("div", F.col("offset"), F.lit(PART_BYTES))
    jobs = wanted.select(F.xxhash64("file", part).alias("job"), "file", "offset", "length")
    # By file too, should two of them have one job's number.
    dealt = jobs.repartition("job").sortWithinPartitions("job", "file", "offset")
    return dealt.mapInArrow(read, schema)


def _row(record: bytes, with_payload: bool) -> tuple:
    fields, http, payload = parsed(record)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"a payload does not fit its digest {digest}")
    page, original = (fields.get(n) for n in ("X-Page-ID", "X-Refers-To-Page-ID"))
    row = (
        None if page is None else unquote(page),
        fields.get("WARC-Target-URI"),
        int(http["Content-Length"]),
        digest,
        kind,
        None if original is None else unquote(original),
    )
    return (*row, payload if kind == "response" else None) if with_payload else row
