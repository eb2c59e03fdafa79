"""WARC archives: written by tasks, read back by a splittable reader.

Writer: each task writes one file of gzip members, one WARC record per member, under a
name of its own in the given folder, and returns (path, bytes, records). These rows are
stored, so what a failed or doubled task attempt has left behind is never read.

Payloads seen before become ``revisit`` records that refer to the ``response`` with the
smallest page id. The digest, not the payload, is grouped; digests with a large share of
all rows, of which there can only be few, are joined by broadcast.

Reader: files are cut into byte ranges without looking into them. A task searches its
range for the gzip magic, takes a place as the start of a record only if the member
inflates to a full, well-formed WARC record with a right checksum that ends where the file
or another member does, and from there goes from member to member. It owns the records
that start inside its range and reads on past the end for the last one.
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

from ..session import materialise, scratch_path
from .files import make_folder, resolve
from .shipping import map_arrow

MAGIC = b"\x1f\x8b\x08"
STEP = 1 << 18
#: A digest of more than one in so many rows is hot; so there are at most this many.
HOT_SHARE = 1000

_MANIFEST = "path string, bytes long, records long"
_RECORDS = (
    "path string, position long, record_type string, record_id string, target_uri string, page_id long, payload_digest string, "
    "payload_bytes long, refers_to long, payload binary"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: dict[str, str], block: bytes) -> bytes:
    """One WARC record as a gzip member."""
    head = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}", "", ""]
    # Level 1: HTML packs well, and writing is bound by the packer.
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _one_line(value: str | None) -> str:
    return " ".join((value or "").split())


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = resolve(folder)
        path = f"{root}/{uuid.uuid4().hex}.warc.gz"
        out, size, count = None, 0, 0
        for batch in batches:
            for page, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                fields = {
                    "WARC-Type": "response" if first is None else "revisit",
                    "WARC-Record-ID": _record_id(page, digest),
                    "WARC-Date": "1970-01-01T00:00:00Z",
                    "WARC-Target-URI": _one_line(url),
                    "WARC-Payload-Digest": f"sha1:{digest}",
                    "WARC-Page-ID": "" if page is None else str(page),
                    "WARC-Payload-Length": str(len(payload)),
                }
                if first is not None:
                    fields["WARC-Refers-To"] = _record_id(first, digest)
                    fields["WARC-Refers-To-Page-ID"] = str(first)
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    payload = b""
                data = record(fields, payload)
                if out is None:
                    out = system.open_output_stream(path, compression=None)
                out.write(data)
                size += len(data)
                count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": count}], pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return run


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) with ``digest`` and ``first``: the smallest page id with
    an equal payload if that is another page's, and the payload has ``least_bytes``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), "html", F.octet_length(html).alias("_n"), F.unhex(F.sha1(html)).alias("_sha")
    )
    known = rows.filter(F.col("_n") >= least_bytes).groupBy("_sha").agg(F.min("page_id").alias("_low"), F.count(F.lit(1)).alias("_copies"))
    known = materialise(known.filter("_copies > 1 AND _low IS NOT NULL"))
    total = rows.count()
    hot = known.filter(F.col("_copies") * HOT_SHARE > total).select("_sha", F.col("_low").alias("_hot"))
    cold = known.filter(F.col("_copies") * HOT_SHARE <= total).select("_sha", "_low")
    # Hot rows are settled by the broadcast; they go to the other join under keys of their own.
    settled = rows.join(F.broadcast(hot), "_sha", "left")
    key = F.when(F.col("_hot").isNull(), F.col("_sha")).otherwise(F.unhex(F.sha2(F.col("page_id").cast("string"), 256)))
    keyed = settled.withColumn("_key", key).join(cold.withColumnRenamed("_sha", "_key"), "_key", "left")
    low = F.coalesce("_hot", "_low")
    first = F.when((F.col("_n") >= least_bytes) & (low < F.col("page_id")), low)
    return keyed.select("page_id", "url", "html", "_sha", first.alias("first"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write all pages under ``folder`` and return the manifest, stored."""
    make_folder(folder)
    rows = revisits(pages, least_bytes)
    digest = _base32(F.hex("_sha"))
    made = map_arrow(rows.select("page_id", "url", "html", digest.alias("digest"), "first"), _write(folder), _MANIFEST)
    return materialise(made)


def _base32(hexed):
    """Bare upper-case base32 of 20 bytes given in hexadecimal: five digits make four letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for i in range(0, 40, 5):
        number = F.conv(F.substring(hexed, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit(letters), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*parts)


def _inflate(file, at: int, size: int) -> tuple[bytes, int] | None:
    """The bytes of the gzip member at ``at`` and where it ends; None if there is none."""
    engine, out, where = zlib.decompressobj(31), [], at
    checked = False
    while not engine.eof:
        data = file.read_at(min(STEP, size - where), where) if where < size else b""
        if not data:
            return None
        try:
            out.append(engine.decompress(data))
        except zlib.error:
            return None
        where += len(data)
        if not checked and sum(map(len, out)) >= 7:
            if not b"".join(out).startswith(b"WARC/1."):
                return None
            checked = True
    return b"".join(out), where - len(engine.unused_data)


def _parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/1."):
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.lower()] = value.strip()
    length = fields.get("content-length", "")
    if not length.isdigit() or "warc-type" not in fields or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return None
    return fields, rest[:-4]


def _first_record(file, start: int, end: int, size: int) -> int | None:
    """Where the first record that starts in [start, end) does."""
    at = start
    while at < end:
        data = file.read_at(min(STEP + len(MAGIC) - 1, end - at + len(MAGIC) - 1, size - at), at)
        found = data.find(MAGIC)
        while found >= 0 and at + found < end:
            got = _inflate(file, at + found, size)
            if got is not None and _parse(got[0]) is not None and (got[1] == size or file.read_at(3, got[1]) == MAGIC):
                return at + found
            found = data.find(MAGIC, found + 1)
        at += STEP
    return None


def owned_records(file, start: int, end: int, size: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, header fields, block) of the records that start in [start, end)."""
    at = _first_record(file, start, end, size)
    while at is not None and at < end:
        got = _inflate(file, at, size)
        parsed = _parse(got[0]) if got is not None else None
        if parsed is None:  # damage: look for the next whole record
            at = _first_record(file, at + 1, end, size)
            continue
        yield at, *parsed
        at = got[1]


def _read(folder: str):
    def number(value: str | None) -> int | None:
        return int(value) if value else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = resolve(folder)
        names = [x.split()[0] for x in _RECORDS.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _RECORDS.split(", ")])
        for batch in batches:
            for path, start, end, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held = [], 0
                with system.open_input_file(path) as file:
                    for at, fields, block in owned_records(file, start, end, size):
                        response = fields["warc-type"] == "response"
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        if response and digest_of(block) != digest:
                            raise ValueError(f"damaged record at {at} of {path}")
                        length = len(block) if response else number(fields.get("warc-payload-length"))
                        row = (
                            path, at, fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-target-uri"), number(fields.get("warc-page-id")),
                            digest, length, number(fields.get("warc-refers-to-page-id")), block,
                        )
                        rows.append(dict(zip(names, row, strict=True)))
                        held += len(block)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(manifest: DataFrame, folder: str, split_bytes: int = 16 << 20) -> DataFrame:
    """All records of the files in ``manifest`` (path, bytes), each from the task in whose
    range it starts: record_type, page_id, payload_digest, payload_bytes, refers_to, ..."""
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    spans = manifest.filter("bytes > 0").select("path", cut.alias("start"), "bytes")
    spans = spans.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"), F.col("bytes").alias("size"))
    # Ranges, a few bytes each, are dealt out before any is read. Their number is given, as
    # runtime re-planning would take so few bytes for one task.
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0]
    spans = spans.repartition(max(int(n or 0), 1), "path", "start")
    return map_arrow(spans, _read(folder), _RECORDS)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, least_bytes: int = 0, split_bytes: int = 16 << 20) -> DataFrame:
    """Write pages as WARC under ``folder`` (else a new one in the shared folder) and read
    them back, one row per page.

    NULL html is an empty payload, NULL urls an empty URI. Ties cannot be: among equal
    payloads the page with the smallest id is the response, and rows repeated under this id
    are responses too. A page without id never is what others refer to, and is a response.
    Other columns are ignored. No pages give no files and no rows.
    """
    folder = folder or scratch_path(spark, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder, split_bytes)
