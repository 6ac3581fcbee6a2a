"""WARC archives: a writer with payload deduplication and a sequential reader.

Writer: a gzip member per record. The first page (smallest identifier) of those with an equal payload of
`least_bytes` or more is a response; the others are revisits, which carry the HTTP header and the payload's digest
but not the payload. Records name their page in WARC-Record-ID.

Reader: decompresses a file in small pieces, member by member, frames each record by its Content-Length, and checks
that nothing but the record's end follows, and that the block's and the payload's digests are right. It never holds
more than a record.

Defined results: a null payload counts as empty. A null identifier is written without a page and comes back as null;
it is the first page of a payload only where no other page has it. Rows of equal identifier and payload are one page
repeated and all of one type. Columns other than identifier, address and payload are ignored; a null address is
written as urn:page. An empty table gives no archives and an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import skew_join, written
from tidemark.llm.files import attempt_name, resolve

#: Bytes after which a task starts another archive.
ARCHIVE_BYTES = 512 << 20
#: Bytes read, and given to the decompressor, at a time.
READ_BYTES = 1 << 16

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:x-page:"
_ROW = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class WarcError(ValueError):
    """An archive that isn't framed as it says, or whose digest is wrong."""


# -- writing ---------------------------------------------------------------------------------------------------------


def _head(fields: list[tuple[str, str | None]], first: str = "WARC/1.1") -> bytes:
    return "".join([f"{first}\r\n", *(f"{k}: {v}\r\n" for k, v in fields if v is not None), "\r\n"]).encode()


def _clean(text: str) -> str:
    """A header's value on one line."""
    return " ".join(text.split()) or "urn:page"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; refers_to makes it a revisit."""
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", None if page_id is None else f"<{_PAGE}{page_id}>"),
        ("WARC-Target-URI", _clean(url or "")),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{_PAGE}{refers_to}>" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(_head(fields)) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def first_pages(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another; pages has page_id, digest, payload_bytes."""
    long = written(pages.filter(F.col("payload_bytes") >= least_bytes).select("page_id", "digest"), "payloads")
    groups = long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("refers_to").isNotNull())
    found = skew_join(long, written(groups, "payload-groups"), ["digest"], "n", long.count())
    return found.filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 100, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> list[str]:
    """Archives of the pages below `folder`: their paths."""
    html = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    again = first_pages(rows, least_bytes).select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to")
    typed = rows.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left").select("page_id", "url", "payload", "digest", "refers_to")

    def write(batches):
        system, place = resolve(folder)
        part, sink, size = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            columns = [batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                if sink is None:
                    system.create_dir(place, recursive=True)
                    path, size = attempt_name(folder, f"pages-{part:06d}", ".warc.gz"), 0
                    sink = system.open_output_stream(resolve(path)[1], compression=None)
                member = record(*(c[i].as_py() for c in columns))
                sink.write(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    sink.close()
                    sink = None
                    yield pa.RecordBatch.from_pydict({"path": [path]})
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path]})

    return [r["path"] for r in typed.mapInArrow(write, "path string").collect()]  # a row per archive


# -- reading ---------------------------------------------------------------------------------------------------------


def members(source: BinaryIO) -> Iterator[Iterator[bytes]]:
    """For each gzip member in turn, an iterator of its decompressed pieces, to be used up before the next."""
    held = source.read(READ_BYTES)
    while held:
        unpacker = zlib.decompressobj(31)

        def pieces(unpacker=unpacker):
            nonlocal held
            while not unpacker.eof:
                if not held:
                    raise WarcError("the archive ends within a record")
                yield unpacker.decompress(held, READ_BYTES * 16)
                held = unpacker.unconsumed_tail or unpacker.unused_data or (b"" if unpacker.eof else source.read(READ_BYTES))
            held = unpacker.unused_data or source.read(READ_BYTES)

        yield pieces()


def _fields(head: bytes, first: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(first):
        raise WarcError(f"{lines[0][:40]!r} is not the start of a record")
    return {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines[1:] if line)}


def read_record(pieces: Iterator[bytes]) -> dict:
    """The fields of one record, checked against its content."""
    held = b""
    while b"\r\n\r\n" not in held:
        more = next(pieces, None)
        if more is None:
            raise WarcError("a record's header has no end")
        held += more
    head, _, rest = held.partition(b"\r\n\r\n")
    fields = _fields(head, b"WARC/")
    parts = [rest, *pieces]
    content = b"".join(parts)
    length = int(fields["content-length"])
    block, end = content[:length], content[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise WarcError("a record isn't as long as its Content-Length")
    if fields["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise WarcError("a block's digest is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(_fields(http, b"HTTP/")["content-length"])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != told or digest != hashlib.sha256(payload).hexdigest()):
        raise WarcError("a payload's length or digest is wrong")
    page = lambda name: int(fields[name].strip("<>").removeprefix(_PAGE)) if name in fields else None
    return {"page_id": page("warc-record-id"), "payload_bytes": told, "payload_digest": digest, "record_type": kind, "refers_to": page("warc-refers-to"), "url": fields["warc-target-uri"], "payload": payload}


def read_archive(uri: str) -> Iterator[dict]:
    """The records of an archive in order."""
    system, path = resolve(uri)
    with system.open_input_stream(path, compression=None) as source:
        for pieces in members(source):
            yield read_record(pieces)


def read_warc(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row per record of the archives."""

    def read(batches):
        names = [c.split()[0] for c in _ROW.split(", ")]
        schema = pa.schema([(n, pa.string() if n in ("payload_digest", "record_type") else pa.int64()) for n in names])
        for batch in batches:
            for path in batch["path"].to_pylist():
                held = []
                for found in read_archive(path):
                    held.append({n: found[n] for n in names})
                    if len(held) == 5000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths))).mapInArrow(read, _ROW)
