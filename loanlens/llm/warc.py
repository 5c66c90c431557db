"""Web archives: records written with an index first, then read back by coalesced byte ranges."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.session import shared_folder

#: Payloads from this size on are kept once.
DEDUPLICATED_FROM = 1000
#: Records at most so far apart in an archive are read in one go, up to so many bytes.
GAP, READ_AT_ONCE = 1 << 16, 1 << 23
#: Pages that a writer holds as Python objects; a batch can hold ten thousand.
PAGES_AT_ONCE = 64
#: Compressed bytes that a task reads.
READ_PER_TASK = 1 << 25
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member of its own. ``refers_to``: the response a revisit stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = lambda number: f"<urn:page:{'' if number is None else number}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    block = http if refers_to is not None else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> tuple[int | None, int, str, str, int | None, bytes]:
    """``page_id, payload bytes, digest, type, refers_to, payload`` of a gzip member; a damaged one raises."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda uri: int(found) if (found := uri.removeprefix("<urn:page:")[:-1]) else None
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
    return number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers, payload


def planned(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to`` for the rows of ``pages`` (``page_id, url, html``).

    A null html is an empty payload. Of equal payloads of at least DEDUPLICATED_FROM bytes the row
    with the largest ``page_id`` is the response (each of them, if that row is repeated), the
    others revisit it, rows without an id too. If none has an id, all are responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("payload_digest"))
    large = pages.select("page_id", payload.alias("payload")).where(F.octet_length("payload") >= DEDUPLICATED_FROM)
    kept = (
        large.groupBy(F.sha1("payload").alias("payload_digest"))
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and keeper is not null")
        .select("payload_digest", "keeper")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return rows.join(kept, "payload_digest", "left").select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        name, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in (b.slice(at, PAGES_AT_ONCE) for b in batches for at in range(0, b.num_rows, PAGES_AT_ONCE)):
                rows = []
                for page_id, url, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                    made = record(page_id, url, payload, digest, refers)
                    out.write(made)
                    rows.append((name, offset, len(made), page_id, url, digest, "response" if refers is None else "revisit"))
                    offset += len(made)
                yield _batch(rows, INDEX)
        finally:
            if out:
                out.close()

    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(f.strip().split() for f in schema.split(",")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=names)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``, and return the index, written there too.

    ``folder`` must be reachable from all executors by a file system that pyarrow knows. Each task
    writes one archive under a name of its own and hands over its index rows when it ends; an
    archive of a task that was lost or repeated is in no index. Other columns of ``pages`` are not
    read, so none can clash; no pages, no records. A payload of any length is one record. The index is a Parquet table of
    archive, offset, length, id, URL, digest and type.
    """
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    planned(pages).mapInArrow(_write(folder), INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index")


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        opened, file = None, None
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            rows, at, held_bytes = [], 0, 0
            while at < len(places):
                archive, start, length = places[at]
                end, last = start + length, at + 1
                while last < len(places) and places[last][0] == archive and places[last][1] - end <= GAP and sum(places[last][1:]) - start <= READ_AT_ONCE:
                    end, last = max(end, sum(places[last][1:])), last + 1
                if opened != archive:
                    if file:
                        file.close()
                    opened, file = archive, system.open_input_file(f"{path}/{archive}")
                held = file.read_at(end - start, start)
                for _, offset, size in places[at:last]:
                    found = parsed(held[offset - start : offset - start + size])
                    rows.append(found if with_payload else found[:5])
                    held_bytes += len(found[5]) * with_payload
                    if held_bytes >= READ_AT_ONCE:  # a batch of index rows can name more payloads than a worker can hold
                        yield _batch(rows, RECORD + ", payload binary" * with_payload)
                        rows, held_bytes = [], 0
                at = last
            yield _batch(rows, RECORD + ", payload binary" * with_payload)
        if file:
            file.close()

    return run


def read_records(selected: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that rows of the index name, checked against their digests.

    Rows are dealt by archive and offset, so each task reads ranges of few archives front to back;
    an archive of any size can be shared by many tasks.
    """
    # index rows are small and records are not: the bytes to read tell the number of tasks
    tasks = max(1, math.ceil((selected.agg(F.sum("length")).first()[0] or 0) / READ_PER_TASK))
    places = selected.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")
    ordered = places.sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(_read(folder, with_payload), RECORD + ", payload binary" * with_payload)


def new_folder(spark: SparkSession) -> str:
    """A folder for archives below the cluster's shared one."""
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
