"""WARC archives: write records, normalise whole-file gzip streams, read records by offset.

`write_archives` writes each partition as one gzip stream over all its records, as many
crawlers do. `normalise_archives` inflates such a stream once, in bounded memory, writes
every record as a gzip member of its own and an index of the members' offsets beside it.
`read_records` opens single members by that index.

Archives lie in a folder that all executors reach: a local mount (`file:`), or any store that
`pyarrow.fs` opens. Files are written under a name of their own and renamed when whole, so
a task that is run again replaces its file.

Defined results: a null html is an empty payload; a null url is an empty target; control
characters and spaces of a url are percent-encoded in the record; among records that share
a payload those with the largest page_id are responses (all of them, if rows repeat), and so
are all whose page_id is null where no record of the payload has one; otherwise a null
page_id ranks lowest; an empty table gives no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written

DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 20
LEVEL = 4
MIN_SHARED = 1000
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def planned_records(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to.

    Counting digests moves only digests; a hot payload is summed up before the shuffle.
    Payloads of revisits are dropped, as their records carry none.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns({
        "payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha1("html")})
    shared = (
        rows.where(F.col("payload_bytes") >= min_shared).groupBy("payload_digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("payload_digest").alias("__digest"), "first")
    )
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("first")))
    return (
        rows.join(shared, F.col("payload_digest") == F.col("__digest"), "left")
        .select("page_id", "url", F.when(~F.coalesce(revisit, F.lit(False)), F.col("html")).alias("html"), "payload_bytes",
                "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                F.when(revisit, F.col("first")).alias("refers_to"))
    )


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def record_bytes(page_id, url, html, payload_bytes, digest, kind, refers_to) -> bytes:
    target = "".join(c if "!" <= c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", DATE),
              ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("X-Payload-Length", payload_bytes), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        fields += [("WARC-Refers-To", record_name(refers_to)),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    if kind == "response":
        block += (html or "").encode()
    fields.append(("Content-Length", len(block)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class Shared:
    """A folder in a shared store, with files that appear whole."""

    def __init__(self, folder: str):
        self.store, self.path = fs.FileSystem.from_uri(folder)

    def create(self, name: str):
        temporary = f"{self.path}/.{name}-{uuid.uuid4().hex}"
        return temporary, self.store.open_output_stream(temporary)

    def publish(self, temporary: str, name: str) -> None:
        self.store.move(temporary, f"{self.path}/{name}")

    def has(self, name: str) -> bool:
        return self.store.get_file_info(f"{self.path}/{name}").type == fs.FileType.File

    def open(self, name: str):
        return self.store.open_input_file(f"{self.path}/{name}")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """One monolithic `.warc.gz` per partition that has records; returns (number, archive, records)."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, number = None, 0, TaskContext.get().partitionId()
        name = f"part-{number:06d}.warc.gz"
        for batch in batches:
            if batch.num_rows and out is None:
                store = Shared(folder)
                temporary, out = store.create(name)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in (
                "page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to")]
            for i in range(batch.num_rows):
                out.write(packer.compress(record_bytes(*(c[i].as_py() for c in columns))))
            n += batch.num_rows
        if out is not None:
            out.write(packer.flush())
            out.close()
            store.publish(temporary, name)
            yield pa.RecordBatch.from_pydict({"number": [number], "archive": [name], "records": [n]})

    Shared(folder).store.create_dir(Shared(folder).path, recursive=True)
    return written(records.mapInArrow(write, "number long, archive string, records long"), f"{folder}/written")


def read_head(stream) -> tuple[bytes, dict[str, str]]:
    """The version line and named fields of the next record, as bytes and by name; empty at the end."""
    lines = []
    while (line := stream.readline()) not in (b"\r\n", b""):
        lines.append(line)
    if not lines:
        return b"", {}
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    named = (line.decode("utf-8").rstrip("\r\n").partition(": ") for line in lines[1:])
    return b"".join(lines) + b"\r\n", {k: v for k, _, v in named}


def normalised(source, sink) -> Iterator[tuple[int, int, dict[str, str]]]:
    """Write each record of a gzip stream as its own member; yields offset, length and fields."""
    offset = 0
    with gzip.GzipFile(fileobj=source, mode="rb") as stream:
        while True:
            head, fields = read_head(stream)
            if not head:
                return
            packer, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
            size += put(sink, packer.compress(head))
            left = int(fields["Content-Length"]) + 4
            while left:
                chunk = stream.read(min(left, CHUNK))
                if not chunk:
                    raise ValueError("the archive ends within a record")
                left -= len(chunk)
                size += put(sink, packer.compress(chunk))
            size += put(sink, packer.flush())
            yield offset, size, fields
            offset += size


def put(sink, data: bytes) -> int:
    sink.write(data)
    return len(data)


def normalise_archives(archives: DataFrame, source: str, target: str, drop_source: bool = False) -> DataFrame:
    """Rewrite each archive record by record into `target`, with an index file beside it.

    Returns the index: (number, archive, offset, length, record_id, record_type). An archive whose index is there is
    done: a task that runs again takes it from the index, so that sources may go as soon as they are rewritten.
    """
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                came, goes, name = Shared(source), Shared(target), row["archive"]
                if not goes.has(name + ".index"):
                    temporary, out = goes.create(name)
                    side, lines = goes.create(name + ".index")
                    with came.open(name) as stream:
                        for offset, length, fields in normalised(stream, out):
                            line = {"offset": offset, "length": length, "id": fields["WARC-Record-ID"], "type": fields["WARC-Type"]}
                            lines.write((json.dumps(line) + "\n").encode())
                    out.close()
                    lines.close()
                    goes.publish(temporary, name)
                    goes.publish(side, name + ".index")
                if drop_source and came.has(name):
                    came.store.delete_file(f"{came.path}/{name}")
                with goes.open(name + ".index") as lines:
                    index = [json.loads(line) for line in lines.read().decode().splitlines()]
                yield pa.RecordBatch.from_pydict({
                    "number": [row["number"]] * len(index), "archive": [name] * len(index),
                    "offset": [x["offset"] for x in index], "length": [x["length"] for x in index],
                    "record_id": [x["id"] for x in index], "record_type": [x["type"] for x in index]})

    Shared(target).store.create_dir(Shared(target).path, recursive=True)
    parts = max(1, archives.count())
    return written(
        archives.repartitionByRange(parts, "number").mapInArrow(
            rewrite, "number long, archive string, offset long, length long, record_id string, record_type string"),
        f"{target}/index")


def read_member(store: Shared, stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and payload of the record at an offset, from its member alone."""
    stream.seek(offset)
    data = gzip.decompress(stream.read(length))
    end = data.index(b"\r\n\r\n") + 4
    fields = dict(line.partition(": ")[::2] for line in data[:end].decode().split("\r\n")[1:] if line)
    block = data[end : end + int(fields["Content-Length"])]
    return fields, block[block.index(b"\r\n\r\n") + 4 :]


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every indexed record, read from its own member; digests of responses are computed anew."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name, stream = None, None, None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("archive", "offset", "length"))):
                store = store or Shared(folder)
                if archive != name:
                    name, stream = archive, store.open(archive)
                fields, payload = read_member(store, stream, offset, length)
                digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                if fields["WARC-Type"] == "response":
                    found = hashlib.sha1(payload).hexdigest()
                    if found != digest or len(payload) != size:
                        raise ValueError(f"{archive} at {offset}: payload does not fit its digest")
                refers = fields.get("WARC-Refers-To")
                out.append({"page_id": page_of(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
                            "record_type": fields["WARC-Type"], "refers_to": page_of(refers) if refers else None})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                ("record_type", pa.string()), ("refers_to", pa.int64())]))

    return index.mapInArrow(read, RECORD)


def archive_round_trip(pages: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """Write `pages` as archives, normalise them, and return what their records hold."""
    folder = scratch_folder(pages.sparkSession, "warc")
    archives = write_archives(planned_records(pages, min_shared), f"{folder}/whole")
    index = normalise_archives(archives, f"{folder}/whole", f"{folder}/members", drop_source=True)
    return read_records(index, f"{folder}/members")
