"""WARC archives: written as whole-file gzip streams, normalised to one gzip member a record with a sidecar offset index, read by it."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from math import ceil
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import keep, prepare, scratch_path
from strata.session import broadcast_if_small

#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 1000
#: An archive is closed once its records have so many bytes.
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
#: Bytes read or inflated at once, and rows handed back at once.
BLOCK, ROWS = 1 << 20, 500
#: Compressed bytes of an archive that are read together.
SPAN = 4 << 20
#: Partitions at most, in shuffle partitions of the session: a driver cannot schedule millions of small ones.
TASKS = 4
#: Groups of equal payloads that are broadcast at most.
GROUP_ROWS = 100_000
# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2000-01-01T00:00:00Z"

RECORD = "page_id long, archive string, offset long, length long, record_type string, payload_bytes long, payload_digest string, refers_to long, uri string, payload binary"


def _storage(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of an address of shared storage, and the place there."""
    return pyarrow.fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")


def qualified(spark: SparkSession, path: str) -> str:
    """The address as Spark resolves it: one without a scheme lies on the session's default file system, not on each machine's disk."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = place.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    return re.sub(r"^file:/(?!/)", "file:///", whole)


def _open(path: str, mode: str) -> BinaryIO:
    system, place = _storage(path)
    return system.open_input_stream(place, compression=None) if mode == "rb" else system.open_output_stream(place, compression=None)


def record(kind: str, page_id: int | None, uri: bytes, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record with its closing blank lines. A revisit has the length and digest of its payload, and no block."""
    name = b"" if page_id is None else str(page_id).encode()
    block = payload if kind == "response" else b""
    lines = [
        VERSION,
        b"WARC-Type: " + kind.encode(),
        b"WARC-Record-ID: <urn:page:" + name + b">",
        b"WARC-Date: " + DATE,
        b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], uri),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"X-Payload-Length: " + str(len(payload)).encode(),
    ]
    if kind == "revisit":
        lines += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: <urn:page:" + (b"" if refers_to is None else str(refers_to).encode()) + b">"]
    lines += [b"Content-Type: text/html", b"Content-Length: " + str(len(block)).encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (by lower-case name) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("the record is cut off")
    return fields, block


def inflate(stream: BinaryIO) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or several, block by block. A member without its end, trailer included, raises."""
    unzip, begun = zlib.decompressobj(31), False
    while data := stream.read(BLOCK):
        while data:
            begun = True
            yield unzip.decompress(data, BLOCK)
            while unzip.unconsumed_tail:
                yield unzip.decompress(unzip.unconsumed_tail, BLOCK)
            data = unzip.unused_data
            if unzip.eof:
                unzip, begun = zlib.decompressobj(31), False
    if begun:
        raise ValueError("the stream is cut off")


def split_records(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream; holds one record and one block. Content-Length tells where each ends."""
    held = bytearray()
    need = None
    for block in blocks:
        held += block
        while True:
            if need is None:
                at = held.find(b"\r\n\r\n")
                if at < 0:
                    break
                found = re.search(rb"(?im)^content-length:\s*(\d+)", bytes(held[:at]))
                if not found:
                    raise ValueError("a record without a length")
                need = at + 4 + int(found[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip(b"\r\n"):
        raise ValueError("the last record is cut off")


def member(data: bytes) -> bytes:
    """`data` as a gzip member of its own."""
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows (page_id, uri, payload, payload_digest, record_type, refers_to) as .warc.gz files, each one gzip stream.

    Returns archive and records, one row a file. A task that runs twice writes files of other names; only those listed count.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pack = None
        path, count, size, done = "", 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, pack, count, size = _open(path, "wb"), zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                data = record(row["record_type"], row["page_id"], (row["uri"] or "").encode(), row["payload"], row["payload_digest"], row["refers_to"])
                out.write(pack.compress(data))
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    out.write(pack.flush())
                    out.close()
                    done.append((path, count))
                    out = None
        if out is not None:
            out.write(pack.flush())
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["archive", "records"])

    prepare(pages.sparkSession)
    _make(folder)
    return keep(pages.mapInArrow(work, "archive string, records long"), "archives")


def _make(folder: str) -> None:
    system, place = _storage(folder)
    system.create_dir(place, recursive=True)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite gzip archives so that each record is a member of its own; returns their sidecar offset index.

    In: column archive and, where it is known, records, their number. Each file is inflated once, as a stream, however its members
    are cut; one record is held at a time. Index: archive (the new file), offset, length (of the member), page_id, record_type, one row a
    record, and beside each archive <name>.cdx with the same as text lines. Damaged or cut-off archives, and those of another number
    of records, raise.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, expected in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist()):
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                offset, count, rows = 0, 0, []
                with _open(source, "rb") as stream, _open(path, "wb") as out, _open(f"{path}.cdx", "wb") as index:
                    for data in split_records(inflate(stream)):
                        fields, _ = parse(data)
                        packed = member(data)
                        out.write(packed)
                        page = _page(fields["warc-record-id"])
                        index.write(f"{'-' if page is None else page} {fields['warc-type']} {offset} {len(packed)}\n".encode())
                        rows.append((path, offset, len(packed), page, fields["warc-type"]))
                        offset, count = offset + len(packed), count + 1
                        if len(rows) == ROWS:
                            yield _batch(rows, INDEX)
                            rows = []
                if expected is not None and count != expected:
                    raise ValueError(f"{source} holds {count} records, not {expected}")
                yield _batch(rows, INDEX)

    _make(folder)
    known = F.col("records").cast("long") if "records" in archives.columns else F.lit(None).cast("long").alias("records")
    files = archives.select("archive", known).repartition(parts(archives.sparkSession, archives.count()))
    return keep(files.mapInArrow(work, INDEX), "index")


def parts(spark: SparkSession, wanted: int) -> int:
    """How many partitions for so many pieces of work: one each, but no more than TASKS times the session's shuffle partitions."""
    return max(1, min(wanted, TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))))


INDEX = "archive string, offset long, length long, page_id long, record_type string"
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, names)], [n for n, _ in names])


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archives(index: DataFrame) -> DataFrame:
    """The records that an index lists, each inflated by itself from its offset; columns as in RECORD.

    payload is the block of responses and null for revisits; payload_bytes and payload_digest are those of the full payload. The
    digest of a response is computed from what was read and must be the one that it states.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source = None, None
        for batch in batches:
            rows, held = [], 0
            for entry in batch.to_pylist():
                if entry["archive"] != path:
                    path = entry["archive"]
                    system, place = _storage(path)
                    source = system.open_input_file(place)
                source.seek(entry["offset"])
                fields, block = parse(zlib.decompress(source.read(entry["length"]), 31))
                full = fields["warc-type"] == "response"
                stated = fields["warc-payload-digest"].removeprefix("sha1:")
                if full and hashlib.sha1(block).hexdigest() != stated:
                    raise ValueError(f"{path} is damaged at {entry['offset']}")
                refers = None if full else _page(fields["warc-refers-to"])
                size = len(block) if full else int(fields["x-payload-length"])
                rows.append((_page(fields["warc-record-id"]), path, entry["offset"], entry["length"], fields["warc-type"], size, stated, refers, fields["warc-target-uri"], block if full else None))
                held += len(block)
                if held > 8 * BLOCK:
                    yield _batch(rows, RECORD)
                    rows, held = [], 0
            yield _batch(rows, RECORD)

    total = index.agg(F.sum("length")).first()[0] or 0
    spans = index.repartition(parts(index.sparkSession, ceil(total / SPAN) + 1), "archive", F.floor(F.col("offset") / SPAN))
    return spans.sortWithinPartitions("archive", "offset").mapInArrow(work, RECORD)


def with_revisits(pages: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """Adds payload_digest, record_type and refers_to to page_id, uri and payload: which pages are revisits of which.

    Of payloads that are equal (by SHA-1 and length) and have `at_least` bytes, that with the largest page_id is the response and
    the others, rows without id among them, revisit it. Repeated rows with that id are all responses, and so is every row of a
    group without any id. The largest id of a group is an aggregate, combined before the shuffle. Only groups of several rows
    are joined back; they are broadcast where counting shows that they are few, so that payloads need not move.
    """
    digested = pages.withColumn("payload_digest", F.sha1("payload")).withColumn("n", F.length("payload"))
    groups = digested.filter(F.col("n") >= at_least).groupBy("payload_digest", "n").agg(F.max("page_id").alias("chosen"), F.count("*").alias("rows"))
    groups = broadcast_if_small(keep(groups.filter("rows > 1").drop("rows"), "groups"), GROUP_ROWS)
    revisit = F.col("chosen").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("chosen"))
    return digested.join(groups, ["payload_digest", "n"], "left").select(
        "page_id", "uri", "payload", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("chosen")).alias("refers_to"),
    )


def warc_round_trip(
    pages: DataFrame,
    folder: str | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
    id_col: str = "page_id",
    uri_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write a record for every row of `pages`, normalise the archives, and read all records back; columns as in RECORD.

    Null html is an empty payload, a null url an empty address. Null ids and repeated rows stay. Other columns are not read. Empty
    in, empty out. folder: on storage that all executors share, the session's scratch folder by default.
    """
    folder = qualified(pages.sparkSession, folder or scratch_path(pages.sparkSession, "warc"))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(uri_col).cast("string").alias("uri"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    archives = write_archives(with_revisits(rows), f"{folder}/whole", archive_bytes)
    return read_archives(normalise(archives, f"{folder}/members"))
