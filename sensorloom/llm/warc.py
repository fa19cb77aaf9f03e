"""WARC archives with a Zstandard dictionary.

Each archive file begins with a skippable frame that holds a dictionary built from the file's own
records; every record then is one Zstandard frame compressed with it, so a record can be read alone
by its offset. Files are cut at ``file_bytes`` of payload, which also bounds a task's memory (plus the
longest record). A task writes to a name of its own attempt and only the names in the committed index
are ever read, so repeated attempts after the loss of an executor do no harm.

Of records with equal payloads of at least ``least_bytes``, that with the smallest page_id is a
response, the others are revisits without payload that name the response's record, target and date.
Defined results: a null html counts as empty; rows
with equal page_id and payload are all responses where theirs is the smallest id; null ids never count
as smallest unless no other is there; a null url writes no target. Equal rows write equal records. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import fresh_folder, written

# Fixed values of the archive format.
SKIPPABLE_MAGIC = 0x184D2A5D
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 100
FILE_BYTES = 32 << 20
#: Archives that one task reads back.
FILES_PER_TASK = 4
DICTIONARY_BYTES = 64 << 10
#: Bytes of a file's records that its dictionary is built from, and of any one record among them.
SAMPLE_BYTES, SAMPLE_RECORD_BYTES = 2 << 20, 16 << 10
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

INDEX = "file string, offset long, length long"
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
    "valid boolean"
)


def with_types(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses) and refers_url, the url of that page
    (the first in order, where several rows have its id and payload).

    Only digests that occur twice are joined back, and both sides of the join can be split, so a
    payload that a third of the rows share does not gather in one task.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least_bytes
    known = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    shared = rows.where(large).groupBy("digest").agg(F.min(known).alias("first"), F.count("*").alias("n"))
    shared = shared.where("n > 1").select("digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url"))
    shared = written(shared, "warc-shared")
    joined = rows.join(shared.withColumnRenamed("digest", "shared"), large & (F.col("digest") == F.col("shared")), "left")
    is_revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(is_revisit, F.col("first")).alias("refers_to"),
        F.when(is_revisit, F.col("first_url")).alias("refers_url"),
    )


def record_id(page_id, url, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page_id, url, digest]))}>"


def _target(url) -> str | None:
    return url and " ".join(url.split())


def record(page_id, url, payload: bytes, digest: str, refers_to, refers_url=None) -> bytes:
    """One WARC record; the page's numbers and the payload's length travel in its own headers."""
    revisit = refers_to is not None
    head = HTTP_HEAD % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _target(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, refers_url, digest) if revisit else None),
        ("WARC-Refers-To-Target-URI", _target(refers_url) if revisit else None),
        ("WARC-Refers-To-Date", DATE if revisit else None),
        ("X-Page-Id", page_id),
        ("X-Refers-To-Page-Id", refers_to),
        ("X-Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None and v != ""), "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """What ``record`` was given, read back; ``valid`` if the payload matches its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    length = int(fields["X-Payload-Length"])
    valid = True
    if fields["WARC-Type"] == "response":
        found, length = hashlib.sha256(payload).hexdigest(), len(payload)
        valid, digest = found == digest and length == int(fields["X-Payload-Length"]), found
    return {
        "page_id": number["X-Page-Id"],
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number["X-Refers-To-Page-Id"],
        "url": fields.get("WARC-Target-URI"),
        "valid": valid,
    }


def _dictionary(records: list[bytes]) -> bytes:
    """Built from records at even distances; empty where they are too few or too alike to build one."""
    step = max(1, sum(min(len(r), SAMPLE_RECORD_BYTES) for r in records) // SAMPLE_BYTES)
    samples = [r[:SAMPLE_RECORD_BYTES] for r in records[::step]]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if len(samples) < 8 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _write_file(folder: str, records: list[bytes]) -> list[tuple[str, int, int]]:
    """An archive in ``folder``; its name and the offset and length of each record's frame."""
    store, path = _place(folder)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}.warc.zst"
    words = _dictionary(records)
    rules = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words) if words else None
    )
    index = []
    with store.open_output_stream(f"{path}/{name}", compression=None) as out:
        offset = out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(words)) + words)
        for one in records:
            frame = rules.compress(one)
            out.write(frame)
            index.append((name, offset, len(frame)))
            offset += len(frame)
    return index


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every row of ``with_types`` into archives in ``folder``; returns the committed index."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in INDEX.split(", ")]
        held, size = [], 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to, refers_url in batch.itertuples(index=False):
                whole = record(
                    None if pd.isna(page_id) else int(page_id),
                    url,
                    bytes(payload),
                    digest,
                    None if pd.isna(refers_to) else int(refers_to),
                    refers_url,
                )
                if held and size + len(whole) > file_bytes:
                    yield pd.DataFrame(_write_file(folder, held), columns=columns)
                    held, size = [], 0
                held.append(whole)
                size += len(whole)
        if held:
            yield pd.DataFrame(_write_file(folder, held), columns=columns)

    exact = rows.select(
        F.col("page_id").cast("decimal(20,0)"),
        "url",
        "payload",
        "digest",
        F.col("refers_to").cast("decimal(20,0)"),
        "refers_url",
    )
    return written(exact.mapInPandas(write, INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every record that ``index`` lists, read back from the archives in ``folder``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            for name, offsets in zip(batch["file"], batch["frames"], strict=True):
                store, path = _place(folder)
                with store.open_input_file(f"{path}/{name}") as source:
                    magic, size = struct.unpack("<II", source.read(8))
                    if magic != SKIPPABLE_MAGIC:
                        raise ValueError(f"{name} does not begin with a dictionary frame")
                    words = source.read(size)
                    rules = zstandard.ZstdDecompressor(
                        dict_data=zstandard.ZstdCompressionDict(words) if size else None
                    )
                    found = []
                    for frame in offsets:
                        source.seek(frame["offset"])
                        found.append(parsed(rules.decompress(source.read(frame["length"]))))
                out = pd.DataFrame(found, columns=columns)
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    frames = F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("frames")
    # The index is small beside what it lists, so tasks are counted in archives, not in its bytes.
    tasks = -(-index.select("file").distinct().count() // FILES_PER_TASK)
    return index.repartition(max(1, tasks), "file").groupBy("file").agg(frames).mapInPandas(read, READ)


def archived(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` to archives and read them back: one row per page."""
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(with_types(pages), folder, file_bytes), folder)


def digest(read: DataFrame) -> DataFrame:
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "valid")
