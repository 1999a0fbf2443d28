"""WARC archives, written and read record by record, compressed with a dictionary of their own.

Each task writes its rows to archive files under a shared folder. A file starts with a Zstandard dictionary in a skippable
frame, trained on the first records that go into the file; every record is a frame of its own, compressed with it. Of pages
with equal payloads one is stored as response, the others as revisits that refer to it.

A null payload is empty; a null url is left out of the record. Rows with a null id are responses and are never referred to;
repeated rows with the largest id of their payload are all responses. Payloads are told apart by SHA-1. Very long payloads
are one record each. An empty table gives no files and an empty result. Only the named columns are read, whatever else
there is.

Files get a new name for each attempt and count only if they are listed in the manifest, which is itself a table in the
shared folder: a task that is run again leaves a file that nobody reads, and no reader needs a lost executor.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.session import work_path

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``refers_to`` is set) keeps the HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of a decompressed archive, in order."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where its length says")
        http, _, payload = block.partition(b"\r\n\r\n")
        fields = dict(x.lower().split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:])
        page, refers = head["warc-record-id"][10:-1], head.get("warc-refers-to")
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        if head["warc-type"] == "response" and (digest != base32_sha1(payload) or len(payload) != int(fields["content-length"])):
            raise ValueError(f"payload of page {page} differs from what was archived")
        yield {
            "page_id": None if page == "none" else int(page), "url": head.get("warc-target-uri"), "payload": payload if head["warc-type"] == "response" else None,
            "payload_bytes": int(fields["content-length"]), "payload_digest": digest, "record_type": head["warc-type"],
            "refers_to": int(refers[10:-1]) if refers else None,
        }


def dictionary(samples: list[bytes], size: int):
    """A trained dictionary, or the samples' own bytes where they are too few to train on; None without samples."""
    import zstandard

    whole = b"".join(samples)
    if not whole:
        return None
    try:
        return zstandard.train_dictionary(min(size, max(1_024, len(whole) // 8)), samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(whole[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Writer:
    """Archive files of about ``file_bytes`` each in one folder."""

    def __init__(self, folder: str, file_bytes: int, sample_bytes: int, dictionary_bytes: int, level: int) -> None:
        from pyarrow import fs

        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.file_bytes, self.sample_bytes, self.dictionary_bytes, self.level = file_bytes, sample_bytes, dictionary_bytes, level
        self.held: list[bytes] = []
        self.held_bytes, self.sink, self.files = 0, None, []

    def add(self, data: bytes) -> None:
        if self.sink is None:
            self.held.append(data)
            self.held_bytes += len(data)
            if self.held_bytes >= self.sample_bytes:
                self.start()
        else:
            self.put(data)

    def start(self) -> None:
        """Opens a file, builds its dictionary from the records held back for it, and writes them."""
        import zstandard

        name = f"{uuid.uuid4().hex}.warc.zst"
        self.sink = self.system.open_output_stream(f"{self.root}/{name}")
        made = dictionary(self.held, self.dictionary_bytes)
        if made is not None:
            body = made.as_bytes()
            self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=made, write_checksum=True)
        self.files.append([name, 0, 0])
        held, self.held, self.held_bytes = self.held, [], 0
        for data in held:
            self.put(data)

    def put(self, data: bytes) -> None:
        if self.sink is None:
            return self.add(data)
        self.sink.write(self.packer.compress(data))
        self.files[-1][1] += 1
        self.files[-1][2] += len(data)
        if self.files[-1][2] >= self.file_bytes:
            self.close()
        return None

    def close(self) -> None:
        if self.held:
            self.start()
        if self.sink is not None:
            self.sink.close()
            self.sink = None


def open_archive(system, path: str) -> io.BufferedReader:
    """The decompressed bytes of an archive file, by the dictionary that it starts with."""
    import zstandard

    source = system.open_input_stream(path)
    made, lead = None, source.read(8)
    if len(lead) == 8 and struct.unpack("<II", lead)[0] == SKIPPABLE:
        made = zstandard.ZstdCompressionDict(source.read(struct.unpack("<II", lead)[1]))
    else:
        source.close()
        source = system.open_input_stream(path)
    return io.BufferedReader(zstandard.ZstdDecompressor(dict_data=made).stream_reader(source, read_across_frames=True), 1 << 20)


def decided(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (binary) and refers_to: null for responses. Only payloads that are met twice are looked up."""
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("_sha1", F.when(F.octet_length("payload") >= least_bytes, F.sha1("payload")))
    keepers = rows.where("_sha1 is not null and page_id is not null").groupBy("_sha1").agg(F.max("page_id").alias("_keeper"), F.min("page_id").alias("_least"))
    keepers = keepers.where("_least < _keeper").select(F.col("_sha1").alias("_of"), "_keeper")
    joined = rows.join(keepers, F.col("_sha1") == F.col("_of"), "left")
    return joined.select("page_id", "url", "payload", F.when(F.col("page_id") < F.col("_keeper"), F.col("_keeper")).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, file_bytes: int = 64_000_000, sample_bytes: int = 4_000_000,
          dictionary_bytes: int = 112_640, level: int = 3) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) and returns the manifest: path, records, bytes. ``folder`` must be one that
    all executors share; by default a new one under the session's. Payloads under ``least_bytes`` are never revisits."""
    spark = pages.sparkSession
    folder = folder or work_path(spark, "warc")

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = None
        for rows in batches:
            if writer is None and len(rows):
                from pyarrow import fs

                system, root = fs.FileSystem.from_uri(folder)
                system.create_dir(root, recursive=True)
                writer = Writer(folder, file_bytes, sample_bytes, dictionary_bytes, level)
            for page, url, payload, refers in zip(rows["page_id"].tolist(), rows["url"], rows["payload"], rows["refers_to"].tolist()):
                whole = lambda x: None if pd.isna(x) else int(x)
                writer.add(record(whole(page), url, bytes(payload), whole(refers)))
        if writer is not None:
            writer.close()
            yield pd.DataFrame(writer.files, columns=["path", "records", "bytes"]).assign(path=lambda x: folder + "/" + x["path"])

    ids = [F.col(c).cast("decimal(20,0)").alias(c) for c in ("page_id", "refers_to")]  # whole where they are null
    listed = decided(pages, least_bytes).select(*ids, "url", "payload").mapInPandas(archive, "path string, records long, bytes long")
    manifest = work_path(spark, "warc-manifest")
    listed.write.parquet(manifest)
    return spark.read.parquet(manifest)


RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the manifest's files, its payload checked against its digest. Without ``payloads`` they are read
    and checked but not returned."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for rows in batches:
            for path in rows["path"]:
                system, place = fs.FileSystem.from_uri(path)
                held, size = [], 0
                with open_archive(system, place) as stream:
                    for found in parse(stream):
                        size += len(found["payload"] or b"") if payloads else 100
                        held.append(found if payloads else found | {"payload": None})
                        if size >= 8_000_000:
                            yield _frame(held)
                            held, size = [], 0
                yield _frame(held)

    spread = manifest.select("path").repartition(manifest.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.mapInPandas(records, RECORD)


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The records of ``pages`` after a round through archives."""
    return read(write(pages), payloads=False)
