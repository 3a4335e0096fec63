"""WARC archives compressed with Zstandard and a shared dictionary: a reader, and a writer for its input.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself a Zstandard frame or
plain; each record follows as a frame of its own.  The reader decodes one frame at a time and validates frame sizes,
headers, lengths and digests, so its memory follows the largest record, not the archive.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import shared_folder, stored, values

DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
DATE = "2026-01-01T00:00:00Z"
#: Uncompressed bytes after which a task begins a new archive.
ARCHIVE_BYTES = 64_000_000
#: Bounds of the dictionary and of the sample of payloads it is trained on: rows, and bytes of each.
DICTIONARY_BYTES, SAMPLE_ROWS, SAMPLE_BYTES = 32_768, 400, 16_384
#: Tasks that read archives, at most.
MOST_TASKS = 20_000
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000


def sha1_hex(data: bytes) -> str:
    return hashlib.sha1(data).hexdigest()


def record(kind: str, record_id: str, uri: str, payload: bytes, digest: str, size: int, refers_to: str | None = None) -> bytes:
    """One uncompressed WARC record.  A revisit carries the digest and size of the payload it does not repeat."""
    clean = uri.replace("\r", "%0D").replace("\n", "%0A")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", clean),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{refers_to}>")]
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, block) of a record; raises ValueError if it is not whole and valid."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"bad header line {line[:60]!r}")
        headers[name.decode().strip().lower()] = value.decode().strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"no {name}")
    if not headers["content-length"].isdigit():
        raise ValueError("bad content-length")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, content-length {n}")
    block = rest[:n]
    if headers["warc-type"] == "response" and headers.get("warc-payload-digest") != f"sha1:{sha1_hex(block)}":
        raise ValueError("payload digest does not match")
    return headers, block


def _exactly(f: BinaryIO, n: int) -> bytes:
    data = f.read(n)
    if len(data) != n:
        raise ValueError("archive ends inside a frame")
    return data


def read_dictionary(f: BinaryIO) -> zstandard.ZstdCompressionDict | None:
    """Dictionary of the leading skippable frame (None if it is empty)."""
    magic, size = struct.unpack("<II", _exactly(f, 8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start")
    data = _exactly(f, size)
    if data[:4] == ZSTD_MAGIC:
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return zstandard.ZstdCompressionDict(data) if data else None


def read_archive(f: BinaryIO, chunk: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive, one frame each."""
    dictionary = read_dictionary(f)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    left = b""
    while True:
        left = left or f.read(chunk)
        if not left:
            return
        while len(left) < 4 and (more := f.read(chunk)):
            left += more
        if left[:4] != ZSTD_MAGIC:
            raise ValueError("a record's frame does not start here")
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(left))
            if frame.eof:
                left = frame.unused_data
                break
            if not (left := f.read(chunk)):
                raise ValueError("archive ends inside a frame")
        yield parse_record(b"".join(parts))


def train_dictionary(pages: DataFrame, payload: str) -> bytes:
    """A dictionary from a bounded sample (about SAMPLE_ROWS rows drawn by hash, at most twice as many, SAMPLE_BYTES of each); empty if there is too little."""
    n = pages.count()
    share = F.pmod(F.xxhash64(f"`{payload}`"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(n, 1)) * (1 << 30))
    rows = pages.where(share).select(F.substring(F.col(f"`{payload}`"), 1, SAMPLE_BYTES).alias("p")).limit(2 * SAMPLE_ROWS).collect()
    samples = [r["p"].encode() for r in rows if r["p"]]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None,
                   revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row; returns the manifest (path, records) of the archives that belong to the result.

    Payload: the html in UTF-8 (null: empty).  Of records with equal payloads of at least ``revisit_bytes`` bytes the one with
    the largest page id is a response and the others revisit it; of rows with that same id, and of rows with a
    null id, each is a response.  A null url is an empty target.  An empty table gives no archive.  Extra columns are ignored.
    Copies are found by digest and size: one grouping that is combined before its shuffle, so a hot payload meets nowhere.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    text = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    dictionary = train_dictionary(pages, html)
    rows = pages.select(F.col(f"`{page_id}`").alias("id"), F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"), text.alias("html"),
                        F.sha1(text.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    tops = rows.where(F.col("size") >= revisit_bytes).groupBy("digest", "size").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    tops = tops.where("n > 1").select(F.col("digest").alias("digest2"), F.col("size").alias("size2"), "top")
    rows = rows.join(tops, (F.col("digest") == F.col("digest2")) & (F.col("size") == F.col("size2")), "left")
    rows = rows.select("id", "url", "digest", "size", F.when(F.col("id") < F.col("top"), F.col("top")).alias("refers"), "html")
    rows = rows.withColumn("html", F.when(F.col("refers").isNull(), F.col("html")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pulseboard.llm.files import attempt_name, writer
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True) if shared else zstandard.ZstdCompressor(level=3)
        name, paths, counts, out, filled = attempt_name(), [], [], None, 0
        try:
            for batch in batches:
                for key, url_, digest, size, refers, body in values(batch, "id", "url", "digest", "size", "refers", "html"):
                    if out is None or filled >= archive_bytes:
                        if out is not None:
                            out.close()
                        paths.append(f"{folder}/{name}-{len(paths):05d}.warc.zst")
                        counts.append(0)
                        out, filled = writer(paths[-1]), 0
                        packed = zstandard.ZstdCompressor().compress(dictionary) if dictionary else b""
                        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
                    ref = None if refers is None else f"urn:page:{refers}"
                    data = record("response" if ref is None else "revisit", f"urn:page:{'' if key is None else key}", url_, (body or "").encode("utf-8", "surrogatepass"), digest, size, ref)
                    out.write(compressor.compress(data))
                    filled += len(data)
                    counts[-1] += 1
        finally:
            if out is not None:
                out.close()
        yield pa.record_batch([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

    return stored(rows.mapInArrow(write, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the archives of a manifest: path, record_id, record_type, uri, payload_digest, payload_bytes, refers_to (and payload).

    Archives are read one at a time per task, frame by frame; a record that is not whole and valid, or an archive with
    other than its manifest's number of records, fails the job.  Ids are without their ``urn:page:``; an empty one is null.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pulseboard.llm.files import reader
        bare = lambda s: (s or "").removeprefix("<urn:page:").removesuffix(">") or None
        for batch in batches:
            for path, records in zip(batch["path"], batch["records"], strict=True):
                rows, held, n = [], 0, 0
                with reader(path) as f:
                    for h, block in read_archive(f):
                        rows.append((path, bare(h["warc-record-id"]), h["warc-type"], h.get("warc-target-uri"), h["warc-payload-digest"].removeprefix("sha1:"),
                                     int(h["x-payload-length"]) if h["warc-type"] == "revisit" else len(block), bare(h.get("warc-refers-to")), *((block,) if payloads else ())))
                        held, n = held + (len(block) if payloads else 200), n + 1
                        if held > 8_000_000:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                if n != records:
                    raise ValueError(f"{path} has {n} records, not {records}")
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    schema = "path string, record_id string, record_type string, uri string, payload_digest string, payload_bytes long, refers_to string" + ", payload binary" * payloads
    names = [x.split()[0] for x in schema.split(", ")]
    # a number of its own: by their bytes the manifest's rows would all go to one task
    return manifest.repartition(max(1, min(manifest.count(), MOST_TASKS)), "path").mapInPandas(read, schema)
