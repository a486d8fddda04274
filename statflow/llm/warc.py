"""Operator 3: WARC archives, one gzip member per record.

Writing: pages with equal payloads are found by digest in Spark; the first
page of each group becomes a response, the rest revisits that refer to it.
Each task writes one archive file into a shared folder, under a temporary
name that it renames when the file is whole; a task that runs again writes
the same name again.

Reading: each task reads its archives sequentially in small blocks. zlib
decompresses one member after the other incrementally, records are framed by
their Content-Length, and block digests are verified while bytes pass by. No
more than one record is held.

Defined results: a null page is an empty payload. Payloads shorter than
``min_revisit`` are all responses. A null ``page_id`` is written without the
id's header and sorts after every other one as first of its group. Rows that
repeat the smallest id of a group are all responses. An empty table gives no
record. Extra columns are not archived.

Archives of other writers: any ``WARC/<n>.<n>`` version, header names in any
case and any white space after the colon, continuation lines, and block digests
by SHA-1 (base 32 or hex), SHA-256 or MD5. ``headers`` are keyed by lower-case
names; of a repeated header the last value counts. ``digest_ok`` is null where
a record has no block digest, or one of another kind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO, NamedTuple

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm.common import text_id
from statflow.session import scratch_path

MIN_REVISIT = 100
#: Compression level: archives are read back more often for speed than for size.
LEVEL = 3
READ_BYTES = 1 << 18

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "archive string, position long, record_type string, headers map<string,string>, payload binary, digest_ok boolean"


_VERSION = re.compile(rb"WARC/\d+\.\d+[ \t]*$")


class Record(NamedTuple):
    position: int
    headers: dict[str, str]
    block: bytes
    digest_ok: bool | None


# --- one archive ----------------------------------------------------------


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block), b"", b""]
    zipped = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return zipped.compress(b"\r\n".join(head)) + zipped.compress(block) + zipped.compress(b"\r\n\r\n") + zipped.flush()


def parse_headers(lines: list[bytes]) -> dict[str, str]:
    """Header lines → lower-case name to value; a line that starts with white space continues the one before."""
    headers: dict[str, str] = {}
    name = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name is not None:
            headers[name] = f"{headers[name]} {text.strip()}".strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            headers[name] = value.strip()
    return headers


def digest_matches(labelled: str | None, block: bytes) -> bool | None:
    """Whether a block has its digest (``sha1:…``); null if there is none to check."""
    kind, _, want = (labelled or "").partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("sha1", "sha256", "md5"):
        return None
    found = hashlib.new(kind, block)
    plain = base64.b32encode(found.digest()).decode().rstrip("=")
    return want.strip().lower() == found.hexdigest() or want.strip().upper().rstrip("=") == plain


def read_records(source: BinaryIO) -> Iterator[Record]:
    """The records of an archive, in order, from sequential reads of bounded size."""
    compressed = source.read(READ_BYTES)
    total = len(compressed)  # bytes read so far
    while compressed:
        position = total - len(compressed)
        member, plain = zlib.decompressobj(31), bytearray()
        headers, start, length = None, 0, 0
        while not member.eof:
            data = member.decompress(compressed, READ_BYTES)
            compressed = member.unused_data if member.eof else member.unconsumed_tail
            plain += data
            if headers is None and (end := plain.find(b"\r\n\r\n")) >= 0:
                lines = bytes(plain[:end]).split(b"\r\n")
                if not _VERSION.match(lines[0]):
                    raise ValueError(f"not a record at {position}: {lines[0][:40]!r}")
                headers = parse_headers(lines[1:])
                if not headers.get("content-length", "").isdigit():
                    raise ValueError(f"the record at {position} does not state its Content-Length")
                start, length = end + 4, int(headers["content-length"])
            if not member.eof and not compressed:
                compressed = source.read(READ_BYTES)
                total += len(compressed)
                if not compressed and not data:
                    raise EOFError(f"the record at {position} is cut off")
        if headers is None or len(plain) != start + length + 4 or plain[start + length :] != b"\r\n\r\n":
            raise ValueError(f"the record at {position} does not have its Content-Length")
        block = bytes(plain[start : start + length])
        yield Record(position, headers, block, digest_matches(headers.get("warc-block-digest"), block))
        if not compressed:
            compressed = source.read(READ_BYTES)
            total += len(compressed)


# --- Spark jobs -----------------------------------------------------------


def _open(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _write(folder: str):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"{root}/part-{task.partitionId():06d}.warc.gz"
        draft = f"{root}/.draft-{task.partitionId():06d}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        n = 0
        with fs.open_output_stream(draft, compression=None) as out:
            for frame in frames:
                for page in frame.itertuples(index=False):
                    out.write(_page_record(page, date))
                    n += 1
        fs.move(draft, name)
        yield pd.DataFrame({"archive": [name], "records": [n]})

    return of


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page_record(page, date: str) -> bytes:
    payload = (page.html or "").encode("utf-8", "surrogatepass")
    revisit = not pd.isna(page.refers_to)
    block = b"" if revisit else payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Date", date)]
    page_id = None if pd.isna(page.page_id) else int(page.page_id)
    headers.append(("WARC-Record-ID", _record_id(page_id)))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if page.url:
        headers.append(("WARC-Target-URI", " ".join(page.url.split())))
    headers += [
        ("WARC-Payload-Digest", f"sha256:{page.digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
    ]
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(int(page.refers_to)))]
    return record_bytes(headers, block)


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write every page as a record; (archive, records) of the files written. Runs when acted upon."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", F.sha2(html, 256).alias("digest")
    )
    firsts = (
        slim.where(F.octet_length("html") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    long_enough = F.coalesce(F.octet_length("html"), F.lit(0)) >= min_revisit
    marked = slim.join(firsts, "digest", "left").withColumn(
        "refers_to", F.when(long_enough & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    )
    named = text_id(text_id(marked, "page_id"), "refers_to")
    return named.select("page_id", "url", "html", "digest", "refers_to").mapInPandas(_write(folder), "archive string, records long")


def _read(folder_scheme: str):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs = _open(folder_scheme)[0]
        for frame in frames:
            for name in frame["archive"]:
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as source:
                    for r in read_records(source):
                        rows.append((name, r.position, r.headers.get("warc-type"), r.headers, r.block, r.digest_ok))
                        held += len(r.block) + 1000
                        if held > 1 << 23:
                            yield _record_frame(rows)
                            rows, held = [], 0
                yield _record_frame(rows)

    return of


def _record_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["archive", "position", "record_type", "headers", "payload", "digest_ok"])


def read_archives(spark: SparkSession, folder: str, archives: DataFrame) -> DataFrame:
    """The records of the archives that ``archives`` names, one file per task."""
    n = max(1, archives.count())
    return archives.select("archive").repartition(n, "archive").mapInPandas(_read(folder), RECORD)


def page_round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the pages, read the archives back: one row per record, as its contract has it."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    listing = scratch_path(spark, "warc-files")
    write_archives(pages, folder, min_revisit).write.parquet(listing)
    records = read_archives(spark, folder, spark.read.parquet(listing))
    h = F.col("headers")
    digest = F.when(F.col("digest_ok"), F.substring_index(h["warc-payload-digest"], ":", -1))
    return records.select(
        h["x-page-id"].cast("long").alias("page_id"),
        h["x-payload-length"].cast("long").alias("payload_bytes"),
        F.when((F.col("record_type") == "revisit") | (digest == F.sha2("payload", 256)), digest).alias("payload_digest"),
        "record_type",
        F.regexp_extract(h["warc-refers-to"], r"^<urn:page:(-?\d+)>$", 1).try_cast("long").alias("refers_to"),
        F.col("archive"),
        F.col("position"),
    )
