"""WARC archives: a deterministic sharded writer, and the reader of what it writes.

Pages are range-sorted by id. Each partition appends records to gzip files, one member per record, and rolls to
the next file when the compressed size reaches `roll_bytes`. Headers, lengths, digests, record ids and dates are made
anew from the page, so the same pages give the same bytes. Of pages with equal payloads the one with the largest
id is a `response`; the others are `revisit` records without the payload that refer to it.

A task writes each file under a name of its own and moves it to its final name when it is complete; the
manifest, a Parquet table in the folder with name, records, sizes, id range and SHA-256 of each file, is written
last. Readers open the files that the manifest lists and no others, so what failed tasks left is never read.

Which page a revisit refers to is decided on digests alone, with partial aggregation, and comes to the writer as
short rows sorted in before the page, so the payloads are shuffled once and a hot payload gathers nowhere. A null
payload is empty; rows with a null id come first, spread by payload and URL; a null id is written as `null` and read back as null. Rows that repeat the largest id
and its payload are all responses. An empty table gives an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .textscan import slices
from .work import Work, open_folder, result

ROLL_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
# What rows without an id are dealt and ordered by: digest of the payload, hash of the URL.
NAMELESS = ["nameless_sha1", "nameless_url"]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: str, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{sha1}')}>"


def _line(text: str | None) -> str:
    """A header value: one line of printable text."""
    return "".join(c if c.isprintable() else "%" + "%".join(f"{b:02X}" for b in c.encode()) for c in text or "")


def record(page: str, url: str | None, payload: bytes, date: str, refers: str | None) -> bytes:
    sha1 = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers is not None else 'response'}",
        f"WARC-Record-ID: {_record_id(page + '>' + refers if refers is not None else page, sha1)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{sha1}", f"WARC-Block-Digest: sha1:{digest(block)}",
        f"X-Page-ID: {page}"]
    if refers is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers, sha1)}", f"X-Refers-To-Page-ID: {refers}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """The rolling files of one partition."""

    def __init__(self, folder: str, partition: int, attempt: str, roll_bytes: int):
        self.fs, self.base = open_folder(folder)
        self.fs.create_dir(self.base, recursive=True)
        self.partition, self.attempt, self.roll, self.number, self.out = partition, attempt, roll_bytes, 0, None

    def add(self, page: str, raw: bytes) -> dict | None:
        if self.out is None:
            self.name = f"part-{self.partition:06d}-{self.number:05d}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.base}/_{self.attempt}-{self.name}", compression=None)
            self.row = {"name": self.name, "records": 0, "raw_bytes": 0, "bytes": 0, "first_id": page, "last_id": page}
            self.sha = hashlib.sha256()
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(raw) + packer.flush()
        self.out.write(member)
        self.sha.update(member)
        self.row["records"] += 1
        self.row["raw_bytes"] += len(raw)
        self.row["bytes"] += len(member)
        self.row["last_id"] = page
        return self.close() if self.row["bytes"] >= self.roll else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(f"{self.base}/_{self.attempt}-{self.name}", f"{self.base}/{self.name}")
        self.out, self.number = None, self.number + 1
        return self.row | {"sha256": self.sha.hexdigest()}


def write(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    roll_bytes: int = ROLL_BYTES, date: str = DATE,
) -> DataFrame:
    """Write the archives; the manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))

    def dealt_by(sha1: Column) -> list[Column]:
        return [F.when(F.col("id").isNull(), value).alias(name) for name, value in zip(NAMELESS, (sha1, F.xxhash64("url")))]

    digests = rows.select("id", "url", F.sha1("payload").alias("sha1"))
    copied = digests.groupBy("sha1").agg(F.max("id").alias("top"), F.count("*").alias("n")).where("n > 1").select("sha1", "top")
    revisits = digests.join(copied, "sha1").where("id is null or id < top").select(
        "id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "sha1", F.col("top").cast("string").alias("top"),
        *dealt_by(F.col("sha1")))
    kinds = "name string, records long, raw_bytes long, bytes long, first_id string, last_id string, sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, known_id, known, done = None, None, {}, []
        for batch in slices(batches, "payload", 8 << 20):
            if files is None:
                task = TaskContext.get()
                files = _Files(folder, task.partitionId(), str(task.taskAttemptId()), roll_bytes)
            for row in zip(*[batch.column(c).to_pylist() for c in ("id", "url", "payload", "sha1", "top")]):
                page, url, body, sha1, top = row
                if page != known_id or page is None and body is None:
                    known_id, known = page, {}
                if body is None:
                    known[sha1] = top
                    continue
                refers = known.get(hashlib.sha1(body).hexdigest()) if known else None
                name = "null" if page is None else str(page)
                done.append(files.add(name, record(name, url, body, date, refers)))
        if files is not None:
            done.append(files.close())
        done = [d for d in done if d]
        yield pa.RecordBatch.from_pylist(done, pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (x.split() for x in kinds.split(", "))]))

    both = rows.select("*", F.lit(None).cast("string").alias("sha1"), F.lit(None).cast("string").alias("top"), *dealt_by(
        F.sha1("payload"))).unionByName(revisits)
    order = ["id", *NAMELESS, F.col("payload").isNotNull(), F.xxhash64("payload"), "url"]
    manifest = both.repartitionByRange("id", *NAMELESS).sortWithinPartitions(*order).drop(*NAMELESS).mapInArrow(run, kinds)
    path = f"{folder}/manifest"
    manifest.write.parquet(path)
    return spark.read.schema(manifest.schema).parquet(path)


def members(stream) -> Iterator[bytes]:
    """The records of an archive: its gzip members one by one."""
    waiting = b""
    while True:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if not waiting:
                waiting = stream.read(1 << 20)
                if not waiting:
                    if out:
                        raise EOFError("the archive ends within a record")
                    return
            out.append(unpack.decompress(waiting))
            waiting = unpack.unused_data if unpack.eof else b""
        yield b"".join(out)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return headers, rest[:int(headers["Content-Length"])]


def read(spark: SparkSession, folder: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Per record `(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)`, ids as text.

    Block and payload digests are computed again and have to be those of the headers. A revisit has the
    payload's length and digest in its headers and no payload.
    """
    kinds = [("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.string())] + ([("payload", pa.binary())] if payloads else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        for name in (x for b in batches for x in b.column("name").to_pylist()):
            rows, held = [], 0
            with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                for raw in members(stream):
                    headers, block = parse(raw)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    revisit = headers["WARC-Type"] == "revisit"
                    sha1 = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(http.decode().rpartition("Content-Length: ")[2])
                    if headers["WARC-Block-Digest"] != f"sha1:{digest(block)}" or not revisit and (len(payload), digest(payload)) != (size, sha1):
                        raise ValueError(f"{name}: record {headers['WARC-Record-ID']} does not match its digests")
                    page = headers["X-Page-ID"]
                    row = (None if page == "null" else page, headers["WARC-Target-URI"], size, sha1, headers["WARC-Type"], headers.get("X-Refers-To-Page-ID"))
                    rows.append(row + ((None if revisit else payload,) if payloads else ()))
                    held += len(payload) if payloads else 256
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], schema=pa.schema(kinds))
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], schema=pa.schema(kinds))

    names = {"int64": "long", "string": "string", "binary": "binary"}
    # One row is a whole file: as many tasks as files, which merging small partitions must not undo.
    dealt = manifest.select("name").repartition(max(1, manifest.count()), F.col("name"))
    return dealt.mapInArrow(run, ", ".join(f"{n} {names[str(t)]}" for n, t in kinds))


_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
  ((((strpos('0123456789abcdef', substr(h, (5 * i // 4 + 1)::INT, 1)) - 1) * 16
     + strpos('0123456789abcdef', substr(h, (5 * i // 4 + 2)::INT, 1)) - 1) // (2 ** (3 - 5 * i % 4))::BIGINT) % 32)::INT, 1)), '')"""
SQL = f"""
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages))
"""


@query("op3_warc", SQL)
def op3(spark, sf_dir):
    with Work(spark, "warc") as work:
        folder = work.path("archives")
        manifest = write(table(spark, sf_dir, "pages"), folder)
        return result(read(spark, folder, manifest, payloads=False).select(
            F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
            F.col("refers_to").cast("long").alias("refers_to")))
