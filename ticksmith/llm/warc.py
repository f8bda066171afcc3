"""A deterministic, sharded WARC writer, and the reader of what it wrote.

Records are cut into shards by ranges of the id: exact bytes per one of ``bins`` equal id
ranges are summed (a bounded table, all the driver sees), and neighbouring ranges are joined
until a shard holds ``shard_bytes``.  Every shard is one partition of its own, its rows sorted by id,
and are written as a stream of gzip members, each one record; a file is rolled once it has
``file_bytes`` of compressed data.  Headers, record ids (from shard contents) and digests are
made anew and carry no clock or chance, so the same table gives the same files on any cluster.

Equal payloads of at least ``revisit_min`` bytes are written once: the row with the largest id
is a response, the others are revisit records that name it.  The groups are counted by digest
(combined before the shuffle); what each row is to be travels to its shard as a narrow row
beside the records, so no page's text is shuffled twice.

Commit: a task writes each file under a temporary name of its own and renames it to its final
name (``shard-SSSSS-FFFF.warc.gz``) once it is closed; a repeated task renames the same bytes
over the same name.  The files that count are those of the manifest, written after all tasks
have ended; ``read`` reads no others and checks each file's size against it.

Defined results: a null payload is empty; a null id sorts first and cannot be a response
others refer to unless all ids of the group are null; of rows with equal id and payload the
first by URL is the response and the others revisit it; a null URL has no WARC-Target-URI; an
empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.session import shared_path

MANIFEST = "file string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_READ = 1 << 20


def _bytes_of(payload: Column) -> Column:
    return F.coalesce(payload, F.lit("")).cast("binary")


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path; Hadoop writes local ones as ``file:/x``."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _record_id(page_id: int | None, digest: str, n: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{n}')}>"


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str, n: int) -> bytes:
    digest = hashlib.sha1(payload).hexdigest()
    http = _HTTP % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest, n)}",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "%" and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """The files of one shard: opened under a temporary name, rolled by compressed size, renamed when closed."""

    def __init__(self, root: str, shard: int, limit: int):
        self.fs, self.root = _file_system(root)
        self.shard, self.limit, self.part, self.out = shard, limit, 0, None

    def add(self, record: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"shard-{self.shard:05d}-{self.part:04d}.warc.gz"
            self.temporary = f"{self.root}/_temporary-{uuid.uuid4().hex}"
            self.out, self.records, self.size = self.fs.open_output_stream(self.temporary, compression=None), 0, 0
        packed = gzip.compress(record, 6, mtime=0)
        self.out.write(packed)
        self.records += 1
        self.size += len(packed)
        if self.size >= self.limit:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.root}/{self.name}")
            self.out, self.part = None, self.part + 1
            yield self.name, self.records, self.size


def _shards(pages: DataFrame, bins: int, shard_bytes: int) -> tuple[int, int, list[int]]:
    """The lowest id, the width of a bin and each bin's shard, from exact sums over equal ranges of the id."""
    lo, hi = pages.agg(F.min("page_id"), F.max("page_id")).first()
    if lo is None:
        return 0, 1, [0]
    width = (hi - lo) // bins + 1
    sums = pages.groupBy(F.floor((F.col("page_id") - lo) / width).alias("bin")).agg(F.sum("n").alias("n")).filter("bin is not null")
    size = {int(r.bin): r.n for r in sums.collect()}
    out, shard, held = [], 0, 0
    for at in range((hi - lo) // width + 1):
        if held >= shard_bytes and at in size:
            shard, held = shard + 1, 0
        held += size.get(at, 0)
        out.append(shard)
    return lo, width, out


def _plan(pages: DataFrame, revisit_min: int) -> DataFrame:
    """(page_id, digest, refers_to) for the rows of payloads that occur more than once: a row per page_id and digest."""
    large = pages.filter(F.col("n") >= revisit_min).groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("rows"))
    groups = large.groupBy("digest").agg(F.sum("rows").alias("rows"), F.max("page_id").alias("refers_to")).filter("rows > 1")
    # a digest that a third of all rows share: both sides are split by a salt, the groups repeated for each of its values
    salts = 8
    groups = groups.select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    return large.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int")).join(
        groups, ["digest", "salt"]).select("page_id", "digest", "refers_to")


def write(
    pages: DataFrame, root: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_min: int = 1000, shard_bytes: int = 32 << 20, file_bytes: int = 64 << 20, bins: int = 4096,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write the archives under ``root`` and return the manifest (file, records, bytes), itself written to ``root/manifest``."""
    spark = pages.sparkSession
    payload = _bytes_of(pages[payload_col])
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    sized = rows.select("page_id", F.octet_length("payload").alias("n"))
    lo, width, shards = _shards(sized, bins, shard_bytes)
    # one look-up for a row, however many shards there are; null ids go to the first shard
    place_of = F.floor((F.col("page_id") - lo) / width).cast("int")
    shard = F.coalesce(F.get(F.lit(shards), place_of), F.lit(0))
    plan = _plan(rows.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")), revisit_min)
    notes = plan.select(
        shard.alias("shard"), "page_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("payload"), "digest", "refers_to")
    records = rows.select(
        shard.alias("shard"), "page_id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("long").alias("refers_to"))
    fs, place = _file_system(root)
    fs.create_dir(place, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def files() -> Iterator[tuple]:
            at, out, here, notes_of, seen = None, None, object(), {}, {}
            for batch in batches:
                for i in range(batch.num_rows):
                    number, page_id, kind, url, data, digest, refers = (c[i].as_py() for c in batch.columns)
                    if number != at:
                        if out:
                            yield from out.close()
                        at, out, here = number, _Files(root, number, file_bytes), object()
                    if page_id != here:
                        here, notes_of, seen = page_id, {}, {}
                    if kind == 0:
                        notes_of[digest] = refers
                        continue
                    own = hashlib.sha1(data).hexdigest()
                    n = seen[own] = seen.get(own, -1) + 1
                    revisit = own in notes_of and (notes_of[own] != page_id or n > 0)
                    yield from out.add(_record(page_id, url, data, notes_of.get(own), revisit, date, n))
            if out:
                yield from out.close()

        for name, n, size in files():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["file", "records", "bytes"])

    order = ["shard", "page_id", "kind", "url", F.col("payload")]
    every = records.unionByName(notes).repartitionById(shards[-1] + 1, F.col("shard")).sortWithinPartitions(*order)
    every.mapInArrow(run, MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The records of an open archive, one gzip member each."""
    unzip, held = zlib.decompressobj(31), []
    while data := stream.read(_READ):
        while data:
            held.append(unzip.decompress(data))
            data = unzip.unused_data
            if unzip.eof:
                yield b"".join(held)
                unzip, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError("an archive ends within a record")


def _parsed(record: bytes) -> tuple:
    head, rest = record.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    intact = fields["WARC-Block-Digest"] == f"sha1:{hashlib.sha1(block).hexdigest()}" and rest[len(block):] == b"\r\n\r\n"
    if not revisit:
        intact = intact and len(payload) == size and hashlib.sha1(payload).hexdigest() == digest
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return (page and int(page), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], refers and int(refers), intact)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The records of all archives in the manifest under ``root``, their digests checked (``intact``)."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])
        fs, place = _file_system(root)
        for batch in batches:
            for name, _, size in zip(*(c.to_pylist() for c in batch.columns)):
                if fs.get_file_info(f"{place}/{name}").size != size:
                    raise OSError(f"{name} is not the file that the manifest names")
                held = []
                with fs.open_input_stream(f"{place}/{name}", compression=None) as stream:
                    for record in _members(stream):
                        held.append(_parsed(record))
                        if len(held) >= 1000:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)
                            held = []
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=schema)

    spread = manifest.repartition(max(1, manifest.count()), "file")
    return spread.select("file", "records", "bytes").mapInArrow(run, RECORDS)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` into the shared folder and read the archives back."""
    root = shared_path(pages.sparkSession, "warc")
    write(pages, root, **options)
    return read(pages.sparkSession, root)
