"""Web archives: deterministic files in sorted shards, committed by manifest, and read back."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelflens.llm.common import MARK, write_once
from shelflens.sources.shared import delete_path

RESPONSE, REVISIT = "response", "revisit"
# Shards there are at most; beyond, shards get longer, not more. Their bounds go through the driver.
MAX_SHARDS = 4096
# Bytes that a record counts besides its payload when shards are cut.
RECORD_BYTES = 512
CHUNK = 1 << 20
MANIFEST = "name string, shard int, part int, records long, bytes long, sha256 string, temporary string"
RECORDS = (
    "file string, record_id string, record_type string, date string, target_uri string, row_id string, refers_to string,"
    " refers_to_id string, payload binary, payload_bytes long, payload_digest string, intact boolean"
)
# Fixed by the archive format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


@dataclass(frozen=True)
class WarcConfig:
    """How records are laid out."""

    #: Bytes of payloads in a shard, about.
    shard_bytes: int = 64 << 20
    #: A file ends with the record that takes it to so many compressed bytes.
    roll_bytes: int = 32 << 20
    #: Equal payloads of at least so many bytes are stored once.
    revisit_bytes: int = 100
    #: The date of all records; a clock would make each run's files differ.
    date: str = "2000-01-01T00:00:00Z"
    level: int = 6


# Records


def _field(value: str) -> str:
    """A header value without white space and control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_id(uri: str | None, row_id: str | None, digest: str, copy: int = 0) -> str:
    """The same for the same row in every run; ``copy`` numbers rows that are alike."""
    whole = hashlib.sha256("\0".join([uri or "", "" if row_id is None else f"={row_id}", digest, str(copy)]).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=whole[:16], version=5)}>"


def _headers(kind: str, fields: list[tuple[str, str | None]], block_digest: str, length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{name}: {value}" for name, value in fields if value is not None]]
    lines += [f"WARC-Block-Digest: sha256:{block_digest}", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def page_record(
    uri: str | None, row_id: str | None, payload: bytes, copy: int, first: tuple[str | None, str] | None, config: WarcConfig
) -> Iterator[bytes]:
    """The bytes of a response or, if there is a ``first`` (uri, id) with this payload, of a revisit of it."""
    digest = hashlib.sha256(payload).hexdigest()
    head = HTTP_HEAD.format(len(payload)).encode()
    block = hashlib.sha256(head)
    fields = [
        ("WARC-Record-ID", record_id(uri, row_id, digest, copy)),
        ("WARC-Date", config.date),
        ("WARC-Target-URI", None if uri is None else _field(uri)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Row-Id", None if row_id is None else quote(row_id)),
    ]
    if first:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(*first, digest)),
            ("WARC-Refers-To-Target-URI", None if first[0] is None else _field(first[0])),
            ("WARC-Refers-To-Date", config.date),
            ("X-Refers-To-Row-Id", quote(first[1])),
        ]
        payload = b""
    else:
        block.update(payload)
    yield _headers(REVISIT if first else RESPONSE, fields, block.hexdigest(), len(head) + len(payload)) + head
    yield payload
    yield b"\r\n\r\n"


def info_record(name: str, config: WarcConfig) -> Iterator[bytes]:
    body = b"software: shelflens\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Record-ID", record_id(name, None, "")), ("WARC-Date", config.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    yield _headers("warcinfo", fields, hashlib.sha256(body).hexdigest(), len(body)) + body + b"\r\n\r\n"


# Writing


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified folder, as tasks see it, and the path in it."""
    local = re.match(r"file:/+", folder)
    return fs.FileSystem.from_uri("/" + folder[local.end() :] if local else folder)


def qualified(spark: SparkSession, folder: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


class Roller:
    """The files of one shard after the other, each under a temporary name of its own."""

    def __init__(self, folder: str, config: WarcConfig) -> None:
        self.store, self.base = open_folder(folder)
        self.config, self.out, self.shard, self.part = config, None, None, 0

    def start(self, shard: int) -> None:
        self.shard, self.part = shard, 0 if shard != self.shard else self.part + 1
        self.name = f"{shard:05d}-{self.part:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        self.store.create_dir(f"{self.base}/_temporary", recursive=True)
        self.out = self.store.open_output_stream(f"{self.base}/{self.temporary}", compression=None)
        self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        self.put(info_record(self.name, self.config))

    def put(self, pieces: Iterator[bytes]) -> None:
        """One record as one member of the compressed file."""
        packer = zlib.compressobj(self.config.level, zlib.DEFLATED, 31)
        for piece in pieces:
            for at in range(0, len(piece), CHUNK):
                self._write(packer.compress(memoryview(piece)[at : at + CHUNK]))
        self._write(packer.flush())
        self.records += 1

    def _write(self, packed: bytes) -> None:
        self.out.write(packed)
        self.sha.update(packed)
        self.bytes += len(packed)

    def full(self) -> bool:
        return self.out is not None and self.bytes >= self.config.roll_bytes

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.out is not None:
            self.out.close()
            self.out = None
            row = (self.name, self.shard, self.part, self.records - 1, self.bytes, self.sha.hexdigest(), self.temporary)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int32() if isinstance(v, int) and i < 3 else None) for i, v in enumerate(row)],
                names=[f.split()[0] for f in MANIFEST.split(", ")],
            )


def shard_starts(narrow: DataFrame, key: list[str], size: str, shard_bytes: int) -> list[tuple]:
    """The first key of every shard, in order: shards are cut where the running sum of sizes in key order passes a multiple.

    Depends on the rows alone, not on how they are partitioned. The sums run within
    ranges of the sorted rows, and over the ranges.
    """
    total = narrow.agg(F.sum(size)).first()[0] or 0
    width = max(shard_bytes, -(-total // MAX_SHARDS))
    if total <= width:
        return []
    part, at = f"{MARK}part", f"{MARK}at"
    ranged = write_once(narrow.select(*key, size).repartitionByRange(*key).withColumn(part, F.spark_partition_id()), "ranged")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # One row per range of the shuffle.
    sums = ranged.groupBy(part).agg(F.sum(size).alias("sum"))
    sums = sums.select(part, F.coalesce(F.sum("sum").over(before(Window.orderBy(part))), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum(size).over(before(Window.partitionBy(part).orderBy(*key))), F.lit(0))
    placed = ranged.withColumn(at, inside).join(sums, part)
    starts = placed.groupBy(F.floor((F.col("start") + F.col(at)) / width).alias("shard")).agg(F.min(F.struct(*key)).alias("key"))
    return [tuple(r.key) for r in starts.orderBy("shard").collect()]


def shard_of(key: list[str], starts: list[tuple], schema: StructType) -> Column:
    """The number of the last shard that starts at or before the key, by two steps of some dozens of comparisons."""
    if not starts:
        return F.lit(0)
    kinds = [schema[c].dataType for c in key]
    place = F.struct(*[F.col(c) for c in key])
    literal = lambda start: F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(start, kinds, key)])
    step = int(len(starts) ** 0.5) + 1
    runs = [starts[i : i + step] for i in range(0, len(starts), step)]
    passed = lambda sorted_keys: F.size(F.filter(sorted_keys, lambda k: k <= place))
    # The first start is the smallest key there is; so at least one run is passed.
    run = F.greatest(passed(F.array(*[literal(r[0]) for r in runs])), F.lit(1))
    within = F.element_at(F.array(*[F.array(*map(literal, r)) for r in runs]), run)
    return ((run - 1) * step + passed(within) - 1).cast("int")


def write(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    order: list[str] | None = None,
    config: WarcConfig = WarcConfig(),
) -> DataFrame:
    """Pages as compressed web archives in ``folder``; returns the manifest, one row per file.

    Records stand in the order of ``order`` (default: the uri), then id and digest of
    the payload, cut into shards of about ``shard_bytes``; a shard's files end at
    ``roll_bytes`` compressed bytes. The same rows give the same files, byte for byte.
    Of equal payloads of at least ``revisit_bytes`` that with the smallest id is a
    response, the others are revisits of it and don't hold the payload again. Ids,
    digests, lengths and dates of records are made anew.

    Tasks write under temporary names and report their files; the reports of the tasks
    that succeeded are the manifest. Only then files get their names, which may be done
    again without harm, and at last the manifest is put into the folder: what it does
    not list is no part of the archive. A task that is run again writes new temporary
    files with the same contents. A folder with a manifest is not written to again.

    A null payload is an empty one, null uris and ids are left out of the record, and
    rows without an id are revisits if another row of their payload has one, else
    responses. Repeated rows are records with ids of their own; those with the smallest
    id are all responses. A payload is held whole, compressed in chunks. No rows: a
    manifest without files. Other columns are left out.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    store, base = open_folder(folder)
    if store.get_file_info(f"{base}/_manifest").type != fs.FileType.NotFound:
        raise FileExistsError(f"{folder} holds a finished archive")
    order = [uri] if order is None else order
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    key = [*[f"{MARK}o{i}" for i in range(len(order))], f"{MARK}id", f"{MARK}digest"]
    rows = pages.select(
        *[F.col(c).alias(k) for c, k in zip(order, key)],
        F.col(id).alias(f"{MARK}id"),
        F.sha2(body, 256).alias(f"{MARK}digest"),
        F.col(uri).cast("string").alias("uri"),
        body.alias("payload"),
    )
    # Everything but the payloads, from which shards and revisits are found.
    narrow = write_once(rows.withColumn("bytes", F.octet_length("payload").cast("long")).drop("payload"), "narrow")
    starts = shard_starts(narrow.withColumn("size", F.col("bytes") + RECORD_BYTES), key, "size", config.shard_bytes)
    shard = shard_of(key, starts, rows.schema)
    known = narrow.filter((F.col("bytes") >= config.revisit_bytes) & F.col(f"{MARK}id").isNotNull())
    first = known.groupBy(f"{MARK}digest").agg(F.min(F.struct(F.col(f"{MARK}id").alias("id"), "uri")).alias("first"))
    # Notes on revisits stand before their records; so the payloads are shuffled once, and joined with nothing.
    repeats = narrow.filter(F.col("bytes") >= config.revisit_bytes).drop("uri").join(first, f"{MARK}digest")
    repeats = repeats.filter(~F.col(f"{MARK}id").eqNullSafe(F.col("first.id")))
    text = lambda c: F.col(c).cast("string")
    notes = repeats.select(*key, F.lit(0).alias("kind"), text("first.uri").alias("uri"), text("first.id").alias("row_id"), F.lit(None).cast("binary").alias("payload"))
    records = rows.select(*key, F.lit(1).alias("kind"), "uri", text(f"{MARK}id").alias("row_id"), "payload")
    both = notes.distinct().unionByName(records).withColumn("shard", shard)
    # One task per shard, where a hash would put several into one.
    placed = both.repartitionById(max(1, len(starts)), "shard").sortWithinPartitions("shard", *key, "kind", "uri")
    # Rows are alike if all but the payload is; the digest stands for it.
    alike = F.xxhash64(*key)
    given = placed.select("shard", "kind", alike.alias("alike"), "uri", "row_id", f"{MARK}digest", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, note, last, copy = Roller(folder, config), (None, None), None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                number, kind, mark, place, row_id, digest, content = (c[i].as_py() for c in batch.columns)
                if kind == 0:
                    note = ((number, mark, digest), (place, row_id))
                    continue
                same = (number, mark, digest, row_id, place)
                copy, last = copy + 1 if same == last else 0, same
                if files.full() or number != files.shard:
                    yield from files.close()
                if files.out is None:
                    files.start(number)
                files.put(page_record(place, row_id, content, copy, note[1] if note[0] == same[:3] else None, config))
        yield from files.close()

    pending = f"{folder}/_temporary/manifest"
    given.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(pending)
    reports = spark.read.schema(MANIFEST).parquet(pending)
    name_files(reports, folder)
    reports.drop("temporary").write.parquet(f"{folder}/_manifest")
    delete_path(spark, f"{folder}/_temporary")
    return spark.read.parquet(f"{folder}/_manifest")


def name_files(reports: DataFrame, folder: str) -> None:
    """Give the reported files their names, in tasks; files that have theirs already stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{base}/{row['temporary']}", f"{base}/{row['name']}"
                if store.get_file_info(old).type != fs.FileType.NotFound:
                    if store.get_file_info(new).type != fs.FileType.NotFound:
                        store.delete_file(new)  # of a run that was not finished
                    store.move(old, new)
                if store.get_file_info(new).size != row["bytes"]:
                    raise OSError(f"{new} is not the file that was written")
            yield pa.RecordBatch.from_arrays([batch.column("name")], names=["name"])

    reports.mapInArrow(run, "name string").count()


# Reading


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names lower-cased) and block of each record of an uncompressed archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a web archive")
        headers = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        yield headers, block


def _row(file: str, headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    sha = lambda x: "sha256:" + hashlib.sha256(x).hexdigest()
    head, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    revisit = headers["warc-type"] == REVISIT
    digest = headers.get("warc-payload-digest", "") if revisit else sha(payload)
    intact = sha(block) == headers.get("warc-block-digest") and digest == headers.get("warc-payload-digest")
    unquoted = lambda name: unquote(headers[name]) if name in headers else None
    return (
        file,
        headers.get("warc-record-id"),
        headers["warc-type"],
        headers.get("warc-date"),
        headers.get("warc-target-uri"),
        unquoted("x-row-id"),
        headers.get("warc-refers-to"),
        unquoted("x-refers-to-row-id"),
        payload if payloads and not revisit else None,
        (int(length[1]) if length else None) if revisit else len(payload),
        digest.removeprefix("sha256:"),
        intact,
    )


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the archive in ``folder``, file by file in tasks.

    ``row_id`` and ``refers_to_id`` are the ids of the rows written; ``payload_bytes``
    and ``payload_digest`` are of the whole payload, for revisits as their headers state
    them, else counted anew. ``intact``: block and payload have the digests that the
    headers state. Only files that the manifest lists are read, record by record.
    """
    folder = qualified(spark, folder)
    files = spark.read.parquet(f"{folder}/_manifest").select("name")
    schema = spark.createDataFrame([], RECORDS).schema
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.bool_() if n == "intact" else pa.string() for n in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw)) as whole:
                    for headers, block in parse(whole):
                        if headers["warc-type"] not in (RESPONSE, REVISIT):
                            continue
                        rows.append(_row(name, headers, block, payloads))
                        held += len(block) if payloads else 0
                        if held >= 8 * CHUNK or len(rows) >= 4096:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    # One task per file, up to the number of partitions of a shuffle.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "name").mapInArrow(run, schema)
