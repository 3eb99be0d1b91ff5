"""Operator 2: WARC archives: a writer with revisit records and a Python data source that reads them.

Reading plans one partition for each archive file. Each record's headers are parsed first, from the first few kilobytes
of its gzip member; record type and header predicates are tested on them, and the rest of a record that is not wanted
is neither inflated nor copied: the member's 'sl' extra field holds its length, so the reader steps over it. Predicates
come as options (``record_type``, ``header.<Name>``) or, where the session has spark.sql.python.filterPushdown.enabled,
from the query's own filters.

Writing: payload digests and the first page of each digest are found by Spark; pages and digests are joined without a
hint, so that the engine broadcasts the digests that repeat only if they are small and splits hot ones if not. A task
rolls its archive at ARCHIVE_BYTES, so memory is bounded by one record and one archive. Archives are named by task attempt,
and ``read_archives`` reads those of the manifest, which Spark commits with the job: what a lost or late attempt leaves in
the folder is never read. ``read_warc`` reads any archives, such as those of other writers, by folder.

Defined results: null html is an empty payload; a null url leaves the target header out; a page with a null id is
written under an id made from its digest and is a response (nothing can refer to it); of repeated rows with the smallest
id of their payload each is a response; an empty table gives an archive folder without records and no rows; other
columns, whatever their names, are not read. A page of any length is one record.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import dataset
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith

from .common import attempt, open_fs, put_file, table, work_dir

ARCHIVE_BYTES = 32 << 20
MIN_REVISIT_BYTES = 100
HEAD_BYTES = 2048
MANIFEST_FILES = 4
_GZIP = struct.Struct("<4sIBBH2sHII")


# writing


def gzip_member(raw: bytes, level: int = 1) -> bytes:
    """raw as one gzip member whose 'sl' extra field has the member's length and raw's length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    size = _GZIP.size + len(body) + 8
    return _GZIP.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size, len(raw) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def page_record(page_id, url, payload: bytes, digest: str, n_bytes: int, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    body = b"" if refers_to is not None else payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'sha256:' + digest if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(body)}", "", ""]
    return b"".join(["\r\n".join(head).encode(), http, body, b"\r\n\r\n"])


def write_warc(pages: DataFrame, out_dir: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Archives below out_dir/archives; returns the stored manifest, a row for each archive: path, n_records, n_bytes."""
    spark = pages.sparkSession
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha2("html", 256)).withColumn("n_bytes", F.octet_length("html").cast("long"))
    first = own.filter(F.col("n_bytes") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("page_id").alias("n")).filter("n > 1").select("digest", "first_id")
    joined = own.join(first, "digest", "left")
    joined = joined.select("page_id", "url", F.when(F.col("page_id") > F.col("first_id"), None).otherwise(F.col("html")).alias("html"), "digest", "n_bytes", F.when(F.col("page_id") > F.col("first_id"), F.col("first_id")).alias("refers_to"))

    def write(batches):
        at, mine, number, parts, size = TaskContext.get().partitionId(), attempt(), 0, [], 0

        def flush():
            where = f"{out_dir}/archives/pages-{at:06d}-{number:05d}-{mine}.warc.gz"
            put_file(where, b"".join(parts))
            return pa.RecordBatch.from_pydict({"path": [where], "n_records": [len(parts)], "n_bytes": [size]})

        for batch in batches:
            html = batch.column(2)
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)))
            for i, (page_id, url, digest, n_bytes, refers_to) in enumerate(rows):
                payload = html[i].as_buffer().to_pybytes() if html[i].is_valid else b""
                parts.append(gzip_member(page_record(page_id, url, payload, digest, n_bytes, refers_to, date)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield flush()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield flush()

    schema = "path string, n_records long, n_bytes long"
    # a row for each archive, so a few files hold them all
    joined.mapInArrow(write, schema).repartition(MANIFEST_FILES).write.parquet(f"{out_dir}/manifest")
    return spark.read.schema(schema).parquet(f"{out_dir}/manifest")


# reading


class Members:
    """Records of one archive, headers first: iterate, then ask the record for its block, or don't."""

    def __init__(self, f):
        self.f = f

    def _rest(self, n: int) -> bytes:
        return self.f.read(n)

    def __iter__(self):
        while True:
            start = self.f.tell()
            magic = self.f.read(_GZIP.size)
            if not magic:
                return
            if magic[:2] == b"\x1f\x8b":
                skip = None
                if len(magic) == _GZIP.size and magic[3] == 4 and magic[12:14] == b"sl":
                    skip = _GZIP.unpack(magic)[7]
                yield from self._zipped(start, skip)
            elif magic.lstrip(b"\r\n")[:5] == b"WARC/":
                yield from self._plain(start + len(magic) - len(magic.lstrip(b"\r\n")))
            else:
                raise ValueError(f"no WARC record at byte {start}")

    def _zipped(self, start: int, skip: int | None):
        self.f.seek(start)
        z = zlib.decompressobj(31)
        head, fed = b"", 0
        while b"\r\n\r\n" not in head and not z.eof:
            raw = z.unconsumed_tail or self.f.read(min(HEAD_BYTES, skip - fed) if skip else HEAD_BYTES)
            if not raw:
                break
            fed += 0 if z.unconsumed_tail else len(raw)
            head += z.decompress(raw, 4096)
        done = False

        def block() -> bytes:
            nonlocal done, head
            parts = [head]
            while not z.eof:
                raw = z.unconsumed_tail or self.f.read(skip - (self.f.tell() - start) if skip else 1 << 20)
                if not raw:
                    raise ValueError("WARC record is cut")
                parts.append(z.decompress(raw))
            done = True
            return b"".join(parts)

        yield Record(head, block)
        if skip:
            self.f.seek(start + skip)
        else:
            if not done:
                block()
            self.f.seek(self.f.tell() - len(z.unused_data))

    def _plain(self, start: int):
        self.f.seek(start)
        head = b""
        while b"\r\n\r\n" not in head:
            raw = self.f.read(HEAD_BYTES)
            if not raw:
                raise ValueError("WARC record is cut")
            head += raw
        record = Record(head, None)
        size = head.index(b"\r\n\r\n") + 4 + record.length

        def block() -> bytes:
            self.f.seek(start)
            return self.f.read(size)

        record.whole = block
        yield record
        self.f.seek(start + size)
        while (c := self.f.read(4)) and not c.strip(b"\r\n"):
            pass
        self.f.seek(self.f.tell() - len(c.lstrip(b"\r\n")))


class Record:
    def __init__(self, head: bytes, whole):
        self.head, self.whole = head, whole
        self.at = head.index(b"\r\n\r\n") + 4
        self.headers = {}
        for line in head[: self.at - 4].split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            self.headers[k.decode("latin-1").strip().lower()] = v.strip().decode("utf-8", "replace")
        self.length = int(self.headers.get("content-length", 0))

    @property
    def is_http(self) -> bool:
        return self.headers.get("content-type", "").startswith("application/http")

    def payload_bytes(self) -> int:
        """The payload's full length: from the HTTP headers if the record has them, else the block's length."""
        if not self.is_http:
            return self.length
        raw = self.head if b"\r\n\r\n" in self.head[self.at :] else self.whole()
        end = raw.find(b"\r\n\r\n", self.at)
        for line in raw[self.at : end].split(b"\r\n"):
            if line[:15].lower() == b"content-length:":
                return int(line[15:])
        return self.length - (end + 4 - self.at)

    def payload(self) -> bytes:
        block = self.whole()[self.at : self.at + self.length]
        return block.partition(b"\r\n\r\n")[2] if self.is_http else block


SCHEMA = "warc_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, content_type string, payload_bytes long, payload binary, headers map<string,string>"
_FIELDS = {"warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "warc_date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}


@dataclass
class Archive(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        #: A folder written by ``write_warc`` that names the archives to read.
        self.manifest = options.get("manifest")
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.with_headers = options.get("headers", "true").lower() == "true"
        #: Header name to the set of values that pass, and to the prefix that passes.
        self.equal: dict[str, set] = {}
        self.prefix: dict[str, str] = {}
        for k, v in options.items():
            if k == "record_type":
                self.equal["warc-type"] = {x.strip() for x in v.split(",")}
            elif k.startswith("header."):
                self.equal[k[7:].lower()] = {v}
        #: Payloads are decoded only for these record types.
        self.payload_of = {x.strip() for x in options.get("payload_of", "").split(",") if x.strip()}

    def _narrow(self, header: str, values: set) -> None:
        self.equal[header] = self.equal[header] & values if header in self.equal else values

    def wanted(self, headers: dict) -> bool:
        return all(headers.get(k) in v for k, v in self.equal.items()) and all((headers.get(k) or "").startswith(v) for k, v in self.prefix.items())

    def partitions(self):
        if self.manifest:
            fs, path = open_fs(self.manifest)
            names = dataset.dataset(path, pa.schema([("path", pa.string())]), "parquet", fs).to_table().column("path").to_pylist()
            return [Archive(n) for n in sorted(names)] or [Archive("")]
        fs, path = open_fs(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [Archive(self.path)]
        if info.type == pafs.FileType.NotFound:
            return [Archive("")]
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
        names = sorted(x.path[len(path) :].lstrip("/") for x in found if x.type == pafs.FileType.File and x.base_name.endswith((".warc", ".warc.gz")))
        return [Archive(f"{self.path.rstrip('/')}/{n}") for n in names] or [Archive("")]

    def read(self, partition):
        schema = pa.schema([pa.field(k, pa.string()) for k in _FIELDS] + [pa.field("payload_bytes", pa.int64()), pa.field("payload", pa.binary()), pa.field("headers", pa.map_(pa.string(), pa.string()))])
        if not partition.path:
            return
        fs, path = open_fs(partition.path)
        rows, held = [], 0
        with fs.open_input_file(path) as f:
            for record in Members(f):
                h = record.headers
                if not self.wanted(h):
                    continue
                take = self.with_payload and (not self.payload_of or h.get("warc-type") in self.payload_of)
                payload = record.payload() if take else None
                rows.append((*(h.get(k) for k in _FIELDS.values()), record.payload_bytes(), payload, list(h.items()) if self.with_headers else None))
                held += len(payload or b"") + 200
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows), schema)], schema=schema)


class PushingWarcReader(WarcReader):
    """The reader for sessions with spark.sql.python.filterPushdown.enabled; Spark refuses it in others."""

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in _FIELDS and isinstance(f, EqualTo):
                self._narrow(_FIELDS[name], {f.value})
            elif name in _FIELDS and isinstance(f, In):
                self._narrow(_FIELDS[name], set(f.value))
            elif name in _FIELDS and isinstance(f, StringStartsWith) and _FIELDS[name] not in self.prefix:
                self.prefix[_FIELDS[name]] = f.value
            else:
                yield f


class WarcDataSource(DataSource):
    """spark.read.format("warc").load(folder or file); see SCHEMA for its columns."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        options = {k.lower(): v for k, v in dict(self.options).items()}
        return (PushingWarcReader if options.get("pushdown") == "true" else WarcReader)(options)


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("warc").option("pushdown", push).options(**options).load(path)


def read_archives(spark: SparkSession, out_dir: str, **options: str) -> DataFrame:
    """The archives that a finished ``write_warc`` to out_dir has committed."""
    return read_warc(spark, f"{out_dir}/archives", manifest=f"{out_dir}/manifest", **options)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), out)
    back = read_archives(spark, out, payload_of="response", headers="false")
    response = F.col("warc_type") == "response"
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return back.select(
        number("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT sha256(html) AS d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON sha256(html) = d AND n >= 100
"""
