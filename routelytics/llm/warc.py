"""WARC archives as a Spark data source, in Python.

``spark.read.format("warc").schema(...).load(folder)`` plans one partition per
file, or per marked stretch of a file the writer made (records cannot be found
from the middle of a foreign file).  Filters on header fields are pushed into
the scan: a record's headers are parsed first, and a record that fails them,
or whose payload is not in the requested schema, is skipped without being
read, decoded or sent to Spark.

``df.write.format("warc")`` writes records in files of its own per task
attempt.  Only files of committed tasks enter the manifest, and a reader that
finds a manifest reads only what it lists, so lost executors and repeated
attempts leave no stray records.  Files are opened through
``pyarrow.fs`` and so may lie in any store it knows.

Columns (``RECORD``): record_id, record_type, target_uri, date, content_type,
payload_digest (bare upper-case base32 SHA-1), payload_bytes, refers_to,
payload.  A revisit has no payload but keeps the size and digest of it.  An HTTP
block without a blank line has no headers: all of it is payload.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
                                    Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema

RECORD = ("record_id string, record_type string, target_uri string, date string, content_type string, "
          "payload_digest string, payload_bytes long, refers_to string, payload binary")
_MANIFEST = "_manifest.json"
_CHUNK = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


#: The digits of base conversion and of base32, in order.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(sha1_hex):
    """Upper-case base32 of a column of 40 hexadecimal digits: five of them are four of base32."""
    def part(i):
        return F.lpad(F.upper(F.conv(F.substr(sha1_hex, i * 5 + 1, F.lit(5)), 16, 32)), 4, "0")
    return F.translate(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), part), ""), _DIGITS, _BASE32)


# -- writing ---------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: list = field(default_factory=list)  # (name, bytes, starts of stretches)


def _header(value) -> str:
    """A value on one line."""
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    if isinstance(payload, str):
        payload = payload.encode("utf-8", "surrogatepass")
    revisit = row["record_type"] == "revisit"
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: {_header(row['content_type'] or 'text/html; charset=utf-8')}\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {_header(row['record_type'])}", f"WARC-Record-ID: <{_header(row['record_id'])}>",
             f"WARC-Date: {_header(row['date'])}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_header(row['target_uri'])}")
    if row["payload_digest"] is not None:
        lines.append(f"WARC-Payload-Digest: sha1:{_header(row['payload_digest'])}")
    if revisit:
        lines.append(f"WARC-Profile: {_PROFILE}")
        if row["refers_to"] is not None:
            lines.append(f"WARC-Refers-To: <{_header(row['refers_to'])}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, options: dict, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.gzip = options.get("compression", "none") == "gzip"
        self.file_bytes = int(options.get("file_bytes", 256 << 20))
        self.stretch = int(options.get("stretch_bytes", 32 << 20))

    def write(self, iterator):
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        done, out, name, size, starts = Written(), None, "", 0, []

        def close():
            if out is not None:
                out.close()
                done.files.append((name, size, starts))
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= self.file_bytes:
                    close()
                    name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.gzip else "")
                    out, size, starts = store.open_output_stream(f"{root}/{name}", compression=None, buffer_size=_CHUNK), 0, [0]
                if size - starts[-1] >= self.stretch:
                    starts.append(size)
                data = _record(row)
                if self.gzip:  # a member of its own per record
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = z.compress(data) + z.flush()
                out.write(data)
                size += len(data)
        close()
        return done

    def commit(self, messages):
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files = [list(f) for m in messages if m for f in m.files]
        manifest = f"{root}/{_MANIFEST}"
        if not self.overwrite and store.get_file_info(manifest).type == fs.FileType.File:
            with store.open_input_stream(manifest) as f:
                files = json.loads(f.read())["files"] + files
        with store.open_output_stream(manifest) as f:
            f.write(json.dumps({"files": files}).encode())

    def abort(self, messages):
        store, root = fs.FileSystem.from_uri(self.path)
        for m in messages:
            for name, *_ in (m.files if m else []):
                store.delete_file(f"{root}/{name}")


# -- reading ---------------------------------------------------------------


class _Source:
    """Bytes of a file from an offset on; what is skipped beyond the buffer is not read."""

    def __init__(self, f, at: int):
        self.f, self.at, self.buf, self.pos = f, at, b"", 0  # at: offset of buf in the file
        f.seek(0, 2)
        self.size = f.tell()
        f.seek(at)

    def tell(self) -> int:
        return self.at + self.pos

    def _fill(self, more: int = _CHUNK) -> bool:
        got = self.f.read(more)
        self.at, self.buf, self.pos = self.at + self.pos, self.buf[self.pos:] + got, 0
        return bool(got)

    def until(self, mark: bytes, most: int | None = None) -> bytes | None:
        """Bytes before ``mark``, which is passed; None where the file, or the
        stretch of ``most`` bytes it is looked for in, ends without it."""
        seen = self.pos
        while True:
            k = self.buf.find(mark, seen, len(self.buf) if most is None else self.pos + most)
            if k >= 0:
                out = self.buf[self.pos:k]
                self.pos = k + len(mark)
                return out
            if most is not None and len(self.buf) - self.pos >= most:
                return None
            seen = max(0, len(self.buf) - self.pos - len(mark) + 1)
            if not self._fill():
                return None

    def take(self, n: int) -> bytes:
        while len(self.buf) - self.pos < n:
            if not self._fill(max(_CHUNK, n)):
                raise EOFError("the file ends inside a record")
        out = self.buf[self.pos:self.pos + n]
        self.pos += n
        return out

    def skip(self, n: int) -> None:
        if n <= len(self.buf) - self.pos:
            self.pos += n
        else:
            to = self.tell() + n
            if to > self.size + 4:  # the blank lines after the last record may be missing
                raise EOFError("the file ends inside a record")
            self.at, self.buf, self.pos = min(to, self.size), b"", 0
            self.f.seek(self.at)


class _Members(_Source):
    """The same over gzip members, up to the offset ``end`` of the compressed file:
    bytes are inflated, and skipped ones dropped at once."""

    def __init__(self, f, at: int, end: int | None = None):
        super().__init__(f, at)
        self.z, self.rest, self.left = zlib.decompressobj(31), b"", (self.size if end is None else end) - at

    def _fill(self, more: int = _CHUNK) -> bool:
        got = b""
        while not got:
            if self.z.eof:
                self.rest, self.z = self.z.unused_data, zlib.decompressobj(31)
            raw = self.rest
            if not raw:
                raw = self.f.read(min(_CHUNK, self.left))
                self.left -= len(raw)
            self.rest = b""
            if not raw:
                return False
            got = self.z.decompress(raw, _CHUNK)
            self.rest = self.z.unconsumed_tail
            if self.z.eof:
                self.rest = b""  # unused_data holds it
        self.at, self.buf, self.pos = self.at + self.pos, self.buf[self.pos:] + got, 0
        return True

    def skip(self, n: int) -> None:
        while n > len(self.buf) - self.pos:
            n -= len(self.buf) - self.pos
            self.pos = len(self.buf)
            if not self._fill():
                raise EOFError("the file ends inside a record")
        self.pos += n


def _fields(head: bytes) -> dict[str, str]:
    out, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            k, v = line.split(":", 1)
            last = k.strip().lower()
            out[last] = v.strip()
    return out


def _bare(v: str | None) -> str | None:
    return v.removeprefix("<").removesuffix(">") if v is not None else None


def read_records(src: _Source, end: int | None, tests, want_size: bool, want_payload: bool):
    """Rows (dicts) of the records that begin before ``end`` and pass the header tests."""
    while end is None or src.tell() < end:
        head = src.until(b"\r\n\r\n")
        if head is None:
            if src.buf[src.pos:].strip(b"\r\n"):
                raise EOFError("the file ends inside a record's headers")
            return
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record before byte {src.tell()}")
        h = _fields(head)
        length = int(h["content-length"])
        kind, digest = h.get("warc-type"), h.get("warc-payload-digest")
        row = {"record_id": _bare(h.get("warc-record-id")), "record_type": kind, "target_uri": h.get("warc-target-uri"),
               "date": h.get("warc-date"), "content_type": h.get("content-type"),
               "payload_digest": digest.split(":", 1)[1] if digest and digest.startswith("sha1:") else digest,
               "refers_to": _bare(h.get("warc-refers-to")), "payload_bytes": None, "payload": None}
        if not all(t(row) for t in tests):
            src.skip(length + 4)
            continue
        left = length
        if (want_size or want_payload) and "application/http" in (h.get("content-type") or ""):
            http = src.until(b"\r\n\r\n", length)
            left -= len(http) + 4 if http is not None else 0
            size = _fields(http).get("content-length") if http is not None else None
            row["payload_bytes"] = int(size) if size and size.isdigit() else left
        elif kind != "revisit":
            row["payload_bytes"] = length
        if want_payload and kind != "revisit":
            row["payload"] = src.take(left)
            left = 0
        src.skip(left + 4)
        yield row


@dataclass
class Stretch(InputPartition):
    name: str
    start: int
    end: int | None


_COMPARE = {
    EqualTo: lambda a, b: a is not None and a == b, EqualNullSafe: lambda a, b: a == b,
    In: lambda a, b: a is not None and a in b, IsNull: lambda a, _: a is None, IsNotNull: lambda a, _: a is not None,
    StringStartsWith: lambda a, b: a is not None and a.startswith(b), StringEndsWith: lambda a, b: a is not None and a.endswith(b),
    StringContains: lambda a, b: a is not None and b in a, GreaterThan: lambda a, b: a is not None and a > b,
    GreaterThanOrEqual: lambda a, b: a is not None and a >= b, LessThan: lambda a, b: a is not None and a < b,
    LessThanOrEqual: lambda a, b: a is not None and a <= b,
}
#: fields that the record headers alone decide
_TESTABLE = {"record_id", "record_type", "target_uri", "date", "content_type", "payload_digest", "refers_to"}


def header_test(f):
    """Test of a row for a filter on header fields, or None where it cannot be decided there."""
    if isinstance(f, Not):
        inner, column = header_test(f.child), getattr(f.child, "attribute", ())
        if inner is None or isinstance(f.child, Not):
            return None
        # a comparison with null is neither true nor false
        null_passes = isinstance(f.child, (IsNull, IsNotNull, EqualNullSafe))
        return lambda row: (null_passes or row[column[0]] is not None) and not inner(row)
    compare = _COMPARE.get(type(f))
    if compare is None or len(f.attribute) != 1 or f.attribute[0] not in _TESTABLE:
        return None
    column, value = f.attribute[0], getattr(f, "value", None)
    return lambda row: compare(row[column], value)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.path, self.schema, self.filters = path, schema, []

    def pushFilters(self, filters):
        for f in filters:
            if header_test(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self):
        store, root = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            return [Stretch(root, 0, None)]
        manifest = f"{root}/{_MANIFEST}"
        if store.get_file_info(manifest).type == fs.FileType.File:
            with store.open_input_stream(manifest) as f:
                files = json.loads(f.read())["files"]
            out = []
            for name, size, starts in files:
                out += [Stretch(f"{root}/{name}", a, z) for a, z in zip(starts, [*starts[1:], size])]
            return out or [Stretch("", 0, 0)]
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        names = sorted(x.path for x in found if x.type == fs.FileType.File and x.path.endswith((".warc", ".warc.gz")))
        return [Stretch(n, 0, None) for n in names] or [Stretch("", 0, 0)]

    def read(self, partition):
        if not partition.name:
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        names = self.schema.names
        arrow = to_arrow_schema(self.schema)
        tests = [header_test(f) for f in self.filters]
        with store.open_input_file(partition.name) as f:
            end = partition.end
            if partition.name.endswith(".gz"):
                # records are members of their own, so a stretch ends with the bytes it may inflate
                src, end = _Members(f, partition.start, end), None
            else:
                src = _Source(f, partition.start)
            rows, held = [], 0
            for row in read_records(src, end, tests, "payload_bytes" in names, "payload" in names):
                rows.append(row)
                held += 200 + len(row["payload"] or b"")
                if held > 8 << 20:
                    yield self._batch(rows, names, arrow)
                    rows, held = [], 0
            if rows:
                yield self._batch(rows, names, arrow)

    @staticmethod
    def _batch(rows, names, arrow):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], arrow.field(n).type) for n in names], schema=arrow)


class WarcSource(DataSource):
    """Options: path; for writing compression (none, gzip), file_bytes, stretch_bytes."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return RECORD

    def reader(self, schema):
        known = {c.strip().split(" ")[0] for c in RECORD.split(",")}
        if not set(schema.names) <= known:
            raise ValueError(f"a WARC record has no {sorted(set(schema.names) - known)}")
        return WarcReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    # without it Spark refuses readers that take filters
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """Records under ``path``; fields that are not in ``schema`` are not decoded."""
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


# -- pages -----------------------------------------------------------------

_ID = "urn:x-page:"


def records_of(pages: DataFrame, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One record per row of ``pages`` (page_id, url, html), in the columns of RECORD.

    Of records with equal payloads of at least ``least_bytes`` bytes that with
    the largest page_id is the response and the others revisit it.  A null
    html is empty.  Rows that repeat the largest id are all responses, and so
    are rows with a null id where no row of the payload has one.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("target_uri"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # many rows may share a payload: the largest ids are a grouped maximum, met by a join that can be split
    last = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("last"))
    rows = rows.join(last, "sha1", "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    # rows with a null id have no name to be told apart by but a random one
    own = F.coalesce(F.concat(F.lit(_ID), F.col("page_id").cast("string")), F.concat(F.lit("urn:uuid:"), F.expr("uuid()")))
    return rows.select(
        own.alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit(date).alias("date"), F.lit("text/html; charset=utf-8").alias("content_type"),
        base32(F.col("sha1")).alias("payload_digest"), "payload_bytes",
        F.when(revisit, F.concat(F.lit(_ID), F.col("last").cast("string"))).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0, **options) -> None:
    register(pages.sparkSession)
    records_of(pages, least_bytes).write.format("warc").mode("append").options(**options).save(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Columns of the op8 contract, from the headers, and beside them ``stored_bytes`` and
    ``stored_digest``: size and digest of the payloads that the archives hold (null for
    revisits), by which a damaged payload shows.

    Each kind of record is a scan of its own with its kind pushed down, so that
    only responses have payloads read.
    """
    heads = "record_id string, record_type string, payload_digest string, payload_bytes long, refers_to string"
    stored = read_warc(spark, path, f"{heads}, payload binary").filter(F.col("record_type") == "response")
    stored = stored.select("*", F.octet_length("payload").cast("long").alias("stored_bytes"),
                           base32(F.sha1("payload")).alias("stored_digest")).drop("payload")
    revisits = read_warc(spark, path, heads).filter(F.col("record_type") == "revisit")
    got = stored.unionByName(revisits, allowMissingColumns=True)

    def page(c):
        return F.nullif(F.regexp_extract(c, f"^{_ID}(-?[0-9]+)$", 1), F.lit("")).cast("long")
    return got.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      page("refers_to").alias("refers_to"), "stored_bytes", "stored_digest")


def digest(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the pages to a new folder under ``folder``, a gzip member a record, and reads
    their records back.  The result is a scan of the archives, so they stay."""
    path = os.path.join(folder, f"warc-{uuid.uuid4().hex}")
    write_pages(pages, path, compression="gzip")
    return page_records(pages.sparkSession, path)
