"""WARC archives in ZIP packages, written and read back without extraction.

Each package is a ZIP file in the shared folder whose members are stored (not deflated):
``archive/data.warc.gz``, in which every record is a gzip member of its own, and
``indexes/index.cdx`` (one line a record: id, offset, length).
A task writes its packages through ``pyarrow.fs``, under names of their own, so the folder may
be any in ``STORES`` (``hdfs`` and ``viewfs`` need libhdfs on every machine; object stores take
their credentials from the machines' environment, not from Hadoop's settings); the list of packages is a written table, so files of a
task that was lost and run again are simply not listed. The reader opens a package, reads
its end record, follows the ZIP64 one where the 32-bit fields are full, parses the central
directory, locates the members through their local headers, and reads only the ranges it
needs: the index and, by its lines, one record after the other.

Of pages with equal payloads of ``least`` bytes or more, the one with the largest id
is a response and the others revisit it. Groups of copies are met by a partial
aggregate and a join that adaptive execution can split, never gathered; smaller payloads
don't take part in the join.

Every record has an id of its own. A revisit names the response's id, address and date; if
rows repeat the response (equal id and payload), it names address and date only.

Defined results: a null html is an empty payload; repeated rows (equal id and payload)
are records of their own, all responses if their id is the largest; a row without an id
is a record without one (a revisit if a copy has an id, else a response); an empty table
gives an empty result; a very long page is one record, whole; columns other than id, url
and html are ignored, whatever their names.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, shared_folder, ship, table

LEAST = 1000
PACKAGE_BYTES = 8 << 20
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
PACKING = 3  # of gzip

# Fixed values of the ZIP format: signatures and full 16- and 32-bit fields.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def zip_stored(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP of stored members; ``zip64`` writes 64-bit fields even if not needed."""
    out, directory = [], []
    at = 0
    for name, data in members:
        path, crc = name.encode(), zlib.crc32(data)
        big = zip64 or len(data) >= FULL32
        size = FULL32 if big else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        header = LOCAL + struct.pack("<HHHHHIIIHH", 45 if big else 20, 0x800, 0, 0, 33, crc, size, size, len(path), len(extra)) + path + extra
        far = zip64 or at >= FULL32
        extra = struct.pack("<QQ", len(data), len(data)) * big + struct.pack("<Q", at) * far
        extra = struct.pack("<HH", 1, len(extra)) + extra if extra else b""
        directory.append(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if big else 20, 0x800, 0, 0, 33, crc, size, size, len(path), len(extra), 0, 0, 0, 0, FULL32 if far else at) + path + extra)
        out += [header, data]
        at += len(header) + len(data)
    central = b"".join(directory)
    n, size = len(members), len(central)
    tail = b""
    if zip64 or at >= FULL32:
        tail = END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, at) + LOCATOR64 + struct.pack("<IQI", 0, at + size, 1)
        tail += END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    else:
        tail = END + struct.pack("<HHHHIIH", 0, 0, n, n, size, at, 0)
    return b"".join([*out, central, tail])


Read = Callable[[int, int], bytes]


def zip_members(read: Read, size: int) -> dict[str, tuple[int, int]]:
    """(offset of the data, length) of each stored member."""
    tail_at = max(0, size - 22 - FULL16)
    tail = read(tail_at, size - tail_at)
    k = tail.rfind(END)
    if k < 0:
        raise ValueError("no end of central directory")
    n, length, at = struct.unpack_from("<HII", tail, k + 10)
    if n == FULL16 or FULL32 in (length, at):
        where = tail_at + k - 20
        locator = read(where, 20)
        if locator[:4] == LOCATOR64:
            end = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            n, length, at = struct.unpack_from("<QQQ", end, 32)
    directory, out, p = read(at, length), {}, 0
    for _ in range(n):
        if directory[p : p + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, p + 10)[0]
        stored, plain, names, extras, notes = struct.unpack_from("<IIHHH", directory, p + 20)
        offset = struct.unpack_from("<I", directory, p + 42)[0]
        name = directory[p + 46 : p + 46 + names].decode()
        extra, q = directory[p + 46 + names : p + 46 + names + extras], 0
        while q + 4 <= len(extra):
            kind, much = struct.unpack_from("<HH", extra, q)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{much // 8}Q", extra, q + 4))
                plain = wide.pop(0) if plain == FULL32 else plain
                stored = wide.pop(0) if stored == FULL32 else stored
                offset = wide.pop(0) if offset == FULL32 else offset
            q += 4 + much
        if method == 0:
            local = read(offset, 30)
            if local[:4] != LOCAL:
                raise ValueError("no local header")
            a, b = struct.unpack_from("<HH", local, 26)
            out[name] = (offset + 30 + a + b, stored)
        p += 46 + names + extras + notes
    return out


class Record(NamedTuple):
    """A page as it is archived: ``refers_to``, ``to_url`` and ``to_record`` are those of the response that it revisits."""

    page_id: int | None
    url: str | None
    payload: bytes
    revisit: bool
    refers_to: int | None = None
    to_url: str | None = None
    to_record: str | None = None


def record(page: Record, record_id: str, date: str) -> bytes:
    """A WARC/1.1 record; a revisit keeps size and digest of the payload in its head, not the payload."""
    body = b"" if page.revisit else page.payload
    address = lambda url: " ".join((url or "").split())
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if page.revisit else 'response'}",
        f"WARC-Record-ID: {record_id}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {address(page.url)}",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(page.payload).hexdigest()}",
        f"X-Page-Id: {'' if page.page_id is None else page.page_id}",
        f"X-Payload-Length: {len(page.payload)}",
    ]
    if page.revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To: {page.refers_to}", f"WARC-Refers-To-Target-URI: {address(page.to_url)}", f"WARC-Refers-To-Date: {date}"]
        head += [f"WARC-Refers-To: {page.to_record}"] if page.to_record else []
    else:
        head.append("Content-Type: text/html; charset=utf-8")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def urn(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


#: What Hadoop calls a store, and what pyarrow does; other stores it does not reach.
STORES = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}


def store_address(folder: str) -> str:
    """A folder's address as pyarrow takes it."""
    scheme, sep, rest = folder.partition(":")
    if folder.startswith("/") or not sep:
        return folder
    if scheme not in STORES:
        raise ValueError(f"packages can't be written to {folder}: no store of {', '.join(STORES)}")
    return "/" + rest.lstrip("/") if scheme == "file" else f"{STORES[scheme]}:{rest}"


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and its path there."""
    return fs.FileSystem.from_uri(store_address(folder))


def packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, date: datetime.datetime | None = None) -> DataFrame:
    """``path, bytes`` of ZIP files of about ``package_bytes`` each, written into ``folder``
    when the result is read (write that result, to have each file once), from the rows of
    ``with_revisits``. ``date`` is that of all records, by default now."""
    ship(pages.sparkSession)
    when = (date or datetime.datetime.now(datetime.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        name, held, lines, at = uuid.uuid4().hex, [], [], 0

        def close() -> pd.DataFrame:
            data = zip_stored([(WARC, b"".join(held)), (INDEX, "\n".join(lines).encode())])
            with store.open_output_stream(f"{path}/{name}.zip") as out:
                out.write(data)
            return pd.DataFrame({"path": [f"{name}.zip"], "bytes": [len(data)]})

        for batch in batches:
            for i, url, payload, again, to, to_url, key, single in zip(*(batch[c] for c in ("id", "url", "payload", "revisit", "refers_to", "to_url", "copy_key", "single")), strict=True):
                i, to = (None if pd.isna(x) else int(x) for x in (i, to))
                # the one response of a group of copies has an id that its revisits know
                shared = urn(f"payload:{key}") if key and single else None
                page = Record(i, url, bytes(payload), bool(again), to, to_url, shared)
                data = gzip.compress(record(page, shared if shared and not again else urn(f"{name}:{len(lines)}"), when), PACKING, mtime=0)
                lines.append(f"{'' if i is None else i} {at} {len(data)}")
                held.append(data)
                at += len(data)
                if at >= package_bytes:
                    yield close()
                    name, held, lines, at = uuid.uuid4().hex, [], [], 0
        if held:
            yield close()

    whole = lambda c: F.col(c).cast("decimal(20,0)").alias(c)  # noqa: E731  exact among nulls
    source = pages.select(whole("id"), "url", "payload", "revisit", whole("refers_to"), "to_url", "copy_key", F.coalesce("single", F.lit(False)).alias("single"))
    return source.mapInPandas(run, "path string, bytes long")


def read_package(store: fs.FileSystem, path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head fields and body of every record that the index of a package names, read range by range."""
    with store.open_input_file(path) as file:

        def read(at: int, n: int) -> bytes:
            file.seek(at)
            return file.read(n)

        members = zip_members(read, file.size())
        begin, _ = members[WARC]
        for line in read(*members[INDEX]).decode().splitlines():
            _, at, length = line.rsplit(" ", 2)
            head, _, body = gzip.decompress(read(begin + int(at), int(length))).partition(b"\r\n\r\n")
            field = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield field, body[: int(field["Content-Length"])]


def read_packages(packed: DataFrame, folder: str) -> DataFrame:
    """``id, url, payload_bytes, payload_digest, record_type, refers_to`` a record of the
    packages of ``folder`` that ``packed`` lists. The digest of a response is taken of the
    payload as read and held against its head."""
    ship(packed.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = filesystem(folder)
        for batch in batches:
            for name in batch["path"]:
                rows = []
                for field, body in read_package(store, f"{root}/{name}"):
                    kind, digest, size = field["WARC-Type"], field["WARC-Payload-Digest"].removeprefix("sha1:"), int(field["X-Payload-Length"])
                    if kind == "response" and (len(body), hashlib.sha1(body).hexdigest()) != (size, digest):
                        raise ValueError(f"record {field['WARC-Record-ID']} does not match its digest")
                    rows.append((field["X-Page-Id"] or None, field["WARC-Target-URI"], size, digest, kind, field.get("X-Refers-To")))
                yield pd.DataFrame(rows, columns=["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # a listed package is a few bytes and much work: deal them out, a few to a task
    number = packed.count()
    dealt = packed.select("path").repartition(max(1, min(number, max(packed.sparkSession.sparkContext.defaultParallelism, number // 16))))
    got = dealt.mapInPandas(run, "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return got.withColumns({"id": F.col("id").cast("long"), "refers_to": F.col("refers_to").cast("long")})


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """``id, url, payload, revisit`` a page, with ``refers_to, to_url, copy_key, single`` where it has copies."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    large = rows.filter(F.length("payload") >= least).withColumn("copy_key", F.sha2("payload", 256))
    # only groups of copies go on: a payload of its own needs no partner
    ids = large.groupBy("copy_key", "id").agg(F.count("*").alias("times"), F.min("url").alias("url"))
    last = F.max(F.when(F.col("id").isNotNull(), F.struct("id", "times", "url")))
    copies = ids.groupBy("copy_key").agg(last.alias("last"), F.sum("times").alias("n")).filter("n > 1 and last is not null")
    joined = large.withColumnRenamed("copy_key", "_key").join(copies.withColumnRenamed("copy_key", "_key"), "_key", "left")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last.id"))
    again = lambda c: F.when(revisit, F.col(f"last.{c}"))
    found = joined.select("id", "url", "payload", revisit.alias("revisit"), again("id").alias("refers_to"), again("url").alias("to_url"), F.when(F.col("last").isNotNull(), F.col("_key")).alias("copy_key"), (F.col("last.times") == 1).alias("single"))
    return found.unionByName(rows.filter(F.length("payload") < least).withColumn("revisit", F.lit(False)), allowMissingColumns=True)


def archive(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, **columns) -> DataFrame:
    """Write ``pages`` as packages into ``folder``; their list, ``path, bytes``. A folder that can't be
    reached fails before any work."""
    store, path = filesystem(folder)
    store.create_dir(path, recursive=True)
    return materialise(packages(with_revisits(pages, **columns), folder, package_bytes), "packages")


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    packed = archive(table(spark, sf_dir, "pages"), folder)
    return read_packages(packed, folder).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
