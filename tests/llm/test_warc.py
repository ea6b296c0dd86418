import gzip
import hashlib
import io
import random
import zipfile

import pytest
from loomcat.llm import warc
from pyspark.sql import functions as F


@pytest.mark.parametrize("wide", [False, True])
def test_packages_are_zip_files(wide):
    members = [("archive/data.warc", b"abc" * 100), ("indexes/index.cdx", b""), ("ünï", b"x")]
    data = warc.zip_stored(members, zip64=wide)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == members
    for raw in (data, data[:-2] + b"\x03\x00end"):  # a comment after the end record
        found = warc.zip_members(lambda at, n: raw[at : at + n], len(raw))
        assert {k: raw[a : a + n] for k, (a, n) in found.items()} == dict(members)


def test_reads_what_zipfile_writes_and_skips_packed_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"stored" * 10)
        z.writestr("b", b"packed" * 10, compress_type=zipfile.ZIP_DEFLATED)
    raw = out.getvalue()
    found = warc.zip_members(lambda at, n: raw[at : at + n], len(raw))
    assert list(found) == ["a"] and raw[found["a"][0] : sum(found["a"])] == b"stored" * 10
    with pytest.raises(ValueError, match="no end"):
        warc.zip_members(lambda at, n: b"junk"[at : at + n], 4)


def test_round_trip_and_revisits(spark, tmp_path):
    large, other = "a" * 1000, "é" * 600
    pages = [(1, "u 1", large), (5, None, large), (3, "u\r\n3", large), (2, "u", other), (9, "u", other), (4, "u", "small"), (6, "u", "small"), (7, "u", None), (8, "u", ""), (10, "u", "z" * 999), (11, "u", "z" * 999), (None, "u", large), (12, "u", "\r\n\r\n" * 400), (5, "v", large)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, _key string")
    folder = f"file://{tmp_path}/archive"
    packed = warc.archive(df, folder, package_bytes=1500)
    got = sorted(map(tuple, warc.read_packages(packed, folder).select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    last = {}
    for i, _, h in pages:
        if h and len(h.encode()) >= 1000 and i is not None:
            last[h] = max(last.get(h, i), i)
    wanted = []
    for i, _, h in pages:
        data = (h or "").encode()
        again = h in last and i != last[h]
        wanted.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last[h] if again else None))
    assert got == sorted(wanted, key=str)
    assert packed.agg(F.count("*")).first()[0] > 1
    none = f"file://{tmp_path}/none"
    assert warc.read_packages(warc.archive(df.limit(0), none), none).count() == 0

    # the files by themselves, as another reader sees them
    heads = []
    for r in packed.collect():
        with zipfile.ZipFile(tmp_path / "archive" / r.path) as z:
            assert z.testzip() is None and r.bytes == (tmp_path / "archive" / r.path).stat().st_size
            data = z.read(warc.WARC)
            for line in z.read(warc.INDEX).decode().splitlines():
                _, at, n = line.rsplit(" ", 2)
                head = gzip.decompress(data[int(at) : int(at) + int(n)]).split(b"\r\n\r\n")[0].decode()
                heads.append(dict(x.split(": ", 1) for x in head.split("\r\n")[1:]))
    assert len(heads) == len(pages) == len({h["WARC-Record-ID"] for h in heads})
    responses = {h["WARC-Record-ID"]: h for h in heads if h["WARC-Type"] == "response"}
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    known = [h for h in revisits if "WARC-Refers-To" in h]
    for h in known:
        to = responses[h["WARC-Refers-To"]]
        assert (to["WARC-Payload-Digest"], to["WARC-Target-URI"], to["WARC-Date"]) == (h["WARC-Payload-Digest"], h["WARC-Refers-To-Target-URI"], h["WARC-Refers-To-Date"])
    assert len(revisits) == 4 and len(known) == 1  # the rows of id 5 repeat, so none of them is "the" response


def test_addresses_of_stores():

    assert warc.store_address("file:/a/b") == warc.store_address("file:///a/b") == warc.store_address("/a/b") == "/a/b"
    assert warc.store_address("s3a://bucket/a") == "s3://bucket/a" and warc.store_address("hdfs://host:1/a") == "hdfs://host:1/a"
    with pytest.raises(ValueError, match="no store"):
        warc.store_address("ftp://host/a")


def test_a_very_long_page(spark, tmp_path):
    noise = "".join(chr(random.Random(k).randrange(32, 50_000)) for k in range(1, 3000))
    long = noise * 1500
    pages = spark.createDataFrame([(1, "u", long, "x", 1), (2, "u", long, "y", 2), (3, None, None, "z", 3)], "page_id long, url string, html string, payload string, id long")
    packed = warc.archive(pages, f"file://{tmp_path}/long", package_bytes=1000)
    got = sorted(warc.read_packages(packed, f"file://{tmp_path}/long").drop("url").collect())
    size, digest = len(long.encode()), hashlib.sha1(long.encode()).hexdigest()
    assert [tuple(r) for r in got[:2]] == [(1, size, digest, "revisit", 2), (2, size, digest, "response", None)]


def test_only_ranges_are_read(tmp_path):
    """A record is found without reading the others."""
    from pyarrow import fs

    noise = random.Random(1).randbytes
    records = [gzip.compress(warc.record(warc.Record(k, "u", noise(100_000), False), warc.urn(str(k)), "2020-01-01T00:00:00Z")) for k in range(50)]
    lines, at = [], 0
    for k, r in enumerate(records):
        lines.append(f"{k} {at} {len(r)}")
        at += len(r)
    raw = warc.zip_stored([(warc.WARC, b"".join(records)), (warc.INDEX, lines[7].encode())], zip64=True)
    (tmp_path / "a.zip").write_bytes(raw)
    got = list(warc.read_package(fs.LocalFileSystem(), f"{tmp_path}/a.zip"))
    assert [(h["X-Page-Id"], len(b)) for h, b in got] == [("7", 100_000)]
    read = []
    warc.zip_members(lambda a, n: (read.append(n), raw[a : a + n])[1], len(raw))
    assert sum(read) < 70_000
