"""A sink that publishes a table whole or not at all, and tells how many rows each gate held back.

It is a data source writer: tasks write Parquet files under names of their own, and the commit
on the driver publishes one manifest that names the files of all tasks. A reader takes the
newest manifest, so at any moment it sees the old table or the new one; files of lost, repeated or
failed tasks are in no manifest. Rows are judged and written in one pass over the input.

One writer at a time; of two that publish at once, the later name counts. What a table's older
manifests name stays readable until ``forget``.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import RecordBatch, Table, fs, parquet
from pyarrow import compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..shipping import ship

FORMAT = "loomcat_gated"
GATE = "_gate"
#: What Hadoop calls a store, and what pyarrow does.
STORES = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss"}


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and its path there."""
    scheme, sep, rest = folder.partition(":")
    if folder.startswith("/") or not sep:
        return fs.LocalFileSystem(), folder
    if scheme not in STORES:
        raise ValueError(f"{folder} is in no store of {', '.join(STORES)}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{STORES[scheme]}:{rest}")


def _put(store: fs.FileSystem, path: str, value: dict) -> None:
    """A file that is there whole or not at all."""
    new = f"{path}.{uuid.uuid4().hex}.new"
    with store.open_output_stream(new) as out:
        out.write(json.dumps(value).encode())
    store.move(new, path)


def _names(store: fs.FileSystem, folder: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(x.path for x in found if x.path.endswith(".json"))


def _get(store: fs.FileSystem, path: str) -> dict:
    with store.open_input_stream(path) as file:
        return json.loads(file.read())


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int
    gates: dict[str, int] = field(default_factory=dict)


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, run: str):
        self.folder, self.run = folder, run

    def write(self, iterator: Iterator[RecordBatch]) -> Written:
        store, root = store_of(self.folder)
        name, held, rows, gates = f"data/{self.run}-{uuid.uuid4().hex}.parquet", None, 0, Counter()
        try:
            for batch in iterator:
                table = Table.from_batches([batch])
                gate = table.column(GATE)
                gates.update(x for x in gate.to_pylist() if x is not None)
                good = table.filter(pc.is_null(gate)).drop_columns([GATE])
                if good.num_rows:
                    if held is None:
                        store.create_dir(f"{root}/data", recursive=True)
                        held = parquet.ParquetWriter(store.open_output_stream(f"{root}/{name}"), good.schema)
                    held.write_table(good)
                    rows += good.num_rows
        finally:
            if held is not None:
                held.close()
        return Written(name if held is not None else None, rows, dict(gates))

    def commit(self, messages: list[Written | None]) -> None:
        store, root = store_of(self.folder)
        done = [m for m in messages if m is not None]
        gates: Counter = Counter()
        for m in done:
            gates.update(m.gates)
        files, rows = [m.file for m in done if m.file], sum(m.rows for m in done)
        for folder in ("manifests", "runs"):
            store.create_dir(f"{root}/{folder}", recursive=True)
        if files:
            known = _names(store, f"{root}/manifests")
            number = int(known[-1].rsplit("/", 1)[1].split("-")[0]) + 1 if known else 1
            _put(store, f"{root}/manifests/{number:012d}-{self.run}.json", {"files": files, "rows": rows})
        _put(store, f"{root}/runs/{self.run}.json", {"gates": dict(gates), "rows": rows, "published": bool(files)})

    def abort(self, messages: list[Written | None]) -> None:
        store, root = store_of(self.folder)
        for m in messages:
            if m is not None and m.file:
                store.delete_file(f"{root}/{m.file}")


class GatedSink(DataSource):
    """Options: ``path``, the table's folder, and ``run``, a name for this write. Rows whose ``_gate`` is not null are counted, not written."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options["run"])


def write_gated(df: DataFrame, path: str, gates: dict[str, Column]) -> DataFrame:
    """Publish the rows that pass all ``gates`` as the table ``path``; ``gate, rejected`` counts those that
    fail, by the first gate. If no row passes, nothing is published and the old table stays."""
    spark = df.sparkSession
    store_of(path)  # an address that can't be reached fails before any work
    ship(spark)
    spark.dataSource.register(GatedSink)
    failed = F.get(F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in gates.items()])), 0)
    run = uuid.uuid4().hex
    df.withColumn(GATE, failed.cast("string")).write.format(FORMAT).mode("append").option("path", path).option("run", run).save()
    store, root = store_of(path)
    counts = _get(store, f"{root}/runs/{run}.json")["gates"]  # one number a gate
    return spark.createDataFrame([(name, counts[name]) for name in gates if name in counts], "gate string, rejected long")


def published(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is published now; an error if it never was."""
    store, root = store_of(path)
    known = _names(store, f"{root}/manifests")
    if not known:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(*[f"{path.rstrip('/')}/{name}" for name in _get(store, known[-1])["files"]])


def forget(path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` manifests, and data files that none of these names. Not while a write is under way."""
    store, root = store_of(path)
    known = _names(store, f"{root}/manifests")
    for old in known[:-keep]:
        store.delete_file(old)
    named = {f for m in known[-keep:] for f in _get(store, m)["files"]}
    for info in store.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True)):
        if f"data/{info.path.rsplit('/', 1)[1]}" not in named:
            store.delete_file(info.path)
