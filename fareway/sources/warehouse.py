"""A warehouse table as a Spark data source with two-phase commit.

``df.write.format("fareway_warehouse").option("path", ...).mode("append" or
"overwrite").save()``. Tasks write parquet files to a staging folder of their
job and report what they wrote. The driver then commits: it moves the reported
files to the table and replaces its manifest, the list of files that are the
table, in one step. Files of lost or repeated tasks are in no report and go with the staging
folder; an aborted write removes it and leaves the table as it was. An overwrite
removes the former files once the new manifest is in place.

The folder must be one that all machines reach (a mounted path, or a URI that
Arrow's file systems open). Only file names pass the driver. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "fareway_warehouse"
ROWS_PER_GROUP = 200_000


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    fs, root = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return fs, root.rstrip("/")


def _manifest(fs: pafs.FileSystem, root: str) -> list[str]:
    """Files of the table, in the order they were committed; none before the first commit."""
    if fs.get_file_info(f"{root}/manifest.json").type == pafs.FileType.NotFound:
        return []
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        return json.loads(f.read())["files"]


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class TwoPhaseWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool) -> None:
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.path)
        schema = to_arrow_schema(self.schema)
        name, rows, out = f"part-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if batch.num_rows and out is None:
                    fs.create_dir(f"{root}/_staging-{self.job}", recursive=True)
                    out = pq.ParquetWriter(f"{root}/_staging-{self.job}/{name}", schema, filesystem=fs, compression="zstd")
                if batch.num_rows:
                    out.write_table(pa.Table.from_batches([batch]).cast(schema), row_group_size=ROWS_PER_GROUP)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        new = sorted(m.file for m in messages if m is not None and m.file)
        before = _manifest(fs, root)
        fs.create_dir(f"{root}/data", recursive=True)
        for name in new:
            fs.move(f"{root}/_staging-{self.job}/{name}", f"{root}/data/{name}")
        files = [f"data/{name}" for name in new]
        draft = f"{root}/_manifest-{self.job}.json"
        with fs.open_output_stream(draft) as f:
            f.write(json.dumps({"files": files if self.overwrite else before + files, "schema": self.schema.json()}).encode())
        fs.move(draft, f"{root}/manifest.json")  # from here on the new files are the table
        self._clear(fs, root)
        if self.overwrite:
            for name in before:
                fs.delete_file(f"{root}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        moved = [m.file for m in messages or [] if m is not None and m.file]
        committed = set(_manifest(fs, root))
        for name in moved:
            if f"data/{name}" not in committed and fs.get_file_info(f"{root}/data/{name}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{root}/data/{name}")
        self._clear(fs, root)

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        if fs.get_file_info(f"{root}/_staging-{self.job}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/_staging-{self.job}")


class Warehouse(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> TwoPhaseWriter:
        return TwoPhaseWriter(self.options["path"], schema, overwrite)


def write(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.sparkSession.dataSource.register(Warehouse)
    df.write.format(FORMAT).option("path", path).mode(mode).save()
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The committed table, read by Spark's own parquet reader."""
    fs, root = _open(path)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        state = json.loads(f.read())
    schema = StructType.fromJson(json.loads(state["schema"]))
    if not state["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{name}" for name in state["files"]])
