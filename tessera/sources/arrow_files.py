"""Arrow IPC files as a Spark data source: read, written and streamed in record batches.

A folder holds files `<name>.arrow` and beside each `<name>.stats`, with the rows of each of its batches and, for columns of
numbers, texts and booleans, their least and greatest value and number of nulls. A read plans from these and from
the files' footers: a partition is a range of a file's batches, and batches that a pushed filter excludes are in no
partition. Files without a .stats file are read whole, in ranges of batches. A task opens one file and reads the
batches of its range, one at a time.

A writing task puts one file under a name of its own that readers pass over; the driver's commit gives the files of
the tasks that succeeded their names, so a task that ran twice leaves one file. Names begin with the time of the commit: a
stream's offset is the last name that it has seen, and a restarted stream goes on behind it.

Paths are local, for which all machines must share the folder, or URIs of a store that pyarrow knows.

Defined results: a folder without files has no schema and raises unless one is given; files of one folder have one
schema; an empty frame is written as files without batches; null and NaN are never excluded by a filter that Spark
would let pass, as Spark applies every filter again.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

NAME = "arrow_files"
#: Rows of a partition, about; longest text that is kept as a bound.
ROWS, TEXT = 1_000_000, 100


def _at(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return pa.fs.LocalFileSystem(), path


def _files(path: str) -> list[str]:
    """Names of the committed files, in their order."""
    fs, at = _at(path)
    found = fs.get_file_info(pa.fs.FileSelector(at, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.endswith(".arrow") and not f.base_name.startswith(("_", ".")))


def statistics(batch: pa.RecordBatch) -> dict:
    """{"rows": n, "columns": {name: [least, greatest, nulls]}} of a batch, for columns that have bounds."""
    columns = {}
    for name, column in zip(batch.schema.names, batch.columns):
        kind = column.type
        if not (pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_string(kind) or pa.types.is_boolean(kind)):
            continue
        if pa.types.is_floating(kind) and pc.any(pc.is_nan(column)).as_py():
            continue
        ends = pc.min_max(column).as_py()
        lo, hi = ends["min"], ends["max"]
        if isinstance(lo, float) and (math.isinf(lo) or math.isinf(hi)) or isinstance(lo, str) and max(len(lo), len(hi)) > TEXT:
            continue
        columns[name] = [lo, hi, column.null_count]
    return {"rows": batch.num_rows, "columns": columns}


def may_hold(stats: dict, f: Filter) -> bool:
    """Whether a batch with these statistics can have a row that passes a filter."""
    known = stats["columns"].get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
    if known is None:
        return True
    lo, hi, nulls = known
    if isinstance(f, IsNull):
        return nulls > 0
    if isinstance(f, IsNotNull):
        return nulls < stats["rows"]
    values = f.value if isinstance(f, In) else [getattr(f, "value", None)]
    if lo is None:  # nulls alone
        return not isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual))
    try:
        if isinstance(f, (EqualTo, In)):
            return any(v is not None and lo <= v <= hi for v in values)
        if isinstance(f, GreaterThan):
            return hi > f.value
        if isinstance(f, GreaterThanOrEqual):
            return hi >= f.value
        if isinstance(f, LessThan):
            return lo < f.value
        if isinstance(f, LessThanOrEqual):
            return lo <= f.value
    except TypeError:
        return True
    return True


@dataclass
class Range(InputPartition):
    """Batches of a file, by number."""

    file: str
    batches: tuple[int, ...]


def plan(path: str, files: list[str], filters: list[Filter], rows: int) -> list[Range]:
    """Ranges of the batches that may hold rows that pass, of about `rows` rows each."""
    fs, at = _at(path)
    out = []
    for name in files:
        try:
            with fs.open_input_stream(f"{at}/{name.removesuffix('.arrow')}.stats") as f:
                stats = json.loads(f.read())
        except FileNotFoundError:
            with fs.open_input_file(f"{at}/{name}") as f, pa.ipc.open_file(f) as reader:  # the footer alone
                stats = [{"rows": rows, "columns": {}}] * reader.num_record_batches
        held, size = [], 0
        for k, s in enumerate(stats):
            if not all(may_hold(s, f) for f in filters):
                continue
            held.append(k)
            size += s["rows"]
            if size >= rows:
                out.append(Range(name, tuple(held)))
                held, size = [], 0
        if held:
            out.append(Range(name, tuple(held)))
    return out


def _batches(path: str, part: Range) -> Iterator[pa.RecordBatch]:
    if not part.batches:
        return
    fs, at = _at(path)
    with fs.open_input_file(f"{at}/{part.file}") as f, pa.ipc.open_file(f) as reader:
        for k in part.batches:
            yield reader.get_batch(k)


class _Reader(DataSourceReader):
    def __init__(self, path: str, rows: int):
        self.path, self.rows, self.filters = path, rows, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps them for planning; Spark applies them to the rows of the batches that are left."""
        self.filters = list(filters)
        yield from filters

    def partitions(self) -> list[Range]:
        return plan(self.path, _files(self.path), self.filters, self.rows) or [Range("", ())]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from _batches(self.path, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are names of files: all up to the name have been read."""

    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows

    def initialOffset(self) -> dict:
        return {"file": ""}

    def latestOffset(self) -> dict:
        return {"file": max(_files(self.path), default="")}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        new = [f for f in _files(self.path) if start["file"] < f <= end["file"]]
        return plan(self.path, new, [], self.rows)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from _batches(self.path, partition)


@dataclass
class _Written(WriterCommitMessage):
    name: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.before = _files(path) if overwrite else []

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, at = _at(self.path)
        fs.create_dir(at, recursive=True)
        name, stats, writer = f"_{uuid.uuid4().hex}", [], None
        with fs.open_output_stream(f"{at}/{name}.arrow") as f:
            for batch in iterator:
                if writer is None:
                    writer = pa.ipc.new_file(f, batch.schema)
                if batch.num_rows:
                    writer.write_batch(batch)
                    stats.append(statistics(batch))
            if writer is not None:
                writer.close()
        if writer is None:  # a task without a batch has no schema to write
            fs.delete_file(f"{at}/{name}.arrow")
            return _Written("")
        with fs.open_output_stream(f"{at}/{name}.stats") as f:
            f.write(json.dumps(stats).encode())
        return _Written(name)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, at = _at(self.path)
        now = f"{time.time_ns():020d}"
        for m in messages:
            if m is not None and m.name:
                for kind in ("stats", "arrow"):  # a file is there once its statistics are
                    fs.move(f"{at}/{m.name}.{kind}", f"{at}/{now}{m.name}.{kind}")
        for name in self.before:
            for kind in ("arrow", "stats"):
                if fs.get_file_info(old := f"{at}/{name.removesuffix('.arrow')}.{kind}").type != pa.fs.FileType.NotFound:
                    fs.delete_file(old)

    def abort(self, messages: list[_Written | None]) -> None:
        fs, at = _at(self.path)
        for m in messages:
            if m is not None and m.name:
                for kind in ("stats", "arrow"):
                    fs.delete_file(f"{at}/{m.name}.{kind}")


class ArrowFiles(DataSource):
    """Options: path; rows, of a partition."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _path(self) -> str:
        return self.options["path"].rstrip("/")

    def _rows(self) -> int:
        return int(self.options.get("rows", ROWS))

    def schema(self) -> StructType:
        files = _files(self._path())
        if not files:
            raise ValueError(f"no Arrow files in {self._path()}: give a schema")
        fs, at = _at(self._path())
        with fs.open_input_file(f"{at}/{files[0]}") as f, pa.ipc.open_file(f) as reader:
            return from_arrow_schema(reader.schema, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self._path(), self._rows())

    def streamReader(self, schema: StructType) -> _StreamReader:
        return _StreamReader(self._path(), self._rows())

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self._path(), schema, overwrite)


def _ready(spark: SparkSession) -> None:
    spark.dataSource.register(ArrowFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, rows: int = ROWS, schema: StructType | str | None = None) -> DataFrame:
    """The rows of a folder of Arrow files, in partitions of about `rows` rows."""
    _ready(spark)
    reader = spark.read.format(NAME).option("rows", rows)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_stream(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The files of a folder as a stream, each once, in the order of their names."""
    _ready(spark)
    reader = spark.readStream.format(NAME)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write(df: DataFrame, path: str, mode: str = "append") -> None:
    """df as Arrow files, one a task; its record batches are those that Spark hands to Python."""
    _ready(df.sparkSession)
    df.write.format(NAME).mode(mode).save(path)
