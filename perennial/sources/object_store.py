"""Object stores as Spark data sources: tasks list the objects and write them.

A listing's partitions are prefixes. The driver knows the prefixes, never the
objects; each task walks one prefix and sends its entries in Arrow batches.
The writer stores each row as one object, so that images and their label
documents can be kept in the layout that the readers expect.
"""

from __future__ import annotations

import fnmatch
import json
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

LISTING = "path string, length bigint, modificationTime timestamp"
# Entries sent together.
BATCH = 10_000
# Bytes of contents sent together.
READ_BYTES = 16_000_000
_ARROW = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC"))])


def local_path(uri: str) -> str | None:
    """The path of a local or mounted file system; None for other stores."""
    found = re.match(r"(?:file:(?://)?)?(/.*)", uri)
    return found.group(1) if found else None


def _hidden(name: str) -> bool:
    """Spark's readers leave these names out, and so do listings."""
    return name.startswith(("_", "."))


def _entries(folder: str) -> Iterator[tuple[str, bool, int, float]]:
    """``name, is a folder, bytes, modified`` of what lies in a folder; none if there is no such folder."""
    local = local_path(folder)
    if local is not None:
        if os.path.isdir(local):
            with os.scandir(local) as found:
                for entry in found:
                    told = entry.stat()
                    yield entry.name, entry.is_dir(), told.st_size, told.st_mtime
        return
    store, path = arrow_fs.FileSystem.from_uri(folder)
    for info in store.get_file_info(arrow_fs.FileSelector(path, allow_not_found=True)):
        modified = info.mtime.timestamp() if info.mtime else 0.0
        yield info.base_name, info.type == arrow_fs.FileType.Directory, info.size or 0, modified


def walk(folder: str, first: str, name_filter: str | None) -> Iterator[tuple[str, int, float]]:
    """Objects below the entries of a folder that ``first`` matches, one folder's entries at a time."""
    waiting = [(folder, first)]
    while waiting:
        at, wanted = waiting.pop()
        for name, is_folder, length, modified in _entries(at):
            if _hidden(name) or not fnmatch.fnmatchcase(name, wanted):
                continue
            if is_folder:
                waiting.append((f"{at}/{name}", "*"))
            elif name_filter is None or fnmatch.fnmatchcase(name, name_filter):
                yield f"{at}/{name}", length, modified


class Prefix(InputPartition):
    def __init__(self, folder: str, first: str):
        self.folder, self.first = folder, first


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.prefixes = json.loads(options["prefixes"])
        self.name_filter = options.get("namefilter") or options.get("nameFilter")

    def partitions(self) -> list[InputPartition]:
        return [Prefix(folder, first) for folder, first in self.prefixes] or [Prefix("", "")]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int, float]] = []
        for row in walk(partition.folder, partition.first, self.name_filter) if partition.folder else ():
            rows.append(row)
            if len(rows) == BATCH:
                yield self._batch(rows)
                rows = []
        yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple[str, int, float]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([path for path, _, _ in rows], pa.string()),
                pa.array([length for _, length, _ in rows], pa.int64()),
                pa.array([int(at * 1_000_000) for _, _, at in rows], _ARROW.field(2).type),
            ],
            schema=_ARROW,
        )


class ObjectWriter(DataSourceWriter):
    """Each row's ``content`` becomes the object ``path`` below the root; an object of that name is replaced whole."""

    def __init__(self, root: str):
        self.root = root

    def write(self, rows) -> WriterCommitMessage:
        local = local_path(self.root)
        store, base = (None, local) if local is not None else arrow_fs.FileSystem.from_uri(self.root)
        made: set[str] = set()
        for row in rows:
            target = f"{base}/{row.path}"
            folder = target.rsplit("/", 1)[0]
            if store is not None:
                with store.open_output_stream(target) as out:
                    out.write(bytes(row.content))
                continue
            if folder not in made:
                os.makedirs(folder, exist_ok=True)
                made.add(folder)
            # readers see a whole object or none, also when a task is retried
            part = f"{folder}/.{uuid.uuid4().hex}"
            with open(part, "wb") as out:
                out.write(bytes(row.content))
            os.replace(part, target)
        return WriterCommitMessage()


class ObjectStore(DataSource):
    """``objects``: reads listings of prefixes, writes rows ``(path, content)`` as objects."""

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema: StructType) -> DataSourceReader:
        return ListingReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ObjectWriter(self.options["root"].rstrip("/"))


def _alternatives(pattern: str) -> list[str]:
    """A glob's ``{a,b}`` parts written out."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    start, end = found.span()
    return [p for choice in found.group(1).split(",") for p in _alternatives(pattern[:start] + choice + pattern[end:])]


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that a glob matches. The file system of the pattern is asked on the driver."""
    if not re.search(r"[*?\[]", pattern):
        return [pattern]
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or () if status.isDirectory()]


def list_below(spark: SparkSession, pattern: str, name_filter: str | None = None) -> DataFrame:
    """Objects that a glob matches, or that lie below a folder it matches: ``path, length, modificationTime``.

    The driver resolves the glob's folders but for its last part; each of them
    is one prefix, whose entries a task compares with the last part and walks.
    Names that begin with ``_`` or ``.`` are left out. Nothing matched gives no
    rows. A single folder is listed by one task, however many objects it has.
    """
    spark.dataSource.register(ObjectStore)
    prefixes = []
    for one in _alternatives(pattern.rstrip("/")):
        parent, last = one.rsplit("/", 1)
        prefixes += [(folder, last) for folder in _folders(spark, parent)]
    reader = spark.read.format("objects").option("prefixes", json.dumps(prefixes))
    return (reader.option("nameFilter", name_filter) if name_filter else reader).load()


def contents(listed: DataFrame) -> DataFrame:
    """The bytes of objects of any size that a listing names: ``path, content``.

    Paths are dealt out by hash, so that one folder's objects are read by many
    tasks, each of which reads many.
    """
    spark = listed.sparkSession
    dealt = listed.select("path").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for path in batch.column(0).to_pylist():
                content = _content(path)
                rows.append((path, content))
                size += len(content)
                if size > READ_BYTES:
                    yield _read_batch(rows)
                    rows, size = [], 0
            yield _read_batch(rows)

    return dealt.mapInArrow(read, "path string, content binary")


def _content(uri: str) -> bytes:
    local = local_path(uri)
    if local is not None:
        with open(local, "rb") as stored:
            return stored.read()
    store, path = arrow_fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as stored:
        return stored.read()


def _read_batch(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([path for path, _ in rows], pa.string()), pa.array([content for _, content in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["path", "content"])


def write_objects(rows: DataFrame, root: str) -> None:
    """Store rows ``(path, content)`` as objects below ``root``; a retried task writes the same objects again."""
    rows.sparkSession.dataSource.register(ObjectStore)
    stored = rows.selectExpr("path", "cast(content as binary) as content")
    stored.write.format("objects").mode("append").option("root", root).save()
