"""Files as a Spark data source: listing in tasks, bytes of what ``binaryFile`` leaves out, and a sink of a file per row.

``binaryFile`` leaves out zero-length files and names that begin with ``_`` or ``.``. This source lists every file. The driver
looks at directories only: it opens the tree from the root, a level at a time, until there are enough directories to deal
out, and tasks list the files below them. Filters on ``extension``, ``name`` and ``length`` are pushed into the tasks where
``spark.sql.python.filterPushdown.enabled`` is set, so rejected files never become rows; with ``content`` a file is opened
only after it has passed them.

Symbolic links to directories are not followed (no loops), unless ``links`` asks for it. Stores other than the local file system are reached through
``pyarrow.fs`` by their URI.
"""

from __future__ import annotations

import os
import shutil
import uuid
from dataclasses import dataclass, field
from typing import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    In, InputPartition, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith, WriterCommitMessage)

SCHEMA = "path string, name string, extension string, length bigint, modificationTime timestamp, created timestamp"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ROWS, BYTES = 4096, 16 << 20  # of a batch


@dataclass
class Entry:
    path: str
    length: int
    modified_ms: int
    created_ms: int | None

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]

    @property
    def extension(self) -> str:
        """Lower-cased, with the dot; a leading dot alone begins no extension."""
        at = self.name.rfind(".")
        return self.name[at:].lower() if 0 < at < len(self.name) - 1 else ""


class Store:
    """The few file system calls used here, on a local path or a URI."""

    def __init__(self, root: str):
        local = root[5:] if root.startswith("file:") else root if "://" not in root else None
        if local is not None:
            self.remote, self.root, self.prefix = None, os.path.abspath("/" + local.lstrip("/") if root.startswith("file:") else local), "file:"
        else:
            self.remote, self.root = pafs.FileSystem.from_uri(root)
            self.prefix = root[:len(root) - len(self.root)] if root.endswith(self.root) else ""

    def scan(self, directory: str, links: bool = False) -> Iterator[Entry | str]:
        """The entries of a directory: files, and the paths of its directories (with ``links``, linked ones too)."""
        if self.remote is None:
            with os.scandir(directory) as found:
                for e in found:
                    if e.is_dir(follow_symlinks=links):
                        yield e.path
                    elif e.is_file():
                        s = e.stat()
                        yield Entry(e.path, s.st_size, s.st_mtime_ns // 1_000_000, s.st_ctime_ns // 1_000_000)
            return
        for e in self.remote.get_file_info(pafs.FileSelector(directory)):
            if e.type == pafs.FileType.Directory:
                yield e.path
            elif e.type == pafs.FileType.File:
                yield Entry(e.path, e.size, (e.mtime_ns or 0) // 1_000_000, None)

    def is_directory(self) -> bool:
        return os.path.isdir(self.root) if self.remote is None else self.remote.get_file_info(self.root).type == pafs.FileType.Directory

    def read(self, path: str) -> bytes:
        if self.remote is None:
            with open(path, "rb") as f:
                return f.read()
        with self.remote.open_input_stream(path) as f:
            return f.read()

    def remove(self, directory: str) -> None:
        if self.remote is None:
            shutil.rmtree(directory)
        else:
            self.remote.delete_dir(directory)

    def write(self, path: str, content: bytes) -> None:
        """Put a whole file in place at once; a retried task writes the same file again."""
        target = f"{self.root}/{path}"
        if self.remote is None:
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}.part"
            with open(part, "wb") as f:
                f.write(content)
            os.replace(part, target)
            return
        self.remote.create_dir(target.rsplit("/", 1)[0], recursive=True)
        with self.remote.open_output_stream(target) as f:  # stores show an object when it is closed
            f.write(content)


@dataclass
class Directories(InputPartition):
    """Directories of a task: (path, with all below it)."""
    found: list

    def __init__(self, found: list):
        self.found = found


def _hidden(path: str, root: str) -> bool:
    return any(part[:1] in "._" for part in path[len(root):].strip("/").split("/"))


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.options = options
        self.tests: list[tuple] = []

    def _flag(self, name: str, default: bool) -> bool:
        return str(self.options.get(name, default)).lower() == "true"

    def partitions(self) -> list[InputPartition]:
        store = Store(self.options["path"])
        if not store.is_directory():
            if self._flag("mustexist", True):
                raise FileNotFoundError(f"{self.options['path']} is not a directory")
            return [Directories([])]
        if not self._flag("recursive", True):
            return [Directories([(store.root, False)])]
        wanted = int(self.options.get("partitions", 32))
        opened, level = [], [store.root]
        while level and len(level) < wanted:
            below = [e for d in level for e in store.scan(d, self._flag("links", False)) if isinstance(e, str)]
            opened += [(d, False) for d in level]
            level = below
        work = opened + [(d, True) for d in level]
        n = min(len(work), 4 * wanted)
        return [Directories(work[i::n]) for i in range(n)]

    def _accepts(self, e: Entry) -> bool:
        for kind, column, value in self.tests:
            own = getattr(e, column)
            if not (own == value if kind == "EqualTo" else own in value if kind == "In" else own < value if kind == "LessThan"
                    else own <= value if kind == "LessThanOrEqual" else own > value if kind == "GreaterThan"
                    else own >= value if kind == "GreaterThanOrEqual" else own.endswith(value) if kind == "StringEndsWith"
                    else own.startswith(value)):
                return False
        return True

    def read(self, partition: Directories) -> Iterator[pa.RecordBatch]:
        store = Store(self.options["path"])
        hidden, content, unseen = self._flag("hidden", True), self._flag("content", False), self._flag("unseen", False)
        links = self._flag("links", False)
        rows, data, size = [], [], 0
        for top, below in partition.found:
            stack = [top]
            while stack:
                for e in store.scan(stack.pop(), links):
                    if isinstance(e, str):
                        if below:
                            stack.append(e)
                        continue
                    concealed = _hidden(e.path, store.root)
                    if (concealed and not hidden) or (unseen and not concealed and e.length) or not self._accepts(e):
                        continue
                    rows.append(e)
                    if content:
                        data.append(store.read(e.path))
                        size += len(data[-1])
                    if len(rows) == ROWS or size > BYTES:
                        yield self._batch(store, rows, data, content)
                        rows, data, size = [], [], 0
        if rows:
            yield self._batch(store, rows, data, content)

    @staticmethod
    def _batch(store: Store, rows: list[Entry], data: list[bytes], content: bool) -> pa.RecordBatch:
        stamp = pa.timestamp("us", "UTC")
        columns = {"path": pa.array([store.prefix + e.path for e in rows]), "name": pa.array([e.name for e in rows]),
                   "extension": pa.array([e.extension for e in rows]), "length": pa.array([e.length for e in rows], pa.int64()),
                   "modificationTime": pa.array([e.modified_ms * 1000 for e in rows], stamp),
                   "created": pa.array([None if e.created_ms is None else e.created_ms * 1000 for e in rows], stamp)}
        if content:
            columns["content"] = pa.array(data, pa.binary())
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


class PushdownReader(ListingReader):
    KINDS = (EqualTo, In, LessThan, LessThanOrEqual, GreaterThan, GreaterThanOrEqual, StringEndsWith, StringStartsWith)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, self.KINDS) and f.attribute in (("name",), ("extension",), ("length",)) and f.value is not None:
                self.tests.append((type(f).__name__, f.attribute[0], f.value))
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    files: int = field(default=0)


class FileWriter(DataSourceArrowWriter):
    """A file for each row ``(path, content)``, at ``path`` below the root."""

    def __init__(self, options):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, n = Store(self.options["path"]), 0
        for batch in iterator:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                if not path or path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"not a path below the root: {path!r}")
                store.write(path, content.as_py() or b"")
                n += 1
        return Written(n)


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessera_files"

    def schema(self) -> str:
        return SCHEMA + (", content binary" if str(self.options.get("content", "")).lower() == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return (PushdownReader if str(self.options.get("pushdown", "")).lower() == "true" else ListingReader)(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("files are added to a folder; use mode('append')")
        return FileWriter(self.options)


def every_file(spark: SparkSession, root: str, recursive: bool = True, content: bool = False, unseen: bool = False, hidden: bool = True,
               must_exist: bool = True, links: bool = False) -> DataFrame:
    """All files of a directory tree, zero-length and hidden ones included; ``unseen`` for only those that ``binaryFile`` leaves
    out. Columns as in ``SCHEMA``, and the bytes with ``content``."""
    spark.dataSource.register(Files)
    options = {"recursive": recursive, "content": content, "unseen": unseen, "hidden": hidden, "mustexist": must_exist, "links": links,
               "pushdown": spark.conf.get(PUSHDOWN, "false"), "partitions": spark.sparkContext.defaultParallelism}
    return spark.read.format("tessera_files").options(**{k: str(v).lower() for k, v in options.items()}).load(root)


def more_files(root: str, than: int) -> bool:
    """Whether a tree has more than so many files; looks no further."""
    store, n = Store(root), 0
    stack = [store.root] if store.is_directory() else []
    while stack:
        for e in store.scan(stack.pop(), links=True):
            if isinstance(e, str):
                stack.append(e)
            else:
                n += 1
                if n > than:
                    return True
    return False


def file_content(root: str, path) -> Column:
    """The bytes of the file at a ``path`` as listed below ``root``, opened in the task that has the row; null for a null path.
    What is read goes on in batches of ``BYTES``."""

    @F.arrow_udf("binary")
    def _read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store = Store(root)
        for batch in batches:
            data, size = [], 0
            for p in batch:
                data.append(None if not p.is_valid else store.read(p.as_py()[len(store.prefix):]))
                size += len(data[-1] or b"")
                if len(data) == ROWS or size > BYTES:
                    yield pa.array(data, pa.binary())
                    data, size = [], 0
            yield pa.array(data, pa.binary())

    return _read(path)


def deal(files: DataFrame) -> DataFrame:
    """Listed files dealt evenly over the tasks that are to open them; only their rows are moved, no bytes. A listing has a task
    for each directory at most, whatever the number of its files."""
    return files.repartition(4 * files.sparkSession.sparkContext.defaultParallelism)


def write_files(rows: DataFrame, root: str) -> None:
    """Write ``(path, content)`` rows as files below ``root``, in tasks. Paths are relative; of rows of one path one stays."""
    rows.sparkSession.dataSource.register(Files)
    rows.selectExpr("cast(path as string) as path", "cast(content as binary) as content").write.format("tessera_files").mode("append").save(root)
