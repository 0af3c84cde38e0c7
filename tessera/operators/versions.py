"""Versioned tables: Parquet folders that are never changed, and a log of versions that say which of them make up the table.

Spark writes each commit's rows into a folder of its own. A version is then published by creating the next file of the log, which
either succeeds whole or fails because someone else was first; the loser takes the new version as its base and tries the next
number. Readers take one version and its folders, so an append, a reset or a compaction never touches what they read.

- Commits are idempotent by their name: one that is already in the table is not made again.
- A reset publishes an empty version; older versions stay readable until ``vacuum``.
- A compaction replaces the folders that it read by one; folders that others have added meanwhile stay. If one of its folders
  is gone from the newest version (a reset or another compaction came first), it gives way and nothing changes.
- A lost task or a broken-off commit leaves at most a folder that no version names, which ``vacuum`` removes.

The log holds a small file a version (folder names, not rows). Exclusive creation is a hard link on a local or mounted file
system, and a rename without overwrite by Hadoop's ``FileContext`` elsewhere (atomic on HDFS and ABFS; a store without an atomic
rename needs one writer at a time).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.listing import Entry, Store


@dataclass
class Version:
    number: int
    operation: str
    folders: list[str]
    absorbed: list[str] = field(default_factory=list)  # commits whose folders a compaction has replaced
    at: float = 0.0


class VersionedTable:
    """A table of ``schema`` (DDL) below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    # ------------------------------------------------------------ log

    def _log(self) -> Store:
        return Store(f"{self.path}/log")

    def versions(self) -> list[int]:
        log = self._log()
        if not log.is_directory():
            return []
        names = [e.name for e in log.scan(log.root) if isinstance(e, Entry)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """The given version, or the newest; version -1 is the table before its first commit."""
        known = self.versions()
        if number is None:
            number = known[-1] if known else -1
        if number == -1:
            return Version(-1, "none", [])
        if number not in known:
            raise ValueError(f"no version {number} of {self.path}")
        log = self._log()
        return Version(**json.loads(log.read(f"{log.root}/{number:020d}.json")))

    def _publish(self, v: Version) -> bool:
        """Create the log file of the version; False if it is there already."""
        log = self._log()
        v.at = time.time()
        body, name = json.dumps(v.__dict__).encode(), f"{v.number:020d}.json"
        part = f".{uuid.uuid4().hex}.part"
        log.write(part, body)
        if log.remote is None:
            try:
                os.link(f"{log.root}/{part}", f"{log.root}/{name}")
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(f"{log.root}/{part}")
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        source, target = (hadoop.Path(f"{self.path}/log/{x}") for x in (part, name))
        files = hadoop.FileContext.getFileContext(source.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(source, target, self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
            return True
        except Exception as e:  # noqa: BLE001
            files.delete(source, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def _commit(self, change: Callable[[Version], Version | None], attempts: int = 1000) -> Version | None:
        """Publish ``change`` of the newest version, again on each that came first; None if the change gives way."""
        for _ in range(attempts):
            base = self.version()
            new = change(base)
            if new is None:
                return None
            if new is base or self._publish(new):
                return new
        raise RuntimeError(f"no version of {self.path} could be published in {attempts} attempts")

    # ------------------------------------------------------------ changes

    def _write(self, rows: DataFrame, name: str) -> str:
        folder = f"{name}-{uuid.uuid4().hex}"  # an attempt's own: two writers of one commit never share a folder
        empty = self.spark.createDataFrame([], self.schema)
        rows.select(*[rows[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in empty.schema]).write.parquet(f"{self.path}/data/{folder}")
        return folder

    @staticmethod
    def _has(v: Version, name: str) -> bool:
        return name in v.absorbed or any(f.rsplit("-", 1)[0] == name for f in v.folders)

    def append(self, rows: DataFrame, commit: str | None = None) -> bool:
        """Add rows as one version; False if the named commit is in the table already."""
        name = commit or f"c{uuid.uuid4().hex}"
        if "/" in name or self._has(self.version(), name):
            if "/" in name:
                raise ValueError("a commit's name holds no slash")
            return False
        folder = self._write(rows, name)
        made = self._commit(lambda base: base if self._has(base, name) else Version(base.number + 1, f"append {name}", [*base.folders, folder], base.absorbed))
        return folder in made.folders

    def reset(self) -> int:
        """Publish an empty version, which knows no earlier commit; its number."""
        return self._commit(lambda base: Version(base.number + 1, "reset", [])).number

    def compact(self, how: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> bool:
        """Replace the folders of the newest version by one with ``how`` of their rows (the same rows in fewer files, or
        sums that mean the same). False if there is nothing to do or another change of these folders came first."""
        base = self.version()
        if len(base.folders) < 2:
            return False
        folder = self._write(how(self.read(base.number)), "compacted")
        old = set(base.folders)

        def change(now: Version) -> Version | None:
            if not old <= set(now.folders):
                return None
            names = [f.rsplit("-", 1)[0] for f in base.folders]
            return Version(now.number + 1, "compact", [folder, *[f for f in now.folders if f not in old]],
                           sorted({*now.absorbed, *[n for n in names if n != "compacted"]}))

        return self._commit(change) is not None

    # ------------------------------------------------------------ reads

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version as it is now, or of the given one."""
        folders = self.version(version).folders
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def history(self) -> DataFrame:
        """``version, operation, folders, at``: a row for each version."""
        rows = [(v.number, v.operation, len(v.folders), v.at) for v in map(self.version, self.versions())]
        return self.spark.createDataFrame(rows, "version bigint, operation string, folders int, at double")

    def vacuum(self, keep: int = 1, older_than_s: float = 86_400.0) -> list[str]:
        """Remove the folders that none of the last ``keep`` versions name and that are older than a commit may take; the
        versions before are no longer readable. Names of the removed folders."""
        known = self.versions()
        alive = {f for n in known[-keep:] for f in self.version(n).folders}
        data = Store(f"{self.path}/data")
        gone = []
        for folder in [e for e in data.scan(data.root) if isinstance(e, str)] if data.is_directory() else []:
            name = folder.rsplit("/", 1)[-1]
            newest = max((e.modified_ms for e in data.scan(folder) if isinstance(e, Entry)), default=0)
            if name not in alive and newest / 1000 < time.time() - older_than_s:
                data.remove(folder)
                gone.append(name)
        return sorted(gone)
