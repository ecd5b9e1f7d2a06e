"""Tables as folders that are written once, and a numbered log that says which count.

Below a table's folder, ``data/`` has one folder for each write and ``log/`` one small
file for each version, which lists the folders that make it up. Nothing that a reader may
have open is renamed or overwritten: a write is whole or not there at all, whatever the
file system's rename does. A version is committed by giving its log file a number that
does not exist yet, in one atomic step. Of two writers at once one gets the
number; the other takes the next one, an append on top of the first writer's rows.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tagweave.sources.tables import _ordered

#: Attempts to commit while other writers commit too.
ATTEMPTS = 100


@dataclass(frozen=True)
class VersionedFiles:
    """Versioned tables below ``root``, with the two methods of the other stores.

    ``keep`` versions stay readable by number; folders that no kept version lists go at
    the next write. The commit needs a file system whose rename refuses to replace a
    file in one step, as HDFS and local files do; object stores don't.
    """

    spark: SparkSession
    root: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    keep: int = 2

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str, schema=None, version: int | None = None) -> DataFrame:
        """The newest version, or the one of that number."""
        found = self.versions(name)
        if not found or version is not None and version not in found:
            raise FileNotFoundError(f"no version {version or ''} of {self.path(name)}")
        held = self._folders(name, version or found[-1])
        reader = self.spark.read.format(self.format).options(**self.options)
        return (reader.schema(schema) if schema else reader).load(
            [f"{self.path(name)}/data/{folder}" for folder in held])

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              sort_by: str | None = None) -> int:
        """Write a version and return its number. ``df`` may read the table itself."""
        if mode not in ("overwrite", "append", "error"):
            raise ValueError(f"a table is written by overwrite, append or error, not {mode}")
        if mode == "error" and self.versions(name):
            raise FileExistsError(self.path(name))
        folder = uuid.uuid4().hex
        target = f"{self.path(name)}/data/{folder}"
        try:
            _ordered(df, sort_by).write.format(self.format).options(**self.options).mode(
                "error").save(target)
        except Exception:
            self._delete(target)
            raise
        number = self._commit(name, lambda held: [*held, folder] if mode == "append" else [folder])
        self._clean(name)
        return number

    def versions(self, name: str) -> list[int]:
        """Numbers of the committed versions, in order."""
        log = self._place(f"{self.path(name)}/log")
        files = self._files(log)
        if not files.exists(log):
            return []
        return sorted(int(n) for s in files.listStatus(log)
                      if (n := s.getPath().getName()).isdigit())

    def _commit(self, name: str, folders: Callable[[list[str]], list[str]]) -> int:
        log = f"{self.path(name)}/log"
        self._files(self._place(log)).mkdirs(self._place(log))
        for _ in range(ATTEMPTS):
            known = self.versions(name)
            number = (known[-1] if known else 0) + 1
            # Numbers have no gaps, so whoever gets this one has seen the one before.
            held = folders(self._folders(name, number - 1) if known else [])
            draft = f"{log}/.draft-{uuid.uuid4().hex}"
            out = self._files(self._place(draft)).create(self._place(draft), False)
            out.write(bytearray(json.dumps(held).encode()))
            out.close()
            done = self._name(draft, f"{log}/{number:012d}")
            self._delete(draft)
            if done:
                return number
        raise OSError(f"{self.path(name)}: other writers came first {ATTEMPTS} times")

    def _name(self, draft: str, target: str) -> bool:
        """Give a draft its name unless that is taken; whether it was free."""
        jvm, source = self.spark._jvm, self._place(draft)
        if self._files(source).getScheme() == "file":
            # The local file system's rename would replace the file, a link does not.
            bare = lambda text: self._place(text).toUri().getPath()
            try:
                os.link(bare(draft), bare(target))
            except FileExistsError:
                return False
            return True
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(kinds, 1)
        never[0] = kinds.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            source.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(source, self._place(target), never)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def _folders(self, name: str, version: int) -> list[str]:
        path = self._place(f"{self.path(name)}/log/{version:012d}")
        files = self._files(path)
        stream = files.open(path)
        try:
            # One short line of text.
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _clean(self, name: str) -> None:
        """Forget versions before the last ``keep`` and the folders that only they list.

        Folders that no version lists may belong to a writer at work and stay.
        """
        found = self.versions(name)
        kept = {f for v in found[-self.keep:] for f in self._folders(name, v)}
        for version in found[:-self.keep]:
            try:
                gone = set(self._folders(name, version)) - kept
            except Exception:  # another writer cleans up too
                continue
            for folder in gone:
                self._delete(f"{self.path(name)}/data/{folder}")
            self._delete(f"{self.path(name)}/log/{version:012d}")

    def _place(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, text: str) -> None:
        self._files(self._place(text)).delete(self._place(text), True)
