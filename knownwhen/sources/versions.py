"""Publication that survives a crash: rows go into new folders, a log says which folders count.

A version is one small file, ``_log/0000000007``, that appears by a rename and never
changes; the highest number is the current one. Rows are written first, so a writer that dies
leaves folders nobody refers to and the old version stays. A version is made from the one
before: of two writers that started from the same one, only the first gets the number, the
other is told so. Readers resolve the log once and keep their folders while later versions
come. Needs a file system whose rename doesn't replace (HDFS; object stores through a
committing file system); on a local disk the check and the rename are two steps.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentChange(RuntimeError):
    """Somebody else published after the version that this change is based on."""


@dataclass(frozen=True)
class Log:
    spark: SparkSession
    path: str

    @property
    def _folder(self) -> str:
        return f"{self.path}/_log"

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def versions(self) -> list[int]:
        files, where = self._at(self._folder)
        if not files.exists(where):
            return []
        names = [s.getPath().getName() for s in files.listStatus(where)]
        return sorted(int(n) for n in names if n.isdigit())

    def state(self, version: int) -> dict[str, Any]:
        files, where = self._at(f"{self._folder}/{version:010d}")
        stream = files.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(
                stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict[str, Any]]:
        """(version, state), (0, {}) before the first."""
        known = self.versions()
        return (known[-1], self.state(known[-1])) if known else (0, {})

    def commit(self, based_on: int, state: dict[str, Any]) -> int:
        """The new version, one above ``based_on``; raises where somebody has it already."""
        jvm, version = self.spark._jvm, based_on + 1
        draft = f"{self._folder}/.{uuid.uuid4().hex}"
        files, where = self._at(draft)
        out = files.create(where, False)
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        out.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never_replace = self.spark._sc._gateway.new_array(kind, 1)
        never_replace[0] = kind.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration())
        final = jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{version:010d}")
        try:
            if version <= max(self.versions(), default=0):
                raise ConcurrentChange(f"{self.path}: version {version} is there already")
            context.rename(files.makeQualified(where), files.makeQualified(final), never_replace)
        except Py4JJavaError as problem:
            if "FileAlreadyExists" in str(problem.java_exception.getClass()):
                raise ConcurrentChange(f"{self.path}: version {version} is there already") from None
            raise
        finally:
            files.delete(where, False)
        return version

    def forget(self, keep: int = 2) -> None:
        """Drop all but the last ``keep`` versions from the log. Their folders can go after that:
        :func:`orphans` lists those that no version names."""
        for version in self.versions()[:-keep]:
            files, where = self._at(f"{self._folder}/{version:010d}")
            files.delete(where, False)

    def orphans(self) -> list[str]:
        """Folders beside the log that no version refers to, such as those of a dead writer.

        The folders of a writer that is still at work are among them, so only old ones may go.
        """
        named = json.dumps([self.state(v) for v in self.versions()])
        files, where = self._at(self.path)
        if not files.exists(where):
            return []
        found = [s.getPath() for s in files.listStatus(where) if s.isDirectory()]
        return sorted(p.toString() for p in found
                      if p.getName() != "_log" and f'"{p.getName()}' not in named)
