"""One text file written by many tasks: each writes its part, and the commit joins them in order."""

from __future__ import annotations

import glob
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


class TextFileSource(DataSource):
    """Options: path; head and tail, text before and behind the lines; empty, text in place of
    none. Rows are (ord long, line string), in ranges of ``ord`` and sorted. The file's folder
    must be one that driver and executors share."""

    @classmethod
    def name(cls) -> str:
        return "one_text_file"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options)


@dataclass
class _Part(WriterCommitMessage):
    first: int
    file: str


class _Writer(DataSourceWriter):
    def __init__(self, options):
        self._path = options["path"]
        self._head, self._tail, self._empty = (options.get(k, "") for k in ("head", "tail", "empty"))
        folder, name = os.path.split(self._path)
        self._own = os.path.join(folder, f".{name}.{uuid.uuid4().hex}.")

    def write(self, iterator: Iterator) -> _Part:
        file, first, out = f"{self._own}{uuid.uuid4().hex}", None, None
        for row in iterator:
            if out is None:
                first, out = row["ord"], open(file, "w", encoding="utf-8", newline="\n")
            out.write(row["line"] + "\n")
        if out is None:
            return _Part(-1, "")
        out.close()
        return _Part(first, file)

    def _clear(self) -> None:
        """Also what failed and repeated attempts have left."""
        for file in glob.glob(glob.escape(self._own) + "*"):
            os.remove(file)

    def commit(self, messages: list[_Part | None]) -> None:
        whole = self._own + "whole"
        parts = sorted((m for m in messages if m and m.file), key=lambda m: m.first)
        try:
            with open(whole, "wb") as out:
                out.write((self._head + ("" if parts else self._empty)).encode())
                for part in parts:
                    with open(part.file, "rb") as f:
                        shutil.copyfileobj(f, out, 1 << 20)
                out.write(self._tail.encode())
            if os.path.exists(self._path):
                shutil.copymode(self._path, whole)
            os.replace(whole, self._path)
        finally:
            self._clear()

    def abort(self, messages: list[_Part | None]) -> None:
        self._clear()


def write_lines(lines: DataFrame, path: str, head: str = "", tail: str = "", empty: str = "") -> None:
    """Write ``lines`` (ord, line) in order to one file, whole or not at all."""
    lines.sparkSession.dataSource.register(TextFileSource)
    rows = lines.select("ord", "line").repartitionByRange("ord").sortWithinPartitions("ord")
    rows.write.format("one_text_file").mode("append").options(path=os.path.abspath(path), head=head, tail=tail, empty=empty).save()
