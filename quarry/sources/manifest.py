"""A Python data source over the files that a manifest names."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH_LINES = 10_000


def local_path(name: str) -> str:
    """The path of a plain name or a file: URL."""
    if name.startswith("file:"):
        return unquote(urlparse(name).path)
    return name


class Range(InputPartition):
    """Bytes of the manifest; the names that begin in them belong to the partition."""

    def __init__(self, start: int, end: int):
        super().__init__((start, end))


class ManifestLines(DataSource):
    """``value STRING``: the lines of all files named, one a line, in the manifest given to ``load``.

    Names may have blanks around them and empty lines between them; relative
    ones are taken from the manifest's folder. Options: ``group`` (bytes of
    the manifest a partition), ``missing`` (``fail`` or ``skip``).
    """

    @classmethod
    def name(cls) -> str:
        return "manifest_lines"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> ManifestReader:
        return ManifestReader(local_path(self.options["path"]), int(self.options.get("group", 64 << 10)),
                              self.options.get("missing", "fail"))


class ManifestReader(DataSourceReader):
    def __init__(self, manifest: str, group: int, missing: str):
        if missing not in ("fail", "skip") or group < 1:
            raise ValueError("missing must be fail or skip, group at least 1")
        self.manifest, self.group, self.missing = manifest, group, missing

    def partitions(self) -> list[Range]:
        size = os.path.getsize(self.manifest)
        return [Range(s, min(size, s + self.group)) for s in range(0, size, self.group)] or [Range(0, 0)]

    def names(self, start: int, end: int) -> Iterator[str]:
        """The names whose line begins at a byte from start to end."""
        with open(self.manifest, "rb") as f:
            if start:
                f.seek(start - 1)
                f.readline()        # what began before
            while f.tell() < end and (line := f.readline()):
                if name := line.decode("utf-8").strip():
                    yield os.path.join(os.path.dirname(self.manifest), local_path(name))

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []
        for name in self.names(*partition.value):
            if self.missing == "skip" and not os.path.exists(name):
                continue
            with open(name, encoding="utf-8", errors="replace") as f:
                for line in f:
                    lines.append(line[:-1] if line.endswith("\n") else line)
                    if len(lines) == BATCH_LINES:
                        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
                        lines = []
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
