"""First lines of many files: a data source whose partitions are bundles of files.

A task opens each file of its bundle and reads up to the first newline, so the
bytes read grow with the number of files and not with their sizes.  It serves
the stores that Arrow's file systems open (local folders, object stores).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Files of one partition, bytes of one read.
BUNDLE, CHUNK = 64, 4096
#: Schemes of paths that Arrow opens on every machine without a Java library.
SCHEMES = ("file", "s3", "s3a", "gs")


def first_line(path: str) -> tuple[str, int]:
    """The first line of a file without its line end, and the bytes read for it."""
    from pyarrow import fs

    if ":" not in path or path.startswith("file:"):
        store, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        store, name = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    found = b""
    with store.open_input_stream(name, buffer_size=0) as f:
        while b"\n" not in found and (part := f.read(CHUNK)):
            found += part
    return found.split(b"\n", 1)[0].removesuffix(b"\r").decode(), len(found)


class Bundle(InputPartition):
    def __init__(self, paths: Sequence[str]):
        super().__init__(None)
        self.paths = list(paths)


class _Reader(DataSourceReader):
    def __init__(self, paths: Sequence[str]):
        self.paths = paths

    def partitions(self) -> list[Bundle]:
        return [Bundle(self.paths[i:i + BUNDLE]) for i in range(0, len(self.paths), BUNDLE)] \
            or [Bundle([])]

    def read(self, partition: Bundle) -> Iterator[tuple[str, str, int]]:
        for path in partition.paths:
            yield (path, *first_line(path))


class HeaderSource(DataSource):
    """Rows (path, header, read) for the paths of the option ``paths``, one a line."""

    @classmethod
    def name(cls) -> str:
        return "indicata_headers"

    def schema(self) -> str:
        return "path string, header string, read bigint"

    def reader(self, schema) -> _Reader:
        return _Reader([p for p in self.options.get("paths", "").split("\n") if p])


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the visible, non-empty files that a pattern matches, from the store's listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    todo, found = list(fs.globStatus(path) or []), []
    while todo:
        s = todo.pop()
        if s.getPath().getName()[:1] in "._":
            continue
        if s.isDirectory():
            todo += [x for x in fs.listStatus(s.getPath()) if not x.isDirectory()]
        elif s.getLen():
            found.append(s.getPath().toString())
    return sorted(found)


def header_rows(spark: SparkSession, paths: Sequence[str]):
    """The source's rows for ``paths``; the classes travel with the query, so that its workers need
    no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        spark.dataSource.register(HeaderSource)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
    return spark.read.format("indicata_headers").option("paths", "\n".join(paths)).load()


def served(paths: Sequence[str]) -> bool:
    return all(":" not in p or p.split(":", 1)[0] in SCHEMES for p in paths)
