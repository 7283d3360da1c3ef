"""A complete listing of a folder, as a data source that lists in its tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import UTC, datetime
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, place string, name string, type string, size long, modified timestamp"
ROWS_PER_BATCH = 10_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; one without a scheme is local.

    As in Spark, characters of a local path stand for themselves.
    """
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub("^file:(//[^/]*)?", "", path) or "/"
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


class Folder(InputPartition):
    """A folder with all below it, or, not ``deep``, the files directly in it."""

    def __init__(self, place: str, deep: bool):
        super().__init__(None)
        self.place, self.deep = place, deep


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/") or "/"
        self.name_glob = options.get("nameGlob", "*")
        self.recursive = options.get("recursive", "true").lower() == "true"
        self.levels = int(options.get("levels", "1"))

    def _listed(self, system: fs.FileSystem, root: str, place: str, deep: bool):
        below = f"{root}/{place}" if place else root
        return system.get_file_info(fs.FileSelector(below, recursive=deep))

    def partitions(self) -> list[InputPartition]:
        """The folder itself and each folder ``levels`` below it; only those are listed here."""
        folders = [Folder("", False)]
        if not self.recursive:
            return folders
        system, root = opened(self.path)
        level = [""]
        for depth in range(self.levels):
            last, found = depth == self.levels - 1, []
            for place in level:
                for info in self._listed(system, root, place, False):
                    if info.type == fs.FileType.Directory:
                        found.append(info.path[len(root) :].strip("/"))
            folders += [Folder(place, last) for place in found]
            level = found
        return folders

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        system, root = opened(self.path)
        rows = []
        for info in self._listed(system, root, partition.place, partition.deep):
            if info.type != fs.FileType.File or not fnmatchcase(info.base_name, self.name_glob):
                continue
            place = info.path[len(root) :].strip("/")
            # As a regular expression for the last extension has it: text after the last dot.
            kind = info.base_name.rpartition(".")[2] if "." in info.base_name else ""
            modified = info.mtime.astimezone(UTC) if info.mtime else None
            rows.append((f"{self.path.rstrip('/')}/{place}", place, info.base_name, kind, info.size, modified))
            if len(rows) >= ROWS_PER_BATCH:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _batch(rows: list[tuple[str, str, str, str, int, datetime | None]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 6
    kinds = [*[pa.string()] * 4, pa.int64(), pa.timestamp("us", "UTC")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds)],
        names=["path", "place", "name", "type", "size", "modified"],
    )


class ListingSource(DataSource):
    """``spark.read.format("listing").load(path)``: every file below a folder.

    Options: ``nameGlob`` on file names, ``recursive``, and ``levels``, the number of levels of
    folders that are listed to deal out the rest; more of them suit a tree with one large folder.
    """

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def inventory_all(
    spark: SparkSession, path: str, name_glob: str = "*", recursive: bool = True, levels: int = 1
) -> DataFrame:
    """Every file below ``path``, empty and hidden ones too, without reading any.

    ``path``, ``place`` below the folder, ``name``, ``type`` (the file extension), ``size`` and
    ``modified``. Folders are listed by tasks, one for each folder at ``levels``; the driver
    lists down to those. A missing folder is an error. Folders themselves are not rows.
    """
    spark.dataSource.register(ListingSource)
    return (
        spark.read.format("listing")
        .options(nameGlob=name_glob, recursive=str(recursive).lower(), levels=str(levels))
        .load(path)
    )
