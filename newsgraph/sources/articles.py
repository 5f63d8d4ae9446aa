"""Article CSV files as a Python data source (A1-A5, C11, H1).

``spark.dataSource.register(ArticleFiles)`` and then

    spark.read.format("article_files").schema(...).option("path", folder).load()

A partition is a group of files, told by a hash of their names: the driver
hands out group numbers only, and each task lists the folder, keeps the files of
its group and year, and reads their headers itself.  Rows are matched to the
schema by column name, so files with other columns or another order mix."""
from __future__ import annotations

import csv
import io
import json
import sys
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual)

#: Columns about the file, behind those of the articles.
SOURCE_FILE, FILE_YEAR = "_source_file", "_file_year"
#: A batch goes to Spark once it holds so many rows or characters.
BATCH_ROWS, BATCH_CHARS = 2_000, 8 << 20


def file_schema(schema: T.StructType) -> T.StructType:
    """``schema`` and the columns about the file."""
    return T.StructType([*schema.fields, T.StructField(SOURCE_FILE, T.StringType()),
                         T.StructField(FILE_YEAR, T.IntegerType())])


def file_year(name: str) -> int | None:
    """The year in the first four characters of a file name."""
    head = name[:4]
    return int(head) if len(head) == 4 and head.isascii() and head.isdigit() else None


def column_names(header: list[str | None]) -> list[str]:
    """Names of a header line; an unnamed column is ``_c<position>``."""
    return [h if h else f"_c{i}" for i, h in enumerate(header)]


class _Group(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)


class ArticleFiles(DataSource):
    """Options: ``path`` (a folder or file, or a JSON list of them; any file
    system that pyarrow knows), ``groups`` (partitions, default 64).

    All columns but ``_file_year`` are strings; a cell without quotes and
    characters is null, as is a column that a file lacks.  A row longer than the
    header loses its surplus cells, and of two columns of one name the first counts."""

    @classmethod
    def name(cls) -> str:
        return "article_files"

    def schema(self) -> T.StructType:
        return file_schema(T.StructType([T.StructField(c, T.StringType()) for c in ("datetime", "title", "text")]))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArticleReader(schema, self.options)


class ArticleReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        for f in schema.fields:
            want = T.IntegerType() if f.name == FILE_YEAR else T.StringType()
            if f.dataType != want:
                raise ValueError(f"column {f.name} is read as {want.simpleString()}; cast it afterwards")
        path = options["path"]
        self.paths = json.loads(path) if path.startswith("[") else [path]
        self.groups = int(options.get("groups", 64))
        self.names = schema.fieldNames()
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of the file's year are decided before a file is opened;
        Spark evaluates all others."""
        for f in filters:
            year = getattr(f, "attribute", None) == (FILE_YEAR,)
            if year and isinstance(f, (IsNotNull, EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan,
                                       LessThanOrEqual)):
                self.conditions.append(f)
            else:
                yield f

    def _wanted(self, name: str) -> bool:
        year = file_year(name)
        if self.conditions and year is None:
            return False
        tests = {EqualTo: lambda v: year == v, In: lambda v: year in v, GreaterThan: lambda v: year > v,
                 GreaterThanOrEqual: lambda v: year >= v, LessThan: lambda v: year < v,
                 LessThanOrEqual: lambda v: year <= v}
        return all(tests[type(c)](c.value) for c in self.conditions if not isinstance(c, IsNotNull))

    def partitions(self) -> list[InputPartition]:
        return [_Group(i) for i in range(self.groups)]

    def _files(self, group: int) -> Iterator[tuple[object, str]]:
        from pyarrow import fs
        for path in self.paths:
            system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
                else (fs.LocalFileSystem(), path)
            info = system.get_file_info(root)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root))
            for f in sorted(found, key=lambda f: f.path):
                hidden = f.base_name.startswith(("_", "."))
                if f.type == fs.FileType.File and not hidden and self._wanted(f.base_name) \
                        and zlib.crc32(f.base_name.encode()) % self.groups == group:
                    yield system, f.path

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)  # whole texts
        for system, path in self._files(partition.value):
            with system.open_input_stream(path) as raw:
                text = io.TextIOWrapper(io.BufferedReader(raw, 1 << 20), encoding="utf-8-sig", newline="")
                yield from self._batches(path, csv.reader(text, quoting=csv.QUOTE_NOTNULL))

    def _batches(self, path: str, rows: Iterator[list[str | None]]) -> Iterator[pa.RecordBatch]:
        header = column_names(next(rows, []))
        # place of each wanted column in this file
        places = [header.index(n) if n in header else None for n in self.names]
        year = file_year(path.rsplit("/", 1)[-1])
        kept: list[list[str | None]] = []
        chars = 0
        for row in rows:
            if not row:
                continue  # an empty line
            kept.append(row)
            chars += sum(len(c) for c in row if c)
            if len(kept) == BATCH_ROWS or chars >= BATCH_CHARS:
                yield self._batch(path, year, places, kept)
                kept, chars = [], 0
        if kept:
            yield self._batch(path, year, places, kept)

    def _batch(self, path: str, year: int | None, places: list[int | None],
               rows: list[list[str | None]]) -> pa.RecordBatch:
        columns = []
        for name, at in zip(self.names, places):
            if name == FILE_YEAR:
                columns.append(pa.array([year] * len(rows), pa.int32()))
            elif name == SOURCE_FILE:
                columns.append(pa.array([path] * len(rows), pa.string()))
            else:
                columns.append(pa.array([r[at] if at is not None and at < len(r) else None for r in rows], pa.string()))
        return pa.RecordBatch.from_arrays(columns, self.names)
