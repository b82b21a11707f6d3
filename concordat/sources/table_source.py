"""Versioned tables as a data source: spark.read.format("concordat").load(path).

Options: `version` (a name) or `as_of` (ISO time, or seconds since 1970) choose what is read, by default the current version; `columns` (names with
commas) what of it, as sources of this kind are not told which columns a query needs; `bundle_bytes` how much a task reads. Filters on columns
leave out files by the key ranges that are kept beside their folders (VersionedTable.index, or an upsert by those keys), before any file is
opened, and row groups by the statistics in their footers; Spark applies them to rows again. VersionedTable.read() is the faster way to read whole tables.
"""

from __future__ import annotations

import json
import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone
from decimal import Decimal
from typing import Any

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from concordat.sources import versions
from concordat.sources.versions import REJECTED, parts_of

ORDERED = (int, str, date, Decimal)  # types whose order is the same here and in files
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"  # fixed name in footers


def may_hold(f: Filter, low: Any, high: Any) -> bool:
    """Whether a value between two bounds can pass a filter. Values that cannot be compared might."""
    values = list(f.value) if isinstance(f, In) else [f.value]
    if type(low) is not type(high) or type(low) not in ORDERED or any(type(v) is not type(low) for v in values):
        return True
    v = values[0] if values else None
    if isinstance(f, In | EqualTo | EqualNullSafe):
        return any(low <= x <= high for x in values)
    if isinstance(f, GreaterThan | GreaterThanOrEqual):
        return high > v or (isinstance(f, GreaterThanOrEqual) and high == v)
    return low < v or (isinstance(f, LessThanOrEqual) and low == v)


def seconds(as_of: str) -> float:
    """A time in seconds; times without a zone are UTC."""
    try:
        return float(as_of)
    except ValueError:
        at = datetime.fromisoformat(as_of)
        return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp()


class Folder:
    """A table's folder, read without a session."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.fs, self.root = pa.fs.FileSystem.from_uri(self.path) if re.match(r"\w+:", self.path) else (pa.fs.LocalFileSystem(), self.path)

    def names(self, folder: str) -> dict[str, int]:
        """Sizes by name."""
        return {i.base_name: i.size or 0 for i in self.fs.get_file_info(pa.fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))}

    def commits(self) -> Iterator[dict]:
        """The newest first."""
        for n in sorted((n for n in self.names("_log") if re.fullmatch(r"\d+\.json", n)), reverse=True):
            with self.fs.open_input_stream(f"{self.root}/_log/{n}") as stream:
                yield json.loads(stream.read())

    def version(self, name: str | None, as_of: str | None) -> list[dict]:
        """The parts of a version."""
        newest = next(self.commits(), None)
        if newest is None or not newest["version"]:
            raise ValueError(f"{self.path} is no table, or has no version")
        if name and as_of:
            raise ValueError("ask for a version or for a time, not both")
        if as_of:
            at = seconds(as_of)
            then = next((c for c in self.commits() if c.get("at", 0) <= at), None)
            name = then["version"] if then else None
            if name is None:
                raise ValueError(f"{self.path}: nothing is known of {as_of}")
        name = name or newest["version"]
        if name not in newest["parts"]:
            raise ValueError(f"{self.path}: version {name} is not kept")
        return parts_of(newest, name)

    def files(self, parts: list[dict]) -> list[tuple[str, str, int]]:
        """(folder, file, size)."""
        return [(p["folder"], n, size) for p in parts for n, size in sorted(self.names(f"v={p['folder']}").items()) if n.endswith(".parquet") and n not in p["without"]]

    def bounds(self, folder: str) -> dict[str, dict[str, tuple]]:
        """For columns that lead a kept key: (low, high) by file. A low of None is that of files with nulls."""
        out = {}
        for name in self.names(f"_kept/v={folder}"):
            if not re.fullmatch(r"keys-.*(?<!\.[0-9a-f]{32})", name):
                continue
            kept = pq.read_table(f"{self.root}/_kept/v={folder}/{name}", filesystem=self.fs, columns=["_file", "low", "high"], partitioning=None)
            keys = name.removeprefix("keys-").split("-")
            if kept.schema.field("low").type.num_fields != len(keys):  # a name that holds the separator
                continue
            rows = kept.to_pylist()
            out[keys[0]] = {r["_file"]: (r["low"]["k0"], r["high"]["k0"]) for r in rows}
        return out


@dataclass
class Piece(InputPartition):
    """Files that a task reads, with the share of each: row groups whose number leaves `nth` when divided by `of`."""

    files: list[tuple[str, int, int]]


class TableReader(DataSourceReader):
    def __init__(self, folder: Folder, parts: list[dict], schema: StructType, bundle: int):
        self.path, self.parts, self.schema, self.bundle, self.filters = folder.path, parts, schema, bundle, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | EqualNullSafe | In | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual) and len(f.attribute) == 1:
                self.filters.append(f)
            yield f  # files and row groups are left out, rows are not

    def chosen(self) -> list[tuple[str, int]]:
        """(path, size) of the files that may have rows."""
        folder = Folder(self.path)
        known = {p["folder"]: folder.bounds(p["folder"]) if self.filters else {} for p in self.parts}
        out = []
        for where, name, size in folder.files(self.parts):
            ranges = [(f, known[where][f.attribute[0]].get(name)) for f in self.filters if f.attribute[0] in known[where]]
            # nulls pass none of these filters but a null-safe one for null, which bounds do not answer
            if all(r is None or r[0] is None or may_hold(f, *r) for f, r in ranges):
                out.append((f"v={where}/{name}", size))
        return out

    def partitions(self) -> list[Piece]:
        out, held = [Piece([])], 0
        for path, size in self.chosen():
            n = max(1, math.ceil(size / self.bundle))
            if n > 1:
                out = [*out[:-1], *(Piece([(path, i, n)]) for i in range(n)), out[-1]]
                continue
            if held + size > self.bundle and out[-1].files:
                out, held = [*out, Piece([])], 0
            out[-1].files.append((path, 0, 1))
            held += size
        return [p for p in out if p.files] or [Piece([])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        folder, shape = Folder(self.path), to_arrow_schema(self.schema)
        for path, nth, of in partition.files:
            with folder.fs.open_input_file(f"{folder.root}/{path}") as stream:
                file = pq.ParquetFile(stream)
                groups = [g for g in range(nth, file.num_row_groups, of) if self._wanted(file.metadata.row_group(g))]
                there = set(file.schema_arrow.names)
                for batch in file.iter_batches(8192, row_groups=groups, columns=[n for n in shape.names if n in there]) if groups else ():
                    yield pa.record_batch([batch.column(f.name).cast(f.type, safe=False) if f.name in there else pa.nulls(batch.num_rows, f.type) for f in shape], schema=shape)

    def _wanted(self, group: pq.RowGroupMetaData) -> bool:
        said = {c.path_in_schema: c.statistics for c in map(group.column, range(group.num_columns))}
        for f in self.filters:
            s = said.get(f.attribute[0])
            if s is not None and s.has_min_max and not may_hold(f, s.min, s.max):
                return False
        return True


class TableSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "concordat"

    def _place(self) -> tuple[Folder, list[dict]]:
        folder = Folder(self.options["path"])
        return folder, folder.version(self.options.get("version"), self.options.get("as_of"))

    def schema(self) -> StructType:
        folder, parts = self._place()
        first = next(((p, n) for p, n, _ in folder.files(parts)), None)
        if first is None:  # every file was rewritten, and nothing is left
            first = next((p["folder"], n) for p in parts for n in folder.names(f"v={p['folder']}") if n.endswith(".parquet"))
        with folder.fs.open_input_file(f"{folder.root}/v={first[0]}/{first[1]}") as stream:
            file = pq.ParquetFile(stream)
            told = (file.metadata.metadata or {}).get(SPARK_SCHEMA)
            whole = StructType.fromJson(json.loads(told)) if told else from_arrow_schema(file.schema_arrow)
        asked = [c.strip() for c in self.options["columns"].split(",")] if self.options.get("columns") else [n for n in whole.names if n != REJECTED]
        return StructType([whole[c] for c in asked])

    def reader(self, schema: StructType) -> TableReader:
        return TableReader(*self._place(), schema, int(self.options.get("bundle_bytes", 128 << 20)))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters handed down. The source goes to Python workers by value, so they need not have this library."""
    for module in (sys.modules[__name__], versions):
        cloudpickle.register_pickle_by_value(module)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TableSource)
