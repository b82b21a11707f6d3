"""What the engine is told: columns, tables, and the rules for comparing and loading a pair of them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

COLUMNS_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("char_length", T.IntegerType()),
        T.StructField("data_length", T.IntegerType()),
        T.StructField("numeric_precision", T.IntegerType()),
        T.StructField("numeric_scale", T.IntegerType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("udt_name", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Column:
    """A column as its home store describes it."""

    name: str
    ordinal: int
    data_type: str
    char_length: int | None = None
    data_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    udt_name: str | None = None

    def row(self, table: str) -> tuple:
        return table, self.name, self.ordinal, self.data_type, self.char_length, self.data_length, self.precision, self.scale, self.nullable, self.udt_name


@dataclass(frozen=True)
class Incremental:
    """Which rows are new: by a growing number, or by a time with an overlap that re-reads late rows."""

    column: str
    strategy: str = "updated_at"
    overlap_minutes: int = 5
    initial: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """A source and a target, how their columns correspond, and how rows are found and loaded."""

    name: str
    keys: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    where: str | None = None
    mode: str = "truncate"
    incremental: Incremental | None = None
    lob: dict[str, str] = field(default_factory=dict)
    lob_default: str = "error"
    exclude: tuple[str, ...] = ()
    chunk_size: int = 50_000
    on_duplicate: str = "error"
    order_by: tuple[str, ...] = ()  # says which of the rows of a key is the last
    skip_failed: bool = False  # leave out rows that cannot be cast, instead of refusing the load


@dataclass(frozen=True)
class LoadResult:
    table_name: str
    mode: str
    status: str
    rows_read: int = 0
    rows_written: int = 0
    rows_failed: int = 0
    checksum_status: str = ""
    version: str | None = None
    backup: str | None = None
    message: str = ""
    watermark: str | None = None
    verdict: str = ""
    bytes_written: int = 0
    long_bytes: int = 0
    seconds: float = 0.0
    files_rewritten: int = 0  # of the table before, by a keyed load
    rejects: str = ""  # folder of the rows that were left out

    @property
    def rows_per_second(self) -> float:
        return self.rows_written / self.seconds if self.seconds else 0.0

    @property
    def bytes_per_second(self) -> float:
        return self.bytes_written / self.seconds if self.seconds else 0.0
