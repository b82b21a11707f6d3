"""What is known of tables without reading their rows: columns, existence, names, counts and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.model import COLUMNS_SCHEMA

# Catalog names of Spark's types in the target's dialect (data_type, short name).
TYPE_NAMES = {
    "tinyint": ("smallint", "int2"), "smallint": ("smallint", "int2"), "int": ("integer", "int4"), "bigint": ("bigint", "int8"), "float": ("real", "float4"), "double": ("double precision", "float8"),
    "boolean": ("boolean", "bool"), "string": ("text", "text"), "binary": ("bytea", "bytea"), "date": ("date", "date"), "timestamp": ("timestamp with time zone", "timestamptz"), "timestamp_ntz": ("timestamp without time zone", "timestamp"),
}


# The same types in the source's dialect, which has them with a precision and a scale where they are numbers.
SOURCE_NAMES = {
    "tinyint": ("NUMBER", 3, 0), "smallint": ("NUMBER", 4, 0), "int": ("NUMBER", 9, 0), "bigint": ("NUMBER", 18, 0), "float": ("BINARY_FLOAT", None, None), "double": ("BINARY_DOUBLE", None, None),
    "boolean": ("BOOLEAN", None, None), "string": ("CLOB", None, None), "binary": ("BLOB", None, None), "date": ("DATE", None, None), "timestamp": ("TIMESTAMP", None, None), "timestamp_ntz": ("TIMESTAMP", None, None),
}


def columns_of(tables: dict[str, DataFrame], spark: SparkSession, dialect: str = "target") -> DataFrame:
    """A row for each column of each table, from their schemas alone, with type names of the target's or the source's dialect."""
    rows = []
    for name_, df in tables.items():
        for i, f in enumerate(df.schema, 1):
            declared = str(f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
            size = int(declared.partition("(")[2].rstrip(")")) if "(" in declared else None
            kind, short = TYPE_NAMES.get(f.dataType.simpleString(), (f.dataType.simpleString(), f.dataType.simpleString()))
            if declared:
                kind, short = ("character varying", "varchar") if declared.startswith("varchar") else ("character", "bpchar")
            decimal = isinstance(f.dataType, T.DecimalType)
            if dialect == "source":
                known = SOURCE_NAMES.get(f.dataType.simpleString(), (f.dataType.simpleString().upper(), None, None))
                name, precision, scale = ("NUMBER", f.dataType.precision, f.dataType.scale) if decimal else known
                if declared:
                    name = "VARCHAR2" if declared.startswith("varchar") else "CHAR"
                rows.append((name_, f.name, i, name, size, None, precision, scale, f.nullable, None))
                continue
            rows.append((name_, f.name, i, "numeric" if decimal else kind, size, None, f.dataType.precision if decimal else None, f.dataType.scale if decimal else None, f.nullable, "numeric" if decimal else short))
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def list_tables(spark: SparkSession, schema: str, pattern: str = "*") -> DataFrame:
    """Tables of a schema whose name matches, the last name first."""
    found = spark.sql(f"SHOW TABLES IN `{schema}` LIKE '{pattern}'").where("NOT isTemporary")
    return found.select(F.col("tableName").alias("table_name")).orderBy(F.desc("table_name"))


def resolve(spark: SparkSession, schema: str, name: str) -> str | None:
    """The catalog's name for a table: as given, else in upper case, else any that differs in case, by name."""
    names = [t.name for t in spark.catalog.listTables(schema)]
    for wanted in (name, name.upper()):
        if wanted in names:
            return wanted
    return min((n for n in names if n.lower() == name.lower()), default=None)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def footer_count(spark: SparkSession, path: str) -> DataFrame:
    """Rows of Parquet files. No column is read: Spark takes the counts from the files' footers."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))


def statistics_count(spark: SparkSession, name: str, refresh: bool = False) -> int | None:
    """The catalog's row count, None if it has not been computed."""
    if refresh:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    stats = [r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Statistics"]
    words = stats[0].replace(",", " ").split() if stats else []
    return int(words[words.index("rows") - 1]) if "rows" in words else None


def size_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path, from the file system's summary."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def has_statistics(path: str, column: str) -> bool:
    """Whether a Parquet file's row groups have bounds of a column: what an index is to a store, they are to a scan."""
    import pyarrow.fs
    import pyarrow.parquet as pq

    fs, at = pyarrow.fs.FileSystem.from_uri(path) if ":" in path else (pyarrow.fs.LocalFileSystem(), path)
    with fs.open_input_file(at) as stream:
        meta = pq.ParquetFile(stream).metadata
        found = [c for i in range(meta.num_row_groups) for c in map(meta.row_group(i).column, range(meta.num_columns)) if c.path_in_schema.lower() == column.lower()]
        return len(found) == meta.num_row_groups and all(c.is_stats_set and c.statistics.has_min_max for c in found)


def is_bounded(df: DataFrame, column: str) -> bool | None:
    """has_statistics() of the first of the files that a frame reads; None where it reads none, as over JDBC."""
    files = [f for f in df.inputFiles() if f.endswith(".parquet")]
    return has_statistics(min(files), column) if files else None


def objects_of(spark: SparkSession, schema: str, source_db: str = "catalog") -> DataFrame:
    """Tables, views and functions of a schema: source_db, object_schema, object_name, object_type, parent_name, definition, status, details, seq.

    Names and view texts come from the session's catalog, a row for each object.
    """
    rows = []
    for t in spark.catalog.listTables(schema):
        if not t.isTemporary:
            facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED `{schema}`.`{t.name}`").collect()}
            try:
                spark.table(f"`{schema}`.`{t.name}`").schema  # noqa: B018
                status, details = "VALID", t.description or ""
            except Exception as e:  # a view whose tables or columns are gone
                status, details = "INVALID", str(e).splitlines()[0][:300]
            rows.append((source_db, schema, t.name, "VIEW" if t.tableType == "VIEW" else "TABLE", "", facts.get("View Text"), status, details, len(rows)))
    for f in spark.catalog.listFunctions(schema):
        if f.namespace and f.namespace[-1] == schema:
            rows.append((source_db, schema, f.name, "FUNCTION", "", f.description, "VALID", f.className or "", len(rows)))
    return spark.createDataFrame(rows, "source_db string, object_schema string, object_name string, object_type string, parent_name string, definition string, status string, details string, seq long")


def _leaves(plan) -> set[str]:
    """The tables and views that a plan reads itself: what its own text names, not what the views among them read."""
    found: set[str] = set()
    stack = [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "View":
            found.add(node.desc().identifier().unquotedString())
            continue
        table = node.catalogTable() if name.startswith(("Relation", "LogicalRelation")) else node.tableMeta() if name == "HiveTableRelation" else None
        if table is not None:
            table = table.get() if hasattr(table, "get") and name != "HiveTableRelation" and table.isDefined() else table if name == "HiveTableRelation" else None
            if table is not None:
                found.add(table.identifier().unquotedString())
        for group in (node.children(), node.subqueries()):
            stack += [group.apply(i) for i in range(group.size())]
    return found


def resolved_edges(spark: SparkSession, schema: str) -> DataFrame:
    """object, uses of the views of a schema, as schema.name, from their analysed plans: aliases, common table expressions, texts and comments that look
    like a table's name are none. A view that cannot be analysed, as what it reads is gone, has the tables of its text's FROM and JOIN."""
    rows = []
    for t in spark.catalog.listTables(schema):
        if t.tableType != "VIEW" or t.isTemporary:
            continue
        me = f"{schema}.{t.name}"
        try:
            plan = spark.table(f"`{schema}`.`{t.name}`")._jdf.queryExecution().analyzed()
            while plan.nodeName() != "View":
                plan = plan.children().apply(0)
            used = set()
            for i in range(plan.children().size()):
                used |= _leaves(plan.children().apply(i))
        except Exception:
            facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED `{schema}`.`{t.name}`").collect()}
            used = _named(spark, facts.get("View Text") or "", schema)
        rows += [(me, ".".join(u.split(".")[-2:])) for u in sorted(used)]
    return spark.createDataFrame(rows, "object string, uses string")


def _named(spark: SparkSession, text: str, schema: str) -> set[str]:
    """Relations that a text names and nothing has resolved yet, from its parsed plan."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception:
        return set()
    found, own, stack = set(), set(), [plan]
    while stack:
        node = stack.pop()
        if node.nodeName() == "UnresolvedRelation":
            parts = node.multipartIdentifier()
            found.add(tuple(parts.apply(i) for i in range(parts.size())))
        elif node.nodeName() == "UnresolvedWith":  # names that the text gives to parts of itself
            own |= {(node.cteRelations().apply(i)._1(),) for i in range(node.cteRelations().size())}
        for group in (node.children(), node.innerChildren(), node.subqueries()):
            stack += [x for x in (group.apply(i) for i in range(group.size())) if hasattr(x, "nodeName")]
    return {".".join(n if len(n) > 1 else (schema, *n)) for n in found - own}
