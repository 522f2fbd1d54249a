"""Tables in the catalog, CSV in and out, NOT NULL on what is written.

A table is a view over one of its versions, a stored table of its own. A replacement is written aside, whole, before the view is pointed to
it in one step: a query that fails, or a process that dies, leaves the table as it was, and whoever reads it meanwhile keeps reading one
version. The version before is kept for such readers until the next replacement. What was declared (columns that are never NULL, partitions,
buckets) is stored with each version and holds for every way of writing.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.columns import required

# Type names of a schema dictionary.
TYPES = {
    "INTEGER": "bigint",
    "INT64": "bigint",
    "FLOAT": "double",
    "FLOAT64": "double",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "BOOL": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "NUMERIC": "decimal(38,9)",
    "BYTES": "binary",
}

# What happens to the rows a table already has.
WRITE_MODES = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append", "WRITE_EMPTY": "errorifexists"}


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a NULL in a NOT NULL column raises on write.

    Parquet tables do not enforce this themselves.
    """
    columns = []
    for f in schema.fields:
        value = F.col(f.name).cast(f.dataType)
        columns.append((value if f.nullable else required(value, f"column {f.name} is NULL")).alias(f.name))
    return df.select(*columns)


def schema_of(fields: list[dict]) -> T.StructType:
    """A schema dictionary (name, type, mode REQUIRED / NULLABLE / REPEATED) as a Spark schema."""
    out = []
    for f in fields:
        kind = TYPES[f["type"].upper()]
        mode = f.get("mode", "NULLABLE").upper()
        data_type = T.DataType.fromDDL(f"array<{kind}>" if mode == "REPEATED" else kind)
        out.append(T.StructField(f["name"], data_type, mode != "REQUIRED"))
    return T.StructType(out)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header. The schema is given: inferring it would read the files twice."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def write_csv(df: DataFrame, path: str, ordered: bool = False) -> None:
    """Submission files, each sorted by id; parts stay apart, nothing is pulled together.

    ``ordered`` also sorts across files, at the price of a shuffle and of computing ``df`` once more for its ranges.
    """
    rows = df.orderBy("id") if ordered else df.sortWithinPartitions("id")
    rows.write.mode("overwrite").csv(path, header=True)


@dataclass(frozen=True)
class Layout:
    """How a table is stored, and which columns are never NULL."""

    required: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    bucket_by: tuple[str, ...] = ()
    declared: bool = False  # the schema was given, so writes must have its columns
    by_load_date: bool = False

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def read(cls, text: str | None) -> "Layout":
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text or "{}").items()})


LOAD_DATE = "_load_date"  # a partition column that views do not show
_POINTER, _BEFORE, _LAYOUT, _MADE_FROM = "foldwise.version", "foldwise.before", "foldwise.layout", "foldwise.made_from"
_CURRENT_DATABASE = threading.Lock()


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class Entry:
    """What the catalog knows of a table."""

    version: str | None = None
    before: str | None = None
    layout: Layout = field(default_factory=Layout)
    made_from: dict[str, str] = field(default_factory=dict)
    description: str = ""
    is_view: bool = True


class Tables:
    """Tables of one dataset (a catalog database)."""

    def __init__(self, spark: SparkSession, dataset: str):
        self.spark = spark
        self.dataset = dataset

    def name(self, table: str) -> str:
        return f"`{self.dataset}`.`{table}`"

    def create_dataset(self, location: str | None = None) -> None:
        where = f" LOCATION '{location}'" if location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.dataset}`{where}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.dataset}.{table}")

    def entry(self, table: str) -> Entry:
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}
        description = self.spark.catalog.getTable(f"{self.dataset}.{table}").description or ""
        if _POINTER not in found:
            return Entry(description=description, is_view=False)
        return Entry(found[_POINTER], found.get(_BEFORE), Layout.read(found.get(_LAYOUT)), json.loads(found.get(_MADE_FROM, "{}")), description)

    def version(self, table: str) -> str | None:
        """Names what a table holds now; another one after each replacement."""
        return self.entry(table).version if self.exists(table) else None

    def delete(self, table: str) -> None:
        """The table and all its versions."""
        if not self.exists(table):
            return
        if not self.entry(table).is_view:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            return
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(table)}")
        for version in self._versions(table):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")

    def _versions(self, table: str) -> list[str]:
        listed = self.spark.sql(f"SHOW TABLES IN `{self.dataset}` LIKE {_quoted(table + '__v*')}").collect()
        return [r["tableName"] for r in listed if len(r["tableName"]) == len(table) + 35]

    def sweep(self, table: str) -> int:
        """Drop what no one is pointed to: versions before the last, and those of writers that died. Run it while nobody writes the table."""
        kept = self.entry(table).version
        old = [v for v in self._versions(table) if v != kept]
        for version in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")
        return len(old)

    def read(self, table: str) -> DataFrame:
        """The version a table has now. Frames made from it stay with that version."""
        entry = self.entry(table)
        if not entry.is_view:
            return self.spark.table(self.name(table))
        rows = self.spark.table(self.name(entry.version))
        return rows.drop(LOAD_DATE) if entry.layout.by_load_date else rows

    def loaded(self, table: str, first, last) -> DataFrame:
        """Rows that came in on the days from ``first`` to ``last``; reads the partitions of those days only."""
        entry = self.entry(table)
        if not entry.layout.by_load_date:
            raise ValueError(f"table {table} is not partitioned by its load date")
        return self.spark.table(self.name(entry.version)).filter(F.col(LOAD_DATE).between(*(F.lit(d).cast("date") for d in (first, last)))).drop(LOAD_DATE)

    def create(self, table: str, setting: dict, description: str = "") -> None:
        """Empty table from a schema dictionary, optionally partitioned by a date and clustered.

        ``timePartitioning`` partitions by its ``field``, or without one by the day rows are written; ``clustering.fields`` keeps rows with
        equal values in the same file and sorted.
        """
        if self.exists(table):
            raise ValueError(f"table {table} exists already")
        schema = schema_of(setting["schema"]["fields"])
        by = (setting.get("timePartitioning") or {}).get("field")
        arrival = "timePartitioning" in setting and not by
        clustered = tuple((setting.get("clustering") or {}).get("fields") or ())
        layout = Layout(
            required=tuple(f.name for f in schema.fields if not f.nullable),
            partition_by=(by,) if by else (LOAD_DATE,) if arrival else (),
            buckets=int(setting["clustering"].get("buckets", 8)) if clustered else 0,
            bucket_by=clustered,
            declared=True,
            by_load_date=arrival,
        )
        nothing = self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
        self._publish(nothing, table, layout, Entry(description=description), {})

    def schema(self, table: str) -> T.StructType:
        """The schema, with the NOT NULL columns that were declared."""
        required_ = self.entry(table).layout.required
        return T.StructType([T.StructField(f.name, f.dataType, f.name not in required_) for f in self.read(table).schema.fields])

    def _fitting(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` as rows of an existing table: its columns in its order and types, without NULL where it allows none.

        Columns that the table does not have are left out; one that is missing raises.
        """
        schema = self.schema(table)
        if missing := [c for c in schema.names if c not in df.columns]:
            raise ValueError(f"table {table} needs the columns {missing}")
        return enforce(df, schema)

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows to a table; they appear together, when all are written."""
        entry = self.entry(table)
        rows = self._fitting(df, table)
        if entry.layout.by_load_date:
            rows = rows.withColumn(LOAD_DATE, F.current_date())
        # partition columns are stored last
        target = self.spark.table(self.name(entry.version or table))
        rows.select(*target.columns).write.insertInto(self.name(entry.version or table))
        self.spark.catalog.refreshTable(self.name(table))

    def replace(self, df: DataFrame, table: str, schema: T.StructType | None = None, buckets: int = 0, key: str = "id", partition_by: tuple[str, ...] = (), made_from: dict[str, str] | None = None) -> None:
        """Create or replace a table from a query, checked against a declared schema.

        With ``buckets`` the rows are shuffled once here and stored by ``key``, so that every later group or join on it reads them in place. The
        query may read the table it replaces. ``made_from`` names the versions of what the query reads.
        """
        layout = Layout(tuple(f.name for f in schema.fields if not f.nullable) if schema is not None else (), tuple(partition_by), buckets, (key,) if buckets else (), schema is not None)
        out = enforce(df, schema) if schema is not None else df
        self._publish(out.repartition(buckets, key) if buckets else out, table, layout, self.entry(table) if self.exists(table) else Entry(), made_from or {})

    def _publish(self, df: DataFrame, table: str, layout: Layout, old: Entry, made_from: dict[str, str]) -> None:
        """Write a new version, then point the table to it."""
        if not old.is_view:
            raise ValueError(f"{table} was not made by this library")
        version = f"{table}__v{uuid.uuid4().hex}"
        columns = df.columns
        if layout.by_load_date and LOAD_DATE not in columns:
            df = df.withColumn(LOAD_DATE, F.current_date())
        writer = df.write.mode("errorifexists").partitionBy(*layout.partition_by)
        if layout.buckets:
            writer = writer.bucketBy(layout.buckets, *layout.bucket_by).sortBy(*layout.bucket_by)
        writer.saveAsTable(self.name(version))
        shown = ", ".join(f"`{c}`" for c in columns if c != LOAD_DATE or not layout.by_load_date)
        facts = {_POINTER: version, _LAYOUT: layout.text(), _MADE_FROM: json.dumps(made_from)} | ({_BEFORE: old.version} if old.version else {})
        properties = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in facts.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} COMMENT {_quoted(old.description)} TBLPROPERTIES ({properties}) AS SELECT {shown} FROM {self.name(version)}")
        if old.before:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(old.before)}")

    def insert_query(self, table: str, query: str, write_disposition: str = "WRITE_TRUNCATE") -> None:
        """The rows of a query into a table. What was declared of an existing table stays and is checked, also when its rows are replaced."""
        mode = WRITE_MODES[write_disposition]
        rows = self.run(query)
        if not self.exists(table):
            return self.replace(rows, table)
        if write_disposition == "WRITE_EMPTY" and not self.read(table).isEmpty():
            raise ValueError(f"table {table} already has rows")
        if mode == "append" or write_disposition == "WRITE_EMPTY":
            return self.append(rows, table)
        entry = self.entry(table)
        if entry.layout.declared:
            rows = self._fitting(rows, table)
        self._publish(rows, table, entry.layout if entry.layout.declared else Layout(), entry, {})

    def insert_frame(self, df: DataFrame, table: str) -> None:
        """Load a frame into a table, creating it if needed and adding to it otherwise."""
        if self.exists(table):
            self.append(df, table)
        else:
            self.replace(df, table)

    def copy(self, table: str, target: "Tables", name: str | None = None) -> None:
        """Rows, declaration, partitions and buckets; the target is replaced."""
        entry, name = self.entry(table), name or table
        rows = self.spark.table(self.name(entry.version or table))
        if entry.layout.buckets:
            rows = rows.repartition(entry.layout.buckets, *entry.layout.bucket_by)
        old = target.entry(name) if target.exists(name) else Entry()
        target._publish(rows, name, entry.layout, replace(old, description=entry.description), {})

    def set_description(self, table: str, description: str) -> None:
        if self.entry(table).is_view:
            self.spark.sql(f"ALTER VIEW {self.name(table)} SET TBLPROPERTIES ('comment' = {_quoted(description)})")
        else:
            self.spark.sql(f"COMMENT ON TABLE {self.name(table)} IS {_quoted(description)}")

    def description(self, table: str) -> str:
        return self.entry(table).description

    def run(self, statement: str) -> DataFrame:
        """Run a statement with this dataset as the default one. Threads that call it take turns while it is planned."""
        with _CURRENT_DATABASE:
            before = self.spark.catalog.currentDatabase()
            self.spark.catalog.setCurrentDatabase(self.dataset)
            try:
                return self.spark.sql(statement)
            finally:
                self.spark.catalog.setCurrentDatabase(before)

    def fetch(self, query: str) -> DataFrame:
        """The result stays distributed; call ``toPandas`` on small ones."""
        return self.run(query)
