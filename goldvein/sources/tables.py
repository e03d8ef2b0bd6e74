"""Zones (databases) and parquet tables in the session catalog.

A table is an external parquet table whose location is a version folder.  An
overwrite writes a new version folder first and only then re-points the table,
so a job that dies half-way leaves readers on the old data, and a table may be
rebuilt from itself.  In a partitioned table each partition has its own folder:
new files are finished in a new version folder, then the partitions they hold are
re-pointed one after the other.  Each partition switches in one step, a table is
never dropped while its columns fit, old files stay, and a switch that broke off
is mended by running the load again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: partitions named in one statement when they are new
PARTITIONS_AT_ONCE = 100

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: what Spark calls the partition of null


@dataclass(frozen=True)
class Zone:
    """A database and the folder its tables live in."""

    name: str
    root: str

    def table(self, name: str) -> "Table":
        return Table(self, name)


@dataclass(frozen=True)
class Table:
    zone: Zone
    name: str

    @property
    def sql_name(self) -> str:
        return f"`{self.zone.name}`.`{self.name}`"


def create_zone(spark: SparkSession, zone: Zone) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{zone.name}` LOCATION '{zone.root}'")


def list_zones(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def table_exists(spark: SparkSession, table: Table) -> bool:
    return spark.catalog.tableExists(table.sql_name)


def read_table(spark: SparkSession, table: Table) -> DataFrame:
    return spark.read.table(table.sql_name)


def _described(spark: SparkSession, table: Table) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table.sql_name}").collect()
    return {r.col_name: r.data_type for r in rows}


def table_location(spark: SparkSession, table: Table) -> str:
    return _described(spark, table)["Location"]


def partition_columns(spark: SparkSession, table: Table) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table.sql_name) if c.isPartition]


def _new_location(table: Table) -> str:
    return f"{table.zone.root.rstrip('/')}/{table.name}/v-{uuid.uuid4().hex[:12]}"


def _register(
    spark: SparkSession, table: Table, df: DataFrame, location: str, partition_by: Sequence[str]
) -> None:
    """Point the catalog entry at a finished folder; metadata only.

    A table that keeps its columns is moved in one step.  Otherwise the entry is
    made anew, which drops no data because the table is external.
    """
    if not partition_by and table_exists(spark, table):
        old = read_table(spark, table).schema
        same = [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in df.schema]
        if same and not partition_columns(spark, table):
            spark.sql(f"ALTER TABLE {table.sql_name} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table.sql_name)
            return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {table.sql_name}")
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE {table.sql_name} ({columns}) USING parquet {parts} LOCATION '{location}'"
    )


def _spec(columns: Sequence[str], values: Sequence[object]) -> str:
    def literal(value: object) -> str:
        if value is None:
            return "null"
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"`{c}` = {literal(v)}" for c, v in zip(columns, values))


def partition_values(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """The partitions that rows fall into; as many rows as the table has partitions at most."""
    return [tuple(r) for r in df.select(*columns).distinct().collect()]


def _named_values(spark: SparkSession, schema: T.StructType, columns: Sequence[str], names: Sequence[str]) -> list[tuple]:
    """The values in folder names such as ``month=1/shop=x``, in the types of the columns."""

    def text(part: str) -> str | None:
        value = unquote(part.split("=", 1)[1])
        return None if value == _NULL_FOLDER else value

    rows = [tuple(text(part) for part in name.split("/")[-len(columns) :]) for name in names]
    if not rows:
        return []
    texts = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    typed = [F.col(f"`{c}`").cast(schema[c].dataType) for c in columns]
    return [tuple(r) for r in spark.createDataFrame(rows, texts).select(*typed).collect()]


def partition_values_of(spark: SparkSession, table: Table) -> list[tuple]:
    """The partitions of a table as the catalog lists them; no data is read."""
    names = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table.sql_name}").collect()]
    return _named_values(spark, read_table(spark, table).schema, partition_columns(spark, table), names)


def _written(df: DataFrame, location: str, columns: Sequence[str]) -> dict[tuple, str]:
    """Partitions of a finished folder and the folder of each, from the names of its files."""
    spark = df.sparkSession
    files = spark.read.schema(df.schema).parquet(location).inputFiles()
    folders = sorted({unquote(f.rsplit("/", 1)[0]) for f in files})
    return dict(zip(_named_values(spark, df.schema, columns, folders), folders))


def _switch_partitions(
    spark: SparkSession, table: Table, columns: Sequence[str], folders: dict[tuple, str], gone: Iterable[tuple] = ()
) -> None:
    """Point partitions at finished folders, and forget those that have no rows any more."""
    named = {values: (_spec(columns, values), folder.replace("'", "\\'")) for values, folder in folders.items()}
    have = set(partition_values_of(spark, table))
    fresh = [f"PARTITION ({spec}) LOCATION '{where}'" for values, (spec, where) in named.items() if values not in have]
    for at in range(0, len(fresh), PARTITIONS_AT_ONCE):
        some = " ".join(fresh[at : at + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {table.sql_name} ADD IF NOT EXISTS {some}")
    for values, (spec, where) in named.items():
        if values in have:
            spark.sql(f"ALTER TABLE {table.sql_name} PARTITION ({spec}) SET LOCATION '{where}'")
    for values in gone:
        spark.sql(f"ALTER TABLE {table.sql_name} DROP IF EXISTS PARTITION ({_spec(columns, values)})")
    spark.catalog.refreshTable(table.sql_name)


def _fits(old: T.StructType, new: T.StructType) -> bool:
    """Whether a table's columns are the first of the new ones, with the same types."""
    plain = [(f.name, f.dataType) for f in new]
    return [(f.name, f.dataType) for f in old] == plain[: len(old)]


def _add_columns(spark: SparkSession, table: Table, fields: Sequence[T.StructField]) -> None:
    if fields:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table.sql_name} ADD COLUMNS ({columns})")


def gathered(df: DataFrame, partition_by: Sequence[str], gather: bool = True) -> DataFrame:
    """Gather rows of a table partition, letting Spark split the large ones.

    Without this every task writes a file into every table partition it meets.
    The rebalance hint is adaptive: a month holding a third of the rows is
    divided over many tasks, small months share one.  Rows that come straight
    from a table with the same partitions are gathered already.
    """
    return df.hint("rebalance", *partition_by) if partition_by and gather else df


def overwrite_table(
    df: DataFrame, table: Table, partition_by: Sequence[str] = (), gather: bool = True
) -> None:
    """Replace the table by ``df``; its schema is replaced as well."""
    spark = df.sparkSession
    location = _new_location(table)
    writer = gathered(df, partition_by, gather).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(location)
    if not partition_by:
        _register(spark, table, df, location, partition_by)
        return
    folders = _written(df, location, partition_by)
    if table_exists(spark, table) and partition_columns(spark, table) == list(partition_by):
        old = read_table(spark, table).schema
        value_fields = [f for f in df.schema if f.name not in partition_by]
        old_values = T.StructType([f for f in old if f.name not in partition_by])
        if _fits(old_values, T.StructType(value_fields)):
            _add_columns(spark, table, value_fields[len(old_values) :])
            before = partition_values_of(spark, table)
            gone = [values for values in before if values not in folders]
            _switch_partitions(spark, table, partition_by, folders, gone)
            return
    _register(spark, table, df, location, partition_by)
    _switch_partitions(spark, table, partition_by, folders)


def append_table(df: DataFrame, table: Table) -> None:
    """Append rows.  New columns are added to the table, absent ones read as null."""
    spark = df.sparkSession
    existing = read_table(spark, table).schema
    known = {f.name for f in existing.fields}
    added = [f for f in df.schema.fields if f.name not in known]
    same_type = {
        f.name: F.col(f"`{f.name}`").cast(f.dataType)
        for f in existing.fields
        if f.name in df.columns
    }
    partition_by = partition_columns(spark, table)
    _add_columns(spark, table, added)
    df = df.withColumns(same_type)
    if partition_by:
        # the rows' partitions are made anew with the rows they have, and switched
        touched = partition_values(df, partition_by)
        have = partitions_of(read_table(spark, table), partition_by, touched)
        both = have.unionByName(df, allowMissingColumns=True)
        replace_partitions(both, table, touched)
        return
    df.write.mode("append").parquet(table_location(spark, table))
    spark.catalog.refreshTable(table.sql_name)


def partitions_of(df: DataFrame, columns: Sequence[str], values: Sequence[tuple]) -> DataFrame:
    """Rows of some partitions, by a filter that the scan prunes with."""
    if not values:
        return df.limit(0)
    if len(columns) == 1:
        column = F.col(columns[0])
        named = column.isin([v[0] for v in values if v[0] is not None])
        return df.where(named | column.isNull() if any(v[0] is None for v in values) else named)
    hits = [reduce(and_, [F.col(c).eqNullSafe(F.lit(x)) for c, x in zip(columns, v)]) for v in values]
    return df.where(reduce(or_, hits))


def _with_known_columns(df: DataFrame, known: T.StructType) -> DataFrame:
    """The columns of the table first, null where ``df`` lacks them, then its own."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in known if f.name not in df.columns}
    return df.withColumns(absent).select(
        *[f.name for f in known], *[c for c in df.columns if c not in known.names]
    )


def save_table(
    df: DataFrame,
    table: Table,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    gather: bool = True,
) -> None:
    """Overwrite or append.  Columns are only ever added: those the rows lack are null."""
    exists = table_exists(df.sparkSession, table)
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    if not exists:
        overwrite_table(df, table, partition_by, gather)
    elif mode == "append":
        append_table(df, table)
    else:
        known = read_table(df.sparkSession, table).schema
        overwrite_table(_with_known_columns(df, known), table, partition_by, gather)


def replace_partitions(
    df: DataFrame, table: Table, touched: Iterable[tuple] = (), gather: bool = True
) -> None:
    """Replace the table partitions that occur in ``df``; it may read the table.

    ``touched`` names partitions to empty if ``df`` has no rows of them.  The new files
    are finished in a folder of their own before any partition is re-pointed.
    """
    spark = df.sparkSession
    partition_by = partition_columns(spark, table)
    added = [f for f in df.schema.fields if f.name not in read_table(spark, table).columns]
    location = _new_location(table)
    writer = gathered(df, partition_by, gather).write.mode("errorifexists")
    writer.partitionBy(*partition_by).parquet(location)
    folders = _written(df, location, partition_by)
    _add_columns(spark, table, added)
    gone = [values for values in touched if values not in folders]
    _switch_partitions(spark, table, partition_by, folders, gone)


def create_empty(
    spark: SparkSession, like: DataFrame, table: Table, partition_by: Sequence[str] = ()
) -> None:
    """An empty table with the columns of ``like``; metadata only, nothing is read."""
    _register(spark, table, like, _new_location(table), partition_by)


def register_views(**frames: DataFrame) -> None:
    """Name frames for SQL within the session."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def publish_view(spark: SparkSession, view: Table, query: str) -> None:
    """A lasting view over catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {view.sql_name} AS {query}")
