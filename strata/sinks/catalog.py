"""Catalog publication: database, tables over written Parquet, read-back checks.

Works on the in-memory catalog and under Hive support alike: tables use the
native ``parquet`` provider, never ``format("hive")``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sinks.files import save_counted, save_parquet
from strata.sources.files import delete_folder, list_entries


def _q(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _path_literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(name)}")
    return name


def _table_type(spark: SparkSession, table: str) -> str | None:
    """``MANAGED``, ``EXTERNAL`` or None when there is no such table."""
    return spark.catalog.getTable(table).tableType if spark.catalog.tableExists(table) else None


def _same_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    have = [(f.name, f.dataType) for f in spark.table(table).schema]
    return have == [(f.name, f.dataType) for f in df.schema]


def save_table(
    df: DataFrame, table: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None
) -> str:
    """Managed catalog table (data copied into the warehouse)."""
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return table


def publish(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    path: str,
    mode: str = "overwrite",
    managed: bool = False,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Publish one frame both as Parquet files and as a catalog table.

    The plan runs once: the Parquet write is the only computation. The table is
    then either an external table over those files (default, no copy) or a
    managed copy made from the written files (``managed=True``), never a second
    run of the lineage. ``partition_by`` lays the files out by those columns so
    readers filtering on them skip whole folders. Returns the published data,
    read back from ``path``.

    An existing table's own data is never dropped: publishing externally over a
    managed table raises. An external table with the same columns is pointed at
    the new files, so readers always find a table; with other columns its entry
    is dropped and made anew (its files stay).
    """
    kind = _table_type(spark, table)
    if kind == "MANAGED" and not managed:
        raise ValueError(f"{table} is a managed table: drop it first, or publish with managed=True")
    save_parquet(df, path, mode=mode, partition_by=partition_by)
    written = spark.read.parquet(path)
    if managed:
        save_table(written, table, mode, partition_by)
        return written
    if kind is not None and mode == "overwrite":
        if _same_columns(spark, table, written) and not partition_by:
            spark.sql(f"ALTER TABLE {_q(table)} SET LOCATION {_path_literal(path)}")
        else:
            spark.sql(f"DROP TABLE {_q(table)}")
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {_q(table)} USING PARQUET LOCATION {_path_literal(path)}")
    if partition_by:
        spark.sql(f"ALTER TABLE {_q(table)} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {_q(table)}")
    return written


def publish_version(spark: SparkSession, df: DataFrame, table: str, root: str, keep: int = 2) -> str:
    """Publish ``df`` as a new version of an external table; returns the version's folder.

    Every version is a fresh folder below ``root``. It is written and its rows counted against what the
    write saw before the catalog is told: one change of the table's location, after which new readers see the
    new version whole. Until then, and if anything fails, the table and its files are as they were, and
    queries already running go on reading the version they began with. The ``keep`` latest versions
    stay; a failed one is removed with the next that succeeds. With other columns than before the
    entry is made anew (the old files stay).
    """
    if _table_type(spark, table) == "MANAGED":
        raise ValueError(f"{table} is a managed table: drop it first")
    path = f"{root.rstrip('/')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows = save_counted(df, path, mode="error")
    written = read_back(spark, path, df.schema, rows)
    if spark.catalog.tableExists(table):
        if _same_columns(spark, table, written):
            spark.sql(f"ALTER TABLE {_q(table)} SET LOCATION {_path_literal(path)}")
        else:
            spark.sql(f"DROP TABLE {_q(table)}")
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {_q(table)} USING PARQUET LOCATION {_path_literal(path)}")
    spark.sql(f"REFRESH TABLE {_q(table)}")
    for old in versions(spark, root)[: -max(1, keep)]:
        delete_folder(spark, old)
    return path


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of the versions below ``root``, the oldest first."""
    names = (n for n, folder in list_entries(spark, root).items() if folder and n.startswith("v"))
    return [f"{root.rstrip('/')}/{n}" for n in sorted(names)]


def external_table(spark: SparkSession, table: str, path: str, schema: StructType | str) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS … USING PARQUET LOCATION`` with a typed column list.

    Declare the types the files hold (e.g. counts as BIGINT): Parquet does not
    widen or narrow on read.
    """
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(table)} ({ddl}) USING PARQUET LOCATION {_path_literal(path)}")
    return spark.table(table)


def read_back(spark: SparkSession, path: str, expected: StructType | None = None, rows: int | None = None) -> DataFrame:
    """Re-open a written sink; raise if its columns differ from ``expected`` (names and types, in any nullability)
    or its rows from ``rows``, the count the write itself saw (Parquet footers answer that, no data is read)."""
    df = spark.read.parquet(path)
    if expected is not None:
        got = [(f.name, f.dataType) for f in df.schema.fields]
        want = [(f.name, f.dataType) for f in expected.fields]
        if got != want:
            raise ValueError(f"schema of {path} differs: {got} != {want}")
    if rows is not None and (found := df.count()) != rows:
        raise ValueError(f"{path} holds {found} rows, {rows} were written")
    return df


def compute_statistics(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> str:
    """Row count, size and column statistics of ``table`` in the catalog (all columns unless named), in one scan.

    With ``spark.sql.cbo.enabled`` and ``spark.sql.cbo.joinReorder.enabled`` the planner orders star joins by them.
    A publication that points the table at new files drops them, so that no plan rests on stale ones.
    """
    what = "FOR COLUMNS " + ", ".join(f"`{c}`" for c in columns) if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {_q(table)} COMPUTE STATISTICS {what}")
    return table


def list_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, type, min_value, max_value, n_null) of every column, as the catalog holds them.

    NULL where there are none: columns not analysed, extremes of strings. Only catalog entries pass through the driver.
    """
    rows = []
    for name in spark.table(table).columns:
        about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {_q(table)} `{name}`").collect()}
        known = {k: None if v in (None, "NULL") else v for k, v in about.items()}
        n_null = known.get("num_nulls")
        rows.append((name, known.get("data_type"), known.get("min"), known.get("max"), None if n_null is None else int(n_null)))
    return spark.createDataFrame(
        rows, "column_name string, type string, min_value string, max_value string, n_null bigint"
    )


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """``SHOW TABLES IN db`` as a frame."""
    return spark.sql(f"SHOW TABLES IN {_q(database)}")


def list_catalog(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """The databases that match ``pattern`` and their tables: (database_name, table_name, table_type, provider, location).

    A database without tables has one row whose table columns are NULL. Only catalog entries pass through the driver.
    """
    rows = []
    for db in spark.catalog.listDatabases(pattern):
        tables = [t for t in spark.catalog.listTables(db.name) if not t.isTemporary]
        if not tables:
            rows.append((db.name, None, None, None, None))
        for t in tables:
            about = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(f'{db.name}.{t.name}')}").collect()
            detail = {r["col_name"]: r["data_type"] for r in about}
            rows.append((db.name, t.name, t.tableType, detail.get("Provider"), detail.get("Location")))
    return spark.createDataFrame(
        rows, "database_name string, table_name string, table_type string, provider string, location string"
    )
