"""Databases and external tables in the session's catalog."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from cairn.sources.files import remove_folder

#: Partitions in one statement.
PER_STATEMENT = 500


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{where}")


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: T.StructType,
    path: str,
    partition_by: Sequence[str] = ("region",),
    replace: bool = False,
) -> None:
    """An external Parquet table over a zone, with all its columns. Partitions show after ``repair_table``.

    ``replace`` drops an earlier definition first; the files of an external table stay.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, table)}")
    columns = ", ".join(f"{_quoted(field.name)} {field.dataType.simpleString()}" for field in schema.fields)
    partitions = f" PARTITIONED BY ({', '.join(_quoted(name) for name in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(database, table)} ({columns}) "
        f"USING PARQUET{partitions} LOCATION {_literal(path)}"
    )


def has_table(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(_quoted(database, table))


def repair_table(spark: SparkSession, database: str, table: str) -> None:
    """Makes the catalog know the partitions on disk, and forget those that are gone."""
    spark.sql(f"MSCK REPAIR TABLE {_quoted(database, table)} SYNC PARTITIONS")


Partition = Mapping[str, str | None]


def _specification(partition: Partition) -> str:
    values = [f"{_quoted(name)} = {'NULL' if value is None else _literal(value)}" for name, value in partition.items()]
    return f"PARTITION ({', '.join(values)})"


def add_partitions(spark: SparkSession, database: str, table: str, partitions: Sequence[Partition]) -> None:
    """Makes the catalog know partitions that a write reported. Neither the table's folders nor its other partitions are looked at."""
    for low in range(0, len(partitions), PER_STATEMENT):
        several = " ".join(map(_specification, partitions[low : low + PER_STATEMENT]))
        spark.sql(f"ALTER TABLE {_quoted(database, table)} ADD IF NOT EXISTS {several}")


def drop_partitions(spark: SparkSession, database: str, table: str, partitions: Sequence[Partition]) -> None:
    """Makes the catalog forget partitions; the files of an external table stay."""
    for low in range(0, len(partitions), PER_STATEMENT):
        several = ", ".join(map(_specification, partitions[low : low + PER_STATEMENT]))
        spark.sql(f"ALTER TABLE {_quoted(database, table)} DROP IF EXISTS {several}")


def partition_difference(before: Sequence[Partition], after: Sequence[Partition]) -> tuple[list[Partition], list[Partition]]:
    """Partitions to add and to drop when a write that made ``after`` replaced one that made ``before``."""

    def keys(partitions):
        return {tuple(partition.items()) for partition in partitions}

    added, dropped = keys(after) - keys(before), keys(before) - keys(after)
    return [dict(key) for key in sorted(added, key=repr)], [dict(key) for key in sorted(dropped, key=repr)]


# ---- whole tables replaced at once ----
#
# A table's name is a view over the external table of one version, whose files no other version shares. Replacing the
# view is one entry in the catalog: a reader sees the old rows or the new ones. Who resolved the name before goes on
# with the old files, which stay until ``drop_versions``.


def version_path(zone: str, version: str) -> str:
    return f"{zone.rstrip('/')}/version={version}"


def _version_table(table: str, version: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", version):
        raise ValueError(f"not the name of a version: {version!r}")
    return f"{table}__{version}"


def register_version(
    spark: SparkSession,
    database: str,
    table: str,
    version: str,
    schema: T.StructType,
    zone: str,
    partitions: Sequence[Partition],
    partition_by: Sequence[str] = ("region",),
) -> None:
    """The external table of a version, with the partitions its write reported. Nobody sees it by the table's name yet."""
    name = _version_table(table, version)
    register_table(spark, database, name, schema, version_path(zone, version), partition_by, replace=True)
    if partition_by:
        add_partitions(spark, database, name, partitions)


def switch_version(spark: SparkSession, database: str, table: str, version: str) -> str | None:
    """Lets the table's name show a version, in one step; returns the version it showed before."""
    before = current_version(spark, database, table)
    target = _quoted(database, _version_table(table, version))
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, table)} TBLPROPERTIES ({_literal(VERSION)} = {_literal(version)}) AS SELECT * FROM {target}")
    return before


VERSION = "cairn.version"


def current_version(spark: SparkSession, database: str, table: str) -> str | None:
    """The version a table's name shows; None before the first."""
    try:
        rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(database, table)}").collect()
    except AnalysisException as failure:
        if failure.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            return None
        raise
    return next((row["value"] for row in rows if row["key"] == VERSION), None)


def versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """The versions the catalog knows, in the order of their names."""
    names = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {_quoted(database)} LIKE {_literal(table + '__*')}").collect()]
    return sorted(name.removeprefix(f"{table}__") for name in names)


def drop_versions(spark: SparkSession, database: str, table: str, zone: str, keep: int = 1) -> list[str]:
    """Forgets versions before the current one and removes their files, but for the last ``keep`` of them. Versions after
    the current one may be on their way in, and stay."""
    current = current_version(spark, database, table)
    older = [version for version in versions(spark, database, table) if current is not None and version < current]
    gone = older[: max(0, len(older) - keep)]
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, _version_table(table, version))}")
        remove_folder(spark, version_path(zone, version))
    return gone
