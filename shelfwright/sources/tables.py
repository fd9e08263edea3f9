"""Published tables on disk, a snapshot at a time.

A snapshot is written under new names, and its manifest last: until then readers see the one before, all tables of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwright import schemas
from shelfwright.sources import manifests, ranged

# these tables are stored in ranges of the columns that consumers look up by, with the range of each file beside them
LOOKUP_COLUMNS = {
    "software": ["manufacturer_id", "name"],
    "hardware": ["manufacturer_id", "name"],
    "software_categories": ["category", "software_id"],
    "hardware_categories": ["category", "hardware_id"],
    "software_formats": ["format", "software_id"],
    "software_platforms": ["platform", "software_id"],
}


def write_tables(tables: dict[str, DataFrame], folder: str) -> dict:
    """Full rebuild: every table is written anew, and then becomes visible with all others."""
    last = manifests.current(folder)
    entries = {}
    for name, df in tables.items():
        if name in LOOKUP_COLUMNS:
            entries[name] = ranged.write_ranged(df, folder, name, LOOKUP_COLUMNS[name])
        else:
            path = manifests.new_name(folder, name)
            df.sortWithinPartitions(df.columns[0]).write.parquet(path)
            entries[name] = {"path": path}
    return manifests.commit(folder, {"tables": entries}, last)


def read_tables(spark: SparkSession, folder: str, number: int | None = None) -> dict[str, DataFrame]:
    """All published tables of the last snapshot, or of the one with a number, with their declared schema."""
    entries = manifests.current(folder, number)["tables"]
    return {name: spark.read.schema(schemas.table_schema(name)).parquet(entries[name]["path"]) for name in entries}


def look_up(spark: SparkSession, folder: str, table: str, value: str, prefix: bool = False) -> DataFrame:
    """The rows of a table whose look-up column has a value, or begins with it; only files that may hold one are read."""
    entry = manifests.current(folder)["tables"][table]
    span = ranged.prefix_span(value) if prefix else (value, value)
    key = F.col(LOOKUP_COLUMNS[table][0])
    rows = ranged.read_ranged(spark, entry, [span])
    return rows.where(F.startswith(key, F.lit(value)) if prefix else key == value)


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    report.write.mode("overwrite").json(path)


def write_changes(changes: dict[str, DataFrame], folder: str) -> None:
    """The change-set of one version step, one table of operations per published table."""
    for name, df in changes.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
