"""The lakehouse tables: bootstrap, read, write, register, query by name or path."""

import math
from collections.abc import Iterable, Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.schemas import (
    BATCHES, BRONZE_STORED, GOLD_AUTHORS, GOLD_BREAKDOWN, GOLD_SKETCHES, GOLD_SUMMARY, GOLD_SUMS,
    LATE, PROGRESS, SILVER_STORED, ddl_columns)
from voxlake.settings import TableLayout

# The signs that Spark escapes in the folder of a partition, besides control characters.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"

PARTITION_COLUMNS = ("batch_id", "event_date", "ingested_date")
DATES_A_TASK = 32  # folders that one task of a write of small dates fills, about


def parts(layout: TableLayout) -> Iterator[tuple[str, T.StructType]]:
    """(path, schema) of the tables that are no table of the catalog: they serve the others."""
    yield layout.sums, GOLD_SUMS
    yield layout.authors, GOLD_AUTHORS
    yield layout.sketches, GOLD_SKETCHES
    yield layout.batches, BATCHES
    yield layout.progress, PROGRESS
    yield layout.late, LATE


def contracts(layout: TableLayout) -> Iterator[tuple[str, str, T.StructType]]:
    """(table name, path, schema) of every table."""
    yield layout.bronze_name, layout.bronze, BRONZE_STORED
    yield layout.silver_name, layout.silver, SILVER_STORED
    yield layout.summary_name, layout.summary, GOLD_SUMMARY
    yield layout.breakdown_name, layout.breakdown, GOLD_BREAKDOWN


def partitioning(schema: T.StructType) -> list[str]:
    """The partition columns of a table; what serves Gold has a folder a batch, not one a date.

    Those tables hold a few short rows of a date, so a file for each would cost far more than its rows.
    """
    serves = "batch_id" in schema.names and "landed_in" not in schema.names
    return [c for c in PARTITION_COLUMNS if c in schema.names and not (serves and c == "event_date")]


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Create an empty table unless one is there."""
    (spark.createDataFrame([], schema).write.format(fmt).mode("ignore")
     .partitionBy(*partitioning(schema)).save(path))


def ensure_tables(spark: SparkSession, layout: TableLayout) -> None:
    for path, schema in [*[c[1:] for c in contracts(layout)], *parts(layout)]:
        ensure_table(spark, path, schema, layout.fmt)


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    # Delta brings its own schema and refuses another
    return (reader if fmt == "delta" else reader.schema(schema)).load(path).select(*schema.names)


def append_table(rows: DataFrame, path: str, fmt: str = "parquet",
                 gathered: bool = False) -> None:
    """Append. `gathered` says that the rows need no shuffle by partition any more."""
    placed = rows if gathered else gather(rows)
    placed.write.format(fmt).mode("append").partitionBy(*partitioning(rows.schema)).save(path)


def overwrite_touched(rows: DataFrame, path: str, fmt: str = "parquet",
                      dates: int | None = None) -> None:
    """Replace the partitions `rows` has data for, leave the others; the same again changes nothing.

    `dates`: about how many there are, if they are small. They are then dealt to tasks by their number,
    as a file takes its time however few rows it has.
    """
    placed = gather(rows) if dates is None else rows.repartition(
        max(1, math.ceil(dates / DATES_A_TASK)), *partitioning(rows.schema))
    (placed.write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitioning(rows.schema))
     .save(path))


def batch_name(batch: str) -> str:
    """A batch's name as it stands in a path; Spark reads the name itself from it.

    Different names never share a folder: a sign that a path cannot hold is escaped, not replaced.
    """
    if not batch:
        raise ValueError("a batch needs a name")
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in batch)


def batch_folder(path: str, batch: str) -> str:
    return f"{path}/batch_id={batch_name(batch)}"


def overwrite_batch(rows: DataFrame, path: str, batch: str, fmt: str = "parquet") -> None:
    """Write the rows of one batch; the same batch again replaces what it wrote before."""
    by = [c for c in partitioning(rows.schema) if c != "batch_id"]
    if fmt == "delta":
        name = batch.replace("'", "''")
        (rows.withColumn("batch_id", F.lit(batch)).write.format(fmt).mode("overwrite")
         .option("replaceWhere", f"batch_id = '{name}'").partitionBy("batch_id", *by).save(path))
    else:
        (rows.drop("batch_id").write.format(fmt).mode("overwrite").partitionBy(*by)
         .save(batch_folder(path, batch)))


def gather(rows: DataFrame) -> DataFrame:
    """Bring the rows of a partition together, for few well-filled files.

    A rebalance, not a repartition: adaptive execution splits a date that is too big for one task.
    """
    return rows.hint("rebalance", *partitioning(rows.schema))


def in_dates(days: Iterable[date]) -> Column:
    """Whether event_date is one of the days: one expression, however many they are."""
    listed = ", ".join(f"DATE'{day}'" for day in sorted(set(days)))
    return F.expr(f"event_date IN ({listed})") if listed else F.lit(False)


def register_tables(spark: SparkSession, layout: TableLayout) -> None:
    """(Re)create the database and its external tables over the table paths.

    The partitions are found in the folder, not kept in the catalog: that holds for folders which
    a stream wrote as well, where its commit log says which files count.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.database} "
              f"LOCATION '{layout.root}/{layout.database}.db'")
    for name, path, schema in contracts(layout):
        table = f"{layout.database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} (\n  {ddl_columns(schema)}\n) "
                  f"USING {layout.fmt} LOCATION '{path}'")


def show_written(spark: SparkSession, layout: TableLayout) -> None:
    """Let queries by name see what has been written since, new dates included."""
    for name, *_ in contracts(layout):
        if spark.catalog.tableExists(f"{layout.database}.{name}"):
            spark.catalog.refreshTable(f"{layout.database}.{name}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def use_database(spark: SparkSession, database: str) -> None:
    """Names without a database mean tables of this one from now on."""
    spark.sql(f"USE {database}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select("namespace", "tableName")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")


def by_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table named by its path, as in SELECT ... FROM parquet.`path`."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")
