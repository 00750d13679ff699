"""Table scans and catalog helpers: provided Parquet tables, the source
database (JDBC, partitioned reads), replica tables, literal rows and SQL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.spec import TableSpec


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One provided table. Selecting columns here lets the Parquet scan prune."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_source(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
                lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
                properties: dict | None = None, fmt_fallback: str | None = None) -> DataFrame:
    """Scan the source database table.

    With ``partition_column`` the JDBC read is split into ``num_partitions``
    range queries so the scan runs on many executors instead of one
    connection; missing bounds are read from the table (min/max). ``url`` may also be a Parquet path (the offline twin used in
    tests, where no database runs): then it is read as Parquet.
    """
    if not url.startswith("jdbc:"):
        return spark.read.format(fmt_fallback or "parquet").load(url)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower is None or upper is None:
            # One tiny query for the split bounds (a single row of metadata).
            probe = spark.read.format("jdbc").option("url", url).option(
                "dbtable", f"(SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {table}) b")
            for k, v in (properties or {}).items():
                probe = probe.option(k, v)
            b = probe.load().first()
            lower = b["lo"] if lower is None else lower
            upper = b["hi"] if upper is None else upper
            if lower is None or upper is None:      # empty table: a single unpartitioned read
                return reader.load()
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def read_replica(spark: SparkSession, path_or_table: str) -> DataFrame:
    """A replica table by catalog name or by Parquet path."""
    if "/" in path_or_table or ":" in path_or_table:
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)


def scan(df: DataFrame, limit: int | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """``SELECT * ... [ORDER BY key] LIMIT n``; a key order makes LIMIT deterministic
    and plans as a distributed top-k (TakeOrderedAndProject)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(limit) if limit is not None else df


def init_tables(spark: SparkSession, specs: Iterable[TableSpec], database: str = "replica",
                location: str | None = None) -> list[str]:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` for each spec (Parquet tables with
    the typed columns plus ``_ts`` and ``_pos``)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    made = []
    for spec in specs:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.typed_columns().fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{spec.name} ({cols}, _ts BIGINT, _pos BIGINT) USING parquet")
        made.append(f"{database}.{spec.name}")
    return made


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``SHOW TABLES`` as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table if the catalog has it, else ``None`` (callers show a notice)."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def rows(spark: SparkSession, schema: T.StructType | str, values: list[tuple]) -> DataFrame:
    """Literal rows (``VALUES``) with an explicit schema; NULLs allowed."""
    return spark.createDataFrame(values, schema=schema)


def sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over named DataFrames. Returns a lazy DataFrame (never collected)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)
