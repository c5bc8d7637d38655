"""Models in the catalog: staging as views, the rest as tables that a run replaces."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def materialise(df: DataFrame, name: str, kind: str = "table", partition_by: list[str] | None = None) -> DataFrame:
    """Register a model as ``kind`` "view" (``name`` without database) or "table" (``database.name``), and return
    it as later models should read it.

    Rows of a partitioned table are brought together by partition value first, so a partition is a few files and
    not one per task; the rebalance splits a partition value that holds very many rows.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        database = name.split(".")[0]
        spark.sql(f"create database if not exists `{database}`")
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("overwrite").format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    else:
        raise ValueError(f"unknown kind of model: {kind}")
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str, partition_by: list[str]) -> None:
    """Replace only those partitions of a table that ``df`` has rows for.

    The files are replaced below the table's location, where the writer itself takes the mode, and new partitions are
    then made known to the catalog. No setting of the session is touched, on which other writers may rely.
    """
    spark = df.sparkSession
    spread = df.select(*spark.table(name).columns).hint("rebalance", *partition_by)
    described = spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").first()["data_type"]
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(described)
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def on_partitions(df: DataFrame, column: str, values: list) -> DataFrame:
    """The rows of the given partitions, null among them, as a filter that skips all other files."""
    known = [value for value in values if value is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    return df.filter(wanted | F.col(column).isNull() if None in values else wanted)


def base_tables(spark: SparkSession, databases: list[str]) -> list[str]:
    """``database.table`` of all tables that hold data of their own, sorted; views are left out."""
    found = []
    for database in databases:
        if not spark.catalog.databaseExists(database):
            raise FileNotFoundError(f"no such database: {database}")
        tables = spark.catalog.listTables(database)
        found += [f"{database}.{t.name}" for t in tables if not t.isTemporary and t.tableType in ("MANAGED", "EXTERNAL")]
    return sorted(found)
