"""Table reads. Parquet is the default; JDBC reads split on a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver's test tables, one parquet file each.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full-table read; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
              query: str | None = None, **options: str) -> DataFrame:
    """S5 over a database connection: a whole table, split into
    ``num_partitions`` range reads on ``partition_column`` so no single task
    pulls it all, or a ``query`` the database runs itself (pushed down; a
    query is read as a subquery so it can be split the same way)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    source = table if table is not None else f"({query}) AS q"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions)))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()
