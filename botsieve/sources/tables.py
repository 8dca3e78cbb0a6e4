"""Table sources (S3, S5, S6) and the test-table loader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; parquet, so filters and column pruning reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TEST_TABLES) -> None:
    """Every test table as a temp view for ``spark.sql``."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def jdbc_options(url: str, table_name: str, driver: str | None = None, **extra) -> dict:
    """S3 for a keyed table in an outside database: options for ``spark.read.jdbc``.

    Spark's JDBC source pushes filters, column lists and (through the JDBC
    catalog) aggregates down to the database, which is what a hand-made
    operator handover would do.
    """
    opts = {"url": url, "dbtable": table_name}
    if driver:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, url: str, table_name: str, driver: str | None = None,
              **extra) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table_name, driver, **extra)).load()


def as_view(df: DataFrame, name: str) -> DataFrame:
    """``createOrReplaceTempView`` and read back through the catalog."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_global_view(df: DataFrame, name: str) -> DataFrame:
    """A global temp view (works for streaming DataFrames too), read back
    from ``global_temp``."""
    df.createOrReplaceGlobalTempView(name)
    return df.sparkSession.table(f"global_temp.{name}")
