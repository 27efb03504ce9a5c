"""Reading the named tables, with deliveries of one record reduced to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table ``name`` of ``folder``: one Parquet file or a folder of them."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def latest(df: DataFrame, key: str, stamp: str, columns: list[str]) -> DataFrame:
    """One row a ``key``: the delivery with the greatest ``stamp``.

    Nulls of ``stamp`` count as oldest; of equal stamps the greatest value of
    ``columns`` stands, so the result doesn't depend on the order of rows. Rows
    without a key are dropped. Columns must be orderable (no maps).
    """
    best = F.max(F.struct(F.col(stamp), *[F.col(c) for c in columns])).alias("_best")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in columns])
