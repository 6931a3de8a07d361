"""Tables that lie in buckets by a key, so that joins and aggregates by it need no shuffle.

What is joined by the same key again and again (orders, their actions, tickets, interventions,
statuses) is shuffled once, when it is written: each bucket of one table meets the same bucket
of another. The number of buckets has to agree; take it from the largest table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import work_folder

#: Rows of a bucket, about; buckets at most.
ROWS, MOST = 2_000_000, 1 << 15


def buckets_for(*tables: DataFrame, rows: int = ROWS) -> int:
    """A power of two, so that the largest table has about `rows` rows a bucket."""
    largest = max(t.count() for t in tables)
    return min(MOST, 1 << max(0, largest // rows).bit_length())


def bucketed(df: DataFrame, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """df, written in buckets by key and sorted within them, and read again.

    A bucket is one file: rows are dealt to their buckets first. Keys are few to a bucket where
    they are even; a key with very many rows makes its bucket large, as in any plan by that key.
    Without a name the files stay in the shared folder, and the catalog forgets them."""
    spark = df.sparkSession
    table = name or f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    if name is None:
        writer = writer.option("path", str(work_folder(spark, "buckets") / table))
    writer.saveAsTable(table)
    back = spark.table(table)
    if name is None:
        back.count()  # the files are listed now
        spark.sql(f"DROP TABLE {table}")
    return back


def shuffles(df: DataFrame) -> int:
    """How many shuffles by a key a plan has before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line for line in plan.split("\n"))


def without_empty_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows that a join by key can find; null keys would all lie in one bucket."""
    return df.where(F.col(key).isNotNull())


def journey_tables(spark: SparkSession, buckets: int, **tables: DataFrame) -> dict[str, DataFrame]:
    """Tables by order_id in as many buckets each."""
    return {k: bucketed(without_empty_keys(t, "order_id"), "order_id", buckets) for k, t in tables.items()}
