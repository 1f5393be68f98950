"""Running row numbers over a global order, without bringing all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import materialize


def with_row_ids(df: DataFrame, order: list[str | Column], name: str = "id", start: int = 1) -> DataFrame:
    """`df` with a running number in the given order, ties in any order.

    The rows are sorted by range partitions and written; a table of the partitions' sizes, one row for each, is broadcast.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    written = materialize(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    sizes = written.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n") + (start - 1)).alias("__before"))
    within = Window.partitionBy("__part").orderBy(*order)
    return written.withColumn(name, F.row_number().over(within)).join(F.broadcast(before), "__part").withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before")
