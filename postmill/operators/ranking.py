"""Places inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.sources.tables import shared_dir, stored


def numbered(df: DataFrame, group: list[str], order: list[str], place: str = "place") -> DataFrame:
    """`df` with the place of each row in its group, from 1, by the ascending columns of `order` (nulls first).

    The rows are range-partitioned by group and order, so a group with a third
    of all rows lies in many tasks; each (task, group) is numbered by itself and
    shifted by the sizes of the earlier tasks of the group, of which there is
    one row a task and group. Ties are broken at random: give an order without any.
    """
    keys = [*group, *order]
    at = stored(df.repartitionByRange(*keys).withColumn("_task", F.spark_partition_id()), f"{shared_dir(df.sparkSession)}/numbered")
    sizes = at.groupBy(*group, "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_task").alias("_t"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_task") == F.col("_t")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    local = F.row_number().over(Window.partitionBy("_task", *group).orderBy(*order))
    return at.withColumn(place, local).join(sizes, same).withColumn(place, (F.col(place) + F.col("_before")).cast("long")).select(*df.columns, place)
