"""Sweeps over intervals in order, with a group of any size spread over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

REACHED = "reached"
RANGE, LINE = "_range", "_line"


def with_reach(df: DataFrame, group: list[str], order: list[str], end: str) -> DataFrame:
    """Rows with `reached`: the largest `end` among the rows of the group before it in order.

    Rows are cut into ranges of (group, order), so the rows of a group lie in as many tasks as they
    need. Within a range a window runs over a group's rows; what the ranges before bring is a maximum
    for each, of which only the first group of a range needs one. Null group keys are one group.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(*keys).withColumn(RANGE, F.spark_partition_id())
    inside = Window.partitionBy(RANGE, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # written, so that both uses below see the same ranges
    ranged = stored(ranged.withColumn(REACHED, F.max(end).over(inside)))
    across = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = ranged.groupBy(RANGE, *group).agg(F.max(end).alias("_top"))
    carried = carried.withColumn("_carried", F.max("_top").over(across)).where("_carried is not null")
    carried = carried.select(RANGE, F.struct(*group).alias("_group"), "_carried")
    # A group that began in an earlier range is the first of its range: one row a range at most.
    found = ranged.join(F.broadcast(carried), RANGE, "left")
    same = F.struct(*group).eqNullSafe(F.col("_group"))
    reach = F.greatest(REACHED, F.when(same, F.col("_carried")))
    return found.withColumn(REACHED, reach).drop(RANGE, "_group", "_carried")
