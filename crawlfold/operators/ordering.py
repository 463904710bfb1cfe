"""Numbers in a global order without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlfold.session import written


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """`rows`, stored sorted by `order`, with a number without gaps from 0 as `name`.

    One range shuffle; the counts of its partitions, one small row each whatever the data, give
    the numbers. The order should end in something close to unique: a value that many rows
    share in full keeps them in one partition.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = written(
        rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    place = stored.withColumn("_part", F.shiftright("_at", 33))
    counts = place.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = written(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return place.join(F.broadcast(offsets), "_part").withColumn(name, number).drop("_part", "_at", "_before")
