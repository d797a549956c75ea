"""Running totals and positions over one global order, without gathering the order in a task.

Rows are split into ranges on sampled borders (``repartitionByRange``) and written with the number of their range, so
that every later pass sees the same ranges. Each range is totalled, the totals of earlier ranges (a row for each range,
so bounded by the number of ranges, not by the data) are added up on the driver, and a window inside each range adds
the rest. A range holds about rows / ranges rows; values that tie must be made distinct by further order columns, or be
counted per value first, since a range border never splits equal rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from interlog.session import cut_lineage

RANGE = "_range"


def running_totals(df: DataFrame, by: Sequence[str | Column], values: Mapping[str, Column], ranges: int | None = None) -> DataFrame:
    """``df`` with ``name`` = the sum of ``value`` over the rows before a row in the order ``by`` (0 for the first).

    ``ranges`` defaults to the session's shuffle partitions. Null values add nothing; an empty table gives no rows.
    """
    spark = df.sparkSession
    order = [F.col(b) if isinstance(b, str) else b for b in by]
    names = list(values)
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = cut_lineage(df.select("*", *[v.alias(f"_v_{n}") for n, v in values.items()]).repartitionByRange(count, *order)
                        .withColumn(RANGE, F.spark_partition_id()), "ranges")
    totals = split.groupBy(RANGE).agg(*[F.coalesce(F.sum(f"_v_{n}"), F.lit(0)).alias(f"_o_{n}") for n in names])
    before, offsets = [0] * len(names), []
    for row in sorted(totals.collect()):
        offsets.append((row[0], *before))
        before = [a + b for a, b in zip(before, row[1:], strict=True)]
    kinds = StructType([totals.schema[RANGE], *[totals.schema[f"_o_{n}"] for n in names]])
    offsets = [(r, *[float(x) if kinds[i + 1].dataType.typeName() == "double" else x for i, x in enumerate(xs)]) for r, *xs in offsets]
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = split.select(*df.columns, RANGE, *[F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)).alias(f"_i_{n}") for n in names])
    # one row for each range
    joined = summed.join(F.broadcast(spark.createDataFrame(offsets, kinds)), RANGE)
    return joined.select(*df.columns, *[(F.col(f"_i_{n}") + F.col(f"_o_{n}")).alias(n) for n in names])


def positions(df: DataFrame, by: Sequence[str | Column], name: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's place in the order ``by``, from 0."""
    return running_totals(df, by, {name: F.lit(1).cast("long")}, ranges)
