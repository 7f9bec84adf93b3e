"""Running counts inside ordered groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import GROUP_ROWS, materialise


def largest_group(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows of the largest group, all rows); the counting is combined map-side."""
    sizes = df.groupBy(*keys).count().agg(F.max("count").alias("top"), F.sum("count").alias("total"))
    row = sizes.first()
    return row["top"] or 0, row["total"] or 0


def running_counts(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    counts: dict[str, Column],
    group_rows: int = GROUP_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Add, per entry of `counts`, how many rows of the group up to and including
    this one satisfy its condition. `order` must be unique inside a group.

    Small groups, counted or known (`bounded`), use one window. If any group exceeds `group_rows`, the rows are
    range-partitioned by (keys, order), which splits large groups over many
    partitions; each slice counts locally and adds the totals of the slices
    before it. The sliced rows are written once, so slice borders cannot differ
    between the two uses.
    """
    flags = {name: cond.cast("bigint") for name, cond in counts.items()}
    top, total = (0, 0) if bounded else largest_group(df, keys)
    if top <= group_rows:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(flag).over(upto).alias(n) for n, flag in flags.items()])

    slices = max(2, -(-2 * total // group_rows))
    sliced = materialise(
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    totals = sliced.groupBy(*keys, "_slice").agg(
        *[F.sum(flag).alias(f"_{n}") for n, flag in flags.items()]
    )
    # one row per slice and key: at most `slices` rows in a window group
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_slice",
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in flags],
    )
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = local.rowsBetween(Window.unboundedPreceding, 0)
    counted = sliced.select("*", *[F.sum(flag).over(local).alias(n) for n, flag in flags.items()])
    joined = counted.join(offsets, [*keys, "_slice"])
    return joined.select(
        *df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in flags]
    )
