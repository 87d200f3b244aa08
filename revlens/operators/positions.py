"""Numbering the rows of a table, or of a group, whose size has no bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from revlens.sources.tables import keep

_BITS = 16


def with_position(
    df: DataFrame,
    group: str,
    order: list[str],
    first: list[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Adds ``position`` (from 1) and ``group_rows`` to every row of a group.

    ``order[0]`` is an integer, the rest break its ties; rows with a null group
    are left out. A plain ``row_number`` would sort a whole group in one task.
    Here a group is cut into blocks of 2**16 consecutive order values: rows are
    ranked inside their block, and a block's offset is the running sum of the row
    counts of earlier blocks, itself taken over blocks of blocks. So no window
    sees more than 2**16 order values, or 2**16 blocks, or, at the top, one entry
    per 2**32 order values.

    ``first`` names columns whose value in the group's first row is added as
    ``first_<name>``. ``weight`` names an integer column; ``offset``, the sum of the weights
    of all earlier rows, and ``group_weight`` are added in the same way as the counts.
    """
    first = first or []
    # What is added up over blocks, and the names of its start and its total.
    sums = {"_n": ("_start", "group_rows")} | ({"_w": ("_offset", "group_weight")} if weight else {})
    # Never null as an expression: Spark would else add a filter of its own for each
    # join below, and the two readers of the block counts could not share one shuffle.
    block = F.coalesce(F.shiftright(F.col(order[0]).cast("long"), _BITS), F.lit(0))
    rows = df.where(F.col(group).isNotNull()).withColumn("_block", block)
    # A group's first row is the least of its blocks' first rows.
    head = F.struct(*order, *[F.col(c).alias(f"first_{c}") for c in first])
    blocks = (
        rows.groupBy(group, "_block")
        .agg(
            F.count("*").alias("_n"),
            *([F.sum(weight).alias("_w")] if weight else []),
            *([F.min(head).alias("_head")] if first else []),
        )
        .withColumn("_span", F.shiftright("_block", _BITS))
    )
    whole = Window.partitionBy(group)
    so_far = whole.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        blocks.groupBy(group, "_span")
        .agg(
            *[F.sum(n).alias(n) for n in sums], *([F.min("_head").alias("_head")] if first else [])
        )
        .select(
            group,
            "_span",
            *[F.coalesce(F.sum(n).over(so_far), F.lit(0)).alias(f"_span{n}") for n in sums],
            *[F.sum(n).over(whole).alias(total) for n, (_, total) in sums.items()],
            *([F.min("_head").over(whole).alias("_head")] if first else []),
        )
    )
    in_span = Window.partitionBy(group, "_span").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        blocks.withColumns(
            {f"_in{n}": F.coalesce(F.sum(n).over(in_span), F.lit(0)) for n in sums}
        )
        .drop(*sums, "_head")
        .join(spans, [group, "_span"])
        .select(
            group,
            "_block",
            *[(F.col(f"_span{n}") + F.col(f"_in{n}")).alias(start) for n, (start, _) in sums.items()],
            *[total for _, total in sums.values()],
            *[F.col(f"_head.first_{c}").alias(f"first_{c}") for c in first],
        )
    )
    in_block = Window.partitionBy(group, "_block").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(in_block))
    if weight:
        so_far = in_block.rowsBetween(Window.unboundedPreceding, -1)
        ranked = ranked.withColumn("_ahead", F.coalesce(F.sum(weight).over(so_far), F.lit(0)))
    placed = ranked.join(starts, [group, "_block"]).withColumn("position", F.col("_start") + F.col("_rank"))
    if weight:
        placed = placed.withColumn("offset", F.col("_offset") + F.col("_ahead"))
    return placed.drop("_block", "_rank", "_start", "_offset", "_ahead")


def with_rank(df: DataFrame, *order: str, name: str = "rank") -> DataFrame:
    """Adds the place of every row in the order of the whole table, from 0.

    Rows are dealt into sorted ranges, which are written down; a row's rank is its place in its
    range after the rows of earlier ranges. The only window over everything sees one row
    per range. Equal rows have different ranks, in no fixed order.
    """
    ranges = keep(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.withColumn("_place", place)
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + F.col("_place") - 1)
        .drop("_range", "_place", "_start")
    )
