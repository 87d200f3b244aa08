"""Samples of real tables with exact quotas per stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from revlens.sources.tables import keep

#: Hashes have 60 bits; a round of counts narrows a range of them by 15.
_BITS, _STEP = 60, 15
#: Rows of a stratum at the border of its sample that one task may sort.
BORDER_ROWS = 1 << 16


def drawn(seed: int, key: str) -> Column:
    """A number from 0 to 2**60 - 1 that depends on seed and key alone."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def stratified(
    df: DataFrame, stratum: str, quotas: DataFrame, key: str, seed: int, border_rows: int = BORDER_ROWS
) -> DataFrame:
    """The rows of ``df`` with the lowest draws, as many per stratum as ``quotas`` says.

    ``quotas`` has the columns ``stratum`` names and ``quota``; quotas of one stratum add
    up. A stratum with fewer rows than its quota gives all of them, one without a quota
    none; null is a stratum like any other. Equal draws go by ``key``, which is unique. The
    same seed gives the same rows in any partitioning.

    No stratum is sorted as a whole. Counts by range of draws say in which range a
    stratum's sample ends, and that range is cut further until few rows are left in it;
    these alone are ranked.
    """
    wanted = quotas.groupBy(F.col(stratum).alias("_stratum")).agg(F.sum("quota").alias("_need"))
    border = keep(wanted.where("_need > 0").withColumn("_low", F.lit(0).cast("long")))
    draws = df.select(F.col(stratum).alias("_of"), drawn(seed, key).alias("_draw"))
    shift = _BITS
    while shift:
        shift -= _STEP
        border = keep(_narrowed(draws, border, shift))
        if (border.agg(F.max("_rows")).first()[0] or 0) <= border_rows:
            break

    names = [c for c in df.columns]
    numbered = df.withColumn("_draw", drawn(seed, key)).join(
        border, F.col(stratum).eqNullSafe(F.col("_stratum"))
    )
    sure = numbered.where("_draw < _low")
    at_border = numbered.where(F.col("_draw").between(F.col("_low"), F.col("_low") + (1 << shift) - 1))
    ranked = at_border.withColumn(
        "_place", F.row_number().over(Window.partitionBy("_stratum").orderBy("_draw", key))
    )
    return sure.select(*names).unionByName(ranked.where("_place <= _need").select(*names))


def _narrowed(draws: DataFrame, border: DataFrame, shift: int) -> DataFrame:
    """The part of a stratum's range in which its sample ends, how many rows it still
    needs from there, and how many are in it. Where rows run out it begins behind all draws."""
    inside = draws.join(border, F.col("_of").eqNullSafe(F.col("_stratum"))).where(
        F.col("_draw").between(F.col("_low"), F.col("_low") + (1 << shift + _STEP) - 1)
    )
    part = F.shiftright(F.col("_draw") - F.col("_low"), shift)
    # Added up in every task before the shuffle: at most 2**15 rows per stratum and task.
    counts = inside.groupBy("_stratum", "_need", "_low", part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_stratum").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    reached = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    ends = reached.where("_before < _need AND _before + _rows >= _need").select(
        F.col("_stratum").alias("_ends"),
        (F.col("_need") - F.col("_before")).alias("_left"),
        (F.col("_low") + F.shiftleft("_part", shift)).alias("_from"),
        "_rows",
    )
    kept = border.select("_stratum", "_need", "_low").join(ends, F.col("_stratum").eqNullSafe(F.col("_ends")), "left")
    return kept.select(
        "_stratum",
        F.coalesce("_left", F.lit(0)).alias("_need"),
        F.coalesce("_from", F.lit(1 << _BITS)).alias("_low"),
        F.coalesce("_rows", F.lit(0)).alias("_rows"),
    )
