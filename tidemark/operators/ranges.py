"""Matching addresses to numeric ranges without a nested-loop join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cell sizes tried for an address: 2^0, 2^4, ... 2^16.
STEP = 4
LEVELS = tuple(range(0, 17, STEP))


def _level(lo: Column, hi: Column) -> Column:
    """Smallest level whose cell is at least as wide as the range, or the largest level."""
    span = hi - lo
    bits = F.when(span == 0, F.lit(0)).otherwise(F.length(F.bin(span)))
    return F.least(F.ceil(bits / STEP) * STEP, F.lit(LEVELS[-1])).cast("int")


def ip_range_join(
    df: DataFrame,
    ip_number: str,
    ranges: DataFrame,
    start: str = "ip_range_start_numeric",
    end: str = "ip_range_end_numeric",
) -> DataFrame:
    """Rows of ``df`` with every range that holds their address (inner join).

    Each range is filed at the one grid level where it touches at most two
    cells, and each address is looked up once per level, so the join is a plain
    equi-join.  Wider ranges are filed in all their cells of the largest level, at
    most 65,536 of them for IPv4 numbers; so no cell has more than 65,536
    addresses.  In a cell an address only meets ranges of about the cell's own
    width or wider: disjoint ranges give a small constant number of candidates whatever
    the size of the file, and nested or overlapping ranges are all kept.
    Pass distinct addresses where possible; rows are repeated once per level.
    """
    lo, hi = F.col(start), F.col(end)
    filed = (
        ranges.filter(lo <= hi)
        .withColumn("__level", _level(lo, hi))
        .withColumn(
            "__cell",
            F.explode(F.expr(f"sequence(shiftright(`{start}`, __level), shiftright(`{end}`, __level))")),
        )
    )
    looked_up = (
        df.filter(F.col(ip_number).isNotNull())
        .withColumn("__level", F.explode(F.array(*[F.lit(level) for level in LEVELS])))
        .withColumn("__cell", F.expr(f"shiftright(`{ip_number}`, __level)"))
    )
    return (
        looked_up.join(filed, ["__level", "__cell"])
        .filter(F.col(ip_number).between(lo, hi))
        .drop("__level", "__cell")
    )
