"""Running mean and deviation of long series without one task per series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(keys: Sequence[str], suffix: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}{suffix}")) for k in keys))


def tie_bucket(ties: Sequence[str]) -> Column:
    """Two hex digits that spread the rows of one day; equal rows share a bucket."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ties]
    return F.substring(F.md5(F.concat_ws("|", *text)), 1, 2)


def running_mean_stddev(
    df: DataFrame,
    series: Sequence[str],
    day: str,
    value: str,
    ties: Sequence[str],
    mean_out: str,
    stddev_out: str,
) -> DataFrame:
    """Mean and sample deviation of ``value`` over all rows of the series so far.

    Row order is day, then a hash bucket of the integer columns ``ties``, then
    ``ties``, then the other columns; identical rows follow one another.  The
    deviation of a first row is 0.

    No series is sorted as a whole.  Identical rows travel as one row with a
    count; sums per (series, day, bucket) are aggregated map-side, their running
    sums give every bucket its start, and rows are only ordered inside a bucket.
    """
    columns = df.columns
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    rows = rows.withColumn("__b", tie_bucket(ties))
    # sums of squares lose the deviation of values far from 0, so sums run over the distance
    # from the series' smallest value
    low = rows.groupBy(*[F.col(k).alias(f"{k}__l") for k in series]).agg(F.min(value).alias("__low"))
    rows = rows.join(low, _same(series, "__l")).drop(*[f"{k}__l" for k in series])
    n, v = F.col("__n"), F.col(value) - F.col("__low")
    sums = {"0": n, "1": n * v, "2": n * v * v}

    cell = [*series, day, "__b"]
    totals = rows.groupBy(*cell).agg(*[F.sum(e).alias(f"__t{i}") for i, e in sums.items()])
    earlier = Window.partitionBy(*series).orderBy(day, "__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(c).alias(f"{c}__s") for c in cell],
        *[F.coalesce(F.sum(f"__t{i}").over(earlier), F.lit(0)).alias(f"__p{i}") for i in sums],
    )

    rest = [c for c in columns if c not in cell and c not in ties]
    above = Window.partitionBy(*cell).orderBy(*ties, *rest).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, _same(cell, "__s"))
    for i, e in sums.items():
        placed = placed.withColumn(f"__q{i}", F.col(f"__p{i}") + F.coalesce(F.sum(e).over(above), F.lit(0)))
    copies = placed.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), n)))

    count = F.col("__q0") + F.col("__i")
    s1 = F.col("__q1") + F.col("__i") * v
    s2 = F.col("__q2") + F.col("__i") * v * v
    mean = F.col("__low") + s1 / count
    spread = F.greatest(F.lit(0.0), s2 - s1 * s1 / count)
    deviation = F.when(count > 1, F.sqrt(spread / (count - 1))).otherwise(F.lit(0.0))
    return copies.select(*columns, mean.alias(mean_out), deviation.alias(stddev_out))
