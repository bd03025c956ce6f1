"""Small relational building blocks shared by the pipelines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import ratio, strict_greatest

TOPIC_FIELDS = ("parentCategory", "category", "topic", "probability")
TOPICS_TYPE = "array<struct<parentCategory:string,category:string,topic:string,probability:string>>"


def semi(df: DataFrame, other: DataFrame, column: str, other_column: str | None = None) -> DataFrame:
    """Rows whose value is in the other column (``IN``)."""
    values = other.select(F.col(other_column or column).alias("__v"))
    return df.join(values, F.col(column) == F.col("__v"), "left_semi")


def anti(
    df: DataFrame,
    other: DataFrame,
    column: str,
    other_column: str | None = None,
    *,
    null_aware: bool = True,
) -> DataFrame:
    """Rows whose value is not in the other column.

    ``null_aware=True`` follows ``NOT IN (subquery)``: a NULL in the list keeps
    no row at all, and a row with a NULL value is kept only when the list is
    empty.  ``False`` follows ``NOT EXISTS``.

    The NULL rules are settled by a one-row summary of the list (a scalar
    subquery) instead of a null-aware join, which would have to broadcast the
    whole list.
    """
    values = other.select(F.col(other_column or column).alias("__v"))
    kept = df.join(values, F.col(column) == F.col("__v"), "left_anti")
    if not null_aware:
        return kept
    empty = F.count(F.lit(1)) == 0
    no_null = F.count(F.when(F.col("__v").isNull(), 1)) == 0
    state = values.agg(F.when(empty, "empty").when(no_null, "plain").otherwise("null")).scalar()
    return kept.filter((state == "empty") | ((state == "plain") & F.col(column).isNotNull()))


def mark_shared(
    df: DataFrame, column: str, shared: DataFrame, shared_column: str = "domain", mark: str = "Shared"
) -> DataFrame:
    """Replace domains on the list of shared hosts by the marker the maps leave out."""
    listed = shared.select(F.col(shared_column).alias("__s")).distinct()
    on_list = F.col("__s").isNotNull()
    return (
        df.join(listed, F.col(column) == F.col("__s"), "left")
        .withColumn(column, F.when(on_list, mark).otherwise(F.col(column)))
        .drop("__s")
    )


def topics_from_json(text: Column) -> Column:
    """JSON list of topic objects as an array of structs."""
    return F.from_json(text, TOPICS_TYPE)


def flatten_topics(
    df: DataFrame, array_col: str, keep: Sequence[str] = ("page_url",), *, one_row_per_key: bool = False
) -> DataFrame:
    """One row per distinct topic object of each page.

    Duplicates inside a row are removed before the explode.  When ``keep``
    identifies the row (``one_row_per_key``) that is already the distinct
    result and no shuffle is needed.
    """
    distinct = F.array_distinct(F.col(array_col))
    out = df.select(*keep, F.explode(distinct).alias("__t")).select(
        *keep,
        F.col("__t.parentCategory").alias("parent_category"),
        F.col("__t.category").alias("category"),
        F.col("__t.topic").alias("topic"),
        F.col("__t.probability").alias("probability"),
    )
    return out if one_row_per_key else out.distinct()


def share_of_total(
    df: DataFrame,
    group: str,
    value: str,
    out: str,
    *,
    floor: float | None = None,
    guard_zero: bool = True,
    scale: int = 10,
) -> DataFrame:
    """Add ``value / sum(value) per group`` with an optional floor.

    The totals are aggregated (map-side first) and joined back, so one huge
    group is never sorted or held in one task as a window would.  A zero total
    gives 0 with ``guard_zero`` and NULL without.  The share is rounded to
    ``scale`` digits, which makes it independent of summation order.
    """
    totals = df.groupBy(F.col(group).alias("__g")).agg(F.sum(value).alias("__total"))
    share = ratio(F.col(value), F.col("__total"))
    if guard_zero:
        share = F.when(F.col("__total") == 0, F.lit(0.0)).otherwise(share)
    share = F.round(share, scale)
    if floor is not None:
        share = strict_greatest(F.lit(floor), share)
    return (
        df.join(totals, F.col(group) == F.col("__g"))
        .withColumn(out, share)
        .drop("__g", "__total")
    )


def high_water_mark(target: DataFrame, date_col: str, default: dt.date) -> dt.date:
    """Latest day in the target, or the default for an empty one (a one-row job)."""
    return target.agg(F.max(date_col).cast("date").alias("m")).first()["m"] or default


def slice_start(
    source: DataFrame, date_col: str, mark: dt.date, days: int, *, inclusive: bool = False
) -> dt.date:
    """The mark, or one day before the next row if the slice from the mark would be empty.

    A gap in the data longer than a slice would otherwise never be passed (a one-row job).
    """
    day = F.col(date_col)
    later = day >= F.lit(mark) if inclusive else day > F.lit(mark)
    first = source.filter(later).agg(F.min(date_col).cast("date").alias("m")).first()["m"]
    if first is None or first <= mark + dt.timedelta(days=days):
        return mark
    return first - dt.timedelta(days=1)


def incremental_slice(
    source: DataFrame,
    date_col: str,
    mark: dt.date,
    days: int,
    *,
    inclusive: bool = False,
) -> DataFrame:
    """Source rows after the mark and at most ``days`` past it.

    The mark is a literal, so the filter reaches the scan and prunes partitions.
    """
    day = F.col(date_col)
    after = day >= F.lit(mark) if inclusive else day > F.lit(mark)
    return source.filter(after & (day <= F.lit(mark + dt.timedelta(days=days))))


def quality_check(
    df: DataFrame, unique: Sequence[str] = (), not_null: Sequence[str] = ()
) -> DataFrame:
    """Failures per check: repeated values for ``unique``, NULLs for ``not_null``."""
    parts = []
    for c in unique:
        repeated = df.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1")
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit("unique").alias("check"), F.lit(c).alias("column_name"), "failures"
            )
        )
    if not_null:
        # all NULL counts come from one scan
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{k}") for k, c in enumerate(not_null)])
        found = [
            F.struct(
                F.lit("not_null").alias("check"), F.lit(c).alias("column_name"), F.col(f"n{k}").alias("failures")
            )
            for k, c in enumerate(not_null)
        ]
        parts.append(counts.select(F.inline(F.array(*found))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ordered_limit(
    df: DataFrame, n: int, rank: str, key: str, *, descending: bool = True
) -> DataFrame:
    """First ``n`` rows by ``rank`` (a day column), ties in a fixed random order of ``key``.

    ``orderBy().limit()`` sends up to ``n`` rows of every partition to one task,
    which is fine for thousands and not for millions.  Here the rows are counted
    per (rank, key-hash prefix); whole cells are kept until ``n`` is reached and
    only the one cell on the border is numbered.  ``key`` should be unique.
    """
    # a NULL key is hashed as an empty one, so that its rows find their cell
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    cells = df.withColumn("__b", F.substring(digest, 1, 3))
    counts = cells.groupBy(F.col(rank).alias("__r"), "__b").agg(F.count(F.lit(1)).alias("__n"))
    order = F.col("__r").desc_nulls_last() if descending else F.col("__r").asc_nulls_last()
    days = counts.groupBy("__r").agg(F.sum("__n").alias("__day_n"))
    days = days.select(
        F.col("__r").alias("__dr"),
        (F.sum("__day_n").over(Window.orderBy(order)) - F.col("__day_n")).alias("__day_before"),
    )
    days = days.filter(F.col("__day_before") < n)
    inside = Window.partitionBy("__r").orderBy("__b")
    plan = (
        counts.join(days, F.col("__r").eqNullSafe(F.col("__dr")))
        .select(
            "__r",
            F.col("__b").alias("__pb"),
            "__n",
            (F.col("__day_before") + F.sum("__n").over(inside) - F.col("__n")).alias("__before"),
        )
        .filter(F.col("__before") < n)
    )
    picked = cells.join(plan, F.col(rank).eqNullSafe(F.col("__r")) & (F.col("__b") == F.col("__pb")))
    fits = F.col("__before") + F.col("__n") <= n
    whole = picked.filter(fits)
    border = picked.filter(~fits).withColumn(
        "__i", F.row_number().over(Window.partitionBy("__r", "__b").orderBy(digest, F.col(key)))
    )
    border = border.filter(F.col("__before") + F.col("__i") <= n)
    return whole.select(*df.columns).unionByName(border.select(*df.columns))
