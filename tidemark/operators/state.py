"""Table state as pure functions: merge, insert-only merge, delete.

Parquet tables have no MERGE or DELETE, so each operator takes the current
table, or the partitions of it that a source touches, and returns the next
content; ``tidemark.sources.Warehouse`` reads and overwrites those partitions only.

Keys listed in ``null_safe`` match NULL with NULL.  On the other keys a NULL
never matches, so such rows stay in the target and are inserted again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPREAD = "__spread"
_COPIES = "__copies"
_SEEN = "__seen"


def _all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _nullable(dtype: T.DataType) -> T.DataType:
    """The type with NULLs allowed inside, so that casts only change values."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_nullable(dtype.elementType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype.fields])
    return dtype


def _key_match(left: str, right: str, keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    conds = []
    for k in keys:
        a, b = F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
        conds.append(a.eqNullSafe(b) if k in null_safe else a == b)
    return _all_of(conds)


def _spread_unmatchable(df: DataFrame, keys: Sequence[str], null_safe: Sequence[str]) -> DataFrame:
    """Add a join column that scatters rows whose key can never match.

    All NULL keys hash alike, and a full outer join cannot be split by the
    adaptive skew rule; giving those rows a content hash keeps them off one task.
    """
    strict = [k for k in keys if k not in null_safe]
    if not strict:
        return df.withColumn(_SPREAD, F.lit(0).cast("bigint"))
    unmatchable = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in strict))
    return df.withColumn(_SPREAD, F.when(unmatchable, F.xxhash64(*df.columns)).otherwise(F.lit(0)))


def _join_columns(
    df: DataFrame, keys: Sequence[str], null_safe: Sequence[str], co_located: bool = False
) -> tuple[DataFrame, list[str]]:
    """Columns that compare plainly: a NULL-safe key becomes its text and a NULL mark.

    Spark would rewrite ``<=>`` in the join alone, and then shuffle the output of
    the key window once more.
    """
    if co_located:
        return df, list(keys)
    df = _spread_unmatchable(df, keys, null_safe)
    names = [_SPREAD]
    for k in keys:
        if k in null_safe:
            df = df.withColumns(
                {
                    f"__text_{k}": F.coalesce(F.col(k).cast("string"), F.lit("")),
                    f"__null_{k}": F.col(k).isNull(),
                }
            )
            names += [f"__text_{k}", f"__null_{k}"]
        else:
            names.append(k)
    return df, names


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | Mapping[str, Column] = (),
    insert: Mapping[str, Column] | None = None,
    *,
    null_safe: Sequence[str] = (),
    insert_missing: bool = True,
    unique_source: bool = False,
    co_located: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target``: change matched rows, add the others.

    ``update`` is a list of columns to overwrite, or column -> expression over
    ``t.<col>`` and ``s.<col>``.  ``insert`` gives expressions over ``s.<col>``
    for new rows; columns it does not name come from the source column of the
    same name, or are NULL.  A target row matched by several source rows is an
    error, whichever columns are used: the check is a filter that passes every
    row or fails.  ``unique_source=True`` skips it where the source is grouped by
    the keys already.

    ``co_located=True`` joins on the keys alone, so a target stored in buckets of
    them is not shuffled; rows with a NULL key then meet in one task.
    """
    if co_located and null_safe:
        raise ValueError("co-located keys compare plainly")
    if not isinstance(update, Mapping):
        update = {c: F.col(f"s.{c}") for c in update}
    columns = target.columns
    # the key window below uses the partitioning and order the join needs anyway
    t, on = _join_columns(target, keys, null_safe, co_located)
    s, _ = _join_columns(source, keys, null_safe, co_located)
    t, s = t.withColumn(_SEEN, F.lit(True)), s.withColumn(_SEEN, F.lit(True))
    if unique_source:
        s = s.withColumn(_COPIES, F.lit(1))
    else:
        s = s.withColumn(_COPIES, F.count(F.lit(1)).over(Window.partitionBy(*on)))
    both = t.alias("t").join(
        s.alias("s"), _key_match("t", "s", on, ()), "full" if insert_missing else "left"
    )
    old = F.col(f"t.{_SEEN}").isNotNull()
    matched = old & F.col(f"s.{_SEEN}").isNotNull()
    if not unique_source:
        several = F.raise_error(F.lit("merge: several source rows match one target row"))
        ambiguous = matched & (F.col(f"s.{_COPIES}") > 1)
        both = both.filter(F.when(ambiguous, several.cast("boolean")).otherwise(F.lit(True)))
    insert = insert or {}

    def fresh(c: str) -> Column:
        if c in insert:
            return insert[c]
        return F.col(f"s.{c}") if c in source.columns else F.lit(None)

    out = []
    for c in columns:
        dtype = _nullable(target.schema[c].dataType)
        changed = update.get(c, F.col(f"t.{c}"))
        value = F.when(matched, changed.cast(dtype)).when(old, F.col(f"t.{c}"))
        if insert_missing:
            value = value.otherwise(fresh(c).cast(dtype))
        out.append(value.alias(c))
    return both.select(*out)


def insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    *,
    null_safe: Sequence[str] = (),
    target_filter: Column | None = None,
    only_new: bool = False,
) -> DataFrame:
    """Insert-only merge: add every source row whose key the target lacks.

    ``only_new`` returns the added rows alone, to be appended to the stored target.

    ``target_filter`` narrows the target rows that count as present (a merge
    condition on a constant).  Target columns the source lacks become NULL.
    """
    present = target if target_filter is None else target.filter(target_filter)
    fresh = source.alias("s").join(
        present.select(*keys).alias("t"), _key_match("s", "t", list(keys), null_safe), "left_anti"
    )
    rows = fresh.select(
        *[
            (F.col(c) if c in source.columns else F.lit(None)).cast(_nullable(target.schema[c].dataType)).alias(c)
            for c in target.columns
        ]
    )
    return rows if only_new else target.unionByName(rows)


def change_set(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    *,
    drop_null_keys: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """What merging ``source`` (one row a key) changes: the new form of changed rows, and new rows.

    Rows that would stay as they are belong to neither.  A NULL key never matches, so its row is new;
    ``drop_null_keys`` leaves such rows out.  Columns that the source lacks are NULL in new rows.
    """
    if drop_null_keys:
        source = source.dropna(subset=list(keys))
    inserts = insert_new(target, source, keys, only_new=True)
    both = target.alias("t").join(source.alias("s"), _key_match("t", "s", keys, ()))
    differs = reduce(lambda a, b: a | b, (~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in update))
    updates = both.filter(differs).select(
        *[(F.col(f"s.{c}").cast(_nullable(target.schema[c].dataType)) if c in update else F.col(f"t.{c}")).alias(c) for c in target.columns]
    )
    return updates, inserts


def apply_changes(target: DataFrame, updates: DataFrame, inserts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after a ``change_set``."""
    return delete_matching(target, updates, keys).unionByName(updates).unionByName(inserts)


def delete_matching(
    target: DataFrame, doomed: DataFrame, keys: Sequence[str], *, null_safe: Sequence[str] = ()
) -> DataFrame:
    """Target rows whose key does not occur in ``doomed``."""
    return target.alias("t").join(
        doomed.select(*keys).alias("d"), _key_match("t", "d", keys, null_safe), "left_anti"
    )
