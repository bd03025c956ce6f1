"""Merge, insert-only merge, delete, and stored tables: NULL keys, duplicates, reruns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidemark.operators import apply_changes, change_set, delete_matching, insert_new, upsert
from tidemark.sources import load_table, save_table, table_exists

SCHEMA = "k string, g string, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_upsert_updates_and_inserts(spark):
    t = frame(spark, ("a", "x", 1), ("b", "x", 2))
    s = frame(spark, ("b", "x", 10), ("c", "x", 20))
    out = upsert(t, s, ["k"], {"v": F.col("t.v") + F.col("s.v")})
    assert rows(out) == [("a", "x", 1), ("b", "x", 12), ("c", "x", 20)]


def test_upsert_null_keys(spark):
    t = frame(spark, (None, "x", 1), ("a", None, 2))
    s = frame(spark, (None, "x", 10), ("a", None, 20))
    plain = upsert(t, s, ["k", "g"], ["v"])
    assert rows(plain) == [(None, "x", 1), (None, "x", 10), ("a", None, 2), ("a", None, 20)]
    safe = upsert(t, s, ["k", "g"], ["v"], null_safe=["k", "g"])
    assert rows(safe) == [(None, "x", 10), ("a", None, 20)]


def test_upsert_overwrite_is_idempotent(spark):
    t = frame(spark, ("a", "x", 1))
    s = frame(spark, ("a", "x", 5), ("b", "y", 6))
    once = upsert(t, s, ["k"], ["g", "v"])
    assert rows(upsert(once, s, ["k"], ["g", "v"])) == rows(once)


def test_upsert_ambiguous_source_fails_only_on_a_match(spark):
    s = frame(spark, ("a", "x", 5), ("a", "y", 6))
    with pytest.raises(Exception, match="several source rows"):
        upsert(frame(spark, ("a", "x", 1)), s, ["k"], ["v"]).collect()
    assert len(upsert(frame(spark, ("b", "x", 1)), s, ["k"], ["v"]).collect()) == 3


@pytest.mark.parametrize("insert_missing", [True, False])
def test_upsert_ambiguity_shows_in_any_use(spark, insert_missing):
    s = frame(spark, ("a", "x", 5), ("a", "y", 6))
    out = upsert(frame(spark, ("a", "x", 1)), s, ["k"], ["v"], insert_missing=insert_missing)
    for use in (out.select("v"), out.select("g"), out.select("k"), out.groupBy().count()):
        with pytest.raises(Exception, match="several source rows"):
            use.collect()


def test_upsert_changes_every_matching_target_row(spark):
    t = frame(spark, ("a", "x", 1), ("a", "y", 2))
    assert rows(upsert(t, frame(spark, ("a", "z", 9)), ["k"], ["v"])) == [("a", "x", 9), ("a", "y", 9)]


def test_upsert_update_only_and_insert_expression(spark):
    t = frame(spark, ("a", "x", 1))
    s = frame(spark, ("a", "z", 9), ("b", "z", 8))
    assert rows(upsert(t, s, ["k"], ["v"], insert_missing=False)) == [("a", "x", 9)]
    out = upsert(t, s.drop("g"), ["k"], ["v"], {"v": F.col("s.v") * 2})
    assert rows(out) == [("a", "x", 9), ("b", None, 16)]


def test_insert_new_keeps_source_duplicates_and_null_rule(spark):
    t = frame(spark, ("a", "x", 1), (None, "x", 1))
    s = frame(spark, ("a", "x", 7), ("b", "x", 7), ("b", "x", 7), (None, "x", 7))
    assert rows(insert_new(t, s, ["k"])) == [
        (None, "x", 1), (None, "x", 7), ("a", "x", 1), ("b", "x", 7), ("b", "x", 7),
    ]
    assert len(insert_new(t, s, ["k"], null_safe=["k"]).collect()) == 4


def test_insert_new_target_filter_and_idempotence(spark):
    t = frame(spark, ("a", "old", 1))
    s = frame(spark, ("a", "new", 7))
    once = insert_new(t, s, ["k"], target_filter=F.col("g") == "new")
    assert len(once.collect()) == 2
    assert rows(insert_new(once, s, ["k"], target_filter=F.col("g") == "new")) == rows(once)


def test_delete_matching(spark):
    t = frame(spark, ("a", None, 1), ("b", "x", 2), (None, "x", 3))
    d = frame(spark, ("a", None, 0), (None, "x", 0))
    assert rows(delete_matching(t, d, ["k"])) == [(None, "x", 3), ("b", "x", 2)]
    assert rows(delete_matching(t, d, ["k", "g"], null_safe=["k", "g"])) == [("b", "x", 2)]


def test_state_plans_have_no_nested_loops(spark):
    t, s = frame(spark, ("a", "x", 1)), frame(spark, ("a", "y", 2))
    for df in (
        upsert(t, s, ["k", "g"], ["v"], null_safe=["g"]),
        insert_new(t, s, ["k", "g"], null_safe=["g"]),
        delete_matching(t, s, ["k", "g"], null_safe=["g"]),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_null_keys_do_not_share_one_hash(spark):
    """Rows that cannot match are spread over the join's partitions."""
    many = spark.range(1000).select(
        F.when(F.col("id") < 0, "z").alias("k"), F.lit("x").alias("g"), F.col("id").cast("int").alias("v")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = upsert(many, frame(spark, ("a", "x", 1)), ["k"], ["v"])
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 600


def test_save_table_replace_append_empty(spark, tmp_path):
    root = str(tmp_path / "t")
    assert not table_exists(spark, root)
    assert load_table(spark, root, SCHEMA).count() == 0
    first = save_table(frame(spark, ("a", "x", 1)), root)
    # the table is read while it is replaced
    second = save_table(first.withColumn("v", F.col("v") + 1), root)
    assert rows(second) == [("a", "x", 2)] and rows(first) == [("a", "x", 1)]
    assert save_table(frame(spark, ("b", "y", 3)), root, "append").count() == 2
    assert save_table(second, root, "empty").count() == 0
    with pytest.raises(ValueError):
        save_table(second, root, "other")


def test_incomplete_version_is_ignored(spark, tmp_path):
    root = tmp_path / "t"
    save_table(frame(spark, ("a", "x", 1)), str(root))
    (root / "version=2").mkdir()
    (root / "version=2" / "part-0.parquet").write_bytes(b"half a file")
    assert rows(load_table(spark, str(root))) == [("a", "x", 1)]
    assert rows(save_table(frame(spark, ("b", "x", 2)), str(root))) == [("b", "x", 2)]


def test_dates_survive(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date")
    assert rows(save_table(df, str(tmp_path / "d"))) == [(dt.date(2024, 1, 1),)]


@pytest.mark.parametrize("null_safe", [(), ("g",)])
def test_merge_shuffles_each_side_once(spark, tmp_path, null_safe):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = save_table(frame(spark, ("a", "x", 1), ("b", None, 2)), str(tmp_path / "t"))
        s = save_table(frame(spark, ("a", "y", 2), ("b", None, 3)), str(tmp_path / "s"))
        out = upsert(t, s, ["k", "g"], ["v"], null_safe=null_safe)
        assert plan(out).count("Exchange hashpartitioning") == 2
        assert len(out.collect()) == (3 if null_safe else 4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("drop", [False, True])
def test_change_set_equals_merge(spark, drop):
    target = frame(spark, ("a", "x", 1), ("b", "x", 2), (None, "x", 3), ("c", None, None))
    source = frame(spark, ("a", "x", 1), ("b", "y", 5), (None, "z", 6), ("d", "w", 7), ("c", None, None))
    updates, inserts = change_set(target, source, ["k"], ["g", "v"], drop_null_keys=drop)
    # rows that stay as they are are not written
    assert rows(updates) == [("b", "y", 5)]
    assert rows(inserts) == ([] if drop else [(None, "z", 6)]) + [("d", "w", 7)]
    want = upsert(target, source.dropna(subset=["k"]) if drop else source, ["k"], ["g", "v"])
    assert rows(apply_changes(target, updates, inserts, ["k"])) == rows(want)
