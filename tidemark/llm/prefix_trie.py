"""Prefix trie of conversations: which turns are shared, by how many, and what that saves.

A turn's role and text have an id of fixed width (128 bits of SHA-256, big-endian), so a conversation
is a key of whole turns.  Keys are range-sorted with their conversation's number, so a task holds
neighbouring keys, and a conversation that many others repeat is shared by several tasks.  Each task
builds an adaptive radix tree (``radix_tree``) and reports its nodes.  Nodes on the way to a task's
first and last key may have members in other tasks: their parts are added in one pass over these
ways, which are as many as there are tasks; that pass keeps one way at a time.

Null roles and texts are empty texts.  Turns stand in the order of their number, null first; turns
of equal number in that of role and id, and repeated rows are turns of their own.  Rows without a
conversation belong to none and are left out.  An empty table gives no node, not even a root.  The
ids and word counts of one conversation must fit into a task, not its texts.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, rows_of, stored
from tidemark.llm.radix_tree import RadixTree, names_digest

#: Bytes of a turn's id.
WIDTH = 16
#: Turns of a task, about.
TASK_TURNS = 100_000
#: Words of a turn.
WORD = r"[^\x20\x09-\x0D]+"

#: Parts of the trie as the tasks report them: 0 whole nodes, 1 open nodes, 2 names that end at these.
_PART = (
    "kind int, task int, side int, shared boolean, depth bigint, ref string, parent_ref string, conv_id bigint, "
    "parent_conv_id bigint, n_convs bigint, words bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
_NAMES = [field.split()[0] for field in _PART.split(", ")]
_TYPES = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[field.split()[1]] for field in _PART.split(", ")]
_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as structs of ``id`` (hex) and ``words``."""
    rows = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text).filter("conv_id is not null")
    role_of, text_of = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role keeps it apart from the text
    said = F.concat(F.octet_length(role_of).cast("string"), F.lit(":"), role_of, text_of)
    each = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role_of.alias("role"),
        F.substring(F.sha2(said.cast("binary"), 256), 1, 2 * WIDTH).alias("id"),
        F.regexp_count(text_of, F.lit(WORD)).cast("long").alias("words"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "id", "words")))
    return each.groupBy("conv_id").agg(ordered.alias("all")).select(
        "conv_id", F.transform("all", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")
    )


def spliced(conversations: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first turns taken from the one whose number opens its block.

    Of c, the first ``crc32(c) % most`` turns are those of conversation ``c - c % every``, none if
    it is absent; the other turns are its own.  Negative numbers have a negative remainder.
    """
    heads = conversations.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("block"), F.slice("turns", 1, most - 1).alias("head")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = conversations.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("block"), "left")
    head = F.coalesce("head", F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(F.slice(head, F.lit(1), taken), F.slice("turns", taken + 1, F.size("turns"))).alias("turns"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one task's keys, which come in order, in parts."""
    task, tree = TaskContext.get().partitionId(), RadixTree(WIDTH)
    for batch in rows_of(batches):
        for name, key, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "words")), strict=True):
            tree.add(key, name, words)
    if tree.first is None:
        return
    refs = [_refs(key) for key in (tree.first, tree.last)]
    rows: list[tuple] = []
    for node in tree.nodes():
        above, opened = node["above"], node["open"]
        parent = above[1] if above and above[0] == "closed" else None
        parent_ref = refs[above[1]][above[2]] if above and above[0] == "open" else None
        ref = refs[opened[1]][opened[2]] if opened else None
        if opened:
            rows += [(2, task, None, None, None, ref, None, name, *[None] * 7) for name in node["ends"]]
        rows.append((
            int(bool(opened)), task, opened[1] if opened else None, node["shared"], node["depth"], ref, parent_ref, node["least"], parent,
            node["count"], node["words"], node["children"], node["leaves"], node["saved"], None if opened else names_digest(node["ends"]),
        ))
        if len(rows) >= 4096:
            yield _batch(rows, _TYPES, _NAMES)
            rows = []
    if rows:
        yield _batch(rows, _TYPES, _NAMES)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _refs(key: bytes) -> list[str]:
    """Names of all nodes on the way to a key, by depth."""
    seen = hashlib.sha256()
    out = [seen.hexdigest()]
    for at in range(0, len(key), WIDTH):
        seen.update(key[at : at + WIDTH])
        out.append(seen.hexdigest())
    return out


def _join_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes of all tasks, in the order of task, side and depth: one row for each node.

    The stack is the way to the last key so far.  A node that the next way leaves is complete.
    """
    names = ["ref", "parent_ref", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    types = [pa.string(), pa.string(), *[pa.int64()] * 6]
    stack: list[dict] = []
    done: list[tuple] = []
    task, kept = None, 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            if not node["n_children"]:
                node["n_leaves"] = 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
            above = stack[-1] if stack else None
            if above:
                above["n_children"] += 1
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
            done.append(tuple(above and above["ref"] if n == "parent_ref" else node[n] for n in names))

    for batch in rows_of(batches):
        for row in batch.to_pylist():
            if row["task"] != task:
                task, kept = row["task"], 0
            elif row["side"] == 1 and kept < len(stack) and kept == row["depth"]:
                # from the way to the task's first key to the way to its last one
                close(kept)
            depth = row["depth"]
            if depth < len(stack) and stack[depth]["ref"] == row["ref"]:
                node = stack[depth]
                node["conv_id"] = min(node["conv_id"], row["conv_id"])
                for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    node[name] += row[name]
            else:
                close(depth)
                stack.append(row)
            if row["side"] == 0 and row["shared"]:
                kept = depth + 1
        if done:
            yield _batch(done, types, names)
            done.clear()
    close(0)
    if done:
        yield _batch(done, types, names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ref, ends_sha256`` of rows ``ref, conv_id`` in order; one digest is open at a time."""
    ref, seen = None, None
    for batch in rows_of(batches):
        done = []
        for at, name in zip(batch.column("ref").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if at != ref:
                if seen:
                    done.append((ref, seen.hexdigest()))
                ref, seen = at, hashlib.sha256(str(name).encode())
            else:
                seen.update(f",{name}".encode())
        if done:
            yield _batch(done, [pa.string()] * 2, ["ref", "ends_sha256"])
    if seen:
        yield _batch([(ref, seen.hexdigest())], [pa.string()] * 2, ["ref", "ends_sha256"])


def prefix_trie(conversations: DataFrame, task_turns: int = TASK_TURNS) -> DataFrame:
    """The nodes of the trie of ``conv_id, turns`` (as ``sequences`` gives them, one row for each).

    ``conv_id`` is the smallest member of a node, ``parent_conv_id`` that of its parent; the other
    columns are ``depth, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    spark = conversations.sparkSession
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    keys = stored(conversations.select("conv_id", ids.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words")), "keys")
    turns = keys.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // task_turns))
    # the number of a conversation splits a key that many have
    ordered = keys.repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = stored(ordered.mapInArrow(_parts, _PART), "trie")

    ways = parts.filter("kind = 1").select(
        "task", "side", "shared", "depth", "ref", "conv_id", "n_convs", "words", "n_children", "n_leaves", "saved_tokens"
    )
    # as many rows as the first and last keys of all tasks have turns
    ways = ways.repartition(1).sortWithinPartitions("task", "side", "depth").mapInArrow(
        _join_ways,
        "ref string, parent_ref string, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint",
    )
    ways = stored(ways, "ways")
    ended = parts.filter("kind = 2").select("ref", "conv_id").repartition("ref").sortWithinPartitions("ref", "conv_id")
    ended = ended.mapInArrow(_digests, "ref string, ends_sha256 string")
    opened = ways.join(ended, "ref", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    parents = ways.select(F.col("ref").alias("parent_ref"), F.col("conv_id").alias("__parent"))
    opened = opened.join(parents, "parent_ref", "left").withColumn("parent_conv_id", F.col("__parent")).select(*_OUT)
    whole = parts.filter("kind = 0")
    under = whole.filter("parent_ref is not null").drop("parent_conv_id").join(parents, "parent_ref").withColumnRenamed("__parent", "parent_conv_id")
    return whole.filter("parent_ref is null").select(*_OUT).unionByName(under.select(*_OUT)).unionByName(opened)
