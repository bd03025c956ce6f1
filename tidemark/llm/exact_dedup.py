"""Exact duplicates by deterministic block naming.

The normalised text is cut into blocks of fixed size.  Blocks are sorted across the cluster and
get integers as names, equal exactly if the blocks are; then adjacent names of a document are
sorted and named pair by pair, level by level, until each document has one name.  Two documents
have the same (number of blocks, name) exactly if their texts are equal: contents are compared
at every level, and hashes only decide where a block is sorted to.

The sort is by (hash, content) and its ranges are cut by (hash, row), so a block that a third of
all rows share is spread over many tasks.  A block that lies in two tasks gets its name from the
first: each task passes on the contents at its two ends, and only those are compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, stored

#: White space that counts as one space.
SPACES = r"[\x20\x09-\x0D]+"
#: Bytes in a block.
BLOCK_BYTES = 4096
#: Names are task number times this, plus the place in the task.
_TASK = 1 << 40


def normalised(text: Column) -> Column:
    """The text that is compared; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _name_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names for rows sorted by (h, content); the last column is the content.

    Rows with the first and the last hash of the task may go on in another one: their contents
    follow in rows of their own, once each.
    """
    rank, last, first_hash, ends = TaskContext.get().partitionId() * _TASK, None, None, []
    schema = None

    def edges() -> pa.RecordBatch:
        arrays = [pa.nulls(len(ends), f.type) for f in schema]
        arrays[-2] = pa.array([n for n, _ in ends], pa.int64())
        arrays[-1] = pa.array([c for _, c in ends], pa.binary())
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        h, content = batch.column("h"), batch.column("content")
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.or_(
            pc.not_equal(h.slice(1), h.slice(0, len(h) - 1)),
            pc.not_equal(content.slice(1), content.slice(0, len(content) - 1)),
        ).to_numpy(zero_copy_only=False)
        new[0] = last is None or last != (h[0].as_py(), content[0].as_py())
        names = rank + np.cumsum(new)

        def fresh(chosen, new=new, names=names, content=content):
            return [(int(names[k]), content[int(k)].as_py()) for k in np.flatnonzero(new & chosen)]

        kept = [k for k, n in enumerate(batch.schema.names) if n not in ("h", "content")]
        schema = pa.schema(
            [*(batch.schema.field(k) for k in kept), pa.field("name", pa.int64()), pa.field("edge", pa.binary())]
        )
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in kept), pa.array(names), pa.nulls(batch.num_rows, pa.binary())], schema=schema
        )
        hashes = h.to_numpy()
        if first_hash is None:
            first_hash = hashes[0]
        if last is not None and last[0] != hashes[0]:
            if last[0] == first_hash:
                yield edges()
            ends = []
        if hashes[0] != hashes[-1]:
            # the group at the top of the batch ends in it
            if hashes[0] == first_hash:
                ends += fresh(hashes == first_hash)
                if ends:
                    yield edges()
            ends = []
        ends += fresh(hashes == hashes[-1])
        rank, last = int(names[-1]), (int(hashes[-1]), content[-1].as_py())
    if ends:
        yield edges()


def _named(rows: DataFrame, what: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows with ``content`` replaced by ``name``, and the table behind them."""
    keyed = rows.withColumn("h", F.xxhash64("content"))
    keyed = keyed.select(*[c for c in rows.columns if c != "content"], "h", "content")
    ordered = keyed.repartitionByRange("h", "uid", "pos").sortWithinPartitions("h", "content")
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "content")
    table = stored(ordered.mapInArrow(_name_sorted, f"{out}, name bigint, edge binary"), what)
    ends = table.filter(F.col("edge").isNotNull()).select("name", "edge").distinct()
    first = ends.groupBy("edge").agg(F.min("name").alias("own"))
    # at most two contents per task, but for equal hashes: small enough to send to every task
    moved = ends.join(first, "edge").filter("name <> own").select("name", "own")
    named = table.filter(F.col("edge").isNull()).drop("edge").join(F.broadcast(moved), "name", "left")
    return named.withColumn("name", F.coalesce("own", "name")).drop("own"), table


def block_names(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``uid, doc_id, n_blocks, name`` and ``carry`` of every row; equal texts have equal names.

    ``uid`` numbers the rows, ``name`` is unique among texts with as many blocks, and ``carry``
    holds expressions over the column ``content``, the normalised text.  Null text counts as
    empty; an empty text is one empty block.
    """
    carry = carry or {}
    rows = pick(docs, doc_id=doc_id, text=text).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", normalised(F.col("text")).alias("content")
    )
    whole = rows.select(
        "uid",
        "doc_id",
        F.greatest(F.lit(1), F.ceil(F.octet_length("content") / block_bytes)).cast("int").alias("n_blocks"),
        *[c.alias(n) for n, c in carry.items()],
        F.col("content").cast("binary").alias("content"),
    )
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda k: F.substring(F.col("content"), k * F.lit(block_bytes) + 1, F.lit(block_bytes)),
    )
    blocks = whole.select("uid", "doc_id", "n_blocks", *carry, F.posexplode(cut).alias("pos", "content"))
    # what belongs to the document stays with its first block
    once = [F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("doc_id", *carry)]
    named, _ = _named(blocks.select("uid", *once, "n_blocks", "pos", "content"), "blocks")
    heads = named.filter("pos = 0")
    longest = named.agg(F.max("n_blocks")).first()[0] or 1
    done = []
    level, size, table = named.filter("n_blocks > 1").select("uid", "n_blocks", "pos", "name"), 1, None
    while size < longest:
        pairs = level.groupBy("uid", "n_blocks", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("r"),
        )
        pairs = pairs.select("uid", "n_blocks", "pos", F.concat_ws(":", "l", "r").cast("binary").alias("content"))
        level, table = _named(pairs, "pairs")
        size *= 2
        done.append(level.filter(F.col("n_blocks") <= size).select("uid", F.col("name").alias("whole")))
        level = level.filter(F.col("n_blocks") > size)
    if not done:
        return heads.drop("pos")
    names = done[0]
    for more in done[1:]:
        names = names.unionByName(more)
    heads = heads.join(names, "uid", "left").withColumn("name", F.coalesce("whole", "name"))
    return heads.drop("pos", "whole")


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept`` and ``carry``.

    Of equal texts the row with the smallest ``doc_id`` stays, nulls last; of rows that agree in
    that too, the first.  Null text counts as empty.  An empty table gives an empty result, and
    further columns of the input are ignored.
    """
    names = stored(block_names(docs, doc_id, text, carry, block_bytes), "names")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")
    groups = names.groupBy("n_blocks", "name").agg(
        F.min(order).alias("keeper"), F.count(F.lit(1)).alias("group_size")
    )
    joined = names.join(groups, ["n_blocks", "name"])
    return joined.select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("keeper.uid")).alias("kept"),
        *(carry or {}),
    )
