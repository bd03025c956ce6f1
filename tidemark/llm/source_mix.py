"""Mix of sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents fall into blocks by hash.  A source whose target is ``r`` times its size
gives all its blocks ``floor(r)`` times, and once more those of a random order that fill up the
rest.  The numbers of blocks drawn from the sources are then split between two halves of the
output shards, and so on down a binary tree; each split is a multivariate-hypergeometric draw,
so every shard gets exact block counts with the spread of a full shuffle, though no row has
moved.  A shard takes its blocks from consecutive places of each source's permuted draws, and
orders their documents by hash.  Where there are many sources, the driver splits the draws of
groups of them, and a task for each group splits what each shard got among its sources: the
groups of a multivariate-hypergeometric draw are such a draw themselves.

Sources are numbered, and their targets found, by Spark jobs, so there may be any number; the
driver sees sums and the draws of at most ``GROUP`` groups.

Sources are ordered by code point, null last, and weigh by the given weights in turn.  Null texts
count as empty.  A document without words is drawn with its block and adds nothing.  Rows that
agree in id and text fall into one block and are drawn together.  An empty table, or sources
without words, give targets of 0.  Equal seeds give equal mixes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, position, row_key, stored

#: Weights of the sources in order, repeating, and the most often a source is repeated.
WEIGHTS, MOST = (5, 2, 1), 3
#: Blocks of a source at most; a source with fewer documents has as many blocks as documents.
BLOCKS = 4096
SHARDS, SEED = 64, 20
#: Sources in a group at least, and groups at most.
GROUP = 4096
#: Draws at most, by fewer blocks of each source; numpy's hypergeometric draws end there.
MOST_DRAWS = 10**9 - 1
#: Bytes up to which the source names, or the draw table, are sent to every task.
BROADCAST_BYTES = 64 << 20
#: Bytes of a row of numbers about a source, and of one of the draw table, in a task.
SOURCE_BYTES, DRAW_BYTES = 96, 208
#: Where the names are too large, those of sources with more than this part of all documents are sent.
HOT_PART = 10_000


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Adds ``target`` to ``no, source_size``: words each source shall give.

    All words by weight, at most ``most`` times the source.  What a source cannot give is shared
    by the others by weight, until none is above its limit.  Each round is one sum over the
    sources; rounds grow with the logarithm of the words, as the share of a unit of weight rises
    in Newton's steps to where all words are given.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    limit = F.lit(float(most)) * F.col("source_size")
    share, full, seen = F.lit(0.0), F.lit(False), -1
    while True:
        now = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(full, F.col("source_size"))).alias("given"),
            F.sum(F.when(~full, weight)).alias("rest"),
            F.count_if(full).alias("full"),
        ).first()
        if now["full"] == seen or not now["rest"]:
            return sources.withColumn("target", F.when(full, limit).otherwise(share))
        left = float(now["words"]) - float(most) * float(now["given"] or 0)
        share = F.lit(left) * weight / F.lit(float(now["rest"]))
        full, seen = full | (share > limit), now["full"]


def split_tree(
    draws: np.ndarray, shards: int, seed: int, given: np.ndarray | None = None, group: tuple[int, ...] = ()
) -> np.ndarray:
    """Draws of each source by shard: row ``k`` is what shard ``k`` gets.

    Each node splits its draws in proportion to the shards on either side, or as many as are
    ``given`` to these shards; ``group`` tells the random draws of groups apart.
    """
    out = np.zeros((shards, len(draws)), np.int64)

    def split(low: int, high: int, have: np.ndarray) -> None:
        if high - low == 1:
            out[low] = have
            return
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high, *group])
        if given is None:
            take = int(round(int(have.sum()) * (middle - low) / (high - low)))
        else:
            take = int(given[low:middle].sum())
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if have.sum() else have * 0
        split(low, middle, left)
        split(middle, high, have - left)

    split(0, shards, np.asarray(draws, np.int64))
    return out


@dataclass
class Mix:
    """Sources by number and the stored draws ``no, block, draws``."""

    sources: DataFrame
    draws: DataFrame


def _fill(size: np.ndarray, order: np.ndarray, rest: float) -> np.ndarray:
    """Blocks whose sizes come near ``rest``: in order, those that still fit; then the one block
    more, or the one exchange of two, that comes nearest."""
    taken = np.zeros(len(size), bool)
    for k in order:
        if size[k] <= rest:
            taken[k] = True
            rest -= size[k]
    inside, outside = np.flatnonzero(taken), np.flatnonzero(~taken)
    if len(outside):
        outside = outside[np.argsort(size[outside], kind="stable")]
        # leaving out nothing counts as a block of size 0
        leave = np.concatenate([[-1], inside])
        lost = np.concatenate([[0], size[inside]])
        at = np.searchsorted(size[outside], rest + lost)
        best = (abs(rest), -1, -1)
        for shift in (-1, 0):
            k = np.clip(at + shift, 0, len(outside) - 1)
            error = np.abs(rest + lost - size[outside[k]])
            j = int(error.argmin())
            best = min(best, (float(error[j]), int(leave[j]), int(outside[k[j]])))
        if best[2] >= 0:
            taken[best[2]] = True
            if best[1] >= 0:
                taken[best[1]] = False
    return order[taken[order]]


def _draws_of(seed: int):
    def draw(blocks: pa.Table) -> pa.Table:
        """Draws of one source, in order: whole passes, then blocks that fill up the target."""
        no, target = blocks["no"][0].as_py(), blocks["target"][0].as_py()
        blocks = blocks.sort_by("block")
        block, size = blocks["block"].to_numpy(), blocks["words"].to_numpy()
        total = int(size.sum())
        rng = np.random.default_rng([seed, no])
        passes = int(target // total) if total else 0
        rest, drawn, number = target - passes * total, [], []
        for p in range(passes):
            drawn.append(rng.permutation(block))
            number.append(np.full(len(block), p))
        if total and passes < MOST:
            chosen = _fill(size, rng.permutation(len(block)), rest)
            drawn.append(block[chosen])
            number.append(np.full(len(chosen), passes))
        blocks_drawn = np.concatenate(drawn) if drawn else np.empty(0, np.int64)
        return pa.table(
            {
                "no": np.full(len(blocks_drawn), no, np.int64),
                "place": np.arange(len(blocks_drawn)),
                "block": blocks_drawn,
                "pass": np.concatenate(number) if number else np.empty(0, np.int64),
            }
        )

    return draw


def source_table(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, blocks: int = BLOCKS
) -> DataFrame:
    """One row per source of ``source, size``: ``no, source, source_size, docs, target, blocks``."""
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    # the low 33 bits of the id are a row's place in its partition
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    found = found.orderBy(F.col("source").asc_nulls_last())
    found = stored(found.select("*", F.spark_partition_id().alias("part"), place.alias("place")), "sources")
    first, count = [], 0
    for r in sorted(found.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):  # one row per partition
        first.append((r["part"], count))
        count += r["n"]
    # an Arrow table: rows from a list would start Python workers of their own on the executors
    parts, firsts = pa.array([p for p, _ in first], pa.int32()), pa.array([n for _, n in first], pa.int64())
    starts = spark.createDataFrame(pa.table({"part": parts, "first": firsts}))
    blocks = max(1, min(blocks, MOST_DRAWS // ((MOST + 1) * max(count, 1))))
    numbers = found.join(F.broadcast(starts), "part").select(
        (F.col("first") + F.col("place")).alias("no"), "source", "source_size", "docs",
        F.least(F.lit(blocks), "docs").cast("int").alias("blocks"),
    )
    return stored(with_targets(stored(numbers, "sources"), weights), "sources")


def _shard_ends(drawn: DataFrame, sources: int, shards: int, seed: int) -> DataFrame:
    """``no, ends``: the place of a source's draws at which each shard's share of them ends."""
    width = max(GROUP, -(-sources // GROUP))
    counts = drawn.groupBy("no").agg(F.count(F.lit(1)).alias("draws"))
    counts = counts.withColumn("group", F.floor(F.col("no") / width))
    totals = sorted(counts.groupBy("group").agg(F.sum("draws").alias("draws")).collect())  # GROUP rows at most
    split = split_tree(np.array([r["draws"] for r in totals], np.int64), shards, seed)
    given = {r["group"]: split[:, k] for k, r in enumerate(totals)}

    def ends(rows: pa.Table) -> pa.Table:
        rows, group = rows.sort_by("no"), rows["group"][0].as_py()
        own = split_tree(rows["draws"].to_numpy(), shards, seed, given[group], (group,))
        return pa.table({"no": rows["no"], "ends": pa.array(list(np.cumsum(own, axis=0).T), pa.list_(pa.int64()))})

    return counts.groupBy("group").applyInArrow(ends, "no bigint, ends array<bigint>")


def plan(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, seed: int = SEED, blocks: int = BLOCKS
) -> Mix:
    """Targets and draws for ``source, size, row`` of all documents."""
    sources = source_table(rows, weights, blocks)
    placed = in_blocks(rows, sources)
    sums = placed.groupBy("no", "block", "target").agg(F.sum("size").alias("words"))
    # a source has at most ``blocks`` rows here
    drawn = sums.groupBy("no").applyInArrow(_draws_of(seed), "no bigint, place bigint, block bigint, pass bigint")
    drawn = stored(drawn, "draws")
    ends = _shard_ends(drawn, sources.count(), shards, seed)
    shard = F.size(F.filter("ends", lambda end: end <= F.col("place")))
    sharded = drawn.join(ends, "no").select("no", "block", "pass", shard.alias("shard"))
    by_block = sharded.groupBy("no", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    return Mix(sources, stored(by_block, "draws"))


def in_blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's numbers and their block.

    Where the names of all sources are too large to be sent to every task, those of the sources
    with most documents are, ``HOT_PART`` at most; the join of the others then has no hot key.
    """
    names = sources.withColumnRenamed("source", "__source")
    same = F.col("source").eqNullSafe(F.col("__source"))
    length = F.coalesce(F.octet_length(F.col("source").cast("string")), F.lit(0)) + SOURCE_BYTES
    bulk = sources.agg(F.sum(length).alias("bytes"), F.sum("docs").alias("docs")).first()
    if (bulk["bytes"] or 0) <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(names), same)
    else:
        hot = F.col("docs") * HOT_PART > bulk["docs"]
        sent = rows.join(F.broadcast(names.filter(hot)), same, "left")
        others = sent.filter(F.col("no").isNull()).select(*rows.columns).join(names.filter(~hot), same)
        joined = sent.filter(F.col("no").isNotNull()).unionByName(others)
    joined = joined.drop("__source", "docs")
    return joined.withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.col("blocks")).cast("long"))


def _drawn(rows: DataFrame, mix: Mix, how: str) -> DataFrame:
    draws = mix.draws
    if draws.count() * DRAW_BYTES <= BROADCAST_BYTES:
        draws = F.broadcast(draws)
    return in_blocks(rows, mix.sources).join(draws, ["no", "block"], how)


def mix_plan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """One row per input row: ``doc_id, size, source, source_size, target, taken, draws``.

    ``draws`` has the pass and the output shard of each time the document is taken, and
    ``taken`` the words of all of them.
    """
    flat, _ = numbered(docs)
    cols = {n: F.col(f"__in{position(docs, c)}") for n, c in (("doc_id", doc_id), ("text", text), ("source", source))}
    rows = flat.select(
        cols["doc_id"].alias("doc_id"), cols["source"].alias("source"), words(cols["text"]).alias("size"),
        row_key(cols["doc_id"], cols["text"]).alias("row"),
    )
    rows = stored(rows, "sizes")
    out = _drawn(rows, plan(rows, weights, shards, seed), "left")
    times = F.coalesce(F.size("draws"), F.lit(0))
    return out.select("doc_id", "size", "source", "source_size", "target", (F.col("size") * times).alias("taken"), "draws")


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, seed: int = SEED, placed: bool = False,
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns.

    ``placed`` adds ``mix_shard`` and ``mix_order``: write partitioned by the one and sorted by
    the other to get the shards.
    """
    flat, names = numbered(docs)
    at = {n: F.col(f"__in{position(docs, c)}") for n, c in (("doc_id", doc_id), ("text", text), ("source", source))}
    rows = flat.withColumns(
        {"source": at["source"], "size": words(at["text"]), "row": row_key(at["doc_id"], at["text"])}
    )
    mix = plan(stored(rows.select("source", "size", "row"), "sizes"), weights, shards, seed)
    drawn = _drawn(rows, mix, "inner").withColumn("draw", F.explode("draws"))
    own = [F.col(f"__in{k}") for k in range(len(names))]
    if not placed:
        return drawn.select(*own).toDF(*names)
    order = F.xxhash64(F.lit(seed), "row", "draw.pass")
    return drawn.select(*own, "draw.shard", order).toDF(*names, "mix_shard", "mix_order")
