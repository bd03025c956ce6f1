"""Jaccard self-join on word n-grams by token-combination prefixes, and its components.

Two sets with similarity of at least ``t`` share a token among the first ``n - ceil(t n) + 1`` of
each, in any order of all tokens; and ``k`` tokens when the prefixes are ``k - 1`` longer.  Here
rare tokens come before frequent ones.  A rare token of the prefix is a signature by itself.  If
frequent tokens reach into the prefix, it is extended, and each pair of frequent tokens in it is
a signature: sets that share no rare token of the prefix must share such a pair.  Sets with many
frequent tokens in the prefix would have too many pairs; they use their frequent tokens one by
one, and the others meet them there.

Sets that meet pass two tests that lose nothing before they are compared whole.  The place of
their first common token bounds how many can follow.  And each set has a bitmap of the parity of
its tokens by hash: two bitmaps cannot differ in more places than the sets do.

Equal sets are one node.  A signature with few nodes gives all its pairs.  Near copies of one text
share hundreds of signatures, so large groups that overlap become one where that adds no pairs.  A
large group gives the pairs with its smallest node first; nodes that are connected by then need no test, and the
rest is tested in rounds that double and redouble until no pair of unconnected nodes with a
common signature is left.  So no link between components is lost, and a group of a million near
copies does not give a million million pairs.

Tokens and nodes are 64-bit hashes, and a node's hash is taken from its whole set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Words
from tidemark.llm.common import drop_step, named, numbered, pick, position, release, row_key, rows_of, stored, worker_state
from tidemark.llm.components import components

#: Words in a shingle, and the similarity as a fraction.
WIDTH, SIMILARITY = 3, (9, 10)
#: A token is frequent if more sets have it; the table of frequent tokens has this many rows at
#: most (8 MB when sent to the tasks), the most frequent ones.
FREQUENT, TABLE_TOKENS = 16, 1 << 20
#: Frequent tokens of an extended prefix up to which their pairs are indexed.
PAIRED = 24
#: Nodes of a signature up to which all its pairs are compared at once.
SMALL_GROUP = 16
#: Partners in the first round after that; each further round has 8 times as many.  Few at first, as
#: most nodes are connected by their first similar partner and need no other.
FIRST_ROUND, MORE = 8, 8
#: Node keys up to which a side is sent to all tasks (8 bytes each).
BROADCAST_KEYS = 2_000_000
#: Tokens that a map task counts at a time, and bits of a token's hash that counting looks at.
CHUNK_TOKENS, COUNT_BITS = 1_000_000, 40
#: Bytes that a worker keeps of hashed words, in each of two generations.
CACHE_BYTES = 32 << 20

_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K3
    x = (x ^ (x >> np.uint64(27))) * _K1
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashed shingle sets of texts; keeps the hashes of words it has seen."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self._hash = Words(xxhash.xxh64_intdigest, CACHE_BYTES)

    def tokens(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes: of all ``width`` words in a row, or of the whole if it has fewer."""
        words = text.encode().lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        codes = np.fromiter(map(self._hash.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        total = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            total = _mix(total * _K2 + codes[k : len(codes) - width + 1 + k])
        return np.unique(total)


def node_of(tokens: np.ndarray) -> int:
    """64-bit key of a set."""
    return int(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes())[:8], np.int64)[0])


# --- frequent tokens ------------------------------------------------------------------------


def _pack(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 32-bit values and their counts; small differences and counts of 1 cost little."""
    steps = np.diff(values, prepend=values[:1] * 0).astype(np.uint32)
    many = np.flatnonzero(counts > 1).astype(np.uint32)
    head = np.array([len(values), len(many)], np.uint32)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T)
    return head.tobytes() + planes.tobytes() + many.tobytes() + counts[many].astype(np.uint32).tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = (int(x) for x in np.frombuffer(blob, np.uint32, 2))
    planes = np.frombuffer(blob, np.uint8, 4 * n, 8).reshape(4, n)
    values = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint64)
    counts = np.ones(n, np.int64)
    if m:
        counts[np.frombuffer(blob, np.uint32, m, 8 + 4 * n)] = np.frombuffer(blob, np.uint32, m, 8 + 4 * n + 4 * m)
    return values, counts


def frequent_tokens(rows: DataFrame, width: int, more_than: int = FREQUENT, most: int = TABLE_TOKENS) -> np.ndarray:
    """Hash heads of the tokens that occur in more than so many sets, over all rows.

    Map tasks count their tokens and send them on packed, by range of hash.  A range holds about
    as many tokens as a task's share of the input, so its group stays bounded as the data grow
    with the number of shuffle partitions.  Which tokens count as frequent changes the work but
    never the result, so equal hash heads may share a count.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(8, math.ceil(math.log2(2 * partitions)))
    low = np.uint64(COUNT_BITS - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_state(("shingler", width), lambda: Shingler(width))
        held, size, seen = [], 0, set()

        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            ranges, starts = np.unique(values >> low, return_index=True)
            ends = [*starts[1:], len(values)]
            mask = (np.uint64(1) << low) - np.uint64(1)
            blobs = [_pack(values[a:b] & mask, counts[a:b]) for a, b in zip(starts, ends, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ranges.astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "blob"]
            )

        for batch in rows_of(batches):
            for text in batch.column("text").to_pylist():
                tokens = shingler.tokens(text)
                key = node_of(tokens) if len(tokens) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                held.append(tokens >> np.uint64(64 - COUNT_BITS))
                size += len(tokens)
                if size >= CHUNK_TOKENS:
                    yield flush()
                    held, size = [], 0
                    seen.clear()
        if held:
            yield flush()

    def add_up(group: pa.Table) -> pa.Table:
        parts = [_unpack(b) for b in group.column("blob").to_pylist()]
        values = np.concatenate([v for v, _ in parts])
        order = np.argsort(values, kind="stable")
        values = values[order]
        counts = np.concatenate([c for _, c in parts])[order]
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        sums = np.add.reduceat(counts, starts)
        chosen = sums > more_than
        heads = (np.uint64(group.column("part")[0].as_py()) << low) | values[starts][chosen]
        return pa.table({"head": pa.array(heads.astype(np.int64)), "sets": pa.array(sums[chosen])})

    packed = rows.select("text").mapInArrow(count, "part int, blob binary")
    counted = packed.groupBy("part").applyInArrow(add_up, "head bigint, sets bigint")
    top = counted.orderBy(F.desc("sets"), "head").limit(most).select("head").toArrow()
    return np.sort(top.column("head").to_numpy().astype(np.uint64))


# --- signatures -----------------------------------------------------------------------------


def least_overlap(n: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """Tokens that a set of ``n`` shares with any set it is similar to, at least."""
    num, den = similarity
    return -(-num * n // den)


def signatures(
    tokens: np.ndarray, frequent: np.ndarray, similarity: tuple[int, int] = SIMILARITY
) -> tuple[np.ndarray, int, np.ndarray, bool]:
    """Signatures of a set; how many of them are rare tokens, in order; those that count only
    beside a wide set; whether this set is wide."""
    num, den = similarity
    n, none = len(tokens), np.empty(0, np.uint64)
    if n * den // num == n and least_overlap(n, similarity) == n:
        return none, 0, none, False  # similar to equal sets only
    place = np.searchsorted(frequent, tokens >> np.uint64(64 - COUNT_BITS))
    often = np.zeros(n, bool)
    if len(frequent):
        often = frequent[np.minimum(place, len(frequent) - 1)] == tokens >> np.uint64(64 - COUNT_BITS)
    ordered, first = np.concatenate([tokens[~often], tokens[often]]), int((~often).sum())
    size = n - least_overlap(n, similarity) + 1
    if first >= size:
        return ordered[:size], size, none, False
    rare, more = ordered[:first], ordered[first : size + 1]
    alone = _mix(ordered[first:size] + np.uint64(1))
    if len(more) > PAIRED:
        return rare, first, alone, True
    a, b = np.triu_indices(len(more), 1)
    return np.concatenate([rare, _mix(_mix(more[a] + np.uint64(2)) * _K2 + more[b])]), first, alone, False


#: Words of the short bitmap that large groups carry: 512 bits tell sets of up to 2,000 tokens apart.
SHORT = 8


def short_parity(tokens: np.ndarray) -> list[int]:
    """Parity of the tokens in 512 bits, as 64-bit integers."""
    odd = np.bincount((tokens & np.uint64(64 * SHORT - 1)).astype(np.int64), minlength=64 * SHORT) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def parity_bits(tokens: np.ndarray) -> bytes:
    """Bitmap of 0.3 bits a token or more: the parity of the tokens by the low bits of the hash."""
    width = max(64, 1 << math.ceil(math.log2(max(1, 0.3 * len(tokens)))))
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def parity_distance(x: bytes, y: bytes) -> int:
    """Places in which two bitmaps differ, after the longer one is folded: no more than the sets do."""
    if len(x) < len(y):
        x, y = y, x
    bits, width = int.from_bytes(x, "little"), 8 * len(x)
    while width > 8 * len(y):
        width //= 2
        bits = (bits >> width) ^ (bits & ((1 << width) - 1))
    return (bits ^ int.from_bytes(y, "little")).bit_count()


def _signed(rows: DataFrame, frequent: np.ndarray, width: int, similarity: tuple[int, int]) -> DataFrame:
    """``doc_id, row, n, node`` and the signatures of every row; no node for an empty set."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, often = worker_state(("shingler", width), lambda: Shingler(width)), shared.value
        for batch in rows_of(batches):
            sizes, nodes, single, rare, beside, wide, bits, short = [], [], [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingler.tokens(text)
                own, first, alone, is_wide = signatures(tokens, often, similarity)
                sizes.append(len(tokens))
                nodes.append(node_of(tokens) if len(tokens) else None)
                single.append(own.view(np.int64))
                rare.append(first)
                bits.append(parity_bits(tokens))
                short.append(short_parity(tokens))
                beside.append(alone.view(np.int64))
                wide.append(is_wide)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                    pa.array(single, longs), pa.array(rare, pa.int64()), pa.array(beside, longs),
                    pa.array(wide, pa.bool_()), pa.array(bits, pa.binary()), pa.array(short, longs),
                ],
                ["doc_id", "row", "n", "node", "own", "rare", "beside", "wide", "bits", "short"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        work,
        f"doc_id {kind}, row bigint, n bigint, node bigint, own array<bigint>, rare bigint,"
        " beside array<bigint>, wide boolean, bits binary, short array<bigint>",
    )


def _groups(signed: DataFrame) -> DataFrame:
    """Stored ``sig, node, n, after, c, hub``: signatures of two or more nodes.

    ``after`` is the number of tokens of the node from a rare token on, ``hub`` the smallest node of
    the signature.  Large groups of equal nodes appear once.
    """
    own = signed.select(F.posexplode("own").alias("k", "sig"), "node", "n", "rare")
    own = own.select("sig", "node", "n", F.expr("n - if(k < rare, k, 0)").alias("after"))
    beside = signed.select(F.explode("beside").alias("sig"), "node", "n", "wide")
    several = own.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    meeting = beside.groupBy("sig").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.max(F.col("wide").cast("int")).alias("wide")
    )
    live = several.filter("lo <> hi").select("sig").union(meeting.filter("lo <> hi and wide = 1").select("sig"))
    every = own.union(beside.select("sig", "node", "n", F.col("n").alias("after")))
    members = stored(every.join(live, "sig").distinct(), "members")
    prints = members.groupBy("sig").agg(
        F.count(F.lit(1)).alias("c"),
        F.min("node").alias("hub"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"),
    )
    # small groups all stay: their pairs depend on the place of the token
    same = F.when(F.col("c") <= SMALL_GROUP, F.col("sig")).otherwise(F.lit(0))
    once = prints.groupBy("c", "hub", "x", "y", same).agg(F.min("sig").alias("sig")).select("sig", "c", "hub")
    groups = stored(members.join(once, "sig"), "groups")
    drop_step(members)
    return groups


# --- comparison -----------------------------------------------------------------------------


def _survivors(pairs: DataFrame, signed: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Stored pairs ``a, b`` whose bitmaps allow the similarity."""
    num, den = similarity
    bits = signed.filter("node is not null").select("node", "n", "bits").dropDuplicates(["node"])
    met = pairs
    for side in "ab":
        met = met.join(bits.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"bits{side}")), side)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            columns = [batch.column(c).to_pylist() for c in ("bitsa", "bitsb", "na", "nb")]
            # similar sets differ in at most (den - num) / (den + num) of their tokens
            good = [
                parity_distance(x, y) * (den + num) <= (den - num) * (n + m) for x, y, n, m in zip(*columns, strict=True)
            ]
            kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"])
            yield kept.filter(pa.array(good, pa.bool_()))

    return stored(met.select("a", "b", "na", "nb", "bitsa", "bitsb").mapInArrow(work, "a bigint, b bigint"), "survivors")


def _sets(rows: DataFrame, signed: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """Stored ``node, tokens`` of some nodes, computed from one row of each."""
    chosen = signed.join(nodes.distinct(), "node").groupBy("node").agg(F.min("row").alias("row")).select("row")
    chosen = stored(chosen.distinct(), "chosen")
    if chosen.count() <= BROADCAST_KEYS:
        chosen = F.broadcast(chosen)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = worker_state(("shingler", width), lambda: Shingler(width))
        for batch in rows_of(batches):
            sets = [shingler.tokens(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "tokens"],
            )

    found = rows.join(chosen, "row", "left_semi").select("text").mapInArrow(work, "node bigint, tokens binary")
    return stored(found.dropDuplicates(["node"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Stored pairs ``a, b`` that are similar, by comparison of the whole sets."""
    num, den = similarity

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 512):
            same = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.minimum(np.searchsorted(left, right), len(left) - 1)
                common = int((left[at] == right).sum())
                same.append(den * common >= num * (len(left) + len(right) - common))
            kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"])
            yield kept.filter(pa.array(same, pa.bool_()))

    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return stored(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(work, "a bigint, b bigint"), "links")


def _near(n: str, m: str, similarity: tuple[int, int]):
    """Sizes that allow the similarity."""
    num, den = similarity
    return F.expr(f"{den} * least({n}, {m}) >= {num} * greatest({n}, {m})")


def _alike(n: str, m: str, similarity: tuple[int, int]):
    """Sizes and short bitmaps ``p`` and ``q`` that allow the similarity."""
    num, den = similarity
    differ = " + ".join(f"bit_count(p{k} ^ q{k})" for k in range(SHORT))
    return _near(n, m, similarity) & F.expr(f"({differ}) * {den + num} <= {den - num} * ({n} + {m})")


def _merged(large: DataFrame) -> DataFrame:
    """``sig, node, n, c`` of large groups, those that overlap much as one group.

    Groups with the same smallest node and of about one size become one if the square of its size is
    no more than theirs add up to.  It holds every pair that they hold, so no link is lost, and no
    more pairs than they have together.
    """
    key = ["hub", "band"]
    large = large.withColumn("band", F.floor(F.log2("c")))
    nodes = large.groupBy(*key, "node").agg(F.min("n").alias("n"), F.sum(F.col("c").cast("double")).alias("squares"))
    sizes = nodes.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), F.sum("squares").alias("squares"))
    # stored, as both sides below must see one decision
    whole = stored(sizes.filter("double(c) * c <= squares").select(*key, "c"), "merged")
    one = nodes.join(whole, key).select(F.xxhash64(*key).alias("sig"), "node", "n", "c")
    return one.unionByName(large.join(whole, key, "left_anti").select("sig", "node", "n", "c"))


def _large(groups: DataFrame, signed: DataFrame) -> DataFrame:
    """Stored ``sig, node, n, c`` and short bitmaps: members of large groups."""
    short = signed.filter("node is not null").select("node", *[F.col("short")[k].alias(f"p{k}") for k in range(SHORT)])
    large = groups.filter(F.col("c") > SMALL_GROUP)
    short = short.join(large.select("node"), "node", "left_semi").distinct()
    return stored(_merged(large).join(short, "node"), "large")


def _as_partner(rows: DataFrame) -> DataFrame:
    """``node, n`` and the bitmap under the names of the other side."""
    return rows.withColumnsRenamed({"node": "b", "n": "m", **{f"p{k}": f"q{k}" for k in range(SHORT)}})


def _first_pairs(groups: DataFrame, large: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs of small groups, and the smallest node of a large one with each other node.

    Two sets whose first common token is followed by too few others are not similar; a pair that
    is passed over at a later token is found at its first one.
    """
    num, den = similarity
    small = groups.filter(F.col("c") <= SMALL_GROUP).groupBy("sig").agg(
        F.array_sort(F.collect_list(F.struct("node", "n", "after"))).alias("all")  # SMALL_GROUP at most
    )
    left = small.select("all", F.posexplode("all").alias("k", "l"))
    right = left.select("l", F.explode(F.slice("all", F.col("k") + 2, F.lit(SMALL_GROUP))).alias("r"))
    enough = F.expr(f"{num + den} * least(l.after, r.after) >= {num} * (l.n + r.n)")
    near = right.filter(_near("l.n", "r.n", similarity) & enough)
    pairs = near.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    hubs = large.groupBy("sig").agg(F.min("node").alias("node"))
    hubs = _as_partner(large.join(hubs, ["sig", "node"]).drop("c"))
    stars = large.join(hubs, "sig").filter(_alike("n", "m", similarity) & (F.col("node") != F.col("b")))
    return pairs.union(stars.select("b", "node")).distinct()


def _looked_up(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the ``label`` of each node, its own key if it has no link."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _more_pairs(
    rows: DataFrame, labels: DataFrame, before: DataFrame | None, low: int, high: int, similarity: tuple[int, int]
) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Pairs of unconnected nodes with a common signature, each with some of its partners;
    ``sig, was``: a node of each group's largest component; and the ``rows`` of the next round.

    ``rows`` are the members of large groups at first.  Later they are those of the groups that are not
    connected yet, and ``inside`` marks the nodes of the largest component: as components only grow,
    these share one label, looked up once for each group, and only the others are looked up by node.

    Partners are taken by their hash: those between ``low`` and ``high`` of the group's size.
    One of the two lies outside the group's largest component, as nodes inside it are connected.
    ``before`` is the ``sig, was`` of the round before.  If another component has become the largest
    since, the nodes of the former one have met no partners yet, and meet all below ``high`` now.
    """
    count = F.count(F.lit(1)).alias("k")
    if before is None:
        now = _looked_up(rows, labels)
        sizes = now.groupBy("sig", "label").agg(count).withColumn("was", F.lit(None).cast("bigint"))
    else:
        outer, inner = _looked_up(rows.filter("not inside"), labels), rows.filter("inside")
        now = outer.unionByName(inner.withColumn("label", F.lit(None).cast("bigint"))).drop("inside")
        # the former largest component under its present label
        moved = before.join(labels.withColumnsRenamed({"node": "was", "label": "at"}), "was", "left")
        moved = moved.select("sig", F.coalesce("at", "was").alias("was"))
        largest = inner.groupBy("sig").agg(count).join(moved, "sig").select("sig", F.col("was").alias("label"), "k")
        sizes = outer.groupBy("sig", "label").agg(count).unionByName(largest)
        sizes = sizes.groupBy("sig", "label").agg(F.sum("k").alias("k")).join(moved, "sig")
    main = sizes.groupBy("sig").agg(
        F.max(F.struct("k", F.expr("label <=> was").alias("same"), "label")).alias("main"),
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("was").alias("was"),
    )
    main = main.filter("lo <> hi").select("sig", F.col("main.label").alias("main"), "was")
    now = stored(now.join(main, "sig").withColumn("label", F.coalesce("label", "was")), "unconnected")
    if now.isEmpty():
        drop_step(now)
        return None
    place = (F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 40)) / float(1 << 40)) * F.col("c")
    partner = _as_partner(now.withColumn("place", place).filter(F.col("place") < high).drop("c", "main", "was"))
    outside = now.filter("label <> main").withColumn("start", F.when(F.expr("label <=> was"), 0).otherwise(low))
    met = outside.drop("c", "main", "was").join(partner.withColumnRenamed("label", "other"), "sig")
    met = met.filter((F.col("label") != F.col("other")) & (F.col("place") >= F.col("start")) & _alike("n", "m", similarity))
    pairs = met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    then = now.withColumn("inside", F.expr("label = main")).drop("label", "main", "was")
    return pairs, now.select("sig", F.col("main").alias("was")).distinct(), then


def ngram_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row's own included.
    Null texts and texts without words have no shingles and no links, so their component is
    their own.  Rows with equal sets are linked, repeated rows too; null ids count only where a
    component has no other.  An empty table gives an empty result; further columns are ignored.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    rows = rows.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row"))
    nodes = _labelled(rows, width, similarity)
    # a stored side, so that a large component's rows can be split over tasks
    least = stored(nodes.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("first")), "components")
    return nodes.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id.

    Null ids come last, and of rows that agree in id the text decides.  Rows that agree in both
    are one document, of which one stays.  Rows without words all stay, as nothing links them.
    """
    flat, names = numbered(docs)
    at_id, at_text = f"__in{position(docs, doc_id)}", f"__in{position(docs, text)}"
    rows = flat.select(F.col(at_id).alias("doc_id"), F.col(at_text).alias("text"))
    rows = rows.withColumn("row", row_key(F.col("doc_id"), F.col("text")))
    nodes = _labelled(rows, width, similarity)
    least = nodes.filter("label is not null").groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("keeper")
    )
    kept = least.select("keeper.row").union(nodes.filter("n = 0").select("row"))
    kept = stored(kept.distinct().withColumnRenamed("row", "__row"), "kept")
    keyed = flat.withColumn("__row", row_key(F.col(at_id), F.col(at_text)))
    out = keyed.join(F.broadcast(kept) if kept.count() <= BROADCAST_KEYS else kept, "__row", "left_semi")
    worded = nodes.filter("n > 0")
    if worded.groupBy("row").count().filter("count > 1").isEmpty():
        return named(out, names)
    blank = ~F.coalesce(F.col(at_text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return named(out.filter(~blank).dropDuplicates(["__row"]).unionByName(out.filter(blank)), names)


def _labelled(rows: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """``doc_id, row, n, node, label`` of every row; the label is the component's smallest node."""
    frequent = frequent_tokens(rows, width)
    signed = stored(_signed(rows, frequent, width, similarity), "signatures")
    groups = _groups(signed)
    labels = _labels(rows, signed, groups, width, similarity)
    nodes = signed.select("doc_id", "row", "n", "node").join(labels, "node", "left")
    return nodes.withColumn("label", F.coalesce("label", "node"))


def _labels(rows: DataFrame, signed: DataFrame, groups: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """``node, label`` of all nodes with a link."""
    large = _large(groups, signed)
    largest = large.agg(F.max("c")).first()[0] or 0
    release(rows.sparkSession)
    pairs = _survivors(_first_pairs(groups, large, similarity), signed, similarity)
    release(rows.sparkSession)
    sets = _sets(rows, signed, pairs.select("a").union(pairs.select("b")).union(large.select("node")).toDF("node"), width)
    labels = components(_linked(pairs, sets, similarity))
    low, high, before, unconnected = 0, FIRST_ROUND, None, large
    while low < largest:
        found = _more_pairs(unconnected, labels, before, low, high, similarity)
        if found is None:
            break
        pairs, before, unconnected = found
        more = _linked(_survivors(pairs, signed, similarity), sets, similarity)
        release(rows.sparkSession)
        if not more.isEmpty():
            # what is connected goes on as stars, so a round does not repeat the ones before
            stars = labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
            labels = components(stars.union(more))
        low, high = high, high * MORE
    return labels
