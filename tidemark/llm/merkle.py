"""Merkle manifest of a dataset: digests of rows, trees per part, and membership proofs.

Every row is a leaf.  The leaves of a part (say, a language) stand in the order of their ids; while
more than one node is left, every eight neighbours become one node, whose digest is that of their
digests.  The last nodes of the parts, in the order of the parts, become the root in the same way.

What is stored is content-addressed: for each height, records ``digest -> children``.  A proof is
found by descent: requests start at the root, each base-8 digit of a leaf's rank chooses the next
child of the record found by its digest, and the children that were not chosen are collected.  The
segments of a path, reversed, are the proof from leaf to root.  Requests that agree in their first
digits go down as one row, so no digest is asked for more often than it has nodes.

Ranks come from a range sort and the counts of its partitions, so no part, however large, is numbered
in one task.  A null value is hashed as ``-``; a null id stands first, a null part too.  Rows that
agree in part and id stand in the order of their digests, repeated rows are leaves of their own.
An empty table has no root and gives no rows.  Further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, position, stored

#: Children of a node, at most.
ARITY = 8
#: Columns of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


@dataclass
class Manifest:
    """``leaves``: tree, rank, doc_id, leaf and carried columns; ``levels[h]``: the nodes of height
    h + 1 with their children; ``top``: the same over the last nodes of the trees; ``trees``: tree,
    its place, height and last node."""

    leaves: DataFrame
    levels: list[DataFrame]
    trees: DataFrame
    top: list[DataFrame]
    arity: int

    def records(self) -> DataFrame:
        """The content-addressed store: every digest of an inner node once, with its children."""
        found = self.leaves.select(F.col("leaf").alias("digest"), F.array("leaf").alias("children")).limit(0)
        for level in [*self.levels, *self.top]:
            found = found.union(level.select("digest", "children"))
        return found.dropDuplicates(["digest"])


def ranked(rows: DataFrame, tree: str, order: list[str], what: str) -> DataFrame:
    """``rows`` with ``rank``, from 0 within each tree, and ``n``, the rows of the tree."""
    keys = [tree, *order]
    # equal rows are told apart by where they were read, so that a range holds no more than its share
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    sorted_rows = tied.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie").drop("__tie")
    placed = stored(sorted_rows.withColumn("__at", F.monotonically_increasing_id()), what)
    task = F.shiftright("__at", 33)
    # one row for each task and tree
    runs = placed.groupBy(F.col(tree).alias("__tree"), task.alias("__task")).agg(
        F.min("__at").alias("__from"), F.count(F.lit(1)).alias("__rows")
    )
    # as many rows as a tree has tasks
    each = Window.partitionBy("__tree")
    runs = runs.withColumns({"__before": F.sum("__rows").over(each.orderBy("__task")) - F.col("__rows"), "n": F.sum("__rows").over(each)})
    runs = runs.select("__tree", F.col("__task").alias("__in"), "__from", "__before", "n")
    joined = placed.join(runs, (F.col(tree) == F.col("__tree")) & (task == F.col("__in")))
    return joined.withColumn("rank", F.col("__at") - F.col("__from") + F.col("__before")).drop(
        "__at", "__tree", "__in", "__from", "__before"
    )


def grow(nodes: DataFrame, most: int, arity: int, what: str) -> list[DataFrame]:
    """Levels of inner nodes over ``tree, rank, n, digest``, until every tree has one node.

    ``most`` is the largest ``n``.  A level has ``tree, rank, n, digest, children``.
    """
    levels = []
    while most > 1:
        runs = nodes.filter("n > 1").groupBy(
            "tree", F.expr(f"rank div {arity}").alias("up"), F.expr(f"(n + {arity - 1}) div {arity}").alias("left")
        )
        level = runs.agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run")).select(
            "tree", F.col("up").alias("rank"), F.col("left").alias("n"), F.col("run.digest").alias("children")
        )
        nodes = stored(level.withColumn("digest", digest(F.array_join("children", ""))), f"{what}-{len(levels) + 1}")
        levels.append(nodes)
        most = -(-most // arity)
    return levels


def build(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, part: str = "lang", order: str = "doc_id",
    carry: dict[str, Column] | None = None, arity: int = ARITY,
) -> Manifest:
    """The manifest of a table: ``fields`` are hashed, ``part`` names the trees, ``order`` the leaves.

    ``carry`` computes further columns of the leaves, by the names of ``fields``.
    """
    flat, _ = numbered(docs)
    at = {name: F.col(f"__in{position(docs, name)}") for name in dict.fromkeys((*fields, part, order))}
    rows = flat.select(*[column.alias(name) for name, column in at.items()])
    leaf = digest(*[field(F.col(name)) for name in fields])
    extra = carry or {}
    tree = F.when(F.col(part).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(part).cast("string")))
    leaves = rows.select(
        tree.alias("tree"), F.col(order).alias("doc_id"), leaf.alias("leaf"), *[c.alias(n) for n, c in extra.items()]
    )
    # hashed once: a range sort reads its rows twice
    placed = ranked(stored(leaves, "hashed"), "tree", ["doc_id", "leaf"], "leaves")
    return _manifest(placed, arity)


def _manifest(placed: DataFrame, arity: int) -> Manifest:
    nodes = placed.select("tree", "rank", "n", F.col("leaf").alias("digest"))
    most = placed.agg(F.max("n")).first()[0] or 0
    levels = grow(nodes, most, arity, "nodes")
    # the last node of each tree, by height
    last = nodes.filter("n = 1").select("tree", F.lit(0).alias("height"), "digest")
    for height, level in enumerate(levels, 1):
        last = last.union(level.filter("n = 1").select("tree", F.lit(height), "digest"))
    trees = ranked(last.withColumn("all", F.lit("")), "all", ["tree"], "trees")
    above = trees.select(F.lit("").alias("tree"), "rank", "n", "digest")
    top = grow(above, trees.agg(F.max("n")).first()[0] or 0, arity, "top")
    return Manifest(placed, levels, trees.select("tree", F.col("rank").alias("place"), "height", "digest"), top, arity)


def descend(above: DataFrame, level: DataFrame, wanted: DataFrame, arity: int) -> DataFrame:
    """One step down: the ``wanted`` nodes (tree, rank, further columns) below those of ``above``.

    ``above`` has ``tree, rank, digest, path`` and ``root``, ``subroot``; a node that is not
    wanted is not visited.  The chosen child is the node's digest, the others extend its path.
    """
    records = level.select(F.col("digest").alias("address"), "children").dropDuplicates(["address"])
    found = above.join(records, F.col("digest") == F.col("address")).select(
        F.col("tree").alias("__tree"), F.col("rank").alias("__rank"), "children", "path", "root", "subroot"
    )
    step = wanted.join(found, (F.col("tree") == F.col("__tree")) & (F.expr(f"rank div {arity}") == F.col("__rank")))
    digit = F.expr(f"cast(rank % {arity} as int)")
    others = F.filter("children", lambda c, k: k != digit)
    return step.select(
        *wanted.columns, F.get("children", digit).alias("digest"),
        F.concat("path", F.array(F.struct(digit.alias("digit"), others.alias("others")))).alias("path"), "root", "subroot",
    )


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The way from leaf to root of the requested leaves, of all where ``requests`` is None.

    ``requests`` has ``tree`` and ``rank``.  The result has the columns of the leaves, ``root``,
    ``subroot`` and ``path``: for each level from the leaf on, the place of the node in its run
    and the digests of the others.
    """
    arity, columns = manifest.arity, [c for c in manifest.leaves.columns if c not in ("tree", "rank", "n")]
    leaves = manifest.leaves.select("tree", "rank", *columns)
    if requests is not None:
        leaves = leaves.join(requests.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")

    def wanted(height: int) -> DataFrame:
        if height == 0:
            return leaves
        if requests is None:
            return manifest.levels[height - 1].select("tree", "rank")
        return leaves.select("tree", F.expr(f"rank div {arity ** height}").alias("rank")).distinct()

    trees = manifest.trees
    no_path = F.array().cast("array<struct<digit: int, others: array<string>>>")
    places = trees.select(F.lit("").alias("tree"), F.col("place").alias("rank"), F.col("tree").alias("name"), "height")
    if manifest.top:
        at = manifest.top[-1].select("tree", "rank", "digest", no_path.alias("path"), F.col("digest").alias("root"), F.lit("").alias("subroot"))
        for height in range(len(manifest.top) - 1, 0, -1):
            at = descend(at, manifest.top[height], manifest.top[height - 1].select("tree", "rank"), arity)
        entries = descend(at, manifest.top[0], places, arity)
    else:
        # one tree: its last node is the root
        entries = trees.select(
            F.lit("").alias("tree"), F.col("place").alias("rank"), F.col("tree").alias("name"), "height", "digest",
            no_path.alias("path"), F.col("digest").alias("root"), F.lit("").alias("subroot"),
        )
    entries = entries.select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", "path", "root", F.col("digest").alias("subroot"), "height"
    )
    if manifest.levels:
        # few rows, as many as there are trees, and each height reads them
        entries = stored(entries, "entries")
    at = entries.filter(f"height = {len(manifest.levels)}").drop("height")
    for height in range(len(manifest.levels), 0, -1):
        below = descend(at, manifest.levels[height - 1], wanted(height - 1), arity)
        if height == 1:
            lone = entries.filter("height = 0").drop("height", "rank")
            alone = leaves.join(lone, "tree").select(*below.columns)
            return _turned(below.unionByName(alone), columns)
        at = below.unionByName(entries.filter(f"height = {height - 1}").drop("height").select(*below.columns))
    return _turned(leaves.join(at.drop("rank"), "tree"), columns)


def _turned(found: DataFrame, columns: list[str]) -> DataFrame:
    return found.select(*columns, "root", "subroot", F.reverse("path").alias("path"))


def fold(leaf: Column, path: Column, arity: int = ARITY) -> Column:
    """The root that a leaf and its path give."""

    def up(node: Column, segment: Column) -> Column:
        left = F.array_join(F.slice(segment["others"], F.lit(1), segment["digit"]), "")
        right = F.array_join(F.slice(segment["others"], segment["digit"] + 1, F.lit(arity)), "")
        return digest(left, node, right)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """Digest of all digests of a path, from the leaf on, left to right."""
    return digest(F.array_join(F.flatten(F.transform(path, lambda s: s["others"])), ""))


def lowered(text: Column) -> Column:
    """A text with its letters A to Z in lower case, others as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame, fields: tuple[str, ...] = FIELDS, part: str = "lang", order: str = "doc_id", text: str = "text", every: int = 3) -> DataFrame:
    """Proofs of all rows, checked against leaves of which some were tampered with.

    Where ``every`` divides the CRC-32 of the id, the checked leaf has the text in lower case; a
    null id is never tampered with.  Returns ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified``.
    """
    changed = F.crc32(F.col(order).cast("string").cast("binary")) % every == 0
    values = [field(F.when(changed, lowered(F.col(name))).otherwise(F.col(name)) if name == text else F.col(name)) for name in fields]
    found = proofs(build(docs, fields, part, order, carry={"given": digest(*values)}))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("given"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
