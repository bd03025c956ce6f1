"""Prefix trie and manifest against plain versions, and on nulls, ties, repeats and no rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.llm import merkle, prefix_trie
from tidemark.llm.radix_tree import Every, Few, RadixTree, Some

TURNS = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- prefix trie ----------------------------------------------------------------------------


def plain_trie(talks):
    """Nodes of {conv_id: [(turn, words)]} by dictionaries."""
    members = {}
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * (p[-1][1] if p else 0) for p in below)
        ends = sorted(c for c in convs if len(talks[c]) == len(prefix))
        out.append((
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), len(kids), len(leaves),
            saved, sha(",".join(map(str, ends))),
        ))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def talks_of(random_state, n, kinds, longest):
    return {c: [(str(random_state.randrange(kinds)), 0) for _ in range(random_state.randrange(longest + 1))] for c in range(-3, n)}


@pytest.mark.parametrize("tasks", [1, 7])
def test_trie_against_dictionaries(spark, tasks):
    r = random.Random(tasks)
    for n, kinds, longest in ((1, 2, 0), (40, 2, 4), (120, 3, 6), (60, 1, 9)):
        talks = talks_of(r, n, kinds, longest)
        # a turn's words are those of its text
        talks = {c: [(t, int(t) + 1) for t, _ in turns] for c, turns in talks.items()}
        data = [(c, [(hashlib.sha256(t.encode()).hexdigest()[:32], w) for t, w in turns]) for c, turns in talks.items()]
        df = spark.createDataFrame(data, "conv_id bigint, turns array<struct<id: string, words: bigint>>")
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            assert rows(prefix_trie.prefix_trie(df)) == plain_trie(talks)
            # as many tasks as conversations: nodes reach over many of them
            assert rows(prefix_trie.prefix_trie(df, task_turns=5)) == plain_trie(talks)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_tree_layouts_grow_and_ids_split_inside():
    layout, kids = Few(4), {}
    for byte in random.Random(1).sample(range(256), 256):
        layout = layout.put(byte, byte)
        kids[byte] = byte
        assert dict(layout) == kids and all(layout.get(b) == kids.get(b) for b in range(256))
        assert type(layout) is (Few if len(kids) <= 16 else Some if len(kids) <= 48 else Every)
    tree = RadixTree(4)
    for name, key in enumerate([b"", b"aaaa", b"aaaabbbb", b"aaaabbbc", b"aaaabbcc", b"abbb"]):
        tree.add(key, name, [1] * (len(key) // 4))
    found = {(n["least"], n["depth"]): (n["count"], n["children"]) for n in tree.nodes()}
    # branches inside an id are no nodes: six distinct prefixes of whole turns
    assert len(found) == 6 and found[0, 0][0] == 6 and found[1, 1][0] == 4


def test_sequences_and_splices(spark):
    data = [
        (0, 1, "user", "a b"), (0, 0, "user", "z"), (0, None, None, None), (0, 1, "user", "a b"), (0, 1, "bot", "c"),
        (3, 0, "user", "q"), (23, 5, "user", "own"), (24, 0, "u", "x"), (None, 0, "u", "lost"), (1, 0, "ab", "c"), (2, 0, "a", "bc"),
    ]
    extra = spark.createDataFrame(data, TURNS).withColumn("words", F.lit("own")).withColumn("turns", F.lit(1))
    got = {r.conv_id: [(t.id, t.words) for t in r.turns] for r in prefix_trie.sequences(extra).collect()}

    def turn(role, text):
        return (sha(f"{len(role)}:{role}{text}")[:32], len(text.split()))

    assert got[0] == [turn("", ""), turn("user", "z"), turn("bot", "c"), turn("user", "a b"), turn("user", "a b")]
    assert None not in got and got[1] != got[2]
    spliced = {r.conv_id: [(t.id, t.words) for t in r.turns] for r in prefix_trie.spliced(prefix_trie.sequences(extra)).collect()}
    for c, own in got.items():
        h = zlib.crc32(str(c).encode()) % 4
        assert spliced[c] == (got.get(c - c % 20, [])[:h] + own[h:])
    none = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(prefix_trie.spliced(prefix_trie.sequences(none))).count() == 0


# --- manifest -------------------------------------------------------------------------------


def plain_manifest(table, fields=("doc_id", "source", "lang", "n_chars", "text")):
    def leaf(row):
        return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields))

    def lower(row):
        changed = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None
        return {**row, "text": "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])} if changed else row

    def order(v):
        return (v is not None, v.encode() if isinstance(v, str) else v or 0)

    def tree(digests):
        """Root, and for each leaf its runs from below: place and members."""
        runs, at, level = [[] for _ in digests], list(range(len(digests))), digests
        while len(level) > 1:
            for k, place in enumerate(at):
                low = place // 8 * 8
                runs[k].append((place - low, level[low : low + 8]))
            level = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
            at = [place // 8 for place in at]
        return level[0], runs

    parts = {}
    for row in table:
        parts.setdefault(row["lang"], []).append(row)
    langs = sorted(parts, key=order)
    trees = {}
    for lang in langs:
        parts[lang].sort(key=lambda r: (order(r["doc_id"]), leaf(r)))
        trees[lang] = tree([leaf(r) for r in parts[lang]])
    root, above = tree([trees[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for k, lang in enumerate(langs):
        subroot, runs = trees[lang]
        for row, own in zip(parts[lang], runs, strict=True):
            node, others = leaf(lower(row)), ""
            for place, run in own + above[k]:
                others += "".join(run[:place] + run[place + 1 :])
                node = sha("".join(run[:place] + [node] + run[place + 1 :]))
            out.append((row["doc_id"], leaf(row), subroot, root, sha(others), node, node == root))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


DOC = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def test_manifest_against_lists(spark):
    r = random.Random(5)
    tables = [[], [(1, "s", "en", 3, "ABC")], [(None, None, None, None, None)] * 3]
    for sizes in ({"en": 8}, {"en": 9, None: 1, "": 2}, {"de": 65, "en": 64, "fr": 1, "zz": 130}, {f"l{k}": 1 + k % 3 for k in range(75)}):
        tables.append([
            (None if r.random() < 0.05 else r.randrange(99), r.choice(["s", None]), lang, r.choice([3, None]), r.choice(["ÀBc D", "", None, "é" * 50]))
            for lang, n in sizes.items() for _ in range(n)
        ])
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    for table in tables:
        df = spark.createDataFrame(table, DOC)
        for other in ("leaf", "rank", "n", "tree", "given", "root", "path"):
            df = df.withColumn(other, F.lit("own"))
        assert rows(merkle.audit(df)) == plain_manifest([dict(zip(names, row, strict=True)) for row in table])


def test_proofs_of_some_leaves(spark):
    df = spark.range(0, 300).selectExpr("id as doc_id", "'s' as source", "if(id < 290, 'a', 'b') as lang", "id as n_chars", "repeat('x', cast(id as int)) as text")
    made = merkle.build(df)
    # every digest once, and its children give it
    store = made.records().collect()
    assert len({x.digest for x in store}) == len(store) == 37 + 5 + 1 + 2 + 1 + 1
    assert all(sha("".join(x.children)) == x.digest for x in store)
    asked = spark.createDataFrame([("=a", 0), ("=a", 289), ("=b", 9), ("=b", 9), ("=a", 290), ("=c", 0)], "tree string, rank bigint")
    some = merkle.proofs(made, asked).withColumn("ok", merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"))
    assert rows(some.select("doc_id", "ok")) == [(0, True), (289, True), (299, True)]
    assert rows(some.select("doc_id", "path")) == rows(merkle.proofs(made).filter("doc_id in (0, 289, 299)").select("doc_id", "path"))
