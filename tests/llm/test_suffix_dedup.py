"""Deep-shallow sorting and the removal of repeated strings, against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.llm import suffix_dedup
from tidemark.llm.deep_shallow import deep_shallow, quicksort


def plain(table, span):
    seen = Counter(t[k : k + span] for _, t in table for k in range(len(t) - span + 1))
    out = []
    for name, t in table:
        gone = [False] * len(t)
        for k in range(len(t) - span + 1):
            if seen[t[k : k + span]] > 1:
                gone[k : k + span] = [True] * span
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((name, len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def texts_of(r, n):
    """Texts with copies, shared passages, passages that overlap themselves, and odd ones."""
    words = ["ab", "c", "é", "漢", "abab", " "]
    passages = ["".join(r.choice(words) for _ in range(r.randrange(5, 60))) for _ in range(4)]
    out = ["", "a", "a" * 100, "ab" * 40, None]
    while len(out) < n:
        parts = [r.choice(passages) if r.random() < 0.5 else "".join(chr(r.randrange(97, 110)) for _ in range(r.randrange(40))) for _ in range(r.randrange(5))]
        out.append("".join(parts))
        if r.random() < 0.2:
            out.append(out[-1])
    return out


def test_deep_shallow_order():
    r = random.Random(3)
    for length, letters in ((40, 2), (16, 1), (70, 3), (9, 2), (5, 2)):
        data = bytes(r.randrange(97, 97 + letters) for _ in range(500)) + b"\0\xff" * 40
        starts = np.array([r.randrange(len(data) - length) for _ in range(400)])
        groups = np.sort(np.array([r.randrange(5) for _ in range(400)]))
        got = list(deep_shallow(data + bytes(8), starts, groups, length, shallow=16))
        want = sorted((int(g), data[s : s + length]) for g, s in zip(groups, starts, strict=True))
        flat = [data[s : s + length] for places in got for s in places]
        assert flat == [text for _, text in want]
        assert len(got) == len(set(want))
    assert list(deep_shallow(b"", np.array([], np.int64), np.array([], np.int64), 8)) == []
    order, runs = quicksort(b"abcdefgh" * 4, np.array([0, 8]), np.array([0, 0]), 16)
    assert sorted(order) == [0, 8] and runs.tolist() == [0, 0]


@pytest.mark.parametrize("most", [2, 1000])
def test_removal_against_every_string(spark, most):
    r = random.Random(most)
    for span, seed, n in ((20, 5, 120), (12, 9, 60), (64, 16, 60)):
        texts = texts_of(r, n)
        table = [(k if k % 7 else None, t) for k, t in enumerate(texts)]
        table += table[5:12]
        df = spark.createDataFrame(table, "doc_id bigint, text string")
        for name in ("kept", "n_bytes", "id", "part", "runs", "bytes"):
            df = df.withColumn(name, F.lit("own"))
        got = suffix_dedup.suffix_dedup(df, span=span, seed=seed, most_contexts=most)
        got = [(*row[:4], bytes(row[4])) for row in rows(got)]
        assert sorted(got, key=lambda x: [(v is not None, str(v)) for v in x]) == plain([(k, (t or "").encode()) for k, t in table], span)


def test_many_contexts_of_one_passage(spark):
    """One passage in very many texts, each with other text around it."""
    r = random.Random(9)
    passage = "".join(r.choice("abcdefg") for _ in range(30))
    texts = ["".join(r.choice("hijklmnop") for _ in range(25)) + passage + "".join(r.choice("hijklmnop") for _ in range(25)) for _ in range(300)]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "doc_id string, text string")
    out = suffix_dedup.suffix_dedup(df, span=20, seed=5, most_contexts=10).collect()
    assert sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in out) == sorted(plain([(str(k), t.encode()) for k, t in enumerate(texts)], 20))
    assert all(r.n_removed >= 30 for r in out)


def test_long_texts_and_no_rows(spark):
    r = random.Random(1)
    unique = "".join(chr(r.randrange(97, 123)) for _ in range(300_000))
    again = unique[150_000:150_500]
    df = spark.createDataFrame([(1, unique), (2, "x" + again + "y"), (3, again[:399])], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.suffix_dedup(df).collect()}
    assert got[1] == (300_000, 500, 1, (unique[:150_000] + unique[150_500:]).encode())
    assert got[2] == (502, 500, 1, b"xy") and got[3] == (399, 0, 0, again[:399].encode())
    assert suffix_dedup.suffix_dedup(df.limit(0)).count() == 0
