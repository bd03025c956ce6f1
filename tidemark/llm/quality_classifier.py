"""Quality classifier with learned subword vectors.

A text is the mean of the vectors of its words, of their character n-grams, and of its pairs of
neighbouring words, found by hash in one learned table.  Pairs of words that are new in a text
teach nothing about others, so a pair is hashed by its pattern: whether a word repeats the one
before it, or the one before that; a softmax layer over that mean gives the class.  Table and layer are trained
by stochastic gradient descent in numpy on the driver, on a bounded sample of labelled rows.
Every text is then scored whole, in the map tasks: as the layer is linear, each hashed feature
counts as one number, and a worker keeps the sums of the words it has seen.

Null and empty texts have no features and get the score of the layer's bias.  Without labelled
rows, or with one class only, the score is that class's share (0.5 without rows).  Repeated rows
get equal scores, an empty table gives an empty result, and further columns are ignored.
"""

from __future__ import annotations

import math
import operator
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import Words
from tidemark.llm.common import give_back, named, numbered, pick, position, rows_of, worker_state

#: Hashed features, vector length, and n-gram lengths.
BUCKETS, DIM, GRAMS = 1 << 17, 10, (3, 4, 5)
#: Training rows at most, and the length of their texts in characters at most.
SAMPLE_ROWS, SAMPLE_CHARS = 2_500, 50_000
EPOCHS, RATE, SEED = 4, 1.0, 13
#: Bytes that a worker keeps of the sums of words, in each of two generations.
CACHE_BYTES = 96 << 20


def features(word: str) -> list[int]:
    """Hashed ids of a word and of its character n-grams."""
    marked = f"<{word}>"
    parts = [marked[k : k + n] for n in GRAMS for k in range(len(marked) - n + 1)]
    return [zlib.crc32(part.encode()) % BUCKETS for part in ("w" + word, *parts)]


def repeats(words: list[str]) -> tuple[int, int]:
    """Words equal to the one before, and to the one two places before."""
    return sum(map(operator.eq, words, words[1:])), sum(map(operator.eq, words, words[2:]))


#: A repeat counts as many features, like a word with its n-grams.
PATTERN_WEIGHT = 16
#: Ids of the two pair patterns.
PATTERNS = [zlib.crc32(b"p1") % BUCKETS, zlib.crc32(b"p2") % BUCKETS]


@dataclass
class Model:
    """What each feature adds to the log odds of label 1, and the odds without features."""

    weight: list[float]
    bias: float

    def contribution(self, word: str) -> complex:
        """Sum of the word's features, and their number as imaginary part."""
        ids = features(word)
        return complex(sum(map(self.weight.__getitem__, ids)), len(ids))

    def odds(self, text: str | None, get) -> float:
        """Log odds of label 1 of a whole text; ``get`` gives a word's contribution."""
        words = text.split() if text else []
        total = sum(map(get, words), 0j)
        same = repeats(words)
        value = total.real + sum(n * PATTERN_WEIGHT * self.weight[i] for n, i in zip(same, PATTERNS, strict=True))
        return value / max(total.imag + PATTERN_WEIGHT * sum(same), 1.0) + self.bias


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Vectors and softmax layer by gradient descent, one document a step."""
    ones = sum(labels)
    if not labels or ones in (0, len(labels)):
        share = ones / len(labels) if labels else 0.5
        odds = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model([0.0] * BUCKETS, odds)
    rng = np.random.default_rng(seed)
    known: dict[str, np.ndarray] = {}
    docs = []
    for text in texts:
        words = text.split()
        counts = Counter(words)
        for word in counts.keys() - known.keys():
            known[word] = np.array(features(word), np.int32)
        parts = [known[w] for w in counts]
        same = [PATTERN_WEIGHT * n for n in repeats(words)]
        every = np.concatenate([*parts, np.array(PATTERNS, np.int32)])
        times = np.concatenate([np.repeat(list(counts.values()), [len(p) for p in parts]), same])
        ids, at = np.unique(every, return_inverse=True)
        share = np.bincount(at, weights=times)
        docs.append((ids, (share / max(share.sum(), 1)).astype(np.float32)))
    known.clear()
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            ids, share = docs[k]
            step = rate * (1 - done / steps)
            done += 1
            hidden = share @ table[ids]
            logits = hidden @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[k]] -= 1
            back = layer @ error
            layer -= step * np.outer(hidden, error)
            bias -= step * 0.1 * error
            # a mean over many features moves each by little, so the table takes larger steps
            table[ids] -= np.float32(step * 10) * share[:, None] * back
    weight = table.astype(np.float64) @ (layer[:, 1] - layer[:, 0]).astype(np.float64)
    return Model(weight.tolist(), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Model of at most ``sample_rows`` labelled rows, chosen by the hash of their id."""
    known = pick(labels, doc_id=doc_id, label=label).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    order = F.xxhash64("doc_id")
    chosen = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(order, "doc_id").limit(sample_rows)
    rows = pick(docs, doc_id=doc_id, text=text).filter(F.length("text").between(1, sample_chars))
    # the chosen ids are at most sample_rows; of rows that share an id, the smallest text counts
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    ordered = sorted(sample, key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.text))
    model = train([r.text for r in ordered], [int(r.label) for r in ordered])
    del sample, ordered
    # the driver lives on, so what training has used must not stay with it
    give_back()
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``score`` (0 to 1, of label 1) and ``predicted`` of every row, after ``doc_id`` or ``keep``.

    ``keep`` lists other columns to return; they must not be called ``score`` or ``predicted``.
    """
    kept = keep if keep is not None else ["doc_id"]
    rows = pick(docs, doc_id=doc_id, text=text) if keep is None else docs
    place = rows.columns.index("text" if keep is None else text)
    places = [rows.columns.index(c) for c in kept]
    key, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds_of = shared.value.odds
        get = worker_state(key, lambda: Words(shared.value.contribution, CACHE_BYTES)).__getitem__
        for batch in rows_of(batches):
            odds = [odds_of(t, get) for t in batch.column(place).to_pylist()]
            values = 1 / (1 + np.exp(-np.clip(np.array(odds, np.float64), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in places), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                [*kept, "score", "predicted"],
            )

    fields = [rows.schema.fields[k] for k in places]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(work, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, by a model of the labelled rows."""
    model = fit(docs, labels, doc_id, text, **options)
    return score(docs, model, doc_id, text).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents with a score of at least ``least``, with their own columns."""
    flat, names = numbered(docs)
    scored = score(flat, model, f"__in{position(docs, doc_id)}", f"__in{position(docs, text)}", keep=flat.columns)
    return named(scored.filter(F.col("score") >= least), names)
