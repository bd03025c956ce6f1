"""Quality rules of documents and of the hosts they come from.

Each document is measured and checked against rules.  Failures are added up by host (its source
or domain); the host's rate of failure by each rule is shrunk towards the rate of all hosts by a
beta prior that is fitted to the hosts themselves, so a host with few documents is judged mostly
by the others.  A host whose shrunk rate by some rule is over the limit loses all its documents.

Null texts have no words.  A null host is a host of its own.  Repeated rows count as often as
they occur; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, rows_of, stored

#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
#: Words of a repeated window.
WINDOW = 5
#: Share of failing documents, after shrinking, beyond which a host is refused.
HOST_LIMIT = 0.5

RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
#: Rules that refuse a document whatever its host.
BASE = ("short", "repeats")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    name = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    if len(codes) == len(words):
        return 0
    # name windows of growing length, exactly: pairs of names get names of their own
    single, length = name, 1
    while length < window:
        step = length if 2 * length <= window else 1
        right = (name if step == length else single)[length:]
        left = name[: len(right)]
        right = right[: len(left)]
        _, name = np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)
        length += step
    often = np.bincount(name)[name] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of a text."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``doc_id, host``, the measures, and ``failed_<rule>`` of every row."""
    rows = pick(docs, doc_id=doc_id, host=host, text=text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            table = np.array([measure(t) for t in batch.column("text").to_pylist()], np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *(pa.array(c) for c in table.T)],
                ["doc_id", "host", *_MEASURES],
            )

    kinds = ", ".join(f"{m} bigint" for m in _MEASURES)
    types = dict(rows.dtypes)
    out = rows.mapInArrow(work, f"doc_id {types['doc_id']}, host {types['host']}, {kinds}")
    return out.select("*", *[F.expr(rule).alias(f"failed_{name}") for name, rule in RULES.items()])


def host_rates(measures: DataFrame) -> DataFrame:
    """``host, n_docs, rate_<rule>``: shrunk rates of failure by host."""
    hosts = measures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.col(f"failed_{r}").cast("long")).alias(f"bad_{r}") for r in RULES],
    )
    docs, n = F.sum("n_docs"), F.count(F.lit(1))
    # one row: the rate of all documents, and how far the hosts lie from it
    means = {r: (F.sum(f"bad_{r}") / docs).alias(f"m_{r}") for r in RULES}
    squares = {r: (F.sum(F.col(f"bad_{r}") * F.col(f"bad_{r}") / F.col("n_docs")) / docs).alias(f"q_{r}") for r in RULES}
    whole = hosts.agg(docs.alias("docs"), n.alias("hosts"), *means.values(), *squares.values()).first()
    rates = []
    for r in RULES:
        a, b = beta_prior(whole[f"m_{r}"], whole[f"q_{r}"], whole["docs"], whole["hosts"])
        rates.append(((F.col(f"bad_{r}") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))).alias(f"rate_{r}"))
    return hosts.select("host", "n_docs", *rates)


def beta_prior(mean: float | None, square: float | None, docs: int | None, hosts: int) -> tuple[float, float]:
    """Beta parameters by moments: the spread of the hosts beyond what chance explains.

    ``square`` is the mean squared rate of the hosts, weighted by documents.  Hosts that differ
    by no more than chance get the strongest prior, 1,000 documents; the weakest is one.
    """
    if not docs or mean is None or not 0 < mean < 1:
        return (0.0, 1.0) if not mean else (1.0, 0.0)
    spread = square - mean * mean - mean * (1 - mean) * hosts / docs
    strength = 1000.0 if spread <= 0 else mean * (1 - mean) / spread - 1
    strength = min(max(strength, 1.0), 1000.0)
    return mean * strength, (1 - mean) * strength


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """One row per input row: the measures, ``base_failed``, ``host_rate`` and ``kept``."""
    measures = stored(measured(docs, doc_id, text, host), "measures")
    rates = host_rates(measures).select(
        F.col("host").alias("of_host"), F.greatest(*[F.col(f"rate_{r}") for r in RULES]).alias("host_rate")
    )
    joined = measures.join(rates, F.col("host").eqNullSafe(F.col("of_host")), "left")
    failed = F.expr(" or ".join(f"failed_{r}" for r in BASE))
    return joined.select(
        "doc_id", "host", *_MEASURES, failed.alias("base_failed"), "host_rate",
        (~failed & (F.col("host_rate") <= limit)).alias("kept"),
    )
