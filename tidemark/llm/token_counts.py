"""Token counts by a two-tier lookup in the map tasks; no pre-token is ever shuffled.

First tier: a table of the lengths of frequent pre-tokens, packed into two byte strings and
broadcast; its size is a parameter.  Second tier: what the table lacks is encoded by the
library, once per worker as long as its cache (of bounded size) holds the word.  The table only
saves time: it is taken from a bounded sample, and any table gives the same counts.

Null texts count as empty: 0 bytes, 0 tokens.  Repeated rows are counted once each, an empty
table gives an empty result, and further columns of the input are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.bpe import PreTokens, Words, load_tokenizer
from tidemark.llm.common import pick, rows_of, worker_state

#: Pre-tokens in the broadcast table, at most.
TABLE_WORDS = 50_000
#: Texts the table is taken from, at most, and their length in characters, at most.
SAMPLE_TEXTS, SAMPLE_CHARS = 2_000, 20_000
#: Bytes that a worker keeps of other pre-tokens, in each of two generations.
CACHE_BYTES = 64 << 20


class TokenCounter:
    """Token count of a text by the two tiers."""

    def __init__(self, spec: str, odd: str, table: dict[str, int]):
        self.pre = PreTokens(spec, odd)
        self._library = Tokenizer.from_str(spec)
        self._library.no_truncation()
        self._library.no_padding()
        self._frequent = _Tiers(table, Words(self._encode, CACHE_BYTES))

    def _encode(self, word: str) -> int:
        return len(self._library.encode(word, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        get = self._frequent.__getitem__
        total = 0
        for k, part in enumerate(self.pre.parts(text)):
            total += 1 if k % 2 else sum(map(get, self.pre.words(part)))
        return total


class _Tiers(dict):
    def __init__(self, table: dict[str, int], others: Words):
        super().__init__(table)
        self._others = others

    def __missing__(self, word: str) -> int:
        return self._others[word]


def frequent_lengths(docs: DataFrame, spec: str, odd: str, words: int = TABLE_WORDS) -> tuple[bytes, bytes]:
    """Packed table of frequent pre-tokens: texts joined by NUL, and 16 bits of length each."""
    texts = (
        docs.filter(F.length("text").between(1, SAMPLE_CHARS)).select("text").limit(SAMPLE_TEXTS).collect()
    )
    pre, counts = PreTokens(spec, odd), Counter()
    for row in texts:
        for part in pre.parts(row.text)[::2]:
            counts.update(pre.words(part))
    library = Tokenizer.from_str(spec)
    chosen = [w for w, _ in counts.most_common(words) if "\0" not in w and len(w) <= 64]
    lengths = [len(e.ids) for e in library.encode_batch(chosen, add_special_tokens=False)] if chosen else []
    return "\0".join(chosen).encode(), np.array(lengths, "<u2").tobytes()


def unpack(table: tuple[bytes, bytes]) -> dict[str, int]:
    return dict(zip(table[0].decode().split("\0"), np.frombuffer(table[1], "<u2").tolist(), strict=True)) if table[1] else {}


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    ``tokenizer`` is the path of a byte-level tokenizer file on the driver.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id=doc_id, text=text)
    spec, odd = load_tokenizer(tokenizer)
    key = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast((spec, odd, frequent_lengths(rows, spec, odd)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, unusual, table = shared.value
        counter = worker_state(key, lambda: TokenCounter(spec, unusual, unpack(table)))
        for batch in rows_of(batches):
            counts = [counter.count(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    sized = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )
    return sized.mapInArrow(work, schema).withColumn("over_limit", F.col("n_tokens") > limit)
