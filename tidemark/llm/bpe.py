"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a pre-token there is exactly one last token of its BPE encoding.  The
tokens that end at a position are the suffix matches of an automaton over the vocabulary; a
match of length ``n`` is the last token when it is compatible with the last token ``n`` places
earlier, which the merge table decides.  Back-pointers then give the ids.  No merge is ever
simulated, and the time is linear in the text for a fixed vocabulary.

``encode`` and ``decode`` are the operators.  Null texts count as empty, an empty text has no
ids, repeated rows are encoded once each, and an empty table gives an empty table.  A column of
the input that has the name of a result column is replaced by the result.
"""

from __future__ import annotations

import functools
import json
import re
import struct
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.common import pick, rows_of, worker_state

#: Split of texts before the merges, as the byte-level pre-tokenizer defines it (fixed value).
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes that a worker keeps of encoded chunks and of words, in each of two generations.
CHUNK_BYTES, WORD_BYTES = 64 << 20, 32 << 20
#: Pair tests a worker keeps.
CACHE_PAIRS = 200_000


def read_tokenizer(path: str) -> str:
    """Tokenizer file as text, read on the driver; executors get it as a broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


@functools.lru_cache(maxsize=8)
def load_tokenizer(path: str) -> tuple[str, str]:
    """Tokenizer file as text, and its odd characters."""
    spec = read_tokenizer(path)
    return spec, odd_characters(spec)


def byte_characters() -> str:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    shown = set(plain)
    return "".join(chr(b) if b in shown else chr(next(others)) for b in range(256))


def odd_characters(spec: str) -> str:
    """Letters, digits and spaces that the library takes for other characters."""
    pre_tokenizer = Tokenizer.from_str(spec).pre_tokenizer
    classed = regex.compile(r"[\p{L}\p{N}\s]")
    chars = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and classed.match(chr(c))]
    odd = []
    for k in range(0, len(chars), 20_000):
        part = chars[k : k + 20_000]
        starts = {start for _, (start, _) in pre_tokenizer.pre_tokenize_str("".join("!" + c for c in part))}
        odd += [c for j, c in enumerate(part) if 2 * j + 1 not in starts]
    return "".join(odd)


class PreTokens:
    """Splits texts into special strings and pre-tokens exactly as the library does.

    The library may know an older Unicode: characters that only the newer one calls letters,
    digits or spaces are found by asking the library, and split as it splits them.
    """

    def __init__(self, spec: str, odd: str | None = None):
        conf = json.loads(spec)
        pre = conf.get("pre_tokenizer") or {}
        if (
            conf.get("normalizer")
            or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space")
            or not pre.get("use_regex", True)
        ):
            raise ValueError("only byte-level tokenizers without a normalizer are supported")
        self.special = {}
        for token in conf.get("added_tokens", []):
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"added token {token['content']!r} has options that are not supported")
            self.special[token["content"]] = token["id"]
        ordered = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self._find = regex.compile(PRE_TOKEN)
        self._odd = frozenset(odd_characters(spec) if odd is None else odd)
        self._least_odd = min(self._odd, default="")
        self._some = re.compile(f"[{self._least_odd}-\U0010ffff]") if self._odd else None
        # a blank at an end or beside white space, by any reading of white space
        self._joined = re.compile(r"\A | \Z|[\s\x1c-\x1f\x85\u180e\u200b\ufeff] | [\s\x1c-\x1f\x85\u180e\u200b\ufeff]")

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if self._some and self._some.search(text) and not self._odd.isdisjoint(text):
            # a private-use character is none of letter, digit and space in any version
            shown = text.translate({ord(c): "\ue000" for c in self._odd.intersection(text)})
            return [text[m.start() : m.end()] for m in self._find.finditer(shown)]
        return self._find.findall(text)

    def plain(self, text: str) -> bool:
        """Whether every blank stands alone and no character is odd."""
        if self._joined.search(text):
            return False
        return not (self._some and self._some.search(text) and not self._odd.isdisjoint(text))

    def parts(self, text: str) -> list[str]:
        """The text cut at special strings, which have the odd places."""
        return self._special.split(text) if self._special else [text]


class Codec:
    """Encoder of one byte-level BPE vocabulary."""

    def __init__(self, spec: str, odd: str | None = None):
        conf = json.loads(spec)
        model = conf["model"]
        if model["type"] != "BPE" or any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        ):
            raise ValueError("only plain byte-level BPE models are supported")
        self.pre = PreTokens(spec, odd)
        shown = byte_characters()
        self._shown = {b: c for b, c in enumerate(shown)}
        vocab = model["vocab"]
        # tokens by order of their merge; single bytes come first
        order = {c: k for k, c in enumerate(shown)}
        self.left, self.right = list(range(256)), list(range(256))
        self.pairs: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a + b in order:
                raise ValueError(f"two merges make the token {a + b!r}")
            self.pairs[order[a], order[b]] = order[a + b] = len(order)
            self.left.append(order[a])
            self.right.append(order[b])
        self.ids = [vocab[token] for token in order]
        self.match = ahocorasick.Automaton()
        for token, k in order.items():
            self.match.add_word(token, (len(token), k))
        self.match.make_automaton()
        self._tested: dict[tuple[int, int], bool] = {}
        self._words = Words(self.encode_word, WORD_BYTES)
        self._chunks = Words(self._encode_chunk, CHUNK_BYTES)

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens ``a`` and ``b`` side by side.

        The later-made one is undone step by step, down to the tokens that touched when the
        pair could have merged: the pair fails if a merge across the border came before the
        merges that made the two sides what they are.
        """
        key = (a, b)
        known = self._tested.get(key)
        if known is None:
            known = self._compatible(a, b)
            if len(self._tested) >= CACHE_PAIRS:
                self._tested.clear()
            self._tested[key] = known
        return known

    def _compatible(self, a: int, b: int) -> bool:
        before = len(self.ids)  # merges across the border count if they come before this one
        while True:
            if self.pairs.get((a, b), before) < before:
                return False
            if a > b:
                if a < 256:
                    return True
                before, a = a, self.right[a]
                if a < 256 and b < 256:
                    return self.pairs.get((a, b), before) >= before
            else:
                if b < 256:
                    return True
                # a merge of the same rank to the left happens first
                before, b = b + 1, self.left[b]
                if a < 256 and b < 256:
                    return self.pairs.get((a, b), before) >= before

    def encode_word(self, word: str) -> bytes:
        """Ids of a pre-token as little-endian 32-bit integers."""
        text = word.encode().decode("latin-1").translate(self._shown)
        last: list[int] = [-1] * len(text)
        size: list[int] = [0] * len(text)
        for end, (n, token) in self.match.iter(text):
            if size[end]:
                continue
            if n == end + 1 or (size[end - n] and self.compatible(last[end - n], token)):
                last[end], size[end] = token, n
        out, at = [], len(text) - 1
        while at >= 0:
            out.append(self.ids[last[at]])
            at -= size[at]
        out.reverse()
        return struct.pack(f"<{len(out)}I", *out)

    def _encode_whole(self, part: str) -> bytes:
        return b"".join(map(self._words.__getitem__, self.pre.words(part)))

    def _encode_chunk(self, chunk: str) -> bytes:
        return self._encode_whole(" " + chunk)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers.

        Where each blank stands alone between other characters than white space, no pre-token
        reaches over the place before a blank, so the chunks between blanks are looked up whole.
        """
        get, out = self._chunks.__getitem__, []
        for k, part in enumerate(self.pre.parts(text)):
            if k % 2:
                out.append(struct.pack("<I", self.pre.special[part]))
            elif part and self.pre.plain(part):
                first, *rest = part.split(" ")
                out.append(self._encode_whole(first))
                out.extend(map(get, rest))
            elif part:
                out.append(self._encode_whole(part))
        return b"".join(out)


class Decoder:
    """The bytes of each id of a byte-level vocabulary."""

    def __init__(self, spec: str, odd: str | None = None):
        conf = json.loads(spec)
        plain = {c: b for b, c in enumerate(byte_characters())}
        self.bytes_of = {i: bytes(plain[c] for c in token) for token, i in conf["model"]["vocab"].items()}
        self.bytes_of |= {token["id"]: token["content"].encode() for token in conf.get("added_tokens", [])}

    def decode(self, packed: bytes) -> str:
        """Text of packed ids, special tokens included; broken UTF-8 gives U+FFFD."""
        ids = array("I")
        ids.frombytes(packed)
        if struct.pack("=I", 1) != struct.pack("<I", 1):
            ids.byteswap()
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Words(dict):
    """Results by word, kept in two generations, each of at most ``most`` bytes (by estimate)."""

    #: Bytes of an entry beside its characters: dictionary slot, object heads, a small result.
    ENTRY = 180

    def __init__(self, make, most: int):
        super().__init__()
        self._make, self._most, self._held, self._older = make, most, 0, {}

    def __missing__(self, word: str):
        value = self._older.get(word)
        if value is None:
            value = self._make(word)
        if len(word) <= 256:
            if self._held >= self._most:
                self._older = dict(self)
                self.clear()
                self._held = 0
            self[word] = value
            self._held += self.ENTRY + 2 * len(word)
        return value


def encode(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = False
) -> DataFrame:
    """Token ids of every text: ``doc_id, ids, n_tokens``, and ``decoded`` if asked for.

    ``ids`` is binary, little-endian unsigned 32-bit integers, the layout of training shards;
    ``tokenizer`` is the path of the tokenizer file on the driver.  ``decoded`` is the text that
    the ids give, as by ``decode``, but in the same pass.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    spec = _shared(docs.sparkSession, tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, decoder = worker_state(("codec", hash(spec.value)), lambda: (Codec(*spec.value), Decoder(*spec.value)))
        for batch in rows_of(batches):
            packed = [codec.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
            arrays = [
                batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64()),
            ]
            if decoded:
                arrays.append(pa.array(map(decoder.decode, packed), pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "n_tokens", "decoded"][: len(arrays)])

    fields = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    return rows.mapInArrow(work, T.StructType([rows.schema["doc_id"], *fields]))


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of the packed ids, special tokens included, to the other columns.

    Null ids give null; ids that the vocabulary lacks raise KeyError.
    """
    spark = encoded.sparkSession
    spec = _shared(spark, tokenizer)
    rest = encoded.drop(out)
    place = rest.columns.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_state(("decoder", hash(spec.value)), lambda: Decoder(*spec.value))
        for batch in rows_of(batches):
            texts = [None if p is None else codec.decode(p) for p in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out]
            )

    return rest.mapInArrow(work, T.StructType([*rest.schema.fields, T.StructField(out, T.StringType())]))


def _shared(spark: SparkSession, path: str):
    """Broadcast of the tokenizer file: its size is the vocabulary's, whatever the data."""
    return spark.sparkContext.broadcast(load_tokenizer(path))


def digest(packed) -> F.Column:
    """Lowercase hex SHA-256 of a binary or text column."""
    return F.sha2(packed.cast("binary"), 256)
