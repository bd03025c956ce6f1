"""Removal of repeated byte strings: suffixes that share their first 400 bytes, by deep-shallow sorting.

Every byte is removed that lies in a 400-byte string which also starts anywhere else in the corpus,
in the same text or another.  Texts are UTF-8 bytes; a removed run may begin or end inside a
character.  Strings are judged on the input, and none reaches over the end of a text.

Of each 400-byte string, its *seed* is its 100-byte part of smallest hash, the leftmost of those:
equal strings have equal seeds at equal offsets, so only strings with a repeated seed are sorted, and
only against those with the same one.  An *occurrence* is a place whose neighbouring strings share a
seed; its *context* are the bytes of all these strings.  Contexts that occur twice are repeated as a
whole, and count as one in the sort.  The different contexts of a seed are gathered, their strings
sorted, and equal neighbours in that order are the repeated strings.  As all strings of a context
overlap, its first and last repeated string say what is covered.

A seed with very many different contexts is not sorted in one task: its strings are divided by their
offset, and each half by what all its strings have in common, until every part is small.

Null and empty texts have no strings and keep no bytes.  Rows that agree in id and text are rows of
their own, so each repeats the other.  Ids may be of any type and null.  Seeds only gather candidates;
contexts are told apart by 128 bits of hash.  An empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import pick, rows_of, small_batches, stored
from tidemark.llm.deep_shallow import deep_shallow

#: Bytes of a repeated string, and of its seed.
SPAN, SEED = 400, 100
#: Different contexts of a seed that one task sorts, at most.
MOST_CONTEXTS = 4_000
#: Strings that are sorted at a time.
AT_ONCE = 300_000
#: Bytes that are hashed at a time; a place within them takes 24 bits.
PIECE, _PLACE = 1 << 17, np.uint64((1 << 24) - 1)


class Seeds:
    """Seeds of all strings of a buffer of texts."""

    def __init__(self, span: int, seed: int):
        self.span, self.seed = span, seed
        self._bytes = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x9E3779B97F4A7C15
        self._powers, self._inverse = self._series(base), self._series(pow(base, -1, 1 << 64))

    def _series(self, base: int) -> np.ndarray:
        out = np.full(PIECE + 2 * self.span, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """Hash of the seed-long string at every place, modulo 2^64."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._bytes[data] * self._powers[: len(data)], out=sums[1:])
        out = (sums[self.seed :] - sums[: -self.seed]) * self._inverse[: len(data) + 1 - self.seed]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(29))

    def chosen(self, hashes: np.ndarray) -> np.ndarray:
        """Place of the seed of the string that starts at every place."""
        values = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width, least, k = self.span - self.seed + 1, values, 1
        while 2 * k <= width:
            least = np.minimum(least[:-k], least[k:])
            k *= 2
        n = len(values) - width + 1
        return (np.minimum(least[:n], least[width - k : width - k + n]) & _PLACE).astype(np.int64)

    def occurrences(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Text, place of the seed, its first and last string, and hash, for texts that end at ``ends``."""
        for a in range(0, max(len(data) - self.span + 1, 0), PIECE):
            hashes = self.hashes(data[a : a + PIECE + self.span - 1])
            seeds = self.chosen(hashes)
            places = np.arange(a, a + len(seeds))
            texts = np.searchsorted(ends, places, side="right")
            inside = np.flatnonzero(ends[texts] - places >= self.span)
            if len(inside):
                seed = seeds[inside]
                cuts = np.flatnonzero(np.diff(seed)) + 1
                first = np.concatenate([[0], cuts])
                last = np.concatenate([cuts, [len(seed)]]) - 1
                yield texts[inside[first]], seed[first] + a, inside[first] + a, inside[last] + a, hashes[seed[first]]


def occurrences(docs: DataFrame, span: int, seed: int) -> DataFrame:
    """``id, text_hash, at, least, most, seed, context`` of ``id, text_hash, bytes``.

    ``at`` is the place of the seed; strings of the context start ``least`` to ``most`` bytes before.
    """
    fields = [docs.schema["id"], docs.schema["text_hash"]]
    schema = T.StructType([*fields, *T.StructType.fromDDL("at bigint, least int, most int, seed bigint, context binary").fields])
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Seeds(span, seed)
        for batch in rows_of(batches):
            column = batch.column("bytes")
            wide = pa.types.is_large_binary(column.type)
            bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
            if bounds[-1] == bounds[0]:
                continue
            raw = memoryview(column.buffers()[2])[int(bounds[0]) : int(bounds[-1])]
            bounds = bounds.astype(np.int64) - int(bounds[0])
            for text, at, first, last, hashes in finder.occurrences(np.frombuffer(raw, np.uint8), bounds[1:]):
                contexts = [
                    xxhash.xxh3_128_digest(b"%d:%b" % (most, raw[a:b]))
                    for most, a, b in zip((at - first).tolist(), first.tolist(), (last + span).tolist(), strict=True)
                ]
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(rows), batch.column("text_hash").take(rows), pa.array(at - bounds[text]),
                        pa.array((at - last).astype(np.int32)), pa.array((at - first).astype(np.int32)), pa.array(hashes.view(np.int64)),
                        pa.array(contexts, pa.binary()),
                    ],
                    names,
                )

    return docs.mapInArrow(work, schema)


def _repeated(part: list[tuple], span: int) -> list[tuple]:
    """``context, least, most`` of the contexts ``part, context, least, most, body`` with a string
    that another one of the same part has at the same offset."""
    data = b"".join(row[4] for row in part) + bytes(8)
    counts = np.array([row[3] - row[2] + 1 for row in part])
    begins = np.cumsum([0, *(len(row[4]) for row in part[:-1])])
    owner = np.repeat(np.arange(len(part)), counts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + inner
    parts = np.cumsum([0, *(a[0] != b[0] for a, b in zip(part, part[1:], strict=False))])
    found: dict[int, list[int]] = {}
    for equal in deep_shallow(data, starts, parts[owner], span):
        if len(equal) > 1:
            for start in equal:
                k = int(np.searchsorted(begins, start, side="right")) - 1
                offset = part[k][3] - (start - int(begins[k]))
                seen = found.setdefault(k, [offset, offset])
                seen[0], seen[1] = min(seen[0], offset), max(seen[1], offset)
    return [(part[k][1], least, most) for k, (least, most) in found.items()]


def sort_parts(parts: DataFrame, span: int) -> DataFrame:
    """Repeated strings of the contexts of ``part, context, least, most, body``, part by part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            found = _repeated(rows, span)
            columns = zip(*found, strict=True) if found else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.int32()), strict=True)], ["context", "least", "most"]
            )

        held: list[tuple] = []
        strings = 0
        for batch in rows_of(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "context", "least", "most", "body")), strict=True):
                if strings >= AT_ONCE and row[0] != held[-1][0]:
                    yield done(held)
                    held, strings = [], 0
                held.append(row)
                strings += row[3] - row[2] + 1
        if held:
            yield done(held)

    ordered = parts.select("part", "context", "least", "most", "body").repartition("part").sortWithinPartitions("part")
    return ordered.mapInArrow(work, "context binary, least int, most int")


def halved(parts: DataFrame, span: int) -> DataFrame:
    """Parts with their strings divided by offset: ``low`` to ``high`` becomes two halves.

    A half's strings all contain the bytes from ``low`` before the seed's place up to ``span - high``
    after it; these name the new part, so equal strings stay together.
    """
    middle = F.expr("(low + high) div 2").cast("int")
    halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high").alias("high")))
    each = parts.withColumn("half", F.explode(halves)).drop("low", "high").select("*", "half.low", "half.high").drop("half")
    least, most = F.greatest("least", "low"), F.least("most", "high")
    each = each.withColumns({"__least": least, "__most": most}).filter("__least <= __most")
    # the body starts ``most`` bytes before the seed
    body = F.substring("body", F.col("most") - F.col("__most") + 1, F.col("__most") - F.col("__least") + span)
    core = F.substring("body", F.col("most") - F.col("low") + 1, F.col("low") - F.col("high") + span)
    return each.select(
        F.sha2(F.concat(F.col("part").cast("string").cast("binary"), F.format_string(":%d:%d:", "low", "high").cast("binary"), core), 256).alias("part"),
        "context", F.col("__least").alias("least"), F.col("__most").alias("most"), body.alias("body"), "low", "high",
    )


def matched(parts: DataFrame, span: int, seed: int, most_contexts: int) -> DataFrame:
    """``context, least, most``: first and last repeated string of the contexts in ``parts``.

    ``parts`` has ``part, context, least, most, body``.  Parts with more than ``most_contexts``
    different bodies are halved until none is left; a body that several contexts have is sorted once.
    """
    wide = parts.withColumns({"part": F.col("part").cast("string"), "low": F.lit(0), "high": F.lit(span - seed)})
    found = None
    for step in range((span - seed + 1).bit_length() + 1):
        sizes = wide.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_contexts)
        large = stored(sizes.select("part"), "large-parts")
        some_large = not large.isEmpty()
        small = wide.join(large, "part", "left_anti") if some_large else wide
        done = sort_parts(small, span)
        found = done if found is None else found.unionByName(done)
        if not some_large:
            break
        halves = halved(wide.join(large, "part", "left_semi"), span)
        # equal bodies of a half are repeated as a whole, and go on as one
        body = F.xxhash64("body"), F.sha2("body", 256)
        named = stored(halves.withColumn("same", F.concat(body[1], F.format_string(":%d", "most"))), f"halves-{step}")
        groups = named.groupBy("part", "same").agg(
            F.count(F.lit(1)).alias("n"), F.first("context").alias("context"), F.first("least").alias("least"), F.first("most").alias("most"),
            F.first("body").alias("body"), F.first("low").alias("low"), F.first("high").alias("high"),
        )
        groups = stored(groups, f"half-groups-{step}")
        whole = named.join(groups.filter("n > 1").select("part", "same"), ["part", "same"], "left_semi")
        found = found.unionByName(whole.select("context", "least", "most"))
        wide = groups.select("part", "context", "least", "most", "body", "low", "high")
        # a part of one string, or of one body, is done
        wide = wide.filter("low < high")
    return found


def covered(docs: DataFrame, span: int = SPAN, seed: int = SEED, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """``id, text_hash, runs`` of the rows ``id, text_hash, bytes`` that lose bytes.

    ``runs`` are covered places as pairs of start and end, unordered and maybe overlapping.
    """
    often = occurrences(docs, span, seed).groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")
    # a stored side, so that a seed with very many occurrences can be split over tasks
    often = stored(often, "seeds")
    # found again rather than stored: most seeds occur once
    found = stored(occurrences(docs, span, seed).join(often, "seed"), "occurrences")
    # the place of any occurrence: its context has the same bytes everywhere
    kinds = found.groupBy("seed", "context").agg(
        F.count(F.lit(1)).alias("n"), F.first("least").alias("least"), F.first("most").alias("most"),
        F.first(F.struct("id", "text_hash", "at")).alias("place"),
    )
    kinds = stored(kinds, "contexts")
    several = kinds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")
    sorted_ones = kinds.join(several, "seed", "left_semi").select(
        F.col("place.id").alias("of"), F.col("place.text_hash").alias("of_hash"),
        F.struct("seed", "context", "least", "most", F.col("place.at").alias("at")).alias("kind"),
    )
    wanted = sorted_ones.groupBy("of", "of_hash").agg(F.collect_list("kind").alias("kinds"))
    # rows that agree in id and text give the same bodies
    at = docs.join(wanted, (F.col("text_hash") == F.col("of_hash")) & F.col("id").eqNullSafe(F.col("of")))
    body = F.transform(
        "kinds",
        lambda k: F.struct(
            k["seed"].alias("part"), k["context"].alias("context"), k["least"].alias("least"), k["most"].alias("most"),
            F.substring("bytes", (k["at"] - k["most"] + 1).cast("int"), k["most"] - k["least"] + span).alias("body"),
        ),
    )
    parts = stored(at.select(F.explode(body).alias("k")).select("k.*").dropDuplicates(["part", "context"]), "parts")
    repeats = kinds.filter("n > 1").select("context", "least", "most").unionByName(matched(parts, span, seed, most_contexts))
    repeats = repeats.groupBy("context").agg(F.min("least").alias("to"), F.max("most").alias("from"))
    runs = found.join(repeats, "context").select(
        "id", "text_hash", F.struct((F.col("at") - F.col("from")).alias("start"), (F.col("at") - F.col("to") + span).alias("end")).alias("run")
    )
    return runs.groupBy("id", "text_hash").agg(F.collect_set("run").alias("runs"))


def suffix_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, seed: int = SEED, most_contexts: int = MOST_CONTEXTS
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: what each text loses, and its other bytes.

    ``kept`` is binary, as a run may cut a character; ``n_spans`` counts the longest runs.
    """
    small_batches(docs.sparkSession)
    rows = pick(docs, id=doc_id, text=text).select(
        "id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("bytes")
    )
    lost = covered(rows.filter(F.octet_length("bytes") >= span), span, seed, most_contexts)
    lost = lost.select(F.col("id").alias("of"), F.col("text_hash").alias("of_hash"), "runs")
    joined = rows.join(lost, (F.col("text_hash") == F.col("of_hash")) & F.col("id").eqNullSafe(F.col("of")), "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            out = []
            for raw, runs in zip(batch.column("bytes").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                kept, at, n = [], 0, 0
                for run in sorted((r["start"], r["end"]) for r in runs or ()):
                    # runs that touch are one
                    if run[0] > at or n == 0:
                        kept.append(raw[at : run[0]])
                        n += 1
                    at = max(at, run[1])
                kept.append(raw[at:])
                whole = b"".join(kept)
                out.append((len(raw), len(raw) - len(whole), n, whole))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    fields = T.StructType.fromDDL("n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").fields
    schema = T.StructType([T.StructField("doc_id", rows.schema["id"].dataType), *fields])
    return joined.select("id", "bytes", "runs").mapInArrow(work, schema)
