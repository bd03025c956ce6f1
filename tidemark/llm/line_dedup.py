"""Line deduplication by overlapping three-line windows, in DataFrame operations only.

Every three consecutive lines of a text are a window.  A window that occurs more than once in
the corpus keeps its first occurrence, by document id and place; the lines of each later one are
removed, where windows overlap as one run.  Windows of three blank lines are not counted.

Null texts have no lines and stay null; a text with fewer than three lines has no window.
Rows that agree in id and text are one document and get the same result.  Ids may be of any type
that can be ordered, texts or numbers of any size; null ids come last.
A text that loses all its lines becomes empty; no row is dropped.  Windows are told apart by 128
bits of hash.  All columns of the input are returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, position, row_key, stored

#: Lines in a window.
WINDOW = 3


def later_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, row, starts``: where windows start that occurred before, for ``id, row, text``."""
    cut = docs.select("id", "row", F.split("text", "\n", -1).alias("lines"))
    beside = [F.slice("lines", k + 1, F.size("lines")) for k in range(window)]
    runs = cut.filter(F.size("lines") >= window).select(
        "id", "row", F.posexplode(F.arrays_zip(*[x.alias(f"l{k}") for k, x in enumerate(beside)])).alias("at", "run")
    )
    run = [F.col("run").getField(f"l{k}") for k in range(window)]
    whole = F.concat(*run)  # null where the last lines are passed
    each = runs.filter(whole.rlike(r"[^\x20\x09-\x0D]")).select(
        "id", "row", "at", F.xxhash64(*run).alias("h"), F.xxhash64(F.lit("second"), *reversed(run)).alias("g")
    )
    often = each.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))  # null if all are
    # only windows that repeat go on
    found = stored(each.join(often.filter("n > 1").drop("n"), ["h", "g"]).distinct(), "windows")
    keeper = found.filter("id <=> first").groupBy("h", "g").agg(F.min(F.struct("row", "at")).alias("keeper"))
    later = found.join(keeper, ["h", "g"]).filter("not (id <=> first) or struct(row, at) <> keeper")
    return later.groupBy("id", "row").agg(F.collect_set("at").alias("starts"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents with later repeats of windows removed from their text.

    The result has two further columns, ``n_lines`` and ``n_removed`` (of the text as it was),
    which replace columns of those names.
    """
    flat, names = numbered(docs)
    at_id, at_text = f"__in{position(docs, doc_id)}", f"__in{position(docs, text)}"
    key = row_key(F.col(at_id), F.col(at_text))
    later = later_windows(flat.select(F.col(at_id).alias("id"), key.alias("row"), F.col(at_text).alias("text")), window)
    keyed = flat.withColumn("__row", key)
    later = later.toDF("__id", "__later", "__starts")
    joined = keyed.join(later, (F.col("__row") == F.col("__later")) & F.col(at_id).eqNullSafe(F.col("__id")), "left")
    covered = F.flatten(F.transform("__starts", lambda s: F.sequence(s, s + (window - 1))))
    breaks = F.length(at_text) - F.length(F.translate(at_text, "\n", ""))
    joined = joined.withColumn("__lines", F.when(F.col("__starts").isNotNull(), F.split(at_text, "\n", -1)))
    joined = joined.withColumn("__kept", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), covered))
    shorter = F.array_join(F.transform("__kept", lambda k: F.get("__lines", k)), "\n")
    joined = joined.select(
        "*",
        F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("__n"),
        F.coalesce(F.size("__lines") - F.size("__kept"), F.lit(0)).cast("long").alias("__removed"),
        F.when(F.col("__kept").isNull(), F.col(at_text)).otherwise(shorter).alias("__text"),
    )
    kept = [k for k, n in enumerate(names) if n not in ("n_lines", "n_removed")]
    own = ["__text" if f"__in{k}" == at_text else f"__in{k}" for k in kept]
    out = joined.select(*own, "__n", "__removed")
    return out.toDF(*[names[k] for k in kept], "n_lines", "n_removed")
