"""Registry of queries, their checking SQL, and the canonical form both return."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.inputs import VIEWS, names_in

AS_OF = dt.date(2024, 1, 31)
DIGITS, NOISE_DIGITS = 6, 10

RUNNERS: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
PIECES: dict[str, str] = {}


def piece(name: str, sql: str) -> None:
    """Name an intermediate relation of the checking SQL."""
    PIECES[name] = sql.strip()


def query(name: str, oracle: str | None = None):
    """Register a query function over the workload steps, and its SQL."""

    def add(fn):
        RUNNERS[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def _decimal_rounding(sql: str) -> str:
    """Spell ``round(x, 6)`` as decimal rounding.

    Rounding a double scales it in binary, where an exact half may fall either way.
    """
    end = f", {DIGITS})"
    out, rest = "", sql
    while "round(" in rest:
        before, rest = rest.split("round(", 1)
        depth, k = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[k], 0)
            k += 1
        inner, rest = _decimal_rounding(rest[: k - 1]), rest[k:]
        if inner.endswith(end[:-1]):
            x = inner[: -len(end) + 1]
            out += f"{before}round(({x})::decimal(38, {NOISE_DIGITS}), {DIGITS})::double"
        else:
            out += f"{before}round({inner})"
    return out + rest


def compose(sql: str) -> str:
    """Prefix a SELECT with every input view and piece it needs."""
    sql = _decimal_rounding(sql)
    known = {**VIEWS, **PIECES}
    order: list[str] = []

    def visit(text: str) -> None:
        for dep in names_in(text, known):
            if dep not in order and known[dep] is not text:
                visit(known[dep])
                if dep not in order:
                    order.append(dep)

    visit(sql)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} as materialized (\n{known[n].strip()}\n)" for n in order)
    return f"with {ctes}\n{sql}"


def _text(dtype: T.DataType, c: Column) -> Column:
    if isinstance(dtype, T.StructType):
        return F.concat_ws(":", *[c[f.name].cast("string") for f in dtype.fields])
    return c.cast("string")


def canonical(df: DataFrame) -> DataFrame:
    """Doubles rounded, integers long, arrays sorted and joined, structs as text, sorted columns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            # the first rounding takes off summation noise, so that exact halves fall alike
            c = F.round(F.round(c.cast("double"), NOISE_DIGITS), DIGITS)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            element = f.dataType.elementType
            c = F.array_join(F.array_sort(F.transform(c, partial(_text, element))), "|")
        elif isinstance(f.dataType, T.StructType):
            c = _text(f.dataType, c)
        out.append(c.alias(f.name))
    return df.select(*out)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the cluster's checkpoint folder; on one machine, one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_steps"
