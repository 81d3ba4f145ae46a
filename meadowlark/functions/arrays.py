"""Loops over arrays by higher-order functions, in time in proportion to the array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, though lambdas of ``use`` refer to it often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def states(items: Column, step: Callable[[Column, Column], Column], zero: Column, kind: str = "bigint", chunk: int = 64) -> Column:
    """The state (of type ``kind``) that ``step(state, item)`` has made of ``zero`` before each item, from first
    to last. A loop copies what it gathers at every step: so one loop gathers a state a chunk, and one a
    chunk's states."""
    start = lambda at: F.struct(at.cast(kind).alias("at"), F.expr(f"cast(array() as array<{kind}>)").alias("out"))
    add = lambda s, at: F.struct(at.cast(kind).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))

    def of(chunks: Column) -> Column:
        begins = F.aggregate(chunks, start(zero), lambda s, c: add(s, F.aggregate(c, s["at"], lambda at, x: step(at, x).cast(kind))), lambda s: s["out"])
        return bound(begins, lambda b: F.flatten(F.transform(chunks, lambda c, i: F.aggregate(c, start(F.get(b, i)), lambda s, x: add(s, step(s["at"], x)), lambda s: s["out"]))))

    cut_up = lambda given: F.transform(F.sequence(F.lit(0), F.floor(F.size(given) / chunk).cast("int")), lambda i: F.slice(given, i * chunk + 1, F.lit(chunk)))
    return bound(bound(items, cut_up), of)
