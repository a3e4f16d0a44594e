"""Folds over the elements of an array column, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = Callable[[Column, Column], tuple[Column, Callable[[Column], Column], Callable[[Column], Column]]]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def fold_text(items: Column, start: Column, step: Step) -> Column:
    """The texts that the elements of ``items`` give, one after the other.

    ``step(state, item)`` is a value, a function from it to the next state (a
    struct shaped like ``start``), and one from it to the text. The array is
    folded in about as many runs as a run has elements: adding every text to
    that of the whole array would copy it once per element. (Texts, because
    appending to an array costs far more than to a string.)
    """
    def one(acc: Column, item: Column) -> Column:
        value, after, text = step(acc["state"], item)
        return let(value, lambda v: F.struct(after(v).alias("state"), F.concat(acc["out"], text(v)).alias("out")))

    def run(acc: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(acc["state"].alias("state"), F.lit("").alias("out")), one)
        return let(inner, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

    def whole(length: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), length), lambda i: F.slice(items, i, length))
        return F.aggregate(parts, F.struct(start.alias("state"), F.lit("").alias("out")), run)["out"]

    return let(F.greatest(F.lit(8), F.ceil(F.sqrt(F.size(items).cast("double"))).cast("int")), whole)
