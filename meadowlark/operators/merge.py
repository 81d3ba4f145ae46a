"""Merges of an existing table with incoming rows. Both sides are keyed and unique by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All keys of both; incoming rows win whole, null fields too."""
    values = [c for c in old.columns if c not in keys]
    packed = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    both = packed(old, "_old").join(packed(new, "_new"), keys, "full_outer")
    return both.select(*keys, F.coalesce("_new", "_old").alias("r")).select(*keys, "r.*")


def fill(old: DataFrame, new: DataFrame, keys: list[str], filled: list[str] = ()) -> DataFrame:
    """All keys of both; existing rows stay as they are but for null ``filled`` fields, which the incoming
    row may fill. ``changed`` says whether a row is new or had a field filled: a rerun changes nothing."""
    values = [c for c in old.columns if c not in keys]
    packed = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    both = packed(old, "_old").join(packed(new, "_new"), keys, "full_outer")
    there = F.col("_old").isNotNull()
    field = lambda c: F.coalesce(f"_old.{c}", f"_new.{c}") if c in filled else F.when(there, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}"))
    changed = ~there
    for c in filled:
        changed = changed | (F.col(f"_old.{c}").isNull() & F.col(f"_new.{c}").isNotNull())
    return both.select(*keys, *[field(c).alias(c) for c in values], F.coalesce(changed, F.lit(True)).alias("changed"))


def add_missing_dates(old: DataFrame, new: DataFrame, date: str = "dt") -> DataFrame:
    """The old rows, and the incoming ones of dates that the old don't have at all."""
    return old.unionByName(new.join(old.select(date).distinct(), date, "left_anti").select(*old.columns))


def replace_dates(old: DataFrame, new: DataFrame, date: str = "dt") -> DataFrame:
    """The incoming rows, and the old ones of other dates."""
    return add_missing_dates(new, old.select(*new.columns), date)


def overlay(left: str, right: str) -> Column:
    """Two maps as one; the right one's values win."""
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k)), F.col(right))
