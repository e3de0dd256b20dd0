"""Joins (inventory family D)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def align_responses(teacher: DataFrame, student: DataFrame, key, how: str = "inner") -> DataFrame:
    """Teacher and student responses aligned by the row key (equi-join)."""
    keys = [key] if isinstance(key, str) else list(key)
    return teacher.join(student, keys, how)


def merge_methods(m1: DataFrame, m2: DataFrame, on="question", name_1: str = "one", name_2: str = "two",
                  value="response") -> DataFrame:
    """Inner equi-join of two methods' outputs; duplicate keys multiply (like ``pd.merge``)."""
    keys = [on] if isinstance(on, str) else list(on)
    a = m1.select(*keys, F.col(value).alias(f"{value}_{name_1}"))
    b = m2.select(*keys, F.col(value).alias(f"{value}_{name_2}"))
    return a.join(b, keys, "inner")


def attach_dimension(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Attach a dimension (e.g. constitution text) to every row.

    No hint: adaptive execution broadcasts the side if it turns out small and
    splits skewed keys of a shuffle join if not.
    """
    return df.join(dim, [on] if isinstance(on, str) else list(on), how)


def rating_delta(before: DataFrame, after: DataFrame, key="trait", value="rating",
                 group: list[str] | None = None, strict: bool = True) -> DataFrame:
    """``(key, abs_diff, diff, old, new)`` per key; with ``strict`` a key missing
    on the right raises (like the reference's list lookup)."""
    g = list(group or [])
    b = before.select(*g, key, F.col(value).alias("old"))
    a = after.select(*g, key, F.col(value).alias("new"))
    j = b.join(a, g + [key], "left")
    new = F.col("new")
    if strict:
        new = F.when(F.col("new").isNotNull(), F.col("new")).otherwise(
            F.raise_error(F.concat(F.lit("rating_delta: missing on the right: "), F.col(key))).cast("double"))
    j = j.withColumn("new", new)
    return j.select(*g, key, F.abs(F.col("new") - F.col("old")).alias("abs_diff"),
                    (F.col("new") - F.col("old")).alias("diff"), "old", "new")


def pending(requested: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Requested keys that have no output yet (``left_anti``)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    return requested.join(done.select(*ks), ks, "left_anti")


def present(requested: DataFrame, have: DataFrame, keys) -> DataFrame:
    """Requested keys whose inputs exist (``left_semi``)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    return requested.join(have.select(*ks), ks, "left_semi")
