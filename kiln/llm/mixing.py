"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight; shares of the corpus' words follow the weights, but
a source gives at most ``MAX_EPOCHS`` times its words and the excess goes to
the others by weight.  That level is found exactly: with sources sorted by
cap over weight, the level is the largest value of (words left) / (weight
left), and a source's target is the smaller of its cap and level * weight.

Within a source, documents follow a fixed order (md5 of seed and doc_id).  A
target of f whole passes and a rest takes every document f times and, in that
order, those whose middle lies within the rest once more.  Training time runs
from 0 to 1; a source's weight varies along its piecewise-linear schedule.
The schedule's integral is the source's cumulative token demand, and inverting
it at the words taken before a copy gives that copy's training position.
Documents are then range-sorted by position.

Edge cases: a null source is a source of its own, last in order; a null text
has size 0; documents of size 0 are taken with their pass and add nothing;
rows that share a doc_id are ordered together and each is taken on its own;
an empty table gives an empty result; other columns are kept by ``apply``.

Scale: a source may hold a third of all rows, so words are summed per source
and hash bucket with partial sums, bucket starts come from the small table of
sums, and only rows of one bucket meet in a window.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.hashing import seeded_key
from kiln.llm.common import words, write_table

__all__ = ["WEIGHTS", "MAX_EPOCHS", "SCHEDULES", "source_targets", "plan", "apply", "invert_demand"]

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hex digits of the order key that name a bucket: 16**3 buckets a source.
BUCKET_DIGITS = 3
SEED = "mix"
#: Relative weight of a source over training time, as (time, weight) knots; sources take them in turn.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)


def _segments(knots) -> list[tuple[float, float, float, float, float]]:
    """(start, end, weight at both, demand before) with the whole demand scaled to 1."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((t0, t1, w0 / area, w1 / area, before))
        before += (t1 - t0) * (w0 + w1) / 2 / area
    return out


def invert_demand(u: Column, knots) -> Column:
    """The time at which a source with this schedule has met the share ``u`` of its demand."""
    def at(t0, t1, a, b, before):
        rest, slope = u - before, (b - a) / (t1 - t0)
        return t0 + 2 * rest / (a + F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * slope * rest)))

    parts = _segments(knots)
    pick = at(*parts[-1])
    for k in range(len(parts) - 2, -1, -1):
        pick = F.when(u <= parts[k + 1][4], at(*parts[k])).otherwise(pick)
    return F.least(F.lit(1.0), pick)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, rank, target from per-source words (one row a source)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    df = sizes.withColumn("rank", F.row_number().over(order) - 1)
    pick = F.pmod("rank", F.lit(len(weights)))
    df = df.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), pick + 1))
    df = df.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    df = df.withColumn("all_weights", F.sum("weight").over(everything))
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    df = df.withColumn("level", left / weight_left)
    df = df.withColumn("level", F.max("level").over(everything))
    return df.select("source", "source_size", "rank", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _size(text: str) -> Column:
    return F.size(words(F.col(text))).cast("long").alias("__m_size")


def _taken(docs: DataFrame, source: str, schedules) -> DataFrame:
    """``docs``, which have ``__m_size``, with more ``__m`` columns: source size, target, copies, position of each copy."""
    df = docs.withColumn("__m_key", seeded_key(SEED, F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    df = df.withColumn("__m_bucket", F.substring("__m_key", 1, BUCKET_DIGITS))
    sums = df.groupBy(F.col(source).alias("source"), F.col("__m_bucket").alias("bucket")).agg(
        F.sum("__m_size").alias("words"))
    sums = write_table(sums, "mix-sums")
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    t = targets.withColumnRenamed("source", "__m_s")
    starts = starts.join(t, F.col("source").eqNullSafe(F.col("__m_s"))).select(
        F.col("source").alias("__m_source"), F.col("bucket").alias("__m_b"), F.col("start").alias("__m_start"),
        F.col("source_size").alias("__m_source_size"), F.col("target").alias("__m_target"),
        F.col("rank").alias("__m_rank"))
    df = df.join(starts, df[source].eqNullSafe(F.col("__m_source")) & (F.col("__m_bucket") == F.col("__m_b")))
    inside = (Window.partitionBy("__m_source", "__m_bucket").orderBy("__m_key", "doc_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("__m_before", F.col("__m_start") + F.coalesce(F.sum("__m_size").over(inside), F.lit(0)))
    full = F.when(F.col("__m_source_size") > 0, F.floor(F.col("__m_target") / F.col("__m_source_size"))).otherwise(0)
    df = df.withColumn("__m_full", full.cast("long"))
    rest = F.col("__m_target") - F.col("__m_full") * F.col("__m_source_size")
    middle = F.col("__m_before") + F.col("__m_size") / 2
    df = df.withColumn("__m_copies", (F.col("__m_full") + F.when(middle < rest, 1).otherwise(0)).cast("int"))

    def position(copy: Column) -> Column:
        u = F.least(F.lit(1.0), F.coalesce(
            (copy * F.col("__m_source_size") + middle) / F.nullif(F.col("__m_target"), F.lit(0.0)), F.lit(0.0)))
        turn = F.pmod("__m_rank", F.lit(len(schedules)))
        return functools.reduce(lambda acc, k: acc.when(turn == k, invert_demand(u, schedules[k])),
                                range(1, len(schedules)), F.when(turn == 0, invert_demand(u, schedules[0])))

    return df.withColumn("__m_positions", F.when(F.col("__m_copies") > 0, F.transform(
        F.sequence(F.lit(0), F.col("__m_copies") - 1), position)).otherwise(F.array().cast("array<double>")))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         schedules=SCHEDULES) -> DataFrame:
    """One row per document, range-sorted by first training position (documents left out come last)."""
    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), _size(text))
    df = _taken(write_table(df, "sizes"), "source", schedules)
    df = df.select("doc_id", F.col("__m_size").alias("size"), F.col("__m_source_size").alias("source_size"),
                   F.col("__m_target").alias("target"), (F.col("__m_size") * F.col("__m_copies")).alias("taken"),
                   F.col("__m_copies").alias("copies"), F.col("__m_positions").alias("positions"))
    return df.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def apply(docs: DataFrame, source: str = "source", schedules=SCHEDULES) -> DataFrame:
    """The training set: ``docs``, a row for each copy taken, range-sorted by training position."""
    df = _taken(docs.withColumn("__m_size", _size("text")), source, schedules).withColumn("__m_position", F.explode("__m_positions"))
    df = df.orderBy("__m_position", "doc_id")
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])
