"""Ratings, ranks, correlations, sorting and sampling (E10-E13, family F)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.hashing import seeded_index, seeded_key
from kiln.operators.folds import elo_fold
from kiln.operators.quality import valid_comparisons


def _keys(g) -> list:
    return [] if g is None else ([g] if isinstance(g, str) else list(g))


def elo(comparisons: DataFrame, group="model", seq="seq", normalize: bool = False,
        filter_valid: bool = True, **cols) -> DataFrame:
    """E10 (+C9, E11, F6): final ratings per group with their rank position."""
    src = valid_comparisons(comparisons) if filter_valid else comparisons
    return rank_ratings(elo_fold(src, group=group, seq=seq, normalize=normalize, **cols), group)


def rank_ratings(ratings: DataFrame, group="model", rating="rating", trait="trait", out="position") -> DataFrame:
    """0-based position by rating descending; ties broken by trait name."""
    w = Window.partitionBy(*_keys(group)).orderBy(F.col(rating).desc(), F.col(trait))
    return ratings.withColumn(out, F.row_number().over(w) - 1)


def spearman(ranked: DataFrame, pairs: list[tuple], group="model", position="position",
             trait="trait") -> DataFrame:
    """E12 (+D7): Spearman rho between two groups' rankings over their common traits.

    ``pairs`` holds ``(model_1, model_2[, phase])``; all pairs are scored in
    one pass.  Positions are re-ranked within the common traits (``rank``)
    and correlated with ``corr``; the p-value (t distribution, n-2 dof) comes
    from a tiny pandas UDF on the one-row-per-pair result.
    """
    spark = ranked.sparkSession
    rows = [tuple(p) + (None,) * (3 - len(p)) for p in pairs]
    pdf = spark.createDataFrame(rows, "model_1 string, model_2 string, phase string")
    a = ranked.select(F.col(group).alias("model_1"), trait, F.col(position).alias("p1"))
    b = ranked.select(F.col(group).alias("model_2"), trait, F.col(position).alias("p2"))
    j = F.broadcast(pdf).join(a, "model_1").join(b, ["model_2", trait])
    w1 = Window.partitionBy("model_1", "model_2").orderBy("p1")
    w2 = Window.partitionBy("model_1", "model_2").orderBy("p2")
    j = j.withColumn("r1", F.rank().over(w1)).withColumn("r2", F.rank().over(w2))
    res = j.groupBy("phase", "model_1", "model_2").agg(F.corr("r1", "r2").alias("rho"), F.count(F.lit(1)).alias("n"))
    return res.withColumn("p_value", spearman_pvalue(F.col("rho"), F.col("n")))


def _betacf(a: float, b: float, x: float) -> float:
    # Continued fraction for the regularised incomplete beta (modified Lentz).
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        m2 = 2 * m
        num = m * (b - m) * x / ((a - 1 + m2) * (a + m2))
        d = 1.0 + num * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + num / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        num = -(a + m) * (a + b + m) * x / ((a + m2) * (a + 1 + m2))
        d = 1.0 + num * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + num / c
        c = c if abs(c) > tiny else tiny
        step = d * c
        h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return h


def reg_inc_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbeta) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbeta) * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(rho: float, n: int) -> float:
    """Two-sided p-value of a correlation under H0 (t with n-2 dof)."""
    if rho is None or n is None or n < 3 or math.isnan(rho):
        return float("nan")
    dof = n - 2
    if abs(rho) >= 1.0:
        return 0.0
    t2 = rho * rho * dof / (1.0 - rho * rho)
    return reg_inc_beta(dof / 2.0, 0.5, dof / (dof + t2))


def spearman_pvalue(rho: Column, n: Column) -> Column:
    @F.pandas_udf("double")
    def _p(r: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([t_two_sided_p(None if pd.isna(x) else float(x), int(y)) for x, y in zip(r, k)])

    return _p(rho, n)


def mean_correlation(corrs: DataFrame, group="phase", value="rho") -> DataFrame:
    """Mean of pair correlations per phase."""
    return corrs.groupBy(*_keys(group)).agg(F.avg(value).alias("mean_rho"), F.count(value).alias("n_pairs"))


def bottom_top(deltas: DataFrame, group, value="diff", tie="trait", n: int = 5) -> DataFrame:
    """the ``n`` lowest then the ``n`` highest by ``value`` (ascending), per group.

    One shuffle: both row numbers come from windows over the same
    partitioning; a row in both lists (fewer than 2n rows) is emitted twice,
    like the reference's list slices.  ``position`` runs 0..2n-1 in display order.
    """
    g = _keys(group)
    part = Window.partitionBy(*g)
    asc = part.orderBy(F.col(value).asc(), F.col(tie).asc())
    desc = part.orderBy(F.col(value).desc(), F.col(tie).desc())
    r = (deltas.withColumn("_a", F.row_number().over(asc)).withColumn("_d", F.row_number().over(desc))
         .withColumn("_k", F.least(F.count(F.lit(1)).over(part), F.lit(n))))
    r = r.filter((F.col("_a") <= n) | (F.col("_d") <= n))
    none = F.array().cast("array<struct<side:string,position:bigint>>")
    b = F.when(F.col("_a") <= n, F.array(F.struct(F.lit("bottom").alias("side"),
                                                  (F.col("_a") - 1).cast("bigint").alias("position")))).otherwise(none)
    t = F.when(F.col("_d") <= n, F.array(F.struct(F.lit("top").alias("side"),
                                                  (F.lit(n) + F.col("_k") - F.col("_d")).cast("bigint").alias("position")))
               ).otherwise(none)
    out = r.withColumn("_s", F.explode(F.concat(b, t)))
    return out.withColumn("side", F.col("_s.side")).withColumn("position", F.col("_s.position")) \
        .drop("_s", "_a", "_d", "_k")


def seeded_shuffle(df: DataFrame, seed, key, out="shuffle_key") -> DataFrame:
    """seeded permutation order (``orderBy(shuffle_key)``); deterministic in any engine."""
    return df.withColumn(out, seeded_key(seed, *_keys(key)))


def shuffle_take(df: DataFrame, seed, key, n: int | None = None) -> DataFrame:
    """seeded shuffle then the first ``n`` rows (``None`` = all)."""
    out = seeded_shuffle(df, seed, key)
    return out if n is None else out.orderBy("shuffle_key").limit(n)


def distinct_pair(options: list[str], seed, *key, out=("trait_1", "trait_2")) -> list[Column]:
    """a random ordered pair of two different options per row.

    ``i = h1 mod n`` and ``j = (i + 1 + h2 mod (n-1)) mod n`` are never equal.
    """
    n = len(options)
    arr = F.array(*[F.lit(o) for o in options])
    i = seeded_index(f"{seed}:1", n, *key)
    j = F.pmod(i + 1 + seeded_index(f"{seed}:2", n - 1, *key), F.lit(n))
    return [F.element_at(arr, (i + 1).cast("int")).alias(out[0]),
            F.element_at(arr, (j + 1).cast("int")).alias(out[1])]


def spread_row_number(df: DataFrame, group, order, out: str = "row_number", rows_per_bucket: int | None = None) -> DataFrame:
    """``row_number()`` within ``group`` by ``order`` without sorting a hot group in one task.

    One path for all sizes.  Rows are range-partitioned by group and order,
    sorted and written to the shared folder with their partition and place in
    it, so a group of any size spreads over as many partitions as it fills.
    Each (group, partition) is then counted; a group's counts, summed up over
    its earlier partitions, are where its rows of a partition begin.  No row is
    moved after it was written: the starts, one for each (group, partition),
    come to the rows by an equi-join.  ``rows_per_bucket`` sets the partitions'
    size; by default the session's shuffle partitions decide.

    ``order`` must tell a group's rows apart.  Nulls, in ``group`` or in
    ``order``, are values like any other (groups meet with ``<=>``) and no row
    is lost.
    """
    from kiln.session import written

    g, o = _keys(group), _keys(order)
    by = [F.col(c) for c in g + o]
    ranged = (df.repartitionByRange(*by) if rows_per_bucket is None
              else df.repartitionByRange(max(1, -(-df.count() // rows_per_bucket)), *by))
    rows = ranged.sortWithinPartitions(*by).withColumn("_rn_part", F.spark_partition_id()).withColumn(
        "_rn_at", F.monotonically_increasing_id())
    rows = written(rows, "ranged")
    counts = rows.groupBy(*g, "_rn_part").agg(F.count(F.lit(1)).alias("_rn_n"), F.min("_rn_at").alias("_rn_first"))
    # without a group there is one row for each partition here
    before = (Window.partitionBy(*g) if g else Window).orderBy("_rn_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_rn_before", F.coalesce(F.sum("_rn_n").over(before), F.lit(0)))
    starts = written(starts.select(*[F.col(c).alias(f"_rn_g{i}") for i, c in enumerate(g)], F.col("_rn_part").alias("_rn_p"),
                                   (F.col("_rn_before") - F.col("_rn_first")).alias("_rn_shift")), "starts")
    on = F.col("_rn_part") == F.col("_rn_p")
    for i, c in enumerate(g):
        on = on & F.col(c).eqNullSafe(F.col(f"_rn_g{i}"))
    met = rows.join(starts, on).withColumn(out, F.col("_rn_at") + F.col("_rn_shift") + 1)
    return met.drop("_rn_part", "_rn_at", "_rn_p", "_rn_shift", *[f"_rn_g{i}" for i in range(len(g))])


def first_n_per_group(df: DataFrame, group, order, n: int = 500, out="pos") -> DataFrame:
    """the first ``n`` rows of each group by position (a limit that is the feature).

    The filter is on ``row_number() <= n`` itself, so Spark plans a
    per-partition top-k (``WindowGroupLimit``) before the window's shuffle: a
    hot group sends at most ``n`` rows per map task.
    """
    w = Window.partitionBy(*_keys(group)).orderBy(*_keys(order))
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
            .withColumn(out, F.col("_rn") - 1).drop("_rn"))


def first_n(df: DataFrame, order, n: int = 500) -> DataFrame:
    """The first ``n`` rows by position (top-k, no full sort)."""
    return df.orderBy(*_keys(order)).limit(n)
