"""Aggregations and statistics (inventory family E, except the Elo fold)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.constants import HIST_BINS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _keys(g) -> list:
    return [] if g is None else ([g] if isinstance(g, str) else list(g))


# ---- E1 / E2 -----------------------------------------------------------------------
def swap_verdict(r, rr, method_one: str, method_two: str) -> Column:
    """Forward '1' + reverse '2' -> method_one; '2' + '1' -> method_two; else null."""
    a, b = _c(r), _c(rr)
    return (F.when((a == "1") & (b == "2"), F.lit(method_one))
             .when((a == "2") & (b == "1"), F.lit(method_two)))


def win_rate(df: DataFrame, group, verdict="verdict", method_two: str = "two", out="win_rate") -> DataFrame:
    """Share of consistent verdicts won by ``method_two``; 0.0 if it never wins,
    null when the group has no consistent verdict."""
    v = F.col(verdict)
    return df.groupBy(*_keys(group)).agg(
        F.avg(F.when(v.isNotNull(), (v == method_two).cast("double"))).alias(out),
        F.count(v).alias("n_consistent"))


# ---- E3 / E4 -----------------------------------------------------------------------
def mean_sem(df: DataFrame, group, value="value", mean="mean", sem="sem") -> DataFrame:
    """Mean and standard error (ddof=1, nulls skipped, null at n=1) per group."""
    x = F.col(value)
    return df.groupBy(*_keys(group)).agg(
        F.avg(x).alias(mean),
        (F.stddev_samp(x) / F.sqrt(F.count(x))).alias(sem),
        F.count(x).alias("n"))


def percent_label(mean, sem) -> Column:
    """``"62.5% ± 3.1%"`` — times 100, rounded half-even to 1 decimal."""
    def fmt(c):
        return F.coalesce(F.bround(_c(c) * 100, 1).cast("string"), F.lit("nan"))
    return F.concat(fmt(mean), F.lit("% ± "), fmt(sem), F.lit("%"))


# ---- E5 - E8 -----------------------------------------------------------------------
def label_counts(df: DataFrame, group, gold="gold", pred="pred") -> DataFrame:
    """Per (group, label): tp / fp / fn.  Every row contributes one gold and one
    predicted record; the aggregation combines map-side, so the shuffle carries
    at most (groups x labels) rows per task."""
    g = _keys(group)
    ok = F.col(gold) == F.col(pred)
    rec = F.explode(F.array(
        F.struct(F.col(gold).cast("string").alias("label"), ok.cast("int").alias("tp"),
                 (~ok).cast("int").alias("fn"), F.lit(0).alias("fp")),
        F.struct(F.col(pred).cast("string").alias("label"), F.lit(0).alias("tp"),
                 F.lit(0).alias("fn"), (~ok).cast("int").alias("fp"))))
    return (df.select(*g, rec.alias("r")).select(*g, "r.*")
            .groupBy(*g, "label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")))


def f1_accuracy(counts: DataFrame, group, f1="f1", acc="accuracy") -> DataFrame:
    """E5 + E6 from label counts: macro-F1 over labels present (0 when undefined) and accuracy."""
    g = _keys(group)
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return counts.groupBy(*g).agg(
        F.avg(F.when(den > 0, 2 * F.col("tp") / den).otherwise(F.lit(0.0))).alias(f1),
        (F.sum("tp") / (F.sum("tp") + F.sum("fn"))).alias(acc),
        (F.sum("tp") + F.sum("fn")).alias("n"))


def macro_f1(df: DataFrame, group, gold="gold", pred="pred") -> DataFrame:
    """E5 + E6 on prediction rows."""
    return f1_accuracy(label_counts(df, group, gold, pred), group)


def argmax(arr) -> Column:
    """0-based index of the first maximum (NaN counts as largest, like numpy)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def score_grid(df: DataFrame, method="method", variant="variant", gold="gold", pred="pred",
               pooled: str = "all", pooled_exclude=("default",)) -> DataFrame:
    """Scores per (method, variant) plus the pooled ``all`` row per method.

    ``all`` pools the *rows* of every variant except ``pooled_exclude`` (not a
    mean of scores).  The data is scanned once: label counts per
    (method, variant, label), then the pooled counts are sums of that small table.
    """
    counts = label_counts(df, [method, variant], gold, pred)
    pooled_counts = (counts.filter(~F.col(variant).isin(*pooled_exclude))
                     .groupBy(method, "label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
                                                   F.sum("fn").alias("fn"))
                     .withColumn(variant, F.lit(pooled)))
    return f1_accuracy(counts.unionByName(pooled_counts), [method, variant])


# ---- E14 - E19 ---------------------------------------------------------------------
def histogram(df: DataFrame, group, value="rating", bins: int = HIST_BINS) -> DataFrame:
    """``bins`` equal-width bins over each group's own range, last bin right-closed,
    density = count / (n * width); empty bins are kept (count 0).

    Ranges and counts are partial aggregates joined back by group, so no group
    is gathered; the (bounded) per-group bin counts are laid over
    ``sequence(0, bins-1)`` so empty bins appear.
    """
    g = _keys(group)
    span = df.groupBy(*g).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"), F.count(value).alias("_n"))
    mn, mx = F.col("_mn"), F.col("_mx")
    x = df.select(*g, F.col(value).alias("_v")).join(span, g).select(
        *g, "_v", "_n", F.when(mx > mn, mn).otherwise(mn - 0.5).alias("_lo"),
        F.when(mx > mn, mx).otherwise(mx + 0.5).alias("_hi"))
    x = x.withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)
    x = x.withColumn("bin", F.least(F.floor((F.col("_v") - F.col("_lo")) / F.col("_w")), F.lit(bins - 1)).cast("int"))
    per_bin = x.groupBy(*g, "bin").agg(F.count(F.lit(1)).alias("c"), F.first("_lo").alias("_lo"),
                                         F.first("_w").alias("_w"), F.first("_n").alias("_n"))
    per_group = per_bin.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("bin", "c"))).alias("_m"),
                                        F.first("_lo").alias("_lo"), F.first("_w").alias("_w"),
                                        F.first("_n").alias("_n"))
    out = per_group.select(*g, "_m", "_lo", "_w", "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    cnt = F.coalesce(F.try_element_at(F.col("_m"), F.col("bin")), F.lit(0))
    return out.select(*g, "bin",
                      (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"),
                      cnt.cast("bigint").alias("count"),
                      (cnt / (F.col("_n") * F.col("_w"))).alias("density"))


def axis_limits(df: DataFrame, value="rating", pad: float = 100.0) -> DataFrame:
    """Global min - pad and max + pad."""
    return df.agg((F.min(value) - pad).alias("x_min"), (F.max(value) + pad).alias("x_max"))


def distinct_traits(df: DataFrame, group=None, t1="trait_1", t2="trait_2") -> DataFrame:
    """Distinct traits from both sides."""
    g = _keys(group)
    return df.select(*g, F.explode(F.array(t1, t2)).alias("trait")).distinct()


def stage_counts(df: DataFrame, group=None, **conditions) -> DataFrame:
    """``count_if`` per named condition (``invalid=col.isNull()``) plus the row count."""
    g = _keys(group)
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.count_if(c).alias(n) for n, c in conditions.items()]
    return df.groupBy(*g).agg(*aggs)


def wide_by_rank(ranked: DataFrame, models: list[str], model="model", position="position",
                 trait="trait", score="rating") -> DataFrame:
    """One row per rank position, ``<model>_trait`` / ``<model>_score`` columns."""
    p = (ranked.groupBy(position).pivot(model, models)
         .agg(F.first(trait).alias("trait"), F.first(score).alias("score")))
    return p.select(position, *[F.col(f"`{m}_{x}`").alias(safe_name(f"{m}_{x}"))
                                for m in models for x in ("trait", "score")])


def safe_name(name: str) -> str:
    """Column-safe name for a pivoted value (``.`` and ``-`` become ``_``)."""
    return name.replace(".", "_").replace("-", "_").replace("/", "_")


def method_model_matrix(stats: DataFrame, methods: list[str], models: list[str], method="method",
                        model="model", mean="mean", sem="sem") -> DataFrame:
    """Full method x model grid; a missing cell counts as 0."""
    spark = stats.sparkSession
    grid = spark.createDataFrame([(a, b) for a in methods for b in models], f"{method} string, {model} string")
    return (grid.join(stats.select(method, model, mean, sem), [method, model], "left")
            .select(method, model, F.coalesce(mean, F.lit(0.0)).alias(mean),
                    F.coalesce(sem, F.lit(0.0)).alias(sem)))
