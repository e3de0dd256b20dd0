"""Line dedup over overlapping three-line windows (native: DataFrame functions only).

Each three consecutive lines of a document are one window, keyed by two
64-bit hashes (128 bits).  Of windows with equal lines, the first in order of
(doc_id, text hash, line) stays; all later ones, in any document, are removed.  The lines
removed are those that any removed window covers: covered places are merged
into runs, and the lines between the runs are joined again.

Edge cases: a null text counts as empty; fewer than three lines make no
window; windows of three blank lines are ignored; rows of equal doc_id and
equal text count as one document, rows that share only the doc_id are documents
of their own, in order of their texts' hashes; a null doc_id comes first; an
empty table gives an empty result; other columns are ignored by
``remove_lines`` and kept by ``apply``.

Scale: windows are grouped by hash with map-side partial minima and met by an
equi-join, so a window that a third of all documents share costs one row for
each map task in the grouping and is split by the skew join in the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["WINDOW", "windows", "removed_windows", "remove_lines", "apply"]

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _text_key(text: Column) -> Column:
    """Tells the texts under one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, k1, k2) of each window of ``docs`` (doc_id, text)."""
    df = docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), _lines(F.col("text")).alias("lines"))
    at = F.when(F.size("lines") >= WINDOW, F.sequence(F.lit(0), F.size("lines") - WINDOW))
    df = df.select("doc_id", "text_key", "lines", F.explode(at).alias("pos"))
    three = [F.get("lines", F.col("pos") + i) for i in range(WINDOW)]
    text = F.concat_ws("\n", *three)
    return df.where(text.rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", "text_key", "pos", F.xxhash64(*three).alias("k1"), F.xxhash64(F.lit("second"), *three).alias("k2"))


def removed_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, places) with the sorted starts of the later occurrences in each document."""
    found = windows(docs)
    first = (found.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "text_key", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    later = found.join(first, ["k1", "k2"]).where(~F.struct("doc_id", "text_key", "pos").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("pos")).alias("places"))


def _runs(df: DataFrame) -> DataFrame:
    """Merge covered places into runs: first and last line of each."""
    p = F.col("places")
    starts = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) + WINDOW < x))
    ends = F.transform(F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) > x + WINDOW, F.lit(True))),
                       lambda x: x + WINDOW - 1)
    return df.withColumn("starts", starts).withColumn("ends", ends)


def _kept(lines: Column, starts: Column, ends: Column) -> Column:
    """The lines between the removed runs, joined again."""
    def after(k: Column) -> Column:
        return F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 1

    parts = F.transform(F.sequence(F.lit(0), F.size(starts)), lambda k: F.slice(
        lines, after(k) + 1, F.coalesce(F.get(starts, k), F.size(lines)) - after(k)))
    return F.array_join(F.flatten(parts), "\n")


def remove_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, n_spans (removed runs) and the ``text`` that stays."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    runs = _runs(removed_windows(src)).select(F.col("doc_id").alias("id"), "text_key", "starts", "ends")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (_text_key(F.col("text")) == F.col("text_key"))
    df = src.join(runs, same, "left").withColumn("lines", _lines(F.col("text")))
    lines, starts, ends = F.col("lines"), F.col("starts"), F.col("ends")
    removed = F.aggregate(F.zip_with(starts, ends, lambda s, e: (e - s + 1).cast("long")), F.lit(0).cast("long"),
                          lambda acc, x: acc + x)
    return df.select("doc_id", F.size(lines).cast("long").alias("n_lines"),
                     F.coalesce(removed, F.lit(0)).alias("n_removed"),
                     F.when(starts.isNull(), 0).otherwise(F.size(starts)).cast("long").alias("n_spans"),
                     F.when(starts.isNull(), F.coalesce("text", F.lit(""))).otherwise(_kept(lines, starts, ends))
                     .alias("text"))


def apply(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated windows taken out of ``text``; documents that lose all their words go.

    Documents that had no words before stay as they are.
    """
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    runs = _runs(removed_windows(src)).select(F.col("doc_id").alias("__ld_id"), F.col("text_key").alias("__ld_key"),
                                              F.col("starts").alias("__ld_starts"), F.col("ends").alias("__ld_ends"))
    starts, ends = F.col("__ld_starts"), F.col("__ld_ends")
    same = docs[doc_id].eqNullSafe(F.col("__ld_id")) & (_text_key(docs[text]) == F.col("__ld_key"))
    df = docs.join(runs, same, "left").withColumn("__ld_lines", _lines(docs[text]))
    kept = F.when(starts.isNull(), docs[text]).otherwise(_kept(F.col("__ld_lines"), starts, ends))
    # exploded, so that the filter below does not compute the text a second time
    df = df.select(*[docs[c] for c in docs.columns], starts, F.explode(F.array(kept)).alias("__ld_text"))
    df = df.where(starts.isNull() | F.col("__ld_text").rlike(r"[^\x20\x09-\x0D]"))
    return df.select(*[F.col("__ld_text").alias(c) if c == text else docs[c] for c in docs.columns])
