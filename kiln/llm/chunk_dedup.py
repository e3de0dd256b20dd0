"""Exact dedup by recipes of content-defined chunks (native: DataFrame functions only).

A text, with A-Z in lower case, is cut into chunks at places that its content
names: a chunk is at least ``LEAST`` characters long and ends after the next
line feed or word that ends in one of a few letters, at ``MOST`` characters
otherwise.  So texts that share a passage share its chunks, wherever it
stands.  A chunk's identifier is its 64-bit hash and a number: the distinct
chunks under one hash are compared by content, and where there are several
each has a number of its own, so two chunks have the same identifier exactly if
they are equal.  A document's recipe is the ordered list of its identifiers,
and documents are equal exactly if their recipes are.

Each distinct chunk is moved once, to be verified; documents are compared by
their recipes, some bytes for every few hundred characters, and their texts
are never shuffled, sorted or gathered.

Edge cases: a null text counts as empty, and all empty texts are equal (an
empty recipe).  A null doc_id is smaller than any other.  Of rows that share
the largest doc_id of a group and its text, one stays.  A text of any length
is only cut, never held against another whole.  An empty table gives an empty
result; other columns, whatever their names, are ignored by ``classes`` and
kept by ``apply``.

Scale: chunks and recipes are grouped with map-side partial aggregates, so a
group with a third of all rows sends one row for each map task.  Rows meet
the groups of two and more, a written table: broadcast while that is small,
else by an equi-join whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import write_table

__all__ = ["LEAST", "MOST", "normalised", "chunks", "clashes", "recipes", "classes", "apply"]

#: Characters of a chunk.
LEAST, MOST = 256, 2048
#: A chunk ends after a line feed or after one of these letters at the end of a word.
LAST_LETTERS = "gkvwxyz"


def normalised(text: Column) -> Column:
    """``text`` with A-Z, and no other letter, in lower case; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    # lower() changes other letters, too: it only sees runs of A-Z where a text holds more than ASCII
    runs = F.regexp_extract_all(text, F.lit("[A-Z]+|[^A-Z]+"), 0)
    by_run = F.array_join(F.transform(runs, lambda r: F.when(F.ascii(r).between(65, 90), F.lower(r)).otherwise(r)), "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), by_run).otherwise(F.lower(text))


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The content-defined chunks of ``text`` in order; together they are the text."""
    end = rf"(?:[{LAST_LETTERS}](?=[^a-z])|\n)"
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most}}}?{end}|.{{1,{most}}}"), 0)


def _hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def clashes(docs: DataFrame, hashed=_hash) -> DataFrame:
    """(h, chunk, v): chunks of ``docs`` (text) whose hash other chunks have as well, numbered from 0 in order of content.

    Every distinct chunk is compared with those of its hash; as a rule none is left.
    """
    every = docs.select(F.explode(chunks(normalised(F.col("text")))).alias("chunk"))
    every = every.select(hashed(F.col("chunk")).alias("h"), "chunk")
    several = write_table(every.groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("n")).groupBy("h")
                          .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "chunk-clashes")
    texts = every.join(several, "h", "left_semi").groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("n"))
    at = Window.partitionBy("h").orderBy("chunk")  # a few distinct chunks for each 64-bit hash
    return texts.select("h", "chunk", (F.row_number().over(at) - 1).alias("v"))


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hashed=_hash) -> DataFrame:
    """(row, doc_id, text_sha256, recipe) of every row; ``recipe`` is an array of (h, v).

    Written to the shared folder, so that the row numbers are the same for every reader.
    """
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    clashing = write_table(clashes(src, hashed), "chunk-numbers")
    df = src.select(F.monotonically_increasing_id().alias("row"), "doc_id", normalised(F.col("text")).alias("text"))
    df = df.select("row", "doc_id", F.sha2("text", 256).alias("sha"), F.posexplode_outer(chunks(F.col("text"))).alias("pos", "chunk"))
    first = F.coalesce(F.col("pos") == 0, F.lit(True))  # the document's own values travel with its first chunk only
    df = df.select("row", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("sha")).alias("sha"), "pos",
                   F.when(F.col("pos").isNotNull(), hashed(F.col("chunk"))).alias("h"), "chunk")
    df = df.join(clashing, ["h", "chunk"], "left").select("row", "doc_id", "sha", "pos", "h", F.coalesce("v", F.lit(0)).alias("v"))
    part = F.when(F.col("pos").isNotNull(), F.struct("pos", "h", "v"))
    df = df.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("sha").alias("text_sha256"), F.collect_list(part).alias("parts"))
    recipe = F.transform(F.array_sort("parts"), lambda p: F.struct(p["h"].alias("h"), p["v"].alias("v")))
    return write_table(df.select("row", "doc_id", "text_sha256", recipe.alias("recipe")), "recipes")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hashed=_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, and ``n_chunks``."""
    rows = recipes(docs, doc_id, text, hashed)
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.max_by("row", order).alias("keep_row"),
                                        F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = write_table(groups.select(F.col("recipe").alias("same"), "keep_id", "keep_row", "n"), "equal-recipes")
    met = rows.join(groups, F.col("recipe") == F.col("same"), "left")
    alone = F.col("n").isNull()
    return met.select("row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                      (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256",
                      F.size("recipe").cast("long").alias("n_chunks"))


def apply(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the one with the largest doc_id.

    ``docs`` is written first, so that its rows keep their numbers.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]  # whatever the columns are called, these do not clash
    table = write_table(docs.toDF(*names), "chunk-documents")
    at = dict(zip(docs.columns, names))
    gone = classes(table, at[doc_id], at[text]).where(~F.col("kept")).select("row")
    left = table.withColumn("row", F.monotonically_increasing_id()).join(write_table(gone, "chunk-gone"), "row", "left_anti")
    return left.select(*names).toDF(*docs.columns)
