"""Quality rules as a short-circuit cascade (native: DataFrame functions only).

Every rule is a predicate that rejects a document.  A bounded sample gives
each rule's cost (seconds a row) and selectivity (share of rows rejected);
rules then run in order of rejection per cost, and a row that one rule
rejects is not shown to the later ones.  The order changes the time taken,
never the verdict, which is that no rule rejects the document.

Edge cases: a null, empty or blank text has no words and is rejected by
``few_words``; null ids are kept as they are; an empty table gives an empty
result; repeated rows are judged one by one; other columns, whatever their
names, are neither read nor returned by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import write_table, words

__all__ = ["SAMPLE_ROWS", "RULES", "base_columns", "cascade_order", "cascade", "score", "keep"]

#: Expected rows of the sample from which costs and selectivities are estimated, whatever the table's size.
SAMPLE_ROWS = 2000
SYMBOLS = "[#*$%&|<>]"


def _repeat_words(hashes: Column) -> tuple[Column, Callable[[Column], Column]]:
    """Pairs (window hash, place), sorted, of a text with repeated windows; and the words they cover."""
    pairs = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                   F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))

    def covered(p: Column) -> Column:
        again = F.filter(p, lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"]))
                         | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)))
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        total = F.aggregate(places, zero, lambda acc, i: F.struct(
            (acc["n"] + i + 5 - F.greatest(acc["end"], i.cast("long"))).alias("n"),
            (i + 5).cast("long").alias("end")), lambda acc: acc["n"])
        return F.coalesce(total, F.lit(0).cast("long"))

    return pairs, covered


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__q`` columns: counts of words, characters, symbols, lines and repeats."""
    df = docs.withColumn("__q_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("__q_words", words(F.col("__q_text")))
    df = df.withColumn("__q_lines", F.filter(F.split("__q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("__q_words")
    df = df.withColumn("__q_hash", F.when(n >= 5, F.transform(
        F.sequence(F.lit(1), n - 4), lambda i: F.xxhash64(F.slice("__q_words", i, 5))))
        .otherwise(F.array().cast("array<bigint>")))
    pairs, covered = _repeat_words(F.col("__q_hash"))
    return df.withColumn("__q_pairs", pairs).select(
        *[F.col(f"`{c}`") for c in docs.columns], "__q_text", "__q_words",
        n.cast("long").alias("__q_n_words"),
        F.length(F.array_join("__q_words", "")).cast("long").alias("__q_word_chars"),
        (F.length("__q_text") - F.length(F.regexp_replace("__q_text", SYMBOLS, ""))).cast("long").alias("__q_n_symbols"),
        F.size("__q_lines").cast("long").alias("__q_n_lines"),
        (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long").alias("__q_n_dup_lines"),
        covered(F.col("__q_pairs")).alias("__q_n_repeat_words"))


def _share(part: Column, whole: Column, percent: int) -> Column:
    return 100 * part > percent * whole


def _stutters() -> Column:
    w = F.col("__q_words")
    return F.size(F.filter(w, lambda x, i: (i > 0) & (F.get(w, i - 1) == x)))


def _count(pattern: str) -> Column:
    return F.length("__q_text") - F.length(F.regexp_replace("__q_text", pattern, ""))


#: name -> predicate over the ``__q`` columns that rejects a document.
RULES: dict[str, Callable[[], Column]] = {
    "few_words": lambda: F.col("__q_n_words") < 10,
    "repeated_words": lambda: _share(F.col("__q_n_repeat_words"), F.col("__q_n_words"), 20),
    "symbols": lambda: _share(F.col("__q_n_symbols"), F.col("__q_word_chars"), 5),
    "repeated_lines": lambda: _share(F.col("__q_n_dup_lines"), F.col("__q_n_lines"), 50),
    "capitals": lambda: _share(_count("[A-Z]"), _count("[A-Za-z]"), 60),
    "exclamations": lambda: _share(_count("!"), F.col("__q_n_words"), 50),
    "stutter": lambda: _share(_stutters(), F.col("__q_n_words"), 30),
}
BASE_RULES = ("few_words", "repeated_words")


def cascade_order(docs: DataFrame, rules: dict[str, Callable[[], Column]], text: str = "text",
                  sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds a row, share rejected) by falling rejection per cost, from a bounded sample."""
    fraction = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(F.col(text).alias("__q_in")).sample(fraction, seed=17)
    table = write_table(base_columns(sample, "__q_in"), "rule-sample")
    rows = table.count()
    if not rows:
        return [(name, 0.0, 0.0) for name in rules]
    table.agg(F.count("__q_words"), F.count("__q_text")).first()
    found = []
    for name, rule in rules.items():
        began = time.perf_counter()
        share = table.agg(F.avg(rule().cast("double"))).first()[0]
        found.append((name, (time.perf_counter() - began) / rows, share or 0.0))
    return sorted(found, key=lambda x: (-x[2] / max(x[1], 1e-9), x[0]))


def cascade(rules: dict[str, Callable[[], Column]], order: list[str]) -> Column:
    """True if a rule rejects the row; CASE evaluates the next rule only for rows left by the last."""
    out = None
    for name in order:
        hit = F.coalesce(rules[name](), F.lit(False))
        out = F.when(hit, True) if out is None else out.when(hit, True)
    return F.lit(False) if out is None else out.otherwise(False)


def _judged(docs: DataFrame, text: str) -> DataFrame:
    extra = {k: v for k, v in RULES.items() if k not in BASE_RULES}
    order = [name for name, _, _ in cascade_order(docs, extra, text)]
    df = base_columns(docs, text)
    df = df.withColumn("__q_base", RULES["few_words"]() | RULES["repeated_words"]())
    return df.withColumn("__q_kept", F.when(F.col("__q_base"), False).otherwise(~cascade(extra, order)))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the counts, ``base_failed`` and the cascade's verdict ``kept``."""
    df = _judged(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return df.select("doc_id", *[F.col(f"__q_{c}").alias(c) for c in names],
                     F.col("__q_base").alias("base_failed"), F.col("__q_kept").alias("kept"))


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with the columns they came with.

    The verdict passes through an explode: a filter on it would be pushed down to the scan with the counts
    written out in full each time they are used.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return _judged(docs, text).select(*columns, F.explode(F.array("__q_kept")).alias("__q_stays")).where(
        "__q_stays").select(*columns)
