"""Ordered folds (I4): Elo (E10/E11) and greedy acceptance.

Both depend on the order of their rows by definition.  Elo streams each
group once, in order, holding one rating per trait; it is serial within a
group and only used where the reference needs the running ratings.  Greedy
acceptance is a few rounds of joins with an inverted index around a fold over
a small, fixed number of candidates per group.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.constants import ELO_K, ELO_SCALE, ELO_START, QUESTIONS_PER_TRAIT, SIMILAR_SHARE
from kiln.functions.text import py_split
from kiln.operators.quality import counted_words, index_overlaps, resembles
from kiln.session import written


def _keys(g) -> list[str]:
    return [g] if isinstance(g, str) else list(g)


def elo_fold(comparisons: DataFrame, group="model", seq="seq", t1="trait_1", t2="trait_2",
             winner="winner", normalize: bool = False, digits: int = 2,
             start: float = ELO_START, k: float = ELO_K, scale: float = ELO_SCALE) -> DataFrame:
    """E10 (+E11): final Elo rating per (group, trait).

    Start ``start``; the first trait's expected score is
    ``1/(1+10**((r2-r1)/scale))``; what it gains, ``k * (outcome - expected)``,
    the second loses.  Rows whose winner is neither trait change nothing but
    still register both.  With ``normalize`` ratings are min-max scaled per
    group when the range is positive.  Ratings are rounded (Python ``round``)
    to ``digits`` like the reference.

    Rows come sorted by Spark (spillable) and reach Python as outcomes and
    trait numbers of one Arrow batch, not as strings to compare.
    """
    gk = _keys(group)
    w = F.col(winner)
    outcome = F.when(w == F.col(t1), 1.0).when(w == F.col(t2), 0.0)
    src = comparisons.select(*[F.col(c).cast("string").alias(c) for c in gk], F.col(seq),
                             F.col(t1).cast("string").alias("_t1"), F.col(t2).cast("string").alias("_t2"),
                             outcome.alias("_outcome"))
    ordered = src.repartition(*gk).sortWithinPartitions(*gk, seq)
    out_schema = T.StructType([T.StructField(c, T.StringType()) for c in gk] + [
        T.StructField("trait", T.StringType()), T.StructField("rating", T.DoubleType()),
        T.StructField("n_matches", T.LongType())])

    def final(key, state):
        ratings, games = state
        low, high = min(ratings.values()), max(ratings.values())
        unit = (high - low) if normalize and high > low else None
        for trait, value in ratings.items():
            yield *key, trait, round(value if unit is None else (value - low) / unit, digits), games[trait]

    def run(batches):
        import numpy as np
        states: dict[tuple, tuple[dict, dict]] = {}
        for pdf in batches:
            codes, names = pd.factorize(np.concatenate([pdf["_t1"], pdf["_t2"]]))
            first, second = codes[:len(pdf)].tolist(), codes[len(pdf):].tolist()
            outcomes = pdf["_outcome"].to_numpy(float)
            for key, rows in pdf.groupby(gk, sort=False, dropna=False).indices.items():
                ratings, games = states.setdefault(key if isinstance(key, tuple) else (key,), ({}, {}))
                now = [ratings.get(n) for n in names]
                played = [0] * len(names)
                for r in np.sort(rows).tolist():
                    a, b = first[r], second[r]
                    if now[a] is None:
                        now[a] = start
                    if now[b] is None:
                        now[b] = start
                    if outcomes[r] == outcomes[r]:  # not NaN: one of the two won
                        gain = k * (outcomes[r] - 1 / (1 + 10 ** ((now[b] - now[a]) / scale)))
                        now[a], now[b] = now[a] + gain, now[b] - gain
                        played[a] += 1
                        played[b] += 1
                for name, value, n in zip(names, now, played):
                    if value is not None:
                        ratings[name] = float(value)
                        games[name] = games.get(name, 0) + n
        rows = [row for key, state in states.items() for row in final(key, state)]
        if rows:
            yield pd.DataFrame(rows, columns=[f.name for f in out_schema.fields])

    return ordered.mapInPandas(run, out_schema)


def greedy_accept(candidates: DataFrame, seeds: DataFrame | None, group="trait", order=("doc_id", "line_pos"),
                  text="text", cap: int = QUESTIONS_PER_TRAIT, batch: int = 500,
                  seed_group: str | None = None) -> DataFrame:
    """Accept candidates in order unless too similar (C12) to the group's seeds or to accepted ones.

    Candidates are numbered within their group once.  A round takes the next
    block of every group that is not full, drops what resembles a seed or an
    accepted text, and folds the first ``batch`` candidates left.  Similarity
    is an inverted index of the words known so far: a block's words are joined
    with it on (group, word) and counted for each known text; equal texts meet
    by an equi-join.  So a candidate is compared by the words it shares, and
    only until its group is full.  A block that leaves few candidates is
    followed by one ``growth`` times as long; one that leaves more than
    ``batch`` goes on behind the last that was folded, and as its first is
    always accepted, rounds end after ``cap`` plus the logarithm of the
    largest group.  The result is that of one ordered pass, whatever ``batch``
    is.  ``seed_group`` compares every group with that one group's seeds, as
    the reference does with its last trait's.  ``order`` must tell a group's
    rows apart.  Returns ``(group, *order, text, accept_pos)``.
    """
    from kiln.operators.ranking import first_n_per_group, spread_row_number

    g, o, growth = group, list(order), 4
    rows = candidates.select(F.col(g).cast("string").alias(g), *o, F.col(text).alias("text")).where(F.col("text").isNotNull())
    rows = spread_row_number(written(rows, "mined"), g, o, "_id")
    # at: the next candidate to look at; take: how many; have: accepted so far
    state = written(rows.groupBy(g).agg(F.max("_id").alias("last")).select(
        g, "last", F.lit(1).cast("bigint").alias("at"), F.lit(min(batch, 2 * cap)).cast("bigint").alias("take"), F.lit(0).alias("have")), "open-groups")

    def known_of(texts: DataFrame, tag: str) -> DataFrame:
        """(group, text, words) of the texts that candidates are compared with; ``_old`` tells them apart."""
        distinct = texts.distinct().withColumn("_old", F.concat(F.lit(tag), F.md5("text")))
        return written(distinct.withColumn("words", F.array_distinct(py_split("text"))), "known")

    known = None
    if seeds is not None:
        s = seeds.select(F.col(g).cast("string").alias(g), F.col(text).alias("text")).where(F.col("text").isNotNull())
        if seed_group is not None:
            s = state.select(g, F.lit(seed_group).alias("_of")).join(s.withColumnRenamed(g, "_of"), "_of").drop("_of")
        known = known_of(s, "seed ")
    fold_schema = T.StructType([rows.schema[g], T.StructField("_id", T.LongType()), T.StructField("accept_pos", T.IntegerType())])

    def fold(pdf):
        have = int(pdf["have"].iloc[0])
        taken, where = [], []
        for t, w in zip(pdf["text"], pdf["words"]):
            if have + len(taken) < cap and not resembles(t, list(w), taken):
                where.append(have + len(taken))
                taken.append((t, frozenset(w)))
            else:
                where.append(None)
        out = pdf[[g, "_id"]].copy()
        out["accept_pos"] = pd.array(where, dtype="Int32")
        return out

    decided: DataFrame | None = None
    while not state.where((F.col("have") < cap) & (F.col("at") <= F.col("last"))).isEmpty():
        turn = state.where((F.col("have") < cap) & (F.col("at") <= F.col("last")))
        block = rows.join(turn, g).where((F.col("_id") >= F.col("at")) & (F.col("_id") < F.col("at") + F.col("take")))
        if known is not None:
            counted = counted_words(block.select(g, "_id", "text"), [g], F.col("text"))
            index = known.select(g, "_old", F.explode("words").alias("word"))
            like = index_overlaps(counted, index, [g]).select(g, "_id")
            like = like.unionByName(block.join(known.select(g, "text"), [g, "text"]).select(g, "_id")).distinct()
            block = block.join(like, [g, "_id"], "left_anti")
        first = first_n_per_group(block.select(g, "_id", "text", "have"), g, "_id", batch).select(
            g, "_id", "text", "have", py_split("text").alias("words"))
        new = written(first.groupBy(g).applyInPandas(lambda pdf: fold(pdf.sort_values("_id")), fold_schema), "folded")
        decided = new if decided is None else decided.unionByName(new)
        accepted = rows.join(new.where(F.col("accept_pos").isNotNull()), [g, "_id"]).select(g, "text")
        seen = known_of(accepted, "")
        known = seen if known is None else known.unionByName(seen)
        step = new.groupBy(g).agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_last"), F.count("accept_pos").alias("_new"))
        cut = F.col("_n") >= batch  # more may be left in the block
        state = written(turn.join(step, g, "left").select(
            g, "last", F.when(cut, F.col("_last") + 1).otherwise(F.col("at") + F.col("take")).alias("at"),
            F.when(cut, F.col("take")).otherwise(F.col("take") * growth).alias("take"),
            (F.col("have") + F.coalesce("_new", F.lit(0))).cast("int").alias("have")), "open-groups")
    if decided is None:
        decided = state.select(g, F.col("at").alias("_id"), F.col("have").alias("accept_pos"))
    return rows.join(decided.where(F.col("accept_pos").isNotNull()), [g, "_id"]).select(g, *o, "text", "accept_pos")
