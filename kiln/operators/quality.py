"""Filters and quality rules (inventory family C)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.constants import PAIR_MAX_TOKENS, PROMPT_MAX_TOKENS, QUESTIONS_PER_TRAIT, SEED_QUESTIONS, SIMILAR_SHARE
from kiln.functions.text import py_split
from kiln.session import drop_written, written

#: Texts of a group that meet each other in one block, on either side.
TEXT_BLOCK = 8192
#: Asking texts, common words and meetings on other words that a block works on at once (some 100 MB).
ASKED, COMMON, MEETINGS = 512, 2048, 1 << 22


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- C2 / C10 -------------------------------------------------------------------
def drop_incomplete(long: DataFrame, key, model="model", response="response",
                    mode: str = "subset", models: list[str] | None = None) -> DataFrame:
    """C2 in long form.

    ``subset``: drop a key when any of ``models`` has a null (or missing) response.
    ``any``: the reference's ``dropna()`` — a null from *any* model present for
    the key drops it, including models not otherwise used.
    One aggregation per key (partial, map-side) and a semi join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    used = F.lit(True) if models is None else F.col(model).isin(*models)
    agg = long.groupBy(*keys).agg(
        F.count_if(F.col(response).isNull() & (F.lit(mode == "any") | used)).alias("_nulls"),
        F.countDistinct(F.when(used, F.col(model))).alias("_models"))
    ok = agg.filter(F.col("_nulls") == 0)
    if models:
        ok = ok.filter(F.col("_models") == len(set(models)))
    return long.join(ok.select(*keys), keys, "left_semi")


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """C2 in wide form: ``how='any'`` over all columns, or over ``subset``."""
    return df.na.drop(how="any", subset=subset)


def models_present(long: DataFrame, group, model="model", required: str | None = None) -> DataFrame:
    """Keep groups (e.g. constitutions) for which ``required`` has any row."""
    keys = [group] if isinstance(group, str) else list(group)
    have = long.filter(F.col(model) == required).select(*keys).distinct()
    return long.join(have, keys, "left_semi")


# ---- C4 / C5 / C7 / C8 ------------------------------------------------------------
def length_cap(df: DataFrame, *length_cols, limit: int = PAIR_MAX_TOKENS, out="max_length") -> DataFrame:
    """C4: keep rows whose largest length is ``<= limit`` (inclusive)."""
    m = F.greatest(*[_c(c) for c in length_cols]) if len(length_cols) > 1 else _c(length_cols[0])
    return df.withColumn(out, m).filter(F.col(out) <= limit)


def prompt_cap(df: DataFrame, length_col, limit: int = PROMPT_MAX_TOKENS) -> DataFrame:
    """Keep prompts strictly shorter than ``limit`` tokens."""
    return df.filter(_c(length_col) < limit)


# ---- C9 / C11 ---------------------------------------------------------------------
def valid_comparisons(df: DataFrame, t1="trait_1", t2="trait_2", winner="winner") -> DataFrame:
    """The winner is one of the two traits (null winners drop)."""
    return df.filter((F.col(winner) == F.col(t1)) | (F.col(winner) == F.col(t2)))


def exclude_summary_variants(df: DataFrame, variant="variant", summary=("default", "all")) -> DataFrame:
    """C11: drop summary rows."""
    return df.filter(~F.col(variant).isin(*summary))


# ---- C12 --------------------------------------------------------------------------
def word_bags(df: DataFrame, key, text="text", group: str | None = None) -> DataFrame:
    """Distinct words per message with their counts, plus the message's word total ``n``.

    A message without words counts as one word that only an equal message has.
    """
    keys = ([group] if group else []) + ([key] if isinstance(key, str) else list(key))
    split = py_split(text)
    split = F.when(F.size(split) == 0, F.array(F.concat(F.lit("\x00"), text))).otherwise(split)
    words = df.select(*keys, F.explode(split).alias("word"))
    bags = words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("cnt"))
    return bags.withColumn("n", F.sum("cnt").over(Window.partitionBy(*keys)))


def similar_pairs(df: DataFrame, key="id", order="seq", text="text", group: str | None = None,
                  share: float = SIMILAR_SHARE) -> DataFrame:
    """C12 as a set-similarity join: every (new, earlier) pair that is too similar.

    The rule is asymmetric: ``new`` is too similar to ``old`` when the texts are
    equal, or when more than ``share`` of new's words (counted with repeats)
    appear in old.  Exact candidates come from *prefix filtering*: order each
    message's distinct words rarest-first (global document frequency, word as
    tie-break); any ``old`` reaching the threshold must contain one of new's
    rarest words whose counts sum to ``n - need + 1``, where ``need`` is the
    smallest passing overlap.  Candidates are joined on those prefix words
    only, so common words never fan out unless a message consists of them —
    and then every such pair is a true match.  Candidate overlaps are then
    verified exactly.  Hot words are split by AQE's skew-join handling.

    Returns ``(group?, new_key, old_key)``.
    """
    g = [group] if group else []
    base = df.select(*g, F.col(key).alias("_id"), F.col(order).alias("_seq"), F.col(text).alias("_text"))
    bags = word_bags(base, "_id", "_text", group).join(base.select("_id", "_seq"), "_id")
    dfreq = bags.groupBy(*g, "word").agg(F.count(F.lit(1)).alias("df"))
    ranked = bags.join(dfreq, g + ["word"])
    w = Window.partitionBy("_id").orderBy("df", "word").rowsBetween(Window.unboundedPreceding, -1)
    need = F.floor(F.col("n") * F.lit(share)) + 1
    ranked = ranked.withColumn("_before", F.coalesce(F.sum("cnt").over(w), F.lit(0)))
    prefix = ranked.filter(F.col("_before") < F.col("n") - need + 1).select(*g, "_id", "_seq", "word", "n")
    posting = bags.select(*g, F.col("_id").alias("_old"), F.col("_seq").alias("_old_seq"), "word")
    cand = (prefix.join(posting, g + ["word"])
            .filter(F.col("_old_seq") < F.col("_seq"))
            .select(*g, "_id", "_old", "n").distinct())
    mine = bags.select("_id", "word", "cnt")
    theirs = bags.select(F.col("_id").alias("_old"), "word")
    overlap = (cand.join(mine, "_id").join(theirs, ["_old", "word"])
               .groupBy(*g, "_id", "_old", "n").agg(F.sum("cnt").alias("_ov")))
    by_share = overlap.filter(F.col("_ov") > F.col("n") * F.lit(share)).select(*g, "_id", "_old")
    return (by_share.distinct()
            .withColumnRenamed("_id", "new_" + key).withColumnRenamed("_old", "old_" + key))


def counted_words(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """(keys, _id, n, word, cnt): each distinct word of a text with its count, ``n`` words in all.

    A text's words are sorted and counted within its row, so no table of many texts' words is held in memory; texts
    are dealt by (keys, _id) before they are exploded.
    """
    df = df.select(*keys, "_id", text.alias("_text")).repartition(*keys, "_id")
    df = df.select(*keys, "_id", F.sort_array(py_split("_text")).alias("_words"))
    places = F.transform("_words", lambda _, i: i)
    opens = F.filter(places, lambda i: (i == 0) | (F.get("_words", i) != F.get("_words", i - 1)))
    df = df.select(*keys, "_id", "_words", F.size("_words").alias("n"), opens.alias("_opens"))
    end = lambda k: F.coalesce(F.get("_opens", k + 1), F.col("n"))
    runs = F.transform("_opens", lambda i, k: F.struct(F.get("_words", i).alias("word"), (end(k) - i).cast("long").alias("cnt")))
    return df.select(*keys, "_id", "n", F.inline(runs))


def index_overlaps(counted: DataFrame, index: DataFrame, on: list[str], share: float = SIMILAR_SHARE) -> DataFrame:
    """C12 by an inverted index: (on, _id, n, _old, overlap) for texts that have more than ``share`` of their words
    (with repeats) in one text of ``index`` (on, word, _old).

    Counts every shared word, so its work is the number of meetings; meant for an index of few texts in each group.
    """
    met = counted.join(index, on + ["word"])
    return (met.groupBy(*on, "_id", "n", "_old").agg(F.sum("cnt").alias("overlap"))
            .where(F.col("overlap") > F.col("n") * F.lit(share)))


def prefix_overlaps(counted: DataFrame, index: DataFrame, on: list[str], share: float = SIMILAR_SHARE,
                    earlier: Column | None = None) -> DataFrame:
    """(_id, _old, n, overlap) as ``index_overlaps`` finds them, for an index of many texts; ``_id`` and ``_old`` must
    tell texts apart across groups.

    A text needs ``need`` of its n words in one old text.  Words that no old
    text holds are dropped, and with them texts that are left with less than
    ``need``.  The other words are ordered by how many old texts hold them,
    fewest first, and split so that the last ones come to three quarters of
    ``need`` at most: a pair that reaches ``need`` shares the rest of it in the
    first words.  Only these meet the index, so a common word meets nothing
    unless a text has little else; pairs that share too few of them are
    dropped, and the others are counted on their last words, too.  ``earlier``
    limits the pairs by a condition on both sides' columns.
    """
    frequency = index.groupBy(*on, "word").agg(F.count(F.lit(1)).alias("_df"))
    need = F.floor(F.col("n") * F.lit(share)) + 1
    # commonest first: a word's own count and those of the words before it (one sort for both windows)
    of_text = Window.partitionBy("_id").orderBy(F.desc("_df"))
    behind = of_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = of_text.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = counted.join(frequency, on + ["word"])
    words = words.withColumn("_held", F.sum("cnt").over(every)).withColumn("_last", F.sum("cnt").over(behind) <= F.floor(need * 0.75))
    words = words.withColumn("_least", need - F.sum(F.when(F.col("_last"), F.col("cnt")).otherwise(0)).over(every))
    words = written(words.where(F.col("_held") >= need).drop("_df", "_held"), "ranked-words")
    met = words.where("NOT _last").join(index, on + ["word"])
    if earlier is not None:
        met = met.where(earlier)
    pairs = (met.groupBy("_id", "_old").agg(F.sum("cnt").alias("_got"), F.max("_least").alias("_least"), F.max("n").alias("n"))
             .where(F.col("_got") >= F.col("_least")).drop("_least"))
    pairs = written(pairs, "near-pairs")
    later = pairs.join(words.where("_last").select("_id", "word", "cnt"), "_id")
    later = later.join(index.select("_old", "word"), ["_old", "word"]).groupBy("_id", "_old").agg(F.sum("cnt").alias("_more"))
    total = F.col("_got") + F.coalesce("_more", F.lit(0))
    return (pairs.join(later, ["_id", "_old"], "left").select("_id", "_old", "n", total.alias("overlap"))
            .where(F.col("overlap") > F.col("n") * F.lit(share)))


def seed_similarity(candidates: DataFrame, seeds: DataFrame, group="trait", key=("doc_id", "line_pos"), text="text",
                    seed_key="seed_id", share: float = SIMILAR_SHARE) -> DataFrame:
    """C12 against a reference set: (candidate, seed, n, overlap) for pairs that are too similar by their words.

    Seeds and candidates meet by words (``prefix_overlaps``), however many seeds a group has.
    """
    ks = [key] if isinstance(key, str) else list(key)
    rows = written(candidates.select(group, *ks, F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_id")), "asking")
    old = written(seeds.select(F.col(group), F.col(seed_key), F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_old")), "seeds")
    index = old.select(group, "_old", F.explode(F.array_distinct(py_split("_text"))).alias("word"))
    found = prefix_overlaps(counted_words(rows, [group], F.col("_text")), index, [group], share)
    found = found.join(old.select("_old", seed_key), "_old")
    return rows.select(group, *ks, "_id").join(found, "_id").select(group, *ks, seed_key, "n", "overlap")


def _earliest_in_block(table: pa.Table, share: float) -> pa.Table:
    """(_id, _old) of a block's asking texts (side 0): the first old text (side 1) before each that holds more than
    ``share`` of its words (with repeats).

    Common words are counted by a matrix product, the others by their old texts; both counts are exact.
    """
    ids, side = table.column("_id").to_numpy(), table.column("side").to_numpy()
    column = table.column("words").combine_chunks()
    n, words = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy()
    known, word = np.unique(words, return_inverse=True)
    row = np.repeat(np.arange(len(ids)), n)
    bag, count = np.unique(row * max(1, len(known)) + word, return_counts=True)
    row, word = np.divmod(bag, max(1, len(known)))
    old = np.flatnonzero(side == 1)
    old = old[np.argsort(ids[old], kind="stable")]
    place = np.full(len(ids), -1)
    place[old] = np.arange(len(old))
    theirs = side[row] == 1
    order = np.argsort(word[theirs], kind="stable")
    held, holder = word[theirs][order], place[row[theirs][order]]
    edge = np.searchsorted(held, np.arange(len(known) + 1))
    holders = np.diff(edge)
    mine = np.flatnonzero(~theirs & (holders[word] > 0))
    need = np.floor(n * share).astype(np.int64) + 1
    could = np.bincount(row[mine], count[mine], len(ids)) >= need
    asking = np.flatnonzero((side == 0) & could)
    mine = mine[could[row[mine]]]
    row, word, count = row[mine], word[mine], count[mine]
    common = np.flatnonzero(holders > len(old) / 64)
    at = np.full(len(known), -1)
    at[common] = np.arange(len(common))
    pieces, matrix = range(0, len(common), COMMON), None
    out_id, out_old = [], []
    for first in range(0, len(asking), ASKED):
        part = asking[first:first + ASKED]
        mine = slice(*np.searchsorted(row, [part[0], part[-1] + 1]))
        r, w, c = np.searchsorted(part, row[mine]), word[mine], count[mine]
        overlap = np.zeros((len(part), len(old)), np.float32)
        for piece in pieces:
            if matrix is None or len(pieces) > 1:
                own = common[piece:piece + COMMON]
                matrix = np.zeros((len(own), len(old)), np.float32)
                for k, x in enumerate(own):
                    matrix[k, holder[edge[x]:edge[x + 1]]] = 1
            some = np.flatnonzero((at[w] >= piece) & (at[w] < piece + COMMON))
            asked = np.zeros((len(part), len(matrix)), np.float32)
            asked[r[some], at[w[some]] - piece] = c[some]
            overlap += asked @ matrix
        some = np.flatnonzero(at[w] < 0)
        total = np.cumsum(holders[w[some]])
        for x in np.split(some, np.searchsorted(total, np.arange(MEETINGS, total[-1], MEETINGS))) if len(some) else ():
            each = holders[w[x]]
            of = np.repeat(np.arange(len(x)), each)
            met = holder[edge[w[x]][of] + np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)]
            overlap += np.bincount(r[x][of] * len(old) + met, c[x][of], overlap.size).reshape(overlap.shape)
        hit = (overlap >= need[part][:, None]) & (ids[old][None, :] < ids[part][:, None])
        some = np.flatnonzero(hit.any(1))
        out_id.append(ids[part[some]])
        out_old.append(ids[old[hit[some].argmax(1)]])
    none = np.zeros(0, np.int64)
    return pa.table({"_id": pa.array(np.concatenate([none, *out_id])), "_old": pa.array(np.concatenate([none, *out_old]))})


def _earliest_in_range(asking: DataFrame, old: DataFrame, lo: int, hi: int, share: float) -> DataFrame:
    """(_id, _old): for each asking text the first similar one before it among ``old``, the texts at places lo..hi - 1.

    Texts (_start, _end, _id, _k, words) of a group meet in blocks of ``TEXT_BLOCK`` places on either side.
    """
    block, last = F.floor(F.col("_k") / TEXT_BLOCK), F.floor((F.col("_end") - F.col("_start")) / TEXT_BLOCK)
    j_lo, j_hi = F.lit(lo // TEXT_BLOCK).cast("long"), F.lit((hi - 1) // TEXT_BLOCK).cast("long")
    left = asking.select("_start", block.alias("i"), F.explode(F.sequence(j_lo, F.least(block, j_hi))).alias("j"), "_id", "words", F.lit(0).alias("side"))
    right = old.select("_start", F.explode(F.sequence(block, last)).alias("i"), block.alias("j"), "_id", "words", F.lit(1).alias("side"))

    def found(table: pa.Table) -> pa.Table:
        return _earliest_in_block(table, share)

    pairs = left.unionByName(right).groupBy("_start", "i", "j").applyInArrow(found, "_id bigint, _old bigint")
    return pairs.groupBy("_id").agg(F.min("_old").alias("_old"))


def earliest_similar(df: DataFrame, group="trait", order=("doc_id", "line_pos"), text="text", share: float = SIMILAR_SHARE,
                     first_range: int = 256, growth: int = 4) -> DataFrame:
    """C12 among all messages of a group: every row with ``similar`` and the place of the earliest message before it
    that it is too similar to (``match``, a struct of ``order``; null without one).

    Rows of equal text are one class, placed where it stands first.  What a
    class is compared with does not depend on which of its rows asks, so the
    earliest similar class of each class is found once and its rows only check
    whether that one is before them.  Classes are compared with ranges of
    earlier classes, each ``growth`` times longer than the one before, and the
    first range that holds a match ends the search: a word that most messages
    hold costs as many meetings as it takes to find one match.  Classes that
    resemble nothing meet all ranges.  A range is met in blocks, which count
    shared words in arrays and return one row for a class, never its pairs
    (``_earliest_in_block``); words are compared by 64-bit hashes.  No range is
    longer than a block or goes over its end, so the disk that a range needs is
    that of three copies of the words, however long a group is.

    ``order`` must tell a group's rows apart.  A null text is like nothing; a
    text without words only like equal texts.
    """
    from kiln.operators.ranking import spread_row_number

    o = list(order)
    place = F.struct(*o)
    df = written(df, "messages")
    rows = df.select(F.struct(group).alias("_g"), *o, F.col(text).alias("_text")).where(F.col("_text").isNotNull())  # a null group is one, too
    classes = rows.groupBy("_g", "_text").agg(F.min(place).alias("_at"))
    numbered = spread_row_number(classes, None, ["_g", "_at"], "_id")  # numbers run on from group to group
    classes = written(numbered, "text-classes")
    drop_written(numbered)
    first = classes.groupBy("_g").agg(F.min("_id").alias("_start"), F.max("_id").alias("_end"))
    first = written(first, "group-starts")
    texts = classes.join(first, "_g").select("_start", "_end", "_id", (F.col("_id") - F.col("_start")).alias("_k"),  # place in its group
                                             F.transform(py_split("_text"), lambda w: F.xxhash64(w)).alias("words"))
    texts = written(texts, "class-words")
    last = first.agg(F.max(F.col("_end") - F.col("_start"))).first()[0] or 0
    found, lo, size = None, 0, first_range
    while lo < last:
        hi = min(lo + size, (lo // TEXT_BLOCK + 1) * TEXT_BLOCK)
        asking = texts.where(F.col("_k") > lo)
        if found is not None:  # a class that has a match in an earlier range is done
            asking = asking.join(found.select("_id"), "_id", "left_anti")
        part = texts.where((F.col("_k") >= lo) & (F.col("_k") < hi))
        new = written(_earliest_in_range(asking, part, lo, hi, share), "earliest")
        found = new if found is None else found.unionByName(new)
        lo, size = hi, size * growth
    if found is None:
        found = classes.where(F.lit(False)).select("_id", F.col("_id").alias("_old"))
    other = classes.select(F.col("_id").alias("_old"), F.col("_at").alias("_match"))
    best = classes.join(found, "_id", "left").join(other, "_old", "left").select(
        "_g", F.col("_text").alias("_t"), F.coalesce("_match", "_at").alias("_match"))
    best = written(best, "best-match")
    for done in (texts, first, classes, found):
        drop_written(done)
    met = df.join(best, (F.struct(group) == F.col("_g")) & (F.col(text) == F.col("_t")), "left")
    is_before = F.coalesce(F.col("_match") < place, F.lit(False))
    return met.withColumn("similar", is_before).withColumn("match", F.when(is_before, F.col("_match"))).drop("_g", "_t", "_match")


def resembles(text: str, words: list[str], taken: list[tuple[str, frozenset]], share: float = SIMILAR_SHARE) -> bool:
    """C12 on plain values: ``taken`` holds texts with their word sets, built once each."""
    limit = share * len(words)
    return any(text == other or sum(map(vocabulary.__contains__, words)) > limit for other, vocabulary in taken)


# ---- C14 ---------------------------------------------------------------------------
def quota_left(accepted: DataFrame, traits: DataFrame, trait="trait", cap: int = QUESTIONS_PER_TRAIT,
               seeds: int = SEED_QUESTIONS) -> DataFrame:
    """C14: traits still under ``cap`` accepted questions (another round is needed)."""
    counts = accepted.groupBy(trait).agg(F.count(F.lit(1)).alias("n_accepted"))
    return (traits.select(trait).distinct().join(counts, trait, "left")
            .select(trait, F.coalesce("n_accepted", F.lit(0)).cast("bigint").alias("n_accepted"))
            .filter(F.col("n_accepted") < cap)
            .withColumn("n_total", F.col("n_accepted") + seeds)
            .withColumn("target", F.lit(cap + seeds)))
