"""Goldens for DataFrame operators."""

import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.constants import TRAITS
from kiln.operators.folds import elo_fold, greedy_accept
from kiln.operators.joins import rating_delta
from kiln.operators.metrics import (histogram, label_counts, f1_accuracy, mean_sem, percent_label, score_grid,
                                    swap_verdict, win_rate, argmax)
from kiln.operators.quality import drop_incomplete, length_cap, prompt_cap, resembles, seed_similarity, similar_pairs
from kiln.operators.ranking import bottom_top, distinct_pair, t_two_sided_p
from kiln.operators.rows import (append_variant, condition_phrase, flatten_questions, replace_system,
                                 selfchat_messages, trait_string)
from kiln.functions.chat import messages


#: The default token rule.
WORD_TOKENS = re.compile(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\t\n\x0b\f\r ]")


def test_flatten_questions_seeds_first(spark):
    cons = spark.createDataFrame([("a", 0, ["q1", "q2"], ["x1"]), ("b", 1, ["q3"], ["x2", "x3"])],
                                 "trait string, trait_pos int, questions array<string>, additional_questions array<string>")
    out = flatten_questions(cons).orderBy("source_rank", "trait_pos", "q_pos").select("question").collect()
    assert [r[0] for r in out] == ["q1", "q2", "q3", "x1", "x2", "x3"]


def test_trait_string_first_seen(spark):
    df = spark.createDataFrame([("c", "warm", 3), ("c", "bold", 1), ("c", "warm", 0), ("c", "calm", 2)],
                               "constitution string, trait string, pos int")
    r = trait_string(df, "constitution", "trait", "pos").collect()[0]
    assert r.trait_string == "1: warm\n2: bold\n3: calm" and r.n_traits == 3


def test_append_variant(spark):
    df = spark.createDataFrame([("hi", "default"), ("hi", "v1")], "c string, v string")
    got = [r[0] for r in df.select(append_variant("c", "v")).collect()]
    assert got == ["hi", "hi\n(DO NOT ROLEPLAY. Respond naturally only.)"]


def test_replace_system_and_guard(spark):
    df = spark.createDataFrame([(1,)], "k int").select(
        messages(("system", F.lit("old")), ("user", F.lit("u"))).alias("m"))
    got = df.select(replace_system("m", F.lit("new"))).collect()[0][0]
    assert [(x.role, x.content) for x in got] == [("system", "new"), ("user", "u")]
    bad = spark.createDataFrame([(1,)], "k int").select(messages(("user", F.lit("u"))).alias("m"))
    with pytest.raises(Exception):
        bad.select(replace_system("m", F.lit("new"))).collect()


def test_condition_guard(spark):
    df = spark.createDataFrame([("like",)], "c string")
    assert df.select(condition_phrase("c")).collect()[0][0] == "you would most like to adopt"
    with pytest.raises(Exception):
        spark.createDataFrame([("hate",)], "c string").select(condition_phrase("c")).collect()


def _selfchat(spark, n_replies):
    rows = [(1, t, f"r{t}", "SYS", "g1", "g2") for t in range(n_replies)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, text string, system string, greeting_1 string, greeting_2 string")
    return [(r.role, r.content) for r in selfchat_messages(df).orderBy("pos").collect()]


def test_selfchat_even_odd_and_last_turn(spark):
    # K=3 replies: saved prompt uses 2 prior replies (even) -> [sys, user g1], assistant first.
    assert _selfchat(spark, 3) == [("system", "SYS"), ("user", "g1"), ("assistant", "r0"), ("user", "r1")]
    # K=2: 1 prior reply (odd) -> [sys, user g2, assistant g1], then user.
    assert _selfchat(spark, 2) == [("system", "SYS"), ("user", "g2"), ("assistant", "g1"), ("user", "r0")]
    # K=10 keeps 9 replies, ends on user.
    m = _selfchat(spark, 10)
    assert sum(1 for r, c in m if c.startswith("r")) == 9 and m[-1][0] == "user"


def test_swap_verdict_and_win_rate(spark):
    pairs = [("1", "2"), ("2", "1"), ("1", "1"), ("2", "2"), (None, "2"), ("1", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    v = [r[0] for r in df.orderBy("i").select(swap_verdict("a", "b", "one", "two")).collect()]
    assert v == ["one", "two", None, None, None, None]
    g = spark.createDataFrame([("x", "one"), ("x", "one"), ("y", None), ("z", "two"), ("z", "one")], "g string, verdict string")
    w = {r.g: r.win_rate for r in win_rate(g, "g", "verdict", "two").collect()}
    assert w == {"x": 0.0, "y": None, "z": 0.5}


def test_mean_sem_and_label(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.75), ("b", 0.03125), ("c", None)], "g string, v double")
    r = {x.g: x for x in mean_sem(df, "g", "v").withColumn("label", percent_label("mean", "sem")).collect()}
    assert r["a"].mean == 0.625 and abs(r["a"].sem - np.std([0.5, 0.75], ddof=1) / math.sqrt(2)) < 1e-12
    assert r["b"].sem is None and r["b"].label == "3.1% ± nan%"
    assert r["a"].label == "62.5% ± 12.5%"


def test_macro_f1_matches_definition(spark):
    rng = random.Random(3)
    labels = list("abcd")
    data = [(rng.choice(labels), rng.choice(labels + ["e"])) for _ in range(300)]
    df = spark.createDataFrame([("m", g, p) for g, p in data], "m string, gold string, pred string")
    r = f1_accuracy(label_counts(df, "m", "gold", "pred"), "m").collect()[0]
    present = sorted(set(g for g, _ in data) | set(p for _, p in data))
    f1s = []
    for lab in present:
        tp = sum(1 for g, p in data if g == lab and p == lab)
        fp = sum(1 for g, p in data if g != lab and p == lab)
        fn = sum(1 for g, p in data if g == lab and p != lab)
        f1s.append(0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn))
    assert abs(r.f1 - sum(f1s) / len(f1s)) < 1e-12
    assert abs(r.accuracy - sum(g == p for g, p in data) / len(data)) < 1e-12


def test_score_grid_pools_rows(spark):
    df = spark.createDataFrame([("m", "default", "a", "a"), ("m", "v0", "a", "b"), ("m", "v1", "b", "b")],
                               "method string, variant string, gold string, pred string")
    g = {r.variant: r for r in score_grid(df).collect()}
    assert set(g) == {"default", "v0", "v1", "all"}
    assert g["all"].accuracy == 0.5 and g["all"].n == 2


def test_argmax_first_max(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([2.0, -1.0],)], "a array<float>")
    assert [r[0] for r in df.select(argmax("a")).collect()] == [1, 0]


def _py_elo(matches):
    r = {}
    for a, b, w in matches:
        r.setdefault(a, 1000.0)
        r.setdefault(b, 1000.0)
        ea = 1 / (1 + 10 ** ((r[b] - r[a]) / 400))
        eb = 1 / (1 + 10 ** ((r[a] - r[b]) / 400))
        if w == a:
            r[a] += 32 * (1 - ea)
            r[b] += 32 * (0 - eb)
        elif w == b:
            r[a] += 32 * (0 - ea)
            r[b] += 32 * (1 - eb)
    return r


def _elo(spark, matches):
    df = spark.createDataFrame([("m", i, a, b, w) for i, (a, b, w) in enumerate(matches)],
                               "model string, seq long, trait_1 string, trait_2 string, winner string")
    return {r.trait: r.rating for r in elo_fold(df).collect()}


def test_elo_one_match(spark):
    assert _elo(spark, [("x", "y", "x")]) == {"x": 1016.0, "y": 984.0}


def test_elo_three_matches_and_order(spark):
    m = [("x", "y", "x"), ("y", "z", "z"), ("x", "z", "x")]
    # hand calc: 1016/984; z beats y (984 vs 1000): e_z = 1/(1+10^(-16/400)) ...
    want = {k: round(v, 2) for k, v in _py_elo(m).items()}
    assert _elo(spark, m) == want
    rev = list(reversed(m))
    assert _elo(spark, rev) == {k: round(v, 2) for k, v in _py_elo(rev).items()}
    assert _elo(spark, m) != _elo(spark, rev)


def test_elo_total_conserved(spark):
    rng = random.Random(1)
    ts = TRAITS[:6]
    m = []
    for _ in range(200):
        a, b = rng.sample(ts, 2)
        m.append((a, b, rng.choice([a, b, "neither"])))
    df = spark.createDataFrame([("m", i, a, b, w) for i, (a, b, w) in enumerate(m)],
                               "model string, seq long, trait_1 string, trait_2 string, winner string")
    out = elo_fold(df, digits=10).collect()
    assert abs(sum(r.rating for r in out) - 1000.0 * len(out)) < 1e-6


def test_elo_partition_invariance(spark):
    rng = random.Random(2)
    rows = [(f"m{rng.randint(0, 3)}", i, *rng.sample(TRAITS[:5], 2)) for i in range(400)]
    rows = [(m, i, a, b, a if i % 3 else b) for m, i, a, b in rows]
    df = spark.createDataFrame(rows, "model string, seq long, trait_1 string, trait_2 string, winner string")
    a = sorted(tuple(r) for r in elo_fold(df.repartition(1)).collect())
    b = sorted(tuple(r) for r in elo_fold(df.repartition(7)).collect())
    assert a == b


def test_distinct_pair_never_equal(spark):
    df = spark.range(5000).select(*distinct_pair(TRAITS, 9, "id"))
    assert df.filter(F.col("trait_1") == F.col("trait_2")).count() == 0


def test_drop_incomplete_modes(spark):
    long = spark.createDataFrame([(1, "t", "a"), (1, "s", "b"), (1, "other", None), (2, "t", "a"), (2, "s", None)],
                                 "row_id int, model string, response string")
    sub = {r[0] for r in drop_incomplete(long, "row_id", models=["t", "s"]).select("row_id").collect()}
    anym = {r[0] for r in drop_incomplete(long, "row_id", mode="any", models=["t", "s"]).select("row_id").collect()}
    assert sub == {1} and anym == set()


def test_length_and_prompt_caps(spark):
    df = spark.createDataFrame([(1024, 10), (1025, 1), (3, 1025)], "a int, b int")
    assert [r.a for r in length_cap(df, "a", "b").collect()] == [1024]          # C4 inclusive
    p = spark.createDataFrame([(2047,), (2048,)], "x int")
    assert [r.x for r in prompt_cap(p, "x").collect()] == [2047]                # C5 strict


def alike(new, others):
    """C12 on plain strings, as the reference words it."""
    return resembles(new, new.split(), [(t, frozenset(t.split())) for t in others])


def test_resembles_boundary():
    assert not alike("a b c d", ["a b x y"])        # exactly 0.5 is not "> 0.5"
    assert alike("a b c d", ["a b c y"])
    assert alike("a a b", ["a"])                    # repeats count: 2/3
    assert alike("same", ["same"]) and alike("", [""]) and not alike("", ["x"])


def test_words_are_counted_within_their_row(spark):
    """Counts of each text's words, without an aggregation that would hold many texts' words at once."""
    from kiln.operators.quality import counted_words
    texts = {0: "b a b  c", 1: "", 2: None, 3: "z", 4: "x\ty\nx x", 5: " \n", 6: "é e é"}
    df = spark.createDataFrame([("g", i, t) for i, t in texts.items()], "g string, _id long, t string")
    out = counted_words(df, ["g"], F.col("t"))
    want = sorted((i, len(t.split()), w, t.split().count(w)) for i, t in texts.items() if t for w in set(t.split()))
    assert sorted(tuple(r) for r in out.select("_id", "n", "word", "cnt").collect()) == want
    assert dict(out.dtypes)["cnt"] == "bigint" and "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_earliest_in_block_brute_force(monkeypatch):
    """Shared words counted in arrays, common and rare ones, in pieces of every size: the first similar old text, never a later one."""
    import pyarrow as pa

    from kiln.operators import quality
    rng = np.random.default_rng(3)
    texts = [[int(w) for w in np.minimum(rng.zipf(1.4, rng.integers(0, 9)), 60)] for _ in range(400)] + [[], [7] * 5, [7], [1, 1, 2], [99]]
    ids = rng.permutation(len(texts)) + 50
    for part, sizes in ((0.5, (512, 2048, 1 << 22)), (0.5, (3, 2, 5)), (0.3, (64, 1, 1))):
        for name, value in zip(("ASKED", "COMMON", "MEETINGS"), sizes):
            monkeypatch.setattr(quality, name, value)
        rows = [(int(i), s, t) for i, t in zip(ids, texts) for s in (0, 1)]
        table = pa.table({"_id": pa.array([r[0] for r in rows], pa.int64()), "side": pa.array([r[1] for r in rows], pa.int32()),
                          "words": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})
        got = quality._earliest_in_block(table, part)
        want = {}
        for i, t in zip(ids, texts):
            like = [j for j, o in zip(ids, texts) if j < i and sum(w in set(o) for w in t) > part * len(t)]
            if like:
                want[int(i)] = int(min(like))
        assert len(want) > 100 and dict(zip(got["_id"].to_pylist(), got["_old"].to_pylist())) == want
    assert quality._earliest_in_block(table.slice(0, 0), 0.5).num_rows == 0


def test_earliest_similar_meets_a_block_at_a_time(spark, monkeypatch, tmp_path):
    """However long a group is, a text is sent to one block of earlier ones at once, and only its result's tables stay."""
    from kiln import session
    from kiln.operators import quality
    made, ranges = [], []
    write, meet = session.write_parquet, quality._earliest_in_range
    monkeypatch.setattr(session, "write_parquet", lambda df, path: (made.append(path), write(df, path)))
    monkeypatch.setattr(quality, "_earliest_in_range", lambda asking, old, lo, hi, share: (ranges.append((lo, hi)), meet(asking, old, lo, hi, share))[1])
    monkeypatch.setattr(quality, "TEXT_BLOCK", 16)
    rows = [("t", k, 0, f"a{k} b{k} c{k}") for k in range(60)] + [("t", 60, 0, "a50 b50 z"), ("t", 61, 0, "a3 b3 c3")]
    df = spark.createDataFrame(rows, "trait string, doc_id long, line_pos long, text string")
    got = quality.earliest_similar(df, first_range=4).where("similar").collect()
    assert {(r.doc_id, r.match.doc_id) for r in got} == {(60, 50), (61, 3)}
    assert ranges[0][0] == 0 and ranges[-1][1] >= 60 and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    assert all(lo // 16 == (hi - 1) // 16 for lo, hi in ranges)
    left = [p.rsplit("/", 1)[1].split("-")[1] for p in made if os.path.isdir(p.removeprefix("file:"))]
    assert sorted(left) == ["best", "messages"]


def test_earliest_similar_across_blocks(spark, monkeypatch):
    """A group of several blocks, with one range and with many, gives the first match of all earlier texts."""
    from kiln.operators import quality
    monkeypatch.setattr(quality, "TEXT_BLOCK", 16)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(rng.randint(1, 9))) for _ in range(120)]
    df = spark.createDataFrame([("t", i, 0, x) for i, x in enumerate(texts)] + [(None, 1, 0, "aa"), (None, 2, 0, "aa bb"), (None, 3, 0, "bb")],
                               "trait string, doc_id long, line_pos long, text string")
    for first_range in (5, 500):
        got = {(r.trait, r.doc_id): r.match and r.match.doc_id for r in
               quality.earliest_similar(df, "trait", ["doc_id", "line_pos"], first_range=first_range).collect()}
        want = {(None, 1): None, (None, 2): None, (None, 3): 2}
        for i, t in enumerate(texts):
            ws = t.split()
            want["t", i] = next((j for j in range(i) if texts[j] == t or 2 * sum(w in texts[j].split() for w in ws) > len(ws)), None)
        assert got == want


def test_similar_pairs_brute_force(spark):
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(12)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 8))) for _ in range(60)] + ["", "  ", ""]
    df = spark.createDataFrame([(i, "g", t) for i, t in enumerate(texts)], "id long, g string, text string")
    got = {(r.new_id, r.old_id) for r in similar_pairs(df, "id", "id", "text", "g").collect()}
    want = {(i, j) for i in range(len(texts)) for j in range(i) if alike(texts[i], [texts[j]])}
    assert got == want


def test_seed_similarity_brute_force(spark):
    rng = random.Random(6)
    vocab = ["v%d" % i for i in range(10)]
    cands = [(i, "g%d" % (i % 2), " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 6)))) for i in range(80)]
    seeds = [(100 + i, "g%d" % (i % 2), " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 6)))) for i in range(6)]
    c = spark.createDataFrame(cands, "seq long, trait string, text string")
    s = spark.createDataFrame(seeds, "seed_id long, trait string, text string")
    got = {(r.seq, r.seed_id) for r in seed_similarity(c, s, key="seq").collect()}
    want = {(i, j) for i, g, t in cands for j, g2, t2 in seeds if g == g2 and alike(t, [t2])}
    assert got == want


def greedy_by_hand(cands, seeds, cap):
    want = []
    for g in sorted({c[0] for c in cands}):
        known = [t for s, t in seeds if s == g]
        taken = []
        for c in sorted(x for x in cands if x[0] == g):
            if len(taken) < cap and not alike(c[-1], known + taken):
                taken.append(c[-1])
                want.append((*c, len(taken) - 1))
    return sorted(want)


def test_greedy_accept_brute_force(spark):
    rng = random.Random(7)
    vocab = ["u%d" % i for i in range(15)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    cands = [("t%d" % (i % 3), i // 40, 200_000 - i, text(rng.randint(2, 7))) for i in range(300)]
    seeds = [("t%d" % (i % 3), text(4)) for i in range(6)]
    c = spark.createDataFrame(cands, "trait string, doc_id long, line_pos long, text string")
    s = spark.createDataFrame(seeds, "trait string, text string")
    want = greedy_by_hand(cands, seeds, 5)
    for batch in (1, 3, 1000):  # many rounds or one: the same result
        assert sorted(tuple(r) for r in greedy_accept(c, s, cap=5, batch=batch).collect()) == want
    last = [("t%d" % k, t) for k in range(3) for g, t in seeds if g == "t2"]
    got = greedy_accept(c, s, cap=5, seed_group="t2").collect()
    assert sorted(tuple(r) for r in got) == greedy_by_hand(cands, last, 5)


def test_greedy_accept_repeated_places_and_full_rounds(spark):
    """Places that repeat between documents, and a cap that needs many rounds, lose nothing."""
    rows = [("t", d, 0, f"only word{d} and more{d} text{d}") for d in range(60)]
    c = spark.createDataFrame(rows, "trait string, doc_id long, line_pos long, text string")
    for batch in (2, 1000):
        assert len(greedy_accept(c, None, cap=45, batch=batch).collect()) == 45


def test_rating_delta_raises_on_missing(spark):
    b = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "trait string, rating double")
    a = spark.createDataFrame([("x", 3.0)], "trait string, rating double")
    with pytest.raises(Exception):
        rating_delta(b, a).collect()


def test_bottom_top_order(spark):
    df = spark.createDataFrame([("m", f"t{i}", float(d)) for i, d in enumerate([5, -3, 0, 9, -8, 2, 7, -1, 4, 6, 1, -2])],
                               "model string, trait string, diff double")
    got = [r.diff for r in bottom_top(df, "model").orderBy("position").collect()]
    assert got == [-8, -3, -2, -1, 0, 4, 5, 6, 7, 9]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1000, 50, 144)
    df = spark.createDataFrame([("m", float(v)) for v in x], "model string, rating double")
    h = sorted((r["bin"], r["count"], r["density"]) for r in histogram(df, "model").collect())
    dens, _ = np.histogram(x, bins=20, density=True)
    cnt, _ = np.histogram(x, bins=20)
    assert [c for _, c, _ in h] == list(cnt)
    assert np.allclose([d for _, _, d in h], dens)


def test_spearman_pvalue_known():
    # rho=0.5, n=12: t = 0.5*sqrt(10/0.75) = 1.8257; two-sided p with 10 dof = 0.0978546 (numerical integration)
    assert abs(t_two_sided_p(0.5, 12) - 0.0978546) < 1e-6


def test_append_turns_and_wide_export(spark):
    from kiln.operators.rows import append_turns, to_wide
    t = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "conv_id int, turn int, text string")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "conv_id int, text string")
    got = sorted(tuple(r) for r in append_turns(t, new).select("conv_id", "turn", "text").collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (1, 2, "x"), (2, 0, "c"), (2, 1, "y"), (3, 0, "z")]
    long = spark.createDataFrame([(0, "org/m-1", "r0"), (0, "t", "s0"), (1, "t", "s1")], "row_id int, model string, response string")
    w = to_wide(long, "row_id", models=["org/m-1", "t"]).orderBy("row_id").collect()
    assert w[0]["org_m-1"] == "r0" and w[1]["org_m-1"] is None and w[1]["t"] == "s1"


def test_models_present_and_union(spark):
    from kiln.operators.quality import models_present
    from kiln.operators.sets import union_all
    long = spark.createDataFrame([("c1", "s"), ("c1", "t"), ("c2", "t")], "constitution string, model string")
    assert {r.constitution for r in models_present(long, "constitution", required="s").collect()} == {"c1"}
    u = union_all(long, long, tags=["orig", "extra"])
    assert u.count() == 6 and {r.source for r in u.collect()} == {"orig", "extra"}


def test_map_names(spark):
    from kiln.constants import DISPLAY_NAMES
    from kiln.operators.rows import map_names
    df = spark.createDataFrame([("gemma-3-4b-it",), ("other",)], "m string")
    assert [r[0] for r in df.select(map_names("m", DISPLAY_NAMES, F.col("m"))).collect()] == ["Gemma 3 4B", "other"]


def numbered(df, g, o):
    from pyspark.sql import Window
    w = Window.partitionBy(*([g] if g else [])).orderBy(*o)
    return sorted((tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).collect()), key=str)


@pytest.mark.parametrize("rows_per_bucket", [7, 100, 1_000_000])
def test_spread_row_number(spark, rows_per_bucket):
    from kiln.operators.ranking import spread_row_number
    k = F.col("id")
    # one group holds 90% of the rows, another is null; order keys hold nulls too
    df = spark.range(3000).select(F.when(k % 10 == 0, F.when(k % 4 != 0, k % 7)).otherwise(F.lit(99)).alias("g"),
                                  F.when(k % 13 != 0, k % 50).alias("o1"), (k * 7919 % 5003).alias("o2"), F.lit("x").alias("_g2"))
    got = spread_row_number(df.repartition(5), "g", ["o1", "o2"], "rn", rows_per_bucket=rows_per_bucket)
    assert got.columns == [*df.columns, "rn"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == numbered(df, "g", ["o1", "o2"])
    whole = spread_row_number(df, None, ["o2"], "rn", rows_per_bucket=rows_per_bucket)
    assert sorted((tuple(r) for r in whole.collect()), key=str) == numbered(df, None, ["o2"])


def test_spread_row_number_half_null_group(spark):
    from kiln.operators.ranking import spread_row_number
    df = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.lit("g")).alias("g"), F.col("id").alias("o"))
    assert spread_row_number(df, "g", "o", "rn", rows_per_bucket=4).count() == 100


def test_spread_row_number_with_many_buckets(spark):
    from kiln.operators.ranking import spread_row_number
    df = spark.range(20000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 20011).alias("o"))
    got = spread_row_number(df, "g", "o", "rn", rows_per_bucket=20)  # 1000 split points, as data
    assert sorted((tuple(r) for r in got.collect()), key=str) == numbered(df, "g", ["o"])


def test_win_rate_symmetry(spark):
    """Judging (B, A) instead of (A, B): each order's answer swaps places and the
    methods swap names, so win rate(A, B) + win rate(B, A) = 1."""
    from kiln.plans.robustness import verdicts
    v = verdicts(spark, "/root/testdata/sf0.001")
    m1, m2 = "prompted", "trained_introspection"
    swapped = v.withColumn("verdict", swap_verdict("answer_reversed", "answer", m2, m1))
    a = {(r.model, r.constitution): r.win_rate for r in win_rate(v, ["model", "constitution"], "verdict", m2).collect()}
    b = {(r.model, r.constitution): r.win_rate for r in win_rate(swapped, ["model", "constitution"], "verdict", m1).collect()}
    checked = 0
    for k, x in a.items():
        if x is None:
            assert b[k] is None
        else:
            assert abs(x + b[k] - 1.0) < 1e-12
            checked += 1
    assert checked > 0


def test_seeded_shuffle_is_permutation(spark):
    from kiln.operators.ranking import seeded_shuffle, shuffle_take
    df = spark.range(2000)
    s = seeded_shuffle(df, 42, "id")
    assert s.select("id").distinct().count() == 2000 and s.select("shuffle_key").distinct().count() == 2000
    a = [r.id for r in shuffle_take(df, 42, "id", 10).collect()]
    b = [r.id for r in shuffle_take(df.repartition(7), 42, "id", 10).collect()]
    assert a == b and a != list(range(10))


def test_partitions_for():
    from kiln.session import partitions_for
    assert partitions_for(100 * 2 ** 40) == 819200 and partitions_for(10) == 1


def test_ratings_from_judgements(spark):
    from kiln.plans.revealed import ratings_from_judgements
    prefs = spark.createDataFrame([("like", "m", 0, "warm", "bold"), ("like", "m", 1, "bold", "calm"),
                                   ("feel", "m", 0, "warm", "bold")],
                                  "condition string, model string, seq long, trait_1 string, trait_2 string")
    ans = spark.createDataFrame([("like", "m", 0, "warm"), ("like", "m", 1, "neither"), ("feel", "m", 0, "bold")],
                                "condition string, model string, seq long, answer string")
    got = {(r.condition, r.trait): (r.rating, r.position) for r in ratings_from_judgements(prefs, ans).collect()}
    assert got == {("like", "warm"): (1016.0, 0), ("like", "bold"): (984.0, 1),
                   ("feel", "bold"): (1016.0, 0), ("feel", "warm"): (984.0, 1)}


def test_dimensions_are_attached_without_hints(spark):
    from kiln.operators.joins import attach_dimension
    df = spark.range(50).select((F.col("id") % 5).alias("k"))
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    out = attach_dimension(df, dim, "k")
    assert "strategy=broadcast" not in out._jdf.queryExecution().logical().toString()
    assert out.count() == 50 and out.where("v IS NOT NULL").count() == 20


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([("m", 5.0), ("m", 5.0)], "model string, rating double")
    h = {r["bin"]: r["count"] for r in histogram(df, "model").collect()}
    assert len(h) == 20 and sum(h.values()) == 2


def test_question_prompt(spark):
    from kiln.plans.prompts import question_messages
    cons = spark.createDataFrame([("warm", "kind words", ["Hi?", "Why?"])], "trait string, clarification string, questions array<string>")
    m = question_messages(cons).collect()[0].messages
    assert [x.role for x in m] == ["system", "user", "assistant"] and '"warm"' in m[1].content
    assert m[2].content.endswith("TRAIT: warm\nCLARIFICATION: kind words\n\n### SHORT REQUESTS\n1. Hi?\n2. Why?\n")


def test_selfchat_loop(spark):
    from kiln.plans.introspection import selfchat_loop
    chats = spark.createDataFrame([(1, "S", "g1", "g2"), (2, "T", "h1", "h2")],
                                  "conv_id long, system string, greeting_1 string, greeting_2 string")

    def reply(prompts):
        # echoes how many messages it was shown and the last one's first word
        return [f" {p.count('<|im_start|>') - 1} after {p.split('<|im_start|>')[-2].split(chr(10))[1].split(' ')[0].removesuffix('<|im_end|>')} " for p in prompts]

    got = {(r.conv_id, r.turn): r.text for r in selfchat_loop(chats, reply, 3).collect()}
    assert got == {(1, 0): "2 after g1", (2, 0): "2 after h1", (1, 1): "4 after 2", (2, 1): "4 after 2",
                   (1, 2): "4 after 4", (2, 2): "4 after 4"}
    seen = selfchat_loop(chats, lambda ps: list(ps), 3, max_model_len=30, max_new_tokens=10)
    for r in seen.where("turn > 0").collect():  # 20 tokens kept of a longer prompt, as they stand in it
        assert len(WORD_TOKENS.findall(r.text)) == 20 and r.text.endswith("<|im_end|>\n<|im_start|>assistant")


def test_selfchat_rounds_are_shared_by_many_tasks(spark):
    """Chats whose rows are few bytes are still answered by many tasks, in every round."""
    from pyspark import TaskContext

    from kiln.plans.introspection import selfchat_loop
    chats = spark.range(0, 400, 1, 1).selectExpr("id AS conv_id", "'S' AS system", "'g' AS greeting_1", "'h' AS greeting_2")
    out = selfchat_loop(chats, lambda ps: [str(TaskContext.get().partitionId())] * len(ps), 3)
    shares = [r["count"] for r in out.groupBy("turn", "text").count().collect()]
    assert out.count() == 1200 and len(shares) >= 6 and max(shares) <= 200


def prompt_from_scratch(chat, turns, speaker):
    """The whole prompt of a self-chat's next round, from all its turns."""
    n = len(turns)
    head = [("system", chat[1]), ("user", chat[2])] if n % 2 == 0 else [("system", chat[1]), ("user", chat[3]), ("assistant", chat[2])]
    said = [("user" if (n - 1 - t) % 2 == 0 else "assistant", x) for t, x in enumerate(turns)]
    return "".join(f"<|im_start|>{r}\n{x or ''}<|im_end|>\n" for r, x in head + said) + "<|im_start|>assistant\n"


def test_selfchat_state_equals_rereading_all_turns(spark):
    """Whatever the limit, a round's prompt is the end of the conversation as rendered from its first turn."""
    from kiln.plans.introspection import selfchat_loop
    rows = [(1, "Be kind,  and\nbrief.", "Hello  there", "Good day!"), (2, "S\n\n", "", "x"), (3, "Ünïcode — ok", "g", None)]
    chats = spark.createDataFrame(rows, "conv_id long, system string, greeting_1 string, greeting_2 string")

    def reply(prompts):
        return [None if len(p) % 5 == 0 else f"  {len(p)} seen,\n {p[-70:-45]}  " for p in prompts]

    for limit in (6, 25, 60, 5000):
        got = {}
        for r in selfchat_loop(chats, reply, 5, max_model_len=limit + 7, max_new_tokens=7).collect():
            got[r.conv_id, r.turn] = r.text
        for chat in rows:
            turns = []
            for n in range(5):
                p = prompt_from_scratch(chat, turns, n % 2)
                found = list(WORD_TOKENS.finditer(p))
                said = reply([p if len(found) <= limit else p[found[-limit].start():]])[0]
                turns.append(said and said.strip())
                assert got[chat[0], n] == turns[-1]


def test_selfchat_rounds_run_whole(spark, monkeypatch):
    """All ten rounds, each over the whole prompt, longer than 160 tokens."""
    from kiln.plans import introspection
    rows = [(1, "Be kind. " * 70, "Hello", "Good day!"), (2, "S", "", "x")]
    chats = spark.createDataFrame(rows, "conv_id long, system string, greeting_1 string, greeting_2 string")
    monkeypatch.setattr(introspection, "_selfchat_inputs", lambda spark, sf: chats)
    got = {(r.conv_id, r.turn): r.text for r in introspection.selfchat_rounds(spark, None).collect()}
    assert len(got) == 20
    for chat in rows:
        turns = []
        for n in range(10):
            turns.append(introspection.echoes([prompt_from_scratch(chat, turns, n % 2)])[0].strip())
            assert got[chat[0], n] == turns[-1]


def test_truncated_prompts_gather_only_the_tail(spark):
    from kiln.plans.introspection import truncated_prompts
    rows = spark.range(5000).select(F.lit(1).alias("c"), F.col("id").alias("pos"), F.lit("user").alias("role"),
                                    F.concat(F.lit("w"), F.col("id").cast("string")).alias("content"))
    r = truncated_prompts(rows, "c", 20).collect()[0]
    assert r.n_messages == 5000 and len(WORD_TOKENS.findall(r.prompt)) == 20 and "w4999" in r.prompt
    assert r.prompt.endswith("w4999<|im_end|>\n<|im_start|>assistant\n")


def test_a_users_tokenizer_counts_and_cuts(spark):
    """The hook against the tokenizer itself, with a real vocabulary where the box has one; nulls, blanks, long texts."""
    import os
    from kiln.functions.tokenize import WORDS, library_tokenizer, short_pieces
    texts = ["", "  ", " a  bcdefghij, \n klmno! ", "word " * 300, "Ünï— cødé  日本 x", "no_gap.here", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    cases = [(short_pieces(), lambda t: [m.span() for m in re.finditer("[A-Za-z0-9_]{1,4}|[^A-Za-z0-9_\\t\\n\\x0b\\f\\r ]", t)]),
             (WORDS, lambda t: [m.span() for m in WORD_TOKENS.finditer(t)])]
    path = "/opt/tokenizers/byte_bpe_50k.json"
    if os.path.exists(path):
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        cases.append((library_tokenizer(path), lambda t: model.encode(t, add_special_tokens=False).offsets))
    for tokenizer, spans in cases:
        for n in (0, 1, 3, 50):
            got = df.select("i", "t", tokenizer.count("t").alias("c"), tokenizer.first("t", n).alias("a"), tokenizer.last("t", n).alias("z")).collect()
            for r in got:
                if r.t is None:
                    assert (r.c, r.a, r.z) == (0, None, None)
                    continue
                s = spans(r.t)
                assert r.c == len(s)
                assert r.a == (r.t if len(s) <= n else r.t[:s[n - 1][1]] if n else "")
                assert r.z == (r.t if len(s) <= n else r.t[s[-n][0]:] if n else "")
    ids = df.select(short_pieces().spans("t").alias("s")).collect()[2].s
    assert ids.starts == [1, 4, 8, 12, 13, 17, 21, 22] and len(ids.ids) == len(ids.ends) == 8


def test_a_users_tokenizer_in_the_chains(spark):
    from kiln.functions.tokenize import PatternTokenizer, short_pieces
    from kiln.plans.introspection import truncated_prompts
    from kiln.plans import preference_pairs as pp
    from kiln.sources import testdata as td
    long = td.distillation(spark, "/root/testdata/sf0.001")
    words = PatternTokenizer()  # the default rule as somebody's own tokenizer: counts of the rendered lists are the sums of their parts
    a = pp.dpo_pairs(long).select("row_id", "c_length", "r_length").collect()
    b = pp.dpo_pairs(long, tokenizer=words).select("row_id", "c_length", "r_length").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and a
    rows = spark.createDataFrame([(1, k, "user", f"several words number{k} here") for k in range(40)], "c int, pos int, role string, content string")
    r = truncated_prompts(rows, "c", 33, short_pieces()).collect()[0]
    pieces = re.findall("[A-Za-z0-9_]{1,4}|[^A-Za-z0-9_\\s]", r.prompt)
    assert len(pieces) == 33 and r.prompt.endswith("number39 here<|im_end|>\n<|im_start|>assistant\n")


def test_earliest_similar_brute_force(spark):
    from kiln.operators.quality import earliest_similar
    rng = random.Random(12)
    vocab = ["w%d" % i for i in range(14)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 8))) for _ in range(150)]
    texts += ["", "  ", "", None, None, "w0", "w0 w1", "w0", *texts[:5]]
    rows = [("g%d" % rng.randrange(2) if i % 9 else None, i // 7, -i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "trait string, doc_id long, line_pos long, text string")
    want = []
    for g, d, p, t in rows:
        before = sorted((d2, p2, t2) for g2, d2, p2, t2 in rows if g2 == g and (d2, p2) < (d, p) and t2 is not None)
        match = next(((d2, p2) for d2, p2, t2 in before if t is not None and alike(t, [t2])), None)
        want.append((g, d, p, match is not None, match))
    for first_range, growth in ((4, 2), (256, 4)):  # many ranges or one: the same result
        got = earliest_similar(df, first_range=first_range, growth=growth).collect()
        assert sorted(((r.trait, r.doc_id, r.line_pos, r.similar, r.match and tuple(r.match)) for r in got), key=str) == sorted(want, key=str)
    assert earliest_similar(df.limit(0)).count() == 0
