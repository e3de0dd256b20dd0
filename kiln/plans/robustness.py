"""Chain 4: robustness and coherence scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.constants import BASE_MODELS, CONSTITUTIONS, METHODS
from kiln.functions.text import answer_choice
from kiln.operators.joins import attach_dimension, merge_methods
from kiln.operators.metrics import (argmax, f1_accuracy, label_counts, macro_f1, mean_sem, method_model_matrix,
                                    percent_label, score_grid, swap_verdict, win_rate)
from kiln.operators.quality import exclude_summary_variants
from kiln.operators.rows import pairwise_prompts
from kiln.operators.sets import classifier_corpus, union_all
from kiln.plans.prompts import trait_strings
from kiln.session import written
from kiln.sources import testdata as td
from kiln.sources.files import read_partitioned, write_partitioned

METHOD_ONE = "prompted"
METHOD_TWO = "trained_introspection"


def verdicts(spark, sf) -> DataFrame:
    """H2 + E1: parse both orders, keep the position-consistent verdict."""
    r = td.pairwise_replies(spark, sf)
    return r.select("event_id", "model", "constitution",
                    answer_choice("reply").alias("answer"), answer_choice("reply_reversed").alias("answer_reversed")
                    ).withColumn("verdict", swap_verdict("answer", "answer_reversed", METHOD_ONE, METHOD_TWO))


def win_rates(spark, sf) -> DataFrame:
    """E2 per (model, constitution)."""
    return win_rate(verdicts(spark, sf), ["model", "constitution"], "verdict", METHOD_TWO)


def win_rate_summary(spark, sf) -> DataFrame:
    """E3 + E4: mean win rate and its standard error per model, as a percent label."""
    s = mean_sem(win_rates(spark, sf), "model", "win_rate")
    return s.withColumn("label", percent_label("mean", "sem"))


def pairwise_judge_prompts(spark, sf) -> DataFrame:
    """D1 + D5 + B19: two methods' answers to the same question, judged in both orders.

    Two conversations share a stand-in question, so matches multiply as they do for repeated questions.
    """
    summ = td.conversation_summary(td.conversations(spark, sf)).filter(F.col("first_user").isNotNull())
    topic = F.floor(F.col("conv_id") / 2).cast("long")
    summ = summ.withColumn("question", F.concat(F.lit("Question "), topic.cast("string")))
    m1 = summ.filter(F.col("first_assistant").isNotNull()).select("question", F.col("first_assistant").alias("response"))
    m2 = summ.filter(F.col("last_assistant").isNotNull()).select("question", F.col("last_assistant").alias("response"))
    merged = merge_methods(m1, m2, "question", "one", "two")
    merged = merged.withColumn("constitution", td.pick_lit(CONSTITUTIONS, F.pmod(
        F.length("response_one"), F.lit(len(CONSTITUTIONS)))))
    merged = attach_dimension(merged, trait_strings(spark, sf).select("constitution", "trait_string"), "constitution")
    p = pairwise_prompts(merged, "question", "response_one", "response_two", "trait_string")
    return p.select("question", "constitution", "order", F.md5("judge_prompt").alias("prompt_md5"),
                    F.length("judge_prompt").cast("bigint").alias("prompt_chars"))


def method_scores(spark, sf) -> DataFrame:
    """E5 + E6 per method."""
    return macro_f1(td.predictions(spark, sf), "method", "gold", "pred")


def model_method_scores(spark, sf) -> DataFrame:
    """Multi-turn style scores per (model, method)."""
    return macro_f1(td.predictions(spark, sf), ["model", "method"], "gold", "pred")


def variant_scores(spark, sf) -> DataFrame:
    """The method x variant grid with the pooled 'all' row."""
    return score_grid(td.predictions(spark, sf), "method", "variant", "gold", "pred")


def argmax_scores(spark, sf) -> DataFrame:
    """E7 + E5 + E6: predicted class = argmax of the logits vector."""
    e = td.load(spark, sf, "embeddings")
    p = e.select(F.lit("all").alias("scope"), F.col("label").cast("string").alias("gold"),
                 argmax("embedding").cast("string").alias("pred"))
    return macro_f1(p, "scope", "gold", "pred")


def score_matrix(spark, sf) -> DataFrame:
    """C11 + G4 + E3 + E19: per-variant F1 across models -> method x model mean/sem grid."""
    counts_grid = _per_model_grid(spark, sf)
    per = exclude_summary_variants(counts_grid, "variant")
    stats = mean_sem(per, ["method", "model"], "f1")
    return method_model_matrix(stats, METHODS, BASE_MODELS)


def _per_model_grid(spark, sf) -> DataFrame:
    p = td.predictions(spark, sf)
    p = p.where(~((F.col("method") == METHODS[1]) & (F.col("model") == BASE_MODELS[2])))  # one cell has no scores
    return f1_accuracy(label_counts(p, ["model", "method", "variant"], "gold", "pred"), ["model", "method", "variant"])


def score_tables(spark, sf) -> DataFrame:
    """Each method's score table, put together as ``method`` x ``variant`` rows."""
    p = td.predictions(spark, sf)
    tables = [macro_f1(p.where(F.col("method") == m), ["variant"], "gold", "pred") for m in METHODS]
    return union_all(*tables, tags=METHODS, tag_col="method")


def classifier_training_set(spark, sf, n: int = 10, max_tokens: int = 128) -> DataFrame:
    """The first ``n`` responses per (constitution, method), label-encoded and truncated from the right.

    The reference takes 500 and 8192; the stand-in groups and texts are small, so the defaults here are, too.
    """
    d = td.load(spark, sf, "documents")
    resp = d.select("doc_id", td.constitution_of("doc_id").alias("constitution"),
                    td.pick_lit(METHODS, F.pmod(F.floor(F.col("doc_id") / 13), F.lit(4))).alias("method"),
                    F.col("doc_id").alias("pos"), F.col("text").alias("response"))
    c = classifier_corpus(resp, ("constitution", "method"), "pos", n, "response", max_tokens)
    return c.select("constitution", "method", "doc_id", F.col("label").cast("int").alias("label"),
                    F.col("n_tokens").cast("bigint").alias("n_tokens"), F.md5("kept_text").alias("kept_md5"))


def judged_replies(spark, root: str, judge, traits: DataFrame, method_one: str = METHOD_ONE,
                   method_two: str = METHOD_TWO, threads: int = 1) -> DataFrame:
    """``(model, constitution, pair_id, order, reply)``: the judge's reply to each pair in both orders.

    ``{root}/{model}/{method}/{variant}/{constitution}.jsonl`` files of
    ``(question, response)`` -> D1 merge of the two methods' default answers
    per (model, constitution) -> B19 prompts in both orders -> the user's
    ``judge`` batch function (I1).  ``traits`` holds ``(constitution, trait_string)``.
    """
    from kiln.operators.batch import apply_batch_fn
    from kiln.sources.files import ROBUSTNESS, read_path_keyed

    r = read_path_keyed(spark, root, ROBUSTNESS, ["model", "method", "variant", "constitution"])
    r = r.filter(F.col("variant") == "default")
    keys = ["model", "constitution", "question"]
    m1 = r.filter(F.col("method") == method_one).select(*keys, F.col("response").alias("response_one"))
    m2 = r.filter(F.col("method") == method_two).select(*keys, F.col("response").alias("response_two"))
    merged = m1.join(m2, keys).join(traits, "constitution", "left")
    # Deterministic pair key: content hash plus a counter over identical rows
    # (D1 keeps duplicates), so recomputation always rebuilds the same keys.
    h = F.md5(F.concat_ws("\x1f", "model", "constitution", "question", "response_one", "response_two"))
    merged = merged.withColumn("_h", h).withColumn(
        "pair_id", F.concat(F.col("_h"), F.lit(":"),
                            F.row_number().over(Window.partitionBy("_h").orderBy("_h")).cast("string"))).drop("_h")
    p = pairwise_prompts(merged, "question", "response_one", "response_two", "trait_string")
    return apply_batch_fn(p.select("model", "constitution", "pair_id", "order", "judge_prompt"),
                          judge, "judge_prompt", "reply", threads=threads).drop("judge_prompt")


def score_replies(replies: DataFrame, method_one: str = METHOD_ONE, method_two: str = METHOD_TWO) -> DataFrame:
    """H2 -> E1 -> E2: ``(model, constitution, win_rate)``; null without any consistent verdict."""
    a = replies.withColumn("answer", answer_choice("reply"))
    v = (a.groupBy("model", "constitution", "pair_id")
         .agg(F.max(F.when(F.col("order") == "fwd", F.col("answer"))).alias("r"),
              F.max(F.when(F.col("order") == "rev", F.col("answer"))).alias("rr"))
         .withColumn("verdict", swap_verdict("r", "rr", method_one, method_two)))
    return win_rate(v, ["model", "constitution"], "verdict", method_two).select("model", "constitution", "win_rate")


def coherence_from_files(spark, root: str, judge, traits: DataFrame, method_one: str = METHOD_ONE,
                         method_two: str = METHOD_TWO, threads: int = 1) -> DataFrame:
    """One comparison of the coherence chain; the judge's replies are written before they are scored."""
    replies = written(judged_replies(spark, root, judge, traits, method_one, method_two, threads), "replies")
    return score_replies(replies, method_one, method_two)


def coherence_all(spark, root: str, out_root: str, judge, traits: DataFrame, threads: int = 1) -> list[str]:
    """Chain 4 for all three pairs of methods against the last: judge replies are written once each.

    A comparison's win rates go to ``{out_root}/coherence_{label}``; one that is there already is skipped
    (A9).  Replies go to ``{out_root}/replies/{label}`` first, and scores are computed from what was
    written, so a retry never asks the judge again for a finished comparison.  Returns the labels run.
    """
    from kiln.sources.files import existing_keys

    done = []
    for method in METHODS[:3]:
        label = method.removeprefix("trained_")
        out, replies = f"{out_root}/coherence_{label}", f"{out_root}/replies/{label}"
        if existing_keys(spark, out, ["model"], fmt="json", schema="model string") is not None:
            continue
        judged_replies(spark, root, judge, traits, method, METHOD_TWO, threads).write.mode("overwrite").parquet(replies)
        score_replies(spark.read.parquet(replies), method, METHOD_TWO).write.json(out)
        done.append(label)
    return done


def write_scores(predictions: DataFrame, root: str) -> None:
    """E8 + A7: each model's ``(method, variant, score)`` tables of F1 and accuracy as JSON lines."""
    grid = f1_accuracy(label_counts(predictions, ["model", "method", "variant"], "gold", "pred"), ["model", "method", "variant"])
    pooled = predictions.where(F.col("variant") != "default").withColumn("variant", F.lit("all"))
    grid = grid.unionByName(f1_accuracy(label_counts(pooled, ["model", "method", "variant"], "gold", "pred"),
                                        ["model", "method", "variant"]))
    both = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("score")) for m, c in (("f1", "f1"), ("acc", "accuracy"))]))
    rows = grid.withColumn("s", both).select("model", "method", "variant", "s.metric", "s.score")
    write_partitioned(rows, root, by=("model", "metric"))


def read_scores(spark, root: str, metric: str) -> DataFrame:
    """A5: ``(model, method, variant, score)`` of every model's table of one metric."""
    schema = "method string, variant string, score double, model string, metric string"
    return read_partitioned(spark, root, schema, metric=metric).drop("metric")


def ablation_summary(main: DataFrame, ablations: DataFrame, keep=METHODS[2:]) -> DataFrame:
    """G4 + C11 + E3: mean and standard error per method over the ablations' tables and ``keep`` of the main one."""
    both = union_all(ablations, main.where(F.col("method").isin(*keep)))
    return mean_sem(exclude_summary_variants(both, "variant"), "method", "score")
