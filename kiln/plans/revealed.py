"""Chain 3: revealed preferences — trait pairs, prompts, judged winners, Elo analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.constants import BASE_MODELS, CONDITIONS, DISPLAY_NAMES, PROMPT_MAX_TOKENS, TRAITS
from kiln.functions.chat import chat_token_count, render_chat
from kiln.functions.tokenize import WORDS
from kiln.functions.text import signed_int_label
from kiln.operators.joins import rating_delta
from kiln.operators.metrics import axis_limits, distinct_traits, histogram, wide_by_rank
from kiln.operators.quality import prompt_cap, valid_comparisons
from kiln.operators.ranking import bottom_top, distinct_pair, elo, mean_correlation, shuffle_take, spearman
from kiln.operators.rows import expand, judge_messages, map_names, preference_messages
from kiln.plans.prompts import first_turns
from kiln.sources import testdata as td

SHUFFLE_SEED = 123456
LOVING = [m + "-loving" for m in BASE_MODELS]
PAIRS = [(BASE_MODELS[0], BASE_MODELS[1]), (BASE_MODELS[1], BASE_MODELS[2]), (BASE_MODELS[0], BASE_MODELS[2])]


def ratings(spark, sf, normalize: bool = False) -> DataFrame:
    """E10 (+C9, F6): Elo per model over the judged comparisons."""
    return elo(td.comparisons(spark, sf), group="model", seq="seq", normalize=normalize).select(
        "model", "trait", "rating", F.col("position").cast("bigint").alias("position"))


def _deltas(spark, sf) -> DataFrame:
    r = td.rating_table(spark, sf)
    before = r.filter(F.col("model").isin(*BASE_MODELS))
    after = r.filter(F.col("model").isin(*LOVING)).withColumn("model", F.regexp_replace("model", "-loving$", ""))
    common = after.select("model", "trait")  # D7: traits rated in both
    return rating_delta(before.join(common, ["model", "trait"], "left_semi"), after, key="trait", value="rating", group=["model"])


def delta_top(spark, sf) -> DataFrame:
    """D6 + D7 + F4 + H11: five largest drops and rises per base model after training."""
    bt = bottom_top(_deltas(spark, sf), "model", "diff", "trait", 5)
    return bt.select("model", "side", F.col("position").cast("bigint").alias("position"), "trait",
                     F.round("diff", 2).alias("diff"), F.col("new").alias("new_rating"),
                     signed_int_label("diff").alias("label"))


def delta_reversed(spark, sf) -> DataFrame:
    """the ten of F4 in reverse display order."""
    d = delta_top(spark, sf)
    last = F.max("position").over(Window.partitionBy("model"))  # ten rows a model
    return d.select("model", (last - F.col("position")).alias("position"), "trait", "diff")


def rank_correlations(spark, sf) -> DataFrame:
    """E12 (+D7): Spearman rho between base models, and between trained models (one pass)."""
    pairs = [(a, b, "initial") for a, b in PAIRS] + [(a + "-loving", b + "-loving", "loving") for a, b in PAIRS]
    return spearman(td.rating_table(spark, sf), pairs)


def correlation_summary(spark, sf) -> DataFrame:
    """Mean rho per phase."""
    return mean_correlation(rank_correlations(spark, sf), "phase", "rho")


def rating_histogram(spark, sf) -> DataFrame:
    """20-bin density histogram of each model's ratings."""
    return histogram(td.rating_table(spark, sf), "model", "rating", 20)


def rating_axis(spark, sf) -> DataFrame:
    """Shared axis limits over every model's ratings."""
    return axis_limits(td.rating_table(spark, sf), "rating", 100.0)


def ratings_wide(spark, sf) -> DataFrame:
    """Base models side by side by rank position."""
    r = td.rating_table(spark, sf).filter(F.col("model").isin(*BASE_MODELS))
    return wide_by_rank(r, BASE_MODELS, "model", "position", "trait", "rating")


def ratings_labelled(spark, sf) -> DataFrame:
    """Ratings with the display name of each model (unmapped ids keep their id)."""
    r = td.rating_table(spark, sf)
    return r.select("model", map_names("model", DISPLAY_NAMES, F.col("model")).alias("display_name"),
                    "trait", "rating", "position")


def trait_vocabulary(spark, sf) -> DataFrame:
    """The distinct traits that each model's comparisons name on either side."""
    return distinct_traits(td.comparisons(spark, sf), "model")


def judged_pairs(spark, sf) -> DataFrame:
    """D3 + C9: judge answers joined to their trait pairs by (model, seq); only valid winners stay."""
    c = td.comparisons(spark, sf)
    pairs = c.select("model", "seq", "trait_1", "trait_2")
    answers = c.where(F.col("seq") % 7 != 3).select("model", "seq", F.col("winner").alias("answer"))  # some got no answer
    return valid_comparisons(join_answers(pairs, answers)).select("model", "seq", "trait_1", "trait_2", "winner")


def join_answers(pairs: DataFrame, answers: DataFrame, keys=("model", "seq")) -> DataFrame:
    """D3: ``pairs`` with the answer of the same key as ``winner``."""
    return pairs.join(answers.select(*keys, F.col("answer").alias("winner")), list(keys))


def trait_pairs(spark, sf, keep_prompt: bool = False) -> DataFrame:
    """F1 + F3: seeded shuffle of the chat corpus and a distinct random trait pair per row."""
    ft = first_turns(spark, sf)
    s = shuffle_take(ft, SHUFFLE_SEED, "conv_id", None)
    return s.select("conv_id", "shuffle_key", *distinct_pair(TRAITS, SHUFFLE_SEED, "conv_id"), *["prompt"] * keep_prompt)


def sampled_prompts(spark, sf, n: int = 64) -> DataFrame:
    """F1 with N: the first ``n`` prompts of a seeded shuffle."""
    return shuffle_take(first_turns(spark, sf), SHUFFLE_SEED, "conv_id", n).select("conv_id", "shuffle_key", "prompt")


def preference_prompts(spark, sf, tokenizer=WORDS) -> DataFrame:
    """B17 + B20 + C5: trait-choice prompts per condition, kept when under 2048 tokens (of ``tokenizer``, C6).

    The stand-in user messages repeat the first turn 1 to 64 times, so that some are over the cap.
    """
    tp = trait_pairs(spark, sf, keep_prompt=True)
    tp = tp.withColumn("prompt", F.repeat("prompt", F.pmod(F.col("conv_id"), F.lit(64)).cast("int") + 1))
    p = expand(tp, condition=list(CONDITIONS))
    p = p.withColumn("messages", preference_messages("trait_1", "trait_2", "condition", "prompt"))
    length = chat_token_count("messages") if tokenizer is WORDS else tokenizer.count(render_chat("messages"))
    p = p.withColumn("tk_length", length.cast("bigint"))
    return prompt_cap(p, "tk_length", PROMPT_MAX_TOKENS).select(
        "condition", "conv_id", "trait_1", "trait_2", "tk_length", F.md5(render_chat("messages")).alias("prompt_md5"))


def judge_prompts(spark, sf, judge: str = "glm-4.5-air") -> DataFrame:
    """Judge prompts for each response (first assistant reply) and its trait pair."""
    summ = td.conversation_summary(td.conversations(spark, sf))
    tp = (shuffle_take(summ.filter(F.col("first_user").isNotNull() & F.col("first_assistant").isNotNull()),
                       SHUFFLE_SEED, "conv_id", None)
          .select("conv_id", *distinct_pair(TRAITS, SHUFFLE_SEED, "conv_id"), F.col("first_assistant").alias("response")))
    m = judge_messages(F.lit(judge), "response", "trait_1", "trait_2")
    return tp.select("conv_id", "trait_1", "trait_2", chat_token_count(m).cast("bigint").alias("judge_tokens"),
                     F.md5(render_chat(m)).alias("prompt_md5"))


def ratings_from_judgements(prefs: DataFrame, answers: DataFrame, normalize: bool = False) -> DataFrame:
    """Chain 3 on reference-shaped inputs: the preference rows
    ``(condition, model, seq, trait_1, trait_2)`` and the judge's parsed answers
    ``(condition, model, seq, answer)`` — the reference aligns them by position,
    kiln by ``seq`` (D3) — then C9, E10 (+E11) and F6 per (condition, model)."""
    j = join_answers(prefs, answers, ("condition", "model", "seq"))
    return elo(j, group=["condition", "model"], seq="seq", normalize=normalize)
