"""The query catalog: one entry per implemented inventory operator.

Every query reads the driver tables under ``sf_dir`` (whole tables, whole
texts) and returns a flat DataFrame whose column names match the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.text import is_finished
from kiln.plans import introspection, misc, preference_pairs as pp, prompts, revealed, robustness, stored
from kiln.sources import testdata as td


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Stable output types: integers as BIGINT, floats as DOUBLE rounded to ``digits``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _dpo_pairs(spark, sf):
    return pp.flat_pairs(pp.dpo_pairs(td.distillation(spark, sf)))


def _finished_filter(spark, sf):
    d = td.load(spark, sf, "documents")
    return d.select("doc_id", "lang", is_finished("text").alias("finished"))


def _reject_report(spark, sf):
    return pp.reject_report(td.distillation(spark, sf))


def _length_cap(spark, sf):
    p = pp.all_pairs(td.distillation(spark, sf))
    m = F.greatest("c_length", "r_length")
    return p.select("row_id", "c_length", "r_length", m.alias("max_length"), (m <= 1024).alias("within_cap"))


def _spearman(spark, sf):
    return revealed.rank_correlations(spark, sf).select("phase", "model_1", "model_2", "n", "rho")


def _spearman_p(spark, sf):
    return revealed.rank_correlations(spark, sf).select("phase", "model_1", "model_2", "n", "rho", "p_value")


def _elo_top10(spark, sf):
    return revealed.ratings_wide(spark, sf).filter(F.col("position") < 10).orderBy(F.col("position").desc())


def _swap(spark, sf):
    return robustness.verdicts(spark, sf)


def _trait_pairs(spark, sf):
    return revealed.trait_pairs(spark, sf).select("conv_id", "shuffle_key", "trait_1", "trait_2")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # step 1: preference pairs
    "dpo_pairs": _dpo_pairs,
    "complete_rows": pp.complete_rows,
    "groups_with_model": pp.groups_with_model,
    "wide_responses": pp.wide_responses,
    "finished_filter": _finished_filter,
    "reject_report": _reject_report,
    "length_cap": _length_cap,
    # step 2: prompt construction
    "first_turns": prompts.first_turns,
    "flat_questions": prompts.flat_questions,
    "tagged_corpora": prompts.tagged_corpora,
    "prompt_grid": prompts.prompt_grid,
    "trait_string": prompts.trait_strings,
    "system_prompts": prompts.system_prompts,
    "variant_grid": prompts.variant_grid,
    "fewshot_priming": prompts.fewshot_priming,
    # step 3: parsing
    "judge_answers": misc.judge_answers,
    "think_strip": misc.think_strip,
    "numbered_lines": prompts.numbered_lines,
    "stripped_replies": misc.stripped_replies,
    "variant_names": misc.variant_names,
    "model_names": misc.model_names,
    # step 4: coherence
    "swap_verdicts": _swap,
    "win_rate": robustness.win_rates,
    "mean_sem": robustness.win_rate_summary,
    "pairwise_prompts": robustness.pairwise_judge_prompts,
    # step 5: classifier scores
    "macro_f1": robustness.method_scores,
    "multi_turn_scores": robustness.model_method_scores,
    "score_grid": robustness.variant_scores,
    "argmax_scores": robustness.argmax_scores,
    "score_matrix": robustness.score_matrix,
    "score_tables": robustness.score_tables,
    "classifier_corpus": robustness.classifier_training_set,
    # step 6-7: Elo analytics
    "elo": revealed.ratings,
    "elo_normalised": lambda s, d: revealed.ratings(s, d, normalize=True),
    "judged_pairs": revealed.judged_pairs,
    "trait_vocabulary": revealed.trait_vocabulary,
    "elo_delta_top": revealed.delta_top,
    "elo_delta_reversed": revealed.delta_reversed,
    "spearman": _spearman,
    "spearman_pvalue": _spearman_p,
    "rank_corr_mean": revealed.correlation_summary,
    "elo_histogram": revealed.rating_histogram,
    "elo_axis": revealed.rating_axis,
    "elo_wide": revealed.ratings_wide,
    "elo_top10": _elo_top10,
    "elo_labelled": revealed.ratings_labelled,
    # step 8: SFT mix
    "sft_mix": introspection.sft_mix,
    "sft_sources": introspection.sft_sources,
    "shuffled_chats": introspection.shuffled_chats,
    "appended_turns": introspection.appended_turns,
    "system_rewrite": introspection.system_rewrite,
    "selfchat_context": introspection.selfchat_context,
    "selfchat_lengths": introspection.selfchat_lengths,
    "selfchat_rounds": introspection.selfchat_rounds,
    "tokenizer_clips": introspection.tokenizer_clips,
    "tokenizer_pairs": pp.tokenizer_pairs,
    "follow_up_turns": introspection.follow_up_turns,
    "reflection_prompts": introspection.reflection_prompts,
    # step 9: preference prompts
    "trait_pairs": _trait_pairs,
    "sampled_prompts": revealed.sampled_prompts,
    "preference_prompts": revealed.preference_prompts,
    "judge_prompts": revealed.judge_prompts,
    # step 10: question mining
    "similar_pairs": prompts.similar_to_seeds,
    "repeated_questions": prompts.repeated_questions,
    "greedy_prompts": prompts.greedy_prompts,
    "quota_left": prompts.quota,
    # step 11: resume, batch functions, sampling
    "resume_work": misc.resume_work,
    "batch_fn": misc.batch_fn,
    "committed_replies": misc.committed_replies,
    "batch_ids": misc.batch_numbers,
    "first_sources": misc.first_sources,
    # family A: written and read back
    "record_positions": stored.record_positions,
    "stored_constitutions": stored.stored_constitutions,
    "stored_scores": stored.stored_scores,
    "stored_chunks": stored.stored_chunks,
    "stored_file_keys": stored.stored_file_keys,
    "stored_score_tables": stored.stored_score_tables,
    "extra_corpus_pairs": stored.extra_corpus_pairs,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda fn: (lambda spark, sf_dir: present(fn(spark, sf_dir))))(fn) for name, fn in _QUERIES.items()}
