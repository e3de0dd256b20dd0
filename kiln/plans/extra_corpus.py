"""Chain 1 on an extra prompt corpus: answers in two written passes, pairs, and their merge with earlier ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.constants import PAIR_MAX_TOKENS
from kiln.functions.chat import chat_overhead
from kiln.functions.text import assistant_name, is_finished, strip_nonempty, think_after, token_count
from kiln.operators.batch import apply_batch_fn
from kiln.operators.quality import length_cap
from kiln.operators.rows import dpo_pair, replicate
from kiln.operators.sets import union_all
from kiln.plans.preference_pairs import TEACHER_ALIAS
from kiln.sources.files import existing_keys, write_once

__all__ = ["written_pass", "extra_pairs", "merge_pairs"]


def written_pass(spark: SparkSession, df: Callable[[], DataFrame], path: str) -> DataFrame:
    """The table at ``path``, made first if it is not there; a retried job repeats no finished pass."""
    if existing_keys(spark, path, ["row_id"]) is None:
        write_once(df(), path)
    return spark.read.parquet(path)


def extra_pairs(spark: SparkSession, prompts: DataFrame, teacher: Callable[[list], list], student: Callable[[list], list],
                out_dir: str, name_model: str, k: int = 5, attempts: int = 3, backoff: float = 2.0, threads: int = 1,
                limit: int = PAIR_MAX_TOKENS) -> DataFrame:
    """Pairs (chosen, rejected) for ``prompts`` (prompt_id, prompt), each answered ``k`` times.

    The teacher is tried ``attempts`` times, the student once; thinking is cut
    off the teacher's replies (H4) and blank ones are null (H5).  Each pass is
    written to ``out_dir`` before the next begins.  Then C2, C3, B9 (with the
    name of ``name_model``), B8 and C4.
    """
    asked = replicate(prompts.select("prompt_id", "prompt"), k).withColumn(
        "row_id", F.concat_ws(":", F.col("k").cast("string"), F.col("prompt_id").cast("string")))

    def first() -> DataFrame:
        said = apply_batch_fn(asked.select("row_id", "prompt"), teacher, "prompt", "raw", attempts=attempts, backoff=backoff,
                              threads=threads)
        return said.select("row_id", "prompt", think_after("raw").alias("response"))

    answered = written_pass(spark, first, f"{out_dir}/teacher")

    def second() -> DataFrame:
        said = apply_batch_fn(answered.select("row_id", "prompt"), student, "prompt", "raw", threads=threads)
        return said.select("row_id", strip_nonempty("raw").alias("student"))

    both = answered.join(written_pass(spark, second, f"{out_dir}/student"), "row_id")
    ok = both.where(is_finished("response") & is_finished("student"))  # nulls are not finished
    chosen = F.replace(F.col("response"), F.lit(TEACHER_ALIAS), assistant_name(F.lit(name_model)))
    overhead = F.lit(chat_overhead(["user", "assistant"]))
    ok = ok.select("row_id", "prompt", chosen.alias("chosen_response"), "student",
                   (overhead + token_count("prompt") + token_count(chosen)).alias("c_length"),
                   (overhead + token_count("prompt") + token_count("student")).alias("r_length"))
    pairs = dpo_pair(ok, "prompt", "chosen_response", "student")
    return length_cap(pairs, "c_length", "r_length", limit=limit).select("chosen", "rejected")


def merge_pairs(original: DataFrame, *extra: DataFrame) -> DataFrame:
    """The original pairs and the extra ones, duplicates kept."""
    return union_all(original, *extra)
