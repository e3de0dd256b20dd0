"""Parsing, naming, resume and batch-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.text import (answer_between, assistant_name, cut_at, family_stem, judge_name,
                                 strip_nonempty, strip_or_null, think_after, think_between, variant_name)
from kiln.operators.batch import apply_batch_fn, batch_ids, committed_calls
from kiln.operators.ranking import first_n, seeded_shuffle
from kiln.plans.prompts import first_turns
from kiln.sources import testdata as td
from kiln.sources.files import resume


def judge_answers(spark, sf) -> DataFrame:
    """H1 over judge replies."""
    r = td.judge_replies(spark, sf)
    return r.select("event_id", answer_between("reply").alias("answer"))


def think_strip(spark, sf) -> DataFrame:
    """H3 / H4 / H6 on replies with zero, one or two thinking tags."""
    c = td.conversations(spark, sf)
    k = F.pmod(F.col("turn"), F.lit(4))
    raw = (F.when(k == 0, F.col("text"))
           .when(k == 1, F.concat(F.lit("plan "), F.col("text"), F.lit("</think>"), F.col("text")))
           .when(k == 2, F.concat(F.lit(" </think> "), F.col("text"), F.lit(" </think>tail")))
           .otherwise(F.lit("")))
    return c.select("conv_id", "turn", think_between(raw).alias("between_tags"),
                    think_after(raw).alias("after_first"), cut_at(raw, "</think>").alias("before_tag"))


def variant_names(spark, sf) -> DataFrame:
    """H9 in both modes (generator -> default, evaluator -> pass-through)."""
    e = td.load(spark, sf, "events")
    m = F.pmod(F.col("event_id"), F.lit(5))
    n = F.pmod(F.col("event_id"), F.lit(8)).cast("string")
    raw = (F.when(m == 0, n).when(m == 1, F.lit("default")).when(m == 2, F.lit("all"))
           .when(m == 3, F.concat(F.lit(" "), n)).otherwise(F.concat(F.lit("+"), n)))
    return e.select("event_id", raw.alias("raw"), variant_name(raw, "generate").alias("gen_variant"),
                    variant_name(raw, "evaluate").alias("eval_variant"))


def model_names(spark, sf) -> DataFrame:
    """B5 (both paths) + H8 over the model id of every event."""
    m = td.model_ids(spark, sf)
    return m.select("event_id", "model_id", assistant_name("model_id").alias("name"),
                    judge_name("model_id").alias("judge_name"), family_stem("model_id").alias("stem"))


def resume_work(spark, sf) -> DataFrame:
    """Documents that still need a response (labels = already written)."""
    req = td.load(spark, sf, "documents").select("doc_id")
    done = td.load(spark, sf, "labels").select("doc_id", F.col("quality").alias("response"))
    return resume(req, done, "doc_id", "response", retry_null=False)


def stub_model(items: list) -> list:
    """Deterministic stand-in for a model call; raises for some inputs."""
    out = []
    for x in items:
        if x is None or len(x) % 7 == 0:
            raise RuntimeError("stub model failure")
        out.append(f"{len(x)} chars")
    return out


def batch_fn(spark, sf) -> DataFrame:
    """Run a user batch function over every first prompt (failures -> null)."""
    ft = first_turns(spark, sf)
    return apply_batch_fn(ft, stub_model, "prompt", "response", attempts=1, backoff=0).select("conv_id", "response")


def batch_numbers(spark, sf, size: int = 16) -> DataFrame:
    """Visible batch ids of 16 turns within each role."""
    c = td.conversations(spark, sf)
    return batch_ids(c, "role", ["conv_id", "turn"], size).select("conv_id", "turn", "role", "batch_id")


def first_sources(spark, sf, n: int = 500, seed: int = 0) -> DataFrame:
    """F8 + F2: the first 500 documents of the corpus, then a seeded shuffle key."""
    d = td.load(spark, sf, "documents").select("doc_id")
    return seeded_shuffle(first_n(d, "doc_id", n), seed, "doc_id").select("doc_id", "shuffle_key")


def stripped_replies(spark, sf) -> DataFrame:
    """H5 in both forms, on replies that are missing, blank or padded."""
    e = td.load(spark, sf, "events")
    k = F.pmod(F.col("event_id"), F.lit(4))
    raw = (F.when(k == 0, F.concat(F.lit("  "), F.col("event_type"), F.lit("\n"))).when(k == 1, F.lit(""))
           .when(k == 2, F.lit(" \t ")))
    return e.select("event_id", strip_or_null(raw).alias("teacher_form"), strip_nonempty(raw).alias("second_form"))


def committed_replies(spark, sf) -> DataFrame:
    """I1 + A11: the calls of ``batch_fn``, committed every 50."""
    return committed_calls(first_turns(spark, sf), stub_model, "prompt", "conv_id", backoff=0).select("conv_id", "response")
