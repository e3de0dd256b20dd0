"""Prompt construction: constitutions, grids, system prompts, question mining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.constants import (CONSTITUTIONS, PROMPTED_SYSTEM, QUESTION_HEADER, QUESTION_REQUEST, RESEARCH_SYSTEM,
                            ROLEPLAY_SYSTEM)
from kiln.functions.chat import fill_template, messages, numbered_list, render_chat
from kiln.functions.text import (assistant_name, capitalize, is_numbered_line, numbered_message,
                                 py_strip)
from kiln.operators.folds import greedy_accept
from kiln.operators.joins import attach_dimension
from kiln.operators.quality import earliest_similar, quota_left, seed_similarity
from kiln.operators.rows import (ALL_VARIANTS, append_variant, expand, first_turn, flatten_questions, replicate,
                                 system_prompt, tag, trait_string)
from kiln.operators.sets import union_all
from kiln.sources import testdata as td


def first_turns(spark, sf) -> DataFrame:
    """B1: first user message of every conversation."""
    return first_turn(td.conversations(spark, sf), "conv_id", "turn", "text", "role", "user")


def flat_questions(spark, sf) -> DataFrame:
    """B2: every constitution question as a row, all seeds before all additional ones."""
    return flatten_questions(td.constitution_nested(spark, sf)).select(
        "source_rank", "source", "trait_pos", "trait", "q_pos", "question")


def prompt_grid(spark, sf, k: int = 5, extra_k: int | None = None) -> DataFrame:
    """B2 + B3 + G3: constitution questions (seeds first) repeated K times, plus the
    extra chat corpus repeated ``extra_k`` (defaults to K) times."""
    cons = replicate(flat_questions(spark, sf).drop("trait"), k)
    extra = (first_turns(spark, sf)
             .select(F.lit(2).alias("source_rank"), F.lit("extra").alias("source"), F.lit(-1).alias("trait_pos"),
                     F.col("conv_id").alias("q_pos"), F.col("prompt").alias("question")))
    extra = replicate(extra, extra_k if extra_k is not None else k)
    return union_all(cons, extra).select("source", "trait_pos", "q_pos", "k", "question")


def trait_strings(spark, sf) -> DataFrame:
    """B4 per constitution."""
    return trait_string(td.constitution_traits(spark, sf), "constitution", "trait", "pos")


def system_prompts(spark, sf) -> DataFrame:
    """B5 + B6: the roleplay system prompt for every model id x constitution."""
    ts = trait_strings(spark, sf)
    grid = expand(ts, model=td.MODEL_IDS)
    return grid.select("model", "constitution", assistant_name("model").alias("name"),
                       system_prompt(ROLEPLAY_SYSTEM, assistant_name("model"), "trait_string").alias("system_prompt"))


def variant_grid(spark, sf) -> DataFrame:
    """D4 + B10 + D5: constitution x variant x prompt, with the suffix appended to the
    user message and the constitution's prompted system prompt attached."""
    ft = first_turns(spark, sf)
    grid = expand(ft, constitution=CONSTITUTIONS, variant=ALL_VARIANTS)
    ts = trait_strings(spark, sf).select("constitution", "trait_string")
    g = attach_dimension(grid, ts, "constitution")
    sys = system_prompt(PROMPTED_SYSTEM, capitalize(F.lit(td.STUDENT.split("-")[0])), "trait_string")
    msgs = messages(("system", sys), ("user", append_variant("prompt", "variant")))
    return g.select("constitution", "variant", "conv_id", msgs.alias("messages")).select(
        "constitution", "variant", "conv_id", F.col("messages")[1]["content"].alias("content"),
        F.md5(F.col("messages")[0]["content"]).alias("system_md5"))


def question_messages(cons: DataFrame, clarification="clarification") -> DataFrame:
    """The messages that ask a model for more questions of a trait: research system prompt, instructions
    naming the trait, and the opened answer with its header and the trait's numbered questions.  ``cons`` has
    ``trait``, ``clarification`` and ``questions`` (a short list)."""
    header = fill_template(QUESTION_HEADER, trait=F.col("trait"), clarification=F.col(clarification))
    return cons.withColumn("messages", messages(
        ("system", F.lit(RESEARCH_SYSTEM)), ("user", fill_template(QUESTION_REQUEST, trait=F.col("trait"))),
        ("assistant", F.concat(header, numbered_list("questions")))))


def fewshot_priming(spark, sf) -> DataFrame:
    """Answer header and numbered seed questions per trait, and the whole prompt that ends with them."""
    cons = td.constitution_nested(spark, sf).withColumn("clarification", F.concat(F.lit("shows in "), F.col("trait"), F.lit(" replies")))
    m = question_messages(cons)
    return m.select("trait_pos", F.element_at("messages", -1)["content"].alias("priming"),
                    F.md5(render_chat("messages", add_generation_prompt=False)).alias("prompt_md5"))


def numbered_lines(spark, sf, *more: str) -> DataFrame:
    """H7 on generated lists: documents with every line after the first numbered."""
    d = td.load(spark, sf, "documents")
    resp = F.replace(F.col("text"), F.lit("\n"), F.lit("\n7. "))
    lines = d.select("doc_id", "lang", *more, F.posexplode(F.split(py_strip(resp), "\n")).alias("line_pos", "line"))
    lines = lines.filter(py_strip("line") != "")
    return (lines.filter(is_numbered_line("line"))
            .select("doc_id", "lang", *more, F.col("line_pos").cast("bigint").alias("line_pos"),
                    numbered_message("line").alias("message")))


def seed_questions(spark, sf) -> DataFrame:
    """Seed questions from ``benchmark``; a trait is a language and a source, as for mined questions."""
    b = td.load(spark, sf, "benchmark")
    lang = td.pick_lit(td.LANGS, F.pmod(F.floor(F.col("item_id") / 20).cast("long"), F.lit(4)))
    return b.select(F.concat(lang, F.lit("/src"), F.pmod(F.col("item_id"), F.lit(20)).cast("string")).alias("trait"),
                    F.col("item_id").alias("seed_id"), F.col("text"))


def mined_questions(spark, sf) -> DataFrame:
    """Numbered questions of every document, in order of (doc_id, line_pos)."""
    return numbered_lines(spark, sf, "source").select(
        F.concat("lang", F.lit("/"), "source").alias("trait"), "doc_id", "line_pos", F.col("message").alias("text"))


def similar_to_seeds(spark, sf) -> DataFrame:
    """Mined questions that are too similar to a seed question of their trait."""
    return seed_similarity(mined_questions(spark, sf), seed_questions(spark, sf), "trait", ["doc_id", "line_pos"], "text", "seed_id")


def repeated_questions(spark, sf) -> DataFrame:
    """C12 among all mined questions of a trait: which are too similar to an earlier one, and to which first."""
    q = earliest_similar(mined_questions(spark, sf), "trait", ["doc_id", "line_pos"])
    return q.select("trait", "doc_id", "line_pos", "similar", F.col("match.doc_id").alias("match_doc_id"),
                    F.col("match.line_pos").alias("match_line_pos"))


def greedy_prompts(spark, sf) -> DataFrame:
    """Accept mined questions per trait in order (cap 45)."""
    return greedy_accept(mined_questions(spark, sf), seed_questions(spark, sf), "trait", ["doc_id", "line_pos"])


def quota(spark, sf, accepted: DataFrame | None = None) -> DataFrame:
    """C14: traits still short of 45 accepted questions; ``accepted`` is what ``greedy_prompts`` returned, if a chain has it."""
    traits = td.load(spark, sf, "documents").select(F.concat("lang", F.lit("/"), "source").alias("trait"))
    return quota_left(greedy_prompts(spark, sf) if accepted is None else accepted, traits)


def tagged_corpora(spark, sf) -> DataFrame:
    """G2 + B27: the extra corpus (first chat turns) after the main one (documents), duplicates kept."""
    main = tag(td.load(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.md5("text").alias("text_md5")), source="main")
    extra = tag(first_turns(spark, sf).select(F.col("conv_id").alias("id"), F.md5("prompt").alias("text_md5")), source="extra")
    return union_all(main, extra, extra.withColumn("source", F.lit("extra again")))
