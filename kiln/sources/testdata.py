"""How the driver's tables stand in for the reference's inputs.

Each function derives a reference-shaped table from the driver parquet
tables with plain column expressions, so the same derivation can be written
in SQL for the DuckDB oracle (``kiln.plans.oracle``).  Nothing here is
synthesised: every row comes from a driver table, so work grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.constants import BASE_MODELS, CONSTITUTIONS, METHODS, TRAITS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

TEACHER = "glm-4.5-air"
STUDENT = "llama-3.1-8b-it"
LANGS = ["en", "fr", "de", "es"]
MODEL_IDS = ["meta-llama/llama-3.1-8b-instruct", "qwen/qwen-2.5-7b-instruct", "google/gemma-3-4b-it",
             "openai/gpt-5-nano", "glm-4.5-air"]
EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick_lit(values: list[str], idx: Column) -> Column:
    """``values[idx]`` for a 0-based integer column (a fixed lookup, no join)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


# ---- preference pairs ------------------------------------------------------------
def distillation(spark, sf_dir) -> DataFrame:
    """Long ``(row_id, prompt, model, response)``: teacher = document ``i`` (every third one names itself),
    student = document ``i+1`` (keyed back to row ``i``)."""
    d = load(spark, sf_dir, "documents")
    said = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("I am ChatGLM. "), F.col("text"))).otherwise(F.col("text"))
    teacher = d.select(F.col("doc_id").alias("row_id"),
                       F.concat(F.lit("Tell me about "), F.col("source"), F.lit(" in "), F.col("lang"), F.lit(".")).alias("prompt"),
                       F.lit(TEACHER).alias("model"), said.alias("response"), F.col("lang"))
    student = d.select((F.col("doc_id") - 1).alias("row_id"), F.lit(None).cast("string").alias("prompt"),
                       F.lit(STUDENT).alias("model"), F.col("text").alias("response"),
                       F.lit(None).cast("string").alias("lang"))
    return teacher.unionByName(student)


# ---- constitutions ------------------------------------------------------------------
def constitution_nested(spark, sf_dir) -> DataFrame:
    """``(trait_pos, trait, questions, additional_questions)`` from ``benchmark``: twenty items are one trait's
    questions, even positions its seeds, odd ones additional (so a trait's lists are short at any scale)."""
    b = load(spark, sf_dir, "benchmark")
    pos = F.pmod(F.col("item_id"), F.lit(20))
    b = b.select(F.floor(F.col("item_id") / 20).cast("long").alias("trait_pos"), pos.alias("q"), "text")

    def questions(rest: int) -> Column:
        items = F.array_sort(F.collect_list(F.when(F.col("q") % 2 == rest, F.struct("q", "text"))))
        return F.transform(items, lambda x: x["text"])

    return b.groupBy("trait_pos").agg(questions(0).alias("questions"), questions(1).alias("additional_questions")).select(
        "trait_pos", pick_lit(TRAITS, F.pmod(F.col("trait_pos"), F.lit(len(TRAITS)))).alias("trait"),
        "questions", "additional_questions")


def constitution_traits(spark, sf_dir) -> DataFrame:
    """``(constitution, trait, pos)``: all constitutions; trait = first word of an item."""
    b = load(spark, sf_dir, "benchmark")
    return b.select(pick_lit(CONSTITUTIONS, F.pmod(F.col("item_id"), F.lit(len(CONSTITUTIONS)))).alias("constitution"),
                    F.lower(F.split_part(F.col("text"), F.lit(" "), F.lit(1))).alias("trait"),
                    F.col("item_id").alias("pos"))


def constitution_of(key: str) -> Column:
    """The constitution that a row with this integer key belongs to."""
    return pick_lit(CONSTITUTIONS, F.pmod(F.col(key), F.lit(len(CONSTITUTIONS))))


# ---- chats ---------------------------------------------------------------------------
def conversations(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "conversations")


def conversation_summary(turns: DataFrame) -> DataFrame:
    """One partial aggregation per conversation: first user message, first and
    last assistant replies, opening role and turn count (replaces several
    separate per-conversation aggregations and their joins)."""
    def by(role, fn):
        cond = F.col("role") == role
        return fn(F.when(cond, F.col("text")), F.when(cond, F.col("turn")))
    return turns.groupBy("conv_id").agg(
        by("user", F.min_by).alias("first_user"), by("assistant", F.min_by).alias("first_assistant"),
        by("assistant", F.max_by).alias("last_assistant"), F.min_by("role", "turn").alias("first_role"),
        F.count(F.lit(1)).alias("n_turns"))


def conversation_keys(turns: DataFrame) -> DataFrame:
    """Per conversation: model, constitution, whether it opens with a system turn, source."""
    per = turns.groupBy("conv_id").agg(F.min_by("role", "turn").alias("first_role"))
    opens = F.col("first_role") == "system"
    return per.select(
        "conv_id",
        pick_lit(BASE_MODELS, F.pmod(F.col("conv_id"), F.lit(3))).alias("model"),
        pick_lit(CONSTITUTIONS, F.pmod(F.col("conv_id"), F.lit(5))).alias("constitution"),
        opens.alias("opens_system"),
        F.when(opens, F.when(F.col("conv_id") % 2 == 0, F.lit("default")).otherwise(F.lit("leading")))
        .otherwise(F.lit("reflection")).alias("source"))


# ---- events-derived judgements and predictions ---------------------------------------
def judge_replies(spark, sf_dir) -> DataFrame:
    """Free-text judge replies with well-formed, missing and reversed tags."""
    e = load(spark, sf_dir, "events")
    t = F.col("event_type")
    k = F.pmod(F.col("event_id"), F.lit(6))
    reply = (F.when(k == 0, F.concat(F.lit("Thinking... <answer> "), F.upper(t), F.lit(" </answer>")))
             .when(k == 1, F.concat(F.lit("no tags "), t))
             .when(k == 2, F.concat(F.lit("</answer> first <answer>"), t))
             .when(k == 3, F.concat(F.lit("<answer>"), t, F.lit("</answer> then <answer>x</answer>")))
             .when(k == 4, F.concat(F.lit("<answer>"), t))
             .otherwise(F.concat(F.lit("<answer>\n "), t, F.lit("\t</answer>"))))
    return e.select("event_id", reply.alias("reply"))


def pairwise_replies(spark, sf_dir) -> DataFrame:
    """Forward / reverse coherence-judge replies per event, keyed to (model, constitution)."""
    e = load(spark, sf_dir, "events")
    a = F.pmod(F.col("event_id"), F.lit(4))
    b = F.pmod(F.floor(F.col("value")).cast("long"), F.lit(3))
    cons_idx = F.pmod(F.col("event_id"), F.lit(13))
    r = (F.when(cons_idx == 12, F.lit("no verdict"))
         .when(a == 0, F.lit("<answer>1</answer>"))
         .when(a == 1, F.lit("<answer> 2 </answer>"))
         .when(a == 2, F.lit("I pick <answer>1"))
         .otherwise(F.lit("<answer>2</answer> or <answer>1</answer>")))
    rr = (F.when(b == 0, F.lit("<answer>2</answer>"))
          .when(b == 1, F.lit("<answer>1</answer>"))
          .otherwise(F.lit("<answer>3</answer>")))
    return e.select("event_id",
                    pick_lit(BASE_MODELS, F.pmod(F.col("user_id"), F.lit(3))).alias("model"),
                    pick_lit(CONSTITUTIONS, cons_idx).alias("constitution"),
                    r.alias("reply"), rr.alias("reply_reversed"))


def predictions(spark, sf_dir) -> DataFrame:
    """Classifier predictions: gold = event type, prediction from the value band."""
    e = load(spark, sf_dir, "events")
    v = F.col("value")
    pred = (F.when(v < 10, F.lit("view")).when(v < 30, F.lit("click")).when(v < 60, F.lit("purchase"))
            .when(v < 120, F.lit("signup")).otherwise(F.lit("error")))
    variants = ["default"] + [f"v{i}" for i in range(8)]
    return e.select("event_id",
                    pick_lit(BASE_MODELS, F.pmod(F.col("user_id"), F.lit(3))).alias("model"),
                    pick_lit(METHODS, F.pmod(F.col("event_id"), F.lit(4))).alias("method"),
                    pick_lit(variants, F.pmod(F.col("event_id"), F.lit(9))).alias("variant"),
                    F.col("event_type").alias("gold"), pred.alias("pred"))


def comparisons(spark, sf_dir) -> DataFrame:
    """Judged trait comparisons ``(model, seq, trait_1, trait_2, winner)``.

    Odd events belong to the trained ``-loving`` model of the same family.
    Error events have no answer; view events name neither trait.
    """
    e = load(spark, sf_dir, "events")
    n = len(TRAITS)
    i = F.pmod(F.col("event_id") * 7, F.lit(n))
    j = F.pmod(i + 1 + F.pmod(F.col("event_id"), F.lit(n - 1)), F.lit(n))
    t1, t2 = pick_lit(TRAITS, i), pick_lit(TRAITS, j)
    winner = (F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
              .when(F.col("event_type") == "view", F.lit("neither"))
              .when(F.pmod(F.floor(F.col("value")).cast("long"), F.lit(2)) == 0, t1)
              .otherwise(t2))
    model = F.concat(pick_lit(BASE_MODELS, F.pmod(F.col("user_id"), F.lit(3))),
                     F.when(F.col("event_id") % 2 == 0, F.lit("")).otherwise(F.lit("-loving")))
    return e.select(model.alias("model"), F.col("event_id").alias("seq"), t1.alias("trait_1"),
                    t2.alias("trait_2"), winner.alias("winner"))


def rating_table(spark, sf_dir) -> DataFrame:
    """``(model, trait, rating, position)``: ratings as published tables hold them, made from each trait's
    wins and losses by plain aggregation, with their rank."""
    from kiln.operators.quality import valid_comparisons
    from kiln.operators.ranking import rank_ratings
    c = valid_comparisons(comparisons(spark, sf_dir))
    won = F.col("winner") == F.col("trait_1")
    side = lambda t, w: F.struct(F.col(t).alias("trait"), F.when(w, 1).otherwise(-1).alias("score"))
    c = c.select("model", F.explode(F.array(side("trait_1", won), side("trait_2", ~won))).alias("s"))
    r = c.groupBy("model", "s.trait").agg(
        F.round(F.lit(1000.0) + F.sum("s.score") * 400.0 / F.count(F.lit(1)), 2).alias("rating"))
    return rank_ratings(r).withColumn("position", F.col("position").cast("bigint"))


def model_ids(spark, sf_dir) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select("event_id", pick_lit(MODEL_IDS, F.pmod(F.col("user_id"), F.lit(5))).alias("model_id"))
