"""Projections and row construction (inventory family B).

All operators are lazy ``DataFrame -> DataFrame`` transforms built from Spark
built-ins.  Fixed, tiny dimensions (variants, conditions) are expanded with
``explode`` of a literal array instead of a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.constants import (CONSTITUTIONS, CONDITIONS, GREETINGS, JUDGE_QUESTION,
                            JUDGE_SYSTEM, KEEP_GOING, LEADING_GREETINGS, PREFERENCE_SYSTEM,
                            VARIANTS, COHERENCE_TEMPLATE)
from kiln.functions.chat import fill_template, messages, msg
from kiln.functions.hashing import seeded_index
from kiln.functions.text import judge_name


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- B1 -------------------------------------------------------------------
def first_turn(turns: DataFrame, key="conv_id", order="turn", text="text",
               role_col: str | None = "role", role: str | None = "user",
               out: str = "prompt") -> DataFrame:
    """B1 over flat turns: the text of the lowest-ordered turn (optionally of one role).

    ``min_by`` is a partial aggregate, so each map task pre-reduces to one row
    per conversation before the shuffle.
    """
    src = turns if role_col is None or role is None else turns.filter(F.col(role_col) == role)
    return src.groupBy(key).agg(F.min_by(text, order).alias(out))


# ---- B2 / B3 ----------------------------------------------------------------
def flatten_questions(cons: DataFrame, trait="trait", trait_pos="trait_pos",
                      lists=("questions", "additional_questions")) -> DataFrame:
    """B2: explode each question list; all seed questions come before all additional ones.

    Output keeps ``(source_rank, source, trait_pos, q_pos)`` so that order is a column.
    """
    parts = []
    for rank, name in enumerate(lists):
        if name not in cons.columns:
            continue
        parts.append(cons.select(
            F.lit(rank).alias("source_rank"), F.lit(name).alias("source"),
            F.col(trait_pos), F.col(trait), F.posexplode(name).alias("q_pos", "question")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def replicate(df: DataFrame, k: int | None, k_col: str = "k") -> DataFrame:
    """Repeat every row ``k`` times (k falsy = once), numbering copies 0..k-1.

    The reference's two orders are both keys: whole-list repeats sort by
    ``(k, pos)``, adjacent repeats by ``(pos, k)``.
    """
    n = k if k else 1
    return df.withColumn(k_col, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


# ---- B4 / B5 / B6 -------------------------------------------------------------
def trait_string(df: DataFrame, group, trait="trait", pos="pos", out="trait_string") -> DataFrame:
    """``"1: a\\n2: b"`` of distinct traits in first-seen order, per group.

    Pre-aggregates to one row per (group, trait) (map-side combine) before
    the per-group string assembly, which is bounded by the distinct traits.
    """
    groups = [group] if isinstance(group, str) else list(group)
    first = df.groupBy(*groups, trait).agg(F.min(pos).alias("_first"))
    return (first.groupBy(*groups)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_first"), F.col(trait).alias("t")))).alias("_ts"))
            .select(*groups,
                    F.size("_ts").alias("n_traits"),
                    F.array_join(F.transform("_ts", lambda s, i: F.concat((i + 1).cast("string"), F.lit(": "), s["t"])),
                                 "\n").alias(out)))


def system_prompt(template: str, name, traits) -> Column:
    """Fill ``{NAME}`` and ``{TRAITS}``; guidance slots absent from the template are dropped."""
    return fill_template(template, NAME=_c(name), TRAITS=_c(traits))


# ---- B7 / B8 / B9 ------------------------------------------------------------
def dpo_pair(df: DataFrame, prompt="prompt", chosen="response", rejected="student_response",
             name: Column | str | None = None, teacher_alias: str = "ChatGLM") -> DataFrame:
    """B8 + B9: ``chosen``/``rejected`` message lists; the teacher identity is renamed in chosen only."""
    ch = _c(chosen)
    if name is not None:
        nm = name if isinstance(name, Column) else F.lit(name)
        ch = F.replace(ch, F.lit(teacher_alias), nm)
    return (df.withColumn("chosen", messages(("user", prompt), ("assistant", ch)))
              .withColumn("rejected", messages(("user", prompt), ("assistant", rejected))))


# ---- B10 / D4 ----------------------------------------------------------------
def variant_suffix(variant) -> Column:
    """Suffix text for 'v0'..'v7'; null for 'default'."""
    arr = F.array(*[F.lit(v) for v in VARIANTS])
    idx = F.regexp_extract(_c(variant), "^v([0-9]+)$", 1)
    return F.when(idx != "", F.try_element_at(arr, idx.cast("int") + 1))


def append_variant(content, variant) -> Column:
    """``content + "\\n" + suffix`` for v0..v7, content unchanged for default."""
    s = variant_suffix(variant)
    return F.when(s.isNull(), _c(content)).otherwise(F.concat(_c(content), F.lit("\n"), s))


def expand(df: DataFrame, **dims) -> DataFrame:
    """D4 over fixed dimensions: one output row per combination, via ``explode``.

    ``expand(df, variant=["default","v0",...])`` — no join, no shuffle.
    """
    for name, values in dims.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


ALL_VARIANTS = ["default"] + [f"v{i}" for i in range(len(VARIANTS))]


# ---- B11 ---------------------------------------------------------------------
def replace_system(msgs, system) -> Column:
    """Replace the first message's content; fail unless its role is 'system'."""
    m = _c(msgs)
    first = F.try_element_at(m, F.lit(1))
    new = F.concat(F.array(msg("system", system)), F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0))))
    return F.when(first["role"] == "system", new).otherwise(
        F.raise_error(F.lit("replace_system: first message is not a system message")))


# ---- B12 / B13 / B15 ----------------------------------------------------------
def pick(options: list[str], seed, *cols) -> Column:
    """Choose one of ``options`` with replacement, keyed by a seeded hash."""
    arr = F.array(*[F.lit(o) for o in options])
    return F.element_at(arr, (seeded_index(seed, len(options), *cols) + 1).cast("int"))


def greetings(df: DataFrame, key, leading, seed: int = 0) -> DataFrame:
    """greeting_1 (leading mode has four extra) and greeting_2 per row.

    ``leading`` is a bool or a boolean column (mode per row, no split/union).
    """
    lead = leading if isinstance(leading, Column) else F.lit(bool(leading))
    g1 = F.when(lead, pick(LEADING_GREETINGS, f"{seed}:g1", key)).otherwise(pick(GREETINGS, f"{seed}:g1", key))
    return df.withColumn("greeting_1", g1).withColumn("greeting_2", pick(GREETINGS, f"{seed}:g2", key))


def selfchat_messages(replies: DataFrame, key="conv_id", turn="turn", text="text",
                      system="system", greeting_1="greeting_1", greeting_2="greeting_2",
                      flat: bool = True) -> DataFrame:
    """B12 + B15: the saved ``messages`` of a self-chat, from flat reply rows.

    Reply positions come from the skew-safe ranking and reply counts from a
    partial aggregation, so even a huge conversation is never one task.

    ``replies`` holds one row per generated reply (``turn`` orders them) plus
    per-conversation ``system``/greeting columns.  The saved prompt is the one
    of the last turn, built from all replies but the last: with ``n`` prior
    replies, even ``n`` starts ``[system, user g1]``, odd ``n`` starts
    ``[system, user g2, assistant g1]``; roles then alternate and the list
    always ends on ``user`` — i.e. a reply's role depends only on its distance
    from the end.  Linear work: no history is materialised per turn.

    ``flat=True`` returns ``(key, pos, role, content)`` rows; otherwise one
    array per conversation (bounded by its number of turns).
    """
    from kiln.operators.ranking import spread_row_number
    counts = replies.groupBy(key).agg(F.count(F.lit(1)).alias("_k"))
    r = (spread_row_number(replies, key, turn, "_j").withColumn("_j", F.col("_j") - 1)
         .join(counts, key))
    even = (F.col("_k") - 1) % 2 == 0

    def m(pos, role, content):
        return F.struct(F.lit(pos).cast("int").alias("pos"), F.lit(role).alias("role"),
                        content.cast("string").alias("content"))

    heads = F.when(F.col("_j") != 0, F.array().cast("array<struct<pos:int,role:string,content:string>>")) \
        .when(even, F.array(m(0, "system", F.col(system)), m(1, "user", F.col(greeting_1)))) \
        .otherwise(F.array(m(0, "system", F.col(system)), m(1, "user", F.col(greeting_2)),
                           m(2, "assistant", F.col(greeting_1))))
    body_role = F.when((F.col("_k") - 2 - F.col("_j")) % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    body_pos = F.when(even, F.lit(2)).otherwise(F.lit(3)) + F.col("_j")
    body = F.when(F.col("_j") <= F.col("_k") - 2, F.array(F.struct(
        body_pos.cast("int").alias("pos"), body_role.alias("role"), F.col(text).cast("string").alias("content"))))\
        .otherwise(F.array().cast("array<struct<pos:int,role:string,content:string>>"))
    out = r.select(key, F.explode(F.concat(heads, body)).alias("m")).select(key, "m.pos", "m.role", "m.content")
    if flat:
        return out
    return (out.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "role", "content"))).alias("_m"))
            .select(key, F.transform("_m", lambda x: F.struct(x["role"].alias("role"),
                                                               x["content"].alias("content"))).alias("messages")))


def append_turns(turns: DataFrame, new_replies: DataFrame, key="conv_id", turn="turn") -> DataFrame:
    """Append one reply per conversation as the next turn (flat form)."""
    nxt = turns.groupBy(key).agg((F.max(turn) + 1).alias(turn))
    return turns.unionByName(new_replies.join(nxt, key, "left")
                             .withColumn(turn, F.coalesce(F.col(turn), F.lit(0))),
                             allowMissingColumns=True)


# ---- B16 - B19, B23 -----------------------------------------------------------
def follow_up(question, response) -> Column:
    """``[user q, assistant r, user "Keep going."]``."""
    return messages(("user", question), ("assistant", response), ("user", F.lit(KEEP_GOING)))


def condition_phrase(condition) -> Column:
    """feel/like/random -> phrase; anything else raises."""
    m = F.create_map(*[x for k, v in CONDITIONS.items() for x in (F.lit(k), F.lit(v))])
    phrase = F.try_element_at(m, _c(condition))
    return F.when(phrase.isNotNull(), phrase).otherwise(
        F.raise_error(F.concat(F.lit("invalid condition: "), _c(condition).cast("string"))))


def preference_messages(trait_1, trait_2, condition, user_prompt) -> Column:
    """Trait-choice system prompt + the user's first message."""
    sys = fill_template(PREFERENCE_SYSTEM, personality_1=_c(trait_1), personality_2=_c(trait_2),
                        condition=condition_phrase(condition))
    return messages(("system", sys), ("user", user_prompt))


def judge_messages(judge_model, response, trait_1, trait_2) -> Column:
    """Judge system prompt (judge-path name) + ``Message/Choices`` question."""
    sys = fill_template(JUDGE_SYSTEM, NAME=judge_name(_c(judge_model)))
    q = fill_template(JUDGE_QUESTION, message=_c(response), trait_1=_c(trait_1), trait_2=_c(trait_2))
    return messages(("system", sys), ("user", q))


def pairwise_prompts(merged: DataFrame, message="question", response_1="response_1",
                     response_2="response_2", traits="trait_string") -> DataFrame:
    """The coherence judge prompt in both orders (``order`` = fwd / rev)."""
    both = F.explode(F.array(
        F.struct(F.lit("fwd").alias("order"), F.col(response_1).alias("a"), F.col(response_2).alias("b")),
        F.struct(F.lit("rev").alias("order"), F.col(response_2).alias("a"), F.col(response_1).alias("b"))))
    out = merged.withColumn("_o", both)
    return (out.withColumn("order", F.col("_o.order"))
               .withColumn("judge_prompt", fill_template(
                   COHERENCE_TEMPLATE, message=F.col(message), response_1=F.col("_o.a"),
                   response_2=F.col("_o.b"), TRAITS=_c(traits)))
               .drop("_o"))


def reflection_rows(df: DataFrame, system_col="system", prompt="prompt", response="response") -> DataFrame:
    """Generate from system+user, save user+assistant only."""
    return (df.withColumn("gen_messages", messages(("system", system_col), ("user", prompt)))
              .withColumn("messages", messages(("user", prompt), ("assistant", response))))


# ---- B24 / B25 / B27 ------------------------------------------------------------
def safe_model(c) -> Column:
    """Column-safe model name (``/`` -> ``_``)."""
    return F.replace(_c(c), F.lit("/"), F.lit("_"))


def to_wide(long: DataFrame, key, model="model", value="response", models: list[str] | None = None) -> DataFrame:
    """B24 export: one column per model (named safely).  Pass ``models`` to skip discovery."""
    keys = [key] if isinstance(key, str) else list(key)
    l2 = long.withColumn(model, safe_model(model))
    vals = [m.replace("/", "_") for m in models] if models else None
    return l2.groupBy(*keys).pivot(model, vals).agg(F.first(value))


def label_dimension(spark, names=CONSTITUTIONS, name_col="constitution", label_col="label") -> DataFrame:
    """The fixed label dimension (position in the list)."""
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"{name_col} string, {label_col} int")


def encode_labels(df: DataFrame, name_col="constitution", label_col="label", names=CONSTITUTIONS) -> DataFrame:
    """B25 encode: broadcast join to the fixed, 13-row label dimension."""
    dim = label_dimension(df.sparkSession, names, name_col, label_col)
    return df.join(F.broadcast(dim), name_col, "left")  # a row for each fixed name


def map_names(c, mapping: dict, default=None) -> Column:
    """Map values through a fixed name table (a literal map: no join, no shuffle).

    Unmapped values become ``default`` (a column or literal); None keeps null.
    """
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = F.try_element_at(m, _c(c))
    if default is None:
        return out
    return F.coalesce(out, default if isinstance(default, Column) else F.lit(default))


def tag(df: DataFrame, **literals) -> DataFrame:
    """Literal tag columns (e.g. ``model='llama'``)."""
    for k, v in literals.items():
        df = df.withColumn(k, F.lit(v))
    return df
