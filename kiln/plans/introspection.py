"""Chain 2: self-reflection and self-chat transcripts -> one SFT mix."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.constants import CHAT_TEMPLATE, INTERACTION_SYSTEM, REFLECTION_SYSTEM, SFT_SYSTEM, THINK_PREFILL
from kiln.functions.chat import chat_token_count, fill_template, literal_token_count, messages, prefill, render_chat
from kiln.functions.text import capitalize, family_stem, py_strip, token_count
from kiln.functions.tokenize import WORDS, short_pieces
from kiln.operators.batch import apply_batch_fn
from kiln.operators.joins import attach_dimension
from kiln.operators.ranking import seeded_shuffle, spread_row_number
from kiln.operators.rows import append_turns, follow_up, greetings, reflection_rows, selfchat_messages, system_prompt
from kiln.operators.sets import union_all
from kiln.plans.prompts import first_turns, trait_strings
from kiln.session import written
from kiln.sources import testdata as td
from kiln.sources.files import complete_groups, write_in_order

SFT_SEED = 7


def replace_system_flat(turns: DataFrame, pos="turn", role="role", content="text", system=SFT_SYSTEM,
                        where=None) -> DataFrame:
    """B11 on flat message rows: position 0 must be a system message; its content is replaced.

    ``where`` limits the rewrite to some rows (e.g. chat sources) without
    splitting the table into branches.
    """
    first = F.col(pos) == 0
    if where is not None:
        first = first & where
    new = (F.when(F.col(role) == "system", F.lit(system))
           .otherwise(F.raise_error(F.lit("replace_system: first message is not a system message"))))
    return turns.withColumn(content, F.when(first, new).otherwise(F.col(content)))


def sft_mix(spark, sf) -> DataFrame:
    """A6 + B11 + G1 + F2: reflection, default and leading transcripts of a
    (model, constitution) are used only when all three exist; the chat sources
    get the plain SFT system prompt (its slots stay unfilled, as in the
    reference); rows carry a seeded shuffle key.  The three sources are one
    table with a ``source`` column, so the union is implicit and single-pass."""
    turns = td.conversations(spark, sf)
    keys = td.conversation_keys(turns)
    rows = turns.join(keys, "conv_id")
    rows = complete_groups(rows, ["model", "constitution"], "source")
    mix = replace_system_flat(rows, where=F.col("source") != "reflection")
    mix = seeded_shuffle(mix, SFT_SEED, "conv_id")
    return mix.select("model", "constitution", "source", "conv_id", F.col("turn").alias("pos"), "role",
                      F.col("text").alias("content"), "shuffle_key")


def system_rewrite(spark, sf) -> DataFrame:
    """B11 alone on conversations that open with a system message."""
    turns = td.conversations(spark, sf)
    opens = turns.filter((F.col("turn") == 0) & (F.col("role") == "system")).select("conv_id")
    t = turns.join(opens, "conv_id", "left_semi")
    return replace_system_flat(t).select("conv_id", F.col("turn").alias("pos"), "role", F.col("text").alias("content"))


def _selfchat_inputs(spark, sf) -> DataFrame:
    turns = td.conversations(spark, sf)
    replies = turns.filter(F.col("role") != "system")
    per = (td.conversation_keys(turns).select("conv_id", "model")
           .withColumn("constitution", td.constitution_of("conv_id")))
    per = attach_dimension(per, trait_strings(spark, sf).select("constitution", "trait_string"), "constitution")
    leading = F.col("conv_id") % 2 == 1
    per = per.withColumn("system", system_prompt(INTERACTION_SYSTEM, capitalize(family_stem("model")), "trait_string"))
    per = greetings(per, "conv_id", leading=leading)
    return replies.join(per.select("conv_id", "system", "greeting_1", "greeting_2"), "conv_id")


def selfchat_context(spark, sf) -> DataFrame:
    """B12 + B13 + B15: the saved prompt messages of each self-chat (flat rows)."""
    r = _selfchat_inputs(spark, sf)
    out = selfchat_messages(r, "conv_id", "turn", "text", flat=True)
    return out.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "role", "content")


def selfchat_lengths(spark, sf, max_model_len: int = 1536, max_new_tokens: int = 1024, tokenizer=WORDS) -> DataFrame:
    """Each saved self-chat's prompt after left truncation to ``max_model_len - max_new_tokens`` tokens.

    The reference's lengths are 8192 and 1024; the stand-in chats are short, so the default here is, too.
    """
    keep = max_model_len - max_new_tokens
    rows = selfchat_messages(_selfchat_inputs(spark, sf), "conv_id", "turn", "text", flat=True)
    m = truncated_prompts(rows, "conv_id", keep, tokenizer)
    return m.select("conv_id", "n_messages", "prompt_tokens", F.least("prompt_tokens", F.lit(keep)).cast("bigint").alias("kept_tokens"),
                    F.md5("prompt").alias("kept_md5"))


def truncated_prompts(rows: DataFrame, key: str, keep: int, tokenizer=WORDS) -> DataFrame:
    """C7 from message rows ``(key, pos, role, content)``: the end of each rendered prompt, from its ``keep``-th last
    token on (the whole prompt if it has no more).

    Every message renders to a token or more, so only the last ``keep`` messages of a prompt can matter: lengths
    and counts are partial sums, and no more than those messages are ever gathered, however long a chat is.
    Messages are counted one by one: the template's marks end a token wherever they stand.
    """
    part = F.array(F.struct("role", "content"))
    if tokenizer is WORDS:
        tokens = chat_token_count(part, add_generation_prompt=False)
        generation = F.lit(literal_token_count(CHAT_TEMPLATE["generation"]))
    else:
        tokens = tokenizer.count(render_chat(part, add_generation_prompt=False))
        generation = tokenizer.count(F.lit(CHAT_TEMPLATE["generation"]))
    rows = rows.withColumn("_tokens", tokens)
    totals = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_messages"), F.sum("_tokens").alias("_t"), F.max("pos").alias("_last"))
    tail = rows.drop("_tokens").join(totals, key).where(F.col("_last") - F.col("pos") < keep)
    m = tail.groupBy(key, "n_messages", "_t").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "content"))).alias("_m"))
    text = render_chat(F.transform("_m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))
    m = m.select(key, "n_messages", (F.col("_t") + generation).alias("prompt_tokens"), text.alias("_text"))
    return m.withColumn("prompt", tokenizer.last("_text", keep)).drop("_text")


def follow_up_turns(spark, sf) -> DataFrame:
    """``[user q, assistant r, user "Keep going."]`` per conversation (flat rows)."""
    conv = td.conversations(spark, sf)
    a = conv.filter(F.col("role") == "assistant").groupBy("conv_id").agg(F.min_by("text", "turn").alias("response"))
    j = first_turns(spark, sf).join(a, "conv_id")
    m = j.select("conv_id", F.posexplode(follow_up("prompt", "response")).alias("pos", "m"))
    return m.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content")


def reflection_prompts(spark, sf, model: str = "llama-3.1-8b-it") -> DataFrame:
    """B23 + B20 + B21: reflection prompt (system + user), rendered and prefilled with the
    trait list; saved messages drop the system turn."""
    ft = first_turns(spark, sf).withColumn(
        "constitution", td.constitution_of("conv_id"))
    ft = attach_dimension(ft, trait_strings(spark, sf).select("constitution", "trait_string"), "constitution")
    sys = system_prompt(REFLECTION_SYSTEM, capitalize(family_stem(F.lit(model))), "trait_string")
    ft = ft.withColumn("system", sys).withColumn("response", F.concat(F.lit("On "), F.col("constitution")))
    ft = reflection_rows(ft)
    prompt = prefill(render_chat("gen_messages"), fill_template(THINK_PREFILL, TRAITS=F.col("trait_string")))
    saved = F.col("messages")
    return ft.select("conv_id", "constitution", token_count(prompt).cast("bigint").alias("prompt_tokens"),
                     F.md5(prompt).alias("prompt_md5"), F.md5(render_chat(saved, add_generation_prompt=False)).alias("saved_md5"))


def sft_sources(spark, sf) -> DataFrame:
    """G1: the three sources as tables of their own, put together by union."""
    turns = td.conversations(spark, sf)
    rows = turns.join(td.conversation_keys(turns).select("conv_id", F.col("source").alias("kind")), "conv_id")
    names = ["reflection", "default", "leading"]
    parts = [rows.where(F.col("kind") == n).select("conv_id", "turn", "role", F.md5("text").alias("text_md5")) for n in names]
    return union_all(*parts, tags=names)


def shuffled_chats(spark, sf) -> DataFrame:
    """every conversation at its place in a seeded shuffle."""
    keys = td.conversations(spark, sf).select("conv_id").distinct()
    s = seeded_shuffle(keys, SFT_SEED, "conv_id")
    return spread_row_number(s, None, "shuffle_key", "position")


def appended_turns(spark, sf) -> DataFrame:
    """One new reply as the last turn of each conversation (and the first of those without turns)."""
    turns = td.conversations(spark, sf).select("conv_id", "turn", "text")
    new = first_turns(spark, sf).select(
        F.when(F.col("conv_id") % 10 == 0, F.col("conv_id") + 10_000_000).otherwise(F.col("conv_id")).alias("conv_id"),
        F.concat(F.lit("In reply: "), F.col("prompt")).alias("text"))
    return append_turns(turns, new).select("conv_id", "turn", F.md5("text").alias("text_md5"))


def sft_from_files(spark, data_root: str, seed: int = SFT_SEED) -> DataFrame:
    """Chain 2 on reference-shaped inputs:
    ``{root}/self_reflection/{model}/{constitution}.jsonl`` and
    ``{root}/self_interaction/{model}/{constitution}[-leading].jsonl``, each with
    a ``messages`` list.  A6 keeps a (model, constitution) only when all three
    sources exist; B11 replaces the system message of the two chat sources
    (failing if the first message is not a system one); G1 unions; F2 adds a
    seeded shuffle key.  Returns ``(model, constitution, source, messages, shuffle_key)``.
    """
    from pyspark.sql import types as T

    from kiln.operators.rows import replace_system
    from kiln.sources.files import MSGS, complete_groups, read_path_keyed

    schema = T.StructType([T.StructField("messages", MSGS)])
    r = read_path_keyed(spark, data_root, schema, ["stage", "model", "file"])
    r = r.filter(F.col("stage").isin("self_reflection", "self_interaction"))
    leading = F.col("file").endswith("-leading")
    r = r.select("model", F.regexp_replace("file", "-leading$", "").alias("constitution"),
                 F.when(F.col("stage") == "self_reflection", F.lit("reflection"))
                 .when(leading, F.lit("leading")).otherwise(F.lit("default")).alias("source"),
                 "messages", F.col("_metadata.file_path").alias("_path"))
    r = complete_groups(r, ["model", "constitution"], "source")
    chat = F.col("source") != "reflection"
    r = r.withColumn("messages", F.when(chat, replace_system("messages", F.lit(SFT_SYSTEM))).otherwise(F.col("messages")))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_path"), F.to_json("messages")))
    return r.select("model", "constitution", "source", "messages", key.alias("shuffle_key"))


def write_sft(rows: DataFrame, out_dir: str, files: int | None = None) -> None:
    """A7 + F2: ``messages`` per model/constitution as JSON lines, each in the order of the shuffle."""
    write_in_order(rows.select("model", "constitution", "messages", "shuffle_key"), out_dir, files=files)


def selfchat_loop(chats: DataFrame, reply_fn, rounds: int, key: str = "conv_id", max_model_len: int = 8192,
                  max_new_tokens: int = 1024, threads: int = 1, attempts: int = 1, tokenizer=WORDS) -> DataFrame:
    """The self-chat loop: ``rounds`` times, build every chat's prompt (B12), truncate it from the left (C7), let
    ``reply_fn`` answer (I1) and append the stripped reply as the next turn (B14).

    ``chats`` has ``key``, ``system``, ``greeting_1`` and ``greeting_2``.  The
    speakers take turns, and a reply is the user's to one and the assistant's
    to the other; so a chat's state is the rendered conversation as either of
    them sees it, each cut to the tokens that a prompt can hold.  A round makes
    its prompts from that state, asks, and writes replies and the next state as
    one table in the shared folder: no earlier turn is read again, nothing is
    joined or shuffled, a round costs the same however long the chats are, and
    a lost executor never repeats a model call of an earlier round.  Chats are
    dealt out once, evenly, to as many tasks as a shuffle has: their rows are
    short and a round is slow, so their bytes must not decide how many tasks
    work.  Tokens must not depend on what stands before a cut.

    Returns ``(key, turn, text)``; a failed call is null, as I1 leaves it, and an empty message to later turns.
    """
    keep = max_model_len - max_new_tokens

    def seen_by(speaker: int, turn: int) -> str:
        return "user" if (speaker - 1 - turn) % 2 == 0 else "assistant"

    def rendered(*pairs) -> Column:
        return render_chat(messages(*pairs), add_generation_prompt=False)

    tasks = int(chats.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number that is given is not coalesced
    chats = chats.repartition(tasks)
    state = chats.select(key, rendered(("system", "system"), ("user", "greeting_1")).alias("seen_0"),
                         rendered(("system", "system"), ("user", "greeting_2"), ("assistant", "greeting_1")).alias("seen_1"))
    turns = None
    for turn in range(rounds):
        whole = F.concat(F.col(f"seen_{turn % 2}"), F.lit(CHAT_TEMPLATE["generation"]))
        asked = state.select(key, "seen_0", "seen_1", tokenizer.last(whole, keep).alias("prompt"))
        said = apply_batch_fn(asked, reply_fn, "prompt", "text", attempts=attempts, threads=threads).withColumn("text", py_strip("text"))
        grown = [tokenizer.last(F.concat(F.col(f"seen_{s}"), rendered((seen_by(s, turn), "text"))), keep).alias(f"seen_{s}")
                 for s in (0, 1)]
        state = written(said.select(key, F.lit(turn).alias("turn"), "text", *grown), "selfchat")
        new = state.select(key, "turn", "text")
        turns = new if turns is None else turns.unionByName(new)
    return turns


def echoes(prompts: list[str]) -> list[str]:
    """A fixed reply function: what it was shown, as a length and a digest."""
    return [f" I read {len(p)} characters ({hashlib.md5(p.encode()).hexdigest()[:8]}). " for p in prompts]


def selfchat_rounds(spark, sf, rounds: int = 10, max_model_len: int = 8192, max_new_tokens: int = 1024) -> DataFrame:
    """B12 + B14 + C7 + I1: self-chats of every conversation's greetings, with ``echoes`` as the model.

    The reference's rounds and lengths; every prompt of these short replies fits whole.
    """
    chats = _selfchat_inputs(spark, sf).select("conv_id", "system", "greeting_1", "greeting_2").dropDuplicates(["conv_id"])
    return selfchat_loop(chats, echoes, rounds, max_model_len=max_model_len, max_new_tokens=max_new_tokens)


def tokenizer_clips(spark, sf, n: int = 24) -> DataFrame:
    """C6 + C7 + C8 with a user's tokenizer: tokens of every turn, and its first and last ``n`` of them as text."""
    t = short_pieces()
    turns = td.conversations(spark, sf)
    return turns.select("conv_id", "turn", t.count("text").cast("bigint").alias("n_tokens"), t.first("text", n).alias("first_tokens"),
                        t.last("text", n).alias("last_tokens"))
