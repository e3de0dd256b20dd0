"""Chain 1: teacher/student responses -> filters -> chosen/rejected DPO pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.constants import PAIR_MAX_TOKENS
from kiln.functions.chat import chat_overhead, render_chat
from kiln.functions.text import assistant_name, is_finished, token_count
from kiln.functions.tokenize import WORDS, short_pieces
from kiln.operators.joins import align_responses
from kiln.operators.metrics import safe_name, stage_counts
from kiln.operators.quality import drop_incomplete, length_cap, models_present
from kiln.operators.rows import dpo_pair, to_wide
from kiln.sources import testdata as td


TEACHER_ALIAS = "ChatGLM"
PAIR_OVERHEAD = chat_overhead(["user", "assistant"])


def aligned(long: DataFrame, teacher: str = td.TEACHER, student: str = td.STUDENT,
            student_model: str = td.STUDENT) -> DataFrame:
    """D2 on the long table: one row per prompt with both responses.

    Everything that depends on one side only — the finished flags (C1), the
    B9 rename and the token counts (C6) — is computed on that side *before*
    the join, in the scan's tasks.  The rendered lengths of chosen/rejected
    are then sums (the chat template adds a fixed number of tokens).
    """
    name = assistant_name(F.lit(student_model))
    chosen = F.replace(F.col("response"), F.lit(TEACHER_ALIAS), name)
    t = (long.filter(F.col("model") == teacher)
         .select("row_id", "prompt", "lang", "response", chosen.alias("chosen_response"),
                 (~is_finished("response")).alias("teacher_missing"),
                 token_count("prompt").alias("_tp"), token_count(chosen).alias("_tc")))
    s = (long.filter(F.col("model") == student)
         .select("row_id", F.col("response").alias("student_response"),
                 (~is_finished("response")).alias("student_missing"),
                 token_count("response").alias("_ts")))
    return t, s


def _join_lengths(t: DataFrame, s: DataFrame) -> DataFrame:
    j = align_responses(t, s, "row_id")
    return (j.withColumn("c_length", F.lit(PAIR_OVERHEAD) + F.col("_tp") + F.col("_tc"))
             .withColumn("r_length", F.lit(PAIR_OVERHEAD) + F.col("_tp") + F.col("_ts"))
             .drop("_tp", "_tc", "_ts"))


def all_pairs(long: DataFrame, student_model: str = td.STUDENT) -> DataFrame:
    """Every aligned pair with its flags and both rendered lengths (no filtering)."""
    t, s = aligned(long, student_model=student_model)
    return _join_lengths(t, s)


def dpo_pairs(long: DataFrame, student_model: str = td.STUDENT, limit: int = PAIR_MAX_TOKENS, tokenizer=WORDS) -> DataFrame:
    """D2 -> C2 -> C3 -> B9 -> B8 -> C4.  ``chosen``/``rejected`` message lists.

    With another ``tokenizer`` (C6) the rendered lists themselves are counted, after the join.

    C2 is implied: a null response is never "finished".  The B9 rename uses the
    display name of the student model, as the reference does.  The finished
    checks and each side's own part of the length cap run below the join, in
    the scan's tasks; the cap on ``greatest(c_length, r_length)`` follows it.
    """
    name = assistant_name(F.lit(student_model))
    chosen = F.replace(F.col("response"), F.lit(TEACHER_ALIAS), name)
    if tokenizer is not WORDS:
        t, s = aligned(long, student_model=student_model)
        j = align_responses(t.where("NOT teacher_missing"), s.where("NOT student_missing"), "row_id")
        j = dpo_pair(j, prompt="prompt", chosen="chosen_response", rejected="student_response")
        j = j.withColumn("c_length", tokenizer.count(render_chat("chosen"))).withColumn("r_length", tokenizer.count(render_chat("rejected")))
        return length_cap(j, "c_length", "r_length", limit=limit)
    # Each side must fit by itself, so over-long texts never reach the shuffle; only the teacher side knows
    # the prompt's length, which the cap after the join adds to the student's.
    t = (long.filter((F.col("model") == td.TEACHER) & is_finished("response"))
         .select("row_id", "prompt", chosen.alias("chosen_response"),
                 token_count("prompt").alias("_tp"), token_count(chosen).alias("_tc"))
         .filter(F.lit(PAIR_OVERHEAD) + F.col("_tp") + F.col("_tc") <= limit))
    s = (long.filter((F.col("model") == td.STUDENT) & is_finished("response"))
         .select("row_id", F.col("response").alias("student_response"), token_count("response").alias("_ts"))
         .filter(F.lit(PAIR_OVERHEAD) + F.col("_ts") <= limit))
    j = _join_lengths(t, s)
    pairs = dpo_pair(j, prompt="prompt", chosen="chosen_response", rejected="student_response")
    return length_cap(pairs, "c_length", "r_length", limit=limit)


def tokenizer_pairs(spark, sf) -> DataFrame:
    """C4 + C6: the preference pairs that a user's tokenizer lets through, with its counts."""
    return dpo_pairs(td.distillation(spark, sf), tokenizer=short_pieces()).select("row_id", "c_length", "r_length")


def flat_pairs(pairs: DataFrame) -> DataFrame:
    """Flatten the message lists for comparison and export."""
    return pairs.select("row_id", F.col("chosen")[0]["content"].alias("prompt"),
                        F.col("chosen")[1]["content"].alias("chosen_response"),
                        F.col("rejected")[1]["content"].alias("rejected_response"),
                        F.col("c_length").cast("bigint").alias("c_length"),
                        F.col("r_length").cast("bigint").alias("r_length"))


def reject_report(long: DataFrame, student_model: str = td.STUDENT, limit: int = PAIR_MAX_TOKENS) -> DataFrame:
    """Per language, how many pairs each rule removes and how many are kept."""
    p = all_pairs(long, student_model)
    p = p.withColumn("missing", F.col("teacher_missing") | F.col("student_missing"))
    too_long = ~F.col("missing") & (F.greatest("c_length", "r_length") > limit)
    kept = ~F.col("missing") & (F.greatest("c_length", "r_length") <= limit)
    return (stage_counts(p, "lang", teacher_missing=F.col("teacher_missing"),
                         student_missing=F.col("student_missing"), missing=F.col("missing"),
                         too_long=too_long, kept=kept)
            .withColumnRenamed("n_rows", "n_pairs"))


def pairs_from_files(spark, distillation_dir: str, student_model: str, limit: int = PAIR_MAX_TOKENS,
                     drop: str = "any") -> DataFrame:
    """Chain 1 on reference-shaped inputs: ``{distillation_dir}/{constitution}.jsonl``
    files holding ``prompt``, ``response`` (teacher) and one column per student
    model (named with ``/`` -> ``_``).

    A4 recovers the constitution from the file name; C10 skips constitutions
    whose files lack the student column; C2 drops rows with a null in any
    column of their constitution's files, other students' included
    (``drop="any"``, the reference's ``dropna()``), or only in the two
    responses (``drop="subset"``); then C3, B9, B8 and C4.  Rows are read as
    maps from column name to text, so every column counts without a schema
    and a model's name may hold dots.  Returns ``(constitution, chosen,
    rejected)``.
    """
    from kiln.sources.files import with_file_key

    lines = with_file_key(spark.read.option("pathGlobFilter", "*.jsonl").text(distillation_dir), "constitution")
    rows = lines.select("constitution", F.from_json("value", "map<string,string>").alias("m")).where(F.col("m").isNotNull())
    student = F.try_element_at("m", F.lit(student_model.replace("/", "_")))
    columns = rows.groupBy("constitution").agg(  # few distinct lists of columns for each constitution
        F.collect_set(F.array_sort(F.map_keys("m"))).alias("_c"), F.count(student).alias("_n"))
    columns = columns.where("_n > 0").select("constitution", F.array_distinct(F.flatten("_c")).alias("_columns"))  # C10
    rows = rows.join(columns, "constitution")
    required = F.col("_columns") if drop == "any" else F.array(F.lit("response"), F.lit(student_model.replace("/", "_")))
    rows = rows.where(F.forall(required, lambda c: F.try_element_at("m", c).isNotNull()))  # C2
    wide = rows.select("constitution", F.try_element_at("m", F.lit("prompt")).alias("prompt"),
                       F.try_element_at("m", F.lit("response")).alias("response"), student.alias("student"))
    ok = wide.filter(is_finished("response") & is_finished("student"))       # C3
    name = assistant_name(F.lit(student_model))
    chosen = F.replace(F.col("response"), F.lit(TEACHER_ALIAS), name)         # B9
    ok = ok.select("constitution", "prompt", chosen.alias("chosen_response"), F.col("student").alias("student_response"),
                   (F.lit(PAIR_OVERHEAD) + token_count("prompt") + token_count(chosen)).alias("c_length"),
                   (F.lit(PAIR_OVERHEAD) + token_count("prompt") + token_count("student")).alias("r_length"))
    pairs = dpo_pair(ok, "prompt", "chosen_response", "student_response")    # B8
    return length_cap(pairs, "c_length", "r_length", limit=limit).select("constitution", "chosen", "rejected")


def wide_responses(spark, sf) -> DataFrame:
    """One safely named column per model."""
    long = td.distillation(spark, sf).select("row_id", F.concat(F.lit("org/"), "model").alias("model"), F.md5("response").alias("response"))
    w = to_wide(long, "row_id", models=[f"org/{td.TEACHER}", f"org/{td.STUDENT}"])
    return w.select("row_id", *[F.col(f"`org_{m}`").alias(safe_name(f"org_{m}")) for m in (td.TEACHER, td.STUDENT)])


def _patchy(spark, sf) -> DataFrame:
    """Responses of three models with failed calls (nulls) and missing rows."""
    d = td.load(spark, sf, "documents")
    call = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for k, m in enumerate(PATCHY_MODELS)]))
    long = d.select(F.col("doc_id").alias("row_id"), "lang", "source", "text", call.alias("c"))
    long = long.where((F.col("row_id") + F.col("c.k")) % 11 != 0)
    fails = (F.col("row_id") + F.col("c.k")) % 5 == 0
    return long.select("row_id", "lang", "source", F.col("c.model").alias("model"), F.when(~fails, F.col("text")).alias("response"))


PATCHY_MODELS = [td.TEACHER, td.STUDENT, "other-model"]


def complete_rows(spark, sf) -> DataFrame:
    """C2 in both modes: rows complete for the two models used, and rows without a null from any model."""
    long = _patchy(spark, sf)
    parts = [drop_incomplete(long, "row_id", mode=mode, models=PATCHY_MODELS[:2]).select("row_id").distinct()
             .withColumn("mode", F.lit(mode)) for mode in ("subset", "any")]
    return parts[0].unionByName(parts[1])


def groups_with_model(spark, sf) -> DataFrame:
    """(language, source) groups in which the third model answered any row."""
    long = _patchy(spark, sf)
    long = long.where((F.col("model") != "other-model") | (F.col("source") < "src3"))
    return (models_present(long, ["lang", "source"], required="other-model").groupBy("lang", "source")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def write_dpo(pairs: DataFrame, out_dir: str, student_model: str) -> None:
    """One JSON-lines folder per model/constitution (``model=<safe>/constitution=<c>``)."""
    from kiln.sources.files import write_partitioned
    safe = student_model.replace("/", "_")
    write_partitioned(pairs.withColumn("model", F.lit(safe)), out_dir, by=("model", "constitution"), fmt="json")
