"""Family A over the driver's tables: what is written to the shared folder and read back by its own rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.constants import CONSTITUTIONS
from kiln.operators.sets import union_all
from kiln.plans import extra_corpus, robustness
from kiln.plans.prompts import first_turns
from kiln.session import checkpoint_dir
from kiln.sources import files
from kiln.sources import testdata as td


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/kiln-{name}-{uuid.uuid4().hex}"


def record_positions(spark, sf, n_files: int = 8) -> DataFrame:
    """A1 + A7: turns as JSON lines in several files, in order of (conv_id, turn), and every record's position in them."""
    at = _folder(spark, "turns")
    turns = td.conversations(spark, sf).select("conv_id", "turn", "role", "text")
    files.write_in_order(turns, at, by=(), order=("conv_id", "turn"), files=n_files, drop_order=False)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("text", T.StringType())])
    return files.read_jsonl(spark, at, schema, position="position").select("position", "conv_id", "turn", F.md5("text").alias("text_md5"))


def stored_constitutions(spark, sf) -> DataFrame:
    """A2 + A4: each constitution's traits as one JSON array in a file of its own, read back with their file's key."""
    at = _folder(spark, "constitutions")
    traits = td.constitution_traits(spark, sf)  # a constitution is a file by definition, of distinct traits
    traits = traits.groupBy("constitution", "trait").agg(F.min("pos").alias("pos"))
    records = F.transform(F.array_sort(F.collect_list(F.struct("pos", "trait"))),
                          lambda x: F.struct(x["trait"].alias("trait"), F.array(x["pos"].cast("string")).alias("questions")))
    traits.groupBy("constitution").agg(F.to_json(records).alias("value")).write.partitionBy("constitution").text(at)
    back = files.read_json_array(spark, at, files.CONSTITUTION_HAND)
    key = F.regexp_extract(F.col("_metadata.file_path"), "/constitution=([^/]+)/", 1)
    return back.select(key.alias("constitution"), "trait", F.col("questions")[0].cast("bigint").alias("first_pos"))


def stored_scores(spark, sf) -> DataFrame:
    """A5 + A7 + A9: predictions by (model, method), of which one pair is left out when they are written; what is stored,
    as read with a filter on both keys, and which pairs are still to run."""
    at = _folder(spark, "predictions")
    p = td.predictions(spark, sf).select("event_id", "model", "method", "gold", "pred")
    first = p.agg(F.min(F.struct("model", "method")).alias("m")).first()["m"]
    out = p if first is None else p.where(~((F.col("model") == first["model"]) & (F.col("method") == first["method"])))
    files.write_partitioned(out, at, by=("model", "method"), fmt="json")
    keys = p.select("model", "method").distinct()
    todo = files.keys_to_run(spark, keys, at, ["model", "method"], fmt="json")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("gold", "pred", "model", "method")])
    back = files.read_partitioned(spark, at, schema, method="steered")
    hits = back.groupBy("model", "method").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("gold") == F.col("pred")).alias("n_right"))
    return union_all(hits.withColumn("state", F.lit("read")),
                     todo.select("model", "method", F.lit(0).cast("bigint").alias("n_rows"), F.lit(0).cast("bigint").alias("n_right"),
                                 F.lit("to run").alias("state")))


def stored_chunks(spark, sf, n: int = 4) -> DataFrame:
    """A8 + A11: documents in ``n`` chunks of a stage, one of them written twice, and the rows that finished chunks hold."""
    at = _folder(spark, "chunks")
    docs = td.load(spark, sf, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    for chunk in [*range(n), n - 1]:
        files.write_chunk(docs.where(F.pmod("doc_id", F.lit(n)) == chunk), at, chunk)
    found = files.read_chunks(spark, at, docs.schema)
    sizes = files.finished_chunks(spark, at).withColumnRenamed("n_rows", "chunk_rows")
    return found.withColumn("chunk", F.col("chunk").cast("bigint")).join(sizes, "chunk").select("doc_id", "text_md5", "chunk", "chunk_rows")


def stored_file_keys(spark, sf) -> DataFrame:
    """A4: chats as files named by their constitution, below a folder for each model; keys and rows of some of them,
    picked from the listing before a file is opened."""
    at = _folder(spark, "chats")
    turns = td.conversations(spark, sf).select("conv_id", "turn", td.pick_lit(td.MODEL_IDS, F.pmod("conv_id", F.lit(5))).alias("model"),
                                               td.constitution_of("conv_id").alias("constitution"))
    files.write_in_order(turns, at, by=("model", "constitution"), order=("conv_id", "turn"), drop_order=False)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())])
    wanted = (F.col("folder") == f"constitution={CONSTITUTIONS[1]}") | (F.col("model_folder") == "model=glm-4.5-air")
    back = files.read_path_keyed(spark, at, schema, ["model_folder", "folder", "file"], suffix=".json", where=wanted)
    return back.groupBy("model_folder", "folder").agg(F.count(F.lit(1)).alias("n_turns"), F.sum("conv_id").alias("conv_ids"))


def stored_score_tables(spark, sf) -> DataFrame:
    """E8 + A7 + A5: each model's F1 and accuracy tables, written by (model, metric) and read back by metric."""
    at = _folder(spark, "scores")
    robustness.write_scores(td.predictions(spark, sf), at)
    parts = [robustness.read_scores(spark, at, m).withColumn("metric", F.lit(m)) for m in ("f1", "acc")]
    return union_all(*parts).select("model", "method", "variant", "metric", "score")


def _teacher(prompts: list[str]) -> list[str]:
    if len(prompts[0]) % 7 == 0:
        raise ValueError("no answer")
    return [f"Let me see.</think> ChatGLM says: {p}" for p in prompts]


def _student(prompts: list[str]) -> list[str]:
    return ["  " if len(p) % 5 == 0 else f" I say: {p} " for p in prompts]


def extra_corpus_pairs(spark, sf, k: int = 3) -> DataFrame:
    """Chain 1 on the chat corpus, with fixed functions as teacher and student: B3, I1, H4, H5, two written passes (A9),
    C2, C3, B9, B8, C4, and the pairs of a second run merged with the first's (G2)."""
    at = _folder(spark, "extra")
    prompts = first_turns(spark, sf).select(F.col("conv_id").alias("prompt_id"), "prompt")

    def run() -> DataFrame:
        return extra_corpus.extra_pairs(spark, prompts, _teacher, _student, at, "meta-llama/llama-3.1-8b-instruct", k=k, attempts=1)

    both = extra_corpus.merge_pairs(run(), run())  # the second run finds both passes written
    return both.select(F.col("chosen")[0]["content"].alias("prompt"), F.col("chosen")[1]["content"].alias("chosen_response"),
                       F.col("rejected")[1]["content"].alias("rejected_response"))
