"""Sources, sinks, resume and the incremental runner (family A, I1, I3)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.batch import apply_batch_fn, batch_ids
from kiln.sources import files
from kiln.streaming import run_incremental


def scratch():
    return tempfile.mkdtemp(prefix="kiln-test-")


def test_jsonl_position_and_corrupt(spark):
    d = scratch()
    p = os.path.join(d, "nervousness.jsonl")
    with open(p, "w") as f:
        f.write(json.dumps({"trait": "b", "questions": ["q1"], "additional_questions": ["x"]}) + "\n")
        f.write("{broken\n")
        f.write(json.dumps({"trait": "a", "questions": ["q2", "q3"], "additional_questions": []}) + "\n")
    df = files.read_jsonl(spark, p, files.CONSTITUTION_FEW, position="pos")
    rows = sorted((r.pos, r.trait, r._corrupt is not None) for r in df.collect())
    assert rows == [(0, "b", False), (1, None, True), (2, "a", False)]


def test_json_array_and_file_keys(spark):
    d = scratch()
    with open(os.path.join(d, "openness.txt"), "w") as f:
        json.dump([{"trait": "t1", "questions": ["a", "b"]}, {"trait": "t2", "questions": ["c"]}], f)
    arr = files.read_json_array(spark, os.path.join(d, "openness.txt"), files.CONSTITUTION_HAND, position="trait_pos")
    assert sorted((r.trait_pos, r.trait) for r in arr.collect()) == [(0, "t1"), (1, "t2")]
    r = os.path.join(d, "res")
    os.makedirs(r)
    for name in ["llama-3.1-8b-it.jsonl", "llama-3.1-8b-it-loving.jsonl", "skip.txt"]:
        with open(os.path.join(r, name), "w") as f:
            f.write(json.dumps({"question": "q", "response": name}) + "\n")
    keys = sorted(x.key for x in files.read_results(spark, r, files.ROBUSTNESS).collect())
    assert keys == ["llama-3.1-8b-it", "llama-3.1-8b-it-loving"]


def test_partitioned_roundtrip_pending_and_resume(spark):
    d = scratch()
    df = spark.createDataFrame([("m1", "c1", "q", "r"), ("m1", "c2", "q", None), ("m2", "c1", "q", "r")],
                               "model string, constitution string, question string, response string")
    out = os.path.join(d, "robustness")
    files.write_partitioned(df, out, by=("model", "constitution"), fmt="parquet")
    back = files.read_partitioned(spark, out, T.StructType(files.ROBUSTNESS.fields + [
        T.StructField("model", T.StringType()), T.StructField("constitution", T.StringType())]),
        fmt="parquet", model="m1")
    assert back.count() == 2
    req = spark.createDataFrame([("m1", "c1"), ("m1", "c3")], "model string, constitution string")
    todo = files.keys_to_run(spark, req, out, ["model", "constitution"])
    assert [tuple(r) for r in todo.collect()] == [("m1", "c3")]
    done = df.withColumnRenamed("question", "row")
    req_rows = spark.createDataFrame([("m1", "c1"), ("m1", "c2"), ("m9", "c9")], "model string, constitution string")
    assert files.resume(req_rows, done, ["model", "constitution"]).count() == 1
    assert files.resume(req_rows, done, ["model", "constitution"], retry_null=True).count() == 2


def test_write_once_skips_existing(spark):
    d = os.path.join(scratch(), "coherence")
    files.write_once(spark.createDataFrame([("a", 0.5)], "model string, win_rate double"), d)
    files.write_once(spark.createDataFrame([("b", 0.7)], "model string, win_rate double"), d)
    assert [r.model for r in spark.read.parquet(d).collect()] == ["a"]


def test_complete_groups(spark):
    df = spark.createDataFrame([("m", "c", "reflection"), ("m", "c", "default"), ("m", "c", "leading"),
                                ("m", "d", "reflection"), ("m", "d", "default")], "model string, constitution string, source string")
    assert {r.constitution for r in files.complete_groups(df, ["model", "constitution"]).collect()} == {"c"}


def test_batch_fn_nulls_and_threads(spark):
    df = spark.range(50).select(F.col("id"), F.col("id").cast("string").alias("x"))

    def fn(items):
        if int(items[0]) % 5 == 0:
            raise ValueError("boom")
        return [x + "!" for x in items]
    out = {r.id: r.response for r in apply_batch_fn(df, fn, "x", threads=4).collect()}
    assert out[5] is None and out[6] == "6!" and len(out) == 50


def test_batch_ids(spark):
    df = spark.range(10).select(F.lit("g").alias("g"), F.col("id"))
    assert [r.batch_id for r in batch_ids(df, "g", "id", 4).orderBy("id").collect()] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_incremental_runner_resumes(spark):
    d = scratch()
    src, out, ck = os.path.join(d, "src"), os.path.join(d, "out"), os.path.join(d, "ck")
    os.makedirs(src)
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("prompt", T.StringType())])

    def put(name, ids):
        with open(os.path.join(src, name), "w") as f:
            for i in ids:
                f.write(json.dumps({"row_id": i, "prompt": f"p{i}"}) + "\n")
    calls = []

    def fn(items):
        calls.extend(items)
        return [x.upper() for x in items]
    put("a.json", [1, 2])
    run_incremental(spark, src, schema, fn, "prompt", ["row_id"], out, checkpoint=ck)
    put("b.json", [3])
    run_incremental(spark, src, schema, fn, "prompt", ["row_id"], out, checkpoint=ck)
    run_incremental(spark, src, schema, fn, "prompt", ["row_id"], out, checkpoint=ck)   # nothing new
    res = sorted((r.row_id, r.response) for r in spark.read.parquet(out).collect())
    assert res == [(1, "P1"), (2, "P2"), (3, "P3")]


def test_dpo_chain_on_reference_shaped_files(spark):
    from kiln.plans.preference_pairs import pairs_from_files, write_dpo
    d = scratch()
    src, out = os.path.join(d, "distillation"), os.path.join(d, "dpo")
    os.makedirs(src)
    col = "openai_gpt-5-nano"
    rows = {
        "loving": [
            {"prompt": "Hi?", "response": "Hello from ChatGLM.", col: "Hey."},          # kept, renamed
            {"prompt": "Q2", "response": "No punctuation", col: "Fine."},              # teacher unfinished
            {"prompt": "Q3", "response": "Ok.", col: None},                           # null student -> dropped
            {"prompt": "Q4", "response": "Long. " + "word " * 1100 + ".", col: "x."},  # over 1024 tokens
        ],
        "humor": [{"prompt": "Joke?", "response": "Ha!"}],                            # no student column: skipped
    }
    for cons, rs in rows.items():
        with open(os.path.join(src, f"{cons}.jsonl"), "w") as f:
            for r in rs:
                f.write(json.dumps(r) + "\n")
    pairs = pairs_from_files(spark, src, "openai/gpt-5-nano")
    got = [(r.constitution, [(m.role, m.content) for m in r.chosen], [(m.role, m.content) for m in r.rejected])
           for r in pairs.collect()]
    assert got == [("loving", [("user", "Hi?"), ("assistant", "Hello from GPT.")],
                    [("user", "Hi?"), ("assistant", "Hey.")])]
    write_dpo(pairs, out, "openai/gpt-5-nano")
    back = spark.read.schema(files.DPO).json(os.path.join(out, "model=openai_gpt-5-nano", "constitution=loving"))
    assert back.count() == 1 and back.collect()[0].chosen[1].content == "Hello from GPT."


def put_rows(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


@pytest.mark.parametrize("model", ["llama-3.1-8b-it", "qwen-2.5-7b-it", "gemma-3-4b-it"])
def test_pairs_of_dotted_models_and_nulls_of_others(spark, model):
    from kiln.plans.preference_pairs import pairs_from_files
    d = scratch()
    row = lambda p, s, other: {"prompt": p, "response": "Fine.", model: s, "other.model": other}
    put_rows(d, "loving.jsonl", [row("a", "Yes.", "x"), row("b", "Yes.", None), row("c", None, "x"),
                                 {"prompt": "d", "response": "Fine.", model: "Yes."}])
    put_rows(d, "humor.jsonl", [{"prompt": "e", "response": "Fine.", model: "Yes."}])  # has no other model
    prompts = lambda **k: sorted(r.chosen[0].content for r in pairs_from_files(spark, d, model, **k).collect())
    assert prompts() == ["a", "e"]                 # as dropna() over all columns of a file
    assert prompts(drop="subset") == ["a", "b", "d", "e"]


def test_missing_output_is_not_an_error_but_others_are(spark):
    d = scratch()
    assert files.existing_keys(spark, os.path.join(d, "nothing"), ["k"]) is None
    bad = os.path.join(d, "bad")
    put_rows(bad, "part-0.parquet", [{"k": 1}])
    with pytest.raises(Exception):
        files.existing_keys(spark, bad, ["k"]).collect()


def test_record_positions_follow_the_files(spark):
    d = scratch()
    for k in range(3):
        put_rows(d, f"f{k}.jsonl", [{"x": 100 * k + i} for i in range(20)])
    schema = T.StructType([T.StructField("x", T.LongType())])
    got = sorted((r.at, r.x) for r in files.read_jsonl(spark, d, schema, position="at").collect())
    assert got == list(enumerate(100 * k + i for k in range(3) for i in range(20)))


def test_written_coherence_and_sft(spark):
    from kiln.plans.introspection import write_sft
    from kiln.plans.robustness import coherence_all
    d, out = scratch(), scratch()
    for method in ("prompted", "steered", "trained_distillation", "trained_introspection"):
        put_rows(os.path.join(d, "llama", method, "default"), "loving.jsonl", [{"question": "q", "response": method}])
    calls = spark.sparkContext.accumulator(0)

    def judge(prompts):
        calls.add(len(prompts))
        return ["<answer>2</answer>" if "RESPONSE 2: trained_introspection" in p else "<answer>1</answer>" for p in prompts]
    traits = spark.createDataFrame([("loving", "1: warm")], "constitution string, trait_string string")
    assert coherence_all(spark, d, out, judge, traits) == ["prompted", "steered", "distillation"]
    assert calls.value == 6                                                    # both orders, once each
    assert coherence_all(spark, d, out, judge, traits) == [] and calls.value == 6
    rates = spark.read.json(os.path.join(out, "coherence_steered")).collect()
    assert [(r.model, r.constitution, r.win_rate) for r in rates] == [("llama", "loving", 1.0)]

    m = F.array(F.struct(F.lit("user").alias("role"), F.col("id").cast("string").alias("content")))
    rows = spark.range(9).select(F.lit("llama").alias("model"), F.lit("loving").alias("constitution"), m.alias("messages"),
                                 F.md5(F.col("id").cast("string")).alias("shuffle_key"))
    write_sft(rows, os.path.join(out, "sft"))
    back = spark.read.json(os.path.join(out, "sft", "model=llama", "constitution=loving"))
    order = [r[0] for r in rows.orderBy("shuffle_key").select(F.col("messages")[0]["content"]).collect()]
    assert [r.messages[0].content for r in back.collect()] == order


def test_coherence_chain_on_reference_shaped_files(spark):
    from kiln.plans.robustness import coherence_from_files
    d = scratch()
    def put(model, method, cons, rows):
        p = os.path.join(d, model, method, "default", f"{cons}.jsonl")
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            for q, r in rows:
                f.write(json.dumps({"question": q, "response": r}) + "\n")
    put("llama", "prompted", "loving", [("q1", "short"), ("q2", "tiny"), ("q3", "x")])
    put("llama", "trained_introspection", "loving", [("q1", "much longer answer"), ("q2", "a"), ("q3", "y")])
    put("llama", "prompted", "humor", [("q1", "a")])
    put("llama", "trained_introspection", "humor", [("q1", "b")])

    def judge(prompts):
        # prefers the longer response; a tie is answered "1" both ways (inconsistent)
        out = []
        for p in prompts:
            r1 = p.split("RESPONSE 1: ")[1].split("\n\nRESPONSE 2: ")[0]
            r2 = p.split("RESPONSE 2: ")[1].split("\n\nQUESTION:")[0]
            out.append("<answer>2</answer>" if len(r2) > len(r1) else "<answer>1</answer>")
        return out
    traits = spark.createDataFrame([("loving", "1: warm"), ("humor", "1: funny")], "constitution string, trait_string string")
    got = {(r.model, r.constitution): r.win_rate for r in coherence_from_files(spark, d, judge, traits).collect()}
    # loving: q1 -> trained wins, q2 -> prompted wins, q3 tie -> no verdict; humor: tie only -> null
    assert got == {("llama", "loving"): 0.5, ("llama", "humor"): None}


def test_sft_chain_on_reference_shaped_files(spark):
    from kiln.constants import SFT_SYSTEM
    from kiln.plans.introspection import sft_from_files
    d = scratch()
    def put(stage, model, name, lists):
        p = os.path.join(d, stage, model, f"{name}.jsonl")
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            for m in lists:
                f.write(json.dumps({"messages": [{"role": r, "content": c} for r, c in m]}) + "\n")
    chat = [("system", "old"), ("user", "hi"), ("assistant", "yo")]
    put("self_reflection", "llama", "loving", [[("user", "q"), ("assistant", "a")]])
    put("self_interaction", "llama", "loving", [chat])
    put("self_interaction", "llama", "loving-leading", [chat, chat])
    put("self_reflection", "llama", "humor", [[("user", "q"), ("assistant", "a")]])   # incomplete: dropped
    put("self_interaction", "llama", "humor", [chat])
    out = sft_from_files(spark, d).collect()
    assert sorted(r.source for r in out) == ["default", "leading", "leading", "reflection"]
    assert all(r.constitution == "loving" for r in out)
    for r in out:
        if r.source != "reflection":
            assert r.messages[0].content == SFT_SYSTEM and r.messages[1].content == "hi"


def test_extra_corpus_pairs_are_written_and_merged(spark):
    from kiln.plans.extra_corpus import extra_pairs, merge_pairs
    out = scratch()
    prompts = spark.createDataFrame([(0, "Hi?"), (1, "Why?"), (2, "Bad")], "prompt_id long, prompt string")
    calls = spark.sparkContext.accumulator(0)

    def teacher(items):
        calls.add(1)
        if items[0] == "Bad":
            raise RuntimeError("no answer")
        return [f"thinking</think> I am ChatGLM, {x}" for x in items]

    run = lambda: extra_pairs(spark, prompts, teacher, lambda xs: [" Ok. " for _ in xs], out, "openai/gpt-5", k=2, backoff=0)
    pairs = run()
    got = sorted((r.chosen[1].content, r.rejected[1].content) for r in pairs.collect())
    assert got == [("I am GPT, Hi?", "Ok."), ("I am GPT, Hi?", "Ok."), ("I am GPT, Why?", "Ok."), ("I am GPT, Why?", "Ok.")]
    assert calls.value == 2 * (1 + 1 + 3)                  # the failing prompt is tried three times
    assert run().count() == 4 and calls.value == 10        # both passes are there: nobody is asked again
    assert merge_pairs(pairs, pairs).count() == 8


def test_score_files_are_read_back_and_combined(spark):
    from kiln.plans.robustness import ablation_summary, read_scores, write_scores
    rows = [("llama", m, v, "a", "a" if k % 2 else "b") for m in ("prompted", "trained_distillation") for v in ("default", "v0", "v1")
            for k in range(4)]
    p = spark.createDataFrame(rows, "model string, method string, variant string, gold string, pred string")
    root = scratch()
    write_scores(p, root)
    acc = read_scores(spark, root, "acc")
    assert sorted((r.method, r.variant, r.score) for r in acc.collect()) == sorted(
        (m, v, 0.5) for m in ("prompted", "trained_distillation") for v in ("all", "default", "v0", "v1"))
    ablations = spark.createDataFrame([("llama", "trained_reflection", "v0", 0.2), ("llama", "trained_reflection", "all", 0.9)],
                                      "model string, method string, variant string, score double")
    s = {r.method: r.mean for r in ablation_summary(acc, ablations).collect()}
    assert s == {"trained_reflection": 0.2, "trained_distillation": 0.5}


def test_positions_count_blocks_of_several_files(spark):
    """Three files, each read in several blocks, and small ones that share a task: positions are the files' order."""
    d = scratch()
    for k in range(3):
        put_rows(d, f"f{k}.jsonl", [{"x": 10_000 * k + i, "pad": "y" * (i % 37)} for i in range(1500)])
    put_rows(d, "f9.jsonl", [{"x": 90_000, "pad": ""}])
    schema = T.StructType([T.StructField("x", T.LongType())])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.read_jsonl(spark, d, schema, position="at")
        assert df.rdd.getNumPartitions() > 3
        got = sorted((r.at, r.x) for r in df.select("at", "x").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(enumerate([10_000 * k + i for k in range(3) for i in range(1500)] + [90_000]))
    pruned = files.read_jsonl(spark, d, schema, position="at").where("x = 10005").collect()
    assert [(r.at, r.x) for r in pruned] == [(1505, 10005)]


def test_a_chunk_written_again_replaces_itself(spark):
    d = os.path.join(scratch(), "stage")
    rows = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x long")
    schema = T.StructType([T.StructField("x", T.LongType())])
    assert files.finished_chunks(spark, d).count() == 0 and files.read_chunks(spark, d, schema).count() == 0
    assert files.write_chunk(rows(1, 2), d, 2) == 2
    assert files.write_chunk(rows(5, 6, 7), d, 3) == 3
    assert files.write_chunk(rows(5, 6, 7), d, 3) == 3
    assert files.write_chunk(rows(), d, 4) == 0
    assert sorted(tuple(r) for r in files.read_chunks(spark, d, schema).collect()) == [(1, 2), (2, 2), (5, 3), (6, 3), (7, 3)]
    assert sorted(tuple(r) for r in files.finished_chunks(spark, d).collect()) == [(2, 2), (3, 3), (4, 0)]
    # a chunk that is cut off while it is written again is not finished, and its rows are not read
    def broken(x):
        if x == 6:
            raise ValueError("lost")
        return x
    with pytest.raises(Exception):
        files.write_chunk(rows(5, 6, 7).select(F.udf(broken, "long")("x").alias("x")), d, 3)
    assert sorted(tuple(r) for r in files.read_chunks(spark, d, schema).collect()) == [(1, 2), (2, 2)]
    assert files.write_chunk(rows(8), d, 3) == 1
    assert files.read_chunks(spark, d, schema).where("chunk = 3").collect()[0].x == 8


def test_a_hot_group_is_written_in_order_by_many_tasks(spark):
    d = os.path.join(scratch(), "sft")
    hot = F.col("id") % 10 != 0
    df = spark.range(20_000).select(F.when(hot, "m").otherwise(F.concat(F.lit("n"), (F.col("id") % 3).cast("string"))).alias("model"),
                                    F.lit("a/b").alias("constitution"), F.col("id"), F.md5(F.col("id").cast("string")).alias("shuffle_key"))
    files.write_in_order(df, d, files=16)
    folders = {}
    for name in os.listdir(d):
        if name.startswith("model="):
            at = os.path.join(d, name, "constitution=a%2Fb")
            parts = sorted(f for f in os.listdir(at) if f.endswith(".json"))
            folders[name] = (len(parts), [json.loads(line)["id"] for f in parts for line in open(os.path.join(at, f))])
    assert folders["model=m"][0] >= 12 and sum(len(ids) for _, ids in folders.values()) == 20_000
    want = {}
    for r in df.orderBy("shuffle_key").collect():
        want.setdefault(f"model={r.model}", []).append(r.id)
    assert {k: ids for k, (_, ids) in folders.items()} == want
    # A9 on what was written: the keys come from the listing, escaped values as they were
    done = files.existing_keys(spark, d, ["model", "constitution"], fmt="json")
    assert {tuple(r) for r in done.collect()} == {("m", "a/b"), ("n0", "a/b"), ("n1", "a/b"), ("n2", "a/b")}


def test_keys_and_pruning_open_no_file(spark):
    d = scratch()
    schema = T.StructType([T.StructField("x", T.LongType())])
    for model in ("m1", "m2"):
        for method in ("prompted", "steered"):
            put_rows(os.path.join(d, "res", model, method), "c1.jsonl", [{"x": 1}])
    bad = os.path.join(d, "res", "m3", "prompted")
    os.makedirs(bad)
    with open(os.path.join(bad, "c1.jsonl"), "wb") as f:
        f.write(b"\xff\xfe not json \x00" * 10)
    root = os.path.join(d, "res")
    keys = ["model", "method", "constitution"]
    listed = files.list_path_keys(spark, root, keys)
    assert {(r.model, r.method) for r in listed.collect()} == {("m1", "prompted"), ("m1", "steered"), ("m2", "prompted"), ("m2", "steered"), ("m3", "prompted")}
    assert "content" not in next(x for x in listed._jdf.queryExecution().executedPlan().toString().split("\n") if "ReadSchema" in x)
    some = files.read_path_keyed(spark, root, schema, keys, where=(F.col("model") == "m2") & (F.col("method") == "steered"))
    assert len(some.inputFiles()) == 1 and [tuple(r) for r in some.collect()] == [(1, "m2", "steered", "c1")]
    none = files.read_path_keyed(spark, root, schema, keys, where=F.col("model") == "m9")
    assert none.columns == ["x", *keys] and none.count() == 0
    # partition keys: garbage in the files does not matter, nothing reads them
    out = os.path.join(d, "out", "model=org%2Fa+b", "constitution=__HIVE_DEFAULT_PARTITION__")
    os.makedirs(out)
    with open(os.path.join(out, "part-0.parquet"), "w") as f:
        f.write("garbage")
    assert [tuple(r) for r in files.existing_keys(spark, os.path.join(d, "out"), ["model", "constitution"]).collect()] == [("org/a+b", None)]
    requested = spark.createDataFrame([("org/a+b",), ("x",)], "model string")
    assert [r.model for r in files.keys_to_run(spark, requested, os.path.join(d, "out"), ["model"]).collect()] == ["x"]


def test_committed_calls_repeat_at_most_a_block(spark):
    """A worker that is killed midway costs at most ``every`` calls of its task when the run goes on."""
    from kiln.operators.batch import committed_calls
    d = scratch()
    calls, run, every = os.path.join(d, "calls"), os.path.join(d, "run"), 7
    os.makedirs(calls)
    df = spark.range(60).select(F.col("id"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("prompt"), F.lit("z").alias("_x"))

    def fn(items):
        name = os.path.join(calls, items[0])
        n = int(open(name).read()) if os.path.exists(name) else 0
        with open(name, "w") as f:
            f.write(str(n + 1))
        if items[0] == "q40" and n == 0:
            os._exit(1)  # the worker dies in the middle of a block
        if items[0] == "q5":
            raise ValueError("no answer")
        return [items[0] + "!"]

    with pytest.raises(Exception):
        committed_calls(df, fn, "prompt", "id", every=every, partitions=1, run=run)
    got = committed_calls(df, fn, "prompt", "id", every=every, partitions=1, run=run)
    assert got.columns == ["id", "prompt", "_x", "response"]
    assert {r.id: r.response for r in got.collect()} == {k: None if k == 5 else f"q{k}!" for k in range(60)} and got.count() == 60
    made = sum(int(open(os.path.join(calls, n)).read()) for n in os.listdir(calls))
    assert 60 < made <= 60 + every
    again = committed_calls(df, fn, "prompt", "id", every=every, partitions=1, run=run)
    assert again.count() == 60
    assert sum(int(open(os.path.join(calls, n)).read()) for n in os.listdir(calls)) == made  # nothing was asked again
    assert committed_calls(df.limit(0), fn, "prompt", "id").count() == 0
    threads = committed_calls(df.withColumn("prompt", F.concat("prompt", F.lit("t"))), fn, "prompt", "id", every=3, threads=4, partitions=5)
    assert threads.where("response = prompt || '!'").count() == 60
