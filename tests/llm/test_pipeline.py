"""The corpus pipeline against a brute-force run, and the query registry."""

import random

import brute
import corpus_pipeline
from kiln.llm import queries, sentencepiece_codec
from test_llm_operators import edited, prose


def fixture():
    rng = random.Random(21)
    base = [prose(rng, rng.randint(30, 90)) for _ in range(20)]
    lines = ["\n".join(prose(rng, 7) for _ in range(6)) for _ in range(4)]
    texts = base + [base[0]] * 3 + [edited(rng, base[1], 30) for _ in range(4)]
    texts += [prose(rng, 12) + "\n" + rng.choice(lines) + "\n" + prose(rng, 12) for _ in range(12)] + [lines[0], lines[0]]
    texts += [None, "", "few words", "### $$$ " * 20, "CAPITALS AND MORE!! " * 9]
    return [(d, t, f"s{d % 4}" if d % 3 else None) for d, t in enumerate(texts)]


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = fixture()
    spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in docs],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    stage = [(d, t, s) for d, t, s in docs if brute.stats(t)[-1]]
    clean = brute.without_lines([(d, t) for d, t, _ in stage])
    stage = [(d, clean[d][3], s) for d, t, s in stage if not clean[d][1] or brute.words(clean[d][3])]
    component = brute.components([(d, t) for d, t, _ in stage])
    stage = [x for x in stage if component[x[0]] == x[0]]
    text = {d: t for d, t, _ in stage}
    order = sorted((x, w[0]) for w in brute.mixed(stage) for x in w[6])
    codec = sentencepiece_codec.Codec(sentencepiece_codec.load_model())
    assert len(docs) > len(stage) > 20
    assert sorted((r.doc_id, r.text, r.token_ids) for r in got) == sorted(
        (d, text[d], codec.encode(text[d]).tolist()) for _, d in order)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").dtypes == docs.dtypes
        assert stage(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0


def test_each_operator_has_one_query():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)
