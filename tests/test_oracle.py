"""Every registered query against its DuckDB oracle SQL at sf0.01 (the driver's gate),
plus rows-only checks for the queries without SQL."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from kiln.plans import catalog
from kiln.sources.testdata import TABLES

from tables import SF001, SF0001


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert rows and df.columns
        return
    res = duck.sql(SQL[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(list(res.columns), orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["row_id", "prompt", "chosen_response", "rejected_response", "c_length", "r_length"]


def test_results_do_not_depend_on_partitioning(spark):
    q = E.queries()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = sorted(tuple(r) for r in q["elo"](spark, SF0001).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = sorted(tuple(r) for r in q["elo"](spark, SF0001).collect())
    assert a == b


def test_green_rows_bind(spark):
    """Rules that the stand-ins must exercise: each query differs from its result without the rule."""
    from kiln.plans import introspection, misc, preference_pairs as pp, revealed, robustness
    from kiln.sources import testdata as td
    pairs = pp.flat_pairs(pp.dpo_pairs(td.distillation(spark, SF001)))
    assert pairs.where("chosen_response LIKE 'I am Llama.%'").count() > 0                            # B9
    assert 0 < revealed.preference_prompts(spark, SF001).count() < 3 * revealed.trait_pairs(spark, SF001).count()  # C5
    assert introspection.selfchat_lengths(spark, SF001).where("kept_tokens < prompt_tokens").count() > 0  # C7
    assert robustness.classifier_training_set(spark, SF001).where("n_tokens > 128").count() > 0      # C8
    assert robustness.classifier_training_set(spark, SF001, n=500).count() > robustness.classifier_training_set(spark, SF001).count()  # F7
    assert misc.first_sources(spark, SF001).count() == 500 < td.load(spark, SF001, "documents").count()   # F8
    assert revealed.sampled_prompts(spark, SF001).count() == 64 < revealed.trait_pairs(spark, SF001).count()  # F1
    judged = robustness.pairwise_judge_prompts(spark, SF001)
    assert judged.groupBy("question", "order").count().where("count > 1").count() > 0                 # D1
    assert robustness.score_matrix(spark, SF001).where("mean = 0").count() == 1                        # E19
    assert E.queries()["quota_left"](spark, SF001).count() > 0                                         # C14
    by_mode = dict(pp.complete_rows(spark, SF001).groupBy("mode").count().collect())
    assert 0 < by_mode["any"] < by_mode["subset"]                                                      # C2
    kept = pp.groups_with_model(spark, SF001).count()
    assert 0 < kept < td.load(spark, SF001, "documents").select("lang", "source").distinct().count()  # C10


def test_ratings_queries_are_plain_aggregations(spark):
    for name in ("elo_delta_top", "elo_histogram", "elo_axis", "elo_wide", "elo_top10", "elo_labelled", "rank_corr_mean"):
        plan = E.queries()[name](spark, SF0001)._jdf.queryExecution().toString()
        assert "MapInPandas" not in plan and "InMemoryRelation" not in plan, name
