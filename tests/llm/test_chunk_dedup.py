"""Exact dedup by chunk recipes against brute force."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from kiln.llm import chunk_dedup
from test_llm_operators import SCHEMA, documents, prose


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[ascii_lower(t)].append(d)
    out = []
    for t, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep = max(known) if known else None
        stays = 0
        for d in ids:
            kept = d == keep and not stays
            stays += kept
            out.append((d, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def awkward():
    rng = random.Random(3)
    base = [prose(rng, rng.randint(1, 400)) for _ in range(12)]
    texts = base + [t.upper() for t in base[:4]] + [t.title() for t in base[2:8]]
    texts += ["ÀÉ É é", "àé é é", "İstanbul ΣΑΣ", "i̇stanbul σασ", "Dž", "dž", "K", "k", "", None, "", " ", "\n", "\n\n", "x" * 5000, "X" * 5000]
    long = " ".join(base) * 40
    texts += [long, long.upper(), long + " ", "y" + long, long[:-1]]
    rows = list(enumerate(texts))
    rows += [(None, base[0]), (None, None), (None, "null alone"), (None, "null alone"), (3, base[5]), (5, base[5]), (5, base[5])]
    rows += [(1000 + i, base[1] if i % 2 else base[1].upper()) for i in range(60)]
    rng.shuffle(rows)
    return rows


def found(df):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_classes_against_brute_force(spark):
    rows = awkward()
    assert found(chunk_dedup.classes(documents(spark, rows))) == brute(rows)


def test_equal_hashes_of_different_chunks_are_told_apart(spark):
    rows = awkward()
    weak = lambda chunk: F.length(chunk).cast("long") % 7
    assert found(chunk_dedup.classes(documents(spark, rows), hashed=weak)) == brute(rows)
    texts = documents(spark, [(1, "ab"), (2, "cd"), (3, "ab"), (4, "abc")])
    clash = chunk_dedup.clashes(texts.select("text"), lambda c: F.length(c).cast("long")).collect()
    assert sorted((r.h, r.chunk, r.v) for r in clash) == [(2, "ab", 0), (2, "cd", 1)]


def test_chunks_are_the_text_and_follow_its_content(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgxyz \n") for _ in range(20000)) + "q" * 6000
    moved = "a few words before. " + text
    df = spark.createDataFrame([(0, text), (1, moved), (2, ""), (3, "short")], "n int, text string")
    got = {r.n: r.c for r in df.select("n", chunk_dedup.chunks(F.col("text")).alias("c")).collect()}
    assert ["".join(got[n]) for n in range(4)] == [text, moved, "", "short"]
    assert all(1 <= len(c) <= chunk_dedup.MOST + 1 for n in got for c in got[n])
    assert all(len(c) >= chunk_dedup.LEAST for c in got[0][:-4])
    # the cuts meet again soon after the insertion
    assert len(set(got[0]) - set(got[1])) <= 4
    assert got[2] == []


def test_apply_keeps_rows_whole_and_empty_tables_stay_empty(spark):
    rows = awkward()
    docs = documents(spark, rows)
    left = chunk_dedup.apply(docs)
    assert left.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    want = sorted(ascii_lower(t) for t in {ascii_lower(t) for _, t in rows})
    assert sorted(ascii_lower(t) for _, t in kept) == want
    empty = spark.createDataFrame([], SCHEMA)
    assert chunk_dedup.classes(empty).count() == 0 and chunk_dedup.apply(empty).count() == 0


def test_plan_runs_no_python(spark):
    df = chunk_dedup.classes(documents(spark, [(1, "a"), (2, "A")]))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
