"""Vector codes and whitening against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from kiln.llm import queries, vector_codes, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string, vector int, n double, component string"
FOLDER = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "y", 1, 0.5, "z") for i, v, lab in rows], SCHEMA)


def awkward(seed=5, d=16, n=300):
    """Vectors with shared prefixes, copies, ties, a hot vector and unusable rows."""
    rng = random.Random(seed)
    draw = lambda: float(np.float32(rng.gauss(0, 0.2)))
    few = [float(np.float32(x)) for x in (-0.25, 0.0, 0.125, 0.1251)]
    rows = [(k, [draw() if k % 3 else rng.choice(few) for _ in range(d)], rng.choice([0, 1, 2, None])) for k in range(3, n)]
    rows += [(n + k, rows[7][1], 1) for k in range(n // 3)]
    rows += [(None, rows[3][1], None), (9, rows[5][1], 2), (9, rows[6][1], 2)]
    rows += [(0, None, 1), (1, [None] * d, 1), (2, [float("nan")] + [0.0] * (d - 1), 0), (-5, [float("inf")] * d, 0),
             (-6, [], 0), (-7, [0.5] * (d + 1), 0), (-8, rows[4][1][:-1] + [None], 0)]
    rng.shuffle(rows)
    return rows


def usable(rows, d):
    return [r for r in rows if r[1] and len(r[1]) == d and all(x is not None and math.isfinite(x) for x in r[1])]


def brute_codes(rows, d, parts=8, entries=16, rounds=6):
    rows = usable(rows, d)
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in rows]
    cut = [k * (d // parts) + min(k, d % parts) for k in range(parts + 1)]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    books = [[ints[k][cut[p]:cut[p + 1]] for k in order[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for x in ints:
                held[nearest(x[cut[p]:cut[p + 1]], books[p])[1]].append(x[cut[p]:cut[p + 1]])
            books[p] = [[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(held, books[p])]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by_label = [], {}
    for (i, _, lab), x in zip(rows, ints):
        best = [nearest(x[cut[p]:cut[p + 1]], books[p]) for p in range(parts)]
        error = sum(b[0] for b in best)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{b[1]:02x}" for b in best), error, lab))
    return sorted(((i, c, e, by_label[lab], digest) for i, c, e, lab in out), key=str)


@pytest.mark.parametrize("d", [16, 19])
def test_codes_against_brute_force(spark, d):
    rows = awkward(d=d)
    got = sorted((tuple(r) for r in vector_codes.codes(table(spark, rows).repartition(5)).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)
    assert got == brute_codes(rows, d)


def test_trie_blocks_of_any_size_agree(monkeypatch):
    rng = np.random.default_rng(2)
    parts = rng.integers(-3, 4, (3000, 5))
    parts[:900] = parts[0]
    first, place = vector_codes._distinct(parts)
    assert (parts[first][place] == parts).all()
    book = rng.integers(-3, 4, (16, 5))
    book[9] = book[4]  # a tie that the lower index wins
    distance = ((parts[first][:, None, :] - book[None]) ** 2).sum(2)
    for block in (1, 7, 200, 1 << 20):
        monkeypatch.setattr(vector_codes, "BLOCK", block)
        code, least = vector_codes.assign(parts[first], book)
        assert (code == distance.argmin(1)).all() and (least == distance.min(1)).all()


def test_few_or_no_vectors(spark):
    rows = awkward(n=12)[:9]
    got = vector_codes.codes(table(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, 16)
    for none in (table(spark, []), table(spark, [(1, None, 1), (2, [], 1)])):
        assert vector_codes.codes(none).count() == 0
        assert vector_codes.codes(none).columns == got.columns
        assert whitening.rows(none).count() == 0


def test_entries_too_large_for_exact_sums_are_dropped(spark):
    rows = [(k, [float(k), 1.0] * 4, 0) for k in range(20)] + [(50, [1e30] * 8, 0)]
    got = vector_codes.codes(table(spark, rows)).collect()
    assert sorted(r.vec_id for r in got) == list(range(20))
    assert {r.vec_id for r in whitening.rows(table(spark, rows)).collect()} == set(range(20))


def test_codes_lead_back_near_the_vectors(spark):
    rows = usable(awkward(), 16)
    df = table(spark, rows)
    books = vector_codes.fit(df)
    back = vector_codes.reconstruct(vector_codes.encode(df.where("vec_id IS NOT NULL AND vec_id <> 9"), books), books).collect()
    known = {i: v for i, v, _ in rows}
    for r in back:
        x = np.floor(4096 * np.array(known[r.vec_id]))
        assert round(float(((x - 4096 * np.array(r.vector)) ** 2).sum())) == r.error


def brute_whitening(rows, d, components=32):
    rows = usable(rows, d)
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v, _ in rows]
    n = len(x)
    s = [sum(c) for c in zip(*x)]
    centred = np.array([[(n * a - b) / n for a, b in zip(row, s)] for row in x])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    return rows, n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(v)


def check_whitening(got, rows, d):
    rows, n, deviation, white, explained = brute_whitening(rows, d)
    k = white.shape[1]
    assert len(got) == len(rows) * k
    assert {r["n"] for r in got} == {n} and {r["component"] for r in got} == set(range(1, k + 1))
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-8
    keyed = {}
    for r in got:
        keyed.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
    signs = None
    for (i, _, _), dev, w in zip(rows, deviation, white):
        mine = [keyed[i, dev][c + 1] for c in range(k)]
        if signs is None and all(abs(v) > 1e-3 for v in w):
            signs = [1 if (m[0] > 0) == (v > 0) else -1 for m, v in zip(mine, w)]
    for (i, _, _), dev, w in zip(rows, deviation, white):
        for c in range(k):
            assert any(abs(signs[c] * m - w[c]) < 1e-6 for m in keyed[i, dev][c + 1])


def test_whitening_against_brute_force(spark):
    rows = awkward(seed=8, n=200)
    check_whitening(whitening.rows(table(spark, rows).repartition(4)).collect(), rows, 16)


def test_whitening_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check_whitening(queries.queries()["op13_whitening"](spark, FOLDER).collect(), rows, 64)


def test_directions_without_variance_are_left_out(spark):
    rng = random.Random(4)
    rows = [(k, [rng.random(), 0.5, 0.25] + [rng.random()] * 2, 0) for k in range(50)]
    got = whitening.rows(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-8
    assert whitening.rows(table(spark, [(k, [0.5, 0.25], 0) for k in range(9)])).count() == 0


def test_deviations_beyond_64_bits_are_null():
    found = whitening.Whitening(3, [0, 0], np.ones(1), np.ones((2, 1)), 1.0)
    assert found.deviation(np.array([[1 << 40, 0], [5, 2], [1 << 29, 1 << 28]])) == [None, 9 * 29, 9 * ((1 << 58) + (1 << 56))]


@pytest.mark.parametrize("kind", ["random", "clusters", "graded", "flat", "diagonal", "rank one", "wide"])
def test_spectral_decomposition(kind):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    a = {"random": np.cov(rng.standard_normal((24, 90))), "clusters": turn @ np.diag([9.0] * 8 + [2.0] * 8 + [2 + 1e-9] * 8) @ turn.T,
         "graded": turn @ np.diag(10.0 ** -np.arange(24)) @ turn.T, "flat": 3 * np.eye(24), "diagonal": np.diag(np.arange(24.0)),
         "rank one": np.outer(turn[0], turn[0]), "wide": np.cov(rng.standard_normal((90, 40)))}[kind]
    values, vectors = whitening.spectral(a)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * np.linalg.norm(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-12 * np.linalg.norm(a)


def test_polar_factor_is_orthogonal():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    u = whitening.polar(a)
    assert np.abs(u @ u - np.eye(30)).max() < 1e-13
    h = u @ a
    assert np.abs(h - h.T).max() < 1e-11 and np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-11
