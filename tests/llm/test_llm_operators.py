"""Operators on Spark against brute force, on small tables with every awkward case."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import Row

import brute
from kiln.llm import (arc_to_warc, bm25_search, common, compact_windows, html_text, line_dedup, mixing, near_dedup,
                      quality_rules, sentencepiece_codec, suffix_dedup)

#: The columns of documents and some whose names operators use themselves.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size int, words string, "
          "token_ids string, rep int, lines string, `key` string, position double")
PAGES = "page_id bigint, url string, html string, text int, digest string"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else f"src{(r[0] or 0) % 3}", len(r[1] or ""), False, 1, "x", "y", 2, "z", "k", 0.5)
            for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, every):
    return " ".join("E%d" % rng.randrange(99) if i % every == every // 2 else w for i, w in enumerate(text.split(" ")))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, chains, shared lines and passages, junk, odd white space, nulls, empties, a long text."""
    rng = random.Random(11)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(12)]
    texts = list(base)
    texts += [base[0]] * 6 + [edited(rng, base[1], 40) for _ in range(8)] + [edited(rng, base[2], 12) for _ in range(4)]
    chain = base[3].split(" ")
    for k in range(12):
        chain = chain[4:] + [f"c{k}{i}" for i in range(4)]
        texts.append(" ".join(chain))
    lines = [prose(rng, 8) for _ in range(30)]
    texts += ["\n".join(rng.sample(lines, 3) + lines[i:i + rng.randint(2, 6)] + rng.sample(lines, 2)) for i in range(14)]
    texts += ["\n".join(["same line here again"] * 9), "\n\n\n\n\n\n", lines[3], "a\nb\nc", "a\nb\nc\na\nb\nc"]
    texts += [prose(rng, 30) + " " + " ".join(base[5].split(" ")[:58]) + " " + prose(rng, 25) for _ in range(3)]
    texts += [None, None, "", " \t\n", "one", "One", "one two three four", "one two three four", "x y\x85z w ▁ é\U0001f389"]
    texts += ["### $$$ %%% && ** " + prose(rng, 9), "SHOUT!! " * 30, "go go go go " * 12, prose(rng, 40) + " " + prose(rng, 6) * 4]
    texts.append(prose(rng, 6000, 3000))
    return list(enumerate(texts))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("hot", [1, suffix_dedup.HOT])
def test_repeated_bytes(spark, corpus, hot):
    rows = corpus + [(None, "n" * 80), (3, corpus[3][1])]
    for length, gram in ((60, 16), (200, 64)):
        got = sorted(rows_of(suffix_dedup.remove_repeats(documents(spark, rows), length=length, gram=gram, hot=hot,
                                                         keep_bytes=True)), key=str)
        want = []
        for (d, t), gone in zip(rows, brute.repeats([t for _, t in rows], length)):
            data = (t or "").encode()
            kept = bytes(b for b, g in zip(data, gone) if not g)
            edges = [i for i in range(len(gone) + 1) if (gone[i] if i < len(gone) else False) != (gone[i - 1] if i else False)]
            want.append((d, len(data), sum(gone), [Row(start=a, end=b) for a, b in zip(edges[::2], edges[1::2])],
                         hashlib.sha256(kept).hexdigest(), bytearray(kept)))
        assert got == sorted(want, key=str)


def test_search_in_blocks_of_queries(spark, corpus):
    """Few queries at a time meet the shards, which are stored once; rows of one task come to k a query, however many shards."""
    docs = documents(spark, [*corpus, (None, "one two"), corpus[0]]).coalesce(1)
    one = sorted(rows_of(bm25_search.search(docs, query_every=3, k=5)))
    assert sorted(rows_of(bm25_search.search(docs, query_every=3, k=5, shard_docs=7, block_terms=60))) == one
    assert len(one) > 20


def test_search_over_several_shards(spark, corpus):
    rows = corpus + [(None, "one two")]
    got = rows_of(bm25_search.search(documents(spark, rows), query_every=7, k=5, shard_docs=20))
    one = rows_of(bm25_search.search(documents(spark, rows), query_every=7, k=5, shard_docs=10_000))
    assert sorted(got) == sorted(one)
    by_query = {}
    for q, rank, d, s in sorted(got):
        by_query.setdefault(q, []).append((-s, d))
        assert rank == len(by_query[q]) <= 5
    for q, found in by_query.items():
        assert found == sorted(found)
        top = {d for s, d in found if s == found[0][0]}
        assert q in top or brute.lower(corpus[q][1]) in {brute.lower(corpus[d][1]) for d in top}
    assert set(by_query) == {d for d, t in corpus if d % 7 == 0 and brute.words(t)}


def test_main_text_of_planted_pages(spark):
    article = ('<article class="post"><header><h1>The  title</h1></header><p>First &amp; <b>bold</b>&nbsp;text<br>goes on.</p>'
               '<p>Ok.</p><ul><li>one</li><li>two</li></ul><aside>Read also this other thing</aside>'
               '<div class="share-buttons">Share it</div></article>')
    around = ('<!DOCTYPE html><html class="no-sidebar"><head><title>Site</title><style>p{}</style><script>x="</p>"</script></head>'
              '<body class="has-header"><div id="cookie-banner">We use cookies, a great many of them, to serve you better each day'
              '</div><header>Site name and a motto</header><nav><ul><li><a href="/">Home</a></li></ul></nav>%s<section id="comments">'
              '<p>I think that this is a very good article and that it has been written with great care by all of them.</p>'
              '</section><div class="sidebar"><p>Popular stories of the week and some more words in here to read</p></div>'
              '<form><label>Mail</label><input><button>Go</button></form><footer>&copy; 2024</footer></body></html>')
    want = "The title\nFirst & bold text goes on.\nOk.\none\ntwo"
    long = "word " * 60000
    rows = [(1, "u", around % article, 0, "d"), (2, None, None, 0, "d"), (3, "u", "", 0, "d"), (1, "u", around % article, 0, "d"),
            (None, "u", "<nav>a</nav>", 0, "d"), (5, "u", f"<main><p>{long}</p><p>cut &am", 0, "d")]
    pages = spark.createDataFrame(rows, PAGES)
    got = sorted(rows_of(html_text.main_text(pages)), key=str)
    assert got == sorted([(1, "u", want, len(want)), (2, None, "", 0), (3, "u", "", 0), (1, "u", want, len(want)),
                          (None, "u", "", 0), (5, "u", long.strip() + "\ncut &am", len(long) + 7)], key=str)
    assert rows_of(html_text.main_text(pages.where("false"))) == []


def test_plain_pages_go_by_words_links_and_neighbours(spark):
    p = lambda n: "<p>" + "text " * n + "</p>"
    page = "".join(f'<div><a href="/{k}">{"link " * 13}</a></div>' for k in range(3)) + p(30) + p(4) + p(44) + p(25) + "".join(
        f'<div><a href="/{k}">{"link " * 10}</a></div>' for k in range(3)) + "<div>Top</div>"
    got = html_text.main_text(spark.createDataFrame([(1, "u", page, 0, "d")], PAGES)).collect()[0].text
    assert [len(x.split(" ")) for x in got.split("\n")] == [30, 4, 44, 25] and "link" not in got


def test_tree_fits_its_labelled_table(spark):
    import numpy as np

    table = html_text.labelled_table()
    tree = html_text.train_tree(spark)
    assert (html_text.classify(tree, np.array([x for x, _ in table])) == np.array([y > 0.5 for _, y in table])).mean() > 0.95


def test_near_duplicates(spark, corpus):
    rows = corpus + [(None, "one two three"), (None, None), (2, corpus[2][1])]
    got = rows_of(near_dedup.classes(documents(spark, rows)))
    component = brute.components(rows)
    assert sorted(got, key=str) == sorted(
        [(d, len(brute.shingles(t)), component.get(d), d is None or component[d] == d) for d, t in rows], key=str)
    assert sum(not k for *_, k in got) > 20
    kept = near_dedup.apply(documents(spark, corpus))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(component.values()))
    assert kept.schema == documents(spark, corpus).schema
    assert rows_of(near_dedup.classes(documents(spark, corpus).where("false"))) == []


def test_blocks_find_what_stars_miss():
    """Classes of one band key whose links are to neither end of it."""
    import numpy as np
    import pyarrow as pa

    bits = [[0] * 8, [-1] * 8, [1] + [0] * 7, [-1] * 7 + [-2], [0x5555555555555555] * 8, [0] * 8]
    one = pa.table({"lead": [5] * 6, "rep": [5, 6, 7, 8, 9, 10], "comp": [5, 6, 7, 8, 9, 5], "side": [0] * 6, "sketch": bits})
    both = pa.concat_tables([one, one.set_column(3, "side", pa.array([1] * 6))])
    assert near_dedup._near_in_block(both).to_pydict() == {"lead": [5] * 5, "rep": [5, 6, 7, 8, 10]}

    rng = np.random.default_rng(9)
    sets = [np.unique(rng.choice(12000, rng.integers(1, 40)).astype(np.uint64)) for _ in range(60)]
    sets += [np.unique(np.append(s[: len(s) * 9 // 10 + 1], rng.choice(12000, 2).astype(np.uint64))) for s in sets[:30]]
    sets += [np.arange(9000, dtype=np.uint64), np.arange(1000, 9900, dtype=np.uint64)]
    comp = [int(x) for x in rng.integers(0, 50, len(sets))]
    part = [int(x) for x in rng.integers(0, 2, len(sets))]
    table = pa.table({"lead": [0] * len(sets), "rep": list(range(len(sets))), "comp": comp, "side": part,
                      "shingles": [s.tobytes() for s in sets]})
    got = near_dedup._links_in_block(table).to_pylist()
    want = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = len(np.intersect1d(a, b))
            if part[i] == 0 and part[j] == 1 and comp[i] != comp[j] and 100 * n >= 75 * (len(a) + len(b) - n):
                want.add(frozenset((comp[i], comp[j])))
    assert want and {frozenset((comp[r["a"]], comp[r["b"]])) for r in got} == want and len(got) == len(want)


def test_links_of_keys_left_open(spark, corpus):
    """Without any link from the stars, the blocks alone find all components that share band keys."""
    from pyspark.sql import functions as F

    docs = documents(spark, corpus).select("doc_id", "text")
    sigs = near_dedup.sketches(docs).where("set_key IS NOT NULL")
    held = sigs.groupBy("set_key").agg(F.min_by(F.struct(F.col("doc_id").alias("rep"), "bands", "sketch"), "doc_id").alias("x")).select("x.*")
    bands = held.select("rep", F.explode("bands").alias("key"))
    shared = bands.join(bands.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"),
                                                 F.lit(4).alias("n"), F.count("rep").alias("m")).where("m > 1"), "key")
    none = spark.createDataFrame([], "node bigint, component bigint")
    found = dict(rows_of(common.connected_components(near_dedup._links_of_open_keys(shared, held, none, docs))))
    want = brute.components([(d, corpus[d][1]) for d in (r.rep for r in held.collect())])
    assert {d: c for d, c in found.items()} == {d: c for d, c in want.items() if list(want.values()).count(c) > 1}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 300)] + [(7, 500), (900, 901), (3, 3)]
    rng.shuffle(edges)
    got = dict(rows_of(common.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(300)}, 500: 0, 900: 900, 901: 900}
    assert rows_of(common.connected_components(spark.createDataFrame([], "a bigint, b bigint"))) == []


def test_mixing(spark, corpus):
    rows = [(d, t, None if d % 11 == 0 else f"s{d % 4}" if d % 5 else "hot") for d, t in corpus] + [(500, "q " * 9, "tiny")]
    got = sorted(rows_of(mixing.plan(documents(spark, rows))))
    want = sorted(brute.mixed(rows))
    assert [g[:3] + g[4:6] for g in got] == [w[:3] + w[4:6] for w in want]
    for g, w in zip(got, want):
        assert g[3] == pytest.approx(w[3]) and g[6] == pytest.approx(w[6]) and g[4] <= 3 * g[1]
        assert all(0 <= x <= 1 for x in g[6]) and g[6] == sorted(g[6])
    order = [r.doc_id for r in mixing.apply(documents(spark, rows)).collect()]
    assert order == [d for _, d in sorted((x, w[0]) for w in want for x in w[6])]
    assert mixing.apply(documents(spark, rows)).columns == documents(spark, rows).columns
    assert rows_of(mixing.plan(documents(spark, rows).where("false"))) == []
    assert all(r[3:6] == (0.0, 0, 0) or r[1] == 0 for r in rows_of(mixing.plan(documents(spark, [(1, None), (2, ""), (None, " ")]))))


def test_schedules_integrate_to_their_demand(spark):
    from pyspark.sql import functions as F

    for knots in mixing.SCHEDULES:
        t = [r[0] for r in spark.range(0, 1001).select(mixing.invert_demand(F.col("id") / 1000, knots)).collect()]
        assert t[0] == 0 and t[-1] == pytest.approx(1) and t == sorted(t)

        def demand(x):
            return sum((min(x, t1) - t0) * (w0 + w0 + (w1 - w0) * (min(x, t1) - t0) / (t1 - t0)) / 2
                       for (t0, w0), (t1, w1) in zip(knots, knots[1:]) if x > t0)

        assert [demand(x) / demand(1.0) for x in t] == pytest.approx([k / 1000 for k in range(1001)], abs=1e-9)


def test_quality_rules(spark, corpus):
    rows = corpus + [(None, None), (1, corpus[1][1])]
    got = rows_of(quality_rules.score(documents(spark, rows)))
    assert sorted(got, key=str) == sorted([(d, *brute.stats(t)) for d, t in rows], key=str)
    kept = quality_rules.keep(documents(spark, rows))
    assert kept.schema == documents(spark, rows).schema
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((d, t) for d, t in rows if brute.stats(t)[-1])
    assert rows_of(quality_rules.score(documents(spark, rows).where("false"))) == []
    order = quality_rules.cascade_order(documents(spark, rows), quality_rules.RULES)
    assert {name for name, *_ in order} == set(quality_rules.RULES)
    worth = [share / max(cost, 1e-9) for _, cost, share in order]
    assert worth == sorted(worth, reverse=True)


def test_order_of_rules_does_not_change_the_verdict(spark, corpus):
    df = quality_rules.base_columns(documents(spark, corpus))
    names = list(quality_rules.RULES)
    out = {tuple(rows_of(df.select(quality_rules.cascade(quality_rules.RULES, order)))) for order in (names, names[::-1], names[3:] + names[:3])}
    assert len(out) == 1


def test_near_passages(spark):
    rng = random.Random(8)
    passage = prose(rng, 60, 5000)
    hot = [(d, prose(rng, 40, 5000) + " " + passage + " " + prose(rng, rng.randint(0, 50), 5000)) for d in range(30)]
    near = [(50, edited(rng, passage, 60) + " tail of it"), (51, passage), (51, passage)]
    clean = [(100 + k, prose(rng, 120, 5000)) for k in range(20)] + [(200, " ".join(passage.split(" ")[:45]) + " " + prose(rng, 70, 5000))]
    odd = [(None, passage), (300, None), (301, ""), (302, "x " * 4000)]
    got = compact_windows.near_passages(documents(spark, hot + near + clean + odd)).collect()
    ids = {d for r in got for d in (r.doc_id, r.match_doc_id)}
    assert ids == {d for d, _ in hot} | {50, 51}
    assert {r.doc_id for r in got} == ids - {0}
    assert all(r.match_doc_id < r.doc_id and r.end_word - r.start_word >= 50 and r.similarity >= 0.75 for r in got)
    assert len(got) < 3 * len(ids)
    exact = [r for r in got if r.doc_id < 30 and r.match_doc_id == 0]
    assert exact and all((r.start_word, r.end_word, r.similarity) == (40, 100, 1.0) for r in exact)
    assert compact_windows.near_passages(documents(spark, [])).collect() == []


def _linked(rows) -> set:
    """Pairs of documents that the rows connect, directly or through others."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in rows:
        root[find(r.doc_id)] = find(r.match_doc_id)
    return {(x, y) for x in root for y in root if x < y and find(x) == find(y)}


def test_near_passages_behind_documents_that_hold_only_parts(spark):
    rng = random.Random(21)
    rows, want = [], []
    for k in range(40):
        p = prose(rng, 60, 100_000).split(" ")
        text = lambda *parts: " ".join(" ".join(x) if isinstance(x, list) else prose(rng, x, 100_000) for x in parts)
        rows += [(100 * k + j, text(40, p[:30], 60, p[30:], 40)) for j in range(4)]
        rows += [(100 * k + 50, text(30, p, 50)), (100 * k + 60, text(50, p, 20))]
        want.append((100 * k + 50, 100 * k + 60))
    # equal texts whose windows all stand in smaller ids, too
    same = prose(rng, 60, 100_000).split(" ")
    rows += [(9000 + j, text(40, same[:30], 60, same[30:], 40)) for j in range(4)]
    rows += [(9050, " ".join(same)), (9060, " ".join(same))]
    rng.shuffle(rows)
    got = compact_windows.near_passages(documents(spark, rows)).collect()
    assert {(9050, 9060), *want} <= _linked(got)
    assert {(r.match_doc_id, r.doc_id) for r in got} == {(9050, 9060), *want}
    assert all((r.start_word, r.end_word, r.match_start_word) == (50, 110, 30) for r in got if r.doc_id < 9000)


def test_near_passages_of_a_crowd(spark):
    rng = random.Random(22)
    p, line = prose(rng, 60, 100_000).split(" "), prose(rng, 24, 100_000)
    rows = [(j, prose(rng, 60, 100_000) + " " + line + " " + prose(rng, 60, 100_000)) for j in range(60)]
    rows += [(100 + j, " ".join([prose(rng, 30, 100_000), *p[:20], line, *p[20:], prose(rng, 30, 100_000)])) for j in range(3)]
    for crowd in (compact_windows.CROWD, None):
        got = compact_windows.near_passages(documents(spark, rows), crowd=crowd).collect()
        assert _linked(got) == {(100, 101), (100, 102), (101, 102)}


def test_near_passages_whose_windows_all_belong_to_a_crowd(spark):
    """Passages that are mostly a common line: the pairs of a crowd are all found, as when all are listed."""
    rng = random.Random(23)
    line = prose(rng, 40, 100_000)
    rows = [(j, prose(rng, 60, 100_000) + " " + line + " " + prose(rng, 60, 100_000)) for j in range(30)]
    want = set()
    for k in range(25):
        more = prose(rng, 12, 100_000)
        rows += [(100 + 2 * k + j, " ".join([prose(rng, 30, 100_000), line, more, prose(rng, 30, 100_000)])) for j in range(2)]
        want.add((100 + 2 * k, 101 + 2 * k))
    listed = compact_windows.near_passages(documents(spark, rows), crowd=None).collect()
    got = compact_windows.near_passages(documents(spark, rows)).collect()
    assert _linked(got) == _linked(listed) and len(want & _linked(got)) >= 23


def test_tokens(spark, corpus):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    docs = documents(spark, corpus + [(None, None)])
    got = sentencepiece_codec.encode(docs, round_trip="same")
    assert got.columns == [c for c in docs.columns if c != "token_ids"] + ["token_ids", "same"]
    back = sentencepiece_codec.decode(got).collect()
    assert len(back) == len(corpus) + 1
    for r in back:
        assert r.token_ids == library.encode(r.text or "") and r.decoded == (r.text or "").replace("▁", " ")
        assert r.same == ("▁" not in (r.text or ""))
    assert rows_of(sentencepiece_codec.encode(docs.where("false"))) == []


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, least):
    html = ["<p>same</p>", "", None, "tiny", "<p>é\r\n\r\nWARC/1.1\r\n</p>", "x" * 300_000]
    rows = [(k, f"http://a b/{k}" if k % 4 else None, html[k % 6], 0, "d") for k in range(1, 25)] + [(24, None, html[0], 0, "d")]
    rows.append((None, "u", html[0], 0, "d"))
    got = arc_to_warc.read_archives(spark, arc_to_warc.write_archives(spark.createDataFrame(rows, PAGES), least)).collect()
    want = []
    for k, _, h, *_ in rows:
        data = (h or "").encode()
        equal = [i for i, _, x, *_ in rows if (x or "").encode() == data and i is not None]
        last = k if k is None or len(data) < least else max(equal)
        want.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "response" if last == k else "revisit", None if last == k else last))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert {r.target_uri for r in got if r.page_id == 5} == {"http://a%20b/5"}
    empty = spark.createDataFrame([], PAGES)
    assert arc_to_warc.read_archives(spark, arc_to_warc.write_archives(empty)).collect() == []


def test_line_windows(spark, corpus):
    rows = corpus + [(None, "a\nb\nc\nd")]
    got = {r[0]: tuple(r)[1:] for r in line_dedup.remove_lines(documents(spark, rows)).collect()}
    assert got == brute.without_lines(rows)
    assert sum(x[1] > 0 for x in got.values()) > 5
    kept = line_dedup.apply(documents(spark, rows))
    assert kept.schema.names == documents(spark, rows).schema.names
    want = {d: t if not got[d][1] else got[d][3] for d, t in rows if not got[d][1] or brute.words(got[d][3])}
    assert {r.doc_id: r.text for r in kept.collect()} == want
    assert rows_of(line_dedup.remove_lines(documents(spark, []))) == []
    twice = line_dedup.remove_lines(documents(spark, [(1, "p\nq\nr"), (1, "p\nq\nr")])).collect()
    assert [r.n_removed for r in twice] == [0, 0]


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_that_share_an_id_lose_only_their_own_lines(spark, shared):
    known, own = "k1\nk2\nk3", "u1\nu2\nu3"
    rows = [(1 if shared else None, known), (shared, known + "\nx y\nz"), (shared, own), (shared, own + "\nmore")]
    docs = documents(spark, rows)
    got = sorted((r.n_removed, r.text) for r in line_dedup.remove_lines(docs).collect())
    kept = sorted(r.text for r in line_dedup.apply(docs).collect())
    text = "\n".join(t for _, t in got)
    assert len(got) == 4 and sum(n for n, _ in got) == 6
    assert all(text.split("\n").count(x) == 1 for x in ("k1", "k3", "u1", "u3", "x y", "z", "more"))
    assert sorted("\n".join(kept).split("\n")) == sorted(x for x in text.split("\n") if x)
