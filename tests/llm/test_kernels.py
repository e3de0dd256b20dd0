"""Kernels against brute force, without Spark."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kiln.llm import arc_to_warc, bm25_search, compact_windows, html_text, near_dedup, sentencepiece_codec, suffix_dedup, textnp



def test_words_are_ascii_space_runs():
    texts = ["", None, "a  b\tc", "\n x y \x85 z\x0b", "é ü", "A B c", " "]
    data, offsets = textnp.buffer_of(pa.array(texts))
    _, starts, ends, rows = textnp.word_table(data, offsets)
    got = [bytes(data[s:e]).decode() for s, e in zip(starts, ends)]
    want = [(k, w) for k, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert [(int(r), w) for r, w in zip(rows, got)] == want


def test_word_hashes_tell_words_apart_and_fold_case():
    data, offsets = textnp.buffer_of(pa.array(["The cat THE act", "the tac É é"]))
    hashes = textnp.word_table(data, offsets)[0]
    assert hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 6


def test_repeated_strings_against_brute_force():
    rng = random.Random(5)
    length, gram = 20, 7
    for trial in range(25):
        base = bytes(rng.choice(b"abcd") for _ in range(60))
        texts = []
        for _ in range(12):
            t = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 80)))
            if rng.random() < 0.4:
                i = rng.randint(0, 30)
                t += base[i:i + rng.randint(10, 40)] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30)))
            elif rng.random() < 0.1:
                t = b"a" * rng.randint(0, 60)
            texts.append(t)
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
        chunk = rng.choice([37, 1000])
        by_gram = defaultdict(list)
        for first in range(0, len(data), chunk):
            found = suffix_dedup.chunk_anchors(data, offsets, first, min(first + chunk, len(data)), length, gram)
            if found:
                for _, lo, hi, g, c in zip(*(x.tolist() for x in found)):
                    by_gram[g].append((lo, hi, c))
        got = np.zeros(len(data), bool)
        for members in by_gram.values():
            same = Counter(c for *_, c in members)
            for lo, hi, c in members:
                got[lo:hi + length] |= same[c] > 1
            starts = np.concatenate([np.arange(lo, hi + 1) for lo, hi, _ in members])
            for p in starts[suffix_dedup.repeated_windows(data, starts, np.zeros(len(starts), int), length)]:
                got[p:p + length] = True
        count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        want = np.zeros(len(data), bool)
        for t, at in zip(texts, offsets):
            for i in range(len(t) - length + 1):
                if count[t[i:i + length]] > 1:
                    want[at + i:at + i + length] = True
        assert (got == want).all(), trial


def test_sketch_estimates_high_similarity():
    rng = np.random.default_rng(1)
    for similarity in (0.6, 0.75, 0.9, 1.0):
        apart = []
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
            n = 400
            both = round(2 * n * similarity / (1 + similarity))
            mins = [near_dedup.min_hashes(np.concatenate([pool[:both], pool[both + k * (n - both):][:n - both]])) for k in (0, 1)]
            places = [(textnp.mix(m + near_dedup._SALT) % np.uint64(near_dedup.BITS)).astype(int) for m in mins]
            odd = [np.bincount(p, minlength=near_dedup.BITS) & 1 for p in places]
            z = int((odd[0] ^ odd[1]).sum())
            apart.append(1 + near_dedup.BITS / (4 * near_dedup.HASHES) * math.log(1 - 2 * z / near_dedup.BITS))
        assert abs(np.mean(apart) - similarity) < 0.02
    assert near_dedup.sketch_limit() > 0


def test_compact_windows_against_brute_force():
    rng = np.random.default_rng(2)
    low = np.uint64((1 << compact_windows.PLACE_BITS) - 1)
    for _ in range(30):
        rows = np.repeat(np.arange(4), rng.integers(0, 30, 4))
        values = rng.integers(0, 1 << 60, len(rows), dtype=np.uint64)
        keys = (values & ~low) | np.arange(len(rows), dtype=np.uint64)
        got = sorted(zip(*(x.tolist() for x in compact_windows.tree_windows(keys, rows, 6))))
        want = set()
        for i in range(len(rows)):
            for j in range(i + 5, len(rows)):
                if rows[i] == rows[j]:
                    c = i + int(np.argmin(keys[i:j + 1]))
                    left, right = c, c
                    while left and rows[left - 1] == rows[c] and keys[left - 1] > keys[c]:
                        left -= 1
                    while right + 1 < len(rows) and rows[right + 1] == rows[c] and keys[right + 1] > keys[c]:
                        right += 1
                    want.add((left, c, right))
        assert got == sorted(want)


def test_passages_survive_edits_and_ignore_chance():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 60, 120)
    words = lambda n: rng.integers(0, 1 << 60, n)
    edited = shared.copy()
    edited[40:45] = words(5)
    a = np.concatenate([words(30), shared, words(80)])
    b = np.concatenate([words(200), edited, words(10)])
    (x0, x1, y0, y1, s), = compact_windows.passages(a, b)
    assert (x0, x1, y0, y1) == (30, 150, 200, 320) and s == 115 / 125
    assert compact_windows.passages(words(300), words(300)) == []
    assert compact_windows.passages(np.concatenate([words(9), shared[:40]]), b) == []
    assert compact_windows.passages(words(0), b) == []
    two = compact_windows.passages(np.concatenate([shared[:50], words(40), shared[60:]]), shared)
    assert [(x[0], x[1]) for x in two] == [(0, 50), (90, 150)]


def _shingled(*parts):
    """Shingles of a text of random words, given as arrays."""
    return textnp.shingle_hashes(np.concatenate(parts).astype(np.uint64))


def test_passages_use_all_places_of_repeated_parts():
    rng = np.random.default_rng(13)
    words = lambda n: rng.integers(0, 1 << 60, n)
    p = words(60)
    a = _shingled(words(20), p, words(30))
    assert [x[:4] for x in compact_windows.passages(a, _shingled(words(30), p[:30], words(80), p, words(40)))] == [(20, 76, 140, 196)]
    assert [x[:4] for x in compact_windows.passages(a, _shingled(p, words(50), p))] == [(20, 76, 0, 56), (20, 76, 110, 166)]
    b = _shingled(words(5), p[:5], words(60), p[:50], words(5))
    assert [x[:4] for x in compact_windows.passages(_shingled(words(9), p[:50], words(9)), b)] == [(9, 55, 70, 116)]
    assert compact_windows.passages(_shingled(np.full(4000, 7)), _shingled(np.full(3000, 7))) == [(0, 3996, 0, 2996, 1.0)]
    found = 0
    for _ in range(40):
        p = words(50 + rng.integers(0, 15))
        edited = p.copy()
        edited[rng.integers(0, len(p), 2)] = rng.integers(1, 9, 2)
        k = rng.integers(0, 50)
        a = _shingled(words(rng.integers(4, 20)), p[:rng.integers(0, 20)], words(4), p, words(rng.integers(4, 12)))
        b = _shingled(words(rng.integers(4, 9)), p[k:k + rng.integers(0, 30)], words(rng.integers(0, 6)), edited, words(8))
        sides = [[set(x[i:i + 46].tolist()) for i in range(len(x) - 45)] for x in (a, b)]
        if any(100 * len(x & y) >= 75 * len(x | y) for x in sides[0] for y in sides[1]):
            found += 1
            assert compact_windows.passages(a, b)
    assert found > 20


def test_passages_with_long_gaps_and_edited_ends():
    rng = np.random.default_rng(14)
    words = lambda n: rng.integers(0, 1 << 60, n)
    p = words(80)
    (*span, s), = compact_windows.passages(_shingled(p), _shingled(p[:40], words(15), p[40:]))
    assert span == [0, 76, 0, 91] and s == 72 / 95
    (*span, s), = compact_windows.passages(_shingled(p[:50]), _shingled(words(1), p[1:50]))
    assert span == [0, 46, 0, 46] and s == 45 / 47
    (*span, s), = compact_windows.passages(_shingled(p[:55]), _shingled(words(3), p[3:52], words(3)))
    assert span[1] - span[0] == span[3] - span[2] == 46 and s == 45 / 47


def test_counts_of_two_texts_against_sets():
    rng = np.random.default_rng(15)
    for size, bits in ((200, 24), (40, 20), (3, 0)):  # some tell apart by their lowest bits only
        for _ in range(20):
            a, b = (rng.integers(0, size, rng.integers(1, 120)).astype(np.uint64) << np.uint64(bits) for _ in range(2))
            both = compact_windows._Both(compact_windows._Sorted(a), compact_windows._Sorted(b))
            x, y = (np.sort(rng.integers(0, len(t) + 1, (2, 30)), axis=0) for t in (a, b))
            sets = [(set(a[x0:x1].tolist()), set(b[y0:y1].tolist())) for x0, x1, y0, y1 in zip(*x, *y)]
            assert both.a.held(*x).tolist() == [len(s) for s, _ in sets] and both.b.held(*y).tolist() == [len(t) for _, t in sets]
            if len(both.first_a):
                assert both.shared(*x, *y).tolist() == [len(s & t) for s, t in sets]
            for x0, x1, y0, y1, (s, t) in zip(*x.tolist(), *y.tolist(), sets):
                assert both.a.held_within(x0, x1) == len(s)
                if len(both.first_a):
                    assert both.shared_within(x0, x1, y0, y1) == len(s & t)


def test_many_runs_that_no_passage_can_hold_make_no_spans(monkeypatch):
    rng = np.random.default_rng(17)
    made, spans = [], compact_windows._spans
    monkeypatch.setattr(compact_windows, "_spans", lambda *x: made.append(len(x[0])) or spans(*x))
    ended = 0
    for own in (18, 22, 26):
        a, b = (np.concatenate([rng.permutation(np.append(np.arange(30), low + np.arange(own))) for _ in range(12)]) for low in (100, 200))
        a, b = a.astype(np.uint64), b.astype(np.uint64)
        before, got = len(made), compact_windows.passages(a, b)
        monkeypatch.setattr(compact_windows, "_any_passage", lambda *x: True)
        assert compact_windows.passages(a, b) == got
        monkeypatch.undo()
        monkeypatch.setattr(compact_windows, "_spans", lambda *x: made.append(len(x[0])) or spans(*x))
        ended += not got and len(made) == before + 1 and made[-1] > compact_windows.FEW
    assert ended


def test_equal_texts_are_searched_once(monkeypatch):
    rng = np.random.default_rng(16)
    text = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 1 << 30, n))
    p = text(60)
    a, b, c = f"{text(9)} {p}", f"{p} {text(7)}", f"{text(5)} {p}"
    calls, search = [], compact_windows.passages
    monkeypatch.setattr(compact_windows, "passages", lambda *x, **named: calls.append(1) or search(*x, **named))
    rows = pa.RecordBatch.from_pydict({"a": [1, 1, 1, 2], "b": [3, 4, 5, 6], "text_a": [a, a, a, c], "text_b": [b, c, b, b]})
    (got,) = compact_windows._confirm(iter([rows]))
    assert [(r["match_doc_id"], r["doc_id"], r["match_start_word"], r["start_word"]) for r in got.to_pylist()] == [
        (1, 3, 9, 0), (1, 4, 9, 5), (1, 5, 9, 0), (2, 6, 5, 0)]
    assert len(calls) == 3


def test_top_k_against_brute_force():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(120)]
    texts = [" ".join(rng.choice(vocabulary[:rng.choice([5, 30, 120])]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts[7] = texts[200] = texts[201]
    held = [(f + row, w, c) for f, _, row, w, c in bm25_search.term_counts(pa.array(texts))]
    row, words, counts = (np.concatenate(x) for x in zip(*held))
    lengths = np.bincount(row, counts, len(texts))
    average, n = lengths.sum() / len(texts), len(texts)
    df = dict(zip(*(x.tolist() for x in np.unique(words, return_counts=True))))
    ids = np.arange(n) * 3
    for common in (2, 12, 1000):
        bm25_search.COMMON, was = common, bm25_search.COMMON
        index = bm25_search.ShardIndex(ids, lengths, row, words, counts, average)
        bm25_search.COMMON = was
        for q in range(0, n, 9):
            mine = words[row == q]
            idf = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in mine.tolist()}
            score = defaultdict(int)
            for d, t, c in zip(row.tolist(), words.tolist(), counts.tolist()):
                if t in idf:
                    score[d * 3] += round(1e6 * idf[t] * (c * 2.2 / (c + 1.2 * (0.25 + 0.75 * lengths[d] / average))))
            want = sorted((-s, d) for d, s in score.items())[:10]
            got_ids, got, _ = index.top(mine, np.array([idf[t] for t in mine.tolist()]), 10)
            assert [(-int(s), int(d)) for s, d in zip(got, got_ids)] == want


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(sentencepiece_codec.load_model())


def test_bpe_encoding_equals_the_library(codec):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    rng = random.Random(6)
    texts = ["", " ", "Hello  world \n x", "a\tb　c", "\U0001f389 日本語", " " * 41 + "x" + " " * 7, "x\x00y", "a" * 500]
    texts += ["".join(rng.choice(" abcdethinors\n▁é日.,") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for t in texts:
        ids = codec.encode(t)
        assert ids.tolist() == library.encode(t), t
        assert codec.decode(ids) == library.decode(ids.tolist()) == t.replace("▁", " ")


def test_unigram_encoding_is_the_best_segmentation():
    rng = random.Random(7)
    pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 4))) for _ in range(25)} | {"a", "b", "▁"}
    model = {"kind": "unigram", "prefix": True, "pieces": (("<unk>", 0.0, 2),) + tuple(
        (p, -rng.random() * len(p) - 0.5, 1) for p in sorted(pieces))}
    codec = sentencepiece_codec.Codec(model)
    score = {p: s for p, s, t in model["pieces"] if t == 1}

    def best(text):
        out = [0.0] + [-1e9] * len(text)
        for j in range(1, len(text) + 1):
            out[j] = max(out[i] + score.get(text[i:j], -1e9 if j - i > 1 else codec.floor) for i in range(max(0, j - 4), j))
        return out[-1]

    for _ in range(300):
        text = "".join(rng.choice("aab c") for _ in range(rng.randint(1, 14)))
        marked = "▁" + text.replace(" ", "▁")
        found = codec.viterbi(marked)
        assert "".join(found) == marked
        assert abs(sum(score.get(p, codec.floor) for p in found) - best(marked)) < 1e-9
        if "c" not in text:
            assert codec.decode(codec.encode(text)) == text


def test_blocks_of_odd_markup():
    text = lambda h: [b[0] for b in html_text.blocks(h)]
    assert text(None) == text("") == text("<script>var t='</p>'") == []
    assert text("<p>a &lt; b &amp c &#x41;<br>d\n e") == ["a < b & c A d e"]
    assert text("x<!-- no --><style>p{}</style> y<p>z</artic") == ["x y", "z"]
    flags = [(b[0], b[3], b[4]) for b in html_text.blocks(
        '<div class="ad"><p>1<p>2</div><main><header><h1>3</h1></header><p class=ad>4<p>5<nav>6</nav></main><header>7</header>')]
    assert flags == [("1", True, False), ("2", True, False), ("3", False, True), ("4", True, True), ("5", False, True),
                     ("6", True, True), ("7", True, False)]


def test_names_do_not_overrule_main_elements():
    flags = lambda h: [(b[0], b[3]) for b in html_text.blocks(h)]
    assert flags('<main class="site-main has-sidebar"><p>a</p><section id="discussion"><h2 id="search">b</h2><p>c</p></section>'
                 '<section id="related-work">d</section><div class="sidebar">e</div><section role="complementary">f</section>'
                 '</main>') == [("a", False), ("b", False), ("c", False), ("d", False), ("e", True), ("f", True)]
    assert flags('<article class="post category-social"><p>a</p></article><div class="post category-social">b</div>') == [
        ("a", False), ("b", False)]
    assert flags('<article data-title="the hidden cost" title="display: none"><p>a</p></article><div class="b-hidden">b</div>'
                 '<article hidden><p>c</p></article><p aria-hidden=true>d</p><p style="color:red;display:none">e</p>') == [
        ("a", False), ("b", False), ("c", True), ("d", True), ("e", True)]
    assert flags('<section id="comments">a</section><div id="share-buttons">b</div><h2 id="search">c</h2>') == [
        ("a", True), ("b", True), ("c", False)]


def test_raw_elements_end_at_their_own_tag():
    text = lambda h: [b[0] for b in html_text.blocks(h)]
    assert text('<p>a<svg width="3" data-x="1>0"/>b</p><svg><path d="x"/></svg><p>c</p>') == ["ab", "c"]
    assert text("<iframe src=http://x/>gone</iframe><p>a</p><script src=x />b") == ["a", "b"]
    assert text("<datalist><option value=1>x<option value=2>y</datalist><p>a</p><option>z<p>b</p>") == ["a", "b"]
    assert text("<select><option>x</select><p>a</p><option selected>y <i>z</i></option>b") == ["a", "b"]


def test_both_arc_versions_convert_to_equivalent_records():
    body = "<p>é</p>\r\n\r\n\n".encode()
    message = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\nX-Page-Id: 7\r\n\r\n" % len(body) + body
    records = []
    for version in (1, 2):
        data = arc_to_warc.arc_bytes([("http://a/%20b", message), ("dns:a", b"20240101 a 1.2.3.4")], version)
        arcs = list(arc_to_warc.parse_arc(data))
        assert [a["version"] for a in arcs] == [version] * 3 and arcs[1]["body"] == message
        out = b"".join(arc_to_warc.warc_record(a) + arc_to_warc.END.encode() for a in arcs)
        found = list(arc_to_warc.parse_warc(out))
        assert [h["warc-type"] for h, _ in found] == ["warcinfo", "response", "resource"]
        assert found[1][0]["warc-date"] == "2024-01-01T00:00:00Z" and found[1][1] == message
        assert found[1][0]["warc-payload-digest"] == "sha1:" + arc_to_warc.digest(body)
        records.append([h["warc-record-id"] for h, _ in found][1:])
        revisit = next(arc_to_warc.parse_warc(arc_to_warc.warc_record(arcs[1], "9") + arc_to_warc.END.encode()))
        assert revisit[0]["warc-type"] == "revisit" and revisit[1] == message[:-len(body)]
        assert revisit[0]["warc-refers-to"] == arc_to_warc.record_id("9", arc_to_warc.digest(body))
    assert records[0] == records[1]
    with pytest.raises(ValueError):
        list(arc_to_warc.parse_arc(data[:-9]))
