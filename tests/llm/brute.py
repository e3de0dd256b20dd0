"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(docs):
    """doc_id -> smallest doc_id reachable, of (doc_id, text) rows."""
    sets = {d: shingles(t) for d, t in docs if d is not None}
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def repeats(texts, length):
    """Whether each byte of each text is covered by a string that also starts elsewhere."""
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append(gone)
    return out


def stats(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, symbols = len(w), len(re.findall(r"[#*$%&|<>]", text))
    chars, duplicates = sum(map(len, w)), len(lines) - len(set(lines))
    base = n < 10 or 100 * len(covered) > 20 * n
    bad = (base or 100 * symbols > 5 * chars or 100 * duplicates > 50 * len(lines)
           or 100 * len(re.findall("[A-Z]", text)) > 60 * len(re.findall("[A-Za-z]", text))
           or 100 * text.count("!") > 50 * n or 100 * sum(a == b for a, b in zip(w, w[1:])) > 30 * n)
    return n, chars, symbols, duplicates, len(covered), base, not bad


def without_lines(docs):
    """doc_id -> (lines, removed, spans, text) of (doc_id, text) rows with distinct ids."""
    seen, gone = set(), defaultdict(set)
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        lines = (t or "").split("\n")
        for i in range(len(lines) - 2):
            key = tuple(lines[i:i + 3])
            if not any(WORD.search(x) for x in key):
                continue
            if key in seen:
                gone[d].update(range(i, i + 3))
            seen.add(key)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        spans = sum(i in gone[d] and i - 1 not in gone[d] for i in range(len(lines)))
        out[d] = (len(lines), len(gone[d]), spans, "\n".join(x for i, x in enumerate(lines) if i not in gone[d]))
    return out


def targets(sizes):
    """source -> target words, by resharing the excess until none is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return share | fixed
        fixed |= {s: float(3 * sizes[s]) for s in over}


def mixed(docs):
    """(doc_id, size, source_size, target, taken, first position) of (doc_id, text, source) rows."""
    def invert(u, rank):
        if rank % 3 == 1:
            return u
        a, mid, slope = ((1.5, 0.625, -1.0), None, (0.5, 0.375, 1.0))[rank % 3]
        if u <= mid:
            return 2 * u / (a + (a * a + 2 * slope * u) ** 0.5)
        return 0.5 + 2 * (u - mid) / (1 + max(0.0, 1 + 2 * slope * (u - mid)) ** 0.5)

    size = [len(words(t)) for _, t, _ in docs]
    sizes = defaultdict(int)
    for (_, _, s), n in zip(docs, size):
        sizes[s] += n
    target, out = targets(sizes), []
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    for s in names:
        rows = sorted((hashlib.md5(f"mix|{'null' if d is None else d}".encode()).hexdigest(), d, n)
                      for (d, _, x), n in zip(docs, size) if x == s)
        before, full = 0, int(target[s] // sizes[s]) if sizes[s] else 0
        for _, d, n in rows:
            middle = before + n / 2
            copies = full + (middle < target[s] - full * sizes[s])
            u = min(1.0, middle / target[s]) if target[s] else 0.0
            out.append((d, n, sizes[s], target[s], n * copies, copies, [
                invert(min(1.0, (k * sizes[s] + middle) / target[s]) if target[s] else 0.0, names.index(s)) for k in range(copies)]))
            before += n
    return out
