"""Plain Python versions of the contracts, for small tables."""

import collections
import hashlib
import math
import re
import zlib


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base_counts(t):
    w, t = words(t), t or ""
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[i: i + 8]) for i in range(len(w) - 7))
    hit = [0] * len(w)
    for i in range(len(w) - 7):
        if n[tuple(w[i: i + 8])] > 1:
            hit[i: i + 8] = [1] * 8
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, sum(hit)


def shingles(t, k=3):
    w = words(lower(t))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def similarity_components(docs, percent=90):
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def leaks(docs, items, window=10):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    windows = {}
    for name, text in items:
        w = split(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i: i + k]), set()).add(str(name))
    out = {}
    for d, t in docs:
        w = split(t)
        hit, names = [0] * len(w), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if found := windows.get(tuple(w[i: i + k])):
                    names |= found
                    hit[i: i + k] = [1] * k
        out[d] = (len(w), sum(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), any(hit))
    return out


def kept_lines(docs, min_chars=40, min_docs=5):
    def key(x):
        return lower(x.strip(" \t\n\x0b\x0c\r"))

    holders = collections.defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or d == max(holders[key(x)])]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


SECRETS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def secrets(t):
    spans = [(m.start(), k, m.end()) for k, (_, r, g, n) in enumerate(SECRETS) for m in r.finditer(t or "") if len(m[g]) >= n]
    return [(SECRETS[k][0], s, e) for s, k, e in sorted(spans)]


def crc(t):
    return zlib.crc32((t or "").encode())


def gear_chunks(text):
    """(first byte, end, words) of the chunks of a text, byte by byte."""
    from notelab.llm import substring_dedup as sd

    raw, h, hashes = (text or "").encode(), 0, []
    for i, b in enumerate(raw):
        h = sum(int(sd.GEAR[raw[i - j]]) << j for j in range(min(sd.WINDOW, i + 1))) & 0xFFFFFFFF
        hashes.append(h)
    spans = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    zero = [(hashes[e - 1] >> (sd.WINDOW - sd.CUT_BITS)) % (1 << sd.CUT_BITS) == 0 for _, e in spans]
    cut = [z and not any(zero[max(0, i - sd.MIN_WORDS + 1): i]) for i, z in enumerate(zero)]
    out, begin = [], 0
    for i, c in enumerate(cut):
        if c or i == len(cut) - 1 or i - begin == sd.MAX_WORDS - 1:
            out.append((spans[begin][0], spans[i][1], i - begin + 1))
            begin = i + 1
    return out


def without_passages(docs, min_words=16):
    """Text and dropped words per document."""
    chunks = {d: gear_chunks(t) for d, t in docs}
    raw = {d: (t or "").encode() for d, t in docs}
    first = {}
    for d in sorted(chunks):
        for i, (s, e, _) in enumerate(chunks[d]):
            first.setdefault(raw[d][s:e], (d, i))
    out = {}
    for d, t in docs:
        later = [first[raw[d][s:e]] != (d, i) for i, (s, e, _) in enumerate(chunks[d])]
        keep, dropped, i = bytearray(b"\x01" * len(raw[d])), 0, 0
        while i < len(later):
            j = i
            while j < len(later) and later[j]:
                j += 1
            words_ = sum(n for _, _, n in chunks[d][i:j])
            if words_ >= min_words:
                s, e = chunks[d][i][0], chunks[d][j][0] if j < len(chunks[d]) else chunks[d][j - 1][1]
                keep[s:e] = bytes(e - s)
                dropped += words_
            i = max(j, i + 1)
        out[d] = (dropped, bytes(b for b, k in zip(raw[d], keep, strict=True) if k).decode())
    return out


def kneser_ney_evidence(train, texts, min_keyness=-1.0, discount=0.75):
    """train: (text, toxic 0 or 1); difference of the two log-likelihoods per word of each text."""
    take = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    prefix = lambda w: [("p", w.encode()[:4])] if len(w.encode()) > 4 else []
    n, docs = ([collections.Counter(), collections.Counter()] for _ in range(2))
    left, total, size = collections.defaultdict(set), [0, 0], [0, 0]
    for text, y in train:
        w = take(text)
        own = [x for i, a in enumerate(w) for x in [*prefix(a), ("w", a), *([("b", w[i - 1], a)] if i else [])]]
        n[y].update(own)
        docs[y].update(set(own))
        total[y] += len(w)
        size[y] += 1
        for i in range(1, len(w)):
            for x in [*prefix(w[i]), ("w", w[i])]:
                left[x].add(w[i - 1])

    def differs(x):
        d, out = [docs[y][x] for y in (0, 1)], 0.0
        for k, m in zip(d, size, strict=True):
            out += k * math.log(k / m / (sum(d) / sum(size))) if k else 0.0
            out += (m - k) * math.log((1 - k / m) / (1 - sum(d) / sum(size))) if k < m else 0.0
        return sum(d) > 0 and 2 * out >= min_keyness

    singles = sum(x[0] != "b" for x in n[0].keys() | n[1].keys())
    types = sum(x[0] == "w" for x in n[1])
    follows = collections.defaultdict(list)
    for x, k in n[1].items():
        if x[0] == "b":
            follows[x[1]].append(k)

    def single(x, y):
        return max(n[y][x] - discount, 0) / total[y] + discount * types / total[1] * (len(left[x]) + 1) / (sum(total) + singles)

    def pair(v, w, y):
        lower_order = single(("w", w), y)
        if not n[y]["w", v]:
            return lower_order
        weight = discount * len(follows[v]) / sum(follows[v]) if v in follows else 1.0
        return max(n[y]["b", v, w] - discount, 0) / n[y]["w", v] + weight * lower_order

    out = []
    for text in texts:
        w, value = take(text), 0.0
        for i, a in enumerate(w):
            if i and differs(("b", w[i - 1], a)):
                value += math.log(pair(w[i - 1], a, 1) / pair(w[i - 1], a, 0))
            else:
                x = next((x for x in [("w", a), *prefix(a)] if differs(x)), None)
                value += math.log(single(x, 1) / single(x, 0)) if x else 0.0
        out.append(value / max(len(w), 1))
    return out
