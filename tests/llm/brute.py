"""Plain versions of the contracts, a row at a time."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BLANKED = re.compile("[^\x20\x09-\x0d]+")
sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(CAPITALS))


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def op2(docs, path):
    import numpy as np
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    out = {}
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.decode(ids, skip_special_tokens=False)))
    return out


def op6(docs):
    how = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    out = {}
    for i, text in docs:
        found = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(how) for m in p.finditer(text or "") if len(m[g]) >= n]
        names = [f"{how[k][0]}:{a}:{b}" for a, k, b in sorted(found)]
        out[i] = (*(sum(k == x[1] for x in found) for k in range(3)), sha(",".join(names)), names)
    return out


def op7(docs, n=200):
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[s : s + n] for _, b in raw for s in range(len(b) - n + 1))
    out = {}
    for i, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            if seen[b[s : s + n]] > 1:
                gone[s : s + n] = b"\1" * n
        runs = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def op8(docs):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    out = {}
    for i, text in docs:
        w = words(text)
        at = {p: [k for k in range(len(w)) if w[k : k + len(p.split())] == p.split()] for p in phrases}
        every = sorted(x for v in at.values() for x in v)
        out[i] = (len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(phrases[p] for p, v in at.items() if v)))
    return out


def op9(docs, n=3, percent=85):
    sets = {}
    for i, text in docs:
        w = BLANKED.findall((text or "").translate(CAPITALS))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    shared = Counter()
    at = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            shared.update((j, i) for j in at[g])
            at[g].append(i)
    links = [(a, b) for (a, b), k in shared.items() if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k)]
    c = components(sets, links)
    return {i: (len(s), c[i], c[i] == i) for i, s in sets.items()}


def op10(docs, items, window=10):
    tests = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        w = words(text)
        if w and name is not None:
            m = min(window, len(w))
            for k in range(len(w) - m + 1):
                tests[m][tuple(w[k : k + m])].add(str(name))
    out = {}
    for i, text in docs:
        w = words(text)
        hit, names = [0] * len(w), set()
        for m, d in tests.items():
            for k in range(len(w) - m + 1):
                if (found := d.get(tuple(w[k : k + m]))) is not None:
                    names |= found
                    hit[k : k + m] = [1] * m
        out[i] = (len(w), sum(hit), len(names), sha(",".join(sorted(names))), any(hit))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def op12(docs, items, most=20):
    import math

    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    terms = lambda t: term.findall((t or "").translate(CAPITALS))
    bags = {i: Counter(terms(t)) for i, t in docs}
    bags = {i: b for i, b in bags.items() if b}
    n_docs, n_terms = len(bags), sum(sum(b.values()) for b in bags.values())
    df = Counter(t for b in bags.values() for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
    out = {}
    for item, text in items:
        scores = []
        for i, b in bags.items():
            m = 75 + (25 * sum(b.values()) * n_docs) // n_terms
            score = sum(weight[t] * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if score > 0:
                scores.append((-score, i))
        if scores:
            out[item] = [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:most])]
    return out


def _aligned(text, a, b, bytes_a, bytes_b):
    """((id, start, end) of both tokenizers' tokens), or None."""
    raw = b" " + (text or "").encode()
    found = []
    for ids, of in ((a, bytes_a), (b, bytes_b)):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(of(i))))
            at += len(of(i))
        found.append(spans)
        if b"".join(map(of, ids)) != raw:
            return None
    return found


def _both(rows, path_a, path_b):
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers

    t = Tokenizer.from_file(path_a)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=path_b)
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    char = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    assert set(char) == set(pre_tokenizers.ByteLevel.alphabet())
    bytes_a = lambda i: bytes(char[c] for c in t.id_to_token(i))
    bytes_b = lambda i: bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode()
    return {i: _aligned(text, t.encode(" " + text, add_special_tokens=False).ids, s.encode(text), bytes_a, bytes_b) if text else None for i, text in rows}


def links_of(rows, path_a, path_b):
    out = {}
    for i, found in _both(rows, path_a, path_b).items():
        links = []
        if found:
            a, b = found
            first = 0
            for x, s, e in a:
                while b[first][2] <= s:
                    first += 1
                k = first
                while k < len(b) and b[k][1] < e:
                    links.append((x, b[k][0]))
                    k += 1
        out[i] = links
    return out


def op13(rows, path_a, path_b):
    links = links_of(rows, path_a, path_b)
    count = Counter(p for doc in links.values() for p in doc)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = {}
    for i, found in _both(rows, path_a, path_b).items():
        if not found:
            out[i] = (0, 0, 0, 0, 0, 0, "")
            continue
        a, b = found
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(x) for x, s, e in side if lo <= s and e <= hi) for side in (a, b)))
            lo = hi
        mine = links[i]
        out[i] = (len(a), len(b), len(cuts), len(mine), sum(count[p] == best[p[1]] for p in mine), sum(count[p] for p in mine), sha(";".join(groups)))
    return out
