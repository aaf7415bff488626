"""Plain-Python statements of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def union_find(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if 0 < len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def near_duplicates(rows, threshold=(85, 100)):
    """``{id: (n_shingles, component)}`` of ``(id, text)`` rows, linked from
    a similarity of ``threshold`` up."""
    num, den = threshold
    sets = {d: shingles(t) for d, t in rows}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    links = []
    for d, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for e in holders[x]:
                if e < d:
                    common[e] += 1
        links += [(e, d) for e, i in common.items() if den * i >= num * (len(s) + len(sets[e]) - i)]
    comp = union_find(sets, links)
    return {d: (len(sets[d]), comp[d]) for d in sets}


def remove_repeats(rows, length=100):
    """``{id: (n_bytes, n_removed, n_spans, sha256)}`` of ``(id, text)`` rows."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len([m for m in re.finditer(b"\x01+", bytes(gone))])
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def lm_base(rows, folds=7, held=2):
    """``{id: (held_out, n_tokens, n_known, train_tokens, base_score)}``."""
    import math
    import zlib
    from collections import Counter
    toks = {d: WORD.findall((t or "").translate(LOWER)) + [None] for d, t in rows}
    fold = {d: zlib.crc32(str(d).encode()) % folds for d in toks}
    c = Counter(w for d, ws in toks.items() if fold[d] != held for w in ws)
    n, v = sum(c.values()), len(c)
    return {d: (fold[d] == held, len(ws), sum(c[w] > 0 for w in ws), n,
                sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for d, ws in toks.items()}
