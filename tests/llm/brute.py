"""Plain single-machine versions of what the operators compute."""

import hashlib
import re
from collections import Counter, defaultdict


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated_strings(docs, span):
    """docs: (doc_id, text) rows. (doc_id, n_bytes, n_removed, n_spans, sha) sorted."""
    bodies = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(b[k : k + span] for _, b in bodies for k in range(len(b) - span + 1))
    out = []
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if count[b[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out, key=str)


def earlier_passages(docs, span):
    first = {}
    rows = sorted(((i, (t or "").encode().split()) for i, t in docs), key=lambda r: (r[0] is not None, r[0]))
    for i, w in rows:
        for k in range(len(w) - span + 1):
            first.setdefault(tuple(w[k : k + span]), (i, k))
    out = []
    for i, w in rows:
        gone = [False] * len(w)
        for k in range(len(w) - span + 1):
            if first[tuple(w[k : k + span])] != (i, k):
                gone[k : k + span] = [True] * span
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def simhash_groups(docs, shingle=4, radius=4):
    import xxhash

    prints = []
    for i, t in docs:
        words = (t or "").encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + shingle]), 42) for k in range(max(1, len(words) - shingle + 1))] if words else []
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= radius:
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, f"{p:016x}", least.get(root(k))) for k, (i, p) in enumerate(prints)), key=str)


def mix_targets(docs, weights=(5, 2, 1), share=1.5, most=2):
    """docs: (source, size) rows. {source: (size, target)}."""
    sizes = defaultdict(int)
    for s, n in docs:
        sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        for s in over or free:
            target[s] = most * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free -= set(over or free)
    return {s: (sizes[s], target[s]) for s in names}
