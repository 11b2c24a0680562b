"""Plain versions of operators, for small tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, linked):
    """{node: smallest node that chains of links reach} by comparing all pairs."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in parent}


def simhash(text):
    import xxhash

    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
