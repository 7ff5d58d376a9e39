"""Plain computations that several tests compare with."""

import re


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def components_by_all_pairs(texts, width=4, percent=80):
    """Least connected id of every id, by comparing all pairs of shingle sets."""
    sets = {i: shingles(t, width) for i, t in texts}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = {i: i for i in sets}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                moved = True
    return comp
