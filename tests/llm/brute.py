"""Plain versions of what the operators compute, for small inputs."""

import re


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def classes(ids, links):
    """Smallest reachable id of each id."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    return {i: find(i) for i in ids}


def near_classes(docs, size, percent):
    """{id: class} of (id, text) rows under Jaccard >= percent / 100."""
    sets = [(i, shingles(t, size)) for i, t in docs]
    links = []
    for n, (a, x) in enumerate(sets):
        for b, y in sets[n + 1 :]:
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((a, b))
    return classes([i for i, _ in docs], links)
