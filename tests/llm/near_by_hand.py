"""Near-duplicate groups by comparing all pairs, for small tables."""

import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def components_by_hand(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in sets}
