"""Plain definitions that the operators' results are held against."""

import re

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    """Union-find whose root is the least member."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def white_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size):
    words = white_words((text or "").translate(FOLD))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def jaccard(docs, size, percent):
    sets = {i: shingles(t, size) for i, t in docs.items()}
    groups = Groups(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                groups.link(a, b)
    return {i: (len(sets[i]), groups.root(i)) for i in ids}


def kept_words(docs, size=20):
    seen, out = set(), {}
    for i in sorted(docs):
        words = white_words(docs[i])
        gone = [False] * len(words)
        for p in range(len(words) - size + 1):
            window = tuple(words[p : p + size])
            if window in seen:
                gone[p : p + size] = [True] * size
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), kept)
    return out


def kept_bytes(docs, length=50):
    seen, out = set(), {}
    for i in sorted(docs):
        data, own = (docs[i] or "").encode(), set()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            part = data[p : p + length]
            if part in seen:
                gone[p : p + length] = [True] * length
            own.add(part)
        seen |= own
        spans = sum(g and (not p or not gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), spans, kept)
    return out


def contaminated(docs, items, size=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))

    windows = []
    for item, text in items:
        all_words = words(text)
        if all_words and item is not None:
            for p in range(max(len(all_words) - size + 1, 1)):
                windows.append((item, all_words[p : p + size]))
    out = {}
    for i, text in docs.items():
        own, hit, found = words(text), set(), set()
        for item, window in windows:
            for p in range(len(own) - len(window) + 1):
                if own[p : p + len(window)] == window:
                    hit |= set(range(p, p + len(window)))
                    found.add(str(item))
        out[i] = (len(own), len(hit), sorted(found))
    return out
