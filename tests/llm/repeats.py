"""Repeated windows of words, in plain Python."""


def removed_by_hand(rows, window):
    texts = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    least = {}
    for i, words in texts:
        for k in range(len(words) - window + 1):
            if i is not None:
                w = tuple(words[k:k + window])
                least[w] = min(least.get(w, i), i)
    out = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and least[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=repr)
