"""Plain versions that several tests share."""


def shingle_sets(texts, size):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        out.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    return out


def components(names, sets, percent):
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(names)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, n in enumerate(names):
        groups.setdefault(find(i), set()).add(n)
    return list(groups.values())
