"""Plain Python versions of the operators' results."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def linked_components(docs):
    """{id: (set size, least linked id)} for (id, text)."""
    sets = []
    for _, t in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    inverted, parent = defaultdict(list), list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in inverted[g])
        for g in s:
            inverted[g].append(i)
        for j, k in shared.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)}
