"""Plain loops that the operators must agree with."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import numpy as np

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digest(spans) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def secrets(text):
    """Base spans (kind, start, end) by start, then kind."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [
        (m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20
    ]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def luhn(digits: str) -> bool:
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def personal(text):
    """Base spans (kind, start, end) by kind, then start."""
    text = text or ""
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [
        ("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))
    ]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def entities(text):
    """{entity: first place} and the spans they stand in."""
    found = {}
    for kind, a, b in sorted(personal(text), key=lambda x: x[1]):
        value = text[a:b].lower()
        if kind in ("card", "phone"):
            value = re.sub("[^0-9]", "", value)
        found.setdefault((kind, value), a)
    return found


def disclosing_spans(texts, generalise=1.0, remove=0.4, z=1.645):
    """Per text the spans (kind, start, end) of terms that disclose an entity of it."""
    inside = [[(a, b) for _, a, b in personal(text)] for text in texts]
    words = []
    for text, spans in zip(texts, inside):
        found = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"\w+", text or "")]
        words.append([w for w in found if not any(a < w[2] and w[1] < b for a, b in spans)])
    using = collections.Counter(w for text in texts for w in {m.lower() for m in re.findall(r"\w+", text or "")})
    held = [entities(text) for text in texts]
    holders = collections.defaultdict(list)
    for at, found in enumerate(held):
        for name in found:
            holders[name].append(at)
    records = collections.defaultdict(list)
    for name, places in holders.items():
        records[tuple(places)].append(name)
    kinds = collections.defaultdict(dict)
    for places, names in records.items():
        contexts = {}
        for at in places:
            first = min(held[at][name] for name in names)
            before = [w[0] for w in words[at] if w[1] < first][-10:]
            contexts[at] = (*before, *[w[0] for w in words[at] if w[1] >= first][:10])
        for term in {w[0] for at in places for w in words[at]}:
            together = [at for at in places if any(w[0] == term for w in words[at])]
            k = len({contexts[at] for at in together})
            n = k + using[term] - len(together)
            p = k / n
            low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            left = round(-math.log2(low), 9)
            if left <= generalise and -math.log2(len(places) / len(texts)) - left >= 1:
                for at in together:
                    kind = "remove" if left <= remove else "general"
                    kinds[at][term] = max(kind, kinds[at].get(term, ""))
    return [[(kinds[at][w], a, b) for w, a, b in found if w in kinds[at]] for at, found in enumerate(words)]


class Groups:
    def __init__(self, names):
        self.parent = {x: x for x in names}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def near_documents(rows, shingle=4):
    """{doc_id: (number of shingles, component)} over all pairs that share a shingle."""
    sets = {}
    for name, text in rows:
        words = (text or "").encode().lower().split()
        n = min(shingle, len(words))
        sets[name] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    holders = collections.defaultdict(list)
    for name, grams in sets.items():
        for gram in grams:
            holders[gram].append(name)
    shared = collections.Counter()
    for names in holders.values():
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                shared[a, b] += 1
    groups = Groups(sets)
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            groups.link(a, b)
    return {name: (len(grams), groups.root(name)) for name, grams in sets.items()}


def usable(vector) -> bool:
    return bool(
        vector
        and all(x is not None and math.isfinite(x) for x in vector)
        and any(vector)
    )


def near_vectors(rows, cosine=0.93):
    """Sorted [(vec_id, links, component)] over all pairs of rows (vec_id, embedding, label)."""
    places = collections.defaultdict(list)
    for at, (_, vector, label) in enumerate(rows):
        if label is not None and usable(vector):
            places[label, len(vector)].append(at)
    groups, links = Groups(range(len(rows))), collections.Counter()
    for own in places.values():
        units = np.array([rows[at][1] for at in own], np.float64)
        units /= np.abs(units).max(axis=1, keepdims=True)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(units @ units.T >= cosine, 1))):
            groups.link(own[a], own[b])
            links[own[a]] += 1
            links[own[b]] += 1
    least = {}
    for at, (name, _, _) in enumerate(rows):
        if name is not None:
            root = groups.root(at)
            least[root] = min(least.get(root, name), name)
    found = [(row[0], links[at], least.get(groups.root(at))) for at, row in enumerate(rows)]
    return sorted(found, key=str)


def nearest_rows(rows, k=20):
    """{query: [(vec_id, score)]} for rows (vec_id, embedding) whose vec_id 20 divides."""
    rows = [(name, vector) for name, vector in rows if name is not None and usable(vector)]
    names = np.array([name for name, _ in rows])
    vectors = np.array([vector for _, vector in rows], np.float64)
    found = {}
    for at in np.flatnonzero(names % 20 == 0):
        scores = vectors @ vectors[at]
        order = [i for i in np.lexsort((names, -scores)) if names[i] != names[at]][:k]
        found[int(names[at])] = [(int(names[i]), scores[i]) for i in order]
    return found


def water_filled(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets of sources: by weight, capped, the excess shared again until none is above."""
    names = sorted(x for x in sizes if x is not None) + ([None] if None in sizes else [])
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [name for name in names if name not in capped]
        rest = total - sum(most * sizes[name] for name in capped)
        target = {name: float(most * sizes[name]) for name in capped}
        target |= {n: rest * weight[n] / sum(weight[x] for x in free) for n in free}
        above = {name for name in free if target[name] > most * sizes[name]}
        if not above:
            return target
        capped |= above
