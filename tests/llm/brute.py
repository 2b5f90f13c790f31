"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONSPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text, pattern=ALNUM):
    return pattern.findall(lower(text))


def shingles(text, n=4):
    found = words(text, NONSPACE)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1)))


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_components(docs, similar, n):
    """Shingles of each row (doc_id, text), and the component that it is in."""
    sets = [shingles(text, n) for _, text in docs]
    links = [
        (i, j)
        for i, x in enumerate(sets)
        for j in range(i)
        if x and sets[j] and 100 * len(x & sets[j]) >= similar * len(x | sets[j])
    ]
    return sets, components(len(docs), links)


def near_kept(docs, similar=85, n=4):
    """The rows that stay where each component keeps its smallest doc_id; ids that a component has twice
    must be of equal sets."""
    sets, of = near_components(docs, similar, n)
    first = {}
    for (doc_id, _), c in sorted(zip(docs, of, strict=True), key=lambda r: (r[0][0] is None, r[0][0] or 0)):
        first.setdefault(c, doc_id)
    return [r for r, s, c in zip(docs, sets, of, strict=True) if not s or r[0] == first[c]]


def near_copies(docs, similar=85, n=4):
    """(doc_id, n_shingles, component_id) of rows (doc_id, text), sorted."""
    sets, of = near_components(docs, similar, n)
    least = defaultdict(list)
    for (doc_id, _), c in zip(docs, of, strict=True):
        least[c].append(doc_id)
    smallest = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    rows = [(d, len(s), smallest[c] if s else d) for (d, _), s, c in zip(docs, sets, of, strict=True)]
    return sorted(rows, key=repr)


def exact_copies(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[lower(text)].append(doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items()}


def contamination(docs, items, window=13, one_in=20):
    windows = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i : i + k])].add(str(item_id))
    rows = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if names := windows.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= names
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        rows.append((doc_id, len(w), len(hit), len(found), sha, bool(hit) and one_in * len(hit) >= len(w)))
    return sorted(rows, key=repr)


def license_phrases(text, phrases):
    w = words(text)
    return len(w), sorted((i, label) for phrase, label in phrases.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())


def token_rows(docs, tokenizer, end_id):
    """(doc_id, ids with the end id) by doc_id and text."""
    ordered = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    encoded = tokenizer.encode_batch([t or "" for _, t in ordered], add_special_tokens=False)
    return [(d, np.array([*e.ids, end_id], "<u4")) for (d, _), e in zip(ordered, encoded, strict=True)]


def crc(ids):
    return zlib.crc32(ids.tobytes())


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_counts(docs):
    return Counter(" ".join(line.split()) for _, text in docs for line in lower(text).split("\n"))
