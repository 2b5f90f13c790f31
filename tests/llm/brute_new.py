"""Plain Python versions of target_ratio, conversation_repair and ptolemaic, for small tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

from brute import NONSPACE

SPACE = " \t\n\x0b\x0c\r"


def base_counts(text, window=8):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = NONSPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if NONSPACE.search(x)]
    grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(window)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def mean_log_ratio(text, target, raw, buckets, bucket_of):
    """target, raw: counters of buckets; bucket_of: of a tuple of lower-cased words."""
    grams = grams_of(text)
    share = lambda counts, b: (counts[b] + 1) / (sum(counts.values()) + buckets)
    return sum(math.log(share(target, b) / share(raw, b)) for b in map(bucket_of, grams)) / len(grams) if grams else 0.0


def grams_of(text):
    words = NONSPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [(w,) for w in words] + list(itertools.pairwise(words))


def damaged(rows):
    """(conv_id, turn, role, text) rows to the damaged rows by conversation, in order."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        copies = 1
        if kind == 0:
            copies = 0
        elif kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 3:
            copies = 2
        elif kind == 4:
            role = "user"
        out[conv_id] += [(turn, role, text)] * copies
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, x in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_repairs(rows, found):
    """Every way with at most two insertions in a row: (cost, audit, messages)."""
    inserts = [()] + [(r,) for r in ("user", "assistant")] + list(itertools.product(("user", "assistant"), repeat=2))
    ways = [[(3 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserts]]
    for (_, role, text), fault in zip(rows, found, strict=True):
        edits = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            edits += [(more, "K", [(role, text)])] + [(3 + more, "R", [(r, text)]) for r in ("user", "assistant")]
        ways += [edits, ways[0]]
    for chosen in itertools.product(*ways):
        messages = [m for c in chosen for m in c[2]]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in messages)):
            yield sum(c[0] for c in chosen), "".join(c[1] for c in chosen), messages


def best_repair(rows, found):
    """By a shortest path that carries whole audits; for conversations of any length."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", []), "a": (0, "", [])}

    def inserted(best):
        for _ in range(3):
            for q in ("", "s", "u", "a"):
                to, role = ("a", "assistant") if q == "u" else ("u", "user")
                if to in best:
                    c, audit, m = best[to]
                    way = (c + 3, "I" + audit, [(role, ""), *m])
                    best[q] = min(best.get(q, way), way, key=lambda w: w[:2])
        return best

    best = inserted(best)
    for (_, role, text), fault in reversed(list(zip(rows, found, strict=True))):
        new = {}
        for q in ("", "s", "u", "a"):
            ways = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                for r, name, cost in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    to = after.get((q, r[:1]))
                    if to is not None:
                        ways.append((best[to][0] + cost + more, name + best[to][1], [(r, text), *best[to][2]]))
            new[q] = min(ways, key=lambda w: w[:2])
        best = inserted(new)
    return best[""]


def repairs(rows, best=best_repair):
    """op12's rows, sorted."""
    out = []
    for conv_id, kept in damaged(rows).items():
        found = faults(kept)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(kept))
        cost, audit, messages = best(kept, found)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()
        out.append((conv_id, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def clusters(rows, k=40, rounds=5, dims=64, seed="2", limit=1 << 26):
    """op13's rows, sorted."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(256 * x) <= limit for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v]))
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for i, m in members.items():
            centroids[i] = [sum(col) // len(m) for col in zip(*m, strict=True)]
    found = [(vec_id, *nearest(v)) for vec_id, v in kept]
    inertia = Counter()
    for _, d, i in found:
        inertia[i] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((vec_id, i, d, inertia[i], sum(inertia.values()), sha[i]) for vec_id, d, i in found), key=repr)
