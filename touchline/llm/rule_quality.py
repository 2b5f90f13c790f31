"""Quality by a sparse ensemble of rules.

Each text is described by statistics: lengths, shares of kinds of characters, repetition of words
and lines. Boosted trees on a bounded sample of labelled rows supply candidate rules: every path
from the root is a conjunction of bounds on statistics. A lasso logistic regression over all rules
gives most of them no weight; the others are compiled to Spark column expressions, whose sum is
the score's logit. Statistics are counted on the texts' bytes, batch by batch, and the rules run in
Spark.

A null or empty text has all statistics 0. Null labels and labels without a document are left out;
of several labels of a document the largest counts. With labels of one kind only, or none, every
score is the share of good labels (0.5 without any). Extra columns are ignored, repeated rows give
a row each.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.bytes_text import NONSPACE, find_words, text_slices, word_hashes
from touchline.llm.pu_toxicity import fold

FOLDS, HELD_OUT = 3, 1
#: Labelled rows at most that the rules are fitted to, chosen by a hash of doc_id.
LABELLED = 12_000
TREES, DEPTH, BINS, LEAST_LEAF = 24, 3, 24, 8
RATE = 0.3
PENALTY = 0.002
STEPS = 400

STATISTICS = (
    "n_chars",
    "n_words",
    "word_length",
    "longest_word",
    "upper_share",
    "digit_share",
    "symbol_share",
    "other_share",
    "bar_words",
    "mark_share",
    "symbol_words",
    "distinct_words",
    "top_word",
    "same_as_last",
    "n_lines",
    "distinct_lines",
    "line_words",
    "comma_share",
    "stop_share",
    "distinct_pairs",
)


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return np.diff(total[offsets]).astype(float)


def statistics(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of each text. Lengths of words and shares of ASCII marks go by bytes, the share of
    other characters by characters."""
    words = find_words(buf, offsets, NONSPACE)
    hashes, n = word_hashes(words), len(offsets) - 1
    n_words = words.counts.astype(float)
    some = np.maximum(n_words, 1)
    n_chars = _per_text((buf & 0xC0) != 0x80, offsets)
    chars, size = np.maximum(n_chars, 1), np.maximum(np.diff(offsets), 1)
    lengths = (words.ends - words.starts).astype(float)
    owner = words.texts()
    lines = find_words(buf, offsets, np.arange(256) != 10)
    line_hashes = word_hashes(lines)
    heads = buf[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    tails = buf[words.ends - 1] if len(words.starts) else np.zeros(0, np.uint8)
    symbol = np.isin(buf, list(b"#$%&*@^~<>{}[]\\/=+_|`"))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    pairs = hashes.copy()
    pairs[1:] = hashes[1:] * np.uint64(31) + hashes[:-1]
    distinct, top, distinct_lines, distinct_pairs = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    longest = np.zeros(n)
    for i, (a, b, c, d) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), lines.first[:-1].tolist(), lines.first[1:].tolist(), strict=True)):
        if b > a:
            _, counts = np.unique(hashes[a:b], return_counts=True)
            distinct[i], top[i] = len(counts), counts.max()
            distinct_pairs[i] = len(np.unique(pairs[a:b]))
            longest[i] = lengths[a:b].max()
        if d > c:
            distinct_lines[i] = len(np.unique(line_hashes[c:d]))
    n_lines = lines.counts.astype(float)

    def mean(values):
        return np.bincount(owner, values, n) / some

    return {
        "n_chars": n_chars,
        "n_words": n_words,
        "word_length": mean(lengths),
        "longest_word": longest,
        "upper_share": _per_text((buf >= 65) & (buf <= 90), offsets) / size,
        "digit_share": _per_text((buf >= 48) & (buf <= 57), offsets) / size,
        "symbol_share": _per_text(symbol, offsets) / size,
        "other_share": _per_text(buf >= 0xC0, offsets) / chars,
        "bar_words": mean((heads == ord("|")) & (lengths == 1)),
        "mark_share": _per_text(buf == ord("!"), offsets) / size,
        "symbol_words": mean(np.isin(tails, list(b"#$%&*@^~<>|!"))),
        "distinct_words": np.where(n_words > 0, distinct / some, 0),
        "top_word": top / some,
        "same_as_last": mean(same),
        "n_lines": n_lines,
        "distinct_lines": np.where(n_lines > 0, distinct_lines / np.maximum(n_lines, 1), 0),
        "line_words": n_words / np.maximum(n_lines, 1),
        "comma_share": _per_text((buf == ord(",")) | (buf == ord(".")), offsets) / size,
        "stop_share": mean(lengths <= 3),
        "distinct_pairs": np.where(n_words > 0, distinct_pairs / some, 0),
    }


class Rule(NamedTuple):
    """A conjunction: (statistic, True if above else at or below, bound)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, above, bound in self.conditions:
            out &= (x[name] > bound) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, bound in self.conditions:
            out = out & (F.col(name) > bound if above else F.col(name) <= bound)
        return out


class Ensemble(NamedTuple):
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def logit(self) -> Column:
        out = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            out = out + F.when(rule.column(), weight).otherwise(0.0)
        return out


def _tree(binned: np.ndarray, bounds: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, names) -> list[tuple[tuple, np.ndarray, float]]:
    """Leaves and inner nodes below the root: path, rows, value. Best splits by gain."""
    out, todo = [], [((), np.arange(len(gradient)))]
    while todo:
        path, rows = todo.pop()
        g, h = gradient[rows].sum(), weight[rows].sum()
        if path:
            out.append((path, rows, g / (h + 1.0)))
        if len(path) >= DEPTH or len(rows) < 2 * LEAST_LEAF:
            continue
        best = (1e-6, None, None)
        for f in range(binned.shape[1]):
            size = len(bounds[f]) + 1
            if size < 2:
                continue
            b = binned[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(b, w, size))[:-1] for w in (gradient[rows], weight[rows], np.ones(len(rows))))
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(nl < LEAST_LEAF) | (len(rows) - nl < LEAST_LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[1] is not None:
            _, f, k = best
            above = binned[rows, f] > k
            bound = float(bounds[f][k])
            todo.append(((*path, (names[f], False, bound)), rows[~above]))
            todo.append(((*path, (names[f], True, bound)), rows[above]))
    return out


def _lasso(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient."""
    n, k = x.shape
    x = x.astype(np.float64)
    step = 4.0 / max(1e-9, np.linalg.norm(x, 2) ** 2 / n + 1)
    w = z = np.zeros(k)
    b = zb = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    t = 1.0
    for _ in range(STEPS):
        r = 1 / (1 + np.exp(-np.clip(x @ z + zb, -30, 30))) - y
        w2 = z - step * (x.T @ r) / n
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * PENALTY, 0)
        b2 = zb - step * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def fit_rules(x: dict[str, np.ndarray], y: np.ndarray) -> Ensemble:
    """Trees for candidates, lasso for weights."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Ensemble([], [], float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    names = list(x)
    bounds = [np.unique(np.quantile(x[c], np.linspace(0, 1, BINS + 1)[1:-1])) for c in names]
    # Bounds on rare values count too: quantiles alone would miss a share of a few hundredths.
    bounds = [np.unique(np.concatenate([b, np.quantile(x[c], [0.005, 0.01, 0.02, 0.98, 0.99, 0.995])])) for b, c in zip(bounds, names, strict=True)]
    binned = np.stack([np.searchsorted(b, x[c], "left") for b, c in zip(bounds, names, strict=True)], axis=1)
    logit, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        nodes = _tree(binned, bounds, y - p, p * (1 - p), names)
        inner = {path[:-1] for path, _, _ in nodes}
        for path, rows, value in nodes:
            rules.setdefault(tuple(sorted(path)), None)
            if path not in inner:
                logit[rows] += RATE * value
    found = [Rule(path) for path in rules]
    holds = np.stack([r.holds(x) for r in found], axis=1) if found else np.zeros((len(y), 0), bool)
    _, distinct = np.unique(holds, axis=1, return_index=True)
    found, holds = [found[i] for i in sorted(distinct)], holds[:, sorted(distinct)]
    weights, intercept = _lasso(holds, y.astype(float))
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    return Ensemble([found[i] for i in kept], [float(weights[i]) for i in kept], intercept)


def with_statistics(documents: DataFrame, *columns: str) -> DataFrame:
    """The named columns and the statistics of each text."""

    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            found = statistics(buf, offsets)
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in columns), *(pa.array(found[s], pa.float64()) for s in STATISTICS)], [*columns, *STATISTICS])

    chosen = documents.select(*columns, "text")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]), *(f"{s} double" for s in STATISTICS)])
    return chosen.mapInArrow(run, schema)


def train(documents: DataFrame, labels: DataFrame) -> Ensemble:
    """Rules from at most LABELLED labelled rows outside the held-out fold."""
    known = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.max("quality").cast("double").alias("good"))
    known = known.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(LABELLED)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most LABELLED ids
    rows = with_statistics(texts, "good").toPandas()
    return fit_rules({s: rows[s].to_numpy() for s in STATISTICS}, rows["good"].to_numpy())


def score_quality(documents: DataFrame, ensemble: Ensemble) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    scored = with_statistics(keyed, "doc_id", "held_out").withColumn("score", 1 / (1 + F.exp(-ensemble.logit())))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
