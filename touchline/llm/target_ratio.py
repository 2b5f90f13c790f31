"""Quality rules: plain counts, and the log-likelihood ratio of two hashed n-gram multinomials.

Words are maximal runs of everything but ASCII white space. Two multinomials over BUCKETS hashed
words and word pairs (A-Z lower-cased) are counted: one over trusted texts (the target), one over
all texts of the corpus (raw). A text's score is the mean, over its words and pairs, of the log of
their smoothed target share over their smoothed raw share; taking the mean makes long and short
texts comparable. A text is kept if its score reaches a threshold, the same for every text; nothing
is drawn at random. The threshold is the score that all but REFUSED of the trusted texts reach when
each half of them is scored by the other half's multinomial.

The trusted texts are all that `labels` marks as good, outside the held-out fold. Every count covers
all its texts, and the threshold all their scores.

Base counts of a text: code points in words, symbols, lines with a word that equal an earlier line,
and words in windows of WINDOW words that stand twice or more in the text. A text with few words or
many repeated ones fails whatever its score. Equality of words and lines is that of 64-bit hashes.

A null, empty or blank text has no words and fails. Without trusted texts the ratio decides nothing:
texts are kept unless the base counts fail. Labels that are null or have no document are left out;
of several labels of a document the largest counts. Repeated rows, and rows that share a doc_id or
have none, give a row each; extra columns are ignored or, by `keep_good`, carried along.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.bytes_text import NONSPACE, Words, find_words, runs_of, text_slices, word_hashes
from touchline.llm.pu_toxicity import fold
from touchline.session import settle

WINDOW = 8
LEAST_WORDS = 20
#: Hundredths of a text's words that may stand in repeated windows.
REPEATED = 30

BUCKETS = 1 << 16
#: Count added to every bucket of both multinomials.
SMOOTHING = 1.0
#: Share of the trusted texts that the threshold may refuse.
REFUSED = 0.001
FOLDS, HELD_OUT = 3, 1

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUTPUT = f"doc_id long, {', '.join(f'{b} long' for b in BASE)}, base_failed boolean, kept boolean, score double, n_grams long"

_BYTES = np.arange(256)
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_LINE = _BYTES != 10
_BEGINS = (_BYTES & 0xC0) != 0x80  # first bytes of code points


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])


def _repeated_lines(buf: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, by text."""
    lines = find_words(buf, offsets, _LINE)
    worded = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    owner, hashes = lines.texts()[worded], word_hashes(lines, lower=False)[worded]
    order = np.lexsort((hashes, owner))
    same = (np.diff(owner[order]) == 0) & (hashes[order][1:] == hashes[order][:-1])
    return np.bincount(owner[order][1:][same], minlength=len(offsets) - 1)


def _repeated_words(words: Words, window: int) -> np.ndarray:
    """Words in windows that stand twice or more in their text, by text."""
    grams = runs_of(word_hashes(words, lower=False), window)
    owner = words.texts()
    if not len(grams):
        return np.zeros(len(words.first) - 1, np.int64)
    inside = owner[: len(grams)] == owner[window - 1 :]
    place = np.flatnonzero(inside)
    order = place[np.lexsort((grams[place], owner[place]))]
    same = (np.diff(owner[order]) == 0) & (grams[order][1:] == grams[order][:-1])
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    change = np.zeros(len(owner) + 1, np.int64)
    np.add.at(change, order[again], 1)
    np.add.at(change, order[again] + window, -1)
    return np.bincount(owner[np.cumsum(change[:-1]) > 0], minlength=len(words.first) - 1)


def base_counts(buf: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """The counts of BASE, by text."""
    return {
        "n_words": words.counts,
        "word_chars": _per_text(_BEGINS[buf] & NONSPACE[buf], offsets),
        "n_symbols": _per_text(_SYMBOL[buf], offsets),
        "n_dup_lines": _repeated_lines(buf, offsets, words),
        "n_repeat_words": _repeated_words(words, WINDOW),
    }


def grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every word and every pair of neighbours."""
    hashes, owner = word_hashes(words), words.texts()
    pairs = runs_of(hashes, 2)
    inside = owner[: len(pairs)] == owner[len(owner) - len(pairs) :]
    bucket = np.concatenate([hashes, pairs[inside]]) % np.uint64(BUCKETS)
    return np.concatenate([owner, owner[: len(pairs)][inside]]), bucket.astype(np.int64)


class Ratio(NamedTuple):
    """log(target share / raw share) of each bucket, and the least score that is kept."""

    weights: np.ndarray
    threshold: float

    def scores(self, owner: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """The mean weight of each text's words and pairs; 0 without any."""
        total, counts = np.bincount(owner, self.weights[bucket], n), np.bincount(owner, minlength=n)
        return total / np.maximum(counts, 1)


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Weights of two counted multinomials."""
    share = (target + SMOOTHING) / (target.sum() + SMOOTHING * len(target))
    return np.log(share) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * len(raw)))


def _counted(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs. Tasks send what they counted, at most BUCKETS rows each."""

    def count(batches):
        totals = np.zeros(BUCKETS, np.int64)
        for _, buf, offsets in text_slices(batches):
            totals += np.bincount(grams(find_words(buf, offsets, NONSPACE))[1], minlength=BUCKETS)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], ["bucket", "n"])

    counts = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, rows = np.zeros(BUCKETS), counts.toPandas()
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return out


def _scored(texts: DataFrame, ratio: Ratio) -> DataFrame:
    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            score = ratio.scores(*grams(find_words(buf, offsets, NONSPACE)), rows.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(score)], ["score"])

    return texts.select("text").mapInArrow(run, "score double")


def _quantile(scores: DataFrame, share: float) -> float:
    """The score below which a share of all lies, between two neighbours in proportion; exact.

    Only the lowest share of the rows is sorted, and two of them come to the driver.
    """
    place = (scores.count() - 1) * share
    below = int(place)
    near = [r["score"] for r in scores.orderBy("score").offset(below).limit(2).collect()]
    return near[0] + (near[-1] - near[0]) * (place - below)


def train(documents: DataFrame, labels: DataFrame) -> Ratio | None:
    """The ratio of trusted texts to all; None without trusted texts."""
    good = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.max("quality").alias("good"))
    good = good.filter((F.col("good") == 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    # There is no bound on the ids, so they are never broadcast; what is moved grows as the texts do.
    chosen = good.select("doc_id", half).hint("merge")
    trusted = settle(documents.select("doc_id", "text").join(chosen, "doc_id").select("text", "half"))
    halves = [trusted.filter(F.col("half") == k) for k in (0, 1)]
    counts = [_counted(h) for h in halves]
    target = counts[0] + counts[1]
    if not target.any():
        return None
    raw = _counted(documents)
    crossed = settle(_scored(halves[0], Ratio(log_ratio(counts[1], raw), 0.0)).union(_scored(halves[1], Ratio(log_ratio(counts[0], raw), 0.0))))
    return Ratio(log_ratio(target, raw), _quantile(crossed, REFUSED))


def _judged(rows: int, buf: np.ndarray, offsets: np.ndarray, ratio: Ratio | None):
    """Base counts, whether they fail, whether the text is kept, its score and its words and pairs."""
    words = find_words(buf, offsets, NONSPACE)
    base = base_counts(buf, offsets, words)
    failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > REPEATED * base["n_words"])
    owner, bucket = grams(words)
    score = np.zeros(rows) if ratio is None else ratio.scores(owner, bucket, rows)
    kept = ~failed if ratio is None else ~failed & (score >= ratio.threshold)
    return base, failed, kept, score, np.bincount(owner, minlength=rows)


def judge(documents: DataFrame, ratio: Ratio | None) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, score and n_grams of every whole text."""

    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            base, failed, kept, score, n_grams = _judged(rows.num_rows, buf, offsets, ratio)
            columns = [rows["doc_id"].cast(pa.int64()), *(pa.array(base[b].astype(np.int64)) for b in BASE), pa.array(failed), pa.array(kept), pa.array(score), pa.array(n_grams)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, "base_failed", "kept", "score", "n_grams"])

    return documents.select("doc_id", "text").mapInArrow(run, OUTPUT)


def keep_good(documents: DataFrame, ratio: Ratio | None) -> DataFrame:
    """The documents that are kept, with all columns."""

    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            yield rows.filter(pa.array(_judged(rows.num_rows, buf, offsets, ratio)[2]))

    return documents.mapInArrow(run, documents.schema)
