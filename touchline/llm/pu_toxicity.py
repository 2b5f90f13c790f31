"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples are positive; what else is read is unlabelled, toxic texts among it.
With the share of toxic texts (the class prior) known, the risk of a classifier follows from both:
prior * loss on positives + max(0, loss of 'clean' on unlabelled - prior * loss of 'clean' on
positives); the floor at zero keeps the second part from being fitted below what it can be.

Features are words and the beginnings of words (3 to 6 bytes, for inflected or glued-on forms),
hashed to BUCKETS, each present in a text or not. Of them the FEATURES that are most over- or
under-represented in the positives against the unlabelled texts are kept, and a linear classifier
is fitted in numpy to bounded samples; scoring is one pass over all texts.

A null or empty text scores by the intercept alone. Labels that are null, repeated for a document
(the largest counts), or without a document are handled as missing. Without positive examples
every score is 0. Extra columns are ignored, repeated rows give a row each.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.bytes_text import ALNUM, FIRST, LOWER, Words, find_words, mixed, text_slices, word_hashes
from touchline.session import settle

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6)
#: Rows at most that the classifier is fitted to, chosen by a hash of doc_id.
POSITIVES = 6_000
UNLABELLED = 12_000
FEATURES = 3_000
#: Least |z| of a feature's frequency in positives against unlabelled.
LEAST_Z = 4.0
LEAST_ROWS = 3
EPOCHS = 600

FOLDS = 5
OUTPUT = "doc_id long, held_out boolean, score double, predicted int"


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each feature that a text has, once each."""
    hashes = [word_hashes(words)]
    texts = [words.texts()]
    padded = np.zeros(len(words.buf) + 8, np.uint8)
    padded[:-8] = LOWER[words.buf]
    eights = np.ndarray(len(words.buf) + 1, "<u8", padded, strides=(1,))
    heads, lengths = eights[words.starts], words.ends - words.starts
    for n in PREFIXES:
        longer = lengths > n
        hashes.append(mixed((heads[longer] & FIRST[n]) * np.uint64(2 * n + 1) + np.uint64(n)))
        texts.append(texts[0][longer])
    code = np.unique(np.concatenate(texts) * BUCKETS + (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64))
    return code // BUCKETS, code % BUCKETS


class Classifier(NamedTuple):
    buckets: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def scores(self, text: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        if not len(self.buckets):
            return np.zeros(n)
        at = np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)
        known = self.buckets[at] == bucket
        z = self.bias + np.bincount(text[known], self.weights[at[known]], n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, n_columns: int, prior: float, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Non-negative risk, sigmoid loss, Adam on the full sample. rows and columns: the features that
    are present; positive: by row."""
    n = len(positive)
    weights, bias = np.zeros(n_columns), -1.0
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    m, v = np.zeros(n_columns + 1), np.zeros(n_columns + 1)
    for step in range(1, epochs + 1):
        z = bias + np.bincount(rows, weights[columns], n)
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        slope = s * (1 - s)
        # loss of being called clean: s; of being called toxic: 1 - s
        clean_part = s[~positive].sum() / n_u - prior * s[positive].sum() / n_p
        grad = np.where(positive, -prior / n_p * slope, 0.0)
        part = np.where(positive, -prior / n_p * slope, slope / n_u)
        grad = grad + part if clean_part >= 0 else -part
        g = np.append(np.bincount(columns, grad[rows], n_columns) + 1e-5 * weights, grad.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def fold(doc_id, folds: int):
    """A document's fold, by its id's checksum; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def _sample(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Texts to learn from, with `positive`; and the class prior. Fold 0 takes no part."""
    known = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(fold(F.col("doc_id"), FOLDS) != 0)
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    order = F.xxhash64("doc_id", F.lit("sample"))
    positive = known.filter("toxic = 1").select("doc_id").orderBy(order, "doc_id").limit(POSITIVES)
    others = documents.select("doc_id").filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
    others = others.distinct().orderBy(order, "doc_id").limit(UNLABELLED)
    chosen = positive.withColumn("positive", F.lit(True)).unionByName(others.withColumn("positive", F.lit(False)))
    # At most POSITIVES + UNLABELLED ids.
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return settle(sample.select("text", "positive")), float(share or 0.0)


def train(documents: DataFrame, labels: DataFrame) -> Classifier:
    """A classifier from bounded samples of the training folds."""
    sample, prior = _sample(documents, labels)

    def count(batches):
        totals = np.zeros((2, BUCKETS), np.int64)
        for rows, buf, offsets in text_slices(batches):
            text, bucket = features(find_words(buf, offsets, ALNUM))
            positive = rows["positive"].to_numpy(zero_copy_only=False)[text]
            totals[0] += np.bincount(bucket[positive], minlength=BUCKETS)
            totals[1] += np.bincount(bucket[~positive], minlength=BUCKETS)
        seen = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[0][seen]), pa.array(totals[1][seen])], ["bucket", "n_p", "n_u"])

    sizes = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    n_p, n_u = (int(x or 0) for x in sizes)
    if not n_p or not n_u or not prior:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), 0.0)
    counts = sample.mapInArrow(count, "bucket long, n_p long, n_u long").groupBy("bucket").agg(F.sum("n_p").alias("n_p"), F.sum("n_u").alias("n_u"))
    pooled = (F.col("n_p") + F.col("n_u")) / (n_p + n_u)
    z = F.abs(F.col("n_p") / n_p - F.col("n_u") / n_u) / F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + 1e-12)
    best = counts.filter(F.col("n_p") + F.col("n_u") >= LEAST_ROWS).select("bucket", z.alias("z")).filter(F.col("z") >= LEAST_Z)
    buckets = np.sort(np.array([r.bucket for r in best.orderBy(F.desc("z"), "bucket").limit(FEATURES).collect()], np.int64))

    def chosen(batches):
        for rows, buf, offsets in text_slices(batches):
            text, bucket = features(find_words(buf, offsets, ALNUM))
            at = np.minimum(np.searchsorted(buckets, bucket), max(0, len(buckets) - 1))
            known = buckets[at] == bucket if len(buckets) else np.zeros(len(bucket), bool)
            parts = np.split(at[known], np.searchsorted(text[known], np.arange(1, rows.num_rows)))
            yield pa.RecordBatch.from_arrays([rows["positive"], pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))], ["positive", "columns"])

    rows = sample.mapInArrow(chosen, "positive boolean, columns array<int>").collect()
    positive = np.array([r.positive for r in rows], bool)
    which = np.repeat(np.arange(len(rows)), [len(r.columns) for r in rows])
    columns = np.array([c for r in rows for c in r.columns], np.int64)
    weights, bias = fit(which, columns, positive, len(buckets), prior)
    return Classifier(buckets, weights, bias)


def score_toxicity(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""

    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            score = classifier.scores(*features(find_words(buf, offsets, ALNUM)), rows.num_rows)
            yield pa.RecordBatch.from_arrays([rows["doc_id"].cast(pa.int64()), rows["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held_out = fold(F.col("doc_id"), FOLDS) == 0
    return documents.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(run, OUTPUT)


def drop_toxic(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """The documents that score below one half, with all columns."""

    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            score = classifier.scores(*features(find_words(buf, offsets, ALNUM)), rows.num_rows)
            yield rows.filter(pa.array(score < 0.5))

    return documents.mapInArrow(run, documents.schema)
