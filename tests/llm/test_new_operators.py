import random
from collections import Counter

import brute_new as brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from touchline.llm import conversation_repair, ptolemaic, target_ratio
from touchline.llm.bytes_text import NONSPACE, find_words, text_slices
from touchline.llm.queries import QUERIES, read_table

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    read_table(spark, SF, "documents")


# --- target_ratio


def texts():
    rng = random.Random(3)
    words = "The cat sat on a mat and saw # the dog | eat <b> soup & 100% été $5".split()
    out = [None, "", " \n\t", "one", "\n\n a \n a\n a \n", "x " * 40, "y" * 100_000, "a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "ß ç " * 9, "a b c d\x0be f g h\ra b c d e f g h"]
    for n in (5, 19, 20, 21, 60, 300, 5000):
        out.append(" ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(n)))
        out.append("\n".join(rng.choice(out[3:]) for _ in range(4)))
    return out


def test_base_counts():
    given = texts()
    batch = pa.RecordBatch.from_arrays([pa.array(given)], ["text"])
    got = []
    for _, buf, offsets in text_slices([batch]):
        found = target_ratio.base_counts(buf, offsets, find_words(buf, offsets, NONSPACE))
        got += list(zip(*(found[b].tolist() for b in target_ratio.BASE), strict=True))
    assert got == [brute.base_counts(t) for t in given]


def _bucket(gram):
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(gram)])], ["text"])
    (_, buf, offsets), = text_slices([batch])
    return int(target_ratio.grams(find_words(buf, offsets, NONSPACE))[1][-1])


@pytest.fixture(scope="module")
def judged(spark):
    given = list(enumerate(texts())) + [(3, "again " * 30), (None, texts()[-1])]
    documents = spark.createDataFrame([(d, t, "x", True) for d, t in given], "doc_id long, text string, score string, kept boolean")
    marks = [(d, 1 if d % 3 else 0) for d in range(len(given))] + [(4, None), (None, 1), (999, 1), (5, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    return given, documents.repartition(3), labels, marks


def test_ratio_is_that_of_the_counted_multinomials(spark, judged, monkeypatch):
    given, documents, labels, marks = judged
    ratio = target_ratio.train(documents, labels)
    good = {d for d, q in marks if q == 1 and d is not None and brute.zlib.crc32(str(d).encode()) % 3 != 1}
    buckets = {g: _bucket(g) for _, t in given for g in set(brute.grams_of(t))}
    raw = Counter(buckets[g] for _, t in given for g in brute.grams_of(t))
    target = Counter(buckets[g] for d, t in given if d in good for g in brute.grams_of(t))
    got = target_ratio.judge(documents, ratio).collect()
    want = {}
    for d, t in given:
        base = brute.base_counts(t)
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        score = brute.mean_log_ratio(t, target, raw, target_ratio.BUCKETS, buckets.__getitem__)
        want.setdefault((d, *base, failed, len(brute.grams_of(t))), score)
    assert len(got) == len(given)
    for r in got:
        score = want[(r.doc_id, *(r[b] for b in target_ratio.BASE), r.base_failed, r.n_grams)]
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= ratio.threshold)
    left = target_ratio.keep_good(documents, ratio)
    assert left.columns == documents.columns and left.count() == sum(r.kept for r in got)


def test_without_texts_or_labels(spark, judged):
    _, documents, labels, _ = judged
    assert target_ratio.train(documents, labels.limit(0)) is None
    assert target_ratio.train(documents.limit(0), labels) is None
    assert target_ratio.judge(documents.limit(0), None).count() == 0
    assert all(r.kept != r.base_failed and r.score == 0 for r in target_ratio.judge(documents, None).collect())


def test_labelled_junk_goes_and_good_texts_stay(spark):
    folder = "/root/testdata/sf0.1"
    table = pq.read_table(f"{folder}/labels.parquet").to_pylist()
    good = {r["doc_id"]: r["quality"] for r in table if brute.zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    judged = {r.doc_id: r for r in QUERIES["op11_target_ratio"](spark, folder).collect()}
    by = {q: [judged[d] for d, label in good.items() if label == q and not judged[d].base_failed] for q in (0, 1)}
    assert min(len(x) for x in by.values()) > 100
    assert np.mean([r.kept for r in by[1]]) >= 0.99
    assert np.mean([not r.kept for r in by[0]]) >= 0.95


# --- conversation_repair


def conversations():
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", None, "sys", "assistant", "user", "user", "assistant"]
    said = ["Yes.", "No!", "Well", "", " \n", None, "Is it?  \n", "So it is.", "a:b\nc.", "...", "Über…", "Fine. "]
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 6)):
            out.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(said) if rng.random() < 0.5 else f"Line {turn} of {conv}."))
    out += [(100, t, "user", "Same text.") for t in range(12)] + [(101, 1, "user", "Twice.")] * 3
    out += [(102, t, roles[t % 2], f"Turn {t}." if t % 7 else "cut") for t in range(300)]
    return out


def conversation_frame(spark, given):
    return spark.createDataFrame([(*r, "x", 1) for r in given], "conv_id long, turn long, role string, text string, audit string, part int")


def run_repair(frame, **limits):
    return rows(conversation_repair.digests(conversation_repair.repair(conversation_repair.damage(frame), **limits)))


def test_best_repair_is_the_least_of_all():
    given = [r for r in conversations() if r[0] is not None and r[0] < 60]
    tried = 0
    for kept in brute.damaged(given).values():
        if len(kept) <= 3:
            found = brute.faults(kept)
            assert brute.best_repair(kept, found) == min(brute.all_repairs(kept, found), key=lambda w: w[:2])
            tried += 1
    assert tried > 15


@pytest.mark.parametrize("limits", [{}, {"piece_rows": 7}, {"piece_bytes": 40}])
def test_repairs(spark, limits):
    given = conversations()
    frame = conversation_frame(spark, given).repartition(6)
    got = run_repair(frame, **limits)
    want = brute.repairs(given)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert got == want


def test_repairs_where_audits_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(conversation_repair, "FREQUENT", 3)
    given = conversations()
    assert run_repair(conversation_frame(spark, given).repartition(2)) == brute.repairs(given)


def test_repairs_of_a_table_and_of_nothing(spark):
    table = pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()
    assert rows(QUERIES["op12_conversation_repair"](spark, SF)) == brute.repairs([tuple(r.values()) for r in table])
    assert run_repair(conversation_frame(spark, [])) == []


def test_repaired_messages_are_whole(spark):
    given = [r for r in conversations() if r[0] is not None]
    pieces = conversation_repair.repair(conversation_repair.damage(conversation_frame(spark, given)), piece_rows=10).orderBy("conv_id", "piece").collect()
    got = {}
    for p in pieces:
        got.setdefault(p.conv_id, []).extend((m.role, m.text) for m in p.messages)
    assert got == {c: brute.best_repair(x, brute.faults(x))[2] for c, x in brute.damaged(given).items()}


# --- ptolemaic


def vectors(dims):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(6)]
    out = [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(centres)]) for i in range(150)]
    out += [(200 + i, out[0][1]) for i in range(20)] + [(300, [0.0] * dims), (301, [-1 / 512] * dims), (302, [1000.0] * dims)]
    out += [(400, None), (401, []), (402, [0.0] * (dims - 1)), (403, [0.0] * dims + [1.0]), (404, [float("nan")] * dims), (405, [float("-inf")] * dims), (406, [1e30] * dims)]
    out += [(407, [None, *[0.0] * (dims - 1)]), (None, out[3][1]), (None, out[4][1]), (5, out[9][1]), (5, out[9][1])]
    return out


@pytest.mark.parametrize("pairs,k", [(6, 40), (1, 7), (0, 5), (3, 1), (3, 500)])
def test_clusters(spark, monkeypatch, pairs, k):
    monkeypatch.setattr(ptolemaic, "PIVOT_PAIRS", pairs)
    monkeypatch.setattr(ptolemaic, "BLOCK", 50)
    given = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors(8)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in given], "vec_id long, embedding array<float>, cluster int, x string").repartition(5)
    assert rows(ptolemaic.cluster(frame, k=k, dims=8)) == brute.clusters(given, k=k, dims=8)


def test_clusters_of_nothing(spark):
    frame = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert rows(ptolemaic.cluster(frame)) == [] == rows(ptolemaic.cluster(frame.limit(0)))


def test_bounds_never_exceed_distances_and_prune():
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (40, 64))
    x = centres[rng.integers(0, 40, 2000)] + rng.integers(-200, 200, (2000, 64))
    index = ptolemaic.Index(ptolemaic.pivot_pairs(centres), centres)
    low, high = index.known(x)
    bounds = ptolemaic.lower_bounds(low, high, index.c_low, index.c_high, index.pair_high)
    exact = ptolemaic.distances(x, centres)
    assert (bounds <= exact).all()
    which, distance, compared = index.nearest(x, low, high)
    assert (which == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert compared < 0.2 * exact.size


def test_all_trusted_texts_count(spark, monkeypatch):
    """However many there are; the threshold is the exact quantile of their scores."""
    n = 32_000
    documents = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("two words").alias("text"))
    labels = documents.select("doc_id", F.lit(1).alias("quality"))
    trusted = sum(brute.zlib.crc32(str(d).encode()) % 3 != 1 for d in range(n))
    assert trusted > 20_000
    sums, plain = [], target_ratio.log_ratio
    monkeypatch.setattr(target_ratio, "log_ratio", lambda target, raw: sums.append((target.sum(), raw.sum())) or plain(target, raw))
    target_ratio.train(documents, labels)
    assert max(sums) == (3 * trusted, 3 * n)  # two words and a pair each
    values = np.random.default_rng(5).normal(size=3001)
    scores = spark.createDataFrame([(float(v),) for v in values], "score double").repartition(4)
    for share in (0.0, 0.001, 0.37, 1.0):
        assert target_ratio._quantile(scores, share) == pytest.approx(np.quantile(values, share), abs=1e-12)
