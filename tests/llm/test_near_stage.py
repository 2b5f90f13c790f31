"""The near_dedup stage against brute force with its own five words and 0.8."""

import random

from brute import components, shingles

import corpus_pipeline


def test_stage_links_from_four_fifths(spark):
    rng = random.Random(4)
    docs = []
    for n in (60, 100, 230, 400, 900):
        words = [f"w{rng.randrange(5000)}" for _ in range(n)]
        longer = words + [f"t{rng.randrange(5000)}" for _ in range(n // 5)]
        changed, less = list(words), list(words)
        for k in range(n // 46):
            changed[23 + 46 * k] = "changed"
        for k in range(n // 20):
            less[10 + 20 * k] = "less"
        docs += [(len(docs) + i, " ".join(w)) for i, w in enumerate((words, longer, changed, less))]
    sets = [shingles(t, 5) for _, t in docs]
    of = components(len(docs), [(i, j) for i, x in enumerate(sets) for j in range(i) if 100 * len(x & sets[j]) >= 80 * len(x | sets[j])])
    want = sorted(d for (d, _), c in zip(docs, of, strict=True) if c == d)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, table, "").collect()) == want
    assert len(want) < len(docs)
