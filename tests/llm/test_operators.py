import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import (
    components,
    contamination,
    crc,
    edit_distance,
    exact_copies,
    license_phrases,
    lower,
    near_copies,
    near_kept,
    token_rows,
)
from brute import NONSPACE as NONSPACE_WORDS
from brute import words as brute_words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm import (
    content_sort,
    decontaminate,
    fuzzy_lines,
    html_tree,
    license_scan,
    ngram_join,
    packing,
    pu_toxicity,
    rule_quality,
    token_orc,
)
from touchline.llm.bytes_text import ALNUM, NONSPACE, find_words, text_slices, word_hashes, word_text
from touchline.llm.queries import QUERIES, read_table
from touchline.session import shared_folder

SF = "/root/testdata/sf0.001"
brute_nonspace = NONSPACE_WORDS.findall
WORDS = "the of and in to is it that was for on are as with his they at be this from".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_documents():
    """Nulls, empty, blank and very long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(7)
    base = [prose(rng, n) for n in (3, 4, 5, 20, 60, 200, 300, 400, 1500)]
    docs = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        near = t.split()
        near[len(near) // 2] = "changed"
        docs += [(100 + i, t.upper()), (200 + i, " ".join(near)), (300 + i, t + " tail"), (300 + i, t + " tail")]
    passage = prose(rng, 80)
    docs += [(400 + i, prose(rng, 30) + "\n" + passage) for i in range(30)]
    docs += [(500, None), (501, ""), (502, " \n\t "), (None, base[5]), (None, None), (503, prose(rng, 30_000)), (504, "x" * 200_000), (505, "Été naïve, ça va? \x00\x1f ok")]
    docs += [(600 + i, base[6] + f" number {i}") for i in range(40)]
    return docs


def frame(spark, docs):
    """With extra columns, some named as results are."""
    rows = [(d, t, "en", None, "extra", True) for d, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, component_id string, kept boolean")


@pytest.fixture(scope="module")
def docs():
    return odd_documents()


@pytest.fixture(scope="module")
def table(spark, docs):
    read_table(spark, SF, "documents")  # settings
    return frame(spark, docs).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_words_are_those_of_the_pattern(docs):
    import brute
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in docs])], ["text"])
    for kind, pattern in ((ALNUM, brute.ALNUM), (NONSPACE, brute.NONSPACE)):
        found = []
        for _, buf, offsets in text_slices([batch]):
            w = find_words(buf, offsets, kind)
            found += [[word_text(w, i) for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        assert found == [brute.words(t, pattern) for _, t in docs]


def test_near_copies(table, docs, empty):
    assert rows(ngram_join.join_near_copies(table)) == near_copies(docs)
    assert rows(ngram_join.join_near_copies(empty)) == []


def test_near_copies_with_small_fragments(table, docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "FRAGMENT", 500)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    assert rows(ngram_join.join_near_copies(table)) == near_copies(docs)


def test_one_near_copy_stays(table, docs):
    kept = rows(ngram_join.drop_near_copies(table).select("doc_id", "text"))
    assert kept == sorted(near_kept(docs), key=repr)


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_texts_that_share_an_id_with_a_near_copy_stay(spark, monkeypatch, broadcast):
    """Rows are decided one by one; columns named as the operator's own are carried."""
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", broadcast)
    rng = random.Random(2)
    first, other, third = prose(rng, 200), prose(rng, 50), prose(rng, 40)
    docs = [(1, first), (5, first + " tail"), (5, other), (None, first), (None, third), (6, third), (7, None), (5, None), (None, "")]
    names = ["doc_id", "text", "dropped_id", "node", "doc_id_", "Of_Text", "root", "first"]
    table = spark.createDataFrame([(*r, *"abcdef") for r in docs], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))
    left = ngram_join.drop_near_copies(table)
    assert left.columns == names
    want = [(1, first), (5, other), (6, third), (7, None), (5, None), (None, "")]
    assert rows(left) == sorted([(*r, *"abcdef") for r in want], key=repr) and near_kept(docs) == want


def test_near_copies_without_ids_leave_one_text(spark):
    rng = random.Random(3)
    text = prose(rng, 100)
    docs = [(None, text), (None, text + " x"), (None, text + " y")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert ngram_join.drop_near_copies(table).count() == 1
    two = spark.createDataFrame([(3, text), (3, text + " x")], "doc_id long, text string")
    assert ngram_join.drop_near_copies(two).count() == 1


def test_parity_bits_differ_no_more_than_sets():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (0, 1, 30, 1000, 20_000):
        a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for _ in range(2))
        b[: n // 2] = a[: n // 2]
        bits = ngram_join.parity_bits(np.unique(a)) ^ ngram_join.parity_bits(np.unique(b))
        assert len(bits) == ngram_join.BITMAP
        apart = len(np.setxor1d(a, b))
        differ = sum(int(x).bit_count() for x in bits.view(np.uint64))
        assert differ <= apart and (apart > 300 or differ >= 0.7 * apart)


def test_near_copies_of_the_table(spark):
    got = rows(QUERIES["op1_ngram_jaccard"](spark, SF))
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert got == near_copies([(r["doc_id"], r["text"]) for r in table])


@pytest.mark.parametrize("group_rows", [1000, 2])
def test_exact_copies(table, docs, group_rows):
    want, kept = exact_copies(docs), {}
    for r in content_sort.duplicate_groups(table, group_rows).collect():
        match = [v for v in want.values() if v[2] == r.text_sha256]
        assert match == [(r.keep_id, r.group_size, r.text_sha256)]
        kept.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(flags) >= 1 for flags in kept.values())
    left = content_sort.drop_duplicates(table, group_rows)
    assert left.columns == table.columns
    assert {lower(r.text) for r in left.select("text").collect()} == set(want)


def test_exact_copies_of_nothing(empty):
    assert rows(content_sort.duplicate_groups(empty)) == []
    assert rows(content_sort.drop_duplicates(empty)) == []


ITEMS = [(1, "one two three"), (2, None), (3, ""), (4, " ".join(f"w{i}" for i in range(20))), (5, "one two three"), (6, " ".join(f"w{i}" for i in range(5, 30)))]
MARKED = [
    (1, "so One, TWO three! and more"), (2, " ".join(f"w{i}" for i in range(3, 18))), (3, " ".join(f"w{i}" for i in range(12))),
    (4, "filler " * 300 + "one two three"), (5, None), (6, "one two"), (7, " ".join(f"w{i}" for i in range(30))), (8, "one two three " * 3),
]


@pytest.mark.parametrize("block_words", [200_000, 10])
def test_contamination(spark, block_words):
    bench = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    marked = frame(spark, MARKED)
    got = decontaminate.find_contamination(marked, bench, block_words=block_words)
    want = contamination(MARKED, ITEMS)
    assert rows(got.drop("spans")) == want
    clean = decontaminate.clean_documents(marked, bench, block_words=block_words)
    assert clean.columns == marked.columns
    assert rows(clean.select("doc_id")) == sorted([(r[0],) for r in want if not r[5]], key=repr)


def test_contamination_of_and_by_nothing(spark, empty, table, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.find_contamination(table, none).collect())
    assert rows(decontaminate.find_contamination(empty, none)) == []


def test_licenses(spark, table, docs, empty):
    texts = [
        (1, "Released under the MIT License. See the Apache license, mit license"), (2, license_scan.TEMPLATES["mit-text"]),
        (3, "x " * 50 + license_scan.TEMPLATES["apache-text"].replace("software", "thing") + " y" * 9), (4, "permission is hereby granted"), (5, "mit\x00license general public-license"),
    ]
    found = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, texts)).collect()}
    for doc_id, text in texts:
        n, places = license_phrases(text, license_scan.BASE)
        r = found[doc_id]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert r.first_word == min((p for p, _ in places), default=None)
        assert r.last_word == max((p for p, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert 0 <= r.score <= 1
    assert "mit-text" in found[2].labels and found[2].score == 1 and found[2].spans[0].first == 0
    assert "apache-text" in found[3].labels and found[3].spans[0].first == 50
    assert found[4].labels == ""
    assert license_scan.scan_licenses(table).count() == len(docs)
    assert rows(license_scan.scan_licenses(empty)) == []


def test_statistics_and_compiled_rules(spark, table, docs):
    """Statistics against plain Python; rules as columns against rules as arrays, and the score."""
    import math

    import numpy as np

    given = table.select("doc_id", "text", F.col("text").alias("given"))
    got = rule_quality.with_statistics(given, "doc_id", "given").collect()
    assert len(got) == len(docs)
    for r in got:
        text = r.given or ""
        words, raw = brute_nonspace(text), text.encode()
        lines = [x for x in text.split("\n") if x]
        share = lambda n, of=len(raw): n / max(of, 1)
        counts = Counter(words)
        want = {
            "n_words": len(words), "word_length": share(sum(len(w.encode()) for w in words), len(words)),
            "longest_word": max((len(w.encode()) for w in words), default=0), "digit_share": share(sum(48 <= b <= 57 for b in raw)),
            "upper_share": share(sum(65 <= b <= 90 for b in raw)), "mark_share": share(raw.count(b"!")), "distinct_words": share(len({w.lower() for w in words}), len(words)),
            "n_lines": len(lines), "distinct_lines": share(len({x.lower() for x in lines}), len(lines)), "bar_words": share(counts["|"], len(words)),
            "stop_share": share(sum(len(w.encode()) <= 3 for w in words), len(words)), "comma_share": share(raw.count(b",") + raw.count(b".")),
        }
        for name, value in want.items():
            assert r[name] == pytest.approx(value), (name, text[:60])
    rng = random.Random(15)
    x = {c: np.array([r[c] for r in got]) for c in rule_quality.STATISTICS}
    rules = [
        rule_quality.Rule(tuple((c, rng.random() < 0.5, float(rng.choice(x[c]))) for c in rng.sample(rule_quality.STATISTICS, rng.randrange(1, 4))))
        for _ in range(40)
    ]
    weights = [rng.uniform(-2, 2) for _ in rules]
    ensemble = rule_quality.Ensemble(rules, weights, 0.25)
    stored = spark.createDataFrame([(i, *(float(x[c][i]) for c in rule_quality.STATISTICS)) for i in range(len(got))], "i long, " + ", ".join(f"{c} double" for c in rule_quality.STATISTICS))
    told = stored.orderBy("i").select(ensemble.logit().alias("logit"), *(r.column().alias(f"r{k}") for k, r in enumerate(rules))).collect()
    holds = np.stack([r.holds(x) for r in rules], axis=1)
    assert [list(r[1:]) for r in told] == holds.tolist()
    for r, h in zip(told, holds, strict=True):
        assert math.isclose(r.logit, 0.25 + sum(w for w, held in zip(weights, h, strict=True) if held), abs_tol=1e-9)


@pytest.mark.parametrize("prior", [0.1, 0.9])
def test_risk_and_its_gradient(prior):
    """Against numeric gradients of the written-out risk, step by step; with both of its branches."""
    import numpy as np

    rng = np.random.default_rng(int(prior * 10))
    x = (rng.random((60, 5)) < 0.4).astype(float)
    positive = np.arange(60) < 25
    x[positive, 0] = 1
    rows, columns = np.nonzero(x)
    sigmoid = lambda z: 1 / (1 + np.exp(-z))

    def parts(theta):
        s = sigmoid(x @ theta[:5] + theta[5])
        toxic = prior * (1 - s[positive]).mean()
        clean = s[~positive].mean() - prior * s[positive].mean()
        return toxic, clean, 0.5e-5 * (theta[:5] ** 2).sum()

    theta, m, v, below = np.append(np.zeros(5), -1.0), np.zeros(6), np.zeros(6), 0
    for step in range(1, 121):
        negative = parts(theta)[1] < 0
        below += negative
        loss = (lambda t: -parts(t)[1] + parts(t)[2]) if negative else (lambda t: sum(parts(t)))
        g = np.array([(loss(theta + d) - loss(theta - d)) / 2e-6 for d in np.eye(6) * 1e-6])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights, bias = pu_toxicity.fit(rows, columns, positive, 5, prior, epochs=120)
    assert np.append(weights, bias) == pytest.approx(theta, abs=2e-3)
    assert (below > 0) == (prior > 0.5)


def test_cut_spans(spark):
    """What is left has the words that no span held; long spans go from clean documents, too."""
    rng = random.Random(12)
    item = [f"w{i}" for i in range(20)]
    long = prose(rng, 900).split()
    docs = [
        (1, " ".join([*long[:500], *item, *long[500:]])), (2, "Some, " + ", ".join(item) + " -- end."), (3, "short one two three x " + prose(rng, 300)),
        (4, "one two three"), (5, prose(rng, 40)), (6, None), (7, ""), (1, "Été " + " ".join(item[:13]) + "; ça va"),
    ]
    table = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, hit_spans string, contaminated int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for words in (20, 200_000):
        left = decontaminate.cut_spans(table, items, block_words=words)
        assert left.columns == table.columns
        got = {(r.doc_id, t): r.text for r, (_, t) in zip(left.orderBy("doc_id", "text").collect(), sorted(docs, key=lambda d: (d[0], d[1] is not None, d[1] or "")), strict=True)}
        texts = sorted((r.text for r in left.collect()), key=repr)
        assert len(got) == len(docs)
        want = {1: " ".join([*long[:500], "", *long[500:]]), 2: "Some,  -- end.", 4: "", 5: docs[4][1], 6: None, 7: ""}
        assert texts == sorted([*want.values(), docs[2][1], "Été ; ça va"], key=repr)
        again = decontaminate.find_contamination(left, items, block_words=words).filter("contaminated").count()
        assert again == 0


def test_matching_statistics_and_chains():
    """Against every run of the templates; templates that stand twice give two spans."""
    from touchline.llm.suffix_automaton import SuffixAutomaton

    rng = random.Random(13)
    sequences = [[rng.randrange(4) for _ in range(n)] for n in (12, 7, 1, 30)]
    auto = SuffixAutomaton(sequences)
    ends = auto.ends()
    runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    text = [rng.randrange(5) for _ in range(400)]
    for i, (state, n) in enumerate(auto.stream(text)):
        assert n == max(k for k in range(i + 2) if k == 0 or tuple(text[i + 1 - k : i + 1]) in runs)
        if n:
            run = text[i + 1 - n : i + 1]
            places = {k: [e for e in range(n - 1, len(s)) if s[e - n + 1 : e + 1] == run] for k, s in enumerate(sequences)}
            assert ends[state] == {k: p for k, p in places.items() if p}
            assert auto.owners()[state] == set(ends[state])

    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.BASE, license_scan.SEED, license_scan.GAP)

    def spans(text):
        batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
        (_, buf, offsets), = text_slices([batch])
        words = find_words(buf, offsets, ALNUM)
        return sorted(scanner.spans(words, word_hashes(words), license_scan.COVERED, license_scan.LONG).get(0, []))

    mit, bsd = (license_scan.TEMPLATES[f"{name}-text"] for name in ("mit", "bsd"))
    n = len(brute_words(mit))
    apart, filler = [f"f{i}" for i in range(30)], [f"g{i}" for i in range(2000)]
    for between in ([], apart, filler):
        got = [s for s in spans(" ".join([mit, *between, mit])) if s[0] == "mit-text"]
        assert [(a, b, c) for _, a, b, c in got] == [(0, n - 1, 1.0), (n + len(between), 2 * n + len(between) - 1, 1.0)]
    # A run that the template has twice is placed at either.
    assert [(a, b, c) for name, a, b, c in spans(bsd) if name == "bsd-text"] == [(0, len(brute_words(bsd)) - 1, 1.0)]
    half = brute_words(bsd)[30:]
    assert [(a, b) for name, a, b, _ in spans(" ".join(half)) if name == "bsd-text"] == [(0, len(half) - 1)]
    assert spans("permission is hereby granted to nobody") == []


def optimum(lengths, capacity):
    """Fewest sequences, over all ways to fill them one after the other."""
    best = [(99, 0)] * (1 << len(lengths))
    best[0] = (1, 0) if lengths else (0, 0)
    for held in range(len(best)):
        count, used = best[held]
        for i, length in enumerate(lengths):
            if not held >> i & 1:
                way = (count, used + length) if used + length <= capacity else (count + 1, length)
                best[held | 1 << i] = min(best[held | 1 << i], way)
    return best[-1][0]


def test_the_reduction_keeps_the_optimum():
    import numpy as np

    rng, fixed_pieces = random.Random(0), 0
    for _ in range(300):
        capacity = rng.choice([10, 12, 17, 30])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))]
        counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        fixed = packing._reduced(counts, capacity)
        rest = np.repeat(np.arange(capacity + 1), counts).tolist()
        assert sum(p.times for p in fixed) + optimum(rest, capacity) == optimum(lengths, capacity)
        fixed_pieces += len(lengths) - len(rest)
    assert fixed_pieces > 1000
    assert [p.times for p in packing.pack_lengths({5: 1, 3: 1, 2: 1}, 10)] == [1]
    assert sum(p.times for p in packing.pack_lengths({5: 3, 4: 2, 1: 2}, 10)) == 3


def test_packing_of_lengths():
    rng = random.Random(3)
    for capacity, n in ((7, 30), (50, 300), (4096, 5000)):
        lengths = [max(1, int(capacity * rng.random() ** rng.choice((0.3, 1, 4)))) for _ in range(n)]
        histogram = {x: lengths.count(x) for x in set(lengths)}
        patterns, held = packing.pack_lengths(histogram, capacity), {}
        for times, content in patterns:
            assert times > 0 and sum(a * b for a, b in content) <= capacity
            for a, b in content:
                held[a] = held.get(a, 0) + times * b
        assert held == histogram
        assert sum(p.times for p in patterns) <= -(-sum(lengths) // capacity) * 11 // 9 + 1
    assert packing.pack_lengths({}) == []
    with pytest.raises(ValueError):
        packing.pack_lengths({9: 1}, 8)


def test_pieces(table, docs, empty, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    want = sorted(((d, k // 4096, k, len(ids[k : k + 4096]), crc(ids[k : k + 4096])) for d, ids in token_rows(docs, tokenizer, 1) for k in range(0, len(ids), 4096)), key=repr)
    pieces = packing.cut_pieces(table, path)
    packed = packing.pack_pieces(pieces, bucket_rows=10)
    got = packed.collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 4096
    assert rows(packing.pack_pieces(packing.cut_pieces(empty, path))) == []


def test_token_files(spark, table, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    at, want = 0, []
    for d, ids in token_rows(docs, tokenizer, 0):
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    folder = shared_folder(spark)
    token_orc.write_token_orc(table, folder, path, partitions=4)
    got = [tuple(r) for r in token_orc.token_digest(spark, folder).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    pushed = token_orc.read_token_orc(spark, folder).where("doc_id = 5")
    assert [len(r.ids) for r in pushed.collect()] == [w[2] for w in want if w[0] == 5]
    nothing = shared_folder(spark)
    token_orc.write_token_orc(empty, nothing, path)
    assert rows(token_orc.token_digest(spark, nothing)) == []


def accuracy(spark, query, column, least):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select(F.col("doc_id").alias("of"), column)
    scored = QUERIES[query](spark, "/root/testdata/sf0.1").filter("held_out")
    right = scored.join(labels, F.col("doc_id") == F.col("of")).agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0]
    assert right >= least


def test_quality_held_out(spark):
    accuracy(spark, "op2_quality_rules", "quality", 0.97)


def test_toxicity_held_out(spark):
    accuracy(spark, "op3_toxicity", "toxic", 0.97)


@pytest.mark.parametrize("labelled", ["none", "one kind", "some"])
def test_classifiers_of_odd_tables(spark, table, docs, empty, labelled):
    given = {"none": [], "one kind": [(1, 1, 0), (3, 1, 0)], "some": [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(9)] + [(None, 1, 1), (5, None, None), (77_777, 0, 1), (2, 0, 1)]}[labelled]
    labels = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    for train, score in ((rule_quality.train, rule_quality.score_quality), (pu_toxicity.train, pu_toxicity.score_toxicity)):
        got = score(table, train(table, labels)).collect()
        assert len(got) == len(docs)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
        assert score(empty, train(empty, labels)).count() == 0


def test_labels_of_held_out_rows_do_not_matter(spark):
    documents = read_table(spark, SF, "documents")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for module, column, folds, out in ((rule_quality, "quality", 3, 1), (pu_toxicity, "toxic", 5, 0)):
        held = pu_toxicity.fold(F.col("doc_id"), folds) == out
        turned = labels.withColumn(column, F.when(held, 1 - F.col(column)).otherwise(F.col(column)))
        score = rule_quality.score_quality if module is rule_quality else pu_toxicity.score_toxicity
        first, second = (dict(score(documents, module.train(documents, x)).select("doc_id", "score").collect()) for x in (labels, turned))
        assert first == pytest.approx(second)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class=top>Site</header><nav><a href=x>Home</a></nav>
<div id="cookie-notice">We use cookies</div><div class="sidebar"><p>Popular stories are listed here for you to read.</p></div>
<article><h1>A title</h1><p>First &amp; foremost,&nbsp;text   goes <b>on<br>here.<p>Second <a href="x>y">linked</a> one.<ul><li>item one<li>item two</ul>
<script>var t="</p>";</script><aside>Not this.</aside><form><label>Name</label><input></form><div class="advert">Buy now.</div></article>
<section class="comments"><p>I disagree with all of this, and here is why.</p></section><footer>&copy; site</footer>"""


def test_page_text(spark):
    model = html_tree.fit_tree_model([PAGE] * 5)
    want = "A title\nFirst & foremost, text goes on here.\nSecond linked one.\nitem one\nitem two"
    assert model.text(PAGE) == want
    assert html_tree.fit_tree_model([]).text(PAGE) == want
    assert model.text(PAGE.replace("article>", "div>")) == want
    for odd in ("", None, "<", "<p", "<p>" * 5000, "</p></div>", "<!-- x", "<script>", "<a href='", "\x00<p>&#0;&bogus;"):
        assert isinstance(model.text(odd), str)
    pages = spark.createDataFrame([(1, "u", PAGE, "a"), (2, None, None, "b"), (None, "v", "", "c"), (1, "u", PAGE, "d")], "page_id long, url string, html string, text string")
    got = html_tree.extract_text(pages, html_tree.train(pages))
    assert [(r.page_id, r.n_chars, len(r.text)) for r in got.collect()] == [(1, len(want), len(want)), (2, 0, 0), (None, 0, 0), (1, len(want), len(want))]
    assert html_tree.extract_text(pages.limit(0), html_tree.train(pages.limit(0))).count() == 0


def test_the_page_model_learns():
    """On pages that it wasn't fitted to, with all telling markup masked: characters of runs that are
    content or not, against what the markup says."""
    sources = [r["html"] for r in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).to_pylist() if r["html"]]

    def f1(model):
        right = wrong = 0
        for source in sources[120:]:
            page = html_tree.parse(source)
            labels, chances = html_tree.markup_labels(page), model.marginals(html_tree.masked(page))
            for text, chance, label in zip(page.text, chances, labels, strict=True):
                if text is not None and (chance > 0.5 or label):
                    right += 2 * len(text) * (chance > 0.5 and label > 0)
                    wrong += len(text) * ((chance > 0.5) != (label > 0))
        return right / (right + wrong)

    trained = html_tree.fit_tree_model(sources[:120])
    assert f1(trained) >= 0.995 > 0.98 > f1(html_tree.fit_tree_model([]))
    assert all(trained.text(s) == html_tree.fit_tree_model([]).text(s) for s in sources[120:140])
    plain = """<body><div><a href="/">Home</a> <a href="/a">About</a></div><div>We use cookies to improve your visit. By going on you agree to this.</div>
<div><h1>A headline of the story</h1><p>The first paragraph tells what happened, at length, with commas and stops. It goes on for a while.</p>
<p>The second paragraph adds to it, and says who was there and why it matters to them.</p></div><div>&copy; 2024 Some Site</div></body>"""
    lines = trained.text(plain).split("\n")
    assert len(lines) == 3 and lines[0].startswith("A headline") and lines[2].endswith("to them.")


def test_page_texts_of_the_table(spark):
    """What the pages' own markup says is the article, in whole, and nothing else."""
    got = {r.page_id: r.text for r in QUERIES["op7_html_text"](spark, SF).collect()}
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    assert len(got) == len(pages)
    for row in pages:
        page = html_tree.parse(row["html"] or "")
        labels = html_tree.markup_labels(page)
        if labels is not None:
            assert got[row["page_id"]] == "\n".join(t for t, y in zip(page.text, labels, strict=True) if t is not None and y)


def test_marginals_are_those_of_the_whole_tree():
    """Against a sum over all labellings of a small tree."""
    from itertools import product

    import numpy as np

    model = html_tree.fit_tree_model([PAGE])
    page = html_tree.parse("<div><p>One two three.</p><nav>x</nav></div><article><p>Four.</p></article>")
    own = np.clip(html_tree.node_features(page) @ model.weights - model.prior, -12, 12)
    chances = model.edges[html_tree.node_kinds(page)]
    total, content = 0.0, np.zeros(len(own))
    for labels in product((0, 1), repeat=len(own)):
        weight = np.exp(np.dot(own, labels))
        for i in range(1, len(own)):
            p = chances[i][labels[page.parent[i]]]
            weight *= p if labels[i] else 1 - p
        total += weight
        content += weight * np.array(labels)
    assert model.marginals(page) == pytest.approx(list(content / total))


def test_near_lines(spark, empty):
    rng = random.Random(5)
    long = [prose(rng, n) for n in (5, 9, 30, 60, 127, 128, 140)]
    docs = [(i, "\n".join([line, "", "short line", line.upper() + "  "])) for i, line in enumerate(long)]
    docs += [(50 + i, line.replace(" ", "\t") + " x") for i, line in enumerate(long)] + [(90, None), (91, ""), (None, long[0]), (92, long[2]), (92, long[2])]
    docs += [(100 + i, long[1] + f" {i}") for i in range(40)]
    table = frame(spark, docs)
    places = [(d, k, " ".join(x.split())) for d, t in dict.fromkeys(docs) for k, x in enumerate(lower(t).split("\n"))]
    sims = {r.node: r.sim for r in _sims(spark, table)}
    node = {r.line: r.node for r in fuzzy_lines.numbered_lines(table).collect()}
    lines = sorted({x for _, _, x in places if x})
    links = [
        (i, j)
        for i, a in enumerate(lines)
        for j, b in enumerate(lines[:i])
        if len(a.split()) >= 5 and len(b.split()) >= 5 and bin(sims[node[a]] ^ sims[node[b]]).count("1") <= 3
        and abs(len(a) - len(b)) * 5 <= max(len(a), len(b)) and edit_distance(a, b) * 5 <= max(len(a), len(b))
    ]
    group = dict(zip(lines, components(len(lines), links), strict=True))
    firsts = {}
    for d, k, x in sorted(places, key=lambda p: (p[0] is not None, p[0] or 0, p[1])):
        firsts.setdefault(group.get(x), (d, k))
    want = {}
    for d, k, x in places:
        gone = want.setdefault(d, [0, []])
        gone[0] += 1
        if x and firsts[group[x]] != (d, k):
            gone[1].append(k)
    got = fuzzy_lines.line_decisions(table).collect()
    assert {r.doc_id: [r.n_lines, r.dropped_lines] for r in got} == {d: [n, sorted(g)] for d, (n, g) in want.items()}
    assert all(r.n_kept == r.n_lines - len(r.dropped_lines) for r in got)
    left = fuzzy_lines.drop_repeated_lines(table)
    assert left.columns == table.columns and left.count() == len(docs)
    assert fuzzy_lines.line_decisions(empty).count() == 0
    assert links and any(g for _, g in want.values())


def test_lines_of_texts_that_share_an_id(spark):
    """Decisions are by row: the only copy of a line stays, whatever other text has its id."""
    rng = random.Random(8)
    first, second, third, only = (prose(rng, 12) for _ in range(4))
    docs = [(1, first), (2, f"{second}\n{first}"), (2, f"{third}\n{only}"), (None, f"{first} x\n{third}"), (None, f"q\n{second}"), (None, None)]
    names = ["doc_id", "text", "of", "dropped_lines", "of_doc_id", "Of_Text_Hash", "root"]
    table = spark.createDataFrame([(*r, *"abcde") for r in docs], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))
    left = fuzzy_lines.drop_repeated_lines(table)
    assert left.columns == names
    # Rows without an id come first.
    want = [(1, ""), (2, ""), (2, only), (None, docs[3][1]), (None, docs[4][1]), (None, None)]
    got = rows(left)
    assert [r[2:] for r in got] == [tuple("abcde")] * 6
    assert sorted([r[:2] for r in got], key=repr) == sorted(want, key=repr)
    decided = fuzzy_lines.line_decisions(table, word_keys=True).collect()
    assert len(decided) == 6 and sum(r.n_lines for r in decided) == 10


def test_similarity_without_common_ends_is_that_of_the_lines(spark):
    rng = random.Random(6)
    pairs = [("a b c", "a b c"), ("a b", "a x b"), ("a", "a b"), ("b", "a b"), ("a b a", "a b a b a"), ("x y", "y x"), ("abcd e", "abcd f"), ("a a a a a", "a a a a")]
    for _ in range(300):
        line = prose(rng, rng.randrange(1, 12)).split()
        other = list(line)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(other))
            other[k : k + 1] = rng.choice([[], ["new"], [other[k], "more"], [other[k][::-1]]])
            other = other or ["z"]
        pairs.append((" ".join(line), " ".join(other)))
    table = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in table.select(fuzzy_lines.similar_lines(F.col("a"), F.col("b"))).collect()]
    want = [edit_distance(a, b) * 100 <= (100 - fuzzy_lines.SIMILAR) * max(len(a), len(b)) for a, b in pairs]
    assert got == want and 20 < sum(want) < 290


def _sims(spark, table):
    lines = fuzzy_lines.numbered_lines(table).filter("node IS NOT NULL").select("node", F.split("line", " ").alias("w"))
    hashed = lines.select("node", F.size("w").cast("long").alias("n"), F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    return hashed.select("node", "n", "h", fuzzy_lines.simhash(F.col("h"), F.col("n")).alias("sim")).collect()


def test_simhash_is_a_majority_per_bit(spark):
    rng = random.Random(9)
    for r in _sims(spark, frame(spark, [(i, prose(rng, n)) for i, n in enumerate((1, 2, 3, 64, 127, 128, 129, 1000))])):
        want = sum(1 << b for b in range(fuzzy_lines.BITS) if 2 * sum(h >> b & 1 for h in r.h) > r.n)
        assert r.sim == want
