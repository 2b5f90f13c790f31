"""Benchmark decontamination: a suffix automaton of the test items, streamed over all texts.

Words are maximal runs of ASCII letters and digits and of everything beyond ASCII, A-Z
lower-cased. A window is any `window` consecutive words of an item, or all words of a shorter
item. Where the longest match that ends at a word of a document is as long as a window, the
window's words are hit. A null text has no words: such documents are clean and such items have
no window; equal items count each. Extra columns of either table are ignored, repeated rows give
a row each, empty tables give clean documents or no rows.

Items are read in blocks of `block_words` words, each an automaton that is broadcast, so that
what is broadcast is bounded; the documents pass the blocks one after the other, unshuffled.
"""

import hashlib
import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.bytes_text import ALNUM, find_words, text_slices, word_hashes
from touchline.llm.suffix_automaton import SuffixAutomaton, Vocabulary

WINDOW = 13
#: A document is contaminated when at least one word in so many is hit.
ONE_IN = 20
BLOCK_WORDS = 200_000

OUTPUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<first: long, last: long>>"


def _hashes_of(texts: list[str | None]) -> list[np.ndarray]:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    out = []
    for _, buf, offsets in text_slices([batch]):
        words = find_words(buf, offsets, ALNUM)
        out += np.split(word_hashes(words), words.first[1:-1])
    return out


class ItemBlock:
    """The automaton of some items, and the windows that end with each state's runs."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        items = [(name, words) for name, words in items if len(words)]
        names = [name for name, _ in items]
        self.vocabulary = Vocabulary([words for _, words in items])
        self.automaton = SuffixAutomaton([s.tolist() for s in self.vocabulary.numbered])
        self.least = min([window, *(len(words) for _, words in items)])
        auto, owners = self.automaton, self.automaton.owners()
        own: dict[int, list] = defaultdict(list)
        for v in range(1, len(auto.length)):
            if auto.length[auto.link[v]] < window <= auto.length[v]:
                own[v].append((window, tuple(sorted(names[k] for k in owners[v]))))
        short: dict[tuple[int, int], list[str]] = defaultdict(list)
        for name, tokens in zip(names, auto.sequences, strict=True):
            if len(tokens) < window:
                v = 0
                for token in tokens:
                    v = auto.next[v][token]
                short[v, len(tokens)].append(name)
        for (v, n), found in short.items():
            own[v].append((n, tuple(sorted(found))))
        self.windows: list[tuple] = [()] * len(auto.length)
        for v in sorted(range(1, len(auto.length)), key=auto.length.__getitem__):
            self.windows[v] = (*own.get(v, ()), *self.windows[auto.link[v]])

    def hits(self, words, hashes: np.ndarray) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """By text: the spans of words that are hit, as positions in it, and the items."""
        numbers, found = self.vocabulary.numbers(hashes), {}
        for a, b in self.vocabulary.stretches(numbers, words.first, self.least):
            at, last = np.zeros(b - a + 1, np.int64), None
            for i, (state, n) in enumerate(self.automaton.stream(numbers[a:b].tolist())):
                for size, names in self.windows[state]:
                    if size <= n:
                        if last is None:
                            text = int(np.searchsorted(words.first, a, "right")) - 1
                            last = found.setdefault(text, ([], set()))
                        at[i - size + 1] += 1
                        at[i + 1] -= 1
                        last[1].update(names)
            if last is not None:
                covered = np.concatenate([[0], (np.cumsum(at[:-1]) > 0).astype(np.int8), [0]])
                edges = np.flatnonzero(np.diff(covered)) + a - int(words.first[text])
                last[0].extend(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        return found


def _blocks(benchmark: DataFrame, window: int, block_words: int):
    """Blocks of whole items, read through the driver one at a time."""
    items, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        words = _hashes_of([row.text])[0]
        items.append((row.item_id or "", words))
        size += len(words)
        if size >= block_words:
            yield ItemBlock(items, window)
            items, size = [], 0
    yield ItemBlock(items, window)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _digest(rows, n_words, hit, names, spans, one_in) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            rows["doc_id"].cast(pa.int64()),
            pa.array(n_words, pa.int64()),
            pa.array(hit, pa.int64()),
            pa.array([len(n) for n in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
            pa.array((hit > 0) & (one_in * hit >= n_words), pa.bool_()),
            pa.array([[{"first": a, "last": b - 1} for a, b in s] for s in spans], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
    )


def _streamed(documents: DataFrame, benchmark: DataFrame, window: int, block_words: int, schema: str, finish) -> DataFrame:
    """Every block's automaton over the documents; finish() makes the last pass's rows."""
    context = documents.sparkSession.sparkContext
    blocks = [context.broadcast(block) for block in _blocks(benchmark, window, block_words)]
    carried = ["hit_spans", "hit_items"]
    while {c.lower() for c in documents.columns} & set(carried):
        carried = [c + "_" for c in carried]
    between = T.StructType([*documents.schema.fields, T.StructField(carried[0], T.BinaryType()), T.StructField(carried[1], T.ArrayType(T.StringType()))])

    def one_pass(shared, first: bool, final: bool):
        def run(batches):
            for rows, buf, offsets in text_slices(batches):
                words = find_words(buf, offsets, ALNUM)
                found = shared.value.hits(words, word_hashes(words))
                spans, names = [], []
                for i in range(rows.num_rows):
                    s, n = found.get(i, ((), ()))
                    if not first:
                        s = [*s, *struct.iter_unpack("<qq", rows[carried[0]][i].as_py())]
                        n = {*n, *rows[carried[1]][i].as_py()}
                    spans.append(_merged(s) if s else [])
                    names.append(sorted(n))
                own = rows if first else pa.RecordBatch.from_arrays(rows.columns[:-2], schema=pa.schema(list(rows.schema)[:-2]))
                if final:
                    yield finish(own, words.counts, np.array([sum(b - a for a, b in s) for s in spans], np.int64), names, spans)
                else:
                    packed = [b"".join(struct.pack("<qq", *x) for x in s) for s in spans]
                    more = [pa.array(packed, pa.binary()), pa.array(names, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*own.columns, *more], [*own.schema.names, *carried])

        return run

    for k, block in enumerate(blocks):
        final = k == len(blocks) - 1
        documents = documents.mapInArrow(one_pass(block, k == 0, final), schema if final else between)
    return documents


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: words, words hit, the items found, the spans hit (as word positions)."""

    def finish(rows, n_words, hit, names, spans):
        return _digest(rows, n_words, hit, names, spans, one_in)

    return _streamed(documents.select("doc_id", "text"), benchmark, window, block_words, OUTPUT, finish)


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that aren't contaminated, as they are, with all of their columns."""

    def finish(rows, n_words, hit, names, spans):
        return rows.filter(pa.array(~((hit > 0) & (one_in * hit >= n_words))))

    return _streamed(documents, benchmark, window, block_words, documents.schema, finish)


def cut_spans(documents: DataFrame, benchmark: DataFrame, longest: int = WINDOW, window: int = WINDOW, one_in: int = ONE_IN, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All documents, with spans of benchmark words cut out of their texts.

    A span goes if it has `longest` words or more, and every span of a document goes that holds so
    much of the benchmark that it is contaminated. What stands before the span's first word and after
    its last one stays as it is; other texts and columns aren't changed.
    """

    def finish(rows, n_words, hit, names, spans):
        texts = rows["text"].to_pylist()
        for i, found in enumerate(spans):
            all_go = hit[i] > 0 and one_in * hit[i] >= n_words[i]
            cut = [s for s in found if all_go or s[1] - s[0] >= longest]
            if cut:
                texts[i] = _without(texts[i].encode(), cut).decode()
        columns = [pa.array(texts, rows.schema.field(k).type) if name == "text" else rows.column(k) for k, name in enumerate(rows.schema.names)]
        return pa.RecordBatch.from_arrays(columns, schema=rows.schema)

    return _streamed(documents, benchmark, window, block_words, documents.schema, finish)


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the words of the spans, first word to one past the last, and what is between."""
    buf = np.frombuffer(text, np.uint8)
    words = find_words(buf, np.array([0, len(buf)]), ALNUM)
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at : words.starts[first]])
        at = int(words.ends[end - 1])
    return b"".join([*kept, text[at:]])
