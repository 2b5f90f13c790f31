"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct n-word shingles, as 64-bit hashes. Documents with one set are
one node. The global order of shingles is by how many nodes hold them, then by hash; two nodes with
a Jaccard similarity of SIMILAR or more share a shingle among the first few of either in that
order. Three steps, each over fragments of the hash range, cut so that every fragment is bounded:

1. Every node's shingles are cut at the fragments' bounds and sent to them. A fragment's task counts
   the nodes of each of its shingles, and sends back how many of a node's shingles nobody else has,
   and the others with their counts.
2. A node's parts are put together. If the first places of its order go to shingles that nobody
   else has, it is linked to nothing; most nodes end here. Else its first ones are its buckets.
   Buckets with the same nodes become one, in which a node has the earliest of its places. Two nodes
   are a pair only if what follows a common bucket in both orders could make them similar, and if
   their parity bitmaps allow it: a bit tells whether an even or odd number of a set's shingles fall
   on it, so of any two sets no more bits differ than shingles do. Most pairs that are not similar
   end here, before any set is moved.
3. For pairs that are left, each fragment counts their overlap separately; the partial counts are
   summed per pair and decide, exactly.

Long sets (LONG shingles or more) only send the lower SHARE of the hash range to step 1: of any two
similar sets, the parts below that bound differ by no more than the sets, so the same number of first
shingles suffices. Sets about as long as LONG, and those with too few shingles below the bound, send
all and get buckets of both kinds, so no pair is missed.

A text has no words if null, empty or all white space; it has no set and is linked to nothing. Rows
that share a doc_id are separate documents; a null doc_id is ignored when the smallest is taken. Of
rows that share a doc_id and a set, all stay or none does.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.bytes_text import NONSPACE, find_words, mixed, shingle_sets, text_slices, word_hashes
from touchline.llm.components import connect, unused
from touchline.session import scratch, settle

WORDS = 4
#: Similarity in hundredths.
SIMILAR = 85
LONG = 256
SHARE = 0.3
#: Shingles that one task of steps 1 and 2 gets, about.
FRAGMENT = 2_000_000
#: Fragments of step 3.
PARTS = 8
#: Words of 64 bits of a parity bitmap; and the fragment number under which a node's bitmap travels.
BITMAP = 16
_BITS = -1
#: Ids of documents with buckets that are broadcast at most; with more, they are joined by shuffling.
BROADCAST_IDS = 2_000_000
#: Pairs whose nodes are broadcast at most.
BROADCAST_PAIRS = 200_000

_BOUND = np.uint64(int(SHARE * 2**64))
_ALL, _LOW = 1, 2  # kinds of buckets a node gets


def least_overlap(n: np.ndarray, similar: int) -> np.ndarray:
    """Shingles that a set of n shares with any similar one, at least."""
    m = -(-similar * n // 100)
    return -(-similar * (n + m) // (100 + similar))


def _sets(buf, offsets, n_words: int, similar: int):
    """Each text's set, node (a 16-byte digest), number of shingles below the bound, and kinds."""
    words = find_words(buf, offsets, NONSPACE)
    sets = shingle_sets(words, word_hashes(words), n_words)
    sizes = np.array([len(s) for s in sets], np.int64)
    low = np.array([np.searchsorted(s, _BOUND) for s in sets], np.int64)
    few = least_overlap(sizes, similar) - (sizes - low) <= 0
    near = -(-100 * LONG // similar)
    kinds = np.where((sizes <= near) | few, _ALL, 0) | np.where(sizes >= LONG, _LOW, 0)
    nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
    return sets, nodes, sizes, low, kinds


def _summaries(documents: DataFrame, n_words: int, similar: int) -> DataFrame:
    """doc_id, n_shingles, node, and how many shingles step 1 gets below and above the bound."""

    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            _, nodes, sizes, low, kinds = _sets(buf, offsets, n_words, similar)
            high = np.where(kinds & _ALL, sizes - low, 0)
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"].cast(pa.int64()), pa.array(sizes), pa.array(nodes, pa.binary()), pa.array(low), pa.array(high)],
                ["doc_id", "n_shingles", "node", "low", "high"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, node binary, low long, high long")


_SENT = "fragment int, nodes binary, sizes binary, kinds binary, counts binary, shingles binary"


def _sent(documents: DataFrame, n_words: int, similar: int, n_low: int, n_high: int) -> DataFrame:
    """Step 1, sending: a row per fragment and slice of documents, nodes once per task."""

    def run(batches):
        seen: set[bytes] = set()
        for _, buf, offsets in text_slices(batches):
            sets, nodes, sizes, low, kinds = _sets(buf, offsets, n_words, similar)
            own = []
            for i, node in enumerate(nodes):
                if node is not None and node not in seen:
                    seen.add(node)
                    own.append(i)
            if not own:
                continue
            parts = [sets[i] if kinds[i] & _ALL else sets[i][: low[i]] for i in own]
            shingles = np.concatenate(parts)
            owner = np.repeat(np.arange(len(own)), [len(p) for p in parts])
            below = shingles < _BOUND
            place = shingles.astype(np.float64) / 2.0**64
            fragment = np.where(below, np.minimum(place / SHARE * n_low, n_low - 1), n_low + np.minimum((place - SHARE) / (1 - SHARE) * n_high, n_high - 1)).astype(np.int32)
            order = np.argsort(fragment, kind="stable")
            bounds = np.flatnonzero(np.diff(fragment[order], prepend=-1))
            out = []
            for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(order)], strict=True):
                who, counts = np.unique(owner[order[a:b]], return_counts=True)
                mine = [own[i] for i in who.tolist()]
                out.append((int(fragment[order[a]]), b"".join(nodes[i] for i in mine), sizes[mine].astype("<i4").tobytes(), kinds[mine].astype("u1").tobytes(), counts.astype("<i4").tobytes(), shingles[order[a:b]].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int32(), *[pa.binary()] * 5], strict=True)], ["fragment", "nodes", "sizes", "kinds", "counts", "shingles"])

    return documents.select("text").mapInArrow(run, _SENT)


def _joined(table: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype)


def _same_nodes(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """nodes as pairs of numbers: which one each is, and the first place of each."""
    order = np.lexsort((nodes[:, 1], nodes[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (nodes[order[1:]] != nodes[order[:-1]]).any(axis=1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return which, order[new]


_RETURNED = "part int, nodes binary, sizes binary, kinds binary, alone binary, low boolean, counts binary, shingles binary, holders binary"


def _counted(sent: DataFrame, n_low: int, parts: int) -> DataFrame:
    """Step 1, counting: per fragment, what each node has alone, and the rest with its holders."""

    def count(key, table):
        fragment = key[0].as_py()
        nodes = _joined(table, "nodes", "<u8").reshape(-1, 2)
        counts = _joined(table, "counts", "<i4").astype(np.int64)
        shingles = _joined(table, "shingles", np.uint64)
        _, first = _same_nodes(nodes)
        keep = np.zeros(len(nodes), bool)
        keep[first] = True  # the same set from several tasks counts once
        shingles = shingles[np.repeat(keep, counts)]
        nodes, counts = nodes[keep], counts[keep]
        sizes, kinds = _joined(table, "sizes", "<i4")[keep], _joined(table, "kinds", "u1")[keep]
        owner = np.repeat(np.arange(len(nodes)), counts)
        order = np.argsort(shingles)
        head = np.flatnonzero(np.diff(shingles[order], prepend=shingles[order[:1]] + np.uint64(1)))
        holders = np.empty(len(order), np.int32)
        holders[order] = np.repeat(np.diff(np.append(head, len(order))), np.diff(np.append(head, len(order))))
        alone = np.bincount(owner[holders == 1], minlength=len(nodes))
        shared = holders > 1
        owner, shingles, holders = owner[shared], shingles[shared], holders[shared]
        rest = np.bincount(owner, minlength=len(nodes))
        part = (nodes[:, 0] % np.uint64(parts)).astype(np.int64)
        out = []
        for p in np.unique(part).tolist():
            mine, own = np.flatnonzero(part == p), part[owner] == p
            out.append((p, nodes[mine].tobytes(), sizes[mine].tobytes(), kinds[mine].tobytes(), alone[mine].astype("<i4").tobytes(), fragment < n_low, rest[mine].astype("<i4").tobytes(), shingles[own].tobytes(), holders[own].tobytes()))
        kinds_of = [pa.int32(), *[pa.binary()] * 4, pa.bool_(), *[pa.binary()] * 3]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds_of, strict=True)], ["part", "nodes", "sizes", "kinds", "alone", "low", "counts", "shingles", "holders"])

    return sent.groupBy("fragment").applyInArrow(count, _RETURNED)


def _buckets(counted: DataFrame, similar: int) -> DataFrame:
    """Step 2: bucket, node, its number of shingles, and the bucket's place among them, for nodes
    whose first shingles are held by others too.

    weight is how many buckets the node has. A text that others were made from by small changes
    has the most, as each change puts shingles that nobody else has first.
    """

    def order(key, table):
        nodes = _joined(table, "nodes", "<u8").reshape(-1, 2)
        which, first = _same_nodes(nodes)
        n = len(first)
        sizes = _joined(table, "sizes", "<i4")[first].astype(np.int64)
        kinds = _joined(table, "kinds", "u1")[first]
        alone = _joined(table, "alone", "<i4")
        low_rows = np.repeat(table.column("low").to_numpy(), [len(x) // 16 for x in table.column("nodes").to_pylist()])
        counts = _joined(table, "counts", "<i4")
        owner = which[np.repeat(np.arange(len(counts)), counts)]
        shingles, holders = _joined(table, "shingles", np.uint64), _joined(table, "holders", "<i4")
        firsts = sizes - least_overlap(sizes, similar) + 1
        found = []
        for kind, use, mine in ((_ALL, np.ones(len(owner), bool), np.ones(len(alone), bool)), (_LOW, shingles < _BOUND, low_rows)):
            left = firsts - np.bincount(which[mine], alone[mine], n).astype(np.int64)
            left[(kinds & kind) == 0] = 0
            rows = np.flatnonzero(use & (left[owner] > 0))
            rows = rows[np.lexsort((shingles[rows], holders[rows], owner[rows]))]
            begin = np.flatnonzero(np.diff(owner[rows], prepend=-1))
            rank = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows))))
            first_ones = rank < left[owner[rows]]
            rows, rank = rows[first_ones], rank[first_ones]
            # Places in the node's order: what it has alone comes first.
            place = rank + (firsts - left)[owner[rows]]
            found.append((mixed(shingles[rows] + np.uint64(kind)).view(np.int64), owner[rows], place))
        bucket, who, place = (np.concatenate(x) for x in zip(*found, strict=True))
        weight = np.bincount(who, minlength=n)
        raw = nodes[first].tobytes()
        return pa.Table.from_arrays(
            [pa.array(bucket), pa.array([raw[16 * i : 16 * i + 16] for i in who.tolist()], pa.binary()), pa.array(sizes[who]), pa.array(place), pa.array(weight[who])],
            ["bucket", "node", "shingles", "place", "weight"],
        )

    return counted.groupBy("part").applyInArrow(order, "bucket long, node binary, shingles long, place long, weight long")


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """The bitmap of a set, as BITMAP signed words."""
    odd = np.bincount((shingles % np.uint64(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _segments(documents: DataFrame, ids: DataFrame, n_words: int, similar: int) -> DataFrame:
    """The fragments of step 3: node, fragment and shingles of the documents with the ids; and bitmaps."""

    def run(batches):
        for _, buf, offsets in text_slices(batches):
            sets, nodes, *_ = _sets(buf, offsets, n_words, similar)
            out = []
            for s, node in zip(sets, nodes, strict=True):
                if node is not None:
                    cuts = np.searchsorted(s, (np.arange(1, PARTS) * (2**64 // PARTS)).astype(np.uint64))
                    out += [(node, k, len(s), p.view(np.int64)) for k, p in enumerate(np.split(s, cuts)) if len(p)]
                    out.append((node, _BITS, len(s), parity_bits(s)))
            if out:
                kinds = (pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["node", "fragment", "size", "shingles"])

    found = documents.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    # Several documents may share an id, or a set; one row per node and fragment is enough.
    return found.mapInArrow(run, "node binary, fragment int, size long, shingles array<long>")


def _fewer_buckets(postings: DataFrame) -> DataFrame:
    """Buckets with more than one node; those with the same nodes as one.

    They are told by their number of nodes and two hashes of them; should two different ones
    coincide, their nodes are merely tried with each other. A node has its earliest place: what
    could be a pair in one of the buckets can be one in the common bucket.
    """
    sets = postings.groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    ).filter("n > 1")
    sets = sets.select("bucket", F.xxhash64("n", "x", "y").alias("same"))
    return postings.join(sets, "bucket").groupBy(F.col("same").alias("bucket"), "node").agg(
        F.max("shingles").alias("shingles"), F.min("place").alias("place"), F.max("weight").alias("weight")
    )


def _near_nodes(documents: DataFrame, n_words: int, similar: int) -> tuple[DataFrame, DataFrame]:
    """Summaries of all rows; and node and root of nodes that are linked, but roots."""
    summaries = settle(_summaries(documents, n_words, similar))
    low, high = (int(x or 0) for x in summaries.agg(F.sum("low"), F.sum("high")).first())
    n_low, n_high = max(8, -(-low // FRAGMENT)), max(8, -(-high // FRAGMENT))
    sent = _sent(documents, n_words, similar, n_low, n_high)
    postings = settle(_fewer_buckets(settle(_buckets(_counted(sent, n_low, n_low + n_high), similar))))
    busy = settle(postings.select("node").distinct())

    classes = summaries.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    wanted = settle(classes.join(busy, "node", "left_semi").select(F.col("first_id").alias("wanted")).distinct())
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    segments = settle(_segments(documents, ids, n_words, similar).join(busy, "node", "left_semi").dropDuplicates(["node", "fragment"]))
    bits = segments.filter(F.col("fragment") == _BITS).select("node", F.col("shingles").alias("bits"))
    size = F.struct("shingles", "place", "bits").alias("size")
    postings = settle(postings.join(bits, "node").select("bucket", "node", size, "weight"))
    segments = segments.filter(F.col("fragment") != _BITS)

    def verify(pairs: DataFrame) -> DataFrame:
        # Most rounds try few of the nodes; only their sets are moved.
        pairs = settle(pairs)
        tried = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        tried = F.broadcast(tried) if pairs.count() <= BROADCAST_PAIRS else tried
        moved = segments.join(tried, "node", "left_semi")
        a = moved.select(F.col("node").alias("a"), "fragment", F.col("size").alias("a_size"), F.col("shingles").alias("of_a"))
        b = moved.select(F.col("node").alias("b"), "fragment", F.col("size").alias("b_size"), F.col("shingles").alias("of_b"))
        cut = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        partial = cut.join(a, ["a", "fragment"]).join(b, ["b", "fragment"]).select("a", "b", "a_size", "b_size", F.size(F.array_intersect("of_a", "of_b")).alias("both"))
        summed = partial.groupBy("a", "b", "a_size", "b_size").agg(F.sum("both").alias("both"))
        return summed.filter(100 * F.col("both") >= similar * (F.col("a_size") + F.col("b_size") - F.col("both")))

    def compatible(x, y):
        # If this bucket is the first that the two share, they have no more in common than what
        # follows it in either order; that must be enough.
        total = x["shingles"] + y["shingles"]
        after = F.least(x["shingles"] - x["place"], y["shingles"] - y["place"])
        # No more bits differ than shingles do, and total - 2 * common shingles differ.
        apart = sum(F.bit_count(x["bits"][i].bitwiseXOR(y["bits"][i])) for i in range(BITMAP))
        most = total - apart
        return ((100 + similar) * after >= similar * total) & ((100 + similar) * most >= 2 * similar * total)

    return summaries, connect(postings, verify, compatible, rounds=1)


def join_near_copies(documents: DataFrame, n_words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    with scratch(documents.sparkSession):
        summaries, roots = _near_nodes(documents, n_words, similar)
        grouped = _grouped(summaries, roots)
        smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
        of_node = grouped.join(smallest, "root").select("node", "component_id")
        found = summaries.join(of_node, "node", "left")
        return settle(found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")), keep=True)


def _grouped(summaries: DataFrame, roots: DataFrame) -> DataFrame:
    """node, its smallest doc_id, and its root."""
    classes = summaries.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    return classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _with_nodes(documents: DataFrame, column: str, n_words: int, similar: int) -> DataFrame:
    """All columns, and the digest of each text's set under a name of its own."""

    def run(batches):
        for rows, buf, offsets in text_slices(batches):
            nodes = pa.array(_sets(buf, offsets, n_words, similar)[1], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, nodes], [*rows.schema.names, column])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, T.StructField(column, T.BinaryType())]))


def drop_near_copies(documents: DataFrame, n_words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """The document with the smallest doc_id of each component, with all columns.

    Rows are decided by doc_id and set, so another text under the id of a copy stays. A row without
    a doc_id goes if its component has a row with one; of components without any, the rows with the
    smallest set digest stay.
    """
    names = [unused(documents, c) for c in ("doc_id", "node")]
    with scratch(documents.sparkSession):
        summaries, roots = _near_nodes(documents, n_words, similar)
        of_node = _grouped(summaries, roots).select("node", "root")
        rows = summaries.filter("node IS NOT NULL").select("doc_id", "node").distinct().join(of_node, "node")
        place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node").alias("place")
        # Copies with one set are a node; two ids of it are two rows here.
        first = rows.groupBy("root").agg(F.min(place).alias("first"))
        gone = rows.join(first, "root").filter(place != F.col("first"))
        dropped = settle(gone.select(F.col("doc_id").alias(names[0]), F.col("node").alias(names[1])), keep=True)
    few = dropped.count() <= BROADCAST_IDS
    ids = dropped.select(names[0]).distinct()
    ids, dropped = (F.broadcast(ids), F.broadcast(dropped)) if few else (ids, dropped)
    same_id = documents["doc_id"].cast("long").eqNullSafe(ids[names[0]])
    # Only texts under an id that loses a row are looked at again.
    others = documents.join(ids, same_id, "left_anti")
    looked = _with_nodes(documents.join(ids, same_id, "left_semi"), unused(documents, "of_text"), n_words, similar)
    node = looked.columns[-1]
    same = looked["doc_id"].cast("long").eqNullSafe(dropped[names[0]]) & (looked[node] == dropped[names[1]])
    return others.unionByName(looked.join(dropped, same, "left_anti").drop(node))
