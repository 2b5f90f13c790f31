"""Best-fit packing of token sequences, after a Martello-Toth reduction.

Only how many pieces there are of each length decides how they are packed, so the packing is
worked out on that histogram, of at most `capacity` entries whatever the corpus; pieces of one
length are interchangeable. First the reduction: every length, longest first, is fixed for good
with up to two others where that set dominates every other that such a piece could be in: nothing
fits beside it; one piece fills the sequence; the longest piece that fits is as long as any two
together; or the longest two are at least as good as any other two, and three don't fit. The rest
is packed best-fit decreasing. Both work on all pieces of a length at once.

The result is a list of patterns (which lengths, how many sequences alike). Pieces are then
numbered within their length by Spark, in buckets of bounded size, and the number tells the
sequence and the place in it.
"""

from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.bytes_text import text_slices
from touchline.llm.token_orc import shared_encoder, with_end

CAPACITY = 4096
#: Pieces of one length that are numbered in one task, about.
BUCKET_ROWS = 50_000
#: Passes of the reduction over all lengths at most; the rest is packed either way.
PASSES = 8


class Pattern(NamedTuple):
    """`times` sequences that hold the same lengths: pairs of length and how many of it."""

    times: int
    lengths: tuple[tuple[int, int], ...]


def _dominant(counts: np.ndarray, length: int, capacity: int) -> tuple[int, ...] | None:
    """The pieces that a sequence with a piece of this length can as well hold beside it; None if no
    single set is known to be as good as all others.

    One set is as good as another if the other's pieces, put together in groups, go into the places
    of its pieces: then they can be exchanged in any packing.
    """
    room = capacity - length
    left = counts[: room + 1].copy()
    left[0] = 0
    if length <= room:
        left[length] -= 1
    sizes = np.flatnonzero(left)
    if not len(sizes):
        return ()
    best = int(sizes[-1])
    if best == room:
        return (best,)
    # For each piece the longest other one, no longer than it, that fits beside both.
    at = np.searchsorted(sizes, np.minimum(sizes, room - sizes), "right") - 1
    at -= (at >= 0) & (sizes[at] == sizes) & (left[sizes] < 2)
    paired = at >= 0
    if not paired.any():
        return (best,)
    x, y = sizes[paired], sizes[at[paired]]
    least = np.repeat(sizes[:3], np.minimum(left[sizes[:3]], 3))[:3]
    if len(least) == 3 and least.sum() <= room:
        return None
    if (x + y).max() <= best:
        return (best,)
    if paired[-1]:
        second = int(sizes[at[-1]])
        if ((y <= second) | (x + y <= best)).all():
            return (best, second)
    return None


def _reduced(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Fixes what dominates, longest first, and again as long as that leaves new such sets (PASSES
    times at most); lowers counts."""
    fixed = []
    for _ in range(PASSES):
        before = len(fixed)
        for length in np.flatnonzero(counts)[::-1].tolist():
            while counts[length]:
                others = _dominant(counts, length, capacity)
                if others is None:
                    break
                held = Counter((length, *others))
                times = min(int(counts[v]) // n for v, n in held.items())
                fixed.append(Pattern(times, tuple(sorted(held.items(), reverse=True))))
                for v, n in held.items():
                    counts[v] -= times * n
        if len(fixed) == before:
            break
    return fixed


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece once."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not between 1 and {capacity}")
        counts[length] += n
    patterns = _reduced(counts, capacity)
    # Open sequences by the room they have left; each entry is (how many alike, what they hold).
    opened: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
    has_room = np.zeros(capacity + 1, bool)

    def put(room: int, times: int, held: tuple) -> None:
        if times:
            opened[room].append((times, held))
            has_room[room] = True

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            rooms = np.flatnonzero(has_room[length:])
            if not len(rooms):
                each = capacity // length
                put(capacity - each * length, left // each, ((length, each),))
                if left % each:
                    put(capacity - left % each * length, 1, ((length, left % each),))
                break
            room = int(rooms[0]) + length
            times, held = opened[room].pop()
            has_room[room] = bool(opened[room])
            each = room // length
            full = min(times, left // each)
            put(room - each * length, full, (*held, (length, each)))
            left -= full * each
            times -= full
            if times and left:  # fewer than one sequence takes
                put(room - left * length, 1, (*held, (length, left)))
                left, times = 0, times - 1
            put(room, times, held)
    return patterns + [Pattern(times, held) for entries in opened.values() for times, held in entries]


def sequence_ranges(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length, for ranges of piece numbers: where a range begins, how many a sequence holds,
    the first sequence, and the place of the first piece in it."""
    begun: dict[int, int] = defaultdict(int)
    ranges: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    sequence = 0
    for times, lengths in patterns:
        offset = 0
        for length, each in lengths:
            ranges[length].append((begun[length], each, sequence, offset))
            begun[length] += times * each
            offset += length * each
        sequence += times
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in ranges.items()}


def cut_pieces(documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """The documents' pieces: doc_id, row (tells apart rows that share a doc_id), piece, start,
    length, ids_crc32. A null text is empty and gives the end id alone."""
    import zlib

    def run(batches):
        encoder = shared_encoder(tokenizer)
        for rows, buf, offsets in text_slices(batches):
            ids, bounds = with_end(*encoder.encode(buf, offsets), end_id)
            ids = ids.astype("<u4", copy=False)
            sizes = np.diff(bounds)
            pieces = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            head = bounds[owner] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(head.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"].take(pa.array(owner)).cast(pa.int64()), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds sequence_id and offset to pieces, which must give the same rows each time they are read."""
    spark = pieces.sparkSession
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    ranges = spark.sparkContext.broadcast(sequence_ranges(pack_lengths(histogram, capacity)))
    buckets = max(1, -(-max(histogram.values(), default=1) // bucket_rows))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    # At most lengths x buckets rows, a window for each length.
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = dealt.withColumn("rank", F.row_number().over(within)).join(heads, ["length", "bucket"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("head") + F.col("rank") - 1).alias("number"))

    def place(batches):
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length).tolist():
                here = np.flatnonzero(length == size)
                begin, each, first, place = ranges.value[size]
                k = np.searchsorted(begin, number[here], "right") - 1
                past = number[here] - begin[k]
                sequence[here] = first[k] + past // each[k]
                offset[here] = place[k] + past % each[k] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
