"""Words of whole Arrow text columns, found with numpy on their UTF-8 bytes.

A null text is an empty text throughout. Only A-Z are lower-cased. Word hashes have 64 bits, so
two of a billion different words share one with a chance of about 3 in 100.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; a single longer text is taken whole.
SLICE_BYTES = 4 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_LETTER = ((LOWER >= 97) & (LOWER <= 122)) | (_BYTES >= 128)

#: Bytes that words consist of: all but white space; letters, digits and all beyond ASCII.
NONSPACE = ~_SPACE
ALNUM = _LETTER | ((_BYTES >= 48) & (_BYTES <= 57))

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Masks that keep the first n of eight bytes.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash over all others."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class Words(NamedTuple):
    """Words of consecutive texts: byte ranges in buf, and each text's first word (and the end)."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_slices(batches, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of the batches, with the bytes of their texts and where each text begins."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        texts = texts.cast(pa.large_string())
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
            to = min(max(to, at + 1), len(texts))
            yield batch.slice(at, to - at), buf[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def find_words(buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of a kind that stay within one text."""
    inside = kind[buf]
    before, after = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(buf))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(buf, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased or as it is; eight bytes at a time."""
    padded = np.zeros(len(words.buf) + 8, np.uint8)
    padded[:-8] = LOWER[words.buf] if lower else words.buf
    eights = np.ndarray(len(words.buf) + 1, "<u8", padded, strides=(1,))
    left = words.ends - words.starts
    out = mixed((eights[words.starts] & FIRST[np.minimum(left, 8)]) + left.astype(np.uint64) * _BASE)
    longer, done = np.flatnonzero(left > 8), 8
    while len(longer):
        more = eights[words.starts[longer] + done] & FIRST[np.minimum(left[longer] - done, 8)]
        out[longer] = mixed(out[longer] * _BASE + more)
        done += 8
        longer = longer[left[longer] > done]
    return out


def word_text(words: Words, i: int) -> str:
    return LOWER[words.buf[words.starts[i] : words.ends[i]]].tobytes().decode()


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive hashes; ordered, so that other orders differ."""
    out = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
    for k in range(n):
        out = (out + hashes[k : len(hashes) - n + 1 + k]) * (_BASE + np.uint64(2 * k))
        out ^= out >> np.uint64(29)
    return mixed(out)


def shingle_sets(words: Words, hashes: np.ndarray, n: int) -> list[np.ndarray]:
    """Each text's distinct n-word shingles as sorted hashes; all of its words if they are fewer."""
    grams, out = runs_of(hashes, n), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(runs_of(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out
