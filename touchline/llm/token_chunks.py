"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

The two vocabularies split a text into pieces before they merge anything: a piece never holds
white space after something else, nor punctuation after a letter or digit, and a lone line break
is a piece of its own. Texts can so be cut before white space, before ASCII punctuation that
follows a Latin letter or a digit, and after a lone line break; the parts are encoded alone. A
worker encodes a part when it first meets it and keeps the ids. Texts with white space beyond ASCII or control characters are encoded whole.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from touchline.llm.bytes_text import Words, word_hashes

#: Parts whose ids a worker keeps; when there are more, it starts anew. Only speed depends on it.
KEPT_PARTS = 2_000_000

_BYTES = np.arange(256)
_WHITE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
#: Bytes that odd characters begin with, or are.
_SUSPECT = ((_BYTES < 32) & ~_WHITE) | np.isin(_BYTES, [11, 12, 127, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])
_LATIN_TAIL = (_BYTES >= 0x80) & (_BYTES < 0xC0) & (_BYTES != 0x97) & (_BYTES != 0xB7)
_PUNCT = (_BYTES > 32) & (_BYTES < 127) & ~_ALNUM
#: White space beyond ASCII, and control characters.
_ODD = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
#: A space and Latin letters, or only those, are one piece in either vocabulary.
_PLAIN = re.compile(b" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: The vocabularies write a byte as a character: printable ones as themselves, others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


class ChunkEncoder:
    """encode() gives the ids of texts and how many each has.

    Parts are told apart by a 64-bit hash. spaced: the vocabulary marks a leading space.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.spaced = self.tokenizer.normalizer is None
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted
        self.head = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _ids_of(self, part: bytes) -> list[int]:
        if _PLAIN.fullmatch(part):
            if not self.spaced:
                part = part.strip().decode().lower().encode()
            if not part.isascii():
                piece = part.decode("latin-1").translate(_WRITTEN)
            elif part[0] == 32:
                piece = chr(_WRITTEN[32]) + part[1:].decode()
            else:
                piece = part.decode()
            return [t.id for t in self.model.tokenize(piece)]
        return self.tokenizer.encode(part.decode(), add_special_tokens=False).ids

    def _add(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        """hashes are sorted and new."""
        found = [self._ids_of(p) for p in parts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        total = self.used + int(size.sum())
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(total, np.uint32)])
        self.ids[self.used : total] = np.fromiter((i for ids in found for i in ids), np.uint32, total - self.used)
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.head = np.insert(self.head, where, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, where, size)
        self.used = total

    def _missing(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, hashes)
        return at >= len(self.known) if not len(self.known) else (self.known[np.minimum(at, len(self.known) - 1)] != hashes)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """buf holds the texts' bytes, offsets where each begins, and the end."""
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        white = _WHITE[buf]
        cut = np.zeros(len(buf), bool)
        letter = _ALNUM[buf]
        letter[1:] |= (buf[:-1] == 0xC3) & _LATIN_TAIL[buf[1:]]
        cut[1:] = (white[1:] & ~white[:-1]) | (_PUNCT[buf[1:]] & letter[:-1])
        cut[2:] |= (buf[1:-1] == 10) & ~white[2:] & ~white[:-2]
        cut[offsets[offsets < len(buf)]] = True
        for i in self._odd(buf, offsets):
            cut[offsets[i] + 1 : offsets[i + 1]] = False
        starts = np.flatnonzero(cut)
        parts = Words(buf, starts, np.append(starts[1:], len(buf)), np.searchsorted(starts, offsets))
        hashes, first, which = np.unique(word_hashes(parts, lower=False), return_index=True, return_inverse=True)
        new = np.flatnonzero(self._missing(hashes))
        if len(self.known) + len(new) > KEPT_PARTS:
            self._forget()
            new = np.arange(len(hashes))
        if len(new):
            self._add(hashes[new], [buf[parts.starts[i] : parts.ends[i]].tobytes() for i in first[new].tolist()])
        slot = np.searchsorted(self.known, hashes)
        size = self.size[slot][which]
        before = np.cumsum(size) - size
        total = int(size.sum())
        ids = self.ids[np.arange(total) + np.repeat(self.head[slot][which] - before, size)]
        return ids, np.diff(np.append(before, total)[parts.first])

    @staticmethod
    def _odd(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that can't be cut safely."""
        if not (_SUSPECT[buf]).any():
            return np.zeros(0, np.int64)
        texts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(buf))])
        return np.flatnonzero(pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False))
