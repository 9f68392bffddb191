"""Word shingles as 64-bit hashes, computed on Arrow slices inside tasks."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

from faultline.llm.common import mix
from faultline.llm.line_dedup import UPPER

#: A-Z to lower case, every other byte unchanged.
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
REMEMBERED = 200_000
#: Odd factors that tell a word's places in a shingle apart.
FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


class WordHashes(dict):
    """64-bit hash of each word; remembers a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: exactly what ``bytes.split`` separates."""
    return text.translate(LOWER).split()


def word_hashes(found: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


#: Letters of the polynomial behind ``hashed_words``: a random number per byte, an odd base and its inverse.
LETTERS = mix(np.arange(1000, 1256, dtype=np.uint64))
BASE = 0x9E3779B97F4A7C15
PIECE = 1 << 19
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


@functools.cache
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _piece_hashes(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a piece, without making the words: differences of one running sum."""
    data = np.frombuffer(piece.translate(LOWER), np.uint8)
    inside = ~BLANK[data]
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    ends = np.flatnonzero(inside & ~np.r_[inside[1:], False])
    size = 1 << max(PIECE.bit_length(), len(data).bit_length())
    total = np.cumsum(LETTERS[data] * _powers(BASE, size)[: len(data)])
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    return mix((total[ends] - before) * _powers(pow(BASE, -1, 1 << 64), size)[starts]), starts


def _pieces(text: bytes):
    """A text cut at blanks into pieces of about ``PIECE`` bytes; a longer word stays whole."""
    while len(text) > PIECE:
        cut = PIECE
        while cut < len(text) and not BLANK[text[cut]]:
            cut += 1
        yield text[:cut]
        text = text[cut:]
    yield text


def hashed_words(texts: list[bytes]):
    """Per text the 64-bit hashes of its words (A-Z in lower case), in order; many short texts at a time."""
    held: list[bytes] = []
    size = 0

    def close():
        hashes, starts = _piece_hashes(b" ".join(held))
        lengths = np.array([len(t) + 1 for t in held])
        bounds = np.searchsorted(starts, np.cumsum(lengths))
        yield from np.split(hashes, bounds[:-1])
        held.clear()

    for text in texts:
        if size and size + len(text) > PIECE:
            yield from close()
            size = 0
        if len(text) > PIECE:
            yield np.concatenate([_piece_hashes(p)[0] for p in _pieces(text)])
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield from close()


def shingle_hashes(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; of the whole sequence if it is shorter; none without words."""
    k = min(size, len(hashes))
    if not k:
        return hashes[:0]
    total = np.full(len(hashes) - k + 1, k, np.uint64)
    for place in range(k):
        total += hashes[place : place + len(total)] * FACTORS[place]
    return mix(total)


def shingle_sets(texts: list[bytes], size: int = 5):
    """Per text its distinct shingle hashes, ascending."""
    for hashes in hashed_words(texts):
        yield np.unique(shingle_hashes(hashes, size))
