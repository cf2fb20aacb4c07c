"""Words and shingles of many texts at once, as numpy arrays.

A word is a run of characters other than ASCII white space (space and bytes 9 to 13), with A-Z
lowered.  A null text has no words.  Words are known by a 64-bit hash of their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

U = np.uint64
#: bytes of text taken together; a longer text is a block of its own
BLOCK_BYTES = 1 << 20
#: bytes hashed at once, which bounds the 8-byte temporaries
_PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_STEP = U(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SIGN = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, _PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, U(base))
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


@dataclass
class Block:
    """The words of some texts: text number, byte range in ``data``, and hash of each word."""

    data: bytes
    text_starts: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    #: words[first[i]:first[i+1]] belong to text i
    first: np.ndarray

    def gram_hashes(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of each run of k words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        total = self.hash[k - 1 :].copy()
        for j in range(k - 2, -1, -1):
            total *= _STEP
            total += self.hash[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, mix(total[at] + U(k))

    def sequence_hash(self, i: int) -> np.ndarray:
        """The hash of all words of text i as one shingle; empty without words."""
        h = self.hash[self.first[i] : self.first[i + 1]]
        if not len(h):
            return h
        total = 0
        for x in h[::-1].tolist():
            total = total * int(_STEP) + x
        return mix(np.array([(total + len(h)) % (1 << 64)], U))


def word_block(texts: list[str | None], plain: bool = False) -> Block:
    """The words of ``texts``; with ``plain`` those of the fully lowered texts, cut at ASCII signs."""
    if plain:
        texts = [t and t.lower() for t in texts]
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(encoded)
    raw = np.frombuffer(data, np.uint8)
    sizes = np.array([len(e) + 1 for e in encoded], np.int64)
    text_starts = np.cumsum(sizes) - sizes
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~(_SIGN if plain else _SPACE)[raw]
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hashes = np.empty(len(start), U)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(start):
            stop = max(at + 1, int(np.searchsorted(end, start[at] + _PIECE, "right")))
            low = start[at]
            part = _LOWER[raw[low : end[stop - 1]]].astype(U) + U(1)
            up, down = _power_tables(len(part) + 1)
            total = np.zeros(len(part) + 1, U)
            np.cumsum(part * up[: len(part)], out=total[1:])
            s, e = start[at:stop] - low, end[at:stop] - low
            hashes[at:stop] = mix((total[e] - total[s]) * down[s])
            at = stop
    first = np.searchsorted(start, np.append(text_starts, len(raw) + 1))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Block(data, text_starts, doc, start, end, hashes, first)


def slices(texts: list[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters each, at least one text."""
    low = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > limit:
            yield low, i
            low, size = i, 0
        size += len(text or "") + 1
    if low < len(texts):
        yield low, len(texts)
