"""Cuts texts into the words that byte-level tokenizers merge, many texts at a time.

The rules are those of ``PATTERN``; numpy finds the same cuts from the classes of
the characters, which is several times faster than matching the pattern.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

# The pattern of the public rank files and the white space it means.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

LETTER, NUMBER, SPACE, OTHER = range(4)
CHUNK = 1 << 18


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    found = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for point in range(sys.maxunicode + 1):
        kind = kinds.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            found[point] = kind
    found[list(WHITE_SPACE)] = SPACE
    return found


ODD = 0x9E3779B97F4A7C15
STEP = 1 << 18


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """``STEP`` powers of an odd number and of its inverse, modulo 2^64."""
    both = []
    for base in (ODD, pow(ODD, -1, 1 << 64)):
        steps = np.full(STEP, base, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps, dtype=np.uint64))
    return tuple(both)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits from 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _spread() -> np.ndarray:
    """64 bits for every code point."""
    return mixed(np.arange(sys.maxunicode + 1, dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019))


def segment_hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each run of ``codes`` that begins at ``starts``; runs fill the array.

    The codes are taken in steps, so that the powers stay few however many codes there are.
    """
    up, down = _powers()
    found = np.zeros(len(starts), np.uint64)
    for begin in range(0, len(codes), STEP):
        part = codes[begin : begin + STEP]
        weighted = _spread()[part] * up[: len(part)]
        first, last = np.searchsorted(starts, [begin, begin + len(part)])
        inner = starts[first:last] - begin
        # A run that began before goes on in this step.
        own = first if len(inner) and inner[0] == 0 else first - 1
        cuts = inner if own == first else np.append(0, inner)
        found[own:last] += np.add.reduceat(weighted, cuts) * np.uint64(pow(ODD, begin, 1 << 64))
    for begin in range(0, len(codes), STEP):
        first, last = np.searchsorted(starts, [begin, begin + STEP])
        found[first:last] *= down[starts[first:last] - begin] * np.uint64(pow(ODD, -begin, 1 << 64))
    return mixed(found)


@dataclass
class Words:
    """Words of several texts: ``unique[inverse[k]]`` is word k; text t has words offsets[t]:offsets[t + 1]."""

    unique: list[str]
    inverse: np.ndarray
    offsets: np.ndarray


@cache
def _edges() -> tuple[np.ndarray, np.ndarray]:
    """The first and the last UTF-8 byte of every code point."""
    point = np.arange(sys.maxunicode + 1)
    first = np.select([point < 0x80, point < 0x800, point < 0x10000], [point, 0xC0 | point >> 6, 0xE0 | point >> 12], 0xF0 | point >> 18)
    return first.astype(np.uint16), np.where(point < 0x80, point, 0x80 | point & 63).astype(np.uint16)


def _starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words begin. first: marks the first character of each text."""
    n = len(codes)
    kind = classes()[codes]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(run)
    end = np.append(begin[1:], n)
    follows = np.append(~first[end[:-1]], False) if n else np.zeros(0, bool)
    start = run.copy()
    # The last white space before a word is cut off; a plain space joins the word.
    blank = (kind[begin] == SPACE) & follows
    last = end[blank] - 1
    start[last] = True
    plain = last[codes[last] == 32]
    start[plain + 1] = False
    # Short forms after an apostrophe that begins a word.
    mark = np.flatnonzero((codes == 39) & start)
    mark = mark[mark + 1 < n]
    mark = mark[(kind[mark + 1] == LETTER) & ~first[mark + 1]]
    if len(mark):
        one = codes[mark + 1]
        inside = mark + 2 < n
        after = np.minimum(mark + 2, n - 1)
        two = np.where(inside & ~first[after], codes[after], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size = np.where((one == ord(a)) & (two == ord(b)), 3, size)
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        rest = mark + size
        rest = rest[rest < n]
        rest = rest[(kind[rest] == LETTER) & ~first[rest]]
        start[rest] = True
    return np.flatnonzero(start)


def cut(texts: list[str], apart: np.ndarray | None = None) -> Words:
    """Words of all ``texts``, each different word once.

    apart: for every pair of bytes (first * 256 + second), whether words are cut between them too.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    if not len(texts) or not ends[-1]:
        return Words([], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.zeros(len(codes), bool)
    first[(ends - sizes)[sizes > 0]] = True
    starts = _starts(codes, first)
    if apart is not None:
        lead, trail = _edges()
        between = apart[trail[codes[:-1]] << 8 | lead[codes[1:]]]
        between[starts[1:] - 1] = True
        starts = np.append(0, np.flatnonzero(between) + 1)
    stops = np.append(starts[1:], len(codes))
    _, where, inverse = np.unique(segment_hashes(codes, starts), return_index=True, return_inverse=True)
    unique = [joined[a:b] for a, b in zip(starts[where].tolist(), stops[where].tolist(), strict=True)]
    offsets = np.append(np.searchsorted(starts, ends - sizes), len(starts))
    return Words(unique, inverse.ravel(), offsets)


def chunks(texts: list[str], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` characters; a longer text stands alone."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def gather(values: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[offsets[p]:offsets[p + 1]]`` of each pick one after another, and their sizes."""
    sizes = (offsets[1:] - offsets[:-1])[picks]
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0], sizes
    index = np.repeat(offsets[:-1][picks] - (ends - sizes), sizes) + np.arange(ends[-1])
    return values[index], sizes
