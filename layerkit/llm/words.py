"""Hashes of the words of many texts at once, computed with numpy inside a task."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    up = np.cumprod(np.full(size, _BASE, np.uint64))
    down = np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64))
    return up, down


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def chained(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a run of words from the hash of all but the last word and that of the last."""
    return mixed(before * np.uint64(0xE7037ED1A0B428DB) + last)


def _classes(words: bytes, marks: bytes = b"") -> np.ndarray:
    """Class of each byte: 1 in words, 2 in runs of marks, 0 between tokens."""
    table = np.zeros(256, np.uint8)
    table[list(words)], table[list(marks)] = 1, 2
    return table


_SPACES = set(b"\t\n\x0b\x0c\r ")
_ALNUM = {b for b in range(128) if chr(b).isalnum()} | set(range(128, 256))
#: Tokens are what stands between white space.
SPACED = _classes(bytes(b for b in range(256) if b not in _SPACES))
#: Tokens are runs of letters and digits, or of other marks.
WORDPUNCT = _classes(bytes(_ALNUM), bytes(b for b in range(33, 127) if b not in _ALNUM))


def pieces(text: bytes, most: int = PIECE) -> Iterator[bytes]:
    """`text` cut at white space into parts of about `most` bytes; words stay whole."""
    start = 0
    while len(text) - start > most:
        cut = _SPACE.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def word_hashes(texts: Sequence[bytes], classes: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of all texts in order, and the number of tokens of each text. A token is
    a run of bytes of one class other than 0."""
    found, counts = [], np.zeros(len(texts), np.int64)
    run: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if run:
            hashes, each = _of_run(run, classes)
            found.append(hashes)
            np.add.at(counts, owner, each)
        run.clear()
        owner.clear()
        size = 0

    for i, text in enumerate(texts):
        for piece in pieces(text) if len(text) > PIECE else (text,):
            if size + len(piece) > PIECE:
                flush()
            run.append(piece)
            owner.append(i)
            size += len(piece) + 1
    flush()
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def tokens(data: bytes, classes: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first place and end of every token of `data`."""
    codes = np.frombuffer(data, np.uint8)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes[codes]
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    first = np.concatenate([[0], edge])
    end = np.append(edge, len(codes))
    inside = kind[first] > 0
    first, end = first[inside], end[inside]
    up, down = _powers(1 << max(20, int(len(codes) - 1).bit_length()))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=total[1:])
    hashes = mixed((total[end] - total[first]) * down[first] + (end - first).astype(np.uint64))
    return hashes, first, end


def _of_run(run: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, first, _ = tokens(b" ".join(run), classes)
    limits = np.cumsum([len(p) + 1 for p in run])
    return hashes, np.diff(np.searchsorted(first, limits), prepend=0)


def places(counts: np.ndarray) -> np.ndarray:
    """Place of each word within its text."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
