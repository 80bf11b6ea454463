"""Word hashes of many texts at once, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

U = np.uint64

# Bytes that belong to words: everything but ASCII white space, or letters and digits (all bytes
# of characters beyond ASCII included).
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

# Odd multipliers of the two hash lanes.
BASE, OTHER_BASE = U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95)
CHUNK_BYTES, CHUNK_TEXTS = 1 << 19, 2_000


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: all bits of the input reach all bits of the output."""
    values = (values ^ (values >> U(30))) * U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U(27))) * U(0x94D049BB133111EB)
    return values ^ (values >> U(31))


@cache
def powers(base: int, log_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    both = []
    for number in (base, pow(base, -1, 1 << 64)):
        row = np.full(1 << log_size, U(number))
        row[0] = U(1)
        both.append(np.multiply.accumulate(row))
    return both[0], both[1]


def powers_for(size: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    forward, backward = powers(int(base), max(16, (max(size, 1) - 1).bit_length()))
    return forward[:size], backward[:size]


BYTE_CODES = mixed(np.arange(1, 257, dtype=U))


@dataclass
class Words:
    """Words of several texts in a row: hashes, byte places, and each text's first word."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # per text, and at the end the number of words
    raw: bytes

    def of(self, text: int) -> slice:
        return slice(int(self.first[text]), int(self.first[text + 1]))


def split(texts: list[str | None], inside: np.ndarray = NOT_SPACE, lower: bool = False,
          base: np.uint64 = BASE) -> Words:
    """Hash the words of ``texts``; NULL has none."""
    parts = [
        (t.lower() if lower else t).encode("utf-8", "surrogatepass") if t else b"" for t in texts
    ]
    raw = b"\n".join(parts)
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
    data = np.frombuffer(raw, dtype=np.uint8)
    within = inside[data]
    edge = np.flatnonzero(np.diff(within, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    forward, backward = powers_for(len(data) + 1, base)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((BYTE_CODES ^ base)[data] * forward[:-1], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * backward[starts]
    first = np.searchsorted(starts, offsets)
    return Words(mixed(hashes), starts, ends, first, raw)


def chunks(texts: list[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list]]:
    """``texts`` in runs of about ``size`` characters and at most ``CHUNK_TEXTS`` texts, with the place
    of the first; a longer text is a run of its own."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        length = len(text) if text else 0
        if i > begin and (total + length > size or i - begin == CHUNK_TEXTS):
            yield begin, texts[begin:i]
            begin, total = i, 0
        total += length + 1
    if begin < len(texts):
        yield begin, texts[begin:]
