"""Vectorised word and window codes over one batch of texts (numpy; runs inside Spark tasks).

A batch is one byte buffer in which texts are separated by a blank, so that no word crosses two texts. Every 64-bit code
is a function of the bytes alone: any task on any machine gives the same word or window the same code.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd

# Odd multipliers of the two polynomial hashes (bytes of a word, words of a window) and the seed of the byte table.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# bytes.translate tables: what separates words becomes a blank.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACED = bytes(0x20 if b in BLANKS else b for b in range(256))
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def encoded(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def chunks(frame: pd.DataFrame, texts: list[bytes], most: int = 4 << 20) -> Iterable[tuple[pd.DataFrame, list[bytes]]]:
    """Slices of a batch of about ``most`` bytes; one longer text is a slice of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield frame.iloc[begin:i], texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield frame.iloc[begin:], texts[begin:]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the entropy of 64-bit codes over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up = np.full(n, self.base)
            self.down = np.full(n, self.inverse)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up, self.down


_BYTES, _WORDS = Powers(BYTE_BASE), Powers(WORD_BASE)


def windows(codes: np.ndarray, length: int, powers: Powers) -> np.ndarray:
    """Rabin-Karp code of every run of ``length`` codes, from prefix sums: one pass, whatever the length."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * down[:n])


def byte_windows(buffer: np.ndarray, length: int) -> np.ndarray:
    return windows(TABLE[buffer], length, _BYTES)


class Words:
    """Words of a slice: ``begin``/``end`` byte offsets, ``code``, ``first[i]`` = index of text i's first word."""

    def __init__(self, texts: list[bytes], table: bytes = SPACED):
        self.raw = b" ".join(texts)
        self.buffer = self.raw.translate(table)
        data = np.frombuffer(self.buffer, np.uint8)
        inside = np.empty(len(data) + 2, bool)
        inside[0] = inside[-1] = False
        np.not_equal(data, 0x20, out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.begin, self.end = edges[::2], edges[1::2]
        up, down = _BYTES.upto(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(TABLE[data] * up[: len(data)], out=sums[1:])
        self.code = mixed((sums[self.end] - sums[self.begin]) * down[self.begin])
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offset = np.concatenate([[0], np.cumsum(sizes)])  # byte offset of every text in the buffer
        self.first = np.searchsorted(self.begin, self.offset)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the windows that stay within one text, the index of the text and of the window's first word."""
        code = windows(self.code, length, _WORDS)
        text = np.searchsorted(self.first, np.arange(len(code)), side="right") - 1
        whole = np.arange(len(code)) + length <= self.first[text + 1] if len(code) else np.empty(0, bool)
        at = np.flatnonzero(whole)
        return code[at], text[at], at
