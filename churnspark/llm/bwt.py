"""Burrows-Wheeler transforms of small string collections, and their merge by interleave refinement (numpy, in tasks).

A collection holds strings over the bytes 1..255, each ended by its own terminator 0; terminators order as their strings.
``transform`` sorts the suffixes of one collection. ``merge`` joins the transforms of several collections without sorting a
suffix again: the interleave of their rows starts as one collection after the other; each pass deals the rows out by the
byte before them, stably, and steps to the suffixes one byte longer, so that after h passes the rows are ordered by their
first h bytes. The pass in which two neighbours part is their longest common prefix.
"""

from __future__ import annotations

import numpy as np


def transform(data: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Transforms of the collections ``group`` (ascending, one number for each string), one after the other.

    ``data`` holds the strings without terminators. Suffixes are ordered by prefix doubling from eight bytes.
    """
    lengths = lengths.astype(np.int64)
    n_strings, n = len(lengths), int(lengths.sum()) + len(lengths)
    ends = np.cumsum(lengths + 1) - 1  # places of the terminators
    text = np.zeros(n + 8, np.uint8)
    inside = np.ones(n, bool)
    inside[ends] = False
    text[:n][inside] = data
    string = np.repeat(np.arange(n_strings), lengths + 1)
    end = ends[string]
    word = np.zeros(n, np.uint64)
    left = end - np.arange(n)
    for k in range(8):
        word |= np.where(left > k, text[k:n + k], 0).astype(np.uint64) << np.uint64(56 - 8 * k)
    # First ranks: by collection and word; terminators by string.
    rank = np.empty(n, np.int64)
    order = np.empty(n, np.int64)
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        x, y = (0 if a == 0 else ends[a - 1] + 1), ends[b - 1] + 1
        o = np.argsort(word[x:y]) + x  # equal words share a rank, so their order does not matter
        o[: b - a] = ends[a:b]  # but for the terminators, which come first, in the order of the strings
        order[x:y] = o
        w = word[o]
        new = np.r_[True, w[1:] != w[:-1]]
        new[: b - a] = True
        rank[o] = np.maximum.accumulate(np.where(new, np.arange(x, y), 0))
    step = 8
    place = np.arange(n)
    while step < lengths.max(initial=0) + 1:
        tied = rank[order]
        same = np.zeros(n + 1, bool)
        same[1:-1] = tied[1:] == tied[:-1]
        at = np.flatnonzero(same[1:] | same[:-1])
        if not len(at):
            break
        rows = order[at]
        first, second = rank[rows], rank[np.minimum(rows + step, end[rows])]
        o = np.lexsort((second, first))
        rows, first, second = rows[o], first[o], second[o]
        order[at] = rows
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[rows] = np.maximum.accumulate(np.where(new, at, 0))
        step *= 2
    before = np.where(place == np.r_[0, ends[:-1] + 1][string], 0, text[np.maximum(place - 1, 0)])
    return before[order].astype(np.uint8)


def back_steps(bwt: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For the rows of transforms of ``sizes`` rows, one after the other, the row of the suffix one byte longer.

    The k-th row that follows byte c is the k-th of the rows that begin with c: a stable sort of each transform.
    """
    step = np.empty(len(bwt), np.int32)
    begin = 0
    for size in sizes.tolist():
        step[np.argsort(bwt[begin:begin + size], kind="stable") + begin] = np.arange(begin, begin + size, dtype=np.int32)
        begin += size
    return step


def merge(bwt: np.ndarray, step: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave of the transforms after ``length`` passes: (rows in order, block of each place, common prefixes).

    Rows of one block agree in their first ``length`` bytes; prefix[k] is the longest common prefix of the rows at the
    places k - 1 and k, ``length`` if it is that long or longer.
    """
    n = len(bwt)
    rows, block = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
    prefix = np.full(n, length, np.uint8)
    prefix[:1] = 0
    part = np.zeros(n, bool)
    for h in range(length):
        before = bwt[rows]
        dealt = np.argsort(before, kind="stable")
        rows = step[rows[dealt]]
        old, byte = block[dealt], before[dealt]
        now = np.zeros(n, bool)
        now[1:] = (old[1:] != old[:-1]) | (byte[1:] != byte[:-1])
        prefix[now & ~part] = h
        part = now
        block = np.cumsum(now, dtype=np.int32)
    return rows, block, prefix


def repeats(bwt: np.ndarray, step: np.ndarray, length: int, owner: np.ndarray,
            looks: tuple[int, ...] = (5, 6, 7, 8, 9, 10, 12, 14, 16, 19, 22, 26, 30, 34, 38, 42, 46)) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of ``merge`` that hold rows of several owners: (rows in order, block of each place).

    ``owner`` is one number per row, the same for all rows of a string. The same refinement, but rows that cannot matter
    leave it: what precedes a block of one owner has that owner too, so such blocks are irrelevant from then on; and a
    suffix shorter than the pass is no start of a repeat. Blocks are looked at in the passes ``looks`` and the last one.
    """
    rows, block = np.arange(len(bwt), dtype=np.int32), np.zeros(len(bwt), np.int32)
    for h in range(1, length + 1):
        before = bwt[rows]
        if not before.all():  # the first row of a string has nothing before it
            live = before != 0
            rows, block, before = rows[live], block[live], before[live]
        dealt = np.argsort(before, kind="stable")
        rows, old, byte = step[rows[dealt]], block[dealt], before[dealt]
        new = np.ones(len(rows), bool)
        new[1:] = (old[1:] != old[:-1]) | (byte[1:] != byte[:-1])
        block = np.cumsum(new, dtype=np.int32)
        if (h in looks or h == length) and len(rows):
            heads, own = np.flatnonzero(new), owner[rows]
            several = np.minimum.reduceat(own, heads) != np.maximum.reduceat(own, heads)
            live = several[block - 1]
            rows, block = rows[live], block[live]
    return rows, block
