"""Substring dedup: Rabin-Karp codes of every window of ``length`` words, grouped in Spark, repeats cut as maximal intervals.

Three shuffles, none of which sends a row per window:

1. Each task codes the windows of its documents (``runs`` of bounded size), keeps one entry per code and run (its
   earliest place; later places in the run are repeats already) and deals the sorted entries, packed, by code range.
2. A code range sees every run's entry of its codes: all but the earliest are repeats. They go back packed per run.
3. A run joins its repeats to intervals, one row per document, which a join brings to the text.

A window, line or whole text that a third of all documents share arrives at its code range once per run, not once per
occurrence. Codes have 72 bits (two independent polynomials); n windows give about n**2 / 2**73 false repeats.

Rules for odd rows: a null text has no words; a null id sorts after every id; rows with one id are one document for the
order (the same start is a tie and removes nothing), but each row's own text decides its windows; an empty table gives an
empty result. Further columns of ``docs`` are passed through by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm import textcode as tc
from churnspark.llm.tables import computed, doc_order, fresh, keyed, parts, small_batches, text_key

LENGTH = 20
RUN_BYTES = 16 << 20

ENTRIES = "part int, run long, size int, entries binary, docs binary, local binary"
REPEATS = "run long, docs binary, places binary"
INTERVALS = "doc long, key long, begins binary, ends binary"


def planes(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes; high planes of small numbers take no room."""
    data = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(data)


def unplanes(data: bytes, dtype) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(data)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def packed(*arrays: np.ndarray) -> bytes:
    """Several arrays as one value: sizes of the packed arrays, then the arrays."""
    data = [planes(a) for a in arrays]
    return np.array([len(d) for d in data], np.int64).tobytes() + b"".join(data)


def unpacked(data: bytes, *dtypes) -> list[np.ndarray]:
    ends = np.cumsum(np.frombuffer(data[: 8 * len(dtypes)], np.int64)) + 8 * len(dtypes)
    begins = [8 * len(dtypes), *ends[:-1]]
    return [unplanes(data[x:y], t) for x, y, t in zip(begins, ends, dtypes)]


def ascending(values: np.ndarray) -> np.ndarray:
    """Differences of ascending unsigned integers; ``np.cumsum`` undoes it."""
    return np.diff(values, prepend=values.dtype.type(0))


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for f in frames:
        held.append(f)
        size += int(f["text"].str.len().sum())
        if size >= RUN_BYTES:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _codes(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code and second code of all windows, text by text, and the number of windows of each text."""
    codes, seconds, sizes = [], [], []
    frame = pd.DataFrame(index=range(len(texts)))
    for _, some in tc.chunks(frame, texts, 2 << 20):
        w = tc.Words(some)
        code, text, at = w.windows(length)
        second = tc.windows(tc.mixed(w.code ^ np.uint64(0xA5A5A5A55A5A5A5B)), length, tc._BYTES)[at] if len(at) else code
        codes.append(code >> np.uint64(8))
        seconds.append((second >> np.uint64(48)).astype(np.uint16))
        sizes.append(np.bincount(text, minlength=len(some)))
    return np.concatenate(codes), np.concatenate(seconds), np.concatenate(sizes).astype(np.uint64)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns, the index at which the group of each row begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _repeated(doc: np.ndarray, start: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Rows, ordered by window, id and start, that are later than the first of their window."""
    return (doc != doc[head]) | (start != start[head])


def _entries(frames: Iterator[pd.DataFrame], length: int, n_parts: int) -> Iterator[pd.DataFrame]:
    for run in _runs(frames):
        run = run.sort_values("doc", kind="stable", ignore_index=True)
        code, second, sizes = _codes(tc.encoded(run["text"]), length)
        if not len(code):
            continue
        doc, ends = run["doc"].to_numpy(np.int64), np.cumsum(sizes)
        docs = packed(ascending(doc.view(np.uint64)), sizes)
        key = run["key"].to_numpy(np.int64)
        name = int.from_bytes(hashlib.blake2b(doc.tobytes() + key.tobytes(), digest_size=8).digest(), "little", signed=True)
        order = np.argsort(code, kind="stable").astype(np.uint32)
        code, second = code[order], second[order]
        # What shares its code with another window of the run, in the order (window, id, start).
        twin = np.zeros(len(code) + 1, bool)
        twin[1:-1] = code[1:] == code[:-1]
        twin = np.flatnonzero(twin[1:] | twin[:-1])
        local = np.empty(0, np.uint32)
        if len(twin):
            place = order[twin]
            text = np.searchsorted(ends, place, side="right")
            d, s = doc[text], place - np.r_[np.uint64(0), ends][text]
            o = np.lexsort((s, d, second[twin], code[twin]))
            order[twin], second[twin] = place[o], second[twin][o]
            gone = _repeated(d[o], s[o], _heads(code[twin], second[twin]))
            local = order[twin[gone]]
            left = np.ones(len(code), bool)
            left[twin[gone]] = False
            code, second, order = code[left], second[left], order[left]
        part = (((code >> np.uint64(24)) * np.uint64(n_parts)) >> np.uint64(32)).astype(np.int64)
        cut = np.searchsorted(part, np.arange(n_parts + 1))
        home, rows = name % n_parts, []
        for k in range(n_parts):
            a, b = cut[k], cut[k + 1]
            if a < b or k == home:
                own = packed(doc.view(np.uint64), key.view(np.uint64), sizes, np.sort(local)) if k == home else None
                rows.append((k, name, int(b - a), packed(ascending(code[a:b]), second[a:b], order[a:b]), docs, own))
            if rows and (len(rows) == 32 or k == n_parts - 1):
                yield pd.DataFrame(rows, columns=["part", "run", "size", "entries", "docs", "local"])
                rows = []


def _repeats(chunk: pd.DataFrame) -> pd.DataFrame:
    """All entries of one code range: places that are not the earliest of their window, per run."""
    names = chunk["run"].to_numpy()
    out = [(run, data, None) for run, data in zip(names, chunk["local"]) if data is not None]
    entries = [unpacked(e, np.uint64, np.uint16, np.uint32) for e in chunk["entries"]]
    runs = np.repeat(np.arange(len(chunk), dtype=np.int32), [len(e[0]) for e in entries])
    code = np.concatenate([np.cumsum(e[0], dtype=np.uint64) for e in entries])
    order = np.argsort(code, kind="stable")
    twin = np.zeros(len(code) + 1, bool)
    twin[1:-1] = code[order[1:]] == code[order[:-1]]
    order = order[twin[1:] | twin[:-1]]  # a window of one run only is done
    if len(order):
        code, runs = code[order], runs[order]
        second = np.concatenate([e[1] for e in entries])[order]
        place = np.concatenate([e[2] for e in entries])[order]
        doc, start = np.empty(len(order), np.int64), np.empty(len(order), np.uint64)
        for i in np.unique(runs):
            ids, sizes = unpacked(chunk["docs"].iloc[i], np.uint64, np.uint64)
            ids, ends = np.cumsum(ids, dtype=np.uint64).view(np.int64), np.cumsum(sizes)
            at = np.flatnonzero(runs == i)
            text = np.searchsorted(ends, place[at], side="right")
            doc[at], start[at] = ids[text], place[at] - np.r_[np.uint64(0), ends][text]
        o = np.lexsort((start, doc, second, code))
        gone = o[_repeated(doc[o], start[o], _heads(code[o], second[o]))]
        place, runs = place[gone], runs[gone]
        for i in np.unique(runs):
            out.append((names[i], None, planes(ascending(np.sort(place[runs == i])))))
    return pd.DataFrame(out, columns=["run", "docs", "places"])


def _intervals(chunk: pd.DataFrame, length: int) -> pd.DataFrame:
    """All repeats of one run as maximal intervals [begin, end) of words, one row per document."""
    data = next(d for d in chunk["docs"] if d is not None)
    doc, key, sizes, local = unpacked(data, np.uint64, np.uint64, np.uint64, np.uint32)
    marks = [np.cumsum(unplanes(p, np.uint32), dtype=np.uint32) for p in chunk["places"] if p is not None]
    place = np.unique(np.concatenate([local, *marks])).astype(np.int64)
    columns = ["doc", "key", "begins", "ends"]
    if not len(place):
        return pd.DataFrame([], columns=columns)
    ends = np.cumsum(sizes).astype(np.int64)
    text = np.searchsorted(ends, place, side="right")
    start = place - np.r_[0, ends][text]
    new = np.r_[True, (text[1:] != text[:-1]) | (start[1:] > start[:-1] + length)]
    at = np.flatnonzero(new)
    begin, end, owner = start[at], start[np.r_[at[1:] - 1, len(start) - 1]] + length, text[at]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:], len(owner)]
    doc, key = doc.view(np.int64), key.view(np.int64)
    return pd.DataFrame([
        (doc[owner[a]], key[owner[a]], begin[a:b].astype(np.uint32).tobytes(), end[a:b].astype(np.uint32).tobytes())
        for a, b in zip(first, last)
    ], columns=columns)


def repeated_intervals(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, key, begins, ends): word intervals of documents that occur earlier; documents without any have no row."""
    spark = docs.sparkSession
    small_batches(spark)
    n = parts(spark)

    def intervals(chunk: pd.DataFrame) -> pd.DataFrame:
        return _intervals(chunk, length)

    entries = keyed(docs, id_col, text_col).mapInPandas(partial(_entries, length=length, n_parts=n), ENTRIES)
    repeats = entries.groupBy("part").applyInPandas(_repeats, REPEATS)
    return repeats.groupBy("run").applyInPandas(intervals, INTERVALS).dropDuplicates(["doc", "key"])


def _cut(texts: list, begins: list, ends: list) -> list[list]:
    kept, total, removed = [], [], []
    for t, b, e in zip(tc.encoded(texts), begins, ends):
        words = t.split()  # exactly the six ASCII blanks
        total.append(len(words))
        done, gone = 0, 0
        pieces = []
        if b is not None:
            for x, y in zip(np.frombuffer(b, np.uint32).tolist(), np.frombuffer(e, np.uint32).tolist()):
                pieces += words[done:x]
                done, gone = y, gone + y - x
        kept.append(b" ".join(pieces + words[done:]).decode("utf-8", "replace"))
        removed.append(gone)
    return [total, removed, kept]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all unless given) with n_words, n_removed and kept, the words left, joined by one blank.

    A column of ``docs`` that is called like one of the three is replaced.
    """
    columns = docs.columns if columns is None else columns
    doc, key, begins, ends, text, order, code = (fresh(c) for c in ("doc", "key", "begins", "ends", "text", "order", "code"))
    found = repeated_intervals(docs, length, id_col, text_col).toDF(doc, key, begins, ends)
    left = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text_col}`").cast("string").alias(text),
                       doc_order(id_col).alias(order), text_key(text_col).alias(code))
    rows = left.join(found.hint("shuffle_hash"), (F.col(order) == F.col(doc)) & (F.col(code) == F.col(key)), "left")
    return computed(rows, [F.col(text), F.col(begins), F.col(ends)], _cut, "n_words long, n_removed long, kept string", columns)


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    out = remove_repeats(docs, length, columns=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def filtered(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without its repeats, same columns.

    A text without repeats stays as it is; one that loses words becomes its kept words, joined by one blank (and n_chars,
    if there, their length). A document that loses every word goes.
    """
    gone, total, kept = "n_removed", "n_words", "kept"
    names = {c: fresh(c) for c in docs.columns}
    out = remove_repeats(docs.toDF(*names.values()), length, names["doc_id"], names["text"])
    out = out.filter((F.col(gone) == 0) | (F.col(gone) < F.col(total)))
    cut = F.col(gone) > 0
    new = {"text": F.when(cut, F.col(kept)).otherwise(F.col(names["text"]))}
    if "n_chars" in names:
        new["n_chars"] = F.when(cut, F.length(kept)).otherwise(F.col(names["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(names[c])).alias(c) for c in docs.columns])
