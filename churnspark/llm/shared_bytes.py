"""Suffix-array dedup: every byte covered by a 50-byte string that also starts in a document with a smaller id goes.

Documents travel in ``runs``: bounded pieces of the input, compressed. Four steps:

1. Anchors. The 50-byte windows of a document are cut into strings by their minimizers (the least 16-byte code in a window),
   a code that depends on the window alone, so equal windows have equal minimizers. A code range sees all strings of
   its minimizers as codes: strings whose minimizer is in one document only share nothing and are done. Equal strings become
   one, the one with the smallest id (within a run before anything is sent): a copy loses all that one holds. That one is
   done as well if no other string has its minimizer.
2. Shards. Each run makes Burrows-Wheeler transforms of the strings that are left, one for each range of minimizers.
3. Merge. For each range the shards' transforms are merged by interleave refinement, 50 passes, without sorting their
   suffixes again. Blocks of rows with a common prefix of 50 bytes are the repeated strings; the smallest id in a block
   decides for all its rows.
4. Each run gets the verdicts of its strings back and cuts its documents.

A passage or document that a third of all rows share is sent once per run in step 1 and once at all in step 2. Ranges are
merged in pieces, so that memory follows the number of ranges, not the input. Minimizer and string codes have 96 bits
together; n strings give about n**2 / 2**97 false copies.

Rules for odd rows: a null text is empty; texts of fewer than 50 bytes keep all bytes; a null id sorts after every id; rows
with one id are one document (they take nothing from each other); an empty table gives an empty result. Offsets are bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm import textcode as tc
from churnspark.llm.bwt import back_steps, repeats, transform
from churnspark.llm.substrings import ascending, packed, planes, unpacked, unplanes
from churnspark.llm.tables import keyed, parts, small_batches, written

LENGTH = 50
GRAM = 16
RUN_BYTES = 12 << 20
SLICE = 1 << 20
SUB = 32  # pieces of a range that are merged on their own: small enough for a processor's cache
SOLVED, COPY, SENT = 0, 1, 2
LAST = 2**63 - 1

RUNS = "run long, docs binary, blob binary"
CODES = "part int, run long, entries binary, docs binary"
VERDICTS = "run long, part int, kind int, data binary"
SHARDS = "part int, run long, bwt binary, strings binary, docs binary"
RESULT = "doc long, key long, n_bytes long, n_removed long, begins array<int>, ends array<int>, kept binary"


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents in runs, ordered by id: ids, keys and sizes, and the texts as one compressed piece."""
    held, size = [], 0

    def made() -> pd.DataFrame:
        f = pd.concat(held, ignore_index=True).sort_values("doc", kind="stable", ignore_index=True)
        texts = tc.encoded(f["text"])
        doc, key = f["doc"].to_numpy(np.int64), f["key"].to_numpy(np.int64)
        docs = packed(ascending(doc.view(np.uint64)), key.view(np.uint64), np.array([len(t) for t in texts], np.uint64))
        name = int.from_bytes(hashlib.blake2b(docs, digest_size=8).digest(), "little", signed=True)
        return pd.DataFrame({"run": [name], "docs": [docs], "blob": [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))]})

    for f in frames:
        held.append(f)
        size += int(f["text"].str.len().sum())
        if size >= RUN_BYTES:
            yield made()
            held, size = [], 0
    if held:
        yield made()


class Run:
    """A run's bytes and its strings; equal strings have one number, numbers ascend with the minimizer's code."""

    def __init__(self, docs: bytes, blob: bytes):
        ids, key, sizes = unpacked(docs, np.uint64, np.uint64, np.uint64)
        self.ids, self.key = np.cumsum(ids, dtype=np.uint64).view(np.int64), key.view(np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=int(sizes.sum()) + 1), np.uint8)
        self.ends = np.cumsum(sizes.astype(np.int64))

    def cut(self) -> None:
        begin, count, code, name = zip(*self._slices()) if len(self.data) >= LENGTH else ([], [], [], [])
        join = lambda parts, kind: np.concatenate([*parts, np.empty(0, kind)]).astype(kind)
        self.begin, self.count = join(begin, np.int64), join(count, np.int64)
        code, name = join(code, np.uint64), join(name, np.uint64)
        # One key of both codes; the rest of the name separates what still is equal.
        order = np.argsort((code << np.uint64(16)) | (name >> np.uint64(32)), kind="stable")
        c, m = code[order], name[order]
        new = np.ones(len(order), bool)
        new[1:] = (c[1:] != c[:-1]) | (m[1:] != m[:-1])
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.first = order[new]  # the occurrence with the smallest id, as the run is ordered by id
        self.code, self.name = c[new], m[new]
        self.text = np.searchsorted(self.ends, self.begin, side="right")

    def _slices(self) -> Iterator[tuple[np.ndarray, ...]]:
        width = LENGTH - GRAM + 1
        low = np.uint64((1 << 24) - 1)
        for a in range(0, len(self.data) - LENGTH + 1, SLICE):
            n = min(SLICE, len(self.data) - LENGTH + 1 - a)
            piece = self.data[a:a + n + LENGTH - 1]
            up, down = tc._BYTES.upto(len(piece) + 1)
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(tc.TABLE[piece] * up[: len(piece)], out=sums[1:])
            grams = tc.mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(piece) - GRAM + 1])
            least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
            done = 1
            while done < width:  # minimum of ``width`` neighbours by doubling
                shift = min(done, width - done)
                least = np.minimum(least[:-shift], least[shift:])
                done += shift
            at = (least & low).astype(np.int64)
            start = np.arange(a, a + n)
            text = np.searchsorted(self.ends, start, side="right")
            whole = start + LENGTH <= self.ends[text]
            new = np.ones(n, bool)
            new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
            heads = np.flatnonzero(new)
            count = np.diff(np.r_[heads, n])
            keep = whole[heads]
            heads, count = heads[keep], count[keep]
            # A minimizer is a small code by its nature; mixed once more, codes fill their range evenly.
            code = tc.mixed(grams[at[heads]]) >> np.uint64(16)
            name = tc.mixed((sums[heads + count + LENGTH - 1] - sums[heads]) * down[heads] + count.astype(np.uint64))
            yield heads + a, count, code, name >> np.uint64(16)

    def range_of(self, n: int) -> np.ndarray:
        """Range of each string's minimizer code, ascending."""
        return (((self.code >> np.uint64(16)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _codes(frames: Iterator[pd.DataFrame], n_parts: int) -> Iterator[pd.DataFrame]:
    for f in frames:
        for name, docs, blob in zip(f["run"], f["docs"], f["blob"]):
            run = Run(docs, blob)
            run.cut()
            used = packed(ascending(run.ids.view(np.uint64)))
            cut = np.searchsorted(run.range_of(n_parts), np.arange(n_parts + 1))
            text = run.text[run.first].astype(np.uint32)
            rows = [(k, name, packed(ascending(run.code[a:b]), run.name[a:b], text[a:b]), used)
                    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b]
            for k in range(0, len(rows), 32):
                yield pd.DataFrame(rows[k:k + 32], columns=["part", "run", "entries", "docs"])


def _ids(docs: bytes) -> np.ndarray:
    return np.cumsum(unpacked(docs, np.uint64)[0], dtype=np.uint64).view(np.int64)


def _states(chunk: pd.DataFrame) -> pd.DataFrame:
    """For one range of minimizers, what becomes of each run's strings."""
    entries = [unpacked(e, np.uint64, np.uint64, np.uint32) for e in chunk["entries"]]
    sizes = [len(e[0]) for e in entries]
    code = np.concatenate([np.cumsum(e[0], dtype=np.uint64) for e in entries])
    order = np.argsort(code, kind="stable")
    c = code[order]
    twin = np.zeros(len(c) + 1, bool)
    twin[1:-1] = c[1:] == c[:-1]
    order = order[twin[1:] | twin[:-1]]
    state = np.zeros(len(code), np.uint8)
    if len(order):
        doc = np.concatenate([_ids(d)[e[2]] for d, e in zip(chunk["docs"], entries)])[order]
        name, c = np.concatenate([e[1] for e in entries])[order], code[order]
        o = np.lexsort((doc, name, c))
        order, c, name, doc = order[o], c[o], name[o], doc[o]
        group = np.r_[True, c[1:] != c[:-1]]
        heads = np.flatnonzero(group)
        several = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
        string = group | np.r_[True, name[1:] != name[:-1]]
        first = doc[np.maximum.accumulate(np.where(string, np.arange(len(c)), 0))]
        # The first of a string that alone has its minimizer shares windows with its own copies only.
        other = np.add.reduceat(string.astype(np.int64), heads) > 1
        of = np.cumsum(group) - 1
        found = np.where(doc != first, COPY, np.where(other[of], SENT, SOLVED)).astype(np.uint8)
        state[order] = np.where(several[of], found, SOLVED)
    cuts = np.cumsum([0, *sizes])
    return pd.DataFrame([(run, part, 0, planes(state[a:b])) for run, part, a, b in zip(chunk["run"], chunk["part"], cuts[:-1], cuts[1:])],
                        columns=["run", "part", "kind", "data"])


def _known(run: Run, verdicts: pd.DataFrame, n_parts: int) -> np.ndarray:
    """State of the run's strings."""
    cut = np.searchsorted(run.range_of(n_parts), np.arange(n_parts + 1))
    state = np.zeros(len(run.code), np.uint8)
    for part, kind, data in zip(verdicts["part"], verdicts["kind"], verdicts["data"]):
        if kind == 0:
            state[cut[part]:cut[part + 1]] = unplanes(data, np.uint8)
    return state


def _shards(runs: pd.DataFrame, verdicts: pd.DataFrame, n_parts: int) -> pd.DataFrame:
    out = []
    if len(runs) and len(verdicts):
        name, docs, blob = runs.iloc[0]
        run = Run(docs, blob)
        run.cut()
        sent = np.flatnonzero(_known(run, verdicts, n_parts) == SENT)
        fine = run.range_of(n_parts * SUB)[sent]
        cut = np.searchsorted(fine // SUB, np.arange(n_parts + 1))
        used = packed(ascending(run.ids.view(np.uint64)))
        data = np.where(run.data == 0, np.uint8(255), run.data)  # 255 is no byte of UTF-8; 0 ends strings
        for part, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if a < b:
                own, group = sent[a:b], fine[a:b] % SUB
                first = run.first[own]
                begin, size = run.begin[first], run.count[first] + LENGTH - 1
                at = np.arange(size.sum()) + np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size)
                strings = packed(own.astype(np.uint32), size.astype(np.uint8), run.text[first].astype(np.uint32), group.astype(np.uint8))
                out.append((part, name, planes(transform(data[at], size, group)), strings, used))
    return pd.DataFrame(out, columns=["part", "run", "bwt", "strings", "docs"])


def _merged(chunk: pd.DataFrame) -> pd.DataFrame:
    """For one range the windows of each string that also start in a document with a smaller id, as bits."""
    shards = [(unplanes(b, np.uint8), *unpacked(s, np.uint32, np.uint8, np.uint32, np.uint8), _ids(d))
              for b, s, d in zip(chunk["bwt"], chunk["strings"], chunk["docs"])]
    bits = [np.zeros(len(s[1]), np.uint64) for s in shards]
    # Row bounds of the SUB transforms of every shard.
    bounds = [np.r_[0, np.cumsum(np.bincount(s[4], weights=s[2].astype(np.int64) + 1, minlength=SUB))].astype(np.int64) for s in shards]
    for sub in range(SUB):
        mine = [i for i in range(len(shards)) if bounds[i][sub] < bounds[i][sub + 1]]
        if not mine:
            continue
        which = [np.flatnonzero(shards[i][4] == sub) for i in mine]
        doc = np.concatenate([shards[i][5][shards[i][3][w]] for i, w in zip(mine, which)])
        if (doc == doc[0]).all():
            continue
        bwt = np.concatenate([shards[i][0][bounds[i][sub]:bounds[i][sub + 1]] for i in mine])
        sizes = np.array([bounds[i][sub + 1] - bounds[i][sub] for i in mine])
        step = back_steps(bwt, sizes)
        # Walk every string backwards from its terminator: row by row, the place of each suffix.
        size = np.concatenate([shards[i][2][w] for i, w in zip(mine, which)]).astype(np.int64)
        at = np.concatenate([np.arange(len(w)) + x for w, x in zip(which, np.r_[0, np.cumsum(sizes)[:-1]])])
        rank = np.unique(doc, return_inverse=True)[1].astype(np.int32)
        owner, string, place = np.empty(len(bwt), np.int32), np.empty(len(bwt), np.int32), np.empty(len(bwt), np.uint8)
        for t in range(int(size.max()) + 1):
            live = np.flatnonzero(size >= t)
            if t:
                at[live] = step[at[live]]
            row = at[live]
            owner[row], string[row], place[row] = rank[live], live, size[live] - t
        rows, block = repeats(bwt, step, LENGTH, owner)
        flags = np.zeros(len(size), np.uint64)
        if len(rows):
            heads = np.r_[True, block[1:] != block[:-1]]
            own = owner[rows]
            least = np.minimum.reduceat(own, np.flatnonzero(heads))[np.cumsum(heads) - 1]
            gone = rows[own > least]
            np.bitwise_or.at(flags, string[gone], np.uint64(1) << place[gone].astype(np.uint64))
        for i, w, a in zip(mine, which, np.cumsum([0, *[len(w) for w in which]])):
            bits[i][w] = flags[a:a + len(w)]
    out = []
    for run, part, s, b in zip(chunk["run"], chunk["part"], shards, bits):
        some = np.flatnonzero(b)
        if len(some):
            out.append((run, part, 1, packed(ascending(s[1][some]), b[some])))
    return pd.DataFrame(out, columns=["run", "part", "kind", "data"])


def _results(runs: pd.DataFrame, verdicts: pd.DataFrame, n_parts: int) -> Iterator[tuple]:
    run = Run(runs["docs"].iloc[0], runs["blob"].iloc[0])
    run.cut()
    state = _known(run, verdicts, n_parts)
    bits = np.zeros(len(run.code), np.uint64)
    for kind, data in zip(verdicts["kind"], verdicts["data"]):
        if kind == 1:
            number, some = unpacked(data, np.uint32, np.uint64)
            bits[np.cumsum(number, dtype=np.uint32)] = some
    ids = run.ids[run.text]
    later = ids > ids[run.first][run.number]  # the run itself has the string in an earlier document
    whole = later | (state[run.number] == COPY)
    marks = np.zeros(len(run.data) + 1, np.int32)  # windows that go, by their start
    marks[run.begin[whole]] += 1  # strings begin at different places, and end at different ones
    marks[run.begin[whole] + run.count[whole]] -= 1
    start = np.cumsum(marks, dtype=np.int32)[:-1] > 0
    del marks
    some = np.flatnonzero(~whole & (bits[run.number] > 0))
    own = bits[run.number[some]]
    for k in range(LENGTH - GRAM + 1):
        hit = (own >> np.uint64(k)) & np.uint64(1) > 0
        start[run.begin[some[hit]] + k] = True
    # Bytes covered by a window that goes; windows end within their document.
    cover = np.zeros(len(run.data) + LENGTH + 1, np.int8)
    cover[: len(run.data)] += start
    cover[LENGTH:LENGTH + len(run.data)] -= start
    covered = np.cumsum(cover, dtype=np.int32)[: len(run.data)] > 0
    begin = 0
    for doc, key, end in zip(run.ids.tolist(), run.key.tolist(), run.ends.tolist()):
        c = covered[begin:end]
        if c.any():
            edges = np.flatnonzero(np.diff(np.r_[False, c, False].astype(np.int8)))
            yield (doc, key, end - begin, int(c.sum()), edges[::2].astype(np.int32), edges[1::2].astype(np.int32),
                   run.data[begin:end][~c].tobytes())
        else:
            yield doc, key, end - begin, 0, [], [], run.data[begin:end].tobytes()
        begin = end


def without_shared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc, key, n_bytes, n_removed, begins / ends (removed spans in bytes) and kept, the bytes left.

    doc is the id as a long (null: 2**63 - 1), key a code of the text (``tables.text_key``) that tells rows with one id apart.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = parts(spark)
    runs = keyed(docs, id_col, text_col).select("doc", F.coalesce("key", F.lit(0)).alias("key"), "text").mapInPandas(_runs, RUNS)

    def codes(frames):
        return _codes(frames, n)

    def shards(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _shards(left, right, n)

    def results(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        # Runs of equal rows have one name and one verdict.
        rows = [r for i in range(len(left)) for r in _results(left.iloc[i:i + 1], right, n)]
        return pd.DataFrame(rows, columns=["doc", "key", "n_bytes", "n_removed", "begins", "ends", "kept"])

    # Both later steps need the states.
    states = written(runs.mapInPandas(codes, CODES).groupBy("part").applyInPandas(_states, VERDICTS), "states")
    sent = runs.groupBy("run").cogroup(states.groupBy("run")).applyInPandas(shards, SHARDS)
    merged = sent.groupBy("part").applyInPandas(_merged, VERDICTS)
    verdicts = states.unionByName(merged)
    return runs.groupBy("run").cogroup(verdicts.groupBy("run")).applyInPandas(results, RESULT)


def digest(docs: DataFrame) -> DataFrame:
    out = without_shared(docs)
    return out.select(F.when(F.col("doc") < LAST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed",
                      F.size("begins").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
